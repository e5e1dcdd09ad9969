"""Checks on decoded rows and what follows from a failed one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondelake.functions.fixedwidth import malformed_name
from sondelake.functions.layout import HEADER_LAYOUT, LEVEL_LAYOUT, Layout
from sondelake.operators.decode import header_is_sound
from sondelake.operators.joins import join_checked
from sondelake.operators.scratch import write_scratch
from sondelake.schemas import (
    HEADER_NOT_NULL,
    HEADER_TEXT_WIDTHS,
    LEVEL_NOT_NULL,
    LEVEL_TEXT_WIDTHS,
)

BAD_HEADER = "bad_header"
DUPLICATE_UID = "duplicate_uid"
FILE_REFUSED = "file_refused"


def null_name(columns: Iterable[str]) -> Column:
    """Name of the first of the columns that is NULL; NULL if none is."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])


def wide_name(widths: Mapping[str, int]) -> Column:
    """Name of the first text column longer than its declared width; NULL if none is."""
    return F.coalesce(*[F.when(F.length(c) > n, F.lit(c)) for c, n in widths.items()])


def first_reason(*checks: tuple[str, Column]) -> Column:
    """``label:column`` of the first failed check; NULL if all pass."""
    return F.coalesce(*[F.concat(F.lit(f"{label}:"), name) for label, name in checks])


def _row_checks(not_null: Iterable[str], widths: Mapping[str, int], layout: Layout) -> tuple:
    """Checks on the declared columns that rows of ``layout`` have; the uid is always one."""
    known = {f.name.lower() for f in layout.fields} | {"uid"}
    return (
        ("null", null_name([c for c in not_null if c in known])),
        ("width", wide_name({c: n for c, n in widths.items() if c in known})),
    )


def header_checks(layout: Layout = HEADER_LAYOUT) -> tuple:
    return _row_checks(HEADER_NOT_NULL, HEADER_TEXT_WIDTHS, layout)


def level_checks(layout: Layout = LEVEL_LAYOUT) -> tuple:
    return _row_checks(LEVEL_NOT_NULL, LEVEL_TEXT_WIDTHS, layout)


def header_reason(layout: Layout = HEADER_LAYOUT) -> Column:
    """Why a row of `decode_headers` must not be loaded; NULL if it may."""
    return F.when(~header_is_sound(layout), F.lit(BAD_HEADER)).otherwise(
        first_reason(("malformed", malformed_name("header", layout)), *header_checks(layout))
    )


def level_reason(layout: Layout = LEVEL_LAYOUT) -> Column:
    """Why a decoded level must not be loaded, next to its ``line``; NULL if it may."""
    return first_reason(("malformed", malformed_name("line", layout)), *level_checks(layout))


def bad_header_cutoffs(blocks: DataFrame, layout: Layout = HEADER_LAYOUT) -> DataFrame:
    """(file, cutoff): position of the first unusable header of each file that has one."""
    return (
        blocks.where(~header_is_sound(layout))
        .groupBy("file")
        .agg(F.min(F.struct("block_start", "seq")).alias("cutoff"))
    )


def cut_at_bad_header(blocks: DataFrame, layout: Layout = HEADER_LAYOUT) -> DataFrame:
    """Keep only the blocks of each file before its first unusable header."""
    cutoffs = write_scratch(bad_header_cutoffs(blocks, layout), "cutoffs")
    marked = join_checked(blocks, cutoffs, "file", "left")
    before = F.struct("block_start", "seq") < F.col("cutoff")
    return marked.where(F.col("cutoff").isNull() | before).drop("cutoff")
