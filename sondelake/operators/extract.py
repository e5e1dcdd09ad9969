"""The published rows: headers joined with their levels, narrowed and banded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondelake.functions.bands import PARTITION_COLUMN, partition_band
from sondelake.schemas import HEADER_TEXT_WIDTHS, LEVEL_TEXT_WIDTHS, PUBLISHED_COLUMNS


def max_header_id(headers: DataFrame) -> DataFrame:
    """One row with the highest header id, NULL if there are no headers."""
    return headers.agg(F.max("header_id").alias("max_head"))


def id_range(
    hi: int, lo: int | None = None, *, inclusive: bool = False, column: str = "header_id"
) -> Column:
    """Ids up to ``hi`` and, for a delta, above ``lo`` (or from it, if inclusive)."""
    header_id = F.col(column)
    upper = header_id <= hi
    if lo is None:
        return upper
    return upper & ((header_id >= lo) if inclusive else (header_id > lo))


def join_levels(
    headers: DataFrame, levels: DataFrame, on: Sequence[str] = ("uid",)
) -> DataFrame:
    """Inner join of headers and their levels.

    Headers hold each uid once. A short range of headers is small enough for adaptive
    execution to broadcast it; a full load is a shuffle join whose skewed partitions adaptive
    execution splits, should one uid own very many levels.
    """
    return headers.join(levels, list(on), "inner")


def extract(
    headers: DataFrame,
    levels: DataFrame,
    hi: int,
    lo: int | None = None,
    *,
    inclusive: bool = False,
    on: Sequence[str] = ("uid",),
) -> DataFrame:
    """Published columns of all levels whose header lies in the id range."""
    chosen = headers.where(id_range(hi, lo, inclusive=inclusive))
    header_columns = [c for c in PUBLISHED_COLUMNS if c in headers.columns]
    level_columns = [c for c in PUBLISHED_COLUMNS if c in levels.columns]
    keys = list(on)
    joined = join_levels(
        chosen.select(*keys, *header_columns), levels.select(*keys, *level_columns), keys
    )
    return publish_columns(joined)


def publish_columns(joined: DataFrame) -> DataFrame:
    """The published columns in order; keys and ids are not published."""
    return joined.select(*PUBLISHED_COLUMNS)


def pad_text(rows: DataFrame) -> DataFrame:
    """Text columns filled up with blanks to their declared width, as CHAR(n) columns read."""
    widths = {**HEADER_TEXT_WIDTHS, **LEVEL_TEXT_WIDTHS}
    return rows.withColumns(
        {c: F.rpad(c, widths[c], " ") for c in rows.columns if c in widths}
    )


def with_band(rows: DataFrame) -> DataFrame:
    return rows.withColumn(PARTITION_COLUMN, partition_band(F.col("gph")))
