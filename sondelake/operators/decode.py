"""Blocks to typed header rows and typed level rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondelake.functions.fixedwidth import block_uid, decode, level_count
from sondelake.functions.layout import HEADER_LAYOUT, LEVEL_LAYOUT, Layout

ORIGIN = ("file", "block_start", "seq")


def header_is_sound(layout: Layout = HEADER_LAYOUT):
    """Exact width and a readable level count; without both a header cannot be used."""
    readable = level_count("header", layout).isNotNull()
    return F.coalesce((F.length("header") == layout.width) & readable, F.lit(False))


def decode_headers(blocks: DataFrame, layout: Layout = HEADER_LAYOUT) -> DataFrame:
    """One row per block: origin, raw header, decoded columns and uid."""
    return blocks.select(
        *ORIGIN, "header", *decode("header", layout), block_uid("header", layout).alias("uid")
    )


def level_lines(
    blocks: DataFrame, layout: Layout = HEADER_LAYOUT, beside: Sequence[str] = ()
) -> DataFrame:
    """Lines that belong to a block: the first N after its header, all of them or none.

    A group with fewer than N lines yields nothing; lines beyond N are ignored. ``beside`` names
    header columns that each line is to carry.
    """
    count = level_count("header", layout)
    whole = (F.length("header") == layout.width) & (count > 0) & (F.size("body") >= count)
    # What comes from the header is decoded before the lines multiply: once per block, not per line.
    decoded = {f.name.lower(): c for f, c in zip(layout.ordered, decode("header", layout))}
    keyed = blocks.where(whole).select(
        *ORIGIN,
        block_uid("header", layout).alias("uid"),
        *[decoded[name] for name in beside],
        F.slice("body", F.lit(1), count).alias("lines"),
    )
    return keyed.select(*ORIGIN, "uid", *beside, F.posexplode("lines").alias("pos", "line"))


def sized_lines(lines: DataFrame, layout: Layout = LEVEL_LAYOUT) -> DataFrame:
    """Lines of exactly the record width; any other line is left out silently."""
    return lines.where(F.length("line") == layout.width)


def decode_levels(lines: DataFrame, layout: Layout = LEVEL_LAYOUT, keep: tuple = ()) -> DataFrame:
    """Decoded columns and uid of correctly sized lines, after the columns in ``keep``."""
    return sized_lines(lines, layout).select(*keep, *decode("line", layout), "uid")
