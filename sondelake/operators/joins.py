"""Joins whose strategy depends on a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest number of rows that is broadcast. The joined rows are a key and a short text, so
#: this stays well below a hundred megabytes per executor.
BROADCAST_ROWS = 500_000

#: Bits of the filter that is broadcast for more rows: 4 MB, whatever the input.
FILTER_BITS = 1 << 25

_PART, _BITS, _HIT = "_part", "_bits", "_hit"


def is_empty_or_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[bool, bool]:
    """Whether ``df`` (a written table) is empty, and whether it has at most ``limit`` rows.

    A count without columns is answered from the Parquet footers, one number per task.
    """
    n = df.count()
    return n == 0, n <= limit


def _marked(big: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """``big`` with a mark that is false where ``on`` is certainly not among the keys of ``small``.

    The mark is looked up in a bitmap of hashed keys, built with map-side combine and broadcast
    in parts of 4 KB. With very many keys it fills up and more rows pass, which costs time only.
    """
    bit = f"pmod(xxhash64({on}), {FILTER_BITS}) + 1"
    bits = (
        small.select(
            F.expr(f"bitmap_bucket_number({bit})").alias(_PART),
            F.expr(f"bitmap_bit_position({bit})").alias("position"),
        )
        .groupBy(_PART)
        .agg(F.bitmap_construct_agg("position").alias(_BITS))
    )
    byte = f"conv(hex(substring({_BITS}, cast(bitmap_bit_position({bit}) div 8 as int) + 1, 1)), 16, 10)"
    is_set = f"(shiftright(cast({byte} as int), cast(bitmap_bit_position({bit}) % 8 as int)) & 1) = 1"
    placed = big.withColumn(_PART, F.expr(f"bitmap_bucket_number({bit})"))
    return placed.join(F.broadcast(bits), _PART, "left").select(
        *big.columns, F.coalesce(F.expr(is_set), F.lit(False)).alias(_HIT)
    )


def join_checked(
    big: DataFrame, small: DataFrame, on: str, how: str, *, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join ``small`` (a written table) to ``big`` without moving ``big`` where possible.

    ``how`` is ``left``, ``left_anti``, ``left_semi`` or ``inner``. The size of ``small`` is
    looked up first: an anti join with nothing is a no-op, and at most ``limit`` rows are
    broadcast. With more, a broadcast bitmap tells the rows of ``big`` that cannot match: they
    stay where they are, and only the others are shuffled. Adaptive execution splits a hot key
    of ``big`` in all four kinds of join.

    More than ``limit`` rows are never broadcast, whatever Spark makes of the size of their files: packed
    ids take two bytes there and a hundred in the driver.
    """
    empty, fits = is_empty_or_small(small, limit)
    if empty and how == "left_anti":
        return big
    if fits:
        return big.join(F.broadcast(small), on, how)
    marked = _marked(big, small, on)
    joined = marked.where(_HIT).drop(_HIT).join(small.hint("merge"), on, how)
    if how in ("inner", "left_semi"):
        return joined
    kept = marked.where(~F.col(_HIT)).drop(_HIT)
    if how == "left":
        kept = kept.withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in small.schema.fields if f.name != on}
        )
    return joined.unionByName(kept)
