"""A fixed-size filter for ids, so that only rows that may matter are shuffled.

The filter is a bitmap of hashed ids. A row whose bit is not set is certainly not among the ids; a
row whose bit is set is settled by a join. With very many ids the bitmap fills up and lets more
rows pass, which costs time but changes no result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter: 4 MB, whatever the input.
BITS = 1 << 25
_BYTES_PER_PART = 4096


def spare_name(taken: Iterable[str], name: str) -> str:
    """``name``, or a longer one if a column is called so already."""
    known = {column.lower() for column in taken}
    while name in known:
        name += "_"
    return name


def bit_of(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITS))


def bitmap(ids: DataFrame, *keys: str) -> Broadcast:
    """The broadcast bitmap of the ``keys`` of all rows, built by the cluster in parts of 4 KB."""
    bit = bit_of(*keys) + 1
    parts = (
        ids.select(F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("position"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
        .collect()
    )
    filled = np.zeros(BITS // 8, dtype=np.uint8)
    for row in parts:
        start = (row.part - 1) * _BYTES_PER_PART
        filled[start : start + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return ids.sparkSession.sparkContext.broadcast(filled)


def is_set(bits: np.ndarray, column: pa.Array) -> np.ndarray:
    """Which values of a `bit_of` column are set."""
    at = column.to_numpy(zero_copy_only=False).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def passing(rows: DataFrame, wanted: Broadcast, which: bool, *keys: str) -> DataFrame:
    """The rows whose bit is set, or those whose bit is not, with their columns as they are."""
    name = spare_name(rows.columns, "filter_bit")
    marked = rows.withColumn(name, bit_of(*keys))

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = is_set(wanted.value, batch.column(name))
            yield batch.filter(pa.array(hit == which)).select(range(batch.num_columns - 1))

    return marked.mapInArrow(kept, rows.schema)
