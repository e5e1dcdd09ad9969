"""Unique keys and serial ids."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sondelake.operators.joins import is_empty_or_small, join_checked
from sondelake.operators.scratch import write_scratch

#: Claims of a component of files that one task walks; a claim is a uid and a file name.
SETTLED_CLAIMS = 200_000

#: Rows of a line's width that one task sorts: about a hundred megabytes, so that it need not spill.
SORTED_ROWS = 500_000

# monotonically_increasing_id() keeps the partition above this many bits of row number.
_ROW_BITS = 33


#: Characters of a uid that decide its part (a station), and the number of parts.
PART_CHARACTERS = 11
UID_PARTS = 256


def uid_parts(rows: DataFrame) -> DataFrame:
    """``part, low, high``: for each part of the uids, the smallest and largest rest.

    At most `UID_PARTS` rows, whatever the size of ``rows``. Where uids begin with a place and go on
    with a time, a part's rest is the period in which its places have rows.
    """
    part = F.pmod(F.xxhash64(F.substring("uid", 1, PART_CHARACTERS)), F.lit(UID_PARTS)).cast("int")
    rest = F.expr(f"substring(uid, {PART_CHARACTERS + 1})")
    return rows.where("uid IS NOT NULL").groupBy(part.alias("part")).agg(F.min(rest).alias("low"), F.max(rest).alias("high"))


def loads_that_may_hold(uids: DataFrame, headers: DataFrame, summaries: DataFrame, load: str) -> DataFrame:
    """(load) of the loads that can hold any of ``uids``; the headers of all others need not be read.

    ``summaries`` are the `uid_parts` of each load. A load without any, but with headers, can hold
    whatever it likes. No uid is compared: only a few hundred rows per load are.
    """
    wanted = uid_parts(uids).select("part", F.col("low").alias("from"), F.col("high").alias("to"))
    near = summaries.join(F.broadcast(wanted), "part").where((F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")))
    unknown = headers.select(load).distinct().join(summaries.select(load).distinct(), load, "left_anti")
    return near.select(load).distinct().union(unknown)


def uids_taken(uids: DataFrame, existing: DataFrame) -> DataFrame:
    """(uid) of those in ``uids`` (a written table, each uid once) that ``existing`` holds.

    A load is usually small next to the tables it joins: its uids are then broadcast, and the
    existing ones are only read. Those of a large one are not, however well their files are packed.
    """
    _, fits = is_empty_or_small(uids)
    wanted = uids.select("uid").hint("broadcast" if fits else "merge")
    return existing.select("uid").join(wanted, "uid", "left_semi")


def first_per_uid(keys: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(seq) of the row that keeps each uid: the first by (file, block_start, seq).

    ``keys`` has uid, file, block_start and seq. Uids found in ``existing`` are taken. The
    choice is an aggregate with map-side combine, so copies of one uid never meet in a task.
    """
    firsts = keys.groupBy("uid").agg(F.min(F.struct("file", "block_start", "seq")).alias("first"))
    if existing is not None:
        firsts = write_scratch(firsts, "firsts")
        # Both sides hold a uid once, so no key of this join is hot.
        firsts = join_checked(firsts, write_scratch(uids_taken(firsts, existing), "taken"), "uid", "left_anti")
    return firsts.select(F.col("first.seq").alias("seq"))


def duplicates(keys: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(seq) of all rows that do not keep their uid."""
    # There are about as many firsts as rows: none of them go through the driver.
    return keys.select("seq").join(first_per_uid(keys, existing).hint("merge"), "seq", "left_anti")


def _components(claims: DataFrame) -> DataFrame:
    """``file, component``: files connected by shared uids have the same component, the first file's name.

    Each round a file takes the smallest label that any of its uids meets, and then that label's own, so
    distances shrink by a factor and the rounds are a logarithm of the longest chain.
    """
    labels = write_scratch(claims.select("file", F.col("file").alias("component")).distinct(), "labels")
    while True:
        per_uid = claims.join(labels, "file").groupBy("uid").agg(F.min("component").alias("least"))
        near = claims.join(per_uid, "uid").groupBy("file").agg(F.min("least").alias("near"))
        beyond = labels.select(F.col("file").alias("near"), F.col("component").alias("beyond"))
        moved = write_scratch(labels.join(near, "file").join(beyond, "near").select("file", "component", "beyond"), "labels")
        labels = moved.select("file", F.col("beyond").alias("component"))
        if moved.where("beyond < component").isEmpty():
            return labels


def _by_component_size(claims: DataFrame, settled: int) -> tuple[DataFrame, DataFrame]:
    """The claims of components that one task can walk, with their component, and all others."""
    named = write_scratch(claims.join(_components(claims), "file"), "components")
    small = named.groupBy("component").count().where(F.col("count") <= settled).select("component")
    small = write_scratch(small, "small")
    rest = join_checked(named, small, "component", "left_anti").select(*claims.columns)
    return join_checked(named, small, "component", "left_semi"), write_scratch(rest, "open")


def _walked(claims: pd.DataFrame) -> pd.DataFrame:
    """Files of one component that are refused when they come one after the other."""
    taken: set[str] = set()
    refused = []
    for file, uids in claims.groupby("file", sort=True)["uid"]:
        if taken.isdisjoint(uids):
            taken.update(uids)
        else:
            refused.append(file)
    return pd.DataFrame({"file": refused}, dtype=object)


def files_with_conflicts(
    keys: DataFrame,
    existing: DataFrame | None = None,
    already_refused: DataFrame | None = None,
    *,
    settled: int = SETTLED_CLAIMS,
) -> DataFrame:
    """(file) of the files that a file-at-a-time load would refuse for a uid conflict.

    Files load in name order. A file is refused as a whole if it holds a uid twice, or holds
    a uid that is in ``existing`` or in a file accepted before it; a refused file claims no
    uids. ``already_refused`` lists files that fail for another reason.

    Only uids found in several files matter, and only files connected by such uids bear on one another. A
    component of files with up to ``settled`` claims is walked in name order by one task. A larger one
    is settled by rounds: each accepts every file that comes first for all its open uids and refuses the
    files sharing a uid with an accepted one; their number follows the longest chain of files in conflict. No
    pairs of files are ever formed. A round writes what it settled, so that plans do not grow.
    """
    per_file = keys.groupBy("uid", "file").agg(F.count("*").alias("n"))
    claims = write_scratch(per_file, "claims")
    refused = claims.where("n > 1").select("file")
    if existing is not None:
        uids = write_scratch(claims.select("uid").distinct(), "uids")
        taken = write_scratch(uids_taken(uids, existing), "taken")
        refused = refused.union(
            join_checked(claims, taken, "uid", "left_semi").select("file")
        )
    if already_refused is not None:
        refused = refused.union(already_refused.select("file"))
    refused = write_scratch(refused.distinct(), "refused")
    valid = join_checked(claims.select("uid", "file"), refused, "file", "left_anti")
    shared = (
        valid.groupBy("uid")
        .agg(F.min("file").alias("lo"), F.max("file").alias("hi"))
        .where("lo <> hi")
        .select("uid")
    )
    open_claims = write_scratch(
        join_checked(valid, write_scratch(shared, "shared"), "uid", "left_semi"),
        "open",
    )
    if not open_claims.isEmpty():
        small, open_claims = _by_component_size(open_claims, settled)
        refused = write_scratch(refused.union(small.groupBy("component").applyInPandas(_walked, "file string")), "refused")
    while not open_claims.isEmpty():
        leaders = open_claims.groupBy("uid").agg(F.min("file").alias("file"))
        led = leaders.groupBy("file").agg(F.count("*").alias("led"))
        total = open_claims.groupBy("file").agg(F.count("*").alias("total"))
        accepted = led.join(total, "file").where("led = total").select("file")
        gone = leaders.join(accepted, "file", "left_semi").select("uid", F.col("file").alias("winner"))
        lost = join_checked(open_claims, write_scratch(gone, "won"), "uid", "inner")
        lost = lost.where("file <> winner").select("file").distinct()
        decided = accepted.withColumn("lost", F.lit(False)).union(lost.withColumn("lost", F.lit(True)))
        decided = write_scratch(decided, "decided")
        refused = write_scratch(refused.union(decided.where("lost").select("file")), "refused")
        open_claims = write_scratch(
            join_checked(open_claims, decided.select("file"), "file", "left_anti"), "open"
        )
    return refused


def sort_tasks(spark: SparkSession, n_rows: int) -> list[int]:
    """The number of partitions to ask for when ``n_rows`` are sorted; none, for the session's, if one would do.

    The session's number is fixed, and adaptive execution merges partitions by their packed size: with
    many rows either way a task would spill.
    """
    wanted = -(-n_rows // SORTED_ROWS)
    return [max(wanted, spark.sparkContext.defaultParallelism)] if wanted > 1 else []


def serial_ids(
    rows: DataFrame,
    order: list[str | Column],
    *,
    base: int = 0,
    name: str = "header_id",
    keep: Sequence[str] | None = None,
    n_rows: int = 0,
) -> DataFrame:
    """Number rows ``base+1, base+2, ...`` in the given total order.

    Rows are range-partitioned and sorted within partitions, written once, and each partition
    is offset by the sizes of those before it. The only single-task step sees one row per
    partition. The result stays in id order, so range filters on the id skip row groups.

    Columns outside ``keep``, if given, only order the rows. Callers with many rows tell their number
    ``n_rows``, so that no task sorts more than it can hold.
    """
    kept = rows.columns if keep is None else list(keep)
    ordered = rows.repartitionByRange(*sort_tasks(rows.sparkSession, n_rows), *order).sortWithinPartitions(*order)
    placed = write_scratch(ordered.select(*kept, F.monotonically_increasing_id().alias("_place")), "serial")
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.lit(base + 1) + F.col("_offset") + row).cast("long").alias(name), *kept)
    )
