"""Mixing sources to target weights with Efraimidis-Spirakis sampling, in DataFrame operations only.

A source's budget first buys complete epochs of it. What is left is drawn without replacement: each
document gets an exponential key divided by its quality weight, documents are sorted by key within
their source, and sizes are summed in that order until the budget is spent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondelake.operators.scratch import write_scratch

SHARES = (5, 2, 1)
MOST_EPOCHS = 3
#: Rows of the per-source table up to which it is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 100_000
#: Order of a source's documents; the last column only keeps equal rows from being one range.
ORDER = ("key", "doc_id", "size", "text_key", "row")


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """A weight in (0, 1]: less for texts with many symbols for their length. A null has weight 1."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0))
    return F.lit(1.0) / (1.0 + 20.0 * symbols / F.greatest(F.coalesce(F.length(text), F.lit(1)), F.lit(1)))


def uniform(identity: Column) -> Column:
    """A number in (0, 1) that depends on nothing but ``identity``."""
    digits = F.conv(F.substring(F.md5(F.coalesce(identity.cast("string"), F.lit(""))), 1, 13), 16, 10)
    return (digits.cast("double") + 0.5) / 2.0**52


def targets(sources: DataFrame, shares: tuple[int, ...], most: int) -> DataFrame:
    """Words to take from each source, from its ``source`` and ``source_size``.

    Sources in code point order, null last, weigh ``shares`` in turn and share the sum of all sizes.
    A target stops at ``most`` times its source's size; what is over goes to the others by weight
    until none is above. That end point is the same as one water level: sources fill up in
    the order of bound / weight, and one is full if the level the rest would reach passes its bound.
    The table has one row per source, so it is ordered in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(s)) for s in shares)), (place % len(shares) + 1).cast("int"))
    fill = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sources.withColumns({"place": place, "weight": weight}).withColumn(
        "bound", (most * F.col("source_size")).cast("double")
    ).withColumn("ratio", F.col("bound") / F.col("weight"))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(fill), F.lit(0.0))) / F.sum("weight").over(rest)
    # Sources before the first one that is not full are full; the rest share its level.
    levels = ranked.withColumn("level", level).withColumn(
        "open", F.when(F.col("ratio") > F.col("level"), F.col("level"))
    )
    shared = F.first("open", ignorenulls=True).over(everything)
    return levels.withColumn("shared", shared).select(
        "source",
        "source_size",
        "n_docs",
        F.round(F.least("bound", F.coalesce(F.col("shared") * F.col("weight"), F.col("bound"))), 6).alias("target"),
    )


def key_ranges(slim: DataFrame) -> DataFrame:
    """The rows with their ``range``: even parts of all rows by source and `ORDER`, in that order.

    Bounds are drawn from the keys themselves, so no weights crowd a range, and equal keys are split
    by the columns after them. The ranges are stored, as they must not be drawn again.
    """
    dealt = slim.repartitionByRange("source", *ORDER).withColumn("range", F.spark_partition_id())
    return write_scratch(dealt, "mix-ranges")


def mix(
    docs: DataFrame,
    shares: tuple[int, ...] = SHARES,
    most: int = MOST_EPOCHS,
    weight: Column | None = None,
) -> DataFrame:
    """How many words of each document the mix takes.

    Needs ``doc_id``, ``text`` and ``source``; other columns are not looked at. Returns doc_id,
    source, size, source_size, target, taken, and weight. A null text has size 0 and is
    taken 0 times; a null source is a source of its own; a null id draws the same key as any other
    null id. Of equal keys the smaller id, then the smaller size and text hash goes first; rows
    equal in all of these may swap places. The last document drawn is taken in part, so a source's
    taken words are its target rounded. Repeated rows count as so many documents. An empty
    table gives an empty result. Reruns agree, as keys depend on the id alone. A ``weight`` of the
    caller's that is null or not above 0 puts a document behind all others of its source.

    A source may hold any share of the rows and its weights any distribution: rows are dealt into even
    ranges of what they are ordered by, sizes are summed per range first, and each range is ordered alone.
    """
    text = F.col("text")
    given = quality(text) if weight is None else weight
    slim = write_scratch(
        docs.select(
            "doc_id",
            "source",
            word_count(text).alias("size"),
            given.alias("weight"),
            F.xxhash64("text").alias("text_key"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("key", F.when(F.col("weight") > 0, -F.log(uniform(F.col("doc_id"))) / F.col("weight")).otherwise(F.lit(float("inf")))),
        "mix-sizes",
    )
    totals = write_scratch(
        slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), "mix-sources"
    )
    budget = targets(totals, shares, most).select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.round("target").cast("long").alias("words"),
    )
    if totals.count() <= BROADCAST_SOURCES:
        budget = F.broadcast(budget)
    full = F.col("source_size") > 0
    keyed = (
        key_ranges(slim).join(budget, F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("epochs", F.when(full, F.least(F.floor(F.col("words") / F.col("source_size")), F.lit(most))).otherwise(0))
        .withColumn("left_over", F.col("words") - F.col("epochs") * F.col("source_size"))
    )
    per_range = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = per_range.select(
        F.col("source").alias("of_source"),
        F.col("range").alias("of_range"),
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("before_range"),
    )
    inside = Window.partitionBy("source", "range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(
        before, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("range") == F.col("of_range"))
    ).withColumn("before", F.col("before_range") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left_over") - F.col("before")))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        "weight",
    )
