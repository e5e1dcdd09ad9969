"""Sounding-shaped inputs derived from the given tables.

Two forms: orders and lineitem rendered as fixed-width lines, and whole sounding files that
hold all lineitem rows in groups of up to 40 levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondelake.functions.fixedwidth import decode
from sondelake.functions.layout import HEADER_LAYOUT, LEVEL_LAYOUT
from sondelake.operators.keys import serial_ids, sort_tasks
from sondelake.operators.scratch import scratch_path

LEVELS_PER_SOUNDING = 40
#: Soundings in each file of a load by the file-at-a-time rules.
SOUNDINGS_PER_FILE = 8

RAW_HEADER = """
concat('#ZZI', lpad(cast(o_custkey as {S}),8,'0'), ' ', lpad(cast(year(o_orderdate) as {S}),4,'0'), ' ',
  lpad(cast(month(o_orderdate) as {S}),2,'0'), ' ', lpad(cast(day(o_orderdate) as {S}),2,'0'), ' ',
  lpad(cast(o_orderkey%24 as {S}),2,'0'), ' ', lpad(cast(o_orderkey%10000 as {S}),4,'0'), ' ',
  lpad(cast(coalesce(n,0) as {S}),4,' '), ' ', rpad(substr(o_orderpriority,1,8),8,' '), ' ',
  rpad(o_orderstatus,8,' '), ' ', lpad(cast(cast(floor(o_totalprice) as int) as {S}),7,' '), ' ',
  lpad(cast(-o_custkey as {S}),8,' '))
"""

RAW_LEVEL = """
concat(cast(l_linenumber%10 as {S}), cast(l_suppkey%10 as {S}), ' ', lpad(cast(l_suppkey%100000 as {S}),5,' '), ' ',
  lpad(cast(l_partkey%1000000 as {S}),6,' '), l_linestatus,
  lpad(cast(cast(floor(l_extendedprice/10) as int) as {S}),5,' '), ' ',
  lpad(cast(cast(floor(l_quantity) as int) as {S}),5,' '), l_returnflag,
  lpad(cast(cast(round(l_discount*100) as int) as {S}),5,' '), ' ',
  lpad(cast(cast(round(l_tax*100) as int) as {S}),5,' '), ' ',
  lpad(cast(dayofyear(l_shipdate) as {S}),5,' '), ' ', lpad(cast(year(l_shipdate) as {S}),5,' '), ' ')
"""

# Header of sounding k with `declared` announced levels; the same text in both engines.
SOUNDING_HEADER = """
concat('#', lpad(cast(k as {S}),11,'0'), ' ', cast(1900+k%120 as {S}), ' ', lpad(cast(1+k%12 as {S}),2,'0'), ' ',
  lpad(cast(1+k%28 as {S}),2,'0'), ' ', lpad(cast(k%24 as {S}),2,'0'), ' ', lpad(cast(k%2400 as {S}),4,'0'), ' ',
  lpad(cast(declared as {S}),4,' '), ' ', rpad('tables',8,' '), ' ', rpad('',8,' '), ' ',
  lpad(cast(k%900000 as {S}),7,' '), ' ', lpad(cast(-(k%1800000) as {S}),8,' '))
"""

# What is wrong with the messy files, by sounding number b and line number n.
MESSY_KEY = "case when b%13 = 6 then b-6 else b end"
MESSY_DECLARED = "levels + case b%7 when 3 then 1 when 5 then -1 else 0 end"
MESSY_HEADER = "case when b%11 = 4 then substr(header,1,70) else header end"
MESSY_LINE = (
    "case when n%101 = 50 then substr(line,1,51) when n%307 = 9 then '' "
    "when n%211 = 100 then concat(substr(line,1,16),'12x45',substr(line,22)) else line end"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, header): one rendered header line per order."""
    counts = (
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    )
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(counts, orders.o_orderkey == counts.l_orderkey, "left")
    return joined.select("o_orderkey", F.expr(RAW_HEADER.format(S="string")).alias("header"))


def level_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, line): one rendered level line per lineitem row."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.expr(RAW_LEVEL.format(S="string")).alias("line")
    )


def header_blocks(spark: SparkSession, sf_dir: str, header: str = "header", files: int = 16) -> DataFrame:
    """Rendered headers as blocks without levels, spread over named files by order key."""
    return header_lines(spark, sf_dir).select(
        F.expr(f"concat('f', lpad(cast(o_orderkey % {files} as string), 3, '0'))").alias("file"),
        F.lit(0).cast("long").alias("block_start"),
        F.col("o_orderkey").alias("seq"),
        F.expr(header).alias("header"),
        F.array().cast("array<string>").alias("body"),
    )


def header_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a header table: id and uid are the order key."""
    return header_lines(spark, sf_dir).select(
        F.col("o_orderkey").alias("header_id"),
        *decode("header", HEADER_LAYOUT),
        F.col("o_orderkey").cast("string").alias("uid"),
    )


def level_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as a level table, pointing at orders."""
    return level_lines(spark, sf_dir).select(
        *decode("line", LEVEL_LAYOUT), F.col("l_orderkey").cast("string").alias("uid")
    )


_kept: dict[tuple, object] = {}


def once(spark: SparkSession, *key: str, make):
    """Keep what ``make`` returns for the rest of the session."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _kept:
        _kept[full] = make()
    return _kept[full]


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lineitem lines with their number n in table order and their sounding b."""

    def make() -> DataFrame:
        source = table(spark, sf_dir, "lineitem")
        lines = source.select(
            "l_orderkey", "l_linenumber", F.expr(RAW_LEVEL.format(S="string")).alias("line")
        )
        # Equal lines may come in any order; the last column lets a hot value be split.
        tied = lines.withColumn("tie", F.monotonically_increasing_id())
        order = ["l_orderkey", "l_linenumber", "line", "tie"]
        numbered = serial_ids(tied, order, base=-1, name="n", keep=["line"], n_rows=source.count())
        return numbered.select("n", F.expr(f"n div {LEVELS_PER_SOUNDING}").alias("b"), "line")

    return once(spark, sf_dir, "numbered", make=make)


def sounding_lines(spark: SparkSession, sf_dir: str, *, messy: bool) -> DataFrame:
    """(b, i, value): text lines of all soundings, the header of each first."""
    lines = numbered_lines(spark, sf_dir)
    # Numbers have no gaps, so every sounding is full but the last.
    headers = (
        lines.where(F.col("n") % LEVELS_PER_SOUNDING == 0)
        .select("b", F.least(F.lit(LEVELS_PER_SOUNDING), F.lit(lines.count()) - F.col("n")).alias("levels"))
        .withColumn("k", F.expr(MESSY_KEY if messy else "b"))
        .withColumn("declared", F.expr(MESSY_DECLARED if messy else "levels"))
        .withColumn("header", F.expr(SOUNDING_HEADER.format(S="string")))
        .select("b", F.lit(0).alias("i"), F.expr(MESSY_HEADER if messy else "header").alias("value"))
    )
    body = lines.select(
        "b",
        F.expr(f"cast(n % {LEVELS_PER_SOUNDING} as int) + 1").alias("i"),
        F.expr(MESSY_LINE if messy else "line").alias("value"),
    )
    return headers.union(body)


def sounding_records(spark: SparkSession, sf_dir: str, per_file: int) -> DataFrame:
    """All messy soundings as the text scan gives them (file, block_start, value), in files of
    ``per_file`` soundings whose names follow the sounding number."""
    n_lines = numbered_lines(spark, sf_dir).count()
    lines = sounding_lines(spark, sf_dir, messy=True).withColumn(
        "file", F.expr(f"concat('f', lpad(cast(b div {per_file} as string), 8, '0'), '.txt')")
    )
    # Brought together once, by file; the grouping by sounding stays where its lines are.
    texts = lines.repartition(*sort_tasks(spark, n_lines), "file").groupBy("file", "b").agg(
        # A sounding has at most `LEVELS_PER_SOUNDING` lines besides its header.
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda r: r["value"]), "\n").alias("text")
    )
    named = texts.withColumn("block_start", F.expr(f"b % {per_file}"))
    is_last = (F.col("block_start") == per_file - 1) | (F.col("b") == (n_lines - 1) // LEVELS_PER_SOUNDING)
    # The separator takes the mark of all records but a file's first; a file ends with a line break.
    value = F.when(F.col("block_start") == 0, F.col("text")).otherwise(F.expr("substr(text, 2)"))
    return named.select("file", "block_start", F.concat(value, F.when(is_last, "\n").otherwise("")).alias("value"))


def write_soundings(lines: DataFrame, folder: str) -> None:
    """Append text files; file names and lines in files follow the sounding number."""
    tasks = sort_tasks(lines.sparkSession, lines.count())
    ordered = lines.repartitionByRange(*tasks, "b").sortWithinPartitions("b", "i")
    ordered.select("value").write.mode("append").text(folder)


def sounding_files(spark: SparkSession, sf_dir: str, *, messy: bool) -> str:
    """Folder with all soundings as text files."""

    def make() -> str:
        folder = scratch_path(spark, "inbox")
        write_soundings(sounding_lines(spark, sf_dir, messy=messy), folder)
        return folder

    return once(spark, sf_dir, "messy" if messy else "clean", make=make)


