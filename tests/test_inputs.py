"""How the inputs of the whole runs are built: what is moved and written, and by how many tasks."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from sondelake.operators import keys
from sondelake.operators.scratch import write_scratch
from workload import inputs, queries

#: Lines of the table made here: three whole soundings and one of five lines.
LINES = 3 * inputs.LEVELS_PER_SOUNDING + 5


@pytest.fixture
def tables(spark, tmp_path):
    rows = spark.range(LINES).selectExpr(
        "(id * 7) % 50 as l_orderkey", "id % 20 as l_partkey", "id % 9 as l_suppkey", "cast(id % 7 as int) as l_linenumber",
        "cast(id % 50 as double) as l_quantity", "cast(id * 10 as double) as l_extendedprice", "0.05D as l_discount",
        "0.02D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", "timestamp '1996-01-02 00:00:00' as l_shipdate",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def _scratch(spark, label):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return {name for name in os.listdir(base) if name.startswith(f"sondelake-{label}-")} if os.path.isdir(base) else set()


def _exchanges(rows):
    """Shuffles of a plan by the columns of a sounding; those of the few rows per task are by others."""
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"Exchange \w+\((file|b)#", line)]


def test_many_lines_are_sorted_by_as_many_tasks_as_they_need(spark, tables, monkeypatch, tmp_path):
    monkeypatch.setattr(keys, "SORTED_ROWS", 10)
    inputs.write_soundings(inputs.sounding_lines(spark, tables, messy=False), f"{tmp_path}/inbox")
    text = spark.read.text(f"{tmp_path}/inbox").withColumn("file", F.input_file_name())
    assert text.select("file").distinct().count() > spark.sparkContext.defaultParallelism
    files = text.groupBy("file").agg(F.collect_list("value").alias("lines")).orderBy("file").collect()
    ordered = [line for row in files for line in row.lines]
    heads = [line for line in ordered if line.startswith("#")]
    assert len(ordered) == LINES + 4 and heads == sorted(heads)
    assert [int(h[32:36]) for h in heads] == [40, 40, 40, 5]


def test_numbers_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(keys, "SORTED_ROWS", 7)
    rows = write_scratch(spark.range(100).selectExpr("id % 13 as k", "id as v"), "rows")
    got = keys.serial_ids(rows, ["k", "v"], name="n", keep=["v"], n_rows=100)
    assert got.columns == ["n", "v"]
    want = sorted(range(100), key=lambda v: (v % 13, v))
    assert [r.v for r in got.orderBy("n").collect()] == want
    assert got.rdd.getNumPartitions() > 0 and keys.sort_tasks(spark, 100) == [15] and keys.sort_tasks(spark, 7) == []


def test_halves_are_not_written_before_their_files(spark, tables):
    before = _scratch(spark, "lines")
    halves = queries._halves(spark, tables)
    assert _scratch(spark, "lines") == before
    assert [sorted({r.b for r in half.collect()}) for half in halves] == [[0, 1], [2, 3]]


def test_records_are_moved_once_and_only_those_asked_for(spark, tables):
    records = inputs.sounding_records(spark, tables, 2)
    part = records.where(F.expr("cast(substr(file, 2, 8) as int) % 2 = 1"))
    moved = _exchanges(part)
    assert len(moved) == 1 and "file" in moved[0]
    plan = part._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {word: max(i for i, line in enumerate(plan) if word in line) for word in ("RepartitionByExpression", "% 2")}
    assert depth["% 2"] > depth["RepartitionByExpression"]
    got = {(r.file, r.block_start): r.value for r in records.collect()}
    assert set(got) == {(f"f{f:08d}.txt", k) for f in (0, 1) for k in (0, 1)}
    assert [k for k in sorted(got) if got[k].endswith("\n")] == [("f00000000.txt", 1), ("f00000001.txt", 1)]
    assert [got[k].startswith("#") for k in sorted(got)] == [True, False, True, False]


def test_scratch_tables_are_packed(spark):
    path = write_scratch(spark.range(10), "packed").inputFiles()
    assert all(".zstd." in name for name in path)
