"""What the physical plans must look like."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sondelake.functions.layout import HEADER_LAYOUT
from sondelake.operators import joins, keys
from sondelake.operators.decode import decode_levels, level_lines
from sondelake.operators.extract import extract, with_band
from sondelake.operators.joins import join_checked
from sondelake.operators.scratch import scratch_area, write_scratch
from sondelake.sources.blocks import cut_lines, read_records
from sondelake.sources.published import read_published, write_banded
from sondelake.sources.tables import save_bucketed
from tests.soundings import header, level, put
from workload import inputs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_and_decode_need_no_shuffle(spark, tmp_path):
    put(tmp_path, "a.txt", "\n".join([header(1), level()]) + "\n")
    assert "Exchange" not in plan(cut_lines(read_records(spark, str(tmp_path)), HEADER_LAYOUT))
    lines = inputs.level_lines(spark, SF).withColumn("uid", F.lit("u"))
    text = plan(decode_levels(lines))
    assert "Exchange" not in text and "Python" not in text


def test_level_lines_read_only_their_columns(spark, tmp_path):
    put(tmp_path, "a.txt", "\n".join([header(1), level()]) + "\n")
    cut = write_scratch(cut_lines(read_records(spark, str(tmp_path)), HEADER_LAYOUT), "cut")
    counted = cut.groupBy("file").count()
    assert "ReadSchema: struct<file:string>" in plan(counted)
    blocks = cut.select("file", "block_start", "seq", F.col("first_line").alias("header"), "body")
    text = plan(level_lines(blocks))
    # The key is built before the lines multiply.
    assert "trim(" not in text.split("Generate")[0]
    assert "end_decides" not in text.split("ReadSchema")[1]


def test_id_range_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "headers")
    inputs.header_table(spark, SF).write.parquet(path)
    headers, levels = spark.read.parquet(path), inputs.level_table(spark, SF)
    text = plan(extract(headers, levels, 100, 50))
    pushed = re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(header_id,100\)[^\]]*\]", text)
    assert pushed and "GreaterThan(header_id,50)" in pushed.group(0)


def test_reader_of_one_band_prunes_folders(spark, tmp_path):
    rows = extract(inputs.header_table(spark, SF), inputs.level_table(spark, SF), 10**6)
    path = str(tmp_path / "out")
    write_banded(with_band(rows), path)
    one = read_published(spark, path).where("partition_gph = 2").select("gph")
    text = plan(one)
    assert re.search(r"PartitionFilters: \[.*partition_gph#\d+ = 2", text)
    assert "ReadSchema: struct<gph:int>" in text
    assert {r[0] for r in one.select(F.ceil(F.col("gph") / 1000)).distinct().collect()} == {2}


def test_bucketed_tables_join_without_shuffle(spark):
    save_bucketed(inputs.header_table(spark, SF), "headers_b", 4)
    save_bucketed(inputs.level_table(spark, SF), "levels_b", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(extract(spark.table("headers_b"), spark.table("levels_b"), 10**6))
        assert "Exchange" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE headers_b")
        spark.sql("DROP TABLE levels_b")


def test_hot_uid_is_split_in_a_full_load(spark):
    levels = inputs.level_table(spark, "/root/testdata/sf0.01").withColumn(
        "uid", F.expr("if(press % 3 = 0, '77', uid)")
    )
    levels = write_scratch(levels.repartition(12), "hot")
    headers = inputs.header_table(spark, "/root/testdata/sf0.01")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "12",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, setting in settings.items():
            spark.conf.set(name, setting)
        rows = extract(headers, levels, 10**6)
        summed = rows.groupBy().agg(
            F.count("*").alias("n"), F.max(F.xxhash64(*rows.columns)).alias("all_columns")
        )
        matching = levels.join(headers.select("uid"), "uid", "left_semi").count()
        assert summed.collect()[0].n == matching
        assert "skew=true" in plan(summed)
    finally:
        for name, setting in before.items():
            if setting is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, setting)


def test_checked_join_gives_one_result_whatever_its_strategy(spark, monkeypatch):
    big = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) AS k")
    small = write_scratch(spark.range(0, 50, 7).selectExpr("id AS k", "id * 2 AS v"), "small")
    for how in ("left", "inner", "left_semi", "left_anti"):
        expected = sorted(map(str, big.join(small, "k", how).collect()))
        for options in ({}, {"limit": 3}):
            joined = join_checked(big, small, "k", how, **options)
            assert sorted(map(str, joined.collect())) == expected
    assert "Broadcast" in plan(join_checked(big, small, "k", "inner"))


def test_no_more_rows_than_the_limit_are_broadcast_however_well_they_are_packed(spark, monkeypatch):
    # Spark takes both tables for small ones: they are far below its own threshold.
    big = write_scratch(spark.range(1000).selectExpr("id AS k", "id % 2 AS b"), "big")
    small = write_scratch(spark.range(0, 1000, 7).selectExpr("id AS k", "'duplicate' AS reason"), "small")
    for how in ("left", "inner", "left_semi", "left_anti"):
        joined = join_checked(big, small, "k", how, limit=3)
        planned = plan(joined)
        assert joined.count() == {"left": 1000, "left_anti": 857}.get(how, 143)
        joined.collect()
        for text in (planned, plan(joined)):
            assert "SortMergeJoin [k#" in text and "BroadcastHashJoin [k#" not in text

    monkeypatch.setattr(joins.is_empty_or_small, "__defaults__", (3,))
    monkeypatch.setitem(joins.join_checked.__kwdefaults__, "limit", 3)
    rows = spark.range(1000).selectExpr("cast(id % 400 as string) AS uid", "'f' AS file", "0L AS block_start", "id AS seq")
    rows = write_scratch(rows, "keys")
    existing = write_scratch(spark.range(0, 100).selectExpr("cast(id as string) AS uid"), "existing")
    for found, n in ((keys.uids_taken(existing, rows), 300), (keys.duplicates(rows), 600), (keys.duplicates(rows, existing), 700)):
        planned = plan(found)
        assert len(found.collect()) == n
        for text in (planned, plan(found)):
            assert not re.search(r"BroadcastHashJoin \[(uid|seq)#", text)


def test_large_exclusion_moves_only_rows_that_may_match(spark):
    big = write_scratch(spark.range(4000).selectExpr("id AS k", "repeat('text ', 20) AS body"), "big")
    small = write_scratch(spark.range(0, 400, 10).selectExpr("id AS k"), "small")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = join_checked(big, small, "k", "left_anti", limit=0)
        assert joined.count() == 3960
        # The bits are as those of the written keys: next to no other row is marked.
        marked = joins._marked(big, small, "k").where("_hit")
        assert 40 <= marked.count() <= 60
        # No body passes an exchange but below the filter on the mark.
        text = plan(joined)
        assert "bitmap_construct_agg" in text and text.count("LeftAnti") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_anti_join_is_skipped(spark):
    big = spark.range(10).withColumnRenamed("id", "k")
    empty = write_scratch(big.where("k < 0"), "empty")
    assert join_checked(big, empty, "k", "left_anti") is big


def test_scratch_area_is_removed(spark):
    with scratch_area(spark):
        kept = write_scratch(spark.range(3), "kept")
        path = kept.inputFiles()[0].removeprefix("file://")
        assert kept.count() == 3
    from pathlib import Path

    assert not Path(path).exists() and not Path(path).parent.parent.exists()
