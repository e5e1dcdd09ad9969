"""Publishing runs: modes, watermark, retries, layout on disk."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sondelake.operators.control import ControlTable, advanced
from sondelake.plans.lake import Lake
from sondelake.plans.publish import NAMED_QUERIES, named_query, publish, published_rows
from sondelake.schemas import (
    CONTROL_SCHEMA,
    HEADER_SCHEMA,
    LEDGER_SCHEMA,
    LEVEL_SCHEMA,
    PUBLISHED_COLUMNS,
    seed_control,
)
from sondelake.sources.published import read_published, write_banded, write_run

JOB = "soundings"


def sounding(reltime, *heights):
    return (f"ZZA{reltime}", heights)


def load(lake, load_id, *soundings):
    """Put soundings into the tables of a lake as a load would, without text files."""
    first = (lake.headers.read().agg(F.max("header_id")).head()[0] or 0) + 1
    headers = [
        (first + i, "ZZA00012345", 1954, 3, 17, 6, 0, len(gphs), "", "own-src1", 1, 2, key, load_id)
        for i, (key, gphs) in enumerate(soundings)
    ]
    levels = [
        (3, 0, 1, 2, "", gph, "", 3, "", 4, 5, 6, 7, key, load_id)
        for key, gphs in soundings
        for gph in gphs
    ]
    lake.levels.write_load(lake.spark.createDataFrame(levels, LEVEL_SCHEMA).coalesce(1), load_id)
    lake.headers.write_load(lake.spark.createDataFrame(headers, HEADER_SCHEMA).coalesce(1), load_id)
    finish(lake, load_id)


def finish(lake, load_id):
    row = [(f"{load_id}.txt", 1, 1, 1)]
    lake.ledger.write_load(lake.spark.createDataFrame(row, LEDGER_SCHEMA).coalesce(1), load_id)


def heights(lake):
    rows = read_published(lake.spark, lake.published_path)
    return sorted((r.partition_gph, r.gph) for r in rows.select("partition_gph", "gph").collect())


def state(lake):
    row = lake.control.rows().head()
    return row.full_load, row.filter_col1_value


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    load(lake, "l1", sounding("0100", 250, 5000), sounding("0200", -9999, 9001))
    lake.control.replace(seed_control(spark, JOB))
    return lake


def test_full_then_delta(lake):
    assert publish(lake, JOB).mode == "full"
    assert heights(lake) == [(0, 9001), (1, -9999), (1, 250), (5, 5000)]
    assert state(lake) == ("N", "2")
    load(lake, "l2", sounding("0300", 1500))
    run = publish(lake, JOB)
    assert (run.mode, run.after_id, run.up_to_id) == ("delta", 2, 3)
    assert heights(lake) == [(0, 9001), (1, -9999), (1, 250), (2, 1500), (5, 5000)]
    assert state(lake) == ("N", "3")
    # Nothing new: rows and mark stay as they are.
    publish(lake, JOB)
    assert len(heights(lake)) == 5 and state(lake) == ("N", "3")
    assert read_published(lake.spark, lake.published_path).columns == [
        *PUBLISHED_COLUMNS, "partition_gph"
    ]


def test_inclusive_delta_repeats_the_last_header(lake):
    publish(lake, JOB)
    load(lake, "l2", sounding("0300", 1500))
    publish(lake, JOB, inclusive=True)
    assert heights(lake) == sorted(
        [(0, 9001), (1, -9999), (1, 250), (2, 1500), (5, 5000), (1, -9999), (0, 9001)]
    )


def test_delta_ids(lake):
    load(lake, "l2", sounding("0300", 1500), sounding("0400", 2500))
    assert {r.gph for r in published_rows(lake, 4, 3).collect()} == {2500}
    assert {r.gph for r in published_rows(lake, 4, 3, inclusive=True).collect()} == {1500, 2500}
    assert {r.gph for r in published_rows(lake, 3, 2).collect()} == {1500}


def test_failed_write_keeps_the_mark_and_retry_is_complete(lake, monkeypatch):
    import sondelake.plans.publish as plan

    publish(lake, JOB)
    load(lake, "l2", sounding("0300", 1500))

    def fail(*_):
        raise RuntimeError("disk is gone")

    with monkeypatch.context() as patch:
        patch.setattr(plan, "write_run", fail)
        with pytest.raises(RuntimeError):
            publish(lake, JOB)
    assert state(lake) == ("N", "2")
    assert [r.exception_message for r in lake.errors().collect()] == ["disk is gone"]
    # Rows written but mark not advanced; meanwhile more data arrives.
    with monkeypatch.context() as patch:
        patch.setattr(ControlTable, "advance", fail)
        with pytest.raises(RuntimeError):
            publish(lake, JOB)
    load(lake, "l3", sounding("0400", 2500))
    publish(lake, JOB)
    assert heights(lake) == [(0, 9001), (1, -9999), (1, 250), (2, 1500), (3, 2500), (5, 5000)]


def test_full_again_replaces_all_runs(lake):
    publish(lake, JOB)
    load(lake, "l2", sounding("0300", 1500))
    publish(lake, JOB)
    lake.control.replace(lake.control.rows().withColumn("full_load", F.lit("y")))
    publish(lake, JOB)
    assert len(heights(lake)) == 5


@pytest.mark.parametrize("flag", ["Y", None])
def test_skipped_job_does_nothing(lake, flag):
    lake.control.replace(lake.control.rows().withColumn("skip_execution", F.lit(flag).cast("string")))
    assert publish(lake, JOB) is None
    assert publish(lake, "another job") is None
    assert heights(lake) == []


def test_no_headers_is_no_run(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.control.replace(seed_control(spark, JOB))
    assert publish(lake, JOB) is None
    assert state(lake) == ("Y", None)


def test_missing_mark_is_a_full_load(lake):
    lake.control.replace(lake.control.rows().withColumn("full_load", F.lit("N")))
    assert publish(lake, JOB).mode == "full"


def test_unknown_range_column_fails_before_reading(lake):
    rows = lake.control.rows().withColumns({"full_load": F.lit("N"), "filter_col1_name": F.lit("GPH")})
    lake.control.replace(rows)
    with pytest.raises(ValueError, match="GPH"):
        publish(lake, JOB)


def test_padded_text(lake):
    publish(lake, JOB, padded=True)
    row = read_published(lake.spark, lake.published_path).head()
    assert (row.id, row.np_src, row.pflag) == ("ZZA00012345 ", "own-src1  ", "   ")


def test_only_the_named_row_advances(spark):
    rows = [(i, JOB, "N", "Y", None, "HEADER_ID", None, None, None) for i in (1, 2)]
    after = advanced(spark.createDataFrame(rows, CONTROL_SCHEMA), 2, 123).orderBy("id").collect()
    assert after[0].full_load == "Y" and after[0].filter_col1_value is None
    assert after[1].full_load == "N" and after[1].filter_col1_value == "123" and after[1].run_date
    assert after[0].run_date is None


def test_lowest_control_row_runs(spark, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))
    rows = [(i, JOB, "N", "Y", None, "HEADER_ID", str(i), None, None) for i in (5, 3, 4)]
    control.replace(spark.createDataFrame(rows, CONTROL_SCHEMA))
    assert control.current(JOB).id == 3
    assert control.current("other") is None


def test_named_queries(lake):
    assert set(NAMED_QUERIES) == {"control", "max_header", "full_load", "delta_load"}
    assert named_query(lake, "max_header").collect()[0].max_head == 2
    assert named_query(lake, "full_load", hi=1).count() == 2
    assert named_query(lake, "delta_load", hi=2, lo=1).count() == 2
    assert named_query(lake, "control", etl_name=JOB).count() == 1
    with pytest.raises(ValueError, match="unknown"):
        named_query(lake, "other")


def test_existing_target_is_an_error_by_default(spark, tmp_path):
    rows = spark.range(5).selectExpr("cast(id as int) gph", "cast(id % 2 as int) partition_gph")
    write_banded(rows, str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exists"):
        write_banded(rows, str(tmp_path / "out"))


def test_whole_file_lake_joins_on_uid_alone(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), whole_files=True)
    load(lake, "l1", sounding("0100", 250))
    # A second file whose header was refused: its levels belong to the first header.
    levels = [(3, 0, 1, 2, "", 700, "", 3, "", 4, 5, 6, 7, "ZZA0100", "l2")]
    lake.levels.write_load(spark.createDataFrame(levels, LEVEL_SCHEMA), "l2")
    # A load that did not reach the ledger comes again under another id.
    assert {r.gph for r in published_rows(lake, 1).collect()} == {250}
    finish(lake, "l2")
    assert {r.gph for r in published_rows(lake, 1).collect()} == {250, 700}


def test_mark_does_not_go_back(lake):
    publish(lake, JOB)
    lake.control.advance(lake.control.current(JOB).id, 900)
    publish(lake, JOB)
    assert state(lake) == ("N", "900")


def test_delta_prunes_level_folders_by_join(spark, lake):
    load(lake, "l2", sounding("0300", 1500))
    rows = published_rows(lake, 3, 2)
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
    assert [r.gph for r in rows.collect()] == [1500]


def test_failing_full_run_leaves_the_old_rows(spark, lake):
    publish(lake, JOB)
    before = heights(lake)
    rows = read_published(spark, lake.published_path)
    with pytest.raises(Exception, match="broken"):
        write_run(rows.withColumn("gph", F.raise_error(F.lit("broken")).cast("int")), lake.published_path, None)
    assert heights(lake) == before
    # Full runs switch folders; the last two are kept.
    for _ in range(3):
        lake.control.replace(lake.control.rows().withColumn("full_load", F.lit("Y")))
        publish(lake, JOB)
        assert heights(lake) == before
    from pathlib import Path

    assert len(list(Path(lake.published_path).glob("run-*"))) == 2


def test_lake_keeps_its_rules(spark, tmp_path):
    root = str(tmp_path / "lake")
    Lake(spark, root).check_rules(keep=True)
    Lake(spark, root).check_rules()
    with pytest.raises(ValueError, match="blocks"):
        published_rows(Lake(spark, root, whole_files=True), 1)
