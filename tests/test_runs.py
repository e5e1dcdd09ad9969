"""What runs leave for one another: ids published, header columns beside levels, uid summaries, the writer's place."""

from __future__ import annotations

import re
import threading

import pytest
from pyspark.sql import functions as F

from sondelake.operators.keys import loads_that_may_hold, uid_parts
from sondelake.plans.ingest import existing_headers, ingest, ingest_all
from sondelake.plans.lake import Lake
from sondelake.plans.publish import publish, published_rows
from sondelake.schemas import CONTROL_SCHEMA, PUBLISHED_COLUMNS
from sondelake.sources.published import (
    Conflict,
    Run,
    RunLog,
    current_folder,
    read_published,
    rebalanced,
    unpublished,
    write_banded,
    write_run,
)
from sondelake.sources.tables import LOAD_COLUMN, create_small, read_small
from tests.soundings import header, level, put, uid


def sounding(gph, **fields):
    return "\n".join([header(1, **fields), level(str(gph))]) + "\n"


def heights(lake):
    return sorted(r.gph for r in read_published(lake.spark, lake.published_path).select("gph").collect())


def two_jobs(lake):
    rows = [(i, job, "N", "Y", None, "HEADER_ID", None, None, None) for i, job in ((1, "a"), (2, "b"))]
    lake.control.replace(lake.spark.createDataFrame(rows, CONTROL_SCHEMA))


def set_mark(lake, job, mark):
    mine = F.col("etl_name") == job
    lake.control.replace(
        lake.control.rows().withColumn("filter_col1_value", F.when(mine, F.lit(str(mark))).otherwise(F.col("filter_col1_value")))
    )


@pytest.fixture
def filled(spark, tmp_path):
    """A lake with one load of two soundings, and a function that loads one more."""
    lake = Lake(spark, str(tmp_path / "lake"))
    put(tmp_path / "in", "f0.txt", sounding(100, month="01") + sounding(200, month="02"))
    ingest(lake, str(tmp_path / "in"), "l0")

    def more(k: int, **fields) -> None:
        put(tmp_path / "in", f"f{k}.txt", sounding(100 * (k + 2), **{"month": f"{k + 2:02}", **fields}))
        ingest(lake, str(tmp_path / "in"), f"l{k}")

    return lake, more


def test_two_jobs_publish_each_id_once(filled):
    lake, more = filled
    two_jobs(lake)
    publish(lake, "a")
    publish(lake, "b")  # full again: replaces the dataset
    assert heights(lake) == [100, 200]
    more(1)
    publish(lake, "a")
    more(2)
    publish(lake, "b")  # from 2 up to 4, of which 3 is there
    publish(lake, "a")
    assert heights(lake) == [100, 200, 300, 400]
    # A mark set back by hand repeats nothing, one set forward leaves ids out until it is set back.
    set_mark(lake, "a", 0)
    assert publish(lake, "a").after_id == 0
    assert heights(lake) == [100, 200, 300, 400]
    more(3)
    set_mark(lake, "a", 5)
    publish(lake, "a")
    assert heights(lake) == [100, 200, 300, 400]
    set_mark(lake, "a", 1)
    publish(lake, "a")
    assert heights(lake) == [100, 200, 300, 400, 500]


def test_gaps():
    runs = [Run("f", -1, 2), Run("g", 4, 6), Run("h", 6, 7), Run("old", -1, None)]
    assert unpublished(runs, 0, 9) == [(2, 4), (7, 9)]
    assert unpublished(runs, 5, 7) == []
    assert unpublished(runs, 3, 5) == [(3, 4)]
    assert unpublished([], 3, 5) == [(3, 5)]
    assert unpublished(runs, 8, 8) == []


def test_second_of_two_runs_sees_the_first(spark, tmp_path):
    root = str(tmp_path / "published")
    rows = spark.range(3).selectExpr("cast(id as int) gph", "cast(id as int) partition_gph")
    write_run(rows, root, 0, 3)
    with pytest.raises(Conflict):
        write_run(rows, root, 2, 5)
    write_run(rows, root, 3, 5)
    log = RunLog(spark, current_folder(spark, root))
    assert [(r.after, r.up_to) for r in log.runs()] == [(0, 3), (3, 5)]
    # Rows of the refused run are gone, and rows outside the log are not read.
    write_banded(rows, f"{root}/from_id=9-dead")
    assert read_published(spark, root).count() == 6
    assert len(list((tmp_path / "published").glob("from_id=*"))) == 3
    log.seal()
    with pytest.raises(Conflict, match="full"):
        write_run(rows, root, 5, 6)


def test_numbers_of_a_log_go_to_one_writer_each(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    threads = [threading.Thread(target=log.commit, args=(Run(f"r{k}", k, k + 1),)) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.folder for r in log.runs()) == sorted(f"r{k}" for k in range(12))
    assert create_small(spark, f"{tmp_path}/x", "one") and not create_small(spark, f"{tmp_path}/x", "two")
    assert read_small(spark, f"{tmp_path}/x") == "one"


def test_full_run_takes_over_what_a_delta_adds_meanwhile(spark, tmp_path):
    root = str(tmp_path / "published")

    def rows(*ids):
        return spark.createDataFrame([(i, 1) for i in ids], "gph int, partition_gph int")

    write_run(rows(1, 2), root, None, 2)
    write_run(rows(3, 4), root, 2, 4)  # a delta that a full run up to 3 has not seen
    write_run(rows(1, 2, 3), root, None, 3, False, lambda after, up_to: rows(*range(after + 1, up_to + 1)))
    assert sorted(r.gph for r in read_published(spark, root).collect()) == [1, 2, 3, 4]


def test_data_older_than_the_log(spark, tmp_path):
    root = str(tmp_path / "published")
    rows = spark.range(2).selectExpr("cast(id as int) gph", "1 partition_gph")
    write_banded(rows, f"{root}/from_id=0")
    assert read_published(spark, root).count() == 2
    write_run(rows, root, 2, 3)
    assert read_published(spark, root).count() == 4


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_full_publish_is_one_shuffle(filled):
    lake, more = filled
    more(1)
    rows = published_rows(lake, 3)
    plan = plan_of(rebalanced(rows.withColumn("partition_gph", F.lit(1))))
    assert len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", plan)) == 1
    headers, levels = lake.headers.read(), lake.levels.read()
    joined = headers.join(levels, [LOAD_COLUMN, "uid"]).select(*PUBLISHED_COLUMNS)
    assert sorted(rows.collect()) == sorted(joined.collect()) and rows.count() == 3
    assert set(lake.levels.read().columns) == {*lake.levels.schema.names, LOAD_COLUMN}


def test_loads_cut_by_the_range_or_without_header_columns_are_joined(spark, filled, tmp_path):
    lake, more = filled
    more(1)
    assert {r.gph for r in published_rows(lake, 3, 1).collect()} == {200, 300}
    assert {r.gph for r in published_rows(lake, 3, 2, inclusive=True).collect()} == {200, 300}
    assert {r.gph for r in published_rows(lake, 1).collect()} == {100}
    # A load that died before its range was written is joined as well.
    lake.ranges.drop_load("l1")
    assert {r.gph for r in published_rows(lake, 3).collect()} == {100, 200, 300}
    # Levels of a load without headers are not published.
    lake.headers.drop_load("l1")
    assert {r.gph for r in published_rows(lake, 3).collect()} == {100, 200}


def test_repeated_load_takes_its_range_back(filled, tmp_path, monkeypatch):
    """Between the levels and the headers of a second attempt, the first one's range does not count."""
    lake, _ = filled
    lake.ledger.drop_load("l0")
    monkeypatch.setattr(lake.headers, "write_load", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError, match="died"):
        ingest(lake, str(tmp_path / "in"), "l0")
    assert lake.ranges.read_load("l0").isEmpty()


def test_only_loads_that_can_hold_the_uids_are_read(spark, filled):
    lake, more = filled
    more(1, station="ZZA00099999")
    more(2, year="1955")
    new = spark.createDataFrame([(uid(month="02"),), (uid(year="1990"),)], "uid string")
    old = lake.uid_parts.read()
    loads = loads_that_may_hold(new, lake.headers.read(), old, LOAD_COLUMN)
    # l1 is another station; l2 lies within the years asked for, though no uid is equal.
    assert {r.load_id for r in loads.collect()} == {"l0", "l2"}
    only = spark.createDataFrame([(uid(month="02"),)], "uid string")
    rows = existing_headers(lake, only, "new")
    assert "dynamicpruning" in plan_of(rows)
    assert {r.load_id for r in rows.collect()} == {"l0"}
    lake.uid_parts.drop_load("l1")  # a load without a summary can hold anything
    loads = loads_that_may_hold(only, lake.headers.read(), lake.uid_parts.read(), LOAD_COLUMN)
    assert {r.load_id for r in loads.collect()} == {"l0", "l1"}
    assert uid_parts(new).count() == 1


def test_copies_across_loads_are_still_found(filled):
    lake, more = filled
    more(1)
    more(2, month="01")  # the uid of l0
    assert [r.reason for r in lake.quarantine.read().collect()] == ["duplicate_uid"]
    assert sorted(r.header_id for r in lake.headers.read().collect()) == [1, 2, 3]


def test_two_loads_at_once(spark, tmp_path):
    """One of two loads is refused, or comes after the other: ids and uids stay unique."""
    inboxes = []
    for k in range(2):
        for month in range(1, 4):
            inboxes.append(put(tmp_path / f"in{k}", f"{k}-{month}.txt", sounding(1, month=f"{month:02}")))
    root, refused = str(tmp_path / "lake"), []
    Lake(spark, root).check_rules(keep=True)

    def run(k):
        try:
            ingest(Lake(spark, root), str(tmp_path / f"in{k}"), f"l{k}")
        except RuntimeError as error:
            refused.append(str(error))

    threads = [threading.Thread(target=run, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    lake = Lake(spark, root)
    rows = lake.headers.read().collect()
    assert sorted(r.header_id for r in rows) == [1, 2, 3] and len({r.uid for r in rows}) == 3
    assert len(refused) == 1 and "running" in refused[0] and lake.errors().count() == 1
    assert lake.writer() is None


def test_place_of_a_dead_load(filled, tmp_path):
    lake, more = filled
    create_small(lake.spark, f"{tmp_path}/lake/writer", "l1")
    with pytest.raises(RuntimeError, match="l1"):
        more(2)
    more(1)  # the dead load takes its place again, and leaves it when it is done
    assert lake.writer() is None
    create_small(lake.spark, f"{tmp_path}/lake/writer", "gone")
    lake.release()
    more(2)
    assert lake.headers.read().count() == 4


def test_errors_before_a_run_are_logged(filled, monkeypatch):
    lake, _ = filled

    def fail(*_):
        raise RuntimeError("no control")

    monkeypatch.setattr(lake.control, "current", fail)
    with pytest.raises(RuntimeError):
        publish(lake, "a")
    with pytest.raises(ValueError, match="finished"):
        ingest(lake, "/nowhere/at/all", "l0")
    assert sorted(r.etl_name for r in lake.errors().collect()) == ["ingest", "publish"]


def test_large_inbox_in_slices(spark, tmp_path, monkeypatch):
    """Slices are loads of their own; a failed one is done again, finished ones are not."""
    for k in range(1, 8):
        inbox = put(tmp_path / "in", f"f{k}.txt", sounding(k, month=f"{k:02}"))
    lake = Lake(spark, str(tmp_path / "lake"))
    write = lake.levels.write_load

    def fail(rows, load_id):
        if load_id.endswith("1"):
            raise RuntimeError("lost")
        write(rows, load_id)

    with monkeypatch.context() as patch:
        patch.setattr(lake.levels, "write_load", fail)
        with pytest.raises(RuntimeError, match="lost"):
            ingest_all(lake, inbox, "big", max_files=3)
    assert lake.headers.read().count() == 3
    put(tmp_path / "in", "late.txt", sounding(9, month="09"))  # not in the manifest
    ledger = ingest_all(lake, inbox, "big", max_files=3).collect()
    assert sorted(r.load_id for r in ledger) == ["big-000000"] * 3 + ["big-000001"] * 3 + ["big-000002"]
    assert sorted(r.header_id for r in lake.headers.read().collect()) == [1, 2, 3, 4, 5, 6, 7]
    with pytest.raises(ValueError, match="finished"):
        ingest_all(lake, inbox, "big", max_files=3)
    assert ingest_all(lake, inbox, "more").count() == 1
    assert ingest_all(lake, inbox, "none") is None


def test_file_without_any_header_is_loaded_once(spark, tmp_path, monkeypatch):
    """Its one record is too long to be read, but the ledger has the file."""
    import sondelake.sources.blocks as blocks

    monkeypatch.setattr(blocks, "LONGEST_RECORD", 200)
    inbox = put(tmp_path / "in", "a.txt", f"{level()}\n" * 50)
    put(tmp_path / "in", "b.txt", sounding(5))
    put(tmp_path / "in", "c.txt", sounding(6, month="04") + f"{level()}\n" * 50)
    lake = Lake(spark, str(tmp_path / "lake"))
    assert {r.file[-5:]: (r.headers, r.levels) for r in ingest(lake, inbox, "l1").collect()} == {
        "a.txt": (0, 0), "b.txt": (1, 1), "c.txt": (1, 1)
    }
    assert ingest(lake, inbox, "l2") is None
    assert sorted(r.gph for r in lake.levels.read().collect()) == [5, 6]
