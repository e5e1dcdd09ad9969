"""Whole loads into fresh lakes: quarantine rules, keys, retries, incremental pickup."""

from __future__ import annotations

import pytest

from sondelake.plans.ingest import ingest, ingest_records, pending_files
from sondelake.plans.lake import Lake
from sondelake.plans.staged import load_staged
from sondelake.sources.blocks import read_records
from sondelake.streaming.pickup import pickup
from tests.soundings import header, level, put, uid


def times(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def good(reltime, n=2, gph="250"):
    return "\n".join([header(n, reltime=reltime)] + [level(gph)] * n) + "\n"


def test_clean_load(spark, tmp_path):
    inbox = put(tmp_path / "in", "b.txt", good("0100") + good("0200", 3))
    put(tmp_path / "in", "a.txt", good("0300", 1, "5000"))
    lake = Lake(spark, str(tmp_path / "lake"))
    ledger = ingest(lake, inbox, "l1")
    assert sorted(r.blocks for r in ledger.collect()) == [1, 2]
    rows = lake.headers.read().orderBy("header_id").collect()
    assert [(r.header_id, r.uid) for r in rows] == [
        (1, uid(reltime="0300")), (2, uid(reltime="0100")), (3, uid(reltime="0200"))
    ]
    assert rows[0].month == 3 and rows[0].p_src == "" and rows[0].lon == -7654321
    assert times(lake.levels.read(), "uid", "gph") == sorted(
        [(uid(reltime="0300"), 5000)] + [(uid(reltime="0100"), 250)] * 2
        + [(uid(reltime="0200"), 250)] * 3
    )
    assert lake.quarantine.read().count() == 0
    # All files are in the ledger, so there is nothing left to do.
    assert pending_files(lake, inbox).isEmpty()
    assert ingest(lake, inbox, "l2") is None


def test_empty_inbox_is_no_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lake = Lake(spark, str(tmp_path / "lake"))
    assert ingest(lake, str(tmp_path / "in"), "l1") is None


BAD = good("0100") + header(2, reltime="0150")[:-1] + "\n" + level() + "\n" + good("0200")


def test_bad_header_goes_to_quarantine(spark, tmp_path):
    inbox = put(tmp_path / "in", "a.txt", BAD)
    put(tmp_path / "in", "b.txt", good("0300") + header("", reltime="0400") + "\n" + level() + "\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest(lake, inbox, "l1")
    assert [r.uid[-4:] for r in lake.headers.read().orderBy("header_id").collect()] == [
        "0100", "0200", "0300"
    ]
    refused = lake.quarantine.read().orderBy("source_file").collect()
    assert [(r.scope, r.reason) for r in refused] == [("block", "bad_header")] * 2
    assert refused[0].raw == header(2, reltime="0150")[:-1] + "\n" + level()


def test_bad_header_ends_its_file(spark, tmp_path):
    inbox = put(tmp_path / "in", "a.txt", BAD)
    put(tmp_path / "in", "b.txt", good("0300"))
    lake = Lake(spark, str(tmp_path / "lake"), whole_files=True)
    ingest(lake, inbox, "l1")
    assert sorted(r.uid[-4:] for r in lake.headers.read().collect()) == ["0100", "0300"]
    assert lake.levels.read().count() == 4
    assert times(lake.quarantine.read(), "scope", "reason") == [("block", "after_bad_header")] * 2


def test_malformed_level_and_header(spark, tmp_path):
    text = "\n".join([header(3), level("12x45"), level(" "), level("7", pflag="A")]) + "\n"
    inbox = put(tmp_path / "in", "a.txt", text)
    put(tmp_path / "in", "b.txt", good("0200") + header(1, lat="4x", reltime="0300") + "\n" + level() + "\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest(lake, inbox, "l1")
    rows = lake.levels.read().where("source_file LIKE '%a.txt'")
    assert times(rows.na.fill(-1), "gph", "pflag") == [(-1, ""), (7, "A")]
    assert times(lake.quarantine.read(), "scope", "reason", "raw") == sorted([
        ("level", "malformed:gph", level("12x45")),
        # The raw text of a file's last block includes the line break that ends the file.
        ("block", "malformed:lat", header(1, lat="4x", reltime="0300") + "\n" + level() + "\n"),
    ])


def test_malformed_values_refuse_whole_files(spark, tmp_path):
    text = "\n".join([header(2), level("12x45"), level("1")]) + "\n"
    inbox = put(tmp_path / "in", "a.txt", text)
    put(tmp_path / "in", "b.txt", good("0200") + header(1, lat="4x", reltime="0300") + "\n" + level("9") + "\n")
    lake = Lake(spark, str(tmp_path / "lake"), whole_files=True)
    ingest(lake, inbox, "l1")
    # Header and level files succeed or fail on their own.
    assert [r.uid for r in lake.headers.read().collect()] == [uid()]
    assert times(lake.levels.read(), "gph") == [(9,), (250,), (250,)]


def test_null_key_column(spark, tmp_path):
    inbox = put(tmp_path / "in", "a.txt", header(1, year="") + "\n" + level() + "\n" + good("0100"))
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest(lake, inbox, "l1")
    assert lake.headers.read().count() == 1
    assert [r.reason for r in lake.quarantine.read().collect()] == ["null:year"]


def test_first_copy_of_a_uid_wins(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    inbox = put(tmp_path / "in", "a.txt", good("0100", gph="1") + good("0100", gph="2"))
    put(tmp_path / "in", "b.txt", good("0100", gph="3") + good("0200", gph="4"))
    ingest(lake, inbox, "l1")
    assert lake.headers.read().count() == 2
    assert sorted({r.gph for r in lake.levels.read().collect()}) == [1, 4]
    put(tmp_path / "in", "c.txt", good("0200", gph="5") + good("0300", gph="6"))
    ingest(lake, inbox, "l2")
    assert times(lake.headers.read(), "header_id", "load_id") == [(1, "l1"), (2, "l1"), (3, "l2")]
    assert sorted({r.gph for r in lake.levels.read().collect()}) == [1, 4, 6]
    assert [r.reason for r in lake.quarantine.read().collect()] == ["duplicate_uid"] * 3


def test_duplicate_refuses_the_header_file_but_not_its_levels(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), whole_files=True)
    inbox = put(tmp_path / "in", "a.txt", good("0100"))
    put(tmp_path / "in", "b.txt", good("0100") + good("0200"))
    put(tmp_path / "in", "c.txt", good("0200") + good("0300"))
    put(tmp_path / "in", "d.txt", good("0400") + good("0400"))
    ingest(lake, inbox, "l1")
    # b conflicts with a and claims nothing, so c is accepted; d conflicts with itself.
    assert times(lake.headers.read(), "uid") == [(uid(reltime=t),) for t in ("0100", "0200", "0300")]
    assert lake.levels.read().count() == 14


def test_load_can_be_repeated(spark, tmp_path):
    inbox = put(tmp_path / "in", "a.txt", good("0100") + good("0200") + good("0100"))
    lake = Lake(spark, str(tmp_path / "lake"))
    for _ in range(2):
        ingest_records(lake, read_records(spark, inbox), "l1")
    assert times(lake.headers.read(), "header_id") == [(1,), (2,)]
    assert lake.levels.read().count() == 4
    assert lake.quarantine.read().count() == 1


def test_pickup_reads_each_file_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    inbox = put(tmp_path / "in", "a.txt", good("0100") + header(3, reltime="0110") + "\n" + level() + "\n")
    put(tmp_path / "in" / "processed", "z.txt", good("0900"))
    checkpoint = str(tmp_path / "checkpoint")
    pickup(lake, inbox, checkpoint)
    assert (lake.headers.read().count(), lake.levels.read().count()) == (2, 2)
    put(tmp_path / "in", "b.txt", good("0200"))
    put(tmp_path / "in", "c.txt", good("0300"))
    pickup(lake, inbox, checkpoint, max_files_per_batch=1)
    assert times(lake.headers.read(), "header_id") == [(1,), (2,), (3,), (4,)]
    pickup(lake, inbox, checkpoint)
    assert (lake.headers.read().count(), lake.levels.read().count()) == (4, 6)
    assert lake.ledger.read().count() == 3


def test_failure_is_logged(spark, tmp_path, monkeypatch):
    inbox = put(tmp_path / "in", "a.txt", good("0100"))
    lake = Lake(spark, str(tmp_path / "lake"))

    def fail(*_):
        raise RuntimeError("it's full")

    monkeypatch.setattr(lake.levels, "write_load", fail)
    with pytest.raises(RuntimeError):
        ingest(lake, inbox, "l1")
    assert lake.headers.read().count() == 0
    assert times(lake.errors(), "etl_name", "exception_message") == [("ingest", "it's full")]


def test_finished_load_id_is_refused(spark, tmp_path):
    inbox = put(tmp_path / "in", "a.txt", good("0100"))
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest(lake, inbox, "day")
    put(tmp_path / "in", "b.txt", good("0200"))
    with pytest.raises(ValueError, match="finished"):
        ingest(lake, inbox, "day")
    ingest(lake, inbox, "day-2")
    assert times(lake.headers.read(), "uid", "load_id") == [(uid(reltime="0100"), "day"), (uid(reltime="0200"), "day-2")]


def test_any_file_name_and_only_direct_children(spark, tmp_path):
    names = ["a b.txt", "a[1].txt", "a%41.txt", "a+b.txt", "{x,y}.txt"]
    for k, name in enumerate(names):
        inbox = put(tmp_path / "in", name, good(f"0{k}00"))
    put(tmp_path / "in" / "k=1", "c.txt", good("1200"))
    put(tmp_path / "in" / "processed", "d.txt", good("1300"))
    lake = Lake(spark, str(tmp_path / "lake"))
    ingest(lake, inbox, "l1")
    assert sorted(r.uid[-4:] for r in lake.headers.read().collect()) == [f"0{k}00" for k in range(len(names))]
    assert ingest(lake, inbox, "l2") is None
    streamed = Lake(spark, str(tmp_path / "streamed"))
    pickup(streamed, inbox, str(tmp_path / "checkpoint"))
    assert streamed.headers.read().count() == len(names)


def test_checkpoints_do_not_share_load_ids(spark, tmp_path):
    one = put(tmp_path / "one", "a.txt", good("0100"))
    two = put(tmp_path / "two", "a.txt", good("0200"))
    lake = Lake(spark, str(tmp_path / "lake"))
    pickup(lake, one, str(tmp_path / "c1"))
    pickup(lake, two, str(tmp_path / "c2"))
    assert sorted(r.uid[-4:] for r in lake.headers.read().collect()) == ["0100", "0200"]
    assert lake.headers.read().select("load_id").distinct().count() == 2


def test_staged_files_of_one_folder(spark, tmp_path):
    rows = ["A1,1954,3,17,6,10,1,,src,4,5,u1", "A1,1954,3,17,6,10,1,,src,4,5,u1", "A2,1954,3,x,6,10,1,,src,4,5,u2"]
    folder = put(tmp_path / "in", "headers-a.CSV", "\n".join(rows) + "\n")
    put(tmp_path / "in", "records-a.csv", '3,0,1,2,"",250,"",3,"",4,5,6,7,u1\n')
    put(tmp_path / "in", "other.csv", "x\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    ledger = load_staged(lake, folder, folder, "s1")
    assert times(ledger, "blocks", "headers", "levels") == [(0, 0, 1), (3, 1, 0)]
    assert times(lake.headers.read(), "header_id", "uid", "p_src") == [(1, "u1", "")]
    assert times(lake.levels.read(), "uid", "gph", "pflag") == [("u1", 250, "")]
    assert times(lake.quarantine.read(), "scope", "reason") == [("header", "duplicate_uid"), ("header", "malformed")]
    with pytest.raises(ValueError, match="finished"):
        load_staged(lake, folder, folder, "s1")
