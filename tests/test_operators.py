"""Expressions and keys on small frames, against plain Python."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from sondelake.functions.bands import open_band, partition_band
from sondelake.functions.fixedwidth import block_uid, csv_line, decode
from sondelake.functions.layout import HEADER_LAYOUT, LEVEL_LAYOUT, Field, layout_for, load_layout
from sondelake.functions.text import datetime_text, field_text, staged_route
from sondelake.operators.decode import decode_headers
from sondelake.operators.extract import max_header_id
from sondelake.operators.keys import duplicates, files_with_conflicts, first_per_uid, serial_ids
from sondelake.operators.quality import header_reason, null_name, wide_name
from sondelake.schemas import HEADER_SCHEMA, LEVEL_SCHEMA
from sondelake.sources import jdbc
from sondelake.sources.staged_csv import (
    STAGED_HEADER_SCHEMA,
    STAGED_LEVEL_SCHEMA,
    read_staged_headers,
    read_staged_levels,
    write_staged,
)
from tests.soundings import header, level, uid


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "line string").select(*columns).head()


def test_bands(spark):
    given = [-9999, None, 0, 1000, 1001, 2000, 9000, 9001, 35000]
    rows = spark.createDataFrame([(g,) for g in given], "gph int").select(
        partition_band(F.col("gph")).alias("p"), open_band(F.col("gph")).alias("o")
    )
    assert [r.p for r in rows.collect()] == [1, 0, 1, 1, 2, 2, 9, 0, 0]
    assert [r.o for r in rows.collect()] == [None, None, 1, 1, 2, 2, 9, 10, 35]


def test_header_decode(spark):
    row = one(spark, header(6), *decode("line", HEADER_LAYOUT), block_uid("line", HEADER_LAYOUT).alias("uid"))
    assert tuple(row) == (
        "ZZA00012345", 1954, 3, 17, 6, 1125, 6, "", "own-src1", 123456, -7654321, uid()
    )


def test_level_decode(spark):
    row = one(spark, level("250", pflag="A"), *decode("line", LEVEL_LAYOUT))
    assert tuple(row) == (3, 0, -9999, -9999, "A", 250, "", -9999, "", -9999, -9999, 90, 20)


@pytest.mark.parametrize(
    "text, value",
    [("     ", None), ("  +7 ", 7), (" -12 ", -12), ("1.5  ", None), ("12x45", None),
     ("\t\x017\x02 ", 7), ("1 2  ", None)],
)
def test_integers(spark, text, value):
    assert one(spark, level(text), *decode("line", LEVEL_LAYOUT)).gph == value


def test_trim_removes_all_low_characters_and_nothing_else(spark):
    line = header(1, p_src="\t\x00a b\x1f", np_src=" x")
    row = one(spark, line, *decode("line", HEADER_LAYOUT))
    assert (row.p_src, row.np_src) == ("a b", " x")


def test_low_single_characters_are_blank(spark):
    for text, kept in ((" ", ""), ("\x07", ""), ("\t", ""), ("!", "!"), (" ", " ")):
        assert one(spark, level(pflag=text), *decode("line", LEVEL_LAYOUT)).pflag == kept


def test_csv_line(spark):
    row = one(spark, header(6), csv_line("line", HEADER_LAYOUT, "'u'").alias("csv"))
    assert row.csv == '"ZZA00012345",1954,03,17,06,1125,6,"","own-src1",123456,-7654321,"u"'


def test_header_reasons(spark):
    lines = {
        header(2): None,
        header(2)[:-1]: "bad_header",
        header(""): "bad_header",
        header("x"): "bad_header",
        header(2, lat="4x"): "malformed:lat",
        header(2, year=""): "null:year",
        header(2, lon=""): None,
    }
    rows = spark.createDataFrame([("f", 0, i, h, []) for i, h in enumerate(lines)],
                                 "file string, block_start long, seq long, header string, body array<string>")
    reasons = decode_headers(rows).withColumn("reason", header_reason()).orderBy("seq").collect()
    assert [r.reason for r in reasons] == list(lines.values())


def test_width_and_null_names(spark):
    row = spark.createDataFrame([("abc", None)], "a string, b string").select(
        wide_name({"a": 2, "b": 2}).alias("wide"), null_name(["a", "b"]).alias("null"),
        wide_name({"a": 3}).alias("fits"),
    ).head()
    assert (row.wide, row.null, row.fits) == ("a", "b", None)


def test_layout_spec(spark, tmp_path):
    rows = [
        {"column_name": "ID", "start_index": 2, "end_index": 12, "column_type": "Character", "column_order": 1},
        {"column_name": "TEMP", "start_index": "13", "end_index": "14", "column_type": "Int eger", "column_order": "2"},
    ]
    path = tmp_path / "spec.json"
    path.write_text(json.dumps({"record_format": rows}, indent=1))
    layout = load_layout(spark, str(path), "Head")
    assert layout.fields == (Field("ID", 2, 12, "Character", 1), Field("TEMP", 13, 14, "Int eger", 2))
    assert [f.is_text for f in layout.fields] == [True, False]
    assert layout.width == 71 and [f.name for f in layout.key_fields] == ["ID"]
    with pytest.raises(ValueError):
        layout_for("tail")


def test_schemas_follow_the_layouts():
    assert HEADER_SCHEMA.names[0] == "header_id" and HEADER_SCHEMA.names[-2:] == ["uid", "source_file"]
    assert LEVEL_SCHEMA.names[:13] == [f.name.lower() for f in LEVEL_LAYOUT.ordered]


def test_text_helpers(spark):
    df = spark.sql("SELECT timestamp'2024-03-05 07:08:09' AS ts, cast(null AS int) AS n, 'headers-a.b.CSV' AS f")
    row = df.select(
        datetime_text(F.col("ts")).alias("t"), field_text(df, "n").alias("null"),
        field_text(df, "missing").alias("missing"), staged_route(F.col("f")).alias("route"),
    ).head()
    assert tuple(row) == ("5/3/2024 7:8:9", None, None, "header")


def test_max_of_nothing_is_one_null_row(spark):
    assert [tuple(r) for r in max_header_id(spark.createDataFrame([], HEADER_SCHEMA)).collect()] == [(None,)]


def keys_frame(spark, rows):
    return spark.createDataFrame(rows, "uid string, file string, block_start long, seq long")


def test_first_per_uid_with_a_hot_uid(spark):
    rng = random.Random(1)
    rows = [
        ("hot" if rng.random() < 0.4 else f"u{rng.randint(0, 200)}", f"f{rng.randint(0, 5)}", rng.randint(0, 3), i)
        for i in range(3000)
    ]
    existing = spark.createDataFrame([(f"u{i}",) for i in range(20)], "uid string")
    best = {}
    for u, f, b, s in rows:
        best[u] = min(best.get(u, (f, b, s)), (f, b, s))
    expected = {v[2] for u, v in best.items() if not (u[0] == "u" and int(u[1:]) < 20)}
    frame = keys_frame(spark, rows)
    assert {r.seq for r in first_per_uid(frame, existing).collect()} == expected
    assert {r.seq for r in duplicates(frame, existing).collect()} == set(range(3000)) - expected


def loaded_in_turn(rows, existing, refused):
    files = {}
    for u, f in rows:
        files.setdefault(f, []).append(u)
    taken, out = set(existing), set(refused)
    for f in sorted(files):
        if f in out:
            continue
        if len(set(files[f])) < len(files[f]) or taken & set(files[f]):
            out.add(f)
        else:
            taken |= set(files[f])
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_file_conflicts_like_loading_in_turn(spark, seed):
    rng = random.Random(seed)
    rows = []
    for f in range(25):
        for _ in range(rng.randint(1, 6)):
            rows.append(("hot" if rng.random() < 0.1 else f"u{rng.randint(0, 90)}", f"f{f:02d}"))
    existing, refused = ["u1", "u2"], ["f03"]
    got = files_with_conflicts(
        spark.createDataFrame(rows, "uid string, file string"),
        spark.createDataFrame([(u,) for u in existing], "uid string"),
        spark.createDataFrame([(f,) for f in refused], "file string"),
    )
    assert {r.file for r in got.collect()} == loaded_in_turn(rows, existing, refused)


def test_serial_ids_are_dense_and_ordered_with_a_hot_file(spark):
    rng = random.Random(5)
    rows = [("f0" if rng.random() < 0.4 else f"f{rng.randint(1, 9)}", rng.randint(0, 5), i) for i in range(5000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, block_start long, seq long").repartition(7)
    got = serial_ids(df, ["file", "block_start", "seq"], base=40).orderBy("header_id").collect()
    assert [r.header_id for r in got] == list(range(41, 5041))
    assert [(r.file, r.block_start, r.seq) for r in got] == sorted(rows)


def test_staged_csv_from_plain_files(spark, tmp_path):
    (tmp_path / "headers-a.csv").write_text('"ZZA",1954,03,17,06,1125,6,"","own",123456,,"U1"\n')
    (tmp_path / "records-a.csv").write_text('3,0,-9999,,"",250,"",-9999,"B",-9999,-9999,90,20,"U1"\n')
    head = read_staged_headers(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in head] == [("ZZA", 1954, 3, 17, 6, 1125, 6, "", "own", 123456, None, "U1")]
    data = read_staged_levels(spark, str(tmp_path)).head()
    assert (data.press, data.pflag, data.tflag, data.wspd, data.uid) == (None, "", "B", 20, "U1")


def test_staged_csv_keeps_quotes_blanks_and_nulls(spark, tmp_path):
    rows = [(1, None, None, None, 'a"b', 5, "", None, "x,y", 1, 2, 3, 4, "U", "in/some.file.txt")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STAGED_LEVEL_SCHEMA) + ", file string"
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "staged")
    write_staged(df, STAGED_LEVEL_SCHEMA, path, "file")
    assert (tmp_path / "staged" / "source=some.file").is_dir()
    back = read_staged_levels(spark, path)
    assert [tuple(r) for r in back.collect()] == [rows[0][:-1]]
    assert STAGED_HEADER_SCHEMA.names[-1] == "uid"


def test_jdbc_texts():
    assert jdbc.subquery(jdbc.max_header_sql("public.h"), "m") == '(SELECT max("header_id") AS "max_head" FROM "public"."h") m'
    assert jdbc.control_sql("c", "it's") == (
        """SELECT * FROM "c" WHERE "etl_name" = 'it''s' AND "skip_execution" <> 'Y'"""
    )
    full = jdbc.published_sql("h", "l", 123, None, False)
    assert full.endswith('ON "h"."uid" = "l"."uid" WHERE "h"."header_id" <= 123')
    assert jdbc.published_sql("h", "l", 123, 100, False).endswith('<= 123 AND "h"."header_id" > 100')
    assert jdbc.published_sql("h", "l", 123, 100, True).endswith('<= 123 AND "h"."header_id" >= 100')
    assert jdbc.quoted('a.b"c') == '"a"."b""c"'
    with pytest.raises(ValueError):
        jdbc.published_sql("h", "l", "1; drop", None, False)


@pytest.mark.parametrize("settled", [0, 12, 200_000])
def test_files_in_conflict_walked_or_in_rounds(spark, settled):
    """Components of all sizes give the outcome of files that come one after the other."""
    draw = random.Random(settled)
    rows = [(f"a{k:04}", f"u{k + j}") for k in range(30) for j in (0, 1)]  # a chain
    rows += [(f"b{draw.randrange(40):02}", f"v{draw.randrange(60)}") for _ in range(90)]
    rows += [(f"c{k}", "w") for k in range(20)] + [(f"c{k}", f"w{k}") for k in range(20)]  # one hot uid
    keys = spark.createDataFrame(rows, "file string, uid string")
    taken, refused = set(), set()
    for file in sorted({f for f, _ in rows}):
        uids = [u for f, u in rows if f == file]
        if len(set(uids)) < len(uids) or taken & set(uids):
            refused.add(file)
        else:
            taken |= set(uids)
    assert {r.file for r in files_with_conflicts(keys, settled=settled).collect()} == refused


def test_long_chain_of_files_takes_few_jobs(spark):
    keys = spark.createDataFrame([(f"f{k:04}", f"u{k + j}") for k in range(1000) for j in (0, 1)], "file string, uid string")
    spark.sparkContext.setJobGroup("chain", "chain")
    refused = {r.file for r in files_with_conflicts(keys).collect()}
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chain")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert refused == {f"f{k:04}" for k in range(1, 1000, 2)}
    assert len(jobs) < 200  # rounds alone would take several for each of 500 rounds
