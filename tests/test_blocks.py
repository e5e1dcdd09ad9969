"""Block scan: golden cases, split boundaries, and comparison with a line-by-line model."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from sondelake.operators.decode import decode_levels, level_lines
from sondelake.sources.blocks import inbox_files, read_blocks
from tests.soundings import header, level, put


def model(text):
    """Header lines and, per header, its announced lines - one line at a time."""
    lines = re.split(r"\r\n|\r|\n", text)
    if lines and lines[-1] == "":
        lines.pop()
    blocks = []
    for line in lines:
        if line.startswith("#"):
            blocks.append((line, []))
        elif blocks:
            blocks[-1][1].append(line)
    found = []
    for head, body in blocks:
        count = head[32:36].strip()
        n = int(count) if len(head) == 71 and re.fullmatch(r"[+-]?\d+", count) else 0
        taken = body[:n] if 0 < n <= len(body) else []
        found.append((head, [x for x in taken if len(x) == 52]))
    return found


def scan(spark, folder):
    blocks = read_blocks(spark, folder)
    levels = (
        decode_levels(level_lines(blocks), keep=("seq", "pos", "line"))
        .groupBy("seq")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    )
    rows = (
        blocks.join(levels, "seq", "left").orderBy("file", "block_start", "seq").collect()
    )
    return [(r.header, [x.line for x in r.lines or []]) for r in rows]


H2, H3, L = header(2), header(3), level()
CASES = {
    "exact": f"{H2}\n{L}\n{L}\n",
    "short": f"{H3}\n{L}\n{L}\n{H2}\n{L}\n{L}\n",
    "long": f"{header(1)}\n{level('1')}\n{level('2')}\n{level('3')}\n",
    "zero": f"{header(0)}\n{L}\n",
    "wrong_length": f"{H2}\n{L}\n{L[:-1]}\n",
    "blank_line": f"{H2}\n{level('1')}\n\n{level('2')}\n",
    "preamble": f"{L}\n{H2}\n{L}\n{L}\n{H2}\n{L}\n{L}\n",
    "preamble_of_header_width": f"{'x' * 70}\n{H2}\n{L}\n{L}\n",
    "preamble_blank": f"\n{H2}\n{L}\n{L}\n",
    "bad_header": f"{H2}\n{L}\n{L}\n{H2[:-1]}\n{L}\n{H2}\n{L}\n{L}\n",
    "blank_count": f"{header('')}\n{L}\n{H2}\n{L}\n{L}\n",
    "crlf": f"{H2}\r\n{L}\r\n{L}\r\n{H3}\r\n{L}\r\n{L}\r\n",
    "short_last": f"{H2}\n{L}\n{L}\n{H3}\n{L}\n{L}\n",
    "short_last_crlf": f"{H3}\r\n{L}\r\n{L}\r\n",
    "blank_closes_inner": f"{H2}\n{L}\n\n{H2}\n{L}\n{L}\n",
    "blank_closes_last": f"{H2}\n{L}\n{L}\n{H2}\n{L}\n\n",
    "blank_closes_crlf": f"{H2}\r\n{L}\r\n\r\n{H2}\r\n{L}\r\n\r\n",
    "no_final_newline": f"{H2}\n{L}\n{L}",
    "no_final_newline_short": f"{H3}\n{L}\n{L}",
    "final_cr": f"{H2}\r{L}\r{L}\r{H3}\r{L}\r{L}\r",
    "cr_only_header_inside": f"{H2}\n{L}\n{L}\r{H2}\n{L}\n{L}\n",
    "double_mark_first": f"#{H2[:-1]}\n{L}\n{L}\n{H2}\n{L}\n{L}\n",
    "double_mark_later": f"{H2}\n{L}\n{L}\n#{H2[:-1]}\n{L}\n{L}\n{H2}\n{L}\n{L}\n",
    "double_mark_after_preamble": f"{L}\n#{H2[:-1]}\n{L}\n{L}\n",
    "bare_mark": f"{H2}\n{L}\n{L}\n#\n{L}\n{H2}\n{L}\n{L}\n",
    "no_header": f"{L}\n{L}\n",
    "header_only": H2,
    "two_headers": f"{H2}\n{H2}\n",
}


@pytest.mark.parametrize("split", [None, 200])
def test_golden_cases(spark, tmp_path, split):
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for name, text in CASES.items():
            put(tmp_path, f"{name}.txt", text)
        expected = [b for name in sorted(CASES) for b in model(CASES[name])]
        assert scan(spark, str(tmp_path)) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_random_files_cut_anywhere(spark, tmp_path):
    rng = random.Random(3)
    texts = {}
    for i in range(6):
        eol = "\r\n" if i % 3 == 0 else "\n"
        parts = [level()] * rng.randint(0, 2)
        for _ in range(rng.randint(1, 30)):
            n = rng.randint(0, 4)
            parts.append(header(n, reltime=f"{rng.randint(0, 9999):04d}"))
            parts += [rng.choice([level(str(rng.randint(0, 9999))), "", "short"])
                      for _ in range(max(0, n + rng.randint(-1, 1)))]
        texts[f"f{i:02d}.txt"] = eol.join(parts) + (eol if rng.random() < 0.7 else "")
    for name, text in texts.items():
        put(tmp_path, name, text)
    expected = [b for name in sorted(texts) for b in model(texts[name])]
    for split in (151, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            assert scan(spark, str(tmp_path)) == expected
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_inbox_is_flat_and_case_sensitive(spark, tmp_path):
    text = f"{H2}\n{L}\n{L}\n"
    put(tmp_path, "a.txt", text)
    put(tmp_path, "b.TXT", text)
    put(tmp_path, "c.csv", text)
    put(tmp_path / "processed", "d.txt", text)
    names = [r.file.rsplit("/", 1)[1] for r in inbox_files(spark, str(tmp_path)).collect()]
    assert names == ["a.txt"]
    assert len(scan(spark, str(tmp_path))) == 1


def test_edge_fixes_beyond_the_broadcast_limit(spark, tmp_path, monkeypatch):
    from sondelake.operators import joins

    monkeypatch.setattr(joins.is_empty_or_small, "__defaults__", (0,))
    monkeypatch.setitem(joins.join_checked.__kwdefaults__, "limit", 0)
    for name, text in CASES.items():
        put(tmp_path, f"{name}.txt", text)
    expected = [b for name in sorted(CASES) for b in model(CASES[name])]
    assert scan(spark, str(tmp_path)) == expected


@pytest.mark.parametrize("split", [300, 1 << 27])
def test_very_long_records_are_scanned_by_line(spark, tmp_path, monkeypatch, split):
    """With a small bound, files whose blocks go on for long give the model's levels."""
    import sondelake.sources.blocks as blocks

    monkeypatch.setattr(blocks, "LONGEST_RECORD", 400)
    draw = random.Random(split)
    texts = {
        "headless": "\n".join(level(str(k)) for k in range(60)) + "\n",
        "one": f"{H2}\n" + "\n".join(level(str(k)) for k in range(80)) + "\n",
        "junk_between": f"{level()}\n" * 30 + f"{H3}\n{level('1')}\n{level('2')}\n{level('3')}\n" + "junk\n" * 300 + f"{H2}\n{level('4')}\n\n{L}",
        "short_tail": f"{H2}\n" + f"{L}\n" * 20 + f"{H3}\n{L}\n{L}\n",
        "cr": f"{H2}\r\n" + f"{L}\r\n" * 20 + f"{H2}\r{level('7')}\r{level('8')}\r",
        "small": f"{H2}\n{level('5')}\n{level('6')}\n",
    }
    for k in range(6):
        parts = [draw.choice([H2, H3, header(40), header(9)[:-1], L, level("3")[:-1], "", "#"]) for _ in range(60)]
        texts[f"mixed{k}"] = "\n".join(parts) + "\n"
    for name, text in texts.items():
        put(tmp_path / name, "a.txt", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        found = {name: scan(spark, str(tmp_path / name)) for name in ("headless", "one", "junk_between", "cr")}
        put(tmp_path / "all", "none.txt", "")
        for name, text in texts.items():
            put(tmp_path / "all", f"{name}.txt", text)
        together = scan(spark, str(tmp_path / "all"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {name: model(texts[name]) for name in found}
    # Blocks of both kinds of files keep numbers of their own.
    assert together == [block for name in sorted(texts) for block in model(texts[name])]
