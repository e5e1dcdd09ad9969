"""Operators that compare documents with one another, and the pipeline, next to plain Python and SQL."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sondelake.llm import decontam, mixing, ngram_join, secret_scan, substring
from sondelake.llm.queries import QUERIES, prepare
from sondelake.llm.sql import ORACLES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, n_words long"


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    assert difference(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) is None


def corpus(seed: int = 1):
    """Copies, near copies, shared passages, short and odd texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = " ".join(draw.choices(vocabulary, k=70))
    base = draw.choices(vocabulary, k=120)
    rows = [(0, " ".join(base))]
    for k in range(1, 25):
        edited = list(base)
        for _ in range(draw.randint(0, 4)):
            edited[draw.randrange(len(edited))] = draw.choice(vocabulary)
        rows.append((k, " ".join(edited)))
    for k in range(25, 45):
        own = draw.choices(vocabulary, k=draw.randint(1, 60))
        rows.append((k, " ".join(own[:20]) + " " + passage + "  " + " ".join(own[20:])))
    rows += [(45, None), (46, ""), (47, "a B c"), (48, "A b c"), (49, "a b"), (50, "la " * 200), (51, "la " * 120), (None, rows[0][1]), (52, rows[3][1].upper())]
    return [(i, t, f"s{(i or 0) % 4}" if i != 45 else None, 1) for i, t in rows]


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, SCHEMA)


def plain_components(rows, width, percent):
    sets = {}
    for i, text, *_ in rows:
        tokens = BLANK.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[i] = {tuple(tokens[k : k + width]) for k in range(max(1, len(tokens) - width + 1))} if tokens else set()
    label = {i: i for i in sets}
    ids = [i for i in sets if i is not None and sets[i]]
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(s), label[i]) for i, s in sets.items()}


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_ngram_join(spark, width, percent):
    rows = corpus()
    found = ngram_join.near_duplicates(frame(spark, rows), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == plain_components(rows, width, percent)
    assert len(found) == len(rows)


def test_ngram_join_of_odd_tables(spark):
    assert ngram_join.near_duplicates(frame(spark, [])).collect() == []
    rows = [(1, "a b c d e f", "s", 1), (1, "a b c d e f", "s", 1), (2, None, "s", 1), (3, "A B C D E F", "s", 1)]
    found = sorted((r.doc_id, r.component_id) for r in ngram_join.near_duplicates(frame(spark, rows)).collect())
    assert found == [(1, 1), (1, 1), (2, 2), (3, 1)]


def plain_repeats(rows, width):
    tokens = [(i, BLANK.findall(t or "")) for i, t, *_ in rows]
    first = {}
    for i, w in tokens:
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k : k + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in tokens:
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [50, 12, 3])
def test_substring_dedup(spark, width):
    rows = corpus()
    rows.append((7, "another text under the same id " * 12, "s", 1))
    found = substring.remove_repeats(frame(spark, rows), width).collect()
    assert sorted(map(tuple, found), key=str) == plain_repeats(rows, width)


def test_substring_dedup_of_many_repeats(spark):
    """Rows that repeat an id and a text bring their pieces once, not once each."""
    shared = " ".join(f"s{k}" for k in range(90))
    rows = [(1, shared, "s", 1)] + [(2, f"{shared} own", "s", 1)] * 3000 + [(2, f"other {shared}", "s", 1)]
    found = substring.remove_repeats(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == plain_repeats(rows, 50)


def test_substring_dedup_of_nothing(spark):
    assert substring.remove_repeats(frame(spark, [])).collect() == []


def test_decontamination_of_short_items_in_passes(spark, monkeypatch):
    docs = frame(spark, [(1, "x The quick-brown fox y", "s", 1), (2, None, "s", 1), (3, "fox fox", "s", 1), (None, "quick brown", "s", 1), (3, "other", "s", 1)])
    items = [(10, "quick brown"), (9, "QUICK, brown!"), (7, "fox"), (8, ""), (None, "other"), (6, None), (5, "the quick brown fox y z")]
    bench = spark.createDataFrame([(i, t, "s") for i, t in items], "item_id long, text string, source string")
    for limit in (500_000, 1):
        monkeypatch.setattr(decontam, "PASS_WORDS", limit)
        rows = sorted(map(tuple, decontam.contamination(docs, bench).collect()), key=str)
        digest = {names: hashlib.sha256(names.encode()).hexdigest() for names in ("10,7,9", "", "7", "10,9")}
        assert rows == sorted(
            [
                (1, 6, 3, 3, digest["10,7,9"], True), (2, 0, 0, 0, digest[""], False), (3, 2, 2, 1, digest["7"], True),
                (3, 1, 0, 0, digest[""], False), (None, 2, 2, 2, digest["10,9"], True),
            ],
            key=str,
        )
    for extra in ("kept", "decontam_hits", "Filter_Bit"):
        named = docs.withColumnRenamed("n_words", extra)
        kept = decontam.without_contaminated(named, bench)
        assert kept.columns == named.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert decontam.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_stages_keep_columns_of_any_name(spark):
    rows = corpus()
    for extra in ("filter_bit", "Filter_Bit", "component_id"):
        docs = frame(spark, rows).withColumnRenamed("n_words", extra)
        kept = ngram_join.one_of_each(docs)
        label = plain_components(rows, 5, 80)
        assert kept.columns == docs.columns and {r[3] for r in kept.collect()} == {1}
        assert {r.doc_id for r in kept.collect()} == {i for i in label if i is None or label[i][1] == i}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_of_odd_tables(spark, stage):
    prepare(spark)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = [(1, None, None, None, None), (None, "no id", "en", "s", 5), (2, "", "en", None, 0), (3, "a b c", None, "s", 5), (3, "a b c", None, "s", 5), (4, "wort " * 50_000, "de", "s", 250_000)]
    docs = spark.createDataFrame(odd, documents.select("doc_id", "text", "lang", "source", "n_chars").schema)
    name, function = stage
    found = function(spark, docs, SF_DIR)
    assert name == "mixture" or found.schema.names == docs.columns
    gone = {"language": 2}.get(name, 0)
    assert len(found.collect()) == len(odd) - gone
    assert function(spark, docs.limit(0), SF_DIR).collect() == []


def test_language_stage_without_labels(spark):
    prepare(spark)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    texts = [(1, None), (2, ""), (3, "12 !!"), (4, "some words"), (4, "some words"), (None, "слово")]
    for lang in (None, "en"):  # labels only on texts without letters teach nothing either
        rows = [(i, t, lang if i in (2, 3) else None, "s", 1) for i, t in texts]
        kept = dict(corpus_pipeline.STAGES)["language"](spark, spark.createDataFrame(rows, documents.schema), SF_DIR)
        assert kept.columns == documents.columns
        assert sorted(str(r.text) for r in kept.collect()) == ["some words", "some words", "слово"]


def test_mixing_with_weights_of_the_caller(spark):
    rows = [(k, "a b", "s", k) for k in range(8)]
    weight = F.when(F.col("n_words") < 5, F.lit(1.0)).when(F.col("n_words") == 5, F.lit(0.0))
    found = mixing.mix(frame(spark, [*rows, (9, "a b c d", "t", 1)]), shares=(1, 2), most=3, weight=weight).collect()
    taken = {r.doc_id: r.taken for r in found}
    assert len(found) == 9 and taken[9] == 12 and sum(taken.values()) == 20
    assert all(taken[k] == 0 for k in (5, 6, 7) if sum(taken[j] for j in range(5)) < 10)


@pytest.mark.parametrize("weight", [1 / 21, 0.0, None])
def test_mixing_cuts_even_ranges(spark, weight, monkeypatch):
    write, seen, n = mixing.write_scratch, {}, 4000
    monkeypatch.setattr(mixing, "write_scratch", lambda df, name: seen.setdefault(name, write(df, name)))
    # One id for a quarter of the rows, and weights far below 1, not above 0 or null.
    rows = [(k if k % 4 else 0, "a b", "s", k) for k in range(n)]
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = mixing.mix(frame(spark, rows), weight=F.lit(weight).cast("double")).collect()
        ranges = seen["mix-ranges"].groupBy("source", "range").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == n and sum(r.taken for r in found) == 2 * n
    assert max(r["count"] for r in ranges) < 2 * n / 16


def test_mixing_meets_its_targets(spark):
    rows = corpus() + [(k, "a b c", "big", 1) for k in range(100, 140)] + [(100, "a b c", "big", 1)]
    found = mixing.mix(frame(spark, rows)).collect()
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(frame(spark, rows[::-1])).collect()))
    taken, target, sizes = defaultdict(int), {}, {}
    for r in found:
        taken[r.source] += r.taken
        target[r.source], sizes[r.source] = r.target, r.source_size
        assert 0 <= r.taken <= 3 * r.size
    assert len(found) == len(rows)
    assert abs(sum(target.values()) - sum(sizes.values())) < 0.01
    for source, words in taken.items():
        assert abs(words - target[source]) <= 1 and target[source] <= 3 * sizes[source]
    # Sources that are not full share by weight.
    order = sorted(target, key=lambda s: (s is None, s or ""))
    levels = {round(target[s] / (5, 2, 1)[k % 3], 3) for k, s in enumerate(order) if target[s] < 3 * sizes[s]}
    assert len(levels) == 1
    assert mixing.mix(frame(spark, [])).collect() == []


def test_pipeline_next_to_plain_python(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = [d for d in docs if d["text"] and any(map(str.isalpha, d["text"]))]
    label = plain_components([(d["doc_id"], d["text"]) for d in kept], 5, 80)
    kept = [d for d in kept if label[d["doc_id"]][1] == d["doc_id"]]

    def tokens(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))

    windows = {tuple(w[k : k + 13]) for w in map(tokens, items) for k in range(max(1, len(w) - 12)) if w}
    widths = {len(w) for w in windows}

    def clean(d):
        w = tokens(d["text"])
        hit = {k + j for n in widths for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for j in range(n)}
        return not (hit and 20 * len(hit) >= len(w))

    kept = [d for d in kept if clean(d)]
    model = secret_scan.MarkovRatio(secret_scan.labelled_samples())
    expected = {d["doc_id"]: len(BLANK.findall(secret_scan.masked(d["text"], secret_scan.spans(d["text"], model)))) for d in kept}
    prepare(spark)
    found = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id: r["size"] for r in found.collect()} == expected
    assert corpus_pipeline.ORACLE_SQL is None and [name for name, _ in corpus_pipeline.STAGES][-1] == "mixture"
