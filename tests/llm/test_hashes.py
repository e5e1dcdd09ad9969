"""Words and rows of words that polynomial hashes modulo a power of two cannot tell apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from sondelake.llm import ngram_join, repetition, substring, words
from sondelake.llm.queries import VOCABULARY, prepare
from tests.llm.test_groups import plain_repeats

SIZE = 1 << 11


def pattern(one: str, other: str) -> list[str]:
    """The Thue-Morse row of two things."""
    return [other if bin(k).count("1") % 2 else one for k in range(SIZE)]


WORD, COMPLEMENT = "".join(pattern("a", "b")), "".join(pattern("b", "a"))
ROW, COMPLEMENT_ROW = " ".join(pattern("left", "right")), " ".join(pattern("right", "left"))


def documents(spark, texts):
    prepare(spark)
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_lines(spark):
    rows = repetition.repetition_rules(documents(spark, [f"{WORD}\n{COMPLEMENT}", f"{WORD}\n{WORD}", f"{ROW}\n{COMPLEMENT_ROW}"])).collect()
    assert {r.doc_id: r.n_dup_lines for r in rows} == {0: 0, 1: 1, 2: 0}


def test_sets(spark):
    found = ngram_join.near_duplicates(documents(spark, [WORD, COMPLEMENT, WORD]), width=4, percent=85).collect()
    assert {r.doc_id: r.component_id for r in found} == {0: 0, 1: 1, 2: 0}


def test_signatures_differ():
    one, two = (list(ngram_join.shingle_sets(pa.array([t]), 4))[0] for t in (WORD, COMPLEMENT))
    assert ngram_join._signature(one) != ngram_join._signature(two)


def test_windows(spark):
    texts = [ROW + " end", COMPLEMENT_ROW + " other end", WORD + " x" * 60, COMPLEMENT + " x" * 60]
    rows = substring.remove_repeats(documents(spark, texts)).collect()
    assert sorted(map(tuple, rows), key=str) == plain_repeats(list(enumerate(texts)), 50)


def test_tokens(spark):
    pytest.importorskip("tokenizers")
    import public_tokenizers
    from tokenizers import Tokenizer

    from sondelake.llm import token_counts

    path = public_tokenizers.path(VOCABULARY)
    library = Tokenizer.from_file(path)
    rows = token_counts.token_counts(documents(spark, [WORD, COMPLEMENT, f"{COMPLEMENT} {WORD}"]), path).collect()
    for r, text in zip(sorted(rows, key=lambda r: r.doc_id), [WORD, COMPLEMENT, f"{COMPLEMENT} {WORD}"]):
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)


def test_stretches(monkeypatch):
    """Spans longer than a stretch hash like themselves elsewhere, and differ where they differ."""
    draw = np.random.default_rng(1)
    values = draw.integers(0, 250, 5000).astype(np.uint8)
    values[3000:4500] = values[200:1700]
    starts = np.array([0, 200, 200, 3000, 3000])
    ends = np.array([5, 1700, 1701, 4500, 4501])
    whole = words.span_hashes(values, starts, ends)
    monkeypatch.setattr(words, "_STRETCH", 64)
    monkeypatch.setattr(words, "_tables", [])
    assert (words.span_hashes(values, starts, ends) == whole).all()
    assert whole[1] == whole[3] and len(set(whole.tolist())) == 4
    mixed = draw.permutation(5)
    assert (words.span_hashes(values, starts[mixed], ends[mixed]) == whole[mixed]).all()
