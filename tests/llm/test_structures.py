"""Prefix trie, packing and centroids next to plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondelake.llm import centroids, packing, prefix_trie
from sondelake.llm.queries import QUERIES, VOCABULARY, prepare

SF_DIR = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, node string, n_convs string"


def conversations(seed: int, n: int = 260, most: int = 9):
    """Few different turns, so that conversations branch at all depths; copies, gaps and odd rows."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-250, 400), n):
        for t in range(draw.choice([0, 1, 2, 3, 5, most])):
            rows.append((c, t * 2, draw.choice(["user", "a"]), draw.choice(["x", "yy", "é😀"]), "n", "7"))
    rows += [(1000 + k, t, "user", "same", None, None) for k in range(120) for t in range(4)]  # one hot conversation
    rows += [(5000, t, "user", f"{t % 3}", None, None) for t in range(300)]  # a long one, and its copy up to a point
    rows += [(5001, t, "user", f"{t % 3}" if t < 200 else "end", None, None) for t in range(260)]
    rows += [(6000, None, None, None, None, None), (6000, 1, "", "", None, None), (None, 1, "user", "x", None, None)]
    rows += [(6001, 1, "user", "x", None, None)] * 2  # repeated rows are turns of their own
    draw.shuffle(rows)
    return rows


def towards_zero(c: int) -> int:
    return c - int(math.fmod(c, 100))


def plain_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()[:32]
            turns[c].append(((t is not None, t or 0, name), (role, text)))
    original = {c: [turn for _, turn in sorted(found, key=lambda f: f[0])] for c, found in turns.items()}
    whole = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(original.get(towards_zero(c), [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in sorted(whole.items()):
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, found in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(found) - 1) * len(node[-1][1]) if node else 0
    return Counter(
        (min(found), len(node), min(members[node[:-1]]) if node else None, len(found), children[node], leaves[node],
         saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, found in members.items()
    )


def trie_rows(frame):
    return Counter(map(tuple, frame.collect()))


@pytest.mark.parametrize("width, segment, parts", [(256, 4 << 20, 1), (2, 300, 7), (7, 2000, 3)])
def test_trie(spark, width, segment, parts):
    """Blocks and segments of any size give the same nodes."""
    prepare(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        rows = conversations(width)
        assert trie_rows(prefix_trie.trie(spark.createDataFrame(rows, TURNS), width, segment)) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_odd_tables(spark):
    prepare(spark)
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(empty).collect() == []
    for rows in (
        [(None, 1, "user", "x", None, None)],
        [(101, 1, "user", "x", None, None)],  # h is above 0: no turn is left, the root alone
        [(7, None, None, "long " * 100_000, None, None), (7, 3, "user", None, None, None)],
    ):
        assert trie_rows(prefix_trie.trie(spark.createDataFrame(rows, TURNS))) == (plain_trie(rows) if rows[0][0] else Counter())


def test_merges_branch():
    """Three rows: two share two turns, all share one."""
    paths = prefix_trie.merge_forest(np.array([3, 2, 4]), np.array([-1, 2, 1]), np.array([9, 4, 6]))
    assert sorted(map(tuple, paths.tolist())) == [
        (0, 1, 3, 3, 0, 9),
        (0, 2, 2, 2, 1, 4),
        (0, 3, 0, 1, 2, 4),
        (2, 3, 2, 4, 0, 6),
    ]


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("tokenizers")
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def plain_pieces(library, texts, limit, end_id=1):
    out = Counter()
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        for piece, start in enumerate(range(0, len(ids), limit)):
            some = ids[start : start + limit]
            out[doc_id, piece, start, len(some), zlib.crc32(np.array(some, "<u4").tobytes())] += 1
    return out


def best_fit_decreasing(lengths, limit):
    spaces: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [s for s in spaces if s >= n]
        if fits:
            spaces.remove(min(fits))
        spaces.append((min(fits) if fits else limit) - n)
    return len(spaces)


def assert_packed(rows, limit):
    """Sequences are gapless, start at 0 and hold no more than ``limit``; returns how many there are."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= limit
    return len(by_sequence)


TEXTS = [(1, None), (1, None), (2, ""), (None, "null id"), (3, "a b c"), (3, "a b c"), (4, "x" * 20_000), (5, "ünï " * 9000)]
TEXTS += [(10 + k, "word " * (k % 40)) for k in range(300)] + [(6, "don't <|endoftext|> İ ﬁ 中文  \x85 Σ")]


@pytest.mark.parametrize("limit", [4096, 50, 8])
def test_packing(spark, vocabulary, library, limit):
    prepare(spark)
    docs = spark.createDataFrame([(i, t, 5, "s") for i, t in TEXTS], "doc_id long, text string, length int, ids string")
    rows = packing.pack(docs.repartition(5), vocabulary, limit).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_pieces(library, TEXTS, limit)
    n = assert_packed(rows, limit)
    lengths = [r.length for r in rows]
    assert -(-sum(lengths) // limit) <= n <= 1.02 * best_fit_decreasing(lengths, limit) + 1


def test_packing_of_the_table(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op12_packing"](spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_pieces(library, docs, 4096)
    lengths = [r.length for r in rows]
    assert assert_packed(rows, 4096) <= 1.02 * best_fit_decreasing(lengths, 4096) + 1


def test_packed_sequences(spark, vocabulary, library):
    """The ids of each sequence give the documents back."""
    texts = [(i, t) for i, t in TEXTS if i != 4]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = Counter()
    for r in packing.sequences(docs, vocabulary, 5000 * 9).collect():
        for doc_id, start, stop in zip(r.doc_ids, r.offsets, [*r.offsets[1:], len(r.ids)]):
            found[doc_id, tuple(r.ids[start:stop])] += 1
    assert found == Counter((i, (*library.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in texts)


def test_packing_of_nothing(spark, vocabulary):
    prepare(spark)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), vocabulary).collect() == []


def test_plan_of_any_histogram():
    draw = np.random.default_rng(5)
    for k in range(40):
        limit = int(draw.choice([1, 8, 100, 4096]))
        histogram = np.bincount(draw.integers(1, limit + 1, int(draw.integers(0, 400))), minlength=limit + 1)
        if k % 2:
            histogram[draw.integers(1, limit + 1)] += 10**int(draw.integers(0, 4))  # one hot length
        plan = packing.plan(histogram, limit)
        lengths = np.repeat(np.arange(limit + 1), histogram)
        numbers = np.concatenate([np.arange(n) for n in histogram])
        sequence, offset = plan.places(lengths, numbers)
        order = np.lexsort((offset, sequence))
        sequence, offset, lengths = sequence[order], offset[order], lengths[order]
        new = np.append(True, sequence[1:] != sequence[:-1]) if len(sequence) else np.zeros(0, bool)
        assert (offset[new] == 0).all() and (offset + lengths <= limit).all()
        assert (offset[1:] == (offset + lengths)[:-1])[~new[1:]].all()
        assert len(np.unique(sequence)) == plan.n_sequences


def test_least_squares_without_negatives():
    """No step along any pattern that is allowed makes the fit better."""
    draw = np.random.default_rng(2)
    for _ in range(20):
        a, b = draw.integers(0, 3, (6, 15)).astype(float), draw.random(6) * 10
        x = packing.non_negative_least_squares(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and (slope < 1e-6).all() and abs(slope[x > 0]).max(initial=0) < 1e-6


def test_tokens_of_odd_texts(vocabulary, library):
    draw = random.Random(4)
    own = packing.TokenIds(open(vocabulary, encoding="utf-8").read())
    pool = [*"abz AZ'09.,!<|>\t\n\r\x0b\x0c\x1c\x1f\x00 ", "é", "É", "ß", "İ", "ı", "Σ", "́", " ", "中", "ﬁ", "×", "ª", "µ",
            "'s", "'RE", "<|endoftext|>", "😀", "٣", "²", "\u0085", " ", "…", "€", "Ÿ"]
    for _ in range(3000):
        text = "".join(draw.choices(pool, k=draw.randint(0, 14)))
        assert np.frombuffer(b"".join(own.stream(text.encode())), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    long = "some wordsé, more " * 200_000  # cut into stretches
    assert np.frombuffer(b"".join(own.stream(long.encode())), "<u4").tolist() == library.encode(long, add_special_tokens=False).ids


def plain_clusters(vectors, k, rounds):
    kept = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in vectors
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centers = [v for _, v in named[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, v), (_, n) in zip(kept, assigned()):
            groups[n].append(v)
        for n, found in groups.items():
            centers[n] = [sum(column) // len(found) for column in zip(*found)]
    near = assigned()
    inertia = Counter()
    for q, n in near:
        inertia[n] += q
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return Counter((i, n, q, inertia[n], sum(inertia.values()), names[n]) for (i, _), (q, n) in zip(kept, near))


VECTORS = "vec_id long, embedding array<float>, label int, cluster string, distance string"


def test_centroids(spark):
    prepare(spark)
    draw = random.Random(1)
    rows = [(i, [draw.choice([-1.5, 0.0, 0.25, 0.3]) for _ in range(64)]) for i in range(90)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # one hot vector, ties everywhere
    rows += [(5, rows[5][1]), (None, rows[6][1]), (907, None), (908, []), (909, [1.0] * 63), (910, [1.0] * 63 + [None])]
    rows += [(911, [1.0] * 63 + [float("nan")]), (912, [float("inf")] * 64), (913, [1.0] * 65)]
    frame = spark.createDataFrame([(*r, 1, "c", "d") for r in rows], VECTORS).repartition(4)
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for k, rounds in ((8, 3), (40, 2), (500, 1)):
        found = Counter(map(tuple, centroids.cluster(frame, k, rounds).collect()))
        assert found == plain_clusters(rows, k, rounds)
    assert centroids.cluster(frame.limit(0)).collect() == []
    assert centroids.cluster(frame.where("vec_id > 900")).collect() == []


def test_large_components_are_held(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64), (2, [-1e30] * 64)], "vec_id long, embedding array<double>")
    rows = centroids.cluster(frame, k=1, rounds=0).collect()
    assert sorted(r.distance for r in rows)[0] == 0 and sorted(r.distance for r in rows)[1] == 64 * (2**25 - 1) ** 2


def test_search_equals_whole_distances():
    draw = np.random.default_rng(3)
    centers = draw.integers(-300, 300, (40, 64))
    centers[9] = centers[4]
    near = centers[draw.integers(0, 40, 700)] + draw.integers(-9, 10, (700, 64))
    for vectors in (near, draw.integers(-300, 300, (700, 64))):
        numbers, distances = centroids.nearest(centroids.coefficients(vectors), centroids.coefficients(centers))
        whole = ((vectors[:, None] - centers[None]) ** 2).sum(axis=2)
        assert (numbers == whole.argmin(axis=1)).all() and (distances == whole.min(axis=1)).all()
