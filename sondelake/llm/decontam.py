"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of 13 words of the benchmark items. A block is two neighbouring words. A
table over block hashes says how far the search may jump, because no pattern that ends sooner
holds this block there; where it may not jump, the hash of the pattern's last words selects the
patterns to try, and the words themselves are compared. Many positions, one in each stretch of
each document, jump side by side as numpy arrays.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondelake.llm import members, words
from sondelake.operators.scratch import write_scratch

WIDTH = 13
#: Words of benchmark text whose patterns are searched at once, a long word counting as one for each
#: `WORD_BYTES`; more are searched in further passes.
PASS_WORDS = 500_000
WORD_BYTES = 32
#: Words of a document that one search position runs through.
STRETCH = 512

_JUMP_BITS = 20


def _word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = words.utf8(texts)
    data = words.LOWER[data]
    return data, *words.split_spans(data, offsets, words.ALPHANUMERIC[data])


class Matcher:
    """Wu-Manber tables for the patterns of one length in words."""

    def __init__(self, width: int, patterns: list[tuple[bytes, str]]):
        self.width = width
        items: dict[bytes, list[str]] = {}
        for spelled, item in patterns:
            items.setdefault(spelled, []).append(item)
        data, starts, ends, _ = _word_spans(pa.array(list(items), pa.binary()).cast(pa.string()))
        hashes = words.span_hashes(data, starts, ends).reshape(-1, width)
        self.block = min(2, width)
        self.farthest = width - self.block + 1
        self.jump = np.full(1 << _JUMP_BITS, self.farthest, dtype=np.int16)
        for end in range(self.block, width + 1):
            slots = self._slots(hashes[:, end - self.block : end].reshape(-1))[:: self.block]
            self.jump[slots] = np.minimum(self.jump[slots], width - end)
        # Buckets of patterns by the hash of their last words.
        self.tail = min(4, width)
        suffix = words.ngram_hashes(hashes.reshape(-1), self.tail)[width - self.tail :: width]
        self.suffixes = np.unique(suffix)
        self.buckets: dict[int, dict[bytes, list[str]]] = {}
        for key, (spelled, names) in zip(suffix.tolist(), items.items()):
            self.buckets.setdefault(key, {})[spelled] = names

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of the block that begins at each word (the last word's is unused if blocks are pairs)."""
        mixed = hashes if self.block == 1 else words.mix(hashes ^ np.roll(words.mix(hashes), -1))
        return (mixed >> np.uint64(64 - _JUMP_BITS)).astype(np.int64)

    def search(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows whose last words have a bucket, and the keys of those buckets."""
        sizes = np.diff(first)
        places = np.maximum(sizes - self.width + 1, 0)  # possible starts in each text
        stretches = -(-places // STRETCH)
        text = np.repeat(np.arange(len(sizes)), stretches)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        at = first[text] + nth * STRETCH
        stop = np.minimum(at + STRETCH, first[text] + places[text])
        jumps = self.jump[self._slots(hashes)] if len(hashes) else np.zeros(0, np.int16)
        found = []
        while len(at):
            step = jumps[at + self.width - self.block]
            here = at[step == 0]
            if len(here):
                found.append(here)
            at = at + np.maximum(step, 1)
            more = at < stop
            at, stop = at[more], stop[more]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        starts = np.concatenate(found)
        ends = starts + self.width
        suffix = words.span_hashes(hashes, ends - self.tail, ends)
        near = np.minimum(np.searchsorted(self.suffixes, suffix), len(self.suffixes) - 1)
        good = self.suffixes[near] == suffix
        return starts[good], suffix[good]


def matchers(items: list[tuple[str, str]]) -> list[Matcher]:
    """Matchers for (item id, text) pairs: one for the full width and one per length of shorter items."""
    by_width: dict[int, list[tuple[bytes, str]]] = {}
    for item, text in items:
        data, starts, ends, _ = _word_spans(pa.array([text], pa.string()))
        spelled = [data[a:b].tobytes() for a, b in zip(starts, ends)]
        width = min(WIDTH, len(spelled))
        for k in range(len(spelled) - width + 1 if width else 0):
            by_width.setdefault(width, []).append((b" ".join(spelled[k : k + width]), item))
    return [Matcher(width, patterns) for width, patterns in sorted(by_width.items())]


def find(searchers: list[Matcher], texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[set[str]]]:
    """Words, positions of words hit, and items found, of each text."""
    data, starts, ends, first = _word_spans(texts)
    hashes = words.span_hashes(data, starts, ends)
    hit = np.zeros(len(starts), dtype=bool)
    items: list[set[str]] = [set() for _ in range(len(first) - 1)]
    for matcher in searchers:
        width = matcher.width
        candidates, keys = matcher.search(hashes, first)
        of_text = np.searchsorted(first, candidates, side="right") - 1
        for at, text, key in zip(candidates.tolist(), of_text.tolist(), keys.tolist()):
            spelled = b" ".join([data[a:b].tobytes() for a, b in zip(starts[at : at + width], ends[at : at + width])])
            names = matcher.buckets[key].get(spelled)
            if names:
                hit[at : at + width] = True
                items[text].update(names)
    marks = [np.flatnonzero(hit[a:b]) for a, b in zip(first[:-1], first[1:])]
    return np.diff(first), marks, items


#: Columns that a pass adds to the documents, if no other is called so: words, hits, items.
_ADDED = ("decontam_n_words", "decontam_hits", "decontam_items")
_built: dict[str, list[Matcher]] = {}


def _pass(docs: DataFrame, items: list[tuple[str, str]], added: list[str]) -> DataFrame:
    """Add what one pass of patterns finds to what earlier passes found in the ``added`` columns."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    key = uuid.uuid4().hex
    own = [field for field in docs.schema.fields if field.name not in added]
    kinds = (T.LongType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType()))
    schema = T.StructType([*own, *map(T.StructField, added, kinds)])
    _, hits_of, items_of = added

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _built:
            _built.clear()  # a worker that is used again keeps the tables of one pass
            _built[key] = matchers(shared.value)
        for batch in words.text_chunks(batches):
            n_words, hits, found = find(_built[key], batch.column("text"))
            if hits_of in batch.schema.names:
                hits = [np.union1d(a, b).astype(np.int64) for a, b in zip(hits, batch.column(hits_of).to_pylist())]
                found = [a | set(b) for a, b in zip(found, batch.column(items_of).to_pylist())]
            columns = [
                *batch.columns[: len(own)],
                pa.array(n_words, pa.int64()),
                pa.array(hits, pa.list_(pa.int64())),
                pa.array([sorted(names) for names in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(rows, schema)


def _passes(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's items in lists of at most `PASS_WORDS` words (a longer item comes alone).

    A stated query set, read row by row: one list at a time is with the driver.
    """
    text = F.col("text")
    n_words = F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    size = F.greatest(n_words, F.ceil(F.octet_length(text) / WORD_BYTES))
    rows = benchmark.where("text is not null and item_id is not null")
    rows = rows.select(F.col("item_id").cast("string").alias("item"), "text", size.alias("n"))
    items: list[tuple[str, str]] = []
    held = 0
    for row in rows.toLocalIterator():
        if items and held + row.n > PASS_WORDS:
            yield items
            items, held = [], 0
        items.append((row.item, row.text))
        held += row.n
    yield items


def _searched(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, list[str]]:
    """Documents with their words, the positions of words hit, and the items found, and the names of
    these three columns."""
    added = [members.spare_name(docs.columns, name) for name in _ADDED]
    for k, items in enumerate(_passes(benchmark)):
        docs = _pass(write_scratch(docs, "decontam") if k else docs, items, added)
    return docs, added


def _contaminated(added: list[str]) -> Column:
    n_words, hits, _ = added
    return (F.size(hits) > 0) & (20 * F.size(hits) >= F.col(n_words))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Which words of each document lie inside a window of a benchmark item.

    Needs ``doc_id`` and ``text`` of the documents, ``item_id`` and ``text`` of the benchmark; other
    columns are not looked at. A null text has no words; an item without words has no window; an
    item of fewer than 13 words is one window; items with a null id or text are left out. Repeated
    rows and ids of documents each give their own row; items that repeat or share windows all
    count, an id once. Without documents the result is empty, without items nothing is hit.
    Nothing is shuffled; a benchmark of more than `PASS_WORDS` words takes further passes.
    """
    searched, added = _searched(docs.select("doc_id", "text"), benchmark)
    n_words, hits, items = added
    return searched.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        F.size(hits).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        _contaminated(added).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    searched, added = _searched(docs, benchmark)
    return searched.where(~_contaminated(added)).select(docs.columns)
