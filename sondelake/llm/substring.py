"""Substring dedup by anchored blocks and window hashes.

Every document is cut into blocks at places that its words alone decide: neighbouring windows whose
smallest n-gram hash, the *anchor*, is the same form one block. Equal windows thus lie in blocks
with equal anchors, wherever they stand, and the index of all blocks is a table keyed by anchor.
Where all blocks of an anchor are equal, a block that a smaller id holds is repeated as a whole.
Where they differ, each window of every different block is looked up among the windows of the blocks
with that anchor. Windows of `width` words found so, joined where they overlap, are the duplicate
spans. This stands in for greedy relative Lempel-Ziv factoring: no longest match is computed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondelake.llm import members, words
from sondelake.operators.scratch import write_scratch

WIDTH = 50
#: Words of the n-grams whose hashes choose the anchors.
ANCHOR_WORDS = 8


def _least_of(values: np.ndarray, span: int) -> np.ndarray:
    """Smallest of each ``span`` neighbours, by doubling."""
    done = 1
    while 2 * done <= span:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = span - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _parsed(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Bytes, word starts and ends, first words of texts, word hashes."""
    data, offsets = words.utf8(texts)
    starts, ends, first = words.split_spans(data, offsets, words.NON_BLANK[data])
    return data, starts, ends, first, words.span_hashes(data, starts, ends)


def blocks(texts: pa.Array, width: int) -> tuple[np.ndarray, ...]:
    """Text, first window, number of windows, anchor and content hash of each block."""
    *_, first, hashes = _parsed(texts)
    at = words.ngram_starts(first, width)
    if not len(at):
        return (np.zeros(0, np.int64),) * 5
    gram = min(ANCHOR_WORDS, width)
    anchors = _least_of(words.ngram_hashes(hashes, gram), width - gram + 1)[at]
    owner = words.owners(first)[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(at)))
    content = words.span_hashes(hashes, at[heads], at[heads] + counts + width - 1)
    return owner[heads], at[heads] - first[owner[heads]], counts, anchors[heads].view(np.int64), content.view(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows are known by id and text, as ids may repeat."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def _indexed(docs: DataFrame, width: int) -> DataFrame:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.text_chunks(batches):
            owner, *values = blocks(batch.column("text"), width)
            keys = [pc.take(batch.column(c), pa.array(owner, pa.int64())) for c in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays(
                [*keys, *(pa.array(v, pa.int64()) for v in values)],
                names=["doc_id", "text_key", "start", "n", "anchor", "block"],
            )

    schema = "doc_id long, text_key long, start long, n long, anchor long, block long"
    return docs.where("doc_id is not null").mapInArrow(rows, schema)


def _spread(first: np.ndarray, text: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the windows of pieces, and the offset of each in its piece."""
    offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(first[text] + start, n) + offset, offset


def _windows(docs: DataFrame, pieces: DataFrame, width: int) -> DataFrame:
    """``anchor, window, block, at, doc_id, top`` of all windows of the given blocks."""
    fields = ("anchor", "block", "start", "n", "top")
    per_doc = pieces.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(*fields)).alias("pieces"))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.text_chunks(batches):
            *_, first, hashes = _parsed(batch.column("text"))
            lists = batch.column("pieces")
            text = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            flat = pc.list_flatten(lists)
            value = {f: pc.struct_field(flat, f).to_numpy(zero_copy_only=False) for f in fields}
            at, offset = _spread(first, text, value["start"], value["n"])
            window = words.ngram_hashes(hashes, width)[at].view(np.int64)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            own = [np.repeat(v, value["n"]) for v in (value["anchor"], value["block"], ids[text], value["top"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (own[0], window, own[1], offset, own[2], own[3])],
                names=["anchor", "window", "block", "at", "doc_id", "top"],
            )

    schema = "anchor long, window long, block long, at long, doc_id long, top long"
    return _with(docs, per_doc).mapInArrow(rows, schema)


def _with(docs: DataFrame, per_doc: DataFrame) -> DataFrame:
    """Documents joined with their rows of ``per_doc``; others are left out before the shuffle."""
    per_doc = write_scratch(per_doc, "per-document")
    wanted = members.bitmap(per_doc, "doc_id", "text_key")
    return members.passing(docs, wanted, True, "doc_id", "text_key").join(per_doc, ["doc_id", "text_key"])


def _duplicates(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_key, start, n, offsets``: blocks with windows that a smaller id holds. Without
    offsets all ``n`` windows of the block are meant."""
    index = write_scratch(_indexed(docs, width), "blocks")
    shared = (
        index.groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), (F.min("block") != F.max("block")).alias("mixed"))
        .where("low < high")
        .drop("high")
    )
    held_again = write_scratch(index.join(write_scratch(shared, "anchors"), "anchor"), "shared-blocks")
    whole = held_again.where("not mixed and doc_id > low").select(
        "doc_id", "text_key", "start", "n", F.lit(None).cast("array<long>").alias("offsets")
    )
    mixed = held_again.where("mixed").drop("low", "mixed")
    # One document stands for all that hold a block: the smallest, which is what later ones ask for.
    held = mixed.groupBy("anchor", "block").agg(
        F.min(F.struct("doc_id", "text_key", "start", "n")).alias("one"), F.max("doc_id").alias("top")
    )
    windows = write_scratch(_windows(docs, held.select("anchor", "block", "one.*", "top"), width), "windows")
    lowest = windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("low"), F.max("top").alias("most"))
    # Stored, so that the join below shuffles both sides and a hot window's rows can be split.
    lowest = write_scratch(lowest.where("low < most").drop("most"), "lowest")
    found = windows.join(lowest, ["anchor", "window"]).where("low < top")
    cuts = found.groupBy("anchor", "block").agg(F.collect_list(F.struct("at", "low")).alias("cuts"))
    part = mixed.join(cuts, ["anchor", "block"]).select(
        "doc_id",
        "text_key",
        "start",
        "n",
        F.expr("transform(filter(cuts, c -> c.low < doc_id), c -> c.at)").alias("offsets"),
    )
    return whole.union(part.where("size(offsets) > 0"))


def _digests(docs: DataFrame, width: int) -> DataFrame:
    """Counts and hash of what is kept, of documents with or without ``pieces``."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.text_chunks(batches):
            data, starts, ends, first, _ = _parsed(batch.column("text"))
            gone = np.zeros(len(starts), dtype=bool)
            if "pieces" in batch.schema.names:
                lists = batch.column("pieces")
                text = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                flat = pc.list_flatten(lists)
                start, n = (pc.struct_field(flat, f).to_numpy(zero_copy_only=False) for f in ("start", "n"))
                offsets = pc.struct_field(flat, "offsets")
                sizes = pc.list_value_length(offsets).to_numpy(zero_copy_only=False)
                full = np.isnan(sizes) if sizes.dtype.kind == "f" else np.zeros(len(sizes), dtype=bool)
                at = [_spread(first, text[full], start[full], n[full])[0]]
                sizes = np.where(full, 0, sizes).astype(np.int64)
                at.append(np.repeat(first[text] + start, sizes) + pc.list_flatten(offsets).to_numpy(zero_copy_only=False))
                gone = words.covered(len(starts), np.unique(np.concatenate(at)).astype(np.int64), width)
            kept = ~gone
            lengths = np.where(kept, ends - starts + 1, 0)
            stops = np.concatenate([[0], np.cumsum(lengths)])
            source = np.arange(stops[-1]) + np.repeat(starts - stops[:-1], lengths)
            joined = np.append(data, np.uint8(32))[source]
            joined[stops[1:][kept] - 1] = 32
            spans = zip(stops[first[:-1]].tolist(), stops[first[1:]].tolist())
            hashes = [hashlib.sha256(joined[a : max(a, b - 1)].tobytes()).hexdigest() for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(words.sums_by_text(gone, first), pa.int64()),
                    pa.array(hashes, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return docs.mapInArrow(rows, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Words of each document, how many of them lie in windows of ``width`` words that also start in a
    document with a smaller id, and the hash of the others, joined by one blank.

    Needs ``doc_id`` and ``text``; other columns are not looked at. Windows are judged on the
    input, not on what is left. A null text has no words; texts shorter than a window keep all.
    Rows with a null id keep everything and count as no one's original. Rows that repeat an
    id are no originals of each other, and each is a row of the result. An empty table gives an
    empty result. Windows are compared by two 64-bit hashes, of anchor and content.

    About one row per 20 words is shuffled for the index, and whole texts only of documents
    that have something to check or to remove. Groups are reduced by map-side minima, so that a block or window
    in very many documents meets in no single task.
    """
    docs = _keyed(docs)
    found = _duplicates(docs, width)
    per_doc = write_scratch(
        # A set: rows that repeat an id and a text bring the same pieces.
        found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "n", "offsets")).alias("pieces")),
        "per-document",
    )
    wanted = members.bitmap(per_doc, "doc_id", "text_key")
    touched = members.passing(docs, wanted, True, "doc_id", "text_key").join(per_doc, ["doc_id", "text_key"], "left")
    return _digests(touched, width).union(_digests(members.passing(docs, wanted, False, "doc_id", "text_key"), width))
