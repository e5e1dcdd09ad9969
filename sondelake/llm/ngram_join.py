"""N-gram Jaccard join: documents whose word shingles overlap by a share, and their components.

Shingles of a set are ordered rare first. Two sets that reach the threshold share a shingle among
the first few of each, so documents meet only on those *prefix* shingles. Pairs that meet pass a
length filter, a positional filter (what is left behind the meeting place must suffice) and a
suffix filter (counts per hash bin bound the symmetric difference); each pair left is verified
once on whole sets.

Within a group that meets on one shingle, everybody is first compared with one member, the hub.
Members that are linked this way need no comparison among themselves, as only components
count; the others are then compared with all that are not yet in their component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondelake.llm import members, words
from sondelake.llm.components import components
from sondelake.operators.scratch import write_scratch

#: The frequency sketch has a fixed size. Its counts only order shingles, so clashes cost
#: candidates but no result.
_SKETCH_BITS = 18
_SKETCH_PARTS = 64
#: Counts per hash bin, a byte each. Unrelated sets of n shingles differ by about 1.1 * sqrt(n * bins),
#: so this many bins tell them apart up to some 10 000 shingles; larger sets just pass.
_BINS = 256


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` make one shingle."""
    data, offsets = words.utf8(texts)
    data = words.LOWER[data]
    starts, ends, first = words.split_spans(data, offsets, words.NON_BLANK[data])
    hashes = words.span_hashes(data, starts, ends)
    grams = words.ngram_hashes(hashes, width)
    sets = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= width:
            sets.append(np.unique(grams[low : high - width + 1]))
        else:
            # The length is mixed in: a short text is no part of a longer one.
            whole = words.span_hashes(hashes, np.array([low]), np.array([high]))
            sets.append(words.mix(whole ^ np.uint64(high - low)) if high > low else whole[:0])
    return sets


def _signature(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    whole = np.array([0]), np.array([len(shingles)])
    return (
        int(words.span_hashes(shingles, *whole).view(np.int64)[0]),
        int(words.span_hashes(words.mix(shingles + np.uint64(1)), *whole).view(np.int64)[0]),
    )


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)


def _bins(shingles: np.ndarray) -> bytes:
    counts = np.bincount((shingles & np.uint64(_BINS - 1)).astype(np.int64), minlength=_BINS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


_SIGNED = "doc_id long, n long, h1 long, h2 long, bins binary, part int, counts binary"


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """Per document the size, signature and bin counts of its set; per task the frequency sketch."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in _SIGNED.split(", ")]
        sketch = np.zeros(1 << _SKETCH_BITS, dtype=np.int32)
        for batch in words.text_chunks(batches):
            sets = shingle_sets(batch.column("text"), width)
            together = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            sketch += np.bincount(_slots(together), minlength=len(sketch)).astype(np.int32)
            found = [(len(s), *_signature(s)) for s in sets]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)]
            columns.append(pa.array([_bins(s) for s in sets], pa.binary()))
            none = [pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, *none], names=names)
        if sketch.any():
            parts = sketch.reshape(_SKETCH_PARTS, -1)
            none = [pa.nulls(_SKETCH_PARTS, pa.int64())] * 4 + [pa.nulls(_SKETCH_PARTS, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array(range(_SKETCH_PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=names,
            )

    return write_scratch(docs.mapInArrow(rows, _SIGNED), "signed")


def _frequencies(signed: DataFrame) -> np.ndarray:
    """The sum of all sketches, about a megabyte. It is summed in two steps so that no task gets
    more than a share of them."""

    def total(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c, np.int32).astype(np.int64) for c in table.column("counts").to_pylist())
        most = np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32)
        return pa.table({"part": table.column("part")[:1].cast(pa.int32()), "counts": pa.array([most.tobytes()], pa.binary())})

    sketches = signed.where("part is not null").select("part", "counts")
    some = sketches.withColumn("share", F.pmod(F.xxhash64("counts"), F.lit(256)))
    some = some.groupBy("part", "share").applyInArrow(total, "part int, counts binary")
    rows = some.groupBy("part").applyInArrow(total, "part int, counts binary").collect()
    out = np.zeros((_SKETCH_PARTS, (1 << _SKETCH_BITS) // _SKETCH_PARTS), dtype=np.int32)
    for row in rows:
        out[row.part] = np.frombuffer(row.counts, np.int32)
    return out.reshape(-1)


def _prefixes(docs: DataFrame, reps: DataFrame, sketch: np.ndarray, width: int, percent: int) -> DataFrame:
    """``shingle, id, n, place`` of the prefixes of one document per distinct set."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.text_chunks(batches):
            first, prefixes = [], []
            for shingles in shingle_sets(batch.column("text"), width):
                n = len(shingles)
                order = np.lexsort((shingles, shared.value[_slots(shingles)]))
                length = n - (percent * n + 99) // 100 + 1 if n else 0
                prefixes.append(shingles[order[:length]].view(np.int64))
                first.append(_signature(shingles)[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(first, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["id", "h1", "prefix"],
            )

    found = docs.mapInArrow(rows, "id long, h1 long, prefix array<long>")
    own = reps.select("id", "h1", "n")
    stored = write_scratch(found.join(own, ["id", "h1"]).dropDuplicates(["id", "h1"]).select("id", "n", "prefix"), "prefixes")
    return stored.select("id", "n", F.posexplode("prefix").alias("place", "shingle"))


def _can_link(n_a: Column, place_a: Column, n_b: Column, place_b: Column, percent: int) -> Column:
    """Length filter, and the positional filter for sets that first meet at these places."""
    least = F.ceil(percent * (n_a + n_b) / F.lit(100 + percent))  # overlap that the threshold asks for
    length = (100 * n_a >= percent * n_b) & (100 * n_b >= percent * n_a)
    return length & (F.least(n_a - place_a, n_b - place_b) >= least)


def _suffix_filter(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Leave out pairs whose bin counts alone differ too much.

    The counts differ by no more than the sets do, and linked sets a, b differ in at most
    (100 - percent) / (100 + percent) of |a| + |b| shingles.
    """
    known = sizes.select("doc_id", "n", "bins")
    left = known.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("bins").alias("bins_a"))
    right = known.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("bins").alias("bins_b"))

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, _BINS).astype(np.int16)
                for c in ("bins_a", "bins_b")
            ]
            apart = np.abs(bins[0] - bins[1]).sum(axis=1, dtype=np.int64)
            sizes = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b")]
            good = (100 + percent) * apart <= (100 - percent) * (sizes[0] + sizes[1])
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return pairs.join(left, "a").join(right, "b").mapInArrow(near, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = members.bitmap(ids, "id")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.text_chunks(batches):
            batch = batch.filter(pa.array(members.is_set(wanted.value, batch.column("bit"))))
            found = [s.tobytes() for s in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["id", "shingles"])

    marked = docs.where("doc_id is not null").select("doc_id", "text", members.bit_of("doc_id").alias("bit"))
    found = marked.mapInArrow(sets, "id long, shingles binary").join(ids, "id", "left_semi")
    found = write_scratch(found.distinct(), "sets")

    def links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                one, two = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = found.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    right = found.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    return pairs.join(left, "b").join(right, "a").mapInArrow(links, "a long, b long")


def _links(docs: DataFrame, sizes: DataFrame, prefixes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between distinct sets: enough of them to connect all that are connected."""
    meet = prefixes.groupBy("shingle").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    # Stored, so that the join shuffles both sides and a hot shingle's rows can be split.
    meet = write_scratch(meet.select("shingle", "hub"), "meeting")
    groups = write_scratch(prefixes.join(meet, "shingle"), "groups")

    hubs = groups.where("id = hub").select("shingle", F.col("n").alias("hub_n"), F.col("place").alias("hub_place"))
    near = groups.where("id > hub").join(hubs, "shingle")
    near = near.where(_can_link(F.col("hub_n"), F.col("hub_place"), F.col("n"), F.col("place"), percent))
    to_hub = write_scratch(
        _suffix_filter(near.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), sizes, percent), "pairs"
    )
    links = write_scratch(_verified(to_hub, docs, width, percent), "hub-links")

    labels = components(links)
    known = groups.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    known = write_scratch(known, "labelled")
    mixed = known.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low < high").select("shingle")
    own = known.where("id = hub").select("shingle", F.col("component").alias("hub_component")).distinct()
    rest = write_scratch(known.join(mixed, "shingle", "left_semi").join(own, "shingle"), "mixed")
    # Of two members in different components one at least is outside the hub's.
    outside = rest.where("component <> hub_component and id <> hub").alias("p")
    everyone = rest.where("id <> hub").alias("q")
    apart = (F.col("p.component") != F.col("q.component")) & (
        (F.col("q.component") == F.col("q.hub_component")) | (F.col("p.id") < F.col("q.id"))
    )
    fits = _can_link(F.col("p.n"), F.col("p.place"), F.col("q.n"), F.col("q.place"), percent)
    crossing = outside.join(everyone, (F.col("p.shingle") == F.col("q.shingle")) & apart & fits)
    pairs = crossing.select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b")).distinct()
    pairs = pairs.join(to_hub, ["a", "b"], "left_anti")  # verified with a hub, in another group
    pairs = write_scratch(_suffix_filter(pairs, sizes, percent), "pairs")
    return links.union(_verified(pairs, docs, width, percent))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Set size and component of every document.

    Needs ``doc_id`` and ``text``; other columns are not looked at. Words are A-Z lower-cased and
    parted by white space; a set holds the distinct shingles of ``width`` words, or the whole text
    if it has fewer words. Two documents link when 100 * intersection >= ``percent`` * union; equal
    sets count as one document, an empty set links with nothing. Returns doc_id, n_shingles,
    component_id (the smallest id reachable). A null text is empty. A null id stays null, links
    with nothing, and its component is null. Rows with the same id are separate rows of equal or
    different sets, told apart by their text. An empty table gives an empty result. Shingles and
    sets count as equal when their 64-bit and 128-bit hashes are.

    No group is paired within itself unless its members are in different components after the
    comparison with its hub, and only sets of documents that are in a pair are shuffled.
    """
    docs = docs.select("doc_id", "text")
    signed = _signed(docs, width)
    sizes = signed.where("part is null").select("doc_id", "n", "h1", "h2", "bins")
    filled = sizes.where("n > 0 and doc_id is not null")
    reps = write_scratch(
        filled.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("id")), "distinct-sets"
    )
    prefixes = _prefixes(docs, reps, _frequencies(signed), width, percent)
    labels = components(_links(docs, filled, prefixes, width, percent))
    placed = reps.join(labels, "id", "left").select(
        F.col("h1").alias("of_h1"), F.col("h2").alias("of_h2"), F.coalesce("component", "id").alias("component")
    )
    same = (F.col("h1") == F.col("of_h1")) & (F.col("h2") == F.col("of_h2")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return sizes.join(placed, same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Rows that repeat an id stay together; rows without an id stay.
    """
    found = near_duplicates(docs, width, percent)
    gone = write_scratch(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    wanted = members.bitmap(gone, "doc_id")
    checked = members.passing(docs, wanted, True, "doc_id").join(gone, "doc_id", "left_anti").select(docs.columns)
    return members.passing(docs, wanted, False, "doc_id").union(checked)
