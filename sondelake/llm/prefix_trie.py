"""Conversation prefix trie from sorted neighbours.

Rebuilt conversations, as rows of turn digests, are sorted; neighbours share a longest common prefix
(LCP). Taking these LCP edges in descending depth, union-find joins neighbouring components: each merge
makes a branching node whose members are the joined rows. Nodes along unbranched paths follow from
their lower end.

Each partition of the sorted rows (in segments of bounded size) is a forest of its own. Nodes that lie
wholly inside are final. The others are on the path of a segment's first or last row: these forests
are contracted to those two paths, and merged across boundaries by sums over equal nodes, less what
both sides of a boundary have counted. So no node's members are ever gathered.

A conversation of many turns is cut into blocks; block k is a row of its own, sorted below the fingerprint of
the turns before it, and what its trie sums up is added to the rows of the blocks above.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondelake.operators.joins import join_checked
from sondelake.operators.scratch import write_scratch

#: Conversations that share their first turns with the one at the multiple of this number.
FAMILY = 100
#: Most turns taken from there, plus one.
HEADS = 6
#: Turns of a block.
BLOCK = 256
#: Bytes of digests in a segment.
SEGMENT_BYTES = 4 << 20
_DIGEST = 16

# Kinds of rows of the pass over the sorted blocks.
_NODE, _PART, _ENDS, _EDGE = range(4)
_PASS = (
    "kind int, node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, part int, segment long, ids binary, last boolean, "
    "block long, prefix string, turns binary, sizes array<long>, ends boolean, real boolean"
)
_FIELDS = [field.split(" ")[0] for field in _PASS.split(", ")]
_TYPES = {
    "kind": pa.int32(), "part": pa.int32(), "node": pa.binary(), "parent": pa.binary(), "ids": pa.binary(),
    "turns": pa.binary(), "ends_sha256": pa.string(), "prefix": pa.string(), "last": pa.bool_(),
    "ends": pa.bool_(), "real": pa.bool_(), "sizes": pa.list_(pa.int64()),
}


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, digest, size`` of every turn, positions from 0 in order of turn.

    Rows are dealt into even ranges of (conv_id, turn, digest), so a conversation may hold any share of
    them. Positions are counted within ranges; a conversation that goes on from one range to the next
    gets an offset from one row per range.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps (role, text) apart from other ways to cut the same characters.
    content = F.concat_ws(":", F.octet_length(role).cast("string"), role, text)
    slim = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(content, 256)), 1, _DIGEST).alias("digest"),
        F.length(text).cast("long").alias("size"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            position = np.arange(len(ids)) - np.repeat(new, np.diff(np.append(new, len(ids))))
            if last == ids[0]:
                head = new[1] if len(new) > 1 else len(ids)
                position[:head] += seen
            last, seen = ids[-1], int(position[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), pa.array(position, pa.int64()), batch.column("digest"),
                    batch.column("size"), pa.array(np.full(len(ids), part), pa.int32()),
                ],
                names=["conv_id", "position", "digest", "size", "part"],
            )

    schema = "conv_id long, position long, digest binary, size long, part int"
    stored = write_scratch(dealt.mapInArrow(counted, schema), "turns")
    ends = stored.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    split = ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("conv_id"))
    split = write_scratch(split.groupBy("conv_id").count().where("count > 1").select("conv_id"), "split")
    counts = join_checked(stored.select("conv_id", "part"), split, "conv_id", "left_semi").groupBy("conv_id", "part").count()
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "part", F.sum("count").over(before).alias("before")).where("before > 0")
    # At most one row per range.
    placed = stored.join(F.broadcast(offsets), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("position") + F.coalesce("before", F.lit(0))).alias("position"), "digest", "size")


def _taken(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, position, digest, size`` of rebuilt conversations; one without turns has a row
    whose position is null."""
    turns = write_scratch(turns, "numbered")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    entry = F.struct("position", "digest", "size")
    heads = write_scratch(
        turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("position") < HEADS - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(entry)).alias("heads")),
        "heads",
    )  # at most five turns each
    known = turns.withColumns({"base": base, "taken": _taken(F.col("conv_id"))})
    counts = heads.select("base", F.size("heads").cast("long").alias("n_heads"))
    own = known.where("position >= taken").join(counts, "base", "left")
    n_heads = F.least("taken", F.coalesce("n_heads", F.lit(0)))
    own = own.select("conv_id", (F.col("position") - F.col("taken") + n_heads).alias("position"), "digest", "size")
    everyone = known.where("position = 0").select("conv_id", "base", "taken").join(heads, "base", "left")
    first = F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), F.lit(1), F.col("taken").cast("int"))
    given = everyone.select("conv_id", F.explode_outer(first).alias("t"))
    return own.unionByName(given.select("conv_id", "t.position", "t.digest", "t.size"))


def blocks(turns: DataFrame, width: int) -> DataFrame:
    """``conv_id, block, prefix, turns, sizes, more, top`` of rebuilt conversations.

    ``turns`` are the joined digests of up to ``width`` turns, ``prefix`` is a fingerprint of all turns
    before (sums of 60 bits each of the hashes of the numbered blocks, four of them), ``more`` tells
    that another block follows, ``top`` is the smallest conversation with the turns before.
    """
    place = F.coalesce(F.floor(F.col("position") / width), F.lit(0)).cast("long")
    entry = F.when(F.col("position").isNotNull(), F.struct("position", "digest", "size"))
    lists = turns.groupBy("conv_id", place.alias("block")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    found = lists.select(
        "conv_id",
        "block",
        F.unhex(F.array_join(F.transform("entries", lambda e: F.hex(e.digest)), "")).alias("turns"),
        F.col("entries.size").alias("sizes"),
    )
    found = write_scratch(found, "blocks")
    if found.where("block > 0").isEmpty():
        none = {"prefix": F.lit(""), "more": F.lit(False), "top": F.lit(None).cast("long")}
        return found.withColumns(none).select("conv_id", "block", "prefix", "turns", "sizes", "more", "top")
    content = F.sha2(F.concat_ws(":", F.col("block").cast("string"), F.hex("turns")), 256)
    parts = [F.conv(F.substring(content, start, 15), 16, 10).cast("decimal(20,0)") for start in (1, 16, 31, 46)]
    order = Window.partitionBy("conv_id").orderBy("block")

    def fingerprint(last: int) -> Column:
        rows = order.rowsBetween(Window.unboundedPreceding, last)
        return F.concat_ws(",", *(F.coalesce(F.sum(p).over(rows).cast("string"), F.lit("")) for p in parts))

    more = F.lead("block").over(order).isNotNull()
    named = found.select("*", fingerprint(-1).alias("prefix"), fingerprint(0).alias("through"), more.alias("more"))
    named = write_scratch(named, "prefixed")
    # Conversations that end with a block are members of the node there too.
    tops = named.where(F.size("sizes") == width).groupBy((F.col("block") + 1).alias("block"), F.col("through").alias("prefix"))
    tops = tops.agg(F.min("conv_id").alias("top"), F.max("more").alias("wanted")).where("wanted").drop("wanted")
    wide = named.join(tops, ["block", "prefix"], "left")
    return write_scratch(wide.select("conv_id", "block", "prefix", "turns", "sizes", "more", "top"), "blocks")


def _common(codes: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number of equal turns at the beginning of each row and the one before it; 0 for the first."""
    shorter = np.minimum(lengths[1:], lengths[:-1])
    out = np.zeros(len(lengths), dtype=np.int64)
    if shorter.sum():
        pair = np.repeat(np.arange(len(shorter)), shorter)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(shorter) - shorter, shorter)
        differ = np.flatnonzero(codes[first[pair] + at] != codes[first[pair + 1] + at])
        out[1:] = shorter
        where, begin = np.unique(pair[differ], return_index=True)
        out[where + 1] = at[differ[begin]]
    return out


def merge_forest(depth: np.ndarray, lcp: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Paths of the forest over rows of these depths, whose neighbours share ``lcp`` turns (-1: none).

    Edges are taken in descending depth and their components united. Returns one row per path of
    nodes with the same members: first row, end of rows, top depth, bottom depth, children of the
    bottom node, smallest id. Root paths reach up to depth 0.
    """
    n = len(depth)
    parent, low, high, least = list(range(n)), list(range(n)), list(range(1, n + 1)), ids.tolist()
    bottom, children = depth.tolist(), [0] * n
    paths: list[tuple[int, ...]] = []

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def lifted(k: int, to: int) -> int:
        """Close the path below depth ``to``; what the component adds to the children of the node there."""
        if bottom[k] == to:
            return children[k]
        paths.append((low[k], high[k], to + 1, bottom[k], children[k], least[k]))
        return 1

    edges = np.flatnonzero(lcp >= 0)
    for edge in edges[np.argsort(-lcp[edges], kind="stable")].tolist():
        left, right, to = find(edge - 1), find(edge), int(lcp[edge])
        children[left] = lifted(left, to) + lifted(right, to)
        bottom[left], high[left], parent[right] = to, high[right], left
        least[left] = min(least[left], least[right])
    for k in range(n):
        if parent[k] == k:
            paths.append((low[k], high[k], 0, bottom[k], children[k], least[k]))
    return np.array(paths, dtype=np.int64).reshape(-1, 6)


def _node_key(block: int, prefix: str, turns: bytes) -> bytes:
    return hashlib.sha256(f"{block}:{prefix}:".encode() + turns).digest()[:_DIGEST]


def _keys_along(block: int, prefix: str, turns: bytes, most: int | None = None) -> list[bytes]:
    """Keys of the nodes on the path of a row, from the block's root to depth ``most`` or the end."""
    most = len(turns) // _DIGEST if most is None else most
    return [_node_key(block, prefix, turns[: _DIGEST * d]) for d in range(most + 1)]


def _shared(one: dict, two: dict) -> int:
    """Turns that the last row of a segment and the first of the next have in common; -1 in other tries."""
    if (one["block"], one["prefix"]) != (two["block"], two["prefix"]):
        return -1
    a, b = one["turns"], two["turns"]
    n = min(len(a), len(b)) // _DIGEST
    return next((d for d in range(n) if a[_DIGEST * d : _DIGEST * (d + 1)] != b[_DIGEST * d : _DIGEST * (d + 1)]), n)


def _twice_counted(one: dict, two: dict, width: int) -> list[dict]:
    """What both sides of a boundary have counted, per node that lies on both, to be taken off."""
    shared = _shared(one, two)
    if shared < 0:
        return []
    keys = _keys_along(one["block"], one["prefix"], one["turns"], shared)
    below = np.cumsum([0, *one["sizes"][:shared]][::-1])[::-1]  # sizes of the shared path from each depth on
    again = int(one["ends"] and shared == len(one["turns"]) // _DIGEST)
    return [
        {
            "kind": _PART,
            "node": key,
            "depth": one["block"] * width + d,
            "n_convs": 0,
            "n_children": -int(d < shared),
            "n_leaves": -again,
            "saved_tokens": int(below[d]),
        }
        for d, key in enumerate(keys)
    ]


def _batch(size: int, columns: dict) -> pa.RecordBatch:
    """Rows of the pass; columns that are not given are null."""
    arrays = [
        pa.array(columns[f], _TYPES.get(f, pa.int64())) if f in columns else pa.nulls(size, _TYPES.get(f, pa.int64()))
        for f in _FIELDS
    ]
    return pa.RecordBatch.from_arrays(arrays, names=_FIELDS)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return _batch(len(rows), {f: [row.get(f) for row in rows] for f in _FIELDS})


def _hash_of(ids: np.ndarray) -> str:
    return hashlib.sha256(_joined(ids)).hexdigest()


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


_NO_ENDS = hashlib.sha256(b"").hexdigest()


class _Segment:
    """Neighbouring sorted blocks and the nodes of their forest, as arrays."""

    def __init__(self, table: pa.Table, width: int):
        column = {name: table.column(name).combine_chunks() for name in table.column_names}
        self.width = width
        self.conv, self.block, self.tail_leaves, self.tail_children, self.tail_saved = (
            column[c].to_numpy(zero_copy_only=False)
            for c in ("conv_id", "block", "tail_leaves", "tail_children", "tail_saved")
        )
        self.has_top = column["top"].is_valid().to_numpy(zero_copy_only=False)
        self.top = column["top"].fill_null(0).to_numpy(zero_copy_only=False)
        self.more = column["more"].to_numpy(zero_copy_only=False).astype(bool)
        self.prefix = column["prefix"].to_pylist()
        self.turns = column["turns"].to_pylist()
        flat = np.frombuffer(b"".join(self.turns), dtype=f"V{_DIGEST}").view([("a", "u8"), ("b", "u8")])
        codes = np.unique(flat, return_inverse=True)[1].reshape(-1)
        self.lengths = np.array([len(t) for t in self.turns], dtype=np.int64) // _DIGEST
        self.first = np.cumsum(self.lengths) - self.lengths
        sizes = column["sizes"].flatten().to_numpy(zero_copy_only=False)
        self.sums = np.append(0, np.cumsum(sizes, dtype=np.int64))
        tries = list(zip(self.block.tolist(), self.prefix))
        other = np.array([True, *(a != b for a, b in zip(tries, tries[1:]))])
        self.lcp = np.where(other, -1, _common(codes, self.first, self.lengths))
        self.trie = np.cumsum(other)
        self._nodes()

    def edge(self, row: int) -> dict:
        """What the neighbour segment has to know of a first or last row."""
        sizes = np.diff(self.sums[self.first[row] : self.first[row] + self.lengths[row] + 1])
        return {
            "block": int(self.block[row]),
            "prefix": self.prefix[row],
            "turns": self.turns[row],
            "sizes": sizes.tolist(),
            "ends": not self.more[row],
        }

    def _nodes(self) -> None:
        """Nodes as if nothing came before or after."""
        paths = merge_forest(self.lengths, self.lcp, self.conv)
        count = paths[:, 3] - paths[:, 2] + 1
        low, high, top, bottom, children, least = np.repeat(paths, count, axis=0).T
        depth = top + np.arange(len(top)) - np.repeat(np.cumsum(count) - count, count)
        self.low, self.high, self.depth, self.bottom = low, high, depth, depth == bottom
        self.least = np.where((depth == 0) & self.has_top[low], self.top[low], least)

        def between(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
            sums = np.append(0, np.cumsum(values, dtype=np.int64))
            return sums[stop] - sums[start]

        # The last of equal rows stands for a childless node if no row goes on from there.
        leaf = (np.append(self.lcp[1:], -1) < self.lengths) & ~self.more
        total = self.sums[self.first + self.lengths] - self.sums[self.first]
        # Sizes of the nodes that a row is the first member of.
        made = total - (self.sums[self.first + np.maximum(self.lcp, 0)] - self.sums[self.first])
        above = self.sums[self.first[low] + np.maximum(depth - 1, 0)] - self.sums[self.first[low]]
        weighted = between(total, low, high) - (high - low) * above
        created = between(made, low + 1, high) + total[low] - above
        full = self.bottom & (bottom == self.width)
        self.n_convs = high - low
        self.n_children = np.where(self.bottom, children, 1) + np.where(full, between(self.tail_children, low, high), 0)
        self.n_leaves = between(leaf + self.tail_leaves, low, high)
        self.saved = weighted - created + between(self.tail_saved, low, high)
        # The parent is the node one up that begins at this node's first row or last before it.
        level = self.trie[low] * (self.width + 2) + depth
        ranked = np.lexsort((low, level))
        place = level * (len(self.conv) + 1) + low
        up = np.searchsorted(place[ranked], place - (len(self.conv) + 1), side="right") - 1
        self.parent = np.where(depth > 0, ranked[np.maximum(up, 0)], -1)

    def _ends(self, node: int) -> np.ndarray:
        """Members that end at a node, ascending: shorter rows come first, of equal rows those that end."""
        low, high, depth = self.low[node], self.high[node], self.depth[node]
        stop = low + int(np.searchsorted(self.lengths[low:high], depth, side="right"))
        return self.conv[low:stop][~self.more[low:stop]]

    def rows(self, part: int, number: int) -> Iterator[pa.RecordBatch]:
        """Final nodes; of nodes on the path of the first or last row what this segment has of them."""
        last = len(self.conv) - 1
        is_open = (self.low == 0) | (self.high == last + 1)
        along = [_keys_along(int(self.block[r]), self.prefix[r], self.turns[r]) for r in (0, last)]

        def key(node: int) -> bytes:
            return along[0 if self.low[node] == 0 else 1][self.depth[node]]

        block = self.block[self.low]
        values = {
            "depth": block * self.width + self.depth,
            "conv_id": self.least,
            "n_convs": self.n_convs,
            "n_children": self.n_children,
            "n_leaves": self.n_leaves,
            "saved_tokens": self.saved,
            "real": (self.depth > 0) | (block == 0),  # roots of later blocks are nodes of the block above
        }
        # Members end only at the lower end of a path, which is as long as its first row.
        with_ends = self.bottom & (self.lengths[self.low] == self.depth)
        final, opened = np.flatnonzero(~is_open), np.flatnonzero(is_open)
        below_open = is_open[self.parent[final]] & (self.depth[final] > 0)
        columns = {name: value[final] for name, value in values.items()}
        columns["kind"] = np.full(len(final), _NODE)
        columns["ends_sha256"] = [_hash_of(self._ends(k)) if with_ends[k] else _NO_ENDS for k in final]
        columns["parent"] = [key(self.parent[k]) if below else None for k, below in zip(final, below_open)]
        known = (self.depth[final] > 0) & ~below_open
        columns["parent_conv_id"] = pa.array(self.least[self.parent[final]], mask=~known)
        yield _batch(len(final), columns)

        columns = {name: value[opened] for name, value in values.items()}
        columns["kind"] = np.full(len(opened), _PART)
        columns["node"] = [key(k) for k in opened]
        columns["parent"] = [key(self.parent[k]) if self.depth[k] else None for k in opened]
        yield _batch(len(opened), columns)
        ending = [(k, self._ends(k)) for k in opened if with_ends[k]]
        yield _rows(
            [
                {"kind": _ENDS, "node": key(k), "part": part, "segment": number, "ids": zlib.compress(_joined(ids), 1)}
                for k, ids in ending
                if len(ids)
            ]
        )


def _segments(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        each = max(1, batch.nbytes // max(1, batch.num_rows))
        step = max(1, limit // each)
        for start in range(0, batch.num_rows, step):
            piece = batch.slice(start, step)
            held.append(piece)
            size += each * piece.num_rows
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _passed(sorted_blocks: DataFrame, width: int, limit: int) -> DataFrame:
    """Final nodes, parts of open nodes, ids that end at open nodes, and the edges of each partition."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before = None
        for number, table in enumerate(_segments(batches, limit)):
            segment = _Segment(table, width)
            yield from segment.rows(part, number)
            first = segment.edge(0)
            if before is None:
                yield _rows([{"kind": _EDGE, "part": part, "last": False, **first}])
            else:
                yield _rows(_twice_counted(before, first, width))
            before = segment.edge(len(segment.conv) - 1)
        if before is not None:
            yield _rows([{"kind": _EDGE, "part": part, "last": True, **before}])

    return write_scratch(sorted_blocks.mapInArrow(rows, _PASS), "forests")


def _across(passed: DataFrame, width: int) -> DataFrame:
    """What the two sides of each boundary between partitions have both counted.

    One row per partition edge, of bounded size, passes the window.
    """
    fields = ["block", "prefix", "turns", "sizes", "ends"]
    edges = passed.where(F.col("kind") == _EDGE).select("part", "last", F.struct(*fields).alias("one"))
    pairs = edges.withColumn("two", F.lead("one").over(Window.orderBy("part", "last"))).where("last and two is not null")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.select(["one", "two"]).to_pylist():
                yield _rows(_twice_counted(pair["one"], pair["two"], width))

    return pairs.select("one", "two").mapInArrow(rows, _PASS)


def _merged(passed: DataFrame, width: int) -> DataFrame:
    """Open nodes, summed over all segments and less what was counted twice."""
    parts = passed.where(F.col("kind") == _PART).unionByName(_across(passed, width))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    found = parts.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums,
        F.max("real").alias("real"),
    )
    return write_scratch(found, "open-nodes")


def _hashed_ends(passed: DataFrame) -> DataFrame:
    """``node, hash`` of open nodes at which conversations end.

    A hash has to see all its ids in a row; they come as packed pieces, one at a time.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            found = []
            for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
                if key == node:
                    state.update(b",")
                else:
                    if node is not None:
                        found.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                state.update(zlib.decompress(ids.as_py()))
            yield _hashes(found)
        yield _hashes([] if node is None else [(node, state.hexdigest())])

    def _hashes(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
        columns = [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["node", "hash"])

    pieces = passed.where(F.col("kind") == _ENDS).select("node", "part", "segment", "ids")
    pieces = pieces.repartition("node").sortWithinPartitions("node", "part", "segment")
    return pieces.mapInArrow(rows, "node binary, hash string")


def _sorted(found: DataFrame) -> DataFrame:
    order = ["block", "prefix", "turns", "more", "conv_id"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order)


def _with_tails(found: DataFrame, width: int, limit: int) -> DataFrame:
    """Blocks with what the tries of later blocks add to theirs.

    The trie of a later block is counted once, at the smallest of its conversations.
    """
    none = {f"tail_{c}": F.lit(0).cast("long") for c in ("leaves", "children", "saved")}
    later = found.where("block > 0")
    if later.isEmpty():
        return found.withColumns(none)
    # Without the tops, roots are known by a conversation that has the block.
    alone = later.withColumns(none).withColumn("top", F.lit(None).cast("long"))
    passed = _passed(_sorted(alone), width, limit)
    wanted = ["conv_id", "depth", "n_leaves", "n_children", "saved_tokens"]
    final = passed.where((F.col("kind") == _NODE) & ~F.col("real")).select(*wanted)
    roots = final.unionByName(_merged(passed, width).where("not real").select(*wanted))
    roots = roots.withColumn("block", F.expr(f"depth div {width}")).drop("depth")
    order = Window.partitionBy("conv_id").orderBy("block")
    after = order.rowsBetween(1, Window.unboundedFollowing)
    return write_scratch(
        found.join(roots, ["conv_id", "block"], "left").select(
            *found.columns,
            F.coalesce(F.sum("n_leaves").over(after), F.lit(0)).alias("tail_leaves"),
            F.coalesce(F.lead("n_children").over(order), F.lit(0)).alias("tail_children"),
            F.coalesce(F.sum("saved_tokens").over(after), F.lit(0)).alias("tail_saved"),
        ),
        "tails",
    )


def trie(conversations: DataFrame, width: int = BLOCK, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations.

    Needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not looked at. Turns are
    ordered by turn, null first, and turns of equal number by a hash of role and text; a null role or
    text is empty. Repeated rows are turns of their own. Rows with a null ``conv_id`` belong to no
    conversation and are left out. A conversation is rebuilt as the first h turns of the one at the
    multiple of 100 towards 0, then its own turns after its first h, with h the crc32 of its id modulo 6.

    Returns per node: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Two nodes may have the same conv_id, never at the same
    depth. An empty table gives an empty result. Turns count as equal when 128 bits of their SHA-256 are.
    """
    found = _with_tails(blocks(rebuilt_turns(numbered_turns(conversations)), width), width, segment_bytes)
    passed = _passed(_sorted(found), width, segment_bytes)
    merged = _merged(passed, width)
    parents = write_scratch(merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("up")), "parents")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    final = passed.where((F.col("kind") == _NODE) & F.col("real"))
    inside = final.where("parent is null").select(*columns)
    below = join_checked(final.where("parent is not null").drop("parent_conv_id"), parents, "parent", "inner")
    opened = merged.where("real").join(parents, "parent", "left").join(_hashed_ends(passed), "node", "left")
    opened = opened.withColumn("ends_sha256", F.coalesce("hash", F.lit(_NO_ENDS)))
    named = [frame.withColumnRenamed("up", "parent_conv_id").select(*columns) for frame in (below, opened)]
    return inside.unionByName(named[0]).unionByName(named[1])
