"""Pattern packing: documents into sequences of at most a fixed number of tokens.

All that decides a packing is the histogram of piece lengths, which has as many entries as a sequence
has tokens. On the driver, patterns of few long documents that fill a sequence are enumerated on a
coarse grid, their repeat counts are fitted to the histogram by non-negative least squares and
rounded down, and what is left (short documents above all) is packed best fit into the space that is
left. The plan names, for each length, which places the pieces of that length take. The cluster
tokenizes, numbers the pieces of each length, and looks their places up; no piece passes the driver.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sondelake.llm.token_counts import _byte_characters
from sondelake.operators.scratch import write_scratch

LIMIT = 4096
#: Id that ends every document.
END_ID = 1
#: Parts of a sequence that lengths of long documents are rounded up to.
UNITS = 64
#: Long documents have more than this many parts; shorter ones fill the space that is left.
SHORT_UNITS = 4
#: Documents in a pattern, and parts that it may leave free.
MOST_DOCUMENTS, MOST_FREE = 4, 3
#: Parts of a sequence that a fitted one may leave free, tried in turn; the plan with the fewest sequences is taken.
LEFT_FREE = (1, 64, 256, 4096)
#: Pieces whose ids a worker remembers before it begins anew.
REMEMBERED = 800_000
#: Longer pieces are not remembered.
REMEMBERED_BYTES = 64
#: Bytes of a text that are tokenized at once.
CUT = 1 << 20
_BLANK = re.compile(rb"[\t-\r ]")
_WORD = re.compile("[^\t-\r ]+")

# Fixed values of the vocabulary's splitting rule: letters from U+00C0 to U+017F, and characters beyond
# ASCII that are neither letters, numbers nor white space. All of them keep their normal form.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_SIGNS = "\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2010-\u2027\u2030-\u205e\u20a0-\u20bf"
_PLAIN = re.compile(f"[\x00-\x7f{_LATIN}{_SIGNS}]*")
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^\t-\r a-z0-9{_LATIN}]+")


class _Pieces(dict):
    """Ids of pieces; missing ones are asked from the library's model."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        self.spelling = dict(enumerate(_byte_characters()))

    def __missing__(self, piece: str) -> bytes:
        spelled = piece.encode().decode("latin-1").translate(self.spelling)
        ids = array("I", [token.id for token in self.model.tokenize(spelled)]).tobytes()
        if len(piece) <= REMEMBERED_BYTES:
            self[piece] = ids
        return ids


class TokenIds:
    """Token ids of texts, as 32-bit bytes, by the library.

    The vocabulary's rules drop white space and never join what it parts. Texts of ASCII, Latin letters
    and common signs are lower-cased and split into pieces here, which does for them what the
    library's normal forms and splitting rule do, and only pieces go to the library's model. Other
    texts are taken word by word, and words with other characters go through the whole library.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = _Pieces(self.tokenizer.model)

    def _plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(special in text for special in self.special)

    def of(self, text: str) -> bytes:
        pieces = self.pieces
        if len(pieces) > REMEMBERED:
            pieces.clear()
        if self._plain(text):
            return b"".join([pieces[piece] for piece in _PIECE.findall(text.lower())])
        out = []
        for word in _WORD.findall(text):
            if self._plain(word):
                out += [pieces[piece] for piece in _PIECE.findall(word.lower())]
            else:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                out.append(array("I", ids).tobytes())
        return b"".join(out)

    def stream(self, text: bytes) -> Iterator[bytes]:
        """Ids of a text of any length, a stretch of about `CUT` bytes after the other."""
        start = 0
        while len(text) - start > CUT:
            blank = _BLANK.search(text, start + CUT)
            if blank is None:
                break
            yield self.of(text[start : blank.start()].decode())
            start = blank.end()
        yield self.of(text[start:].decode())


def cut_pieces(ids: Iterable[bytes], limit: int, end_id: int) -> Iterator[bytes]:
    """The ids of a document and ``end_id`` in pieces of ``limit`` ids; the last may be shorter."""
    buffer, width = bytearray(), 4 * limit
    for some in ids:
        buffer += some
        while len(buffer) > width:  # the end is still to come
            yield bytes(buffer[:width])
            del buffer[:width]
    buffer += np.array([end_id], dtype="<u4").tobytes()
    for start in range(0, len(buffer), width):
        yield bytes(buffer[start : start + width])


_workers: dict[str, TokenIds] = {}


def pieces(docs: DataFrame, vocabulary: str, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, place``, stored; ``place`` counts the pieces
    of the same length within a part of the input. With ``with_ids``, the ids too."""
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
    if with_ids:
        fields, schema = [*fields, "ids"], schema + ", ids binary"
    types = {"doc_id": pa.int64(), "piece": pa.int32(), "part": pa.int32(), "ids": pa.binary()}

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _workers:
            _workers[vocabulary] = TokenIds(shared.value)
        encoder = _workers[vocabulary]
        met = [0] * (limit + 1)

        def flushed(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out) if out else [()] * len(fields)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, types.get(f, pa.int64())) for f, c in zip(fields, columns)], names=fields
            )

        for batch in batches:
            out: list[tuple] = []
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text, part in zip(batch.column("doc_id").to_pylist(), texts, batch.column("part").to_pylist()):
                for piece, ids in enumerate(cut_pieces(encoder.stream(text.as_py() or b""), limit, end_id)):
                    n = len(ids) // 4
                    row = (doc_id, piece, piece * limit, n, zlib.crc32(ids), part, met[n])
                    out.append((*row, ids) if with_ids else row)
                    met[n] += 1
                    if len(out) >= 4096:
                        yield flushed(out)
                        out = []
            yield flushed(out)

    read = docs.select("doc_id", "text", F.spark_partition_id().alias("part"))
    return write_scratch(read.mapInArrow(rows, schema), "pieces")


def patterns(units: int = UNITS, short: int = SHORT_UNITS, most: int = MOST_DOCUMENTS, free: int = MOST_FREE) -> np.ndarray:
    """How often each size (1 to ``units``) stands in each pattern, one pattern per column.

    Patterns hold 1 to ``most`` sizes above ``short`` and leave at most ``free`` parts.
    """
    found: list[list[int]] = []

    def extend(sizes: list[int], left: int) -> None:
        if sizes and left <= free:
            found.append(sizes)
        if len(sizes) < most:
            for size in range(min(left, sizes[-1] if sizes else units), short, -1):
                extend([*sizes, size], left - size)

    extend([], units)
    table = np.zeros((units + 1, len(found)), dtype=np.int64)
    for column, sizes in enumerate(found):
        np.add.at(table[:, column], sizes, 1)
    return table


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 with the least squared difference of ``a @ x`` and ``b``, by active sets."""
    x = np.zeros(a.shape[1])
    active: list[int] = []
    least = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= least:
            break
        active.append(best)
        while True:
            fit = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if (fit > 0).all():
                break
            now = x[active]
            low = np.flatnonzero(fit <= 0)
            step = float(np.min(now[low] / np.maximum(now[low] - fit[low], 1e-300)))
            now = now + step * (fit - now)
            x[active] = np.maximum(now, 0)
            kept = [k for k, value in zip(active, now) if value > 1e-12]
            x[[k for k in active if k not in kept]] = 0
            if len(kept) == len(active):  # rounding: nothing reached its bound
                kept.pop(int(np.argmin(fit)))
            active = kept
            if not active:
                return x
        x[:] = 0
        x[active] = fit
    return x


@dataclass
class Bundle:
    """``repeats`` sequences that hold the same lengths."""

    repeats: int
    space: int
    copies: dict[int, int]

    def with_more(self, repeats: int, length: int, n: int) -> Bundle:
        copies = {**self.copies, length: self.copies.get(length, 0) + n}
        return Bundle(repeats, self.space - n * length, copies)


def _from_patterns(stock: np.ndarray, limit: int) -> list[Bundle]:
    """Sequences of long documents after the fitted patterns; what they hold leaves ``stock``."""
    units = min(UNITS, limit)
    sizes = -(-np.arange(limit + 1) * units // limit)  # parts, rounded up
    wanted = np.bincount(sizes, weights=stock, minlength=units + 1)
    wanted[: SHORT_UNITS + 1] = 0
    table = patterns(units)
    if not wanted.any() or not table.shape[1]:
        return []
    scale = wanted.max()
    fitted = np.floor(non_negative_least_squares(table.astype(float), wanted / scale) * scale + 1e-6).astype(np.int64)
    by_size = [[int(n) for n in np.flatnonzero((sizes == u) & (stock > 0))] for u in range(units + 1)]
    out = []
    for column in np.argsort(-fitted, kind="stable"):
        slots = [u for u in range(units, 0, -1) for _ in range(int(table[u, column]))]
        repeats = int(fitted[column])
        while repeats > 0:
            # As many sequences as are alike when each slot takes the longest pieces that are left,
            # the last one the longest that fit.
            taken: dict[int, int] = {}
            space = limit
            for place, u in enumerate(slots, 1):
                fits = (n for n in reversed(by_size[u]) if stock[n] > taken.get(n, 0))
                if place == len(slots):
                    fits = (n for n in range(space, 0, -1) if stock[n] > taken.get(n, 0))
                n = next(fits, 0)
                taken[n] = taken.get(n, 0) + 1
                space -= n
            if 0 in taken:
                break
            same = min(repeats, *(int(stock[n]) // k for n, k in taken.items()))
            for n, k in taken.items():
                stock[n] -= same * k
            out.append(Bundle(same, space, taken))
            repeats -= same
            for u in {int(sizes[n]) for n in taken}:
                by_size[u] = [n for n in by_size[u] if stock[n]]
    return out


def _best_fit(stock: np.ndarray, bundles: list[Bundle], limit: int) -> list[Bundle]:
    """Put what is in ``stock``, longest first, where it leaves the least space."""
    by_space: dict[int, list[Bundle]] = {}
    spaces: list[int] = []

    def add(bundle: Bundle) -> None:
        if bundle.repeats:
            if bundle.space not in by_space:
                by_space[bundle.space] = []
                insort(spaces, bundle.space)
            by_space[bundle.space].append(bundle)

    for bundle in bundles:
        add(bundle)
    for length in range(limit, 0, -1):
        left = int(stock[length])
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                bundle = Bundle(-(-left // (limit // length)), limit, {})
            else:
                bundle = by_space[spaces[at]].pop()
                if not by_space[spaces[at]]:
                    del by_space[spaces[at]], spaces[at]
            each = bundle.space // length
            full = min(bundle.repeats, left // each)
            rest = min(left - full * each, each - 1) if full < bundle.repeats else 0
            add(bundle.with_more(full, length, each))
            if rest:
                add(bundle.with_more(1, length, rest))
            if bundle.copies:  # a sequence without pieces is none
                add(Bundle(bundle.repeats - full - bool(rest), bundle.space, bundle.copies))
            left -= full * each + rest
    return [bundle for some in by_space.values() for bundle in some]


@dataclass
class Plan:
    """Where the pieces of each length go, sorted by length and number.

    The pieces of ``length`` with numbers from ``first`` on go, ``copies`` to a sequence, to the
    sequences from ``sequence`` on, beginning at ``offset``.
    """

    length: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.searchsorted(self.length, length, side="left")
        stop = np.searchsorted(self.length, length, side="right")
        while (stop - begin > 1).any():  # bisection within the entries of a length
            middle = (begin + stop) // 2
            after = self.first[np.minimum(middle, len(self.first) - 1)] <= number
            wide = stop - begin > 1
            begin, stop = np.where(wide & after, middle, begin), np.where(wide & ~after, middle, stop)
        past = number - self.first[begin]
        each = self.copies[begin]
        return self.sequence[begin] + past // each, self.offset[begin] + past % each * length


def plan(histogram: np.ndarray, limit: int = LIMIT) -> Plan:
    """The plan for ``histogram[length]`` pieces of each length up to ``limit``."""
    fitted = _from_patterns(np.array(histogram, dtype=np.int64), limit)
    packings = []
    for free in (limit // part for part in LEFT_FREE):
        # Fitted sequences that leave more than this free go back to the residuals.
        kept = [bundle for bundle in fitted if bundle.space <= free]
        stock = np.array(histogram, dtype=np.int64)
        for bundle in kept:
            for length, n in bundle.copies.items():
                stock[length] -= n * bundle.repeats
        packings.append(_best_fit(stock, kept, limit))
    bundles = min(packings, key=lambda found: sum(bundle.repeats for bundle in found))
    met = np.zeros(limit + 1, dtype=np.int64)
    entries, sequence = [], 0
    for bundle in bundles:
        offset = 0
        for length, n in sorted(bundle.copies.items(), reverse=True):
            entries.append((length, int(met[length]), n, sequence, offset))
            met[length] += n * bundle.repeats
            offset += n * length
        sequence += bundle.repeats
    columns = np.array(sorted(entries), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, n_sequences=sequence)


def _numbered(cut: DataFrame) -> DataFrame:
    """Pieces with their ``number`` among all pieces of their length.

    A hot length is numbered part by part: offsets are sums over one row per part and length.
    """
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return cut.join(offsets, ["part", "length"]).withColumn("number", F.col("before") + F.col("place"))


def pack(docs: DataFrame, vocabulary: str, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The place of every piece of every document.

    Needs ``doc_id`` and ``text``; other columns are not looked at. ``vocabulary`` is the path of a
    tokenizer description of the tokenizers library, read on the driver. A document is the ids of
    its whole text without added special tokens, and ``end_id``; longer ones than ``limit`` are cut
    into pieces of ``limit`` ids, the last may be shorter. Returns doc_id, piece, start, length, ids_crc32
    (of little-endian 32-bit ids), sequence_id, offset; with ``with_ids`` also ids (those bytes).
    A null or empty text is ``end_id`` alone; repeated rows and ids are separate documents, a null id
    stays null; an empty table gives an empty result. A text is read in stretches, so a very long one
    needs little more memory than itself, unless it holds a very long word, which the library must
    see whole. The driver holds the histogram (``limit`` numbers) and the plan, whose size depends on the
    lengths that occur and not on how many documents there are.
    """
    cut = pieces(docs, vocabulary, limit, end_id, with_ids)
    histogram = np.zeros(limit + 1, dtype=np.int64)
    for row in cut.groupBy("length").count().collect():
        histogram[row.length] = row["count"]
    shared = docs.sparkSession.sparkContext.broadcast(plan(histogram, limit))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            if batch.num_rows:
                found = shared.value.places(length, number)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *(pa.array(f, pa.int64()) for f in found)],
                    names=[*kept, "sequence_id", "offset"],
                )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    numbered = _numbered(cut).select(*kept, "number")
    return numbered.mapInArrow(rows, schema + ", sequence_id long, offset long")


def sequences(docs: DataFrame, vocabulary: str, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """``sequence_id, ids`` (array of int) and ``doc_ids, offsets`` of the pieces of every packed sequence."""
    packed = pack(docs, vocabulary, limit, end_id, with_ids=True)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most ``limit`` ids
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = [b"".join(part["ids"] for part in parts) for parts in batch.column("parts").to_pylist()]
            ids = pa.array([np.frombuffer(j, "<u4").astype(np.int32) for j in joined], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), ids, batch.column("doc_ids"), batch.column("offsets")],
                names=["sequence_id", "ids", "doc_ids", "offsets"],
            )

    named = grouped.withColumns({"doc_ids": F.col("parts.doc_id"), "offsets": F.col("parts.offset")})
    return named.mapInArrow(rows, "sequence_id long, ids array<int>, doc_ids array<long>, offsets array<long>")
