"""Text columns as flat numpy arrays: bounded chunks, word spans, hashes of spans and n-grams.

Helpers of the operators that run in ``mapInArrow``. They look at UTF-8 bytes, so a word is a pair
of byte positions and no Python string is made for it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step of an operator holds as arrays; a longer text comes alone.
CHUNK_BYTES = 1 << 20

#: Bytes of `[^\\x20\\x09-\\x0D]`.
NON_BLANK = np.ones(256, dtype=bool)
NON_BLANK[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`, once A-Z are lower-cased.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[ord("0") : ord("9") + 1] = True
ALPHANUMERIC[ord("a") : ord("z") + 1] = True
ALPHANUMERIC[128:] = True

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Prime moduli below 2^31 of the two hashes that make one, each with a base of its own.
_MODULI = (2_147_483_647, 2_147_483_629)
_BASES = (1_610_612_741, 805_306_457)
#: Positions whose powers are kept; longer spans are hashed in stretches of this many.
_STRETCH = 1 << 18
_tables: list[tuple[np.ndarray, np.ndarray]] = []


def text_chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece hold at most ``limit`` bytes together."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text begins; a null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    where = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[where[0] : where[-1]], where - where[0]


def split_spans(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of positions marked in ``inside`` that do not leave their text.

    Returns starts, ends (exclusive), and for each text the number of its first run; the last
    entry is the number of runs.
    """
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begin[firsts] = inside[firsts]
    finals = offsets[1:][offsets[1:] > 0] - 1
    last[finals] = inside[finals]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finishing step of SplitMix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables() -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers and inverse powers of both bases, made once by doubling."""
    if not _tables:
        for modulus, base in zip(_MODULI, _BASES):
            pair = []
            for step in (base, pow(base, -1, modulus)):
                powers = np.ones(2 * _STRETCH + 1, dtype=np.uint64)
                done = 1
                while done < len(powers):
                    more = powers[: min(done, len(powers) - done)] * np.uint64(pow(step, done, modulus))
                    powers[done : done + len(more)] = more % np.uint64(modulus)
                    done += len(more)
                pair.append(powers)
            _tables.append((pair[0], pair[1]))
    return _tables


def _terms(values: np.ndarray, modulus: np.uint64, powers: np.ndarray) -> np.ndarray:
    """Summands of the hash of ``values``: each plus one, times the power of its place."""
    small = values if values.dtype.itemsize < 4 else values.astype(np.uint64) % modulus
    return (small.astype(np.uint64) + np.uint64(1)) * powers[: len(values)] % modulus


def _short_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    halves = []
    for modulus, (powers, inverse) in zip(map(np.uint64, _MODULI), _power_tables()):
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(_terms(values, modulus, powers), out=sums[1:])  # below 2^31 each: no overflow
        halves.append((sums[ends] - sums[starts]) % modulus * inverse[starts] % modulus)
    return (halves[0] << np.uint64(32)) | halves[1]


def _long_span(values: np.ndarray) -> int:
    halves = []
    for modulus, base, (powers, _) in zip(_MODULI, _BASES, _power_tables()):
        total = 0
        for at in range(0, len(values), _STRETCH):
            stretch = _terms(values[at : at + _STRETCH], np.uint64(modulus), powers)
            total += int(stretch.sum()) % modulus * pow(base, at, modulus)
        halves.append(total % modulus)
    return (halves[0] << 32) | halves[1]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """62-bit hashes (as 64 spread bits) of ``values[start:end]``, equal for equal content wherever it stands.

    Two polynomial hashes modulo primes, from running sums; the inverse power of the start takes the
    position out. Memory beside the result does not grow with ``values``.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    short = np.flatnonzero(ends - starts <= _STRETCH)
    if (starts[short][1:] < starts[short][:-1]).any():
        short = short[np.argsort(starts[short], kind="stable")]
    first, last = starts[short], ends[short]
    done = 0
    while done < len(short):
        low = first[done]
        stop = int(np.searchsorted(first, low + _STRETCH))
        high = last[done:stop].max()
        out[short[done:stop]] = _short_spans(values[low:high], first[done:stop] - low, last[done:stop] - low)
        done = stop
    for k in np.flatnonzero(ends - starts > _STRETCH):
        out[k] = _long_span(values[starts[k] : ends[k]])
    return mix(out)


def ngram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` neighbours, over all texts at once."""
    starts = np.arange(max(0, len(hashes) - width + 1))
    return span_hashes(hashes, starts, starts + width)


def owners(first: np.ndarray) -> np.ndarray:
    """The text that each run belongs to, from the third result of `split_spans`."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ngram_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Positions at which ``width`` neighbours belong to one text."""
    owner = owners(first)
    if len(owner) < width:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(owner[: len(owner) - width + 1] == owner[width - 1 :])


def covered(size: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Marks of the positions inside any span of ``width`` positions; starts are distinct."""
    sums = np.zeros(size + width + 1, dtype=np.int32)
    sums[starts + width] = 1
    np.cumsum(sums, out=sums)  # at i + width: spans that start at i or before
    return sums[width : width + size] > sums[:size]


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the runs of each text."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]
