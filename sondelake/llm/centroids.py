"""Centroid clustering by progressive search over Walsh-Hadamard coefficients.

The transform of 64 components is exact in integers and keeps distances up to the factor 64, so sums
of squared coefficient differences, taken coarse to fine, are lower bounds that grow to the whole
distance. A centroid whose bound passes the distance of one known centroid is strictly worse and is
dropped; for what is left all 64 coefficients are summed. Equal distances go to the smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondelake.operators.scratch import write_scratch

SIZE = 64
SCALE = 256
#: Scaled components are kept within these bounds, so that all sums of squares fit 64 bits.
LIMIT = 1 << 24
#: Coefficients (coarse to fine) after which centroids are compared.
STEPS = (4, 8, 16, 32, 64)
#: Vectors searched side by side.
BLOCK = 4096
_LONG_MAX = (1 << 63) - 1


def _by_sign_changes() -> np.ndarray:
    """Order of the transform's rows from coarse (few sign changes) to fine."""
    rows = walsh_hadamard(np.eye(SIZE, dtype=np.int64)).T
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def walsh_hadamard(vectors: np.ndarray) -> np.ndarray:
    """The transform of each row, by six rounds of sums and differences."""
    out = vectors.astype(np.int64)
    half = 1
    while half < SIZE:
        pairs = out.reshape(len(out), SIZE // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), SIZE)
        half *= 2
    return out


_ORDER = _by_sign_changes()
_PLACE = np.argsort(_ORDER)


def coefficients(vectors: np.ndarray) -> np.ndarray:
    """Transforms of integer vectors, coarse to fine."""
    return walsh_hadamard(vectors)[:, _ORDER]


def components(transformed: list[int]) -> list[int]:
    """The integer vector (or sum of vectors) with these coefficients."""
    plain = np.array(transformed, dtype=object)[_PLACE].reshape(1, -1)
    half = 1
    while half < SIZE:
        pairs = plain.reshape(-1, 2, half)
        plain = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).reshape(1, -1)
        half *= 2
    return [int(x) // SIZE for x in plain[0]]


def _squares(vectors: np.ndarray, centers: np.ndarray, rows: np.ndarray, numbers: np.ndarray, start: int, stop: int) -> np.ndarray:
    apart = vectors[rows, start:stop] - centers[numbers, start:stop]
    return np.einsum("ij,ij->i", apart, apart)


def nearest(vectors: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest center of each row; both sides are coefficients."""
    n, k = len(vectors), len(centers)
    rows, numbers = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    sums = np.zeros(n * k, dtype=np.int64)
    known = np.full(n, _LONG_MAX, dtype=np.int64)  # whole distance of one center per row
    done = 0
    for stop in STEPS:
        sums += _squares(vectors, centers, rows, numbers, done, stop)
        done = stop
        if stop == SIZE:
            break
        # The center that looks best so far is measured to the end; it bounds the nearest one.
        first = np.searchsorted(rows, np.arange(n))
        best = np.minimum.reduceat(sums, first)
        at = np.flatnonzero(sums == best[rows])
        at = at[np.searchsorted(rows[at], np.arange(n))]
        known = np.minimum(known, sums[at] + _squares(vectors, centers, rows[at], numbers[at], stop, SIZE))
        left = sums <= known[rows]
        rows, numbers, sums = rows[left], numbers[left], sums[left]
    first = np.searchsorted(rows, np.arange(n))
    best = np.minimum.reduceat(sums, first)
    at = np.flatnonzero(sums == best[rows])
    at = at[np.searchsorted(rows[at], np.arange(n))]
    return numbers[at], sums[at] // SIZE


def _scaled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("embedding")
        whole = pc.fill_null(pc.equal(pc.list_value_length(lists), SIZE), False)
        batch = batch.filter(whole)
        flat = pc.list_flatten(batch.column("embedding")).cast(pa.float64())
        values = flat.to_numpy(zero_copy_only=False).reshape(-1, SIZE)  # nulls become NaN
        good = np.isfinite(values).all(axis=1)
        values = np.floor(np.clip(values[good], -LIMIT, LIMIT) * SCALE)
        kept = coefficients(np.clip(values, -LIMIT, LIMIT - 1).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").filter(pa.array(good)), _lists(kept)], names=["vec_id", "coefficients"]
        )


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, SIZE, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1).astype(np.int64)))


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, coefficients`` of the vectors with exactly 64 finite components, stored."""
    return write_scratch(
        vectors.select("vec_id", "embedding").mapInArrow(_scaled, "vec_id long, coefficients array<long>"), "coefficients"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, SIZE)


def _searched(batches: Iterable[pa.RecordBatch], centers: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            vectors = _matrix(part.column("coefficients"))
            yield part, vectors, *nearest(vectors, centers)


def _sums(kept: DataFrame, centers: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sums of their coefficients for each center that has any.

    Each task emits one row per center and coefficient at most; the driver gets as many.
    """
    shared = kept.sparkSession.sparkContext.broadcast(centers)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(len(centers), np.int64), np.zeros((len(centers), SIZE), dtype=object)
        for _, vectors, numbers, _ in _searched(batches, shared.value):
            order = np.argsort(numbers, kind="stable")
            found, first = np.unique(numbers[order], return_index=True)
            totals[found] += np.add.reduceat(vectors[order], first, axis=0).astype(object)
            counts += np.bincount(numbers, minlength=len(counts))
        found = np.flatnonzero(counts)
        values = [str(x) for x in totals[found].reshape(-1)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(found, SIZE), pa.int32()),
                pa.array(np.tile(np.arange(SIZE), len(found)), pa.int32()),
                pa.array(np.repeat(counts[found], SIZE), pa.int64()),
                pa.array(values, pa.string()),
            ],
            names=["number", "place", "n", "total"],
        )

    parts = kept.mapInArrow(rows, "number int, place int, n long, total string")
    sums = parts.groupBy("number", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    out: dict[int, tuple[int, list[int]]] = {}
    for row in sums.collect():
        out.setdefault(row.number, (row.n, [0] * SIZE))[1][row.place] = int(row.total)
    return out


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2) -> DataFrame:
    """Cluster and distance of every vector, and the inertia.

    Needs ``vec_id`` and ``embedding`` (an array of numbers); other columns are not looked at. Kept
    are vectors of exactly 64 components, none of them null or non-finite; a component x becomes
    floor(256 * x), held within 2^24 on either side. Centers start as the ``k`` kept vectors with the
    smallest sha256 of ``seed:vec_id``, in that order (all of them if there are fewer; equal ids by
    their components; a null id counts as empty text). Each round assigns every vector to the nearest
    center, ties to the smaller number, and moves each center that has any to the floor of their
    mean; then vectors are assigned once more.

    Returns vec_id, cluster, distance (squared), cluster_inertia, inertia (sums of distances, at most
    the largest long), centroid_sha256. Repeated rows are separate vectors; a null id keeps its
    row; an empty table, or one without a kept vector, gives an empty result. Per round a task emits
    at most ``k`` * 64 numbers and the driver holds as many; no vector is shuffled.
    """
    kept = kept_vectors(vectors)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    start = kept.select(name.alias("name"), "coefficients").orderBy("name", "coefficients").limit(k).collect()
    centers = np.array([row.coefficients for row in start], dtype=np.int64).reshape(-1, SIZE)
    if len(centers):
        for _ in range(rounds):
            for number, (n, total) in _sums(kept, centers).items():
                mean = [x // n for x in components(total)]
                centers[number] = coefficients(np.array([mean], dtype=np.int64))[0]
    names = [
        hashlib.sha256(",".join(map(str, components([int(x) for x in center]))).encode()).hexdigest() for center in centers
    ]
    shared = kept.sparkSession.sparkContext.broadcast(centers)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, numbers, distances in _searched(batches, shared.value):
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(numbers, pa.int32()), pa.array(distances, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    assigned = write_scratch(kept.mapInArrow(rows, "vec_id long, cluster int, distance long"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole = min(sum(int(r.total) for r in sums), _LONG_MAX)
    table = kept.sparkSession.createDataFrame(
        [(r.cluster, min(int(r.total), _LONG_MAX), whole, names[r.cluster]) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # One row per center.
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
