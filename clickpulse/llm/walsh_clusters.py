"""Centroid clustering of integer vectors by progressive search of their Walsh spectra.

The Walsh-Hadamard transform of n integers is n integers, and keeps squared distances but
for the factor n. Its coefficients are compared from the coarsest (the sum) to the finest:
what centroid and vector differ in so far is a lower bound of their distance, and with
twice the energy left in both an upper one, as (a - b)^2 <= 2 a^2 + 2 b^2. A centroid whose
lower bound is above the upper bound of another one is given up. What remains is compared
in all coefficients, so the nearest centroid and its distance are exact.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.frames import Input

#: Vectors that are compared at once.
_ROWS = 4096
#: Components up to this size keep all sums of 64 squares within 64 bits.
_SMALL = 1 << 20


def cluster_vectors(
    df: DataFrame,
    k: int = 8,
    rounds: int = 10,
    seed: int = 3,
    scale: int = 1024,
    size: int = 64,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors with exactly `size` components (a power of two), none null, infinite
    or NaN; each component x becomes floor(scale * x). The first centroids are the `k` kept
    vectors with the smallest SHA-256 of "seed:id" (null ids come last; equal ids go by
    their vectors). In each round every vector goes to its nearest centroid, and those that
    got any become the floor of their mean. Equal distances go to the smaller number.

    Repeated rows count each time and are all returned; other columns are not. With fewer
    than `k` vectors each is a centroid, without any the result is empty. Components of
    any size are compared exactly, but a distance or sum beyond 64 bits is an error.
    """
    if size & (size - 1) or size < 1:
        raise ValueError("the transform needs a power of two as its size")
    given = Input(df)
    body = given.frame.select(given[id].alias("id"), given[vector].alias("vector"))
    kind = body.schema["id"].dataType.simpleString()
    centroids = _first(body, k, seed, scale, size)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(body.select("vector"), centroids, scale)
    assigned = body.mapInArrow(
        lambda batches: _assigned(batches, centroids, scale, size),
        f"id {kind}, cluster int, distance bigint",
    )
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect() if centroids else []
    inertia = {row.cluster: row.d for row in sums}
    facts = [
        (n, inertia.get(n, 0), sum(inertia.values()), centroid_digest(c))
        for n, c in enumerate(centroids)
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    known = F.broadcast(df.sparkSession.createDataFrame(facts, schema))
    return assigned.join(known, "cluster").select(
        F.col("id").alias(id), "cluster", "distance", *known.columns[1:]
    )


def centroid_digest(centroid: list[int]) -> str:
    """SHA-256 of the components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def walsh(vectors: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, from the coarsest coefficient to the finest."""
    return _hadamard(vectors)[:, _coarse_to_fine(vectors.shape[1])]


def _hadamard(vectors: np.ndarray) -> np.ndarray:
    """Sums and differences of halves, step by step; exact in integers."""
    rows, size = vectors.shape
    found, half = vectors, 1
    while half < size:
        pairs = found.reshape(rows, size // (2 * half), 2, half)
        left, right = pairs[:, :, 0], pairs[:, :, 1]
        found = np.stack([left + right, left - right], axis=2).reshape(rows, size)
        half *= 2
    return found


def _coarse_to_fine(size: int) -> np.ndarray:
    """Places of the coefficients by the sign changes of their base functions."""
    functions = _hadamard(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(functions, axis=0) != 0).sum(axis=0), kind="stable")


def nearest(spectra: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each spectrum the number of its nearest centroid, and their squared distance.

    Candidates are pairs of row and centroid, in order; each row always keeps one.
    """
    (rows, size), k = spectra.shape, len(centroids)
    row, number = np.repeat(np.arange(rows), k), np.tile(np.arange(k), rows)
    apart = np.zeros(rows * k, spectra.dtype)
    start, end = 0, 1
    while start < size:
        difference = spectra[row, start:end] - centroids[number, start:end]
        apart = apart + (difference * difference).sum(axis=1)
        left, left_there = spectra[:, end:], centroids[:, end:]
        rest = 2 * ((left * left).sum(axis=1)[row] + (left_there * left_there).sum(axis=1)[number])
        most = np.minimum.reduceat(apart + rest, _firsts(row))
        kept = apart <= most[row]
        row, number, apart = row[kept], number[kept], apart[kept]
        start, end = end, 2 * end
    # Nothing is left beyond the last coefficient: what was kept are the nearest, with ties.
    first = _firsts(row)
    return number[first], apart[first] // size


def _firsts(row: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(row, prepend=-1))


def _kept(batch: pa.RecordBatch, scale: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and integer components of the batch's kept vectors, part by part."""
    for start in range(0, len(batch), _ROWS):
        column = batch.column("vector").slice(start, _ROWS)
        whole = np.asarray(pc.equal(pc.list_value_length(column), size).fill_null(False))
        flat = column.filter(pa.array(whole)).flatten().cast(pa.float64())
        values = flat.to_numpy(zero_copy_only=False).reshape(-1, size)
        finite = np.isfinite(values).all(axis=1)
        floors = np.floor(scale * values[finite])
        if floors.size and np.abs(floors).max() >= _SMALL:
            integers = np.array([[int(x) for x in row] for row in floors], dtype=object)
        else:
            integers = floors.astype(np.int64)
        yield start + np.flatnonzero(whole)[finite], integers


def _first(body: DataFrame, k: int, seed: int, scale: int, size: int) -> list[list[int]]:
    """The first centroids: each task offers its k best, so the driver sees only a few."""

    def offered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = []
        for batch in batches:
            draws = batch.column("draw").to_pylist()
            for places, integers in _kept(batch, scale, size):
                # U+FFFF is behind all hex digits: a null id has no draw.
                new = [(draws[p] or "￿", v) for p, v in zip(places.tolist(), integers.tolist())]
                best = heapq.nsmallest(k, best + new)
        yield pa.record_batch(
            {
                "draw": pa.array([draw for draw, _ in best], pa.string()),
                "vector": pa.array([v for _, v in best], pa.list_(pa.int64())),
            }
        )

    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    few = body.select(draw.alias("draw"), "vector").mapInArrow(
        offered, "draw string, vector array<bigint>"
    )
    return [list(row.vector) for row in few.orderBy("draw", "vector").limit(k).collect()]


def _moved(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """The floors of the means of the vectors nearest to each centroid."""
    size = len(centroids[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), size), object)
        count = np.zeros(len(centroids), np.int64)
        spectra = _spectra(centroids)
        for batch in batches:
            for _, integers in _kept(batch, scale, size):
                if len(integers):
                    number, _ = _nearest(integers, spectra)
                    for n in np.unique(number):
                        total[n] += integers[number == n].sum(axis=0).astype(object)
                        count[n] += (number == n).sum()
        yield pa.record_batch(
            {
                "cluster": pa.array(np.arange(len(centroids)), pa.int32()),
                "n": pa.array(count, pa.int64()),
                "total": pa.array(total.tolist(), pa.list_(pa.int64())),
            }
        )

    parts = vectors.mapInArrow(sums, "cluster int, n bigint, total array<bigint>")
    columns = (F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(size))
    means = {
        row.cluster: [row[f"s{i}"] // row.n for i in range(size)]
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *columns).collect()
        if row.n
    }
    return [means.get(n, centroid) for n, centroid in enumerate(centroids)]


def _assigned(
    batches: Iterator[pa.RecordBatch], centroids: list[list[int]], scale: int, size: int
) -> Iterator[pa.RecordBatch]:
    spectra = _spectra(centroids) if centroids else None
    for batch in batches:
        for places, integers in _kept(batch, scale, size):
            if len(integers):
                number, distance = _nearest(integers, spectra)
                yield pa.record_batch(
                    {
                        "id": batch.column("id").take(pa.array(places, pa.int64())),
                        "cluster": pa.array(number, pa.int32()),
                        "distance": pa.array(distance.tolist(), pa.int64()),
                    }
                )


def _spectra(centroids: list[list[int]]) -> np.ndarray:
    return walsh(np.array(centroids, dtype=object))


def _nearest(integers: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroids, in 64 bits if both sides are small enough."""
    limit = _SMALL * integers.shape[1]
    if integers.dtype != object and max(abs(int(c)) for c in centroids.flat) <= limit:
        return nearest(walsh(integers), centroids.astype(np.int64))
    return nearest(walsh(integers.astype(object)), centroids)
