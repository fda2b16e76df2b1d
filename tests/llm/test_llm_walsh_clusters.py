"""Clusters of integer vectors against plain distances."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from clickpulse.llm.oracles import ORACLES
from clickpulse.llm.queries import QUERIES
from clickpulse.llm.walsh_clusters import cluster_vectors, nearest, walsh


def brute(rows, k, rounds, size, scale=1024, seed=3):
    """All rounds with whole distances; rows are (id, vector)."""
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    draw = lambda i: "￿" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted((draw(i), v) for i, v in kept)[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [assign(v)[1] for _, v in kept]
        groups = [[v for (_, v), n in zip(kept, own) if n == c] for c in range(len(centroids))]
        centroids = [
            [sum(x) // len(group) for x in zip(*group)] if group else old
            for group, old in zip(groups, centroids)
        ]
    found = [(i, *reversed(assign(v))) for i, v in kept]
    inertia = [sum(d for _, n, d in found if n == c) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, inertia[n], sum(inertia), digests[n]) for i, n, d in found]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_transform():
    vectors = np.random.default_rng(1).integers(-50, 50, (5, 8))
    spectra = walsh(vectors)
    assert (spectra[:, 0] == vectors.sum(axis=1)).all()
    assert (spectra[:, 1] == vectors[:, :4].sum(axis=1) - vectors[:, 4:].sum(axis=1)).all()
    assert ((spectra**2).sum(axis=1) == 8 * (vectors**2).sum(axis=1)).all()


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_nearest_with_ties(spread):
    pick = np.random.default_rng(spread)
    vectors, centroids = (pick.integers(-spread, spread + 1, (n, 16)) for n in (300, 6))
    apart = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    number, distance = nearest(walsh(vectors), walsh(centroids))
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_query_equals_sql_and_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    result = QUERIES["op12_walsh_clusters"](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    sql = con.execute(ORACLES["op12_walsh_clusters"])
    assert result.columns == [c[0] for c in sql.description]
    got = ordered(result.collect())
    assert got == ordered(sql.fetchall())
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    assert got == ordered(brute(rows, 8, 10, 64))


SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance string, vector string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(parts)


def odd_rows():
    pick = random.Random(5)
    rows = [(n, [pick.uniform(-1, 1) for _ in range(4)]) for n in range(40)]
    rows += rows[:3] + [(7, [0.5] * 4), (None, [0.25] * 4), (None, [0.25] * 4), (41, None), (42, [])]
    rows += [(43, [1.0] * 5), (44, [1.0, None, 1.0, 1.0]), (45, [math.nan] * 4), (46, [math.inf] * 4)]
    return rows


@pytest.mark.parametrize("k", [1, 3, 60])
def test_odd_rows(spark, k):
    rows = odd_rows()
    result = cluster_vectors(frame(spark, rows), k=k, rounds=4, size=4)
    assert ordered(result.collect()) == ordered(brute(rows, k, 4, 4))


def test_large_components(spark):
    rows = [(n, [float(n % 3 * 5000), -1e6 * (n % 2), 0.0, 1.0]) for n in range(12)]
    result = cluster_vectors(frame(spark, rows), k=3, rounds=3, size=4)
    assert ordered(result.collect()) == ordered(brute(rows, 3, 3, 4))


def test_a_third_of_all_vectors_alike(spark):
    pick = random.Random(2)
    rows = [(n, [0.5, 0.5, -0.5, 0.0]) for n in range(100)]
    rows += [(n, [pick.uniform(-1, 1) for _ in range(4)]) for n in range(100, 300)]
    result = cluster_vectors(frame(spark, rows), k=4, rounds=5, size=4)
    assert ordered(result.collect()) == ordered(brute(rows, 4, 5, 4))


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        result = cluster_vectors(frame(spark, rows, 1), size=4)
        assert result.collect() == [] and result.columns[0] == "vec_id"


def test_size_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        cluster_vectors(frame(spark, []), size=6)
