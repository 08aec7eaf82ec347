"""Delta Lloyd rounds against plain ones over Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lookout.llm.lloyd import clustered, delta_lloyd, nearest

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k, rounds, dimensions):
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for at in range(rounds + 1):
        owner = [min((far(v, c), j) for j, c in enumerate(centroids))[::-1] for _, v in kept]
        if at < rounds:
            for j in range(len(centroids)):
                own = [v for (_, v), (o, _) in zip(kept, owner, strict=True) if o == j]
                if own:
                    centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    inertia = [sum(d for o, d in owner if o == j) for j in range(len(centroids))]
    return sorted(((i, o, d, inertia[o], sum(inertia), hashlib.sha256(",".join(map(str, centroids[o])).encode()).hexdigest()) for (i, _), (o, d) in zip(kept, owner, strict=True)), key=str)


def vectors(n, dimensions, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(rng.choice([-2, 0, 2]), 0.5) for _ in range(dimensions)]) for i in range(n)]
    return rows + [(n + j, rows[0][1]) for j in range(n // 3)] + [rows[1], (None, rows[2][1])]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,k,rounds,partitions", [(1, 3, 10, 1), (2, 8, 4, 5), (3, 8, 0, 3)])
def test_against_plain_rounds(spark, seed, k, rounds, partitions):
    rows = vectors(60, 4, seed)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit(1), "cluster": F.lit("x")}).repartition(partitions)
    assert got(clustered(df, k, rounds, 4)) == plain(rows, k, rounds, 4)


def test_odd_vectors_go(spark):
    rows = [(1, [0.5, 1.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0, float("-inf")]), (7, [-0.0001, 2.0]), (None, [3.0, 3.0]), (7, [-0.0001, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(clustered(df, 2, 3, 2)) == plain(rows, 2, 3, 2)
    assert {r["vec_id"] for r in clustered(df, 2, 3, 2).collect()} == {1, 7, None}
    assert clustered(df.where("vec_id = 2"), 2, 3, 2).collect() == []
    assert clustered(df.limit(0), 2, 3, 2).collect() == []


def test_fewer_vectors_than_clusters(spark):
    rows = [(1, [0.0, 0.0]), (2, [5.0, 5.0])]
    assert {r["distance"] for r in clustered(spark.createDataFrame(rows, SCHEMA), 8, 10, 2).collect()} == {0}


def test_too_large_is_an_error(spark):
    rows = [(1, [0.0, 0.0]), (2, [1e9, 0.0])]
    with pytest.raises(Exception, match="beyond"):
        clustered(spark.createDataFrame(rows, SCHEMA), 2, 1, 2).collect()


def test_later_rounds_compare_less(spark):
    """Once few centroids move, a round compares few pairs; with none moved there is no further round."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(10 * (i % 4), 0.1), rng.gauss(0, 0.1)]) for i in range(400)]
    found = delta_lloyd(spark.createDataFrame(rows, SCHEMA), 8, 30, 2)
    assert found.compared[0] == 8 * 400
    assert len(found.compared) < 31
    assert min(found.compared) < 8 * 400 / 2


def test_what_is_not_compared_could_not_win():
    rng = np.random.default_rng(7)
    for _ in range(50):
        x, before = rng.integers(-5, 6, (40, 3)), rng.integers(-5, 6, (5, 3))
        owner, distance, _ = nearest(x, before, np.full(40, -1), np.zeros(40, np.int64), np.ones(5, bool))
        after, moved = before.copy(), rng.random(5) < 0.4
        after[moved] = rng.integers(-5, 6, (int(moved.sum()), 3))
        own, far, _ = nearest(x, after, owner, distance, moved)
        all_, want, _ = nearest(x, after, np.full(40, -1), np.zeros(40, np.int64), np.ones(5, bool))
        assert (own == all_).all() and (far == want).all()


def test_rounds_join_without_a_shuffle(spark):
    """Blocks and owners have the same buckets; neither the files' names nor tables of lost rounds stay behind."""
    df = spark.createDataFrame(vectors(60, 4, 9), SCHEMA)
    plan = delta_lloyd(df, 3, 2, 4).rows._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan
    assert spark.catalog.listTables() == []
