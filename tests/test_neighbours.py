"""Nearest neighbours by buckets against all pairs, and what the buckets spare."""

import random

import pytest
from pyspark.sql import functions as F

from lookout.operators import neighbours


def plain(rows, queries, k, block=None):
    out = set()
    for q, v, *b in queries:
        near = sorted((round(sum((a - c) ** 2 for a, c in zip(v, x, strict=True)) ** 0.5, 9), i) for i, x, *o in rows if i != q and o == b)[:k]
        out |= {(q, i, d, r) for r, (d, i) in enumerate(near, 1)}
    return out


def got(df):
    rows = df.collect()
    assert len(rows) == len({(r["query"], r["rank"]) for r in rows})
    return {(r["query"], r["neighbour"], r["distance"], r["rank"]) for r in rows}


def clustered(n, seed, d=3, spread=0.05):
    rng = random.Random(seed)
    return [(7 * i, [rng.choice([0, 4, 9]) + rng.gauss(0, spread) for _ in range(d)]) for i in range(n)]


@pytest.mark.parametrize("seed,pivots,bucket,k", [(1, 8, 10, 2), (2, 1, 5, 3), (3, 128, 1000, 1), (4, 5, 1, 4)])
def test_against_all_pairs(spark, seed, pivots, bucket, k):
    """Copies in plenty, ties, queries that are no rows, and more neighbours wanted than a bucket holds."""
    rows = clustered(80, seed) + [(1000 + i, [4.0, 4.0, 4.0]) for i in range(25)] + [(2000 + i, [float(i % 3), 0.0, 0.0]) for i in range(9)]
    queries = rows[::9] + [(-5, [100.0, -50.0, 3.0]), (-6, [4.0, 4.0, 4.0])]
    make = lambda x: spark.createDataFrame(x, "id long, embedding array<double>")
    assert got(neighbours.nearest(make(queries), make(rows).repartition(3), k, pivots=pivots, bucket=bucket, most_queries=3)) == plain(rows, queries, k)


def test_blocks(spark):
    rng = random.Random(5)
    rows = [(i, [rng.random(), rng.random()], rng.choice(["a", "b", "hot", "hot", "hot"])) for i in range(90)] + [(500, [0.5, 0.5], "alone")]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, site string")
    queries = rows[::8] + rows[-1:]
    found = neighbours.nearest(spark.createDataFrame(queries, df.schema), df, 2, block="site", bucket=7)
    assert got(found) == plain(rows, queries, 2)


def test_pruning_spares_most(spark):
    """Where vectors lie in groups, a query is compared with its group, not with all; and nothing is collected but counts."""
    rows = clustered(600, 6)
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    found = neighbours.nearest(df.where("id % 5 = 0"), df, 2, pivots=32, bucket=20).cache()
    assert got(found) == plain(rows, [r for r in rows if r[0] % 5 == 0], 2)
    assert found.agg(F.avg("compared")).first()[0] < len(rows) / 4


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, [0.0]), (None, [1.0]), (3, None)], "id long, embedding array<double>")
    assert neighbours.nearest(df, df, 2).collect() == []
    assert neighbours.nearest(df.limit(0), df, 2).collect() == []
    assert neighbours.nearest(df, df.limit(0), 2).collect() == []
