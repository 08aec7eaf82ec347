"""Exact nearest neighbours by joins on buckets of rows.

Rows are dealt to the nearest of a bounded number of pivots, and the rows of a pivot, by their distance to it, to buckets of bounded size.  A query meets its own bucket first;
the distance of the k-th row found there bounds what is still of use, and by the triangle inequality it goes only to those other buckets that may hold
a nearer row.  In a task the rows of a bucket are held as one matrix, and the queries that go there stream past it, so what is shuffled is each row twice and a query
for each bucket it goes to, and k rows for each of these; no pair of vectors ever is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookout.operators.store import Scratch, ship

#: Pivots at most; stretches of distance that a pivot's rows are counted by; rows of a bucket, about; queries that are compared at a time.
PIVOTS, RINGS, BUCKET, QUERIES = 128, 64, 32_768, 256
#: Pairs of a query and a bucket that a task looks at a time, and those of them that it gives in one batch with the query's vector.
PAIRS, SENT = 1 << 18, 2048

_FOUND = "query long, neighbour long, distance double, compared long"


class Buckets:
    """Where rows lie: pivots, and for each (pivot, ring) its first bucket and how many share it; and for each bucket the least and greatest distance to its pivot."""

    def __init__(self, pivots: np.ndarray, widest: np.ndarray, counts: dict[tuple[int, int], int], bucket: int):
        self.pivots, self.widest = pivots, np.maximum(widest, 1e-12)
        self.first, self.share = {}, {}
        low, high, of = [], [], []
        for p in range(len(pivots)):
            room, step = 0, self.widest[p] / RINGS
            for ring in (r for r in range(RINGS) if (p, r) in counts):
                n = counts[p, ring]
                if n > room:  # a new bucket, or as many as one ring alone needs
                    share = -(-n // bucket)
                    self.first[p, ring], self.share[p, ring] = len(low), share
                    low += [ring * step] * share
                    high += [(ring + 1) * step] * share
                    of += [p] * share
                    room = bucket - n if share == 1 else 0
                else:
                    self.first[p, ring], self.share[p, ring] = len(low) - 1, 1
                    high[-1] = (ring + 1) * step
                    room -= n
        self.low, self.high, self.of = np.array(low), np.array(high), np.array(of, np.int64)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([((x - p) ** 2).sum(1) for p in self.pivots], 1))

    def ring(self, far: np.ndarray, own: np.ndarray) -> np.ndarray:
        return np.minimum((far / self.widest[own] * RINGS).astype(np.int64), RINGS - 1)

    def place(self, pivot: int, ring: int, turn: int) -> int:
        """The bucket of a ring, one of those that share it; of a ring without rows, which only a query can be in, that of the nearest one with."""
        at = (pivot, ring) if (pivot, ring) in self.first else min(self.first, key=lambda k: (k[0] != pivot, abs(k[1] - ring), k))
        return self.first[at] + turn % self.share[at]

    def home(self, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of each row, and its distances to all pivots."""
        far = self.distances(x)
        own = far.argmin(1)
        rings = self.ring(far[np.arange(len(x)), own], own)
        turns = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return np.array([self.place(*k) for k in zip(own.tolist(), rings.tolist(), turns.tolist(), strict=True)], np.int64), far

    def may_hold(self, far: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """queries by buckets: whether a row at `bound` or nearer can lie there, as |q - p| and |r - p| differ by |q - r| at most, and r is no nearer to another pivot."""
        to = far[:, self.of]
        least = np.maximum(np.maximum(to - self.high, self.low - to), (to - far.min(1)[:, None]) / 2)
        return least <= bound[:, None] * (1 + 1e-9) + 1e-7  # distances are rounded to 9 digits


def _vectors(batch: pa.RecordBatch, at: int) -> np.ndarray:
    column = batch.column(at)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)


def _nearest_in_buckets(batches, k: int, most_queries: int):
    """Rows of (bucket, is_query, id, embedding) in that order -> each query's k nearest rows of the bucket, and with how many it was compared."""
    bucket, ids, x = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        v, own, kinds, buckets = _vectors(batch, 3), batch.column(2).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(0).to_numpy()
        cuts = np.flatnonzero((np.diff(buckets) != 0) | (np.diff(kinds.astype(np.int8)) != 0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)], strict=True):
            if buckets[start] != bucket:
                bucket, ids, x = buckets[start], [], []
            if not kinds[start]:
                ids.append(own[start:end]), x.append(v[start:end])
                continue
            if not ids:
                continue
            if len(ids) > 1:
                ids, x = [np.concatenate(ids)], [np.concatenate(x)]
            for at in range(start, end, most_queries):
                yield _best(own[at : min(end, at + most_queries)], v[at : min(end, at + most_queries)], ids[0], x[0], k)


def _best(queries: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pa.RecordBatch:
    """A product of matrices finds candidates, a little beyond the k-th; their distances are then taken one by one, as the product loses digits."""
    rough = (q * q).sum(1)[:, None] - 2 * (q @ x.T) + (x * x).sum(1)[None, :]
    out = []
    slack = 1e-9 * (1 + (x * x).sum(1).max() + (q * q).sum(1).max())
    for i, query in enumerate(queries):
        row = np.where(ids == query, np.inf, rough[i])
        last = np.partition(row, k - 1)[k - 1] if len(row) > k else np.inf
        near = np.flatnonzero((row <= last + slack) & (ids != query))
        d = np.round(np.sqrt(((x[near] - q[i]) ** 2).sum(1)), 9)
        for j in np.lexsort((ids[near], d))[:k]:
            out.append((query, ids[near[j]], d[j], 0))
        out.append((query, None, None, len(ids) - int((ids == query).sum())))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)], ["query", "neighbour", "distance", "compared"])


def _met(rows: DataFrame, queries: DataFrame, k: int, most_queries: int) -> DataFrame:
    """rows and queries with their buckets -> query, neighbour, distance and compared."""
    both = rows.select("bucket", F.lit(False).alias("is_query"), "id", "embedding").unionByName(queries.select("bucket", F.lit(True).alias("is_query"), "id", "embedding"))
    return both.repartition("bucket").sortWithinPartitions("bucket", "is_query").mapInArrow(lambda batches: _nearest_in_buckets(batches, k, most_queries), _FOUND)


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """Of what several buckets gave for a query the k best, and the sum of its comparisons."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("distance").asc_nulls_last(), "neighbour"))  # k rows a bucket, and one
    return found.withColumns({"compared": F.sum("compared").over(Window.partitionBy("query")), "rank": place}).where((F.col("rank") <= k) & F.col("neighbour").isNotNull())


def _buckets(rows: DataFrame, pivots: int, bucket: int, seed: int) -> Buckets:
    """Pivots are the first distinct vectors in a seeded order; two passes count what lies where: pivots times rings, at most."""
    first = rows.select(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string"))).alias("h"), "embedding").orderBy("h").limit(pivots)
    points = np.unique(np.array([r["embedding"] for r in first.collect()], np.float64), axis=0)
    every = Buckets(points, np.ones(len(points)), {}, bucket)

    def sized(batches):
        for batch in batches:
            if batch.num_rows:
                far = every.distances(_vectors(batch, 1))
                own = far.argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(far[np.arange(len(own)), own])], ["pivot", "far"])

    near = rows.select("id", "embedding").mapInArrow(sized, "pivot long, far double")
    widest = np.zeros(len(points))
    for r in near.groupBy("pivot").agg(F.max("far").alias("far")).collect():
        widest[r["pivot"]] = r["far"]
    wide = F.array(*[F.lit(float(w)) for w in np.maximum(widest, 1e-12)])  # one number a pivot
    ring = F.least(F.floor(F.col("far") / F.element_at(wide, (F.col("pivot") + 1).cast("int")) * RINGS), F.lit(RINGS - 1))
    counts = {(r["pivot"], r["ring"]): r["count"] for r in near.groupBy("pivot", ring.alias("ring")).count().collect()}
    return Buckets(points, widest, counts, bucket)


def nearest(queries: DataFrame, rows: DataFrame, k: int = 2, block: str | None = None, most_queries: int = QUERIES, pivots: int = PIVOTS, bucket: int = BUCKET, seed: int = 0) -> DataFrame:
    """query, neighbour, distance, rank, compared: the k nearest rows (id, embedding) to each query (id, embedding), by Euclidean distance rounded to 9 digits, ties to the least id; a row isn't its
    own neighbour.  compared: with how many rows the query was compared; most_queries: how many are at a time.

    With `block`, a column of both, only rows of the query's block are neighbours, and a block's rows are dealt evenly to buckets by their ids.  Rows without
    an id or a vector are left out; a query with fewer than k others gets as many as there are; vectors have one length and no nulls.
    """
    spark = rows.sparkSession
    ship(spark)
    both = ["id", "embedding", *([block] if block else [])]
    fine = F.col("id").isNotNull() & F.col("embedding").isNotNull()
    rows, queries = (x.where(fine).select(F.col("id").cast("long").alias("id"), *both[1:]) for x in (rows, queries))
    with Scratch(spark) as scratch:
        if block:
            shares = scratch.cut(rows.groupBy(block).agg(F.ceil(F.count("*") / bucket).cast("int").alias("share")))
            name = lambda part: F.xxhash64(block, part)
            dealt = rows.join(shares, block).withColumn("bucket", name(F.pmod(F.xxhash64("id"), F.col("share")).cast("int")))
            sent = queries.join(shares, block).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("share") - 1))).withColumn("bucket", name(F.col("part")))
            found = scratch.cut(_met(dealt, sent, k, most_queries))
            return _best_of(scratch.keep(found), k).select("query", "neighbour", "distance", "rank", "compared")
        of = _buckets(rows, pivots, bucket, seed)
        if not len(of.pivots):
            return spark.createDataFrame([], "query long, neighbour long, distance double, rank int, compared long")
        shared = spark.sparkContext.broadcast(of)  # PIVOTS vectors, and a few numbers for each of their rings

        def home(batches):
            for batch in batches:
                if batch.num_rows:
                    buckets, _ = shared.value.home(batch.column(0).to_numpy(), _vectors(batch, 1))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(buckets)], ["id", "embedding", "bucket"])

        def others(batches):
            """Queries with the distance that their k-th row must beat (null: any), to the buckets that may have one, but for the one they have met."""
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, x = batch.column(0).to_numpy(), _vectors(batch, 1)
                own, far = shared.value.home(ids, x)
                bound = np.array([np.inf if b is None else b for b in batch.column(2).to_pylist()])
                step = max(1, min(most_queries, PAIRS // len(shared.value.of)))
                for at in range(0, len(ids), step):
                    may = shared.value.may_hold(far[at : at + step], bound[at : at + step])
                    may[np.arange(len(may)), own[at : at + step]] = False
                    q, b = np.nonzero(may)
                    for piece in range(0, len(q), SENT):
                        some = pa.array(at + q[piece : piece + SENT])
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(some), batch.column(1).take(some), pa.array(b[piece : piece + SENT])], ["id", "embedding", "bucket"])

        kind = f"id long, embedding {rows.schema['embedding'].dataType.simpleString()}, bucket long"
        dealt = scratch.cut(rows.mapInArrow(home, kind))
        sent = queries.select("id", "embedding").mapInArrow(home, kind)
        first = scratch.cut(_met(dealt, sent, k, most_queries))
        kth = _best_of(first, k).groupBy("query").agg(F.max(F.when(F.col("rank") == k, F.col("distance"))).alias("bound"))
        bounded = queries.select("id", "embedding").join(kth, F.col("id") == F.col("query"), "left").select("id", "embedding", "bound")
        second = scratch.cut(_met(dealt, bounded.mapInArrow(others, kind), k, most_queries))
        return _best_of(scratch.keep(first).unionByName(scratch.keep(second)), k).select("query", "neighbour", "distance", "rank", "compared")
