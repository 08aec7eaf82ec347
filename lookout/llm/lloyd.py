"""Centroid clustering by delta Lloyd rounds over integer vectors.

Vectors are written once, packed into blocks, in a table bucketed by block.  What a round persists is a second table with the same buckets: for each
block its vectors' owners and their distances to them, and the signed sums that the round moved between clusters.  A round joins the two without
a shuffle and compares a vector whose owner's centroid moved with all centroids, any other one only with the centroids that moved, as its
own distance still holds.  Global counts and sums are k * dimensions integers; a round adds the transfers to them.  All arithmetic is
exact, so results don't depend on partitioning, and a round in which no centroid moved ends the rounds, as all later ones would be alike.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.llm.common import drop, prepare, register, shared_dir, temporary, tidy

#: Vectors of a block, and of a bucket about.
BLOCK, BUCKET = 1024, 1 << 19
#: Largest component after scaling: squared distances of 64 components fit a long then.
MOST = 1 << 27

_TRANSFERS = "array<struct<cluster:int,n:long,sums:array<long>>>"


@dataclass
class Clusters:
    """What delta_lloyd gives: rows(vec_id, cluster, distance), the centroids, and how many comparisons each pass made."""

    rows: DataFrame
    centroids: np.ndarray
    compared: list[int]


def _bucketed(df: DataFrame, label: str, buckets: int) -> DataFrame:
    """Writes df as a table bucketed by `block` in the shared folder; only its files stay, not its name."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    df.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).option("path", path).bucketBy(buckets, "block").saveAsTable(name)
    out = spark.table(name)
    out.schema  # noqa: B018  resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return register(path, out)


def whole_vectors(rows: DataFrame, dimensions: int = 64, scale: int = 1024) -> DataFrame:
    """vec_id and v: floor(scale * x) of the embeddings with exactly `dimensions` components, none null or non-finite; the others go."""
    x = F.transform("embedding", lambda x: x.cast("double"))
    fine = (F.size("embedding") == dimensions) & ~F.exists(x, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda x: F.floor(x * scale)).alias("v"))


def _blocks(vectors: DataFrame, dimensions: int, most: int) -> DataFrame:
    """block, n, ids and packed vectors: the rows of a partition, BLOCK at a time."""

    def run(batches):
        from pyspark import TaskContext

        first, made, ids, rows, waiting = TaskContext.get().partitionId() << 32, 0, [], [], 0

        def packed(last: bool):
            nonlocal made, ids, rows, waiting
            own, x = np.concatenate(ids), np.concatenate(rows)
            end = len(own) if last else len(own) - len(own) % BLOCK
            for at in range(0, end, BLOCK):
                to = min(at + BLOCK, end)
                yield pa.RecordBatch.from_arrays([pa.array([first + made], pa.int64()), pa.array([own[at:to].tolist()], pa.list_(pa.int64())), pa.array([x[at:to].astype("<i4").tobytes()], pa.binary())], ["block", "ids", "vectors"])
                made += 1
            ids, rows, waiting = [own[end:]], [x[end:]], len(own) - end

        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            if ((x > most) | (x < -most)).any():
                raise ValueError(f"a vector has a component beyond {most} after scaling: squared distances may not fit a long")
            ids.append(np.array(batch.column(0).to_pylist(), object)), rows.append(x)
            waiting += len(x)
            if waiting >= BLOCK:
                yield from packed(False)
        if waiting:
            yield from packed(True)

    return vectors.select("vec_id", "v").mapInArrow(tidy(run), "block long, ids array<long>, vectors binary")


def nearest(x: np.ndarray, centroids: np.ndarray, owner: np.ndarray, distance: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """New owners and distances (ties to the smaller number), and how many pairs were compared.  owner -1: none so far."""
    lost = (owner < 0) | moved[owner]
    owner, distance = np.where(lost, len(centroids), owner), np.where(lost, np.iinfo(np.int64).max, distance)
    compared = 0
    for j, centroid in enumerate(centroids):
        own = np.arange(len(x)) if moved[j] else np.flatnonzero(lost)
        d = x[own] - centroid
        d = np.einsum("ij,ij->i", d, d)
        closer = (d < distance[own]) | ((d == distance[own]) & (j < owner[own]))
        owner[own[closer]], distance[own[closer]] = j, d[closer]
        compared += len(own)
    return owner, distance, compared


def _step(pairs: DataFrame, centroids: np.ndarray, moved: np.ndarray) -> DataFrame:
    """block, owners, distances and transfers of blocks with their owners and distances so far (null: none); cluster -1 stands for the pairs compared."""
    dimensions, k = centroids.shape[1], len(centroids)

    def run(batches):
        for batch in batches:
            out = {c: [] for c in ("block", "owners", "distances", "transfers")}
            for block, packed, had, far in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                x = np.frombuffer(packed, "<i4").reshape(-1, dimensions).astype(np.int64)
                before = np.full(len(x), -1) if had is None else np.frombuffer(had, "<i4").astype(np.int64)
                owner, distance, compared = nearest(x, centroids, before, np.zeros(len(x), np.int64) if far is None else np.frombuffer(far, "<i8"), moved)
                went = np.flatnonzero(owner != before)
                n, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
                np.add.at(n, owner[went], 1)
                np.add.at(sums, owner[went], x[went])
                left = went[before[went] >= 0]
                np.subtract.at(n, before[left], 1)
                np.subtract.at(sums, before[left], x[left])
                touched = sorted({*owner[went].tolist(), *before[left].tolist()})
                for c, v in zip(out, (block, owner.astype("<i4").tobytes(), distance.astype("<i8").tobytes(), [{"cluster": -1, "n": compared, "sums": []}, *({"cluster": j, "n": int(n[j]), "sums": sums[j].tolist()} for j in touched)]), strict=True):
                    out[c].append(v)
            kind = pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))
            yield pa.RecordBatch.from_arrays([pa.array(out["block"], pa.int64()), pa.array(out["owners"], pa.binary()), pa.array(out["distances"], pa.binary()), pa.array(out["transfers"], kind)], list(out))

    return pairs.select("block", "vectors", "owners", "distances").mapInArrow(tidy(run), f"block long, owners binary, distances binary, transfers {_TRANSFERS}")


def _transfers(state: DataFrame, k: int, dimensions: int) -> tuple[list[list[int]], int]:
    """For each cluster what a round adds to its count and its sums, and the comparisons of the round."""
    each = state.select(F.explode("transfers").alias("t")).select("t.cluster", F.posexplode(F.concat(F.array("t.n"), F.col("t.sums"))).alias("at", "x"))
    out, compared = [[0] * (dimensions + 1) for _ in range(k)], 0
    for r in each.groupBy("cluster", "at").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("x")).collect():  # k * (dimensions + 1) rows and one
        if r["cluster"] < 0:
            compared = int(r["x"])
        else:
            out[r["cluster"]][r["at"]] = int(r["x"])
    return out, compared


def seeds(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `<seed>:<vec_id>`; null ids last, equal ones by their components."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return np.array([r["v"] for r in vectors.select(hashed.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()], np.int64)


def delta_lloyd(rows: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024, seed: int = 3) -> Clusters:
    """Clusters rows(vec_id, embedding) by `rounds` of Lloyd's method from the seeds() on, then assigns once more.

    Embeddings that are null, of another length, or with a null or non-finite component go.  Repeated rows each count, a null vec_id is kept like any other;
    equal vectors have one cluster, ties go to the smaller number.  With fewer than k vectors each is a centroid; an empty table gives no rows.  Other
    columns are ignored.  A component beyond 2**27 after scaling is an error.
    """
    spark: SparkSession = rows.sparkSession
    prepare(spark)
    vectors = whole_vectors(rows, dimensions, scale)
    centroids = seeds(vectors, k, seed)
    k = len(centroids)
    if not k:
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dimensions), np.int64), [])
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BUCKET))
    with temporary(spark) as keep:
        blocks = keep(_bucketed(_blocks(vectors, dimensions, MOST).repartition(buckets, "block"), "vectors", buckets))
        none = blocks.withColumns({"owners": F.lit(None).cast("binary"), "distances": F.lit(None).cast("binary")})
        state, compared = None, []
        totals, moved = [[0] * (dimensions + 1) for _ in range(k)], np.ones(k, bool)
        for at in range(rounds + 1):
            pairs = none if state is None else blocks.select("block", "vectors").join(state.select("block", "owners", "distances").hint("shuffle_hash"), "block")
            new = _bucketed(_step(pairs, centroids, moved), "owners", buckets)
            if state is not None:
                drop(state)
            state = new
            added, n = _transfers(state, k, dimensions)
            compared.append(n)
            if at == rounds:
                break
            totals = [[a + b for a, b in zip(*x, strict=True)] for x in zip(totals, added, strict=True)]
            after = np.array([[s // own[0] for s in own[1:]] if own[0] else centroids[j].tolist() for j, own in enumerate(totals)], np.int64)
            moved = (after != centroids).any(1)
            centroids = after
            if not moved.any():
                break
        keep(state)

    def unpack(batches):
        for batch in batches:
            for ids, owners, distances in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.frombuffer(owners, "<i4")), pa.array(np.frombuffer(distances, "<i8"))], ["vec_id", "cluster", "distance"])

    both = blocks.select("block", "ids").join(state.select("block", "owners", "distances").hint("shuffle_hash"), "block")
    return Clusters(both.select("ids", "owners", "distances").mapInArrow(tidy(unpack), "vec_id long, cluster int, distance long"), centroids, compared)


def clustered(rows: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of delta_lloyd()'s clusters; odd rows as there."""
    found = delta_lloyd(rows, k, rounds, dimensions)
    own = {r["cluster"]: int(r["s"]) for r in found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # k rows at most
    table = [(j, own.get(j, 0), sum(own.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(found.centroids.tolist())]
    of = rows.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
