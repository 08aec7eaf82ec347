"""Packing of neighbouring documents along a space-filling curve.

Method: a document's tokens are counted in hashed buckets; the vector of their damped counts, of length 1, is projected to a few dimensions by a fixed random
matrix, and each dimension is spread evenly by its mean and deviation over the corpus.  The Hilbert key of that point orders the documents: a
sort by range of the keys gives a line on which texts alike lie side by side, equal texts next to each other.  The line of all tokens is cut
into sequences of full capacity; what is left at its end is cut at powers of two, so no token is padding.  Where a document lies is the sum of what
comes before: within a task a running sum, and of each task one number.

Token ids are shuffled once, by the sort; all else of a document is a few numbers.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import materialise, mix, prepare, temporary, texts, tidy, tokenizer_path
from lookout.llm.packing import CAPACITY, token_bytes

#: Hashed buckets of a vector, dimensions of the curve, and bits of each: 60 bits are a key.
BUCKETS, DIMENSIONS, BITS = 512, 4, 15
#: Projections are kept as whole numbers of this fraction, so that their sums are exact in any order.
UNIT = 1 << 20

_TOKENS = "doc_id long, doc_tokens long, crc long, row long, " + ", ".join(f"p{i} long" for i in range(DIMENSIONS)) + ", ids binary"
_ORDERED = "doc_id long, doc_tokens long, part long, at long, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of whole points (n by dimensions) of `bits` bits a dimension; neighbours on the curve differ by 1 in one dimension."""
    x = [c.astype(np.uint64).copy() for c in points.T]
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):  # undo the turns of the sub-cubes, from the largest down
        bit, below = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(len(x)):
            inside = (x[i] & bit) != 0
            swap = np.where(inside, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] = np.where(inside, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flips = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, 0, -1):
        flips = np.where((x[-1] & np.uint64(1 << b)) != 0, flips ^ np.uint64((1 << b) - 1), flips)
    out = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, -1, -1):
        for c in x:
            out = (out << one) | (((c ^ flips) >> np.uint64(b)) & one)
    return out.astype(np.int64)


def projections(counts: np.ndarray, seed: int = 12) -> np.ndarray:
    """Hashed counts (n by BUCKETS) -> their damped, normed vectors in DIMENSIONS dimensions, in UNITs; without a token all 0."""
    v = np.log1p(counts.astype(np.float32))
    v /= np.maximum(1e-9, np.sqrt((v * v).sum(1, keepdims=True)))
    return np.round(v @ np.random.default_rng(seed).normal(size=(BUCKETS, DIMENSIONS)).astype(np.float32) * UNIT).astype(np.int64)


def _tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Of each document its id, tokens, their ids (16 bits each if all fit, else 32), projections and a place that tells equal rows apart."""
    path, end = tokenizer_path(tokenizer), np.array([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        bucket = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
        for batch in batches:
            n, crc, packed, counts = [], [], [], []
            for b in token_bytes(texts(batch), path):
                ids = np.frombuffer(b, "<u4")
                small = not len(ids) or ids.max() < 1 << 16
                counts.append(np.bincount(bucket[ids] if small else (mix(ids.astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS))
                b += end
                n.append(len(b) // 4), crc.append(zlib.crc32(b))
                packed.append(np.frombuffer(b, "<u4").astype("<u2").tobytes() if small and end_id < 1 << 16 else b)
            if not n:
                continue
            p = projections(np.array(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.arange(row, row + len(n))), *(pa.array(c) for c in p.T.copy()), pa.array(packed, pa.binary())], ["doc_id", "doc_tokens", "crc", "row", *(f"p{i}" for i in range(DIMENSIONS)), "ids"])
            row += len(n)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), _TOKENS)


def _keyed(tokens: DataFrame) -> DataFrame:
    """Adds `key`: the place on the curve, with each dimension spread by the logistic curve of its distance from the mean in deviations."""
    p = [f"p{i}" for i in range(DIMENSIONS)]
    number = lambda c: F.col(c).cast("decimal(20,0)")
    sums = tokens.agg(F.count("*").alias("n"), *[F.sum(number(c)).alias(c) for c in p], *[F.sum((number(c) * number(c)).cast("decimal(38,0)")).alias(f"{c}_2") for c in p]).first()  # one row
    n = max(1, sums["n"])
    mean = [int(sums[c] or 0) / n for c in p]
    deviation = [max(1.0, max(0.0, int(sums[f"{c}_2"] or 0) / n - m * m) ** 0.5) for c, m in zip(p, mean, strict=True)]

    @F.arrow_udf("long")
    def key(*columns: pa.Array) -> pa.Array:
        x = (np.stack([c.to_numpy(zero_copy_only=False) for c in columns], 1) - np.array(mean)) / np.array(deviation)
        even = (1 << BITS) / (1 + np.exp(-1.702 * np.clip(x, -30, 30)))
        return pa.array(hilbert(np.minimum(even, (1 << BITS) - 1).astype(np.int64)))

    return tokens.withColumn("key", key(*p))


def _placed(ordered: DataFrame) -> DataFrame:
    """Sorted rows with the task they lie in and how many tokens come before them there."""

    def run(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            at = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.full(len(n), part)), pa.array(at), batch.column(2)], ["doc_id", "doc_tokens", "part", "at", "ids"])

    return ordered.select("doc_id", "doc_tokens", "ids").mapInArrow(tidy(run), _ORDERED)


def tail(total: int, capacity: int = CAPACITY) -> list[int]:
    """Where the sequences begin that hold what full ones leave over, and where the last ends: lengths are powers of two, the largest first."""
    at = [total // capacity * capacity]
    left = total - at[0]
    while left:
        at.append(at[-1] + (1 << (left.bit_length() - 1)))
        left = total - at[-1]
    return at


def pack_along_curve(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k.json", end_id: int = 1) -> DataFrame:
    """A row for each piece of each document: doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian unsigned, 32 bits each).

    A document is its ids, then end_id; a null or empty text is end_id alone.  Null doc_ids and repeated rows are packed like any other; equal texts stand in order of
    doc_id, null first; rows that tie in all are alike.  A very long text goes over many sequences; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    with temporary(spark) as keep:
        tokens = _keyed(materialise(_tokens(docs, tokenizer, end_id), "tokens"))
        order = ["key", "doc_id", "doc_tokens", "crc", "row"]
        ranged = tokens.select(*order, "ids").repartitionByRange(*order).sortWithinPartitions(*order)
        ordered = keep(materialise(_placed(ranged), "curve"))
    sums = sorted((r["part"], r["n"]) for r in ordered.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect())  # a row for each task of the sort
    first, total = {}, 0
    for part, n in sums:
        first[part], total = total, total + n
    ends = tail(total, capacity)
    shared = spark.sparkContext.broadcast(first)

    def cut(batches):
        full, rest = ends[0], np.array(ends)
        for batch in batches:
            out = []
            for doc_id, n, part, at, packed in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                begin = shared.value[part] + at
                ids = packed if len(packed) == 4 * n else np.frombuffer(packed, "<u2").astype("<u4").tobytes()
                place = begin
                while place < begin + n:
                    if place < full:
                        sequence, offset = divmod(place, capacity)
                        to = place - offset + capacity
                    else:
                        k = int(np.searchsorted(rest, place, "right")) - 1
                        sequence, offset, to = full // capacity + k, place - ends[k], ends[k + 1]
                    to = min(to, begin + n)
                    out.append((doc_id, place - begin, to - place, n, sequence, offset, ids[4 * (place - begin) : 4 * (to - begin)]))
                    place = to
            columns = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return ordered.mapInArrow(tidy(cut), _PIECES)


def curve_digest(docs: DataFrame) -> DataFrame:
    """pack_along_curve() with each piece's crc32 in place of its ids."""
    return pack_along_curve(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
