"""What several corpus operators share: shared storage, shipping of this package, bounded counting."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The white space that separates words in all contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Ships this package to the executors once, and keeps Arrow batches small enough for long texts.

    The two Arrow settings stay with the session, as results are lazy and need them when they are read.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_lookout_shipped", False):
        top = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="lookout")) / f"lookout_{uuid.uuid4().hex[:8]}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted((top / "lookout").rglob("*.py")):
                z.write(f, f.relative_to(top))
        sc.addPyFile(str(archive))
        sc._lookout_shipped = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, which only local runs may leave unset."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not getattr(sc, "_lookout_dir", None):
        sc._lookout_dir = "file://" + tempfile.mkdtemp(prefix="lookout-checkpoint-")
    return sc._lookout_dir


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cuts lineage: writes df as a table in the shared folder and reads it again.

    The files outlive a lost executor.  They go when a `temporary` block they were written in ends without keeping them, or by clear().
    Row groups are small, as each writing task holds one in memory.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    return register(path, spark.read.schema(df.schema).parquet(path))


def register(path: str, table: DataFrame) -> DataFrame:
    """Notes that the table's files at path are an operator's own, for `temporary`, `drop` and `clear`."""
    _written(table.sparkSession).append((path, table))
    return table


def drop(table: DataFrame) -> None:
    """Removes a table that an operator has written, when nothing will read it any more."""
    written = _written(table.sparkSession)
    for path, _ in (x for x in written if x[1] is table):
        _remove(table.sparkSession, path)
    written[:] = [x for x in written if x[1] is not table]


def _written(spark: SparkSession) -> list[tuple[str, DataFrame]]:
    sc = spark.sparkContext
    if not hasattr(sc, "_lookout_written"):
        sc._lookout_written = []
    return sc._lookout_written


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Yields keep(table).  At the end of the block, the tables written in it go, but for those kept.

    A block must end only after all that reads its tables has been written itself.
    """
    kept: list[int] = []
    written = _written(spark)
    before = len(written)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(id(df))
        return df

    try:
        yield keep
    finally:
        for path, df in written[before:]:
            if id(df) not in kept:
                _remove(spark, path)
        written[before:] = [x for x in written[before:] if id(x[1]) in kept]


def clear(spark: SparkSession) -> None:
    """Removes all tables that operators have written in this session; results that weren't written elsewhere can't be read after it."""
    written = _written(spark)
    while written:
        _remove(spark, written.pop()[0])


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores behind it until no column has it (case doesn't tell names apart)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


_slot: dict = {}


def held(key, make):
    """A large object that a worker process keeps between tasks; there is one at a time, so what another operator has left goes first."""
    if key not in _slot:
        _slot.clear()
        release()
        _slot[key] = make()
    return _slot[key]


def release() -> None:
    """Hands memory that is free in this process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass


def tidy(run):
    """run(batches) for mapInArrow, after which the worker, which lives on for other stages, keeps no free memory."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def learned_split(doc_id: Column, folds: int, held_out: int) -> Column:
    """True where crc32(doc_id as text) mod folds is held_out; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == held_out, F.lit(False))


def offsets_within(df: DataFrame, groups: list[str], order: list[str], weight: str | None, out: str, buckets: int = 1024) -> DataFrame:
    """Adds `out`: the sum of `weight` (None: the number of rows) over the rows of the same group that come earlier.

    The order is by a hash bucket of `order`, then by `order`.  A group of any size is spread over `buckets` windows: the
    buckets are summed first (map side), then a running sum over at most `buckets` rows a group gives where each starts.
    Rows that tie in all of `order` must be interchangeable.  df must be cheap and stable to read twice.
    """
    w = F.lit(1).cast("long") if weight is None else F.col(weight)
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)).cast("int"))
    sums = df.groupBy(*groups, "_bucket").agg(F.sum(w).alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_bucket").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*groups, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_within", F.coalesce(F.sum(w).over(inner), F.lit(0)))
    on = [df[g].eqNullSafe(starts[f"_g{i}"]) for i, g in enumerate(groups)] + [df["_bucket"] == starts["_b"]]
    joined = df.join(starts, functools.reduce(lambda a, b: a & b, on), "left")
    return joined.withColumn(out, (F.col("_start") + F.col("_within")).cast("long")).drop("_bucket", "_within", "_start", "_b", *[f"_g{i}" for i in range(len(groups))])


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on arrays of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shared_sketch(df: DataFrame, keys_of, width_bits: int, slices: int = 64) -> np.ndarray:
    """Counts 64-bit keys in 2**width_bits counters, over all rows of df; returns the counters.

    keys_of(batch) gives an array of uint64 keys of an Arrow batch.  Each task adds up its own rows, then emits its
    counters as `slices` compressed pieces, which are summed by piece.  What is shuffled is a few MB for each
    task at most; what reaches the driver is 4 * 2**width_bits bytes at any input size.
    """
    width = 1 << width_bits
    size = width // slices

    def count(batches):
        import zlib

        total = np.zeros(width, np.uint32)
        for batch in batches:
            keys = keys_of(batch)
            if len(keys):
                total += np.bincount((keys >> np.uint64(64 - width_bits)).astype(np.int64), minlength=width).astype(np.uint32)
        used = [i for i in range(slices) if total[i * size : (i + 1) * size].any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([zlib.compress(total[i * size : (i + 1) * size].tobytes(), 1) for i in used], pa.binary())], ["piece", "counts"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        total = np.zeros(size, np.uint64)
        for batch in batches:
            for blob in batch.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(blob), np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)], pa.binary())], ["piece", "counts"])

    kind = "piece int, counts binary"
    pieces = df.mapInArrow(count, kind).groupBy("piece").applyInArrow(add, kind).collect()
    import zlib

    out = np.zeros(width, np.uint32)
    for r in pieces:
        out[r.piece * size : (r.piece + 1) * size] = np.frombuffer(zlib.decompress(bytes(r.counts)), np.uint32)
    return out


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies: name itself if it is a path, else by the package `public_tokenizers`."""
    if os.path.dirname(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def bounded_sample(rows: DataFrame, group: str, most: int, columns: list[str], seed: int = 29, shown: dict[str, Column] | None = None) -> list:
    """At most `most` rows of each group, those with the lowest seeded hash of doc_id, collected in that order: their columns, or what `shown` makes of them.

    The groups are counted first; then the ids' hashes under a bound that lets about twice `most` through give the exact place
    of the last row to take, so no group, however large, meets in one task, and only rows that are taken leave the executors.  For fitting models only.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("n")).where(F.col(group).isNotNull())
    span = 1 << 31
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(span))
    bound = F.least(F.lit(span), (F.lit(span) * F.lit(2.0 * most + 20) / F.col("n")).cast("long") + 1)
    placed = rows.select(*{*columns, group}, place.alias("_place"), F.xxhash64("doc_id", *columns).alias("_tie"))
    low = placed.join(counts.select(group, bound.alias("_bound")), group).where(F.col("_place") < F.col("_bound"))
    first: dict = {}
    for r in sorted(low.select(group, "_place", "_tie").collect(), key=lambda r: (r["_place"], r["_tie"])):
        own = first.setdefault(r[group], [])
        if len(own) < most:
            own.append((r["_place"], r["_tie"]))
    if not first:
        return []
    last = pa.table({"_group": pa.array(list(first), _arrow_type(rows, group)), "_last": pa.array([own[-1][0] for own in first.values()], pa.int64())})
    last = rows.sparkSession.createDataFrame(last)  # a row for each group
    found = placed.join(last, F.col(group) == F.col("_group")).where(F.col("_place") <= F.col("_last"))
    found = (found if shown is None else found.select(group, "_place", "_tie", *[c.alias(n) for n, c in shown.items()])).collect()
    chosen = {(g, *x) for g, own in first.items() for x in own}
    out, taken = [], {}
    for r in sorted(found, key=lambda r: (r["_place"], r["_tie"])):
        taken[r[group]] = taken.get(r[group], 0) + 1
        if taken[r[group]] <= most and (r[group], r["_place"], r["_tie"]) in chosen:
            out.append(r)
    return out


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


class WordHasher:
    """64-bit hashes of the words of a text, by array operations on its bytes.

    codes: for each byte 0 where it separates words, else the byte it counts as.  A word's hash is a polynomial of random codes modulo
    2**64 in an odd base, mixed; equal words have equal hashes, and that two words of one corpus share one is as unlikely as
    for any 64-bit hash.
    """

    def __init__(self, codes: list[int], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.table = np.array([int(x) | 1 for x in rng.integers(0, 1 << 63, 256, np.uint64)], np.uint64)[codes]
        self.table[np.array(codes) == 0] = 0
        self.base = int(rng.integers(0, 1 << 63, dtype=np.uint64)) | 1
        self._powers(1 << 14)

    def _powers(self, n: int) -> None:
        def run(base: int) -> np.ndarray:
            out = np.ones(1, np.uint64)
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
            return out

        self.power, self.inverse = run(self.base), run(pow(self.base, -1, 1 << 64))

    def __call__(self, data: bytes) -> np.ndarray:
        """In order of the words, repeats included."""
        a = self.table[np.frombuffer(b" " + data + b" ", np.uint8)]
        n = len(a)
        if n > len(self.power):
            self._powers(n)
        inside = a != 0
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        sums = np.cumsum(a * self.inverse[:n])
        found = mix((sums[ends - 1] - sums[starts - 1]) * self.power[ends])
        if n > 1 << 20:
            self._powers(1 << 14)  # a very long text must not keep its memory
        return found


#: A-Z counts as a-z; the white space of SPACES separates.
PLAIN_CODES = [0 if chr(b) in SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256)]
#: Beyond that, all ASCII but letters and digits separates.
TERM_CODES = [b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 0 for b in range(256)]
