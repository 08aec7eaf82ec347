"""Tables whose files never change and whose versions are published whole.

A table is a folder with data/ (files, each commit in a folder of its own) and versions/ (a JSON document for each version that says which folders of data it is made of).  A change
writes new files beside the old ones, then creates the next version's document, which only one writer can do.  So a reader sees a version or the next one, never a
part of either; of two writers that began from one version, the second is told so and leaves nothing; and a job that dies leaves files that no version names.
"""

from __future__ import annotations

import json
import math
import os
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a partition folder of a null is called.
NULL = "__HIVE_DEFAULT_PARTITION__"
BUCKET, KEY = "_bucket", "_key"
#: Rows that a task of a merge sorts.
ROWS_A_TASK = 1 << 19


class Conflict(RuntimeError):
    """Another writer published the version that this one was going to."""


@dataclass
class Version:
    """number 0 is a table that isn't there.  parts: folders below data/, with the values of the columns `by`, as text, that their rows have."""

    number: int = 0
    schema: str = ""
    by: list[str] = field(default_factory=list)
    parts: list[dict] = field(default_factory=list)
    notes: dict = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    p, fs = _fs(spark, f"{root}/versions")
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version, or that of a number.  A document that isn't whole is that of a writer that died, and no version."""
    for n in reversed(versions(spark, root)) if number is None else [number]:
        try:
            return Version(**json.loads(spark.read.text(f"{root}/versions/{n:012d}.json", wholetext=True).first()["value"]))
        except (ValueError, TypeError):
            if number is not None:
                raise
    return Version()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file if there is none, which stores with a lock or a conditional put do as one step; local folders by a link."""
    p, fs = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":
        local = p.toUri().getPath()
        draft = f"{local}.{uuid.uuid4().hex}"
        with open(draft, "w") as f:
            f.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _parts(spark: SparkSession, root: str, folder: str, by: list[str]) -> list[dict]:
    """The partition folders of what was written, by listing."""
    found = [(folder, {})]
    for column in by:
        deeper = []
        for at, values in found:
            p, fs = _fs(spark, f"{root}/data/{at}")
            for x in fs.listStatus(p):
                name, eq, value = x.getPath().getName().partition("=")
                if x.isDirectory() and eq and unquote(name) == column:
                    deeper.append((f"{at}/{x.getPath().getName()}", values | {column: None if value == NULL else unquote(value)}))
        found = deeper
    return [{"folder": at, "values": values} for at, values in found]


def _written(rows: DataFrame, root: str, by: list[str]) -> tuple[str, list[dict]]:
    folder = f"commit={uuid.uuid4().hex}"
    out = rows.write.option("compression", "zstd")
    (out.partitionBy(*by) if by else out).parquet(f"{root}/data/{folder}")
    return folder, _parts(rows.sparkSession, root, folder, by)


def _publish(spark: SparkSession, root: str, before: Version, schema: T.StructType, by: list[str], parts: list[dict], notes: dict, folder: str) -> Version:
    """The next version, or, if another writer has made it, an error, after which the new files are gone."""
    after = Version(max([before.number, *versions(spark, root)]) + 1, schema.json(), by, parts, notes)  # after documents that aren't whole, too
    if version(spark, root).number != before.number or not _create(spark, f"{root}/versions/{after.number:012d}.json", json.dumps(after.__dict__)):
        p, fs = _fs(spark, f"{root}/data/{folder}")
        fs.delete(p, True)
        raise Conflict(f"{root}: version {after.number} is another writer's")
    return after


def _rows(spark: SparkSession, root: str, v: Version, parts: list[dict], columns: list[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(v.schema))
    names = columns or schema.names
    if not parts:
        return spark.createDataFrame([], schema).select(names)
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*[f"{root}/data/{p['folder']}" for p in parts]).select(names)


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of the newest version, or of an older one that is kept; whatever writers do meanwhile, the same."""
    v = version(spark, root, number)
    if not v.number:
        raise FileNotFoundError(root)
    return _rows(spark, root, v, v.parts).drop(BUCKET, KEY)


def save(rows: DataFrame, root: str, by: list[str] | None = None, base: Version | None = None) -> Version:
    """A version of these rows alone; they may come from the table itself."""
    spark, by = rows.sparkSession, by or []
    base = base or version(spark, root)
    folder, parts = _written(rows, root, by)
    return _publish(spark, root, base, rows.schema, by, parts, {}, folder)


def _of(part: dict, wanted: set[tuple], by: list[str]) -> bool:
    return tuple(part["values"][c] for c in by) in wanted


def merge(rows: DataFrame, root: str, key: list[str], by: list[str] | None = None, base: Version | None = None) -> Version:
    """Rows whose key (null like any value) is there already replace those; all others stay.  Of new rows with one key the greatest counts.

    Only partitions that a new row lies in are read and written again, the others are named again; so the columns `by` must be part of the key.
    """
    spark, by = rows.sparkSession, by or []
    base = base or version(spark, root)
    if base.number:
        by = base.by
    if not set(by) <= set(key):
        raise ValueError(f"the key {key} must have the partition columns {by}")
    sizes = rows.groupBy(*[F.col(c).cast("string") for c in by]).agg(F.count("*")).collect()  # a row a partition
    touched = {tuple(r[:-1]) for r in sizes}
    old = _rows(spark, root, base, [p for p in base.parts if _of(p, touched, by)]) if base.number else None
    total = sum(r[-1] for r in sizes) + (old.count() if base.number else 0)
    tasks = max(math.ceil(total / ROWS_A_TASK), min(spark.sparkContext.defaultParallelism, 1 + total // 10_000))

    def dealt(df: DataFrame, *columns: str | Column) -> DataFrame:
        """By the key as one struct, in which nulls are alike, to as many tasks as the rows need: Spark's own number goes by bytes, and sorted keys are a sixtieth of their size there."""
        return df.select(F.struct(*key).alias("_key"), *columns).repartition(tasks, "_key")

    rest = [c for c in rows.columns if c not in key]
    new = dealt(rows, F.struct(*rest).alias("_x")).groupBy("_key").agg(F.max("_x").alias("_x")) if rest else dealt(rows).distinct()
    added = new.select("_key.*", *["_x.*"] * bool(rest)).select(rows.columns)
    if not base.number:
        return save(added, root, by, base)
    kept = dealt(old, F.struct(*old.columns).alias("_row")).join(new.select("_key"), "_key", "left_anti").select("_row.*")
    folder, parts = _written(kept.unionByName(added, allowMissingColumns=True), root, by)
    schema = kept.unionByName(added.limit(0), allowMissingColumns=True).schema
    return _publish(spark, root, base, schema, by, [p for p in base.parts if not _of(p, touched, by)] + parts, base.notes, folder)


def append_new(rows: DataFrame, root: str, key: list[str] | None = None, buckets: int = 256, batch: tuple[str, int] | None = None) -> Version:
    """Adds the rows that aren't there yet: none with the same key, or without `key` no equal whole row.

    Rows lie in buckets by a hash of their key, with the hash beside them.  Of the table only the hashes of those buckets that a new row falls in are read, and nothing is written
    again.  With `batch`, a stream's name and the number of its batch, one that was added before adds nothing, so a stream that begins again counts each batch once.
    Of new rows with one key the greatest counts.
    """
    spark = rows.sparkSession
    base = version(spark, root)
    seen = base.notes.get("batches", {})
    if batch and seen.get(batch[0], -1) >= batch[1]:
        return base
    names = rows.columns
    hashed = F.sha2(F.to_json(F.struct(*[F.col(c) for c in key or names]), {"ignoreNullFields": "false"}), 256)
    buckets = base.notes.get("buckets", buckets)
    one = rows.withColumn(KEY, hashed).groupBy(KEY).agg(F.max(F.struct(*names)).alias("_x")).select("_x.*", KEY)
    new = one.withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int"))
    if base.number:
        touched = {(str(r[0]),) for r in new.select(BUCKET).distinct().collect()}  # `buckets` rows at most
        old = _rows(spark, root, base, [p for p in base.parts if _of(p, touched, [BUCKET])], [KEY, BUCKET])
        new = new.join(old, [BUCKET, KEY], "left_anti").select(new.columns)
    folder, parts = _written(new.repartition(BUCKET), root, [BUCKET])
    notes = {"buckets": buckets, "batches": seen | ({batch[0]: batch[1]} if batch else {})}
    return _publish(spark, root, base, new.schema, [BUCKET], base.parts + parts, notes, folder)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Removes the versions but the last `keep`, and all files that none of these names; says how many folders went.  No writer may be at work."""
    numbers = versions(spark, root)
    used = {p["folder"].split("/")[0] for n in numbers[-keep:] for p in version(spark, root, n).parts}
    for n in numbers[:-keep]:
        p, fs = _fs(spark, f"{root}/versions/{n:012d}.json")
        fs.delete(p, False)
    p, fs = _fs(spark, f"{root}/data")
    gone = [x.getPath() for x in fs.listStatus(p) if x.getPath().getName() not in used]
    for x in gone:
        fs.delete(x, True)
    return len(gone)
