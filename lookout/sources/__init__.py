"""What is read and written: registries, sequence folders, label files, CSV and JSON tables, Parquet."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookout.sources import committed
from lookout.sources.places import listed, read_files

REGISTRY = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "folder", "camera", "split")])
PAIRS = "site string, azimuth_a int, azimuth_b int, n_kp_a int, n_kp_b int, n_good int, n_inliers int, dcx double, h_scale double, s_area double, d_area double"
REPRESENTATIVES = "site string, azimuth int, folder string, image string, latest_timestamp string, n_sequences long"
REMAP = "site string, cluster_id string, discard_azimuth int, keep_azimuth int, n_sequences long, n_train long, n_val long, n_test long, votes_keep long, votes_discard long, cluster_size long, cluster_members string, evidence_pairs string"
DECISION = "struct<status:string,kept_azimuth:int,discarded_azimuth:int,n_inliers:int,decided_at:string>"


def exists(spark: SparkSession, path: str) -> bool:
    """By the file system of the path, whatever it is."""
    p, fs = _fs(spark, path)
    return fs.exists(p)


def registry(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """The sequences of a registry: one document {"sequences": [...]}, a table as save_registry() writes it, or a folder of JSON lines.

    Without the file, or without its key, none, unless strict.  Anything else that is no registry is an error: a file with something in it is never an empty table.
    """
    if not exists(spark, path):
        if strict:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], REGISTRY)
    if is_folder(spark, path) and exists(spark, f"{path.rstrip('/')}/versions"):
        return committed.read(spark, path.rstrip("/"))
    if is_folder(spark, path):
        return spark.read.schema(REGISTRY).json(path, mode="FAILFAST")
    texts = spark.read.text(path, wholetext=True)
    whole = F.from_json("value", T.StructType([T.StructField("sequences", T.ArrayType(REGISTRY))]), {"mode": "PERMISSIVE"})
    parsed = texts.select("value", whole.alias("x"), F.json_object_keys("value").alias("keys"))
    lost = F.col("keys").isNull() | (F.array_contains("keys", "sequences") & F.col("x.sequences").isNull() & ~F.get_json_object("value", "$.sequences").isNull())
    absent = ~F.array_contains("keys", "sequences")
    # one document is one row: what is wrong with it is told when it is read
    checked = parsed.select(F.when(lost & (F.trim("value") != ""), F.raise_error(F.lit(f"no registry: {path}"))).when(absent & F.lit(strict), F.raise_error(F.lit(f"no sequences in {path}"))).otherwise(F.col("x.sequences")).cast(T.ArrayType(REGISTRY)).alias("s"))
    return checked.select(F.inline(F.coalesce("s", F.array().cast(T.ArrayType(REGISTRY)))))


def save_registry(rows: DataFrame, path: str) -> None:
    """As a committed table, which registry() reads, so registries of any size can be written; it replaces what was there, and rows may come from there.

    A reader sees the old rows or the new ones, and of two writers at a time one is told so.
    """
    committed.save(rows.select("id", "folder", "camera", "split"), path.rstrip("/"))


def export_registry(rows: DataFrame, path: str) -> None:
    """As the one document {"sequences": [...]} in order of ids, indented, for tools that read it so.  It goes through the driver: for registries that such tools can hold."""
    found = [r.asDict() for r in rows.select("id", "folder", "camera", "split").orderBy("id").collect()]
    write_text(rows.sparkSession, path, json.dumps({"sequences": found}, indent=2) + "\n")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.getFileStatus(p).isDirectory()


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    p, fs = _fs(spark, path)
    if not fs.rename(p, _fs(spark, to)[0]):
        raise OSError(f"can't rename {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def folders(spark: SparkSession, root: str) -> DataFrame:
    """folder: the directories right under root, with or without files, not those whose name begins with a dot; by name."""
    p, fs = _fs(spark, root)
    names = sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory())
    return spark.createDataFrame([(n,) for n in names if not n.startswith(".")], "folder string")


def files(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("jpg", "jpeg", "png")) -> DataFrame:
    """folder, kind (images, labels, ...), stem, name, ext and bytes of all files <root>/<folder>/<kind>/<name>, not those under a name that begins with a dot.

    Tasks list the folders, and nothing is read; an empty file, as a background's label is, counts like any other.
    """
    part = F.split(F.concat(F.lit(f"{root.rstrip('/')}/"), "path"), "/")
    rows = listed(spark, root).select(F.element_at(part, -3).alias("folder"), F.element_at(part, -2).alias("kind"), F.element_at(part, -1).alias("name"), "bytes")
    rows = rows.withColumns({"stem": F.regexp_replace("name", r"\.[^.]*$", ""), "ext": F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1))})
    return rows.where(~F.col("folder").startswith(".") & ~F.col("name").startswith(".") & ((F.col("kind") != "images") | F.col("ext").isin(*extensions)))


def label_lines(spark: SparkSession, root: str) -> DataFrame:
    """folder, stem and text of all label files <root>/<folder>/labels/<stem>.txt; names are as files() gives them, spaces and all; an empty file is an empty text."""
    part = F.split(F.concat(F.lit(f"{root.rstrip('/')}/"), "path"), "/")
    rows = read_files(spark, root).select(F.col("text").alias("value"), "path")
    return rows.select(F.element_at(part, -3).alias("folder"), F.regexp_replace(F.element_at(part, -1), r"\.txt$", "").alias("stem"), F.col("value").alias("text"))


def table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header; empty fields are null."""
    return spark.read.schema(schema).csv(path, header=True, nullValue="", emptyValue="")


def tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV files with a header as one table, all columns text, by name; empty files don't count."""
    by_header: dict[str, list[str]] = {}
    for p in paths:
        first = spark.read.text(p).limit(1).collect()
        if first and first[0]["value"].strip():
            by_header.setdefault(first[0]["value"], []).append(p)
    found = [spark.read.csv(own, header=True, enforceSchema=False) for own in by_header.values()]  # a read for each header, not for each file
    if not found:
        raise ValueError("no CSV file with rows")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """pair_id, site, azimuth_a, azimuth_b, status, kept_azimuth, n_inliers, decided_at of a decision log; none without the file."""
    schema = f"pair_id string, site string, azimuth_a int, azimuth_b int, {DECISION[7:-1].replace(':', ' ')}"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{DECISION}>")).alias("pair_id", "d"))
    part = F.split("pair_id", r"\|")
    return rows.select("pair_id", part[0].alias("site"), part[1].cast("int").alias("azimuth_a"), part[2].cast("int").alias("azimuth_b"), "d.*")


def embeddings(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Embeddings as save_embeddings() writes them; a split that isn't there is an error."""
    rows = spark.read.parquet(path)
    if split is None:
        return rows
    own = rows.where(F.col("split") == split)
    if own.limit(1).count() == 0:
        raise ValueError(f"no embeddings of {split} in {path}")
    return own


def save_embeddings(rows: DataFrame, path: str) -> None:
    """rows(id, split, embedding, ...) as a table by split; embeddings of different lengths, or none, are an error."""
    odd = rows.agg(F.min(F.coalesce(F.size("embedding"), F.lit(-1))).alias("least"), F.max(F.size("embedding")).alias("most")).first()
    if odd["most"] is not None and odd["least"] != odd["most"] or odd["least"] == -1:
        raise ValueError(f"embeddings have {odd['least']} to {odd['most']} numbers")
    save_dataset(rows, path)


def platform_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines that a download job has put down, one object each: cameras, organizations, sequences or detections."""
    return spark.read.schema(schema).json(path)


def save_dataset(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """A data set as a table in a folder for each split (and category); it replaces what was there."""
    rows.write.mode("overwrite").partitionBy(*(by or ["split"])).parquet(path)


def merge_dataset(rows: DataFrame, path: str, key: tuple[str, ...] = ("split", "folder", "stem")) -> None:
    """Adds rows to a data set by split: a file with a key that is there already is replaced, all others stay."""
    spark = rows.sparkSession
    if not exists(spark, path):
        save_dataset(rows, path)
        return
    old = spark.read.parquet(path)
    on = [old[c].eqNullSafe(rows[c]) for c in key]
    both = old.join(rows, on, "left_anti").unionByName(rows, allowMissingColumns=True)
    new, before = f"{path.rstrip('/')}.new", f"{path.rstrip('/')}.old"
    remove(spark, new)
    save_dataset(both, new)
    remove(spark, before)
    rename(spark, path, before)
    rename(spark, new, path)
    remove(spark, before)


def copy_dataset(spark: SparkSession, path: str, to: str, splits: tuple[str, ...] = ("train", "val", "test"), names: list[str] | None = None) -> None:
    """The splits asked for of a data set, merged into another, with its data.yaml, which names these splits only."""
    combine_datasets(spark, [path], to, splits, names)


def combine_datasets(spark: SparkSession, paths: list[str], to: str, splits: tuple[str, ...] = ("train", "val", "test"), names: list[str] | None = None) -> None:
    """Several data sets one after another into one; of files with one key the last one's stays."""
    if not splits:
        raise ValueError("a split is needed")
    for path in paths:
        rows = spark.read.parquet(path)
        merge_dataset(rows.where(F.col("split").isin(*splits)), to, tuple(c for c in ("split", "folder", "stem", "name") if c in rows.columns))
    write_text(spark, f"{to.rstrip('/')}.yaml", dataset_yaml(names or ["smoke"], splits))


def append_table(rows: DataFrame, path: str, key: list[str] | None = None) -> None:
    """Adds rows to a Parquet table, whole rows once: what it has already is left out, so a repeated run adds nothing.

    With `key`, columns that a row never changes in (its day, its source), only the part of the table with the new rows' keys is read and compared;
    the table is kept in a folder for each key.
    """
    spark = rows.sparkSession
    new = rows.distinct()
    if exists(spark, path):
        old = spark.read.schema(rows.schema).parquet(path)
        if key:
            old = old.join(rows.select(*key).distinct(), key, "left_semi").select(rows.columns)
        new = new.join(old, on=[F.equal_null(new[c], old[c]) for c in rows.columns], how="left_anti")
    (new.write.mode("append").partitionBy(*key) if key else new.write.mode("append")).parquet(path)


def append_run(spark: SparkSession, path: str, run: dict) -> None:
    """Adds a run's data, one JSON line, to the log of runs in a folder."""
    spark.createDataFrame([(json.dumps(run, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("append").text(path)


def runs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log's runs; none without a log."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def save_csv(rows: DataFrame, path: str, order: list | None = None) -> None:
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").csv(path, header=True)


def dataset_yaml(names: list[str], splits: tuple[str, ...] = ("train", "val", "test")) -> str:
    """The text that describes a data set to a trainer."""
    return "".join(f"{s}: ./images/{s}\n" for s in splits) + f"nc: {len(names)}\nnames: [{', '.join(names)}]\n"


def parse_yaml(text: str) -> dict:
    """The keys of a data set's description: texts, numbers, and lists, in brackets or by lines; other YAML isn't read."""
    def value(x: str):
        x = x.strip().strip("'\"")
        return int(x) if re.fullmatch("-?[0-9]+", x) else x

    out: dict = {}
    last = None
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith("#"):
            continue
        if bare.lstrip().startswith("- ") and last is not None:
            out[last] = [*(out[last] or []), value(bare.lstrip()[2:])]
        elif m := re.fullmatch(r"([A-Za-z_]\w*)\s*:\s*(.*)", bare):
            last, rest = m[1], m[2]
            out[last] = [value(x) for x in rest[1:-1].split(",") if x.strip()] if rest.startswith("[") and rest.endswith("]") else value(rest) if rest else None
        else:
            raise ValueError(f"not read: {line}")
    return out


def dataset_info(spark: SparkSession, path: str) -> dict:
    """A data set's description and which of train, val and test it names."""
    found = parse_yaml(read_text(spark, path))
    return found | {"splits": [s for s in ("train", "val", "test") if s in found]}
