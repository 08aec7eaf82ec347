"""Merging, appending and moving rows between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookout.operators.ranks import numbered
from lookout.operators.splits import next_id
from lookout.operators.store import Scratch


def merge(tables: list[tuple[str, DataFrame]], key: list[str]) -> DataFrame:
    """All rows with their `origin`; of equal keys the one of the last table stays, and `copies` says how many there were."""
    rows = None
    for i, (name, df) in enumerate(tables):
        df = df.withColumns({"origin": F.lit(name), "_rank": F.lit(i)})
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    last = Window.partitionBy(*key).orderBy(F.desc("_rank"), *[F.col(c) for c in rows.columns if c not in (*key, "_rank")])
    return rows.withColumns({"copies": F.count("*").over(Window.partitionBy(*key)), "_place": F.row_number().over(last)}).where("_place = 1").drop("_rank", "_place")


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables without whole rows that repeat."""
    return old.unionByName(new, allowMissingColumns=True).distinct()


def only_new(incoming: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return incoming.join(known.select(key), key, "left_anti")


def only_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return rows.join(known.select(key), key, "left_semi")


def move(source: DataFrame, target: DataFrame, chosen: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Moves registry rows whose folder is chosen and not yet in target: (what source keeps, target with them).

    They keep camera and split and get new ids after target's last, in order of folder; rows that share a folder each get one, in order of id.
    """
    moved = source.join(chosen.select("folder").distinct(), "folder", "left_semi").join(target.select("folder"), "folder", "left_anti")
    first = F.broadcast(next_id(target, prefix))  # one row
    placed = numbered(moved.select("folder", F.col("id").alias("old"), "camera", "split"), ["folder", "old"], Scratch(source.sparkSession))
    added = placed.join(first).withColumn("id", F.format_string(f"{prefix}_%08d", F.col("next_id") + F.col("place") - 1)).select("id", "folder", "camera", "split")
    return source.join(moved.select("folder"), "folder", "left_anti"), target.select("id", "folder", "camera", "split").unionByName(added)


def union_sources(tables: dict[str, DataFrame], split: str | None = None) -> DataFrame:
    """Registries with where each row comes from (`source`), of one split if it is given."""
    out = None
    for name, df in tables.items():
        df = df.withColumn("source", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out if split is None else out.where(F.col("split") == split)


def combined(datasets: list[DataFrame], splits: tuple[str, ...] = ("train", "val", "test"), key: tuple[str, ...] = ("split", "name")) -> DataFrame:
    """Data sets as one, of the splits asked for; of files with one name in a split the last data set's stays."""
    if not splits or not datasets:
        raise ValueError("a split and a data set are needed")
    return merge([(str(i), d.where(F.col("split").isin(*splits))) for i, d in enumerate(datasets)], list(key)).drop("origin", "copies")
