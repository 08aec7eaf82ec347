"""Samples and quotas: per sequence, round robin, by ratio, by confidence."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookout.functions.boxes import boxes
from lookout.functions.names import seeded
from lookout.operators.ranks import numbered
from lookout.operators.splits import SPLITS
from lookout.operators.store import Scratch


def labelled(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Images whose label (same folder and stem) has something in it."""
    return images.join(labels.where(F.col("label_bytes") > 0).select("folder", "stem"), ["folder", "stem"], "left_semi")


def per_sequence(frames: DataFrame, most: int = 10, seed: int = 0) -> DataFrame:
    """Up to `most` frames of each sequence, in a seeded order."""
    place = F.row_number().over(Window.partitionBy("folder").orderBy(seeded(seed, F.col("folder"), F.col("stem")), "stem"))
    return frames.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")


def first_frames(frames: DataFrame, most: int = 20) -> DataFrame:
    """The first frames of each sequence by name."""
    return frames.withColumn("_place", F.row_number().over(Window.partitionBy("folder").orderBy("stem"))).where(F.col("_place") <= most).drop("_place")


def round_robin(frames: DataFrame, quota: int) -> DataFrame:
    """`quota` frames, best score first, one of each sequence in turn (sequences by name), then the next of each.

    Turns are made once and counted: those before the last one are whole, and of that one the first folders by name are taken.
    """
    if quota <= 0:
        return frames.withColumn("turn", F.lit(1)).limit(0)
    with Scratch(frames.sparkSession) as scratch:
        turn = F.row_number().over(Window.partitionBy("folder").orderBy(F.desc("score"), "stem"))
        rows = scratch.keep(scratch.cut(frames.withColumn("turn", turn)))
        counts = rows.groupBy("turn").agg(F.count("*").alias("n"))  # no more than the frames of the longest sequence
        upto = counts.withColumn("run", F.sum("n").over(Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)))
        last = upto.where(F.col("run") >= quota).orderBy("turn").limit(1).collect()
        if not last:
            return rows
        most = quota - (last[0]["run"] - last[0]["n"])
        part = scratch.keep(scratch.cut(numbered(rows.where(F.col("turn") == last[0]["turn"]), ["folder"], scratch).where(F.col("place") <= most)))
        return rows.where(F.col("turn") < last[0]["turn"]).unionByName(part.drop("place"))


def by_ratio(frames: DataFrame, groups: list[str], ratio: float = 0.05, seed: int = 0) -> DataFrame:
    """Of each group max(1, round(n * ratio)) rows, halves to even, never more than there are.

    Rows are counted by ranges of their seeded order first: only those of the ranges up to a group's last row are ranked, each range by itself.
    """
    order = seeded(seed, F.col("stem"))
    spread = F.substring(order, 1, 4)
    sizes = frames.groupBy(*[F.col(g).alias(f"_{g}") for g in groups], spread.alias("_range")).agg(F.count("*").alias("_n"))  # 65,536 a group at most
    of = Window.partitionBy(*[f"_{g}" for g in groups])
    n = F.sum("_n").over(of)
    sizes = sizes.withColumns({"_before": F.coalesce(F.sum("_n").over(of.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_most": F.least(n, F.greatest(F.lit(1), F.bround(n * F.lit(ratio))))})
    on = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups] + [F.col("_range") == F.col("_own")]
    rows = frames.withColumns({"_order": order, "_own": spread}).join(sizes.where("_before < _most"), functools.reduce(lambda a, b: a & b, on))
    place = F.col("_before") + F.row_number().over(Window.partitionBy(*groups, "_own").orderBy("_order", "stem"))
    return rows.withColumn("_place", place).where(F.col("_place") <= F.col("_most")).select(*frames.columns)


def split_counts(rows: DataFrame) -> DataFrame:
    """split and n, for each of the splits, 0 where it has no row."""
    n = rows.agg(*[F.count_if(F.col("split") == s).alias(s) for s in SPLITS])
    return n.select(F.explode(F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("n")) for s in SPLITS])).alias("x")).select("x.*")


def false_positive_quota(counts: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """counts(split, n) -> split, n, quota: as many false positives as make up the split's ratio of all."""
    r = F.coalesce(F.create_map(*[F.lit(x) for pair in ratios.items() for x in pair])[F.col("split")], F.lit(0.0))
    return counts.select("split", "n", F.floor(F.col("n") * r / (1 - r) + 1e-9).cast("long").alias("quota"))


def most_confident(predictions: DataFrame, most: int, distinct_frames: bool = False) -> DataFrame:
    """The predictions of each sequence with the highest confidence above 0; a frame may come up again unless distinct_frames."""
    rows = predictions.where(F.col("conf") > 0)
    if distinct_frames:
        rows = rows.groupBy("folder", "stem").agg(F.max("conf").alias("conf"), F.min("line").alias("line"))
    place = F.row_number().over(Window.partitionBy("folder").orderBy(F.desc("conf"), "stem", "line"))
    return rows.withColumn("place", place).where(F.col("place") <= most)


def prediction_truth(predictions: DataFrame, truths: DataFrame, strict: bool = False) -> DataFrame:
    """predictions(folder, stem, text) with the ground truth of the same frame: folder, stem, text (the truth's), n_truth, n_predicted and least_conf, as hard_examples() takes them.

    A frame without a truth has none of its boxes, and null text; with `strict` it fails the job.
    """
    truth = truths.select("folder", "stem", "text", F.lit(True).alias("has"))
    found = predictions.select("folder", "stem", F.transform(boxes(F.col("text")), lambda b: b["conf"]).alias("_confs"))  # a column, so that each text is parsed once
    counted = found.select("folder", "stem", F.size("_confs").alias("n_predicted"), F.array_min("_confs").alias("least_conf"))
    rows = counted.join(truth, ["folder", "stem"], "left")
    if strict:
        rows = rows.withColumn("text", F.when(F.col("has"), F.col("text")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("no ground truth for"), "folder", "stem"))))
    return rows.select("folder", "stem", "text", F.size(boxes(F.col("text"))).alias("n_truth"), "n_predicted", "least_conf")


def hard_examples(frames: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """frames(folder, stem, n_truth, n_predicted, least_conf): of those with ground truth the 2 * most with the least confident prediction and `most` without
    one, of which `most` are picked in a seeded order."""
    rows = frames.where(F.col("n_truth") > 0).withColumn("kind", F.when(F.col("n_predicted") > 0, "low").otherwise("none"))
    order = Window.partitionBy("folder", "kind").orderBy(F.col("least_conf").asc_nulls_last(), "stem")
    pool = rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= F.when(F.col("kind") == "low", 2 * most).otherwise(most))
    pick = F.row_number().over(Window.partitionBy("folder").orderBy(seeded(seed, F.col("folder"), F.col("stem")), "stem"))
    return pool.withColumn("_pick", pick).where(F.col("_pick") <= most).drop("_place", "_pick")


def page(rows: DataFrame, order: list, limit: int, offset: int = 0) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit)
