"""Validation of sequences, leakage between splits, and counts that must agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lookout.functions.names import FOLDER_FORMAT, IMAGE_FORMAT, UNKNOWN_AZIMUTH


def validate(sequences: DataFrame) -> DataFrame:
    """sequences(folder, images, labels): images an array of names, labels an array of sizes in bytes; null where the directory is missing.

    Adds naming_issues and structural_issues, arrays of what is wrong, and is_valid.  Without both directories nothing else is looked at.
    """
    folder = F.col("folder")
    azimuth = F.regexp_extract(folder, FOLDER_FORMAT, 1).try_cast("int")
    both = F.col("images").isNotNull() & F.col("labels").isNotNull()
    n_bad = F.size(F.filter("images", lambda x: ~x.rlike(IMAGE_FORMAT)))
    n_images, n_labels = F.size("images"), F.size(F.filter("labels", lambda x: x > 0))
    naming = F.array_compact(F.array(F.when(~folder.rlike(FOLDER_FORMAT), F.lit("folder name")), F.when((azimuth > 360) & (azimuth != UNKNOWN_AZIMUTH), F.lit("azimuth")), F.when(both & (n_bad > 0), F.lit("image name"))))
    few = (n_labels == 0) | ((n_labels == 1) & (n_images > 2))
    structural = F.array_compact(F.array(F.when(F.col("images").isNull(), F.lit("no images")), F.when(F.col("labels").isNull(), F.lit("no labels")), F.when(both & few, F.lit("few labels"))))
    out = sequences.withColumns({"naming_issues": naming, "structural_issues": structural})
    return out.withColumn("is_valid", (F.size("naming_issues") == 0) & (F.size("structural_issues") == 0))


def leakage(rows: DataFrame, item: str, scope: list[str] | None = None) -> DataFrame:
    """Items that stand in several splits, counted for each pair of splits, in one pass over distinct (item, split)."""
    keys = [*(scope or []), item]
    found = rows.where(F.col(item).isNotNull()).select(*keys, "split").distinct().groupBy(*keys).agg(F.sort_array(F.collect_set("split")).alias("splits")).where(F.size("splits") > 1)  # no more than there are splits
    pair = F.flatten(F.transform("splits", lambda a, i: F.transform(F.slice("splits", i + 2, F.size("splits")), lambda b: F.struct(a.alias("split_a"), b.alias("split_b")))))
    return found.select(*(scope or []), F.explode(pair).alias("p")).groupBy(*(scope or []), "p.split_a", "p.split_b").agg(F.count("*").alias("n"))


def file_counts(files: DataFrame, kinds: list[str]) -> DataFrame:
    """files(folder, kind): one count for each kind, and whether all agree."""
    out = files.groupBy("folder").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    first, *others = (F.col(k) for k in kinds)
    same = F.lit(True)
    for o in others:
        same = same & (o == first)
    return out.withColumn("agree", same)


def complete_smoke(frames: DataFrame) -> DataFrame:
    """Sequences to keep: background always, smoke only with as many ground-truth labels as images.  frames(folder, is_background, has_truth)."""
    per = frames.groupBy("folder").agg(F.bool_or("is_background").alias("is_background"), F.count("*").alias("images"), F.count_if("has_truth").alias("labels"))
    return per.where(F.col("is_background") | (F.col("images") == F.col("labels")))


def image_label_parity(images: DataFrame, labels: DataFrame) -> DataFrame:
    """For each split the number of images and of labels, and whether they are equal."""
    a, b = images.groupBy("split").agg(F.count("*").alias("images")), labels.groupBy("split").agg(F.count("*").alias("labels"))
    return a.join(b, "split", "full").fillna(0, ["images", "labels"]).withColumn("equal", F.col("images") == F.col("labels"))


def assert_parity(images: DataFrame, labels: DataFrame) -> None:
    """Fails if a split has more images than labels, or fewer."""
    odd = image_label_parity(images, labels).where("not equal").collect()  # a row for each split
    if odd:
        raise ValueError(f"images and labels differ: {odd}")


def run_counters(registry: DataFrame, images: DataFrame, chosen: DataFrame) -> DataFrame:
    """What a build did, for each split: sequences in the registry, those written and the frames of these, those skipped (they have images, but none
    was chosen) and those missing (they have no images at all).  registry(folder, split), images(folder), chosen(folder, stem)."""
    has = images.groupBy("folder").agg(F.count("*").alias("images"))
    got = chosen.groupBy("folder").agg(F.count("*").alias("frames"))
    rows = registry.select("folder", "split").join(has, "folder", "left").join(got, "folder", "left")
    missing = F.col("images").isNull()
    return rows.groupBy("split").agg(F.count("*").alias("sequences"), F.count_if(F.col("frames").isNotNull()).alias("written"), F.coalesce(F.sum("frames"), F.lit(0)).cast("long").alias("frames"), F.count_if(~missing & F.col("frames").isNull()).alias("skipped"), F.count_if(missing & F.col("frames").isNull()).alias("missing"))


def observed(rows: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """rows, and an observation that counts them, and those that meet each condition, while something else reads them: no pass of its own."""
    seen = Observation(name)
    return rows.observe(seen, F.count("*").alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()]), seen
