"""Records of the camera platform: detection, sequence, camera and organization in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_of(rows: DataFrame, order: str | None = None) -> DataFrame:
    """One row for each id: the last by the column `order`, which says when it came; without one, or among equal ones, the greatest row."""
    first = [order] if order else []
    best = F.struct(*first, *[c for c in rows.columns if c not in first])
    return rows.groupBy("id").agg(F.max(best).alias("x")).select(*[F.col(f"x.{c}").alias(c) for c in rows.columns])


def records(detections: DataFrame, sequences: DataFrame, cameras: DataFrame, organizations: DataFrame, order: str | None = None, strict: bool = False) -> DataFrame:
    """The flat record of each detection; of rows with one id in a dimension the last counts (by `order`).  sequence_is_wildfire is the sequence's own flag, null where it has none.

    Detections of which a dimension is missing are left out; with `strict` they fail the job.  Spark broadcasts cameras and organizations where they are small.  Detections and
    sequences grow together and are shuffled, as Spark would take what was fetched, or read from compressed files, for small and send it through the driver.
    """
    flag = F.col("is_wildfire") if "is_wildfire" in sequences.columns else F.lit(None).cast("boolean")
    s = last_of(sequences, order).select(F.col("id").alias("sequence_id"), "camera_id", flag.alias("sequence_is_wildfire"), F.col("started_at").alias("sequence_started_at"), F.col("last_seen_at").alias("sequence_last_seen_at"), F.col("azimuth").alias("sequence_azimuth")).hint("merge")
    c = last_of(cameras, order).select(F.col("id").alias("camera_id"), "organization_id", F.col("name").alias("camera_name"), F.col("lat").alias("camera_lat"), F.col("lon").alias("camera_lon"), F.col("is_trustable").alias("camera_is_trustable"), F.col("angle_of_view").alias("camera_angle_of_view"))
    o = last_of(organizations, order).select(F.col("id").alias("organization_id"), F.col("name").alias("organization_name"))
    d = detections.select(F.col("id").alias("detection_id"), "sequence_id", F.col("created_at").alias("detection_created_at"), F.col("azimuth").alias("detection_azimuth"), F.col("url").alias("detection_url"), F.col("bboxes").alias("detection_bboxes"), F.col("bucket_key").alias("detection_bucket_key"))
    if not strict:
        return d.join(s, "sequence_id").join(c, "camera_id").join(o, "organization_id")
    known = {"sequence_id": s, "camera_id": c, "organization_id": o}
    missing = None
    for key, dimension in known.items():
        d = d.join(dimension.withColumn(f"has_{key}", F.lit(True)), key, "left")
        told = F.raise_error(F.concat(F.lit(f"no {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        absent = F.col(f"has_{key}").isNull()
        missing = F.when(absent, told) if missing is None else missing.when(absent, told)  # the first that is missing is told
    return d.withColumn("detection_id", missing.otherwise(F.col("detection_id"))).drop(*[f"has_{k}" for k in known])


def sequence_ids(names: DataFrame, column: str = "folder") -> DataFrame:
    """The distinct numbers after the last `_sequence-` of folder names."""
    return names.select(F.regexp_extract(column, "_sequence-([0-9]+)$", 1).try_cast("long").alias("sequence_id")).where("sequence_id is not null").distinct()


def directories(paths: DataFrame, ending: str = "", sequence: bool = False) -> DataFrame:
    """paths(path) of directories, nested however deep: those whose name ends as given (`false-positives`, `true-positives`), or is that of a sequence, `..._sequence-<digits>`."""
    name = F.element_at(F.split(F.regexp_replace("path", "/+$", ""), "/"), -1)
    found = paths.where(name.endswith(ending))
    return found.where(name.rlike("_sequence-[0-9]+$")) if sequence else found


def containing(rows: DataFrame, column: str, part: str, ignore_case: bool = False, most: int | None = None) -> DataFrame:
    """Rows whose text has `part` in it; with `most`, the first of them by that text, for a viewer's list."""
    text = F.col(column)
    found = rows.where(F.lower(text).contains(part.lower()) if ignore_case else text.contains(part))
    return found if most is None else found.orderBy(column).limit(most)


def of_sequences(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.select("sequence_id"), "sequence_id", "left_semi")


def annotated(references: DataFrame, annotated_dirs: DataFrame) -> DataFrame:
    """References (folder) with the first annotated directory of their name, or null."""
    first = annotated_dirs.groupBy("name").agg(F.min("path").alias("path"))
    return references.join(first, references["folder"] == first["name"], "left").drop("name")
