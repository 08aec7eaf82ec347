"""Cameras that look the same way under two azimuths: candidates, decisions, clusters, and the remap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookout.functions.names import azimuth, pair_id, site, stamp
from lookout.operators.graph import components

# The columns of the remap file and how its evidence is written, which other tools read.
REMAP_COLUMNS = ("site", "cluster_id", "discard_azimuth", "keep_azimuth", "n_sequences", "n_train", "n_val", "n_test", "votes_keep", "votes_discard", "cluster_size", "cluster_members", "evidence_pairs")
EVIDENCE, EVIDENCE_SEPARATOR = "%d↔%d(keep=%d,inl=%d)", " | "


def latest_representatives(registry: DataFrame, frames: DataFrame) -> DataFrame:
    """site, azimuth, folder, latest_timestamp, n_sequences: the latest sequence with a frame; the count is over all."""
    cams = registry.select("folder", "split", site(F.col("camera")).alias("site"), azimuth(F.col("camera")).alias("azimuth")).where("azimuth is not null")
    n = cams.groupBy("site", "azimuth").agg(F.count("*").alias("n_sequences"))
    have = cams.join(frames.select("folder").distinct(), "folder", "left_semi")
    best = have.groupBy("site", "azimuth").agg(F.max(F.struct(F.coalesce(stamp(F.col("folder")), F.lit("")).alias("t"), "folder")).alias("x"))
    return best.join(n, ["site", "azimuth"]).select("site", "azimuth", "x.folder", F.col("x.t").alias("latest_timestamp"), "n_sequences")


def candidate_pairs(representatives: DataFrame) -> DataFrame:
    """All azimuth pairs a < b of each site."""
    a = representatives.select("site", F.col("azimuth").alias("azimuth_a"), F.col("folder").alias("folder_a"))
    b = representatives.select("site", F.col("azimuth").alias("azimuth_b"), F.col("folder").alias("folder_b"))
    return a.join(b, "site").where(F.col("azimuth_a") < F.col("azimuth_b"))


def site_pairs(representatives: DataFrame) -> DataFrame:
    """Sites with two azimuths or more: their azimuths and number of pairs."""
    s = representatives.groupBy("site").agg(F.sort_array(F.collect_set("azimuth")).alias("azimuths")).where(F.size("azimuths") > 1)  # 361 at most
    n = F.size("azimuths").cast("long")
    return s.withColumn("n_pairs", (n * (n - 1) / 2).cast("long"))


def reject_reason(pairs: DataFrame, most_shift: float = 0.5, least_scale: float = 0.6, most_scale: float = 1.7) -> DataFrame:
    """Adds `reason`: dcx, scale or degenerate where a pair can't be the same view, else null.  Without a scale only the inliers tell, whatever the shift."""
    scale = F.col("h_scale")
    none = scale.isNull() | F.isnan(scale)
    reason = F.when(none, F.when(F.col("n_inliers") >= 4, "degenerate")).when(F.abs("dcx") > most_shift, "dcx").when((scale < least_scale) | (scale > most_scale), "scale")
    return pairs.withColumn("reason", reason)


def reject_counts(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count("*").alias("pairs"), *[F.count_if(F.col("reason") == r).alias(r) for r in ("dcx", "scale", "degenerate")])


def with_decisions(pairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pairs with `status` (pending without a decision) and kept_azimuth."""
    p = pairs.withColumn("pair_id", pair_id(F.col("site"), F.col("azimuth_a"), F.col("azimuth_b")))
    return p.join(decisions.select("pair_id", "status", "kept_azimuth"), "pair_id", "left").withColumn("status", F.coalesce("status", F.lit("pending")))


def progress(decided: DataFrame, least_inliers: int = 30) -> DataFrame:
    rows = decided.where(F.col("n_inliers") >= least_inliers)
    return rows.agg(F.count("*").alias("pairs"), *[F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "rejected", "pending")])


def filtered(decided: DataFrame, least_inliers: int = 30, status: str | None = None, site: str | None = None) -> DataFrame:
    """What a validator looks at: pairs with enough inliers, of one status and one site where these are given."""
    rows = decided.where(F.col("n_inliers") >= least_inliers)
    rows = rows if status is None else rows.where(F.col("status") == status)
    return rows if site is None else rows.where(F.col("site") == site)


def default_keep(pairs: DataFrame) -> DataFrame:
    """Which azimuth a validator proposes to keep: the one with the later representative, then with more sequences; ties to the first."""
    a, b = (F.struct(F.col(f"latest_{x}"), F.col(f"n_{x}")) for x in "ab")
    return pairs.withColumn("proposed", F.when(a >= b, F.col("azimuth_a")).otherwise(F.col("azimuth_b")))


def clusters(accepted: DataFrame) -> DataFrame:
    """accepted(site, azimuth_a, azimuth_b) -> site, azimuth, cluster: components of each site; cluster ids c000... by site and least azimuth.

    A node is the pair (site, azimuth) as one text, so all sites close at once.
    """
    node = lambda a: F.concat_ws("|", "site", F.lpad(F.col(a).cast("string"), 5, "0"))
    found = components(accepted.select(node("azimuth_a").alias("a"), node("azimuth_b").alias("b")))
    parts = lambda c: (F.regexp_extract(c, r"(?s)^(.*)\|([0-9]+)$", 1), F.regexp_extract(c, r"(?s)^(.*)\|([0-9]+)$", 2).cast("int"))
    s, a = parts("node")
    _, root = parts("component")
    rows = found.select(s.alias("site"), a.alias("azimuth"), root.alias("root"))
    ids = rows.select("site", "root").distinct().withColumn("cluster_id", F.format_string("c%03d", F.row_number().over(Window.orderBy("site", "root")) - 1))  # one row a cluster that people confirmed
    return rows.join(ids, ["site", "root"]).select("site", "azimuth", "cluster_id")


def canonical(members: DataFrame, accepted: DataFrame, representatives: DataFrame) -> DataFrame:
    """members and votes, keep_azimuth: each cluster keeps the azimuth with most votes, then the latest representative, most sequences, the greatest number."""
    votes = accepted.groupBy("site", F.col("kept_azimuth").alias("azimuth")).agg(F.count("*").alias("votes"))
    rows = members.join(votes, ["site", "azimuth"], "left").join(representatives.select("site", "azimuth", "latest_timestamp", "n_sequences"), ["site", "azimuth"], "left")
    rows = rows.withColumns({"votes": F.coalesce("votes", F.lit(0)), "latest_timestamp": F.coalesce("latest_timestamp", F.lit("")), "n_sequences": F.coalesce("n_sequences", F.lit(0)).cast("long")})
    best = rows.groupBy("cluster_id").agg(F.max(F.struct("votes", "latest_timestamp", "n_sequences", "azimuth")).alias("x"))
    return rows.join(best, "cluster_id").select("site", "azimuth", "cluster_id", "votes", F.col("x.azimuth").alias("keep_azimuth"), F.col("x.votes").alias("votes_keep"))


def remap(chosen: DataFrame, accepted: DataFrame, registry: DataFrame) -> DataFrame:
    """One row for each azimuth that goes: what it becomes, its sequences by split, votes, the cluster's members and evidence."""
    inventory = registry.select(site(F.col("camera")).alias("site"), azimuth(F.col("camera")).alias("azimuth"), "split").groupBy("site", "azimuth").agg(F.count("*").alias("n_sequences"), *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")])
    of = chosen.select("site", F.col("azimuth").alias("azimuth_a"), "cluster_id")
    evidence = accepted.join(of, ["site", "azimuth_a"]).groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("n_inliers")).alias("o"), F.col("azimuth_a").alias("a"), F.col("azimuth_b").alias("b"), F.col("kept_azimuth").alias("k")))).alias("e"))
    text = F.array_join(F.transform("e", lambda x: F.format_string(EVIDENCE, x["a"], x["b"], x["k"], -x["o"])), EVIDENCE_SEPARATOR)
    size = chosen.groupBy("cluster_id").agg(F.count("*").alias("cluster_size"), F.array_join(F.transform(F.sort_array(F.collect_list("azimuth")), lambda x: x.cast("string")), ",").alias("cluster_members"))
    rows = chosen.where(F.col("azimuth") != F.col("keep_azimuth")).join(inventory, ["site", "azimuth"], "left").join(size, "cluster_id").join(evidence, "cluster_id")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_sequences", "n_train", "n_val", "n_test")}
    return rows.withColumns(zero).withColumns({"discard_azimuth": F.col("azimuth"), "votes_discard": F.col("votes"), "evidence_pairs": text}).select(*REMAP_COLUMNS)


def remap_totals(remapped: DataFrame) -> DataFrame:
    """One row: clusters, azimuths that go, and the sequences they have, in all and by split."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return remapped.agg(F.count_distinct("cluster_id").alias("clusters"), F.count("*").alias("azimuths"), *map(total, ("n_sequences", "n_train", "n_val", "n_test")))


def rename_plan(registry: DataFrame, remapped: DataFrame, on_disk: DataFrame) -> DataFrame:
    """id, old and new camera and folder, and the action: rename, or registry-only where the folder has its new name already.

    Folders that don't begin with their camera, or are missing under both names, are left out.
    """
    c = F.col("camera")
    rows = registry.withColumns({"site": site(c), "azimuth": azimuth(c)}).join(remapped.select("site", F.col("discard_azimuth").alias("azimuth"), "keep_azimuth"), ["site", "azimuth"])
    rows = rows.where(F.col("folder").startswith(F.concat(c, F.lit("_"))))
    new_camera = F.concat_ws("_", "site", F.col("keep_azimuth").cast("string"))
    rows = rows.select("id", c.alias("old_camera"), new_camera.alias("new_camera"), F.col("folder").alias("old_folder"), F.concat(new_camera, F.substr("folder", F.length("camera") + 1)).alias("new_folder"))
    disk = on_disk.select("folder").distinct()
    rows = rows.join(disk.select(F.col("folder").alias("old_folder"), F.lit(True).alias("has_old")), "old_folder", "left").join(disk.select(F.col("folder").alias("new_folder"), F.lit(True).alias("has_new")), "new_folder", "left")
    rows = rows.where(F.col("has_old").isNotNull() | F.col("has_new").isNotNull())
    return rows.select("id", "old_camera", "new_camera", "old_folder", "new_folder", F.when(F.col("has_old").isNotNull(), "rename").otherwise("registry-only").alias("action"), (F.col("has_old").isNotNull() & F.col("has_new").isNotNull()).alias("target_exists"))


def collisions(plan: DataFrame) -> DataFrame:
    """New folders that several old ones would take, or that exist beside the old one."""
    return plan.groupBy("new_folder").agg(F.count_distinct("old_folder").alias("sources"), F.bool_or("target_exists").alias("target_exists")).where("sources > 1 or target_exists")


def apply_plan(registry: DataFrame, plan: DataFrame) -> DataFrame:
    p = plan.select("id", "new_camera", "new_folder")
    return registry.join(p, "id", "left").select("id", F.coalesce("new_folder", "folder").alias("folder"), F.coalesce("new_camera", "camera").alias("camera"), "split")


def plan_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy(site(F.col("old_camera")).alias("site"), "action").agg(F.count("*").alias("n"))
