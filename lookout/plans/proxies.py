"""The engine's tables as made from the test tables, in SQL that Spark and DuckDB read alike; {name} stands for a test table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_PART = "lpad(CAST({0}(ts) AS STRING), {1}, '0')"
_STAMP = "concat(" + ", '-', ".join(_PART.format(f, n) for f, n in (("year", 4), ("month", 2), ("day", 2))) + ", 'T', " + ", '-', ".join(_PART.format(f, 2) for f in ("hour", "minute", "second")) + ")"
_SPLIT = "CASE WHEN substr(md5({0}), 1, 1) < 'd' THEN 'train' WHEN substr(md5({0}), 1, 1) = 'd' THEN 'val' ELSE 'test' END"

PROXIES: dict[str, str] = {
    # a sequence for each event; a camera for each type, user and a quarter of the horizon
    "seqs": f"SELECT min(event_id) AS event_id, folder, min(ts) AS ts FROM (SELECT event_id, ts, concat('src_', event_type, '-u', CAST(user_id AS STRING), '_', CAST((event_id % 4) * 90 AS STRING), '_', {_STAMP}) AS folder FROM {{events}}) x GROUP BY folder",
    "registry": f"SELECT concat('wf_', lpad(CAST(event_id AS STRING), 8, '0')) AS id, folder, regexp_extract(folder, '^(.*?)_[0-9][0-9][0-9][0-9][^a-zA-Z]', 1) AS camera, {_SPLIT.format('folder')} AS split, ts, event_id FROM <seqs>",
    # a frame for each distinct line of an order, with a box
    "frames": f"SELECT *, {_SPLIT.format('folder')} AS split FROM (SELECT concat('seq', CAST(l_orderkey % 400 AS STRING)) AS folder, concat('cam', CAST(l_orderkey % 40 AS STRING)) AS camera, concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS stem, 0 AS line, max(floor(l_discount * 1e2 + 5e-1) / 1e1) AS conf, max(CAST(l_partkey % 97 AS DOUBLE) / 97e0) AS cx, max(CAST(l_suppkey % 89 AS DOUBLE) / 89e0) AS cy, max(l_quantity / 1e2) AS w, max(5e-2 + CAST(l_linenumber % 5 AS DOUBLE) / 2e1) AS h, max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS has_label, max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS has_truth FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey) f",
    # label texts, some lines of which are broken
    "label_texts": "SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN concat('0 0.5 0.5 0.', CAST(n_chars AS STRING), ' 0.25') WHEN 2 THEN concat('0 0.1 0.2 0.3 0.4 0.', CAST(n_chars AS STRING), chr(10), chr(10), '1 0.5 0.5 0.1 0.1 0.0625') WHEN 3 THEN '0 0.5 x 0.1 0.1' WHEN 4 THEN '0 0 0 0 0' WHEN 5 THEN '0 0.25 0.5 0.5 0.5 high' ELSE '0 0.5 0.5' END AS text FROM {documents}",
    "stems": "SELECT event_id, concat(CASE event_id % 9 WHEN 0 THEN 'platform_' WHEN 1 THEN 'pyro_' WHEN 2 THEN 'ADF_' WHEN 3 THEN 'awf_' WHEN 4 THEN 'axis_' WHEN 5 THEN '2023_' WHEN 6 THEN 'sdis-77_' WHEN 7 THEN 'hpwren_' ELSE 'other_' END, CASE event_id % 3 WHEN 0 THEN concat('brison-', CAST(event_id % 361 AS STRING)) WHEN 1 THEN concat('st_peray_', CAST(event_id % 5 AS STRING)) ELSE 'tower' END, '_2023', CASE event_id % 4 WHEN 0 THEN '_07_12T13_24_14' WHEN 1 THEN '-05-24T16-45-00' WHEN 2 THEN '_13_40T25_61_00' ELSE '-07-12' END) AS stem FROM {events}",
    # viewpoints: nations are sites, suppliers' numbers azimuths
    "reps": "SELECT concat('site', CAST(s_nationkey AS STRING)) AS site, CAST(s_suppkey % 361 AS INT) AS azimuth, min(s_name) AS folder, max(s_name) AS latest_timestamp, count(*) AS n_sequences FROM {supplier} GROUP BY s_nationkey, s_suppkey % 361",
    "pairs": "SELECT a.site, a.azimuth AS azimuth_a, b.azimuth AS azimuth_b, CAST((a.azimuth * 7 + b.azimuth * 13) % 90 AS INT) AS n_inliers, CAST((a.azimuth + b.azimuth) % 31 AS DOUBLE) / 2e1 - 75e-2 AS dcx, CASE WHEN (a.azimuth + b.azimuth) % 5 = 0 THEN CAST(NULL AS DOUBLE) ELSE 5e-1 + CAST((a.azimuth * b.azimuth) % 14 AS DOUBLE) / 1e1 END AS h_scale FROM <reps> a JOIN <reps> b ON a.site = b.site AND a.azimuth < b.azimuth",
    "decisions": "SELECT concat_ws('|', site, CAST(azimuth_a AS STRING), CAST(azimuth_b AS STRING)) AS pair_id, CASE WHEN (azimuth_a * 3 + azimuth_b) % 7 = 0 THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN azimuth_a % 2 = 0 THEN azimuth_a ELSE azimuth_b END AS kept_azimuth FROM <pairs> p WHERE (azimuth_a + azimuth_b) % 4 <> 0",
    "accepted": "SELECT p.site, p.azimuth_a, p.azimuth_b, p.n_inliers, d.kept_azimuth FROM <pairs> p JOIN <decisions> d ON d.pair_id = concat_ws('|', p.site, CAST(p.azimuth_a AS STRING), CAST(p.azimuth_b AS STRING)) WHERE d.status = 'accepted'",
    "docs": f"SELECT doc_id, text, source, lang, n_chars, {_SPLIT.format('CAST(doc_id AS STRING)')} AS split, {_SPLIT.format('text')} AS text_split FROM {{documents}}",
    "items": "SELECT vec_id AS id, concat('f', CAST(vec_id AS STRING)) AS folder, concat('cam', CAST(label AS STRING)) AS camera, label, embedding FROM {embeddings}",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def text(name: str) -> str:
    """A proxy's SQL with the proxies it builds on put in."""
    return re.sub(r"<(\w+)>", lambda m: f"({text(m[1])})", PROXIES[name])


def proxy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = text(name)
    used = [t for t in TABLES if f"{{{t}}}" in sql]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def oracle(sql: str) -> str:
    """SQL over proxies, written <name>, for DuckDB."""
    out = re.sub(r"<(\w+)>", lambda m: f"({text(m[1])})", sql)
    return re.sub(rf"\{{({'|'.join(TABLES)})\}}", r"\1", out)
