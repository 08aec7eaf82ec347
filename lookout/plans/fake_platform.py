"""A platform that answers from the test tables: orders are sequences, their lines detections, suppliers cameras, nations organizations."""

from __future__ import annotations

import datetime as dt
import functools

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lookout.sources.paged import ROUTES
from lookout.sources.places import store

TRANSPORT = "lookout.plans.fake_platform:platform"
DAYS = ("1992-01-01", "2002-01-01")
SCHEMAS = {
    "sequences": "id long, camera_id long, started_at string, last_seen_at string, azimuth double, is_wildfire boolean",
    "detections": "id long, created_at string, azimuth double, url string, bboxes string, bucket_key string",
    "cameras": "id long, organization_id long, name string, lat double, lon double, is_trustable boolean, angle_of_view double",
    "organizations": "id long, name string",
}


#: Stretches of ids that detections are laid out by, at most: what a request reads is one of them.
STRETCHES = 500


def lay_out(spark: SparkSession, sf: str, root: str) -> dict:
    """The tables as the platform keeps them, below root: a folder for each month's sequences and for each stretch of sequences' detections; gives platform()'s arguments."""
    read = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    orders, cameras = read("orders"), read("supplier").select(F.col("s_suppkey").cast("long").alias("id"), F.col("s_nationkey").cast("long").alias("organization_id"), F.col("s_name").alias("name"))
    lines = read("lineitem").select(F.col("l_orderkey").cast("long").alias("of"), F.col("l_linenumber").cast("long").alias("line"), F.col("l_partkey").cast("long").alias("part"), F.col("l_suppkey").cast("long").alias("supplier"), F.col("l_discount").cast("double").alias("discount"))
    width = 1 + (lines.agg(F.max("of").alias("x")).first()["x"] or 0) // STRETCHES
    days = orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.unix_date(F.to_date("o_orderdate")).cast("long").alias("day"), F.col("o_orderkey").cast("long").alias("id"), (F.col("o_orderstatus") == "F").alias("fire"))
    tasks = 4 * spark.sparkContext.defaultParallelism
    days.repartitionByRange(tasks, "month").sortWithinPartitions("month", "day", "id").write.partitionBy("month").parquet(f"{root}/sequences")
    lines.withColumn("stretch", F.floor(F.col("of") / width)).repartitionByRange(tasks, "stretch").sortWithinPartitions("stretch", "of", "line", "part", "supplier").write.partitionBy("stretch").parquet(f"{root}/detections")
    cameras.write.parquet(f"{root}/cameras")
    read("nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")).write.parquet(f"{root}/organizations")
    return {"folder": root, "cameras": cameras.count(), "width": width}


def _table(folder: str, columns: tuple[str, ...]) -> pa.Table | None:
    """All rows of a folder, in the order of their files; none if it isn't there."""
    of, at = store(folder)
    if of.get_file_info(at).type == fs.FileType.NotFound:
        return None
    files = sorted(x.path for x in of.get_file_info(fs.FileSelector(at)) if x.path.endswith(".parquet"))
    return pa.concat_tables([pq.ParquetFile(of.open_input_file(f)).read(list(columns)) for f in files]) if files else None


@functools.lru_cache(2)
def _sorted(folder: str, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    found = _table(folder, names)
    return {} if found is None else {n: c.to_numpy() for n, c in zip(names, found.sort_by([(c, "ascending") for c in names]).columns, strict=True)}


def _run(t: dict[str, np.ndarray], column: str, value: int) -> range:
    """Where a value of the first column stands."""
    return range(*np.searchsorted(t[column], [value, value + 1]).tolist()) if t else range(0)


def platform(folder: str, cameras: int, width: int):
    """Lists by day with limit and offset, and detections by sequence, of which every 97th request fails once.  A task holds two months or two stretches of sequences at most."""
    asked = {"n": 0}

    def get(route: str, params: dict):
        asked["n"] += 1
        if asked["n"] % 97 == 0:
            raise OSError("try again")
        if route == ROUTES["sequences"]:
            day = params["from_date"]
            t = _sorted(f"{folder}/sequences/month={day[:7]}", ("day", "id", "fire"))
            some = _run(t, "day", (dt.date.fromisoformat(day) - dt.date(1970, 1, 1)).days)[params["offset"] : params["offset"] + params["limit"]]
            return [{"id": int(t["id"][i]), "camera_id": int(t["id"][i]) % cameras, "started_at": f"{day}T00:00:00", "last_seen_at": None, "azimuth": 1.5, "is_wildfire": bool(t["fire"][i])} for i in some]
        if route == ROUTES["cameras"]:
            return [r | {"is_trustable": True} for r in _table(f"{folder}/cameras", ("id", "organization_id", "name")).to_pylist()]
        if route == ROUTES["organizations"]:
            return _table(f"{folder}/organizations", ("id", "name")).to_pylist()
        of = int(route.split("/")[-2])
        t = _sorted(f"{folder}/detections/stretch={of // width}", ("of", "line", "part", "supplier", "discount"))
        at = _run(t, "of", of)
        return [{"id": 10 * of + int(t["line"][i]), "azimuth": float(t["part"][i]), "bboxes": [[0.1, 0.1, 0.2, 0.2, float(t["discount"][i])]]} for i in (at[::-1] if params["desc"] == "true" else at)[: params["limit"]]]

    return get
