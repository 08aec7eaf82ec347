"""A platform's pages as tables: a Python data source over days, and requests for each row of a table.

Requests go through a transport: what `module:factory` makes of a JSON object of arguments, in each task.  It is called with a route and parameters, and gives the parsed answer.
HttpTransport is the one for the platform itself; tests and queries bring their own.  A request that fails is tried again, after a wait that doubles; an
answer that isn't a list of objects is an error document and fails the job.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from lookout.operators.store import Scratch, ship

FORMAT = "lookout_pages"
#: What the platform calls its lists, and how many sequences of a day one request asks for.
ROUTES = {"sequences": "/api/v1/sequences/all/fromdate", "detections": "/api/v1/sequences/{id}/detections", "cameras": "/api/v1/cameras/", "organizations": "/api/v1/organizations/", "login": "/api/v1/login/creds"}
PAGE = 1000
#: Rows that answers are gathered up to before they are given to Spark, as an answer may be small.
BATCH = 5000

Transport = Callable[[str, dict], object]


class HttpTransport:
    """GET requests with a token.  The token is in an environment variable of the tasks, or is got with the name and password in two others; none of them is an option."""

    def __init__(self, endpoint: str, token: str = "PLATFORM_TOKEN", login: str = "PLATFORM_LOGIN", password: str = "PLATFORM_PASSWORD", timeout: float = 30):
        self.endpoint, self.timeout = endpoint.rstrip("/"), timeout
        self.token = os.environ.get(token) or self._log_in(os.environ[login], os.environ[password])

    def _log_in(self, name: str, password: str) -> str:
        data = urllib.parse.urlencode({"username": name, "password": password}).encode()
        with urllib.request.urlopen(urllib.request.Request(self.endpoint + ROUTES["login"], data=data), timeout=self.timeout) as answer:
            return json.load(answer)["access_token"]

    def __call__(self, route: str, params: dict) -> object:
        """The answer as JSON whatever its status; one that is none is an error."""
        url = f"{self.endpoint}{route}" + (f"?{urllib.parse.urlencode(params)}" if params else "")
        request = urllib.request.Request(url, headers={"Authorization": f"Bearer {self.token}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                status, body = answer.status, answer.read()
        except urllib.error.HTTPError as e:
            status, body = e.code, e.read()
        try:
            return json.loads(body)
        except ValueError:
            raise OSError(f"{status} for {route}: {body[:200]!r}") from None


def made(transport: str, args: str = "{}") -> Transport:
    module, _, factory = transport.partition(":")
    return getattr(importlib.import_module(module), factory)(**json.loads(args))


def asked(get: Transport, route: str, params: dict, retries: int = 3, wait: float = 1.0) -> list[dict]:
    """A list of objects, or the error of the last of `retries` tries more."""
    for left in range(retries, -1, -1):
        try:
            found = get(route, params)
            break
        except Exception:
            if not left:
                raise
            time.sleep(wait)
            wait *= 2
    if isinstance(found, dict) and "id" in found:
        found = [found]  # one object, asked for by its id
    if not isinstance(found, list) or not all(isinstance(x, dict) for x in found):
        raise ValueError(f"no list of objects for {route} {params}: {str(found)[:200]}")
    return found


def _batch(found: list[dict], schema: T.StructType) -> pa.RecordBatch:
    """Objects as rows: what a schema calls text and is none stays JSON; a missing key is null."""
    as_text = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    value = lambda x, name: x if x is None or name not in as_text or isinstance(x, str) else json.dumps(x)
    return pa.RecordBatch.from_pylist([{n: value(x.get(n), n) for n in schema.fieldNames()} for x in found], to_arrow_schema(schema))


@dataclass
class Days(InputPartition):
    first: int
    last: int
    lane: int


class PageReader(DataSourceReader):
    """Pages of lists by day.  A partition is some days and a lane: it reads every `lanes`-th page of each day, until one is short, so it needs no other and no count."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.schema = dict(options), schema
        self.lanes, self.page = int(options.get("lanes", 1)), int(options.get("page", PAGE))

    def partitions(self) -> list[Days]:
        first, end = (dt.date.fromisoformat(self.options[c]).toordinal() for c in ("from", "to"))
        if first > end:
            raise ValueError(f"from {self.options['from']} is after {self.options['to']}")
        step = int(self.options.get("days", 1))
        return [Days(a, min(a + step, end), lane) for a in range(first, end, step) for lane in range(self.lanes)] or [Days(first, first, 0)]

    def read(self, partition: Days) -> Iterator[pa.RecordBatch]:
        o = self.options
        get = made(o["transport"], o.get("args", "{}"))
        rows: list[dict] = []
        for day in range(partition.first, partition.last):
            offset = partition.lane * self.page
            while True:
                found = asked(get, o.get("route", ROUTES["sequences"]), {"from_date": dt.date.fromordinal(day).isoformat(), "limit": self.page, "offset": offset}, int(o.get("retries", 3)), float(o.get("wait", 1)))
                rows += found
                if len(rows) >= BATCH:
                    yield _batch(rows, self.schema)
                    rows = []
                if len(found) < self.page:
                    break
                offset += self.lanes * self.page
        if rows:
            yield _batch(rows, self.schema)


class PagedPlatform(DataSource):
    """Format `lookout_pages`: options transport, args, route, from, to (not included), page, days and lanes of a partition, retries, wait; with a schema."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("give the schema of the list's objects")

    def reader(self, schema: T.StructType) -> PageReader:
        return PageReader(self.options, schema)


def pages(spark: SparkSession, transport: str, first: str, end: str, schema: str, args: dict | None = None, **options) -> DataFrame:
    """The list's objects of all days from `first` up to, not including, `end`."""
    ship(spark)
    spark.dataSource.register(PagedPlatform)
    reader = spark.read.format(FORMAT).schema(schema).option("transport", transport).option("args", json.dumps(args or {})).option("from", first).option("to", end)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


def fetched(ids: DataFrame, transport: str, route: str, schema: str, args: dict | None = None, params: dict | None = None, tasks: int | None = None, retries: int = 3, wait: float = 1.0) -> DataFrame:
    """The objects that a route with {id} gives for each id of ids(id), with that id as `of_id`: a sequence's detections, a camera, an organization.

    Each id is asked for once, however often it stands there; null ids aren't.  With `tasks`, a task asks for ids that lie together, in their order, so a platform that
    keeps them so reads what it has once; ids are then read twice.
    """
    ship(ids.sparkSession)
    kind = T.StructType([T.StructField("of_id", T.LongType()), *T.StructType.fromDDL(schema).fields])
    own = T.StructType(kind.fields[1:])

    def rows(of: list[int], found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), *_batch(found, own).columns], [f.name for f in kind.fields])

    def run(batches):
        get = made(transport, json.dumps(args or {}))
        of, gathered = [], []
        for batch in batches:
            for i in batch.column(0).to_pylist():
                found = asked(get, route.format(id=i), params or {}, retries, wait)
                of += [i] * len(found)
                gathered += found
                if len(gathered) >= BATCH:
                    yield rows(of, gathered)
                    of, gathered = [], []
        if gathered:
            yield rows(of, gathered)

    distinct = ids.select(F.col("id").cast("long").alias("id")).where("id IS NOT NULL").distinct()
    return (distinct.repartitionByRange(tasks, "id").sortWithinPartitions("id") if tasks else distinct).mapInArrow(run, kind)


def updates(spark: SparkSession, transport: str, first: str, end: str, schemas: dict[str, str], args: dict | None = None, limit: int = 10, newest_first: bool = True, tasks: int | None = None, retries: int = 3, wait: float = 1.0, **options) -> dict[str, DataFrame]:
    """sequences of the days, their detections (at most `limit` each, the newest or the oldest), cameras and organizations: what platform.records() joins."""
    scratch = Scratch(spark)
    sequences = scratch.keep(scratch.cut(pages(spark, transport, first, end, schemas["sequences"], args, retries=retries, wait=wait, **options)))  # each page is asked for once
    again = {"tasks": tasks or 4 * spark.sparkContext.defaultParallelism, "retries": retries, "wait": wait}  # requests wait for answers, so tasks are many however small their rows
    detections = fetched(sequences.select("id"), transport, ROUTES["detections"], schemas["detections"], args, {"limit": limit, "desc": str(newest_first).lower()}, **again)
    one = spark.range(1).select(F.lit(0).cast("long").alias("id"))
    lists = {name: scratch.keep(scratch.cut(fetched(one, transport, ROUTES[name], schemas[name], args, retries=retries, wait=wait).drop("of_id"))) for name in ("cameras", "organizations")}  # written, as Spark takes what one request gives for a row
    return {"sequences": sequences, "detections": detections.withColumn("sequence_id", F.col("of_id")).drop("of_id"), **lists}
