"""Pages of a platform: every row once by any lanes and days, retries, stops, and a real server."""

import datetime as dt
import http.server
import json
import os
import threading
import urllib.parse

import pytest

from lookout.sources import paged

SCHEMA = "id long, name string, extra string, at double, flag boolean"


def counted(n_of="0,0,0", fails=0, broken=False):
    """A list for each day from 2024-01-01 on, with as many rows as said; the first `fails` requests of a task fail."""
    sizes, left = [int(x) for x in n_of.split(",")], [fails]

    def get(route, params):
        if left[0]:
            left[0] -= 1
            raise OSError("busy")
        if broken:
            return {"detail": "not allowed"}
        day = (dt.date.fromisoformat(params["from_date"]) - dt.date(2024, 1, 1)).days
        rows = [{"id": 1000 * day + i, "name": f"n{i}", "extra": {"a": [i]}, "at": i, "odd": 1} for i in range(sizes[day])]
        return rows[params["offset"] :][: params["limit"]]

    return get


@pytest.mark.parametrize("lanes,days,page", [(1, 1, 10), (3, 1, 4), (2, 5, 1), (4, 2, 100)])
def test_every_row_once(spark, lanes, days, page):
    sizes = "0,1,10,23,4"
    df = paged.pages(spark, "tests.test_paged:counted", "2024-01-01", "2024-01-06", SCHEMA, {"n_of": sizes, "fails": 2}, lanes=lanes, days=days, page=page, wait=0)
    rows = df.collect()
    assert sorted(r.id for r in rows) == [1000 * d + i for d, n in enumerate(map(int, sizes.split(","))) for i in range(n)]
    assert all((json.loads(r.extra), r.at, r.flag) == ({"a": [r.id % 1000]}, float(r.id % 1000), None) for r in rows)
    assert df.rdd.getNumPartitions() == lanes * -(-5 // days)


def test_a_lane_needs_no_other():
    """A partition reads its own pages and stops at a short one of its own."""
    from pyspark.sql.types import StructType

    options = {"transport": "tests.test_paged:counted", "args": json.dumps({"n_of": "23"}), "from": "2024-01-01", "to": "2024-01-02", "page": "5", "lanes": "2"}
    reader = paged.PageReader(options, StructType.fromDDL("id long"))
    got = [[i for b in reader.read(p) for i in b.column(0).to_pylist()] for p in reader.partitions()]
    assert got == [[0, 1, 2, 3, 4, 10, 11, 12, 13, 14, 20, 21, 22], [5, 6, 7, 8, 9, 15, 16, 17, 18, 19]]


def test_errors(spark):
    ask = lambda **a: paged.pages(spark, "tests.test_paged:counted", "2024-01-01", "2024-01-02", SCHEMA, a, retries=1, wait=0).collect()
    with pytest.raises(Exception, match="not allowed"):
        ask(broken=True)
    with pytest.raises(Exception, match="busy"):
        ask(n_of="1", fails=2)
    assert len(ask(n_of="1", fails=1)) == 1
    assert paged.pages(spark, "tests.test_paged:counted", "2024-01-02", "2024-01-02", SCHEMA).collect() == []
    with pytest.raises(Exception, match="after"):
        paged.pages(spark, "tests.test_paged:counted", "2024-01-03", "2024-01-02", SCHEMA).collect()


@pytest.fixture
def server(monkeypatch):
    seen = []

    class Platform(http.server.BaseHTTPRequestHandler):
        def answer(self, body, status=200):
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body if isinstance(body, bytes) else json.dumps(body).encode())

        def do_POST(self):
            form = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
            self.answer({"access_token": f"{form['username'][0]}!"})

        def do_GET(self):
            at = urllib.parse.urlparse(self.path)
            q = {k: v[0] for k, v in urllib.parse.parse_qs(at.query).items()}
            seen.append((at.path, q, self.headers["Authorization"]))
            if at.path == paged.ROUTES["sequences"]:
                self.answer([{"id": i, "name": q["from_date"]} for i in range(3)][int(q["offset"]) :][: int(q["limit"])])
            elif at.path == paged.ROUTES["detections"].format(id=2):
                self.answer([], 404)  # an answer counts whatever its status
            elif at.path.endswith("/detections"):
                self.answer([{"id": 10 * int(at.path.split("/")[-2]) + i, "name": q["desc"]} for i in range(int(q["limit"]))])
            else:
                self.answer(b"<html>", 500)

        def log_message(self, *_):
            pass

    http_server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Platform)
    threading.Thread(target=http_server.serve_forever, daemon=True).start()
    monkeypatch.setenv("PLATFORM_LOGIN", "me")
    monkeypatch.setenv("PLATFORM_PASSWORD", "secret")
    yield f"http://127.0.0.1:{http_server.server_port}", seen
    http_server.shutdown()


def test_http(server):
    url, seen = server
    get = paged.HttpTransport(url)
    assert paged.asked(get, paged.ROUTES["sequences"], {"from_date": "2024-01-01", "limit": 2, "offset": 1}) == [{"id": i, "name": "2024-01-01"} for i in (1, 2)]
    assert seen[-1][2] == "Bearer me!"
    assert paged.asked(get, paged.ROUTES["detections"].format(id=2), {}) == []
    with pytest.raises(OSError, match="500"):
        paged.asked(get, "/api/v1/cameras/", {}, retries=1, wait=0)


def objects(url="", first=0):
    return paged.HttpTransport(url, token="NO_SUCH_VARIABLE") if url else (lambda route, params: [{"id": 10 * int(route.split("/")[-2]) + i, "name": params["desc"]} for i in range(params["limit"])])


def test_fetched(spark):
    """Each id once, nulls not; rows carry the id they were asked for by."""
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    rows = paged.fetched(ids, "tests.test_paged:objects", paged.ROUTES["detections"], "id long, name string", {}, {"limit": 2, "desc": "true"}, tasks=3).collect()
    assert sorted(map(tuple, rows)) == [(1, 10, "true"), (1, 11, "true"), (2, 20, "true"), (2, 21, "true")]


def test_a_request_reads_a_part_of_the_tables(spark, tmp_path):
    """The platform of the queries keeps its tables by month and by stretches of ids; a task holds two parts, whatever tables there are."""
    from lookout.plans import fake_platform

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    args = fake_platform.lay_out(spark, sf, str(tmp_path / "p"))
    get = fake_platform.platform(**args)
    orders = spark.read.parquet(f"{sf}/orders.parquet").collect()
    day = f"{orders[0].o_orderdate:%Y-%m-%d}"
    want = sorted(o.o_orderkey for o in orders if f"{o.o_orderdate:%Y-%m-%d}" == day)
    assert [x["id"] for x in get(paged.ROUTES["sequences"], {"from_date": day, "limit": 10**6, "offset": 0})] == want
    parts = [len(t) for p in (tmp_path / "p" / "sequences").glob("month=*") if (t := fake_platform._table(str(p), ("id",)))]
    assert sum(parts) == len(orders) and max(parts) < len(orders) / 20
    assert fake_platform._sorted.cache_info().maxsize == 2


def test_fetched_records_are_not_broadcast(spark):
    """Spark's sizes are the requests', not those of the answers, so detections and sequences must be shuffled, whatever they seem to be."""
    from lookout.operators import platform
    from lookout.plans import fake_platform

    ids = spark.range(1).selectExpr("id")
    t = {name: paged.fetched(ids, "tests.test_paged:objects", paged.ROUTES["detections"], schema, {}, {"limit": 1, "desc": "true"}) for name, schema in fake_platform.SCHEMAS.items()}
    detections = t["detections"].withColumnRenamed("of_id", "sequence_id")
    for strict in (False, True):
        plan = platform.records(detections, t["sequences"].drop("of_id"), t["cameras"].drop("of_id"), t["organizations"].drop("of_id"), strict=strict)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [sequence_id" in plan and "HashJoin [sequence_id" not in plan
