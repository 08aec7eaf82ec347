"""Versions that are published whole: readers beside writers, two writers, partitions left alone, batches counted once."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lookout import streaming
from lookout.sources import committed

SCHEMA = "split string, name string, n int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_reader_sees_old_or_new(spark, tmp_path):
    root = str(tmp_path / "t")
    committed.save(table(spark, [("a", "x", 1), (None, "y", 2)]), root, ["split"])
    before = committed.read(spark, root)
    committed.save(committed.read(spark, root).where("n = 2"), root, ["split"])  # from where it goes
    assert got(before) == [("a", "x", 1), (None, "y", 2)]
    assert got(committed.read(spark, root)) == [(None, "y", 2)] or sorted(committed.read(spark, root).columns) == ["n", "name", "split"]
    assert committed.read(spark, root).where("split IS NULL AND n = 2").count() == committed.read(spark, root).count() == 1
    assert got(committed.read(spark, root, 1)) == got(before)
    committed.save(table(spark, []), root)
    assert committed.read(spark, root).collect() == []
    with pytest.raises(FileNotFoundError):
        committed.read(spark, str(tmp_path / "none"))


def test_of_two_writers_one_fails_cleanly(spark, tmp_path):
    root = str(tmp_path / "t")
    base = committed.save(table(spark, [("a", "x", 1)]), root)
    committed.merge(table(spark, [("a", "x", 2)]), root, ["split", "name"], base=base)
    files = set(os.listdir(f"{root}/data"))
    for write in (lambda: committed.merge(table(spark, [("a", "x", 3)]), root, ["split", "name"], base=base), lambda: committed.save(table(spark, []), root, base=base)):
        with pytest.raises(committed.Conflict):
            write()
    assert set(os.listdir(f"{root}/data")) == files
    assert got(committed.read(spark, root)) == [("a", "x", 2)]


def test_the_last_step_is_one_create(spark, tmp_path, monkeypatch):
    """Two writers that both saw the same newest version: only one can create the next document."""
    root = str(tmp_path / "t")
    base = committed.save(table(spark, [("a", "x", 1)]), root)
    numbers = committed.versions(spark, root)
    committed.save(table(spark, [("a", "x", 2)]), root, base=base)
    monkeypatch.setattr(committed, "versions", lambda *a: numbers)
    with pytest.raises(committed.Conflict):
        committed.save(table(spark, [("a", "x", 3)]), root, base=base)
    monkeypatch.undo()
    assert got(committed.read(spark, root)) == [("a", "x", 2)]


def test_a_broken_document_is_no_version(spark, tmp_path):
    root = str(tmp_path / "t")
    committed.save(table(spark, [("a", "x", 1)]), root)
    (tmp_path / "t/versions/000000000002.json").write_text('{"number": 2, "sch')
    assert got(committed.read(spark, root)) == [("a", "x", 1)]
    assert committed.save(table(spark, [("a", "x", 5)]), root).number == 3
    assert got(committed.read(spark, root)) == [("a", "x", 5)]


def test_merge_rewrites_only_what_it_touches(spark, tmp_path):
    root, key = str(tmp_path / "t"), ["split", "name"]
    first = committed.merge(table(spark, [("a", "x", 1), ("b=%/ é", "x", 1), (None, "x", 1), ("c", None, 1)]), root, key, ["split"])
    second = committed.merge(table(spark, [("a", "x", 7), ("a", "z", 2), ("c", None, 3), ("c", None, 4), ("new", "w", 1)]), root, key)
    want = {("a", "x", 7), ("a", "z", 2), ("b=%/ é", "x", 1), (None, "x", 1), ("c", None, 4), ("new", "w", 1)}
    assert {(r["split"], r["name"], r["n"]) for r in committed.read(spark, root).collect()} == want
    kept = {json.dumps(p, sort_keys=True) for p in first.parts} & {json.dumps(p, sort_keys=True) for p in second.parts}
    assert {json.loads(p)["values"]["split"] for p in kept} == {"b=%/ é", None}
    with pytest.raises(ValueError, match="partition"):
        committed.merge(table(spark, []), root, ["name"])
    assert committed.vacuum(spark, root) == 0  # of the first version two partitions are in use
    committed.merge(table(spark, [("b=%/ é", "x", 2), (None, "x", 2)]), root, key)
    assert committed.vacuum(spark, root) == 1
    assert {(r["split"], r["n"]) for r in committed.read(spark, root).where("name = 'x'").collect()} == {("a", 7), ("b=%/ é", 2), (None, 2)}


def test_append_reads_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = table(spark, [("a", f"n{i}", i) for i in range(200)] + [("a", "n1", 1), (None, None, None)])
    assert committed.append_new(rows, root, buckets=64).number == 1
    assert committed.read(spark, root).count() == 201
    before = committed.version(spark, root)
    after = committed.append_new(table(spark, [("a", "n5", 5), (None, None, None), ("a", "n5", 6)]), root)
    assert committed.read(spark, root).count() == 202
    assert after.parts[: len(before.parts)] == before.parts and len(after.parts) == len(before.parts) + 1
    read = []
    whole = committed._rows
    committed._rows = lambda s, r, v, parts, columns=None: read.append((parts, columns)) or whole(s, r, v, parts, columns)
    try:
        committed.append_new(table(spark, [("a", "n7", 7)]), root)
    finally:
        committed._rows = whole
    (parts, columns), *_ = read
    assert len({p["values"]["_bucket"] for p in parts}) <= 1 and columns == ["_key", "_bucket"]
    keyed = str(tmp_path / "k")
    for n in (1, 2):
        committed.append_new(table(spark, [("a", "x", n), ("a", "y", n)]), keyed, key=["split", "name"])
    assert got(committed.read(spark, keyed)) == [("a", "x", 1), ("a", "y", 1)]


def test_stream_counts_each_batch_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    root, go = str(tmp_path / "s"), lambda: streaming.ingest_once(spark, str(tmp_path / "in"), "a long, b string", str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    for i in (1, 2):
        (tmp_path / f"in/{i}.json").write_text('{"a": 3}\n{"a": 3}\n{"a": 4}\n' + f'{{"a": {10 + i}}}\n')
        go()
    assert sorted(r.a for r in committed.read(spark, root).collect()) == [3, 4, 11, 12]
    number = committed.version(spark, root).number
    batch = spark.createDataFrame([(99, "lost and run again")], "a long, b string")
    committed.append_new(batch, root, batch=(str(tmp_path / "c"), 0))
    assert committed.version(spark, root).number == number
    assert committed.read(spark, root).where(F.col("a") == 99).count() == 0


def test_merge_deals_rows_by_their_number(spark, tmp_path, monkeypatch):
    """A merge has as many tasks as its rows need, whatever their size in bytes; nulls in a key are alike."""
    monkeypatch.setattr(committed, "ROWS_A_TASK", 200)
    root = f"file://{tmp_path}/t"
    rows = spark.range(2000).selectExpr("id % 2 AS part", "CASE WHEN id > 1 THEN id END AS k", "'a' AS x")
    committed.merge(rows, root, ["part", "k"], ["part"])
    assert len(committed.read(spark, root).inputFiles()) >= 20  # ten tasks, two partitions; of so few bytes Spark makes one task a core
    committed.merge(rows.where("part = 1").withColumn("x", F.lit("b")), root, ["part", "k"])
    got = committed.read(spark, root)
    assert len(got.inputFiles()) >= 18
    assert {(r.part, r.x): r["count"] for r in got.groupBy("part", "x").count().collect()} == {(0, "a"): 1000, (1, "b"): 1000}
