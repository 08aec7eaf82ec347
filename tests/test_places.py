"""Places by ranges, and what is built on them."""

import random

import pytest
from pyspark.sql import functions as F

from lookout.operators import ranks, sampling, select, sets
from lookout.operators.store import Scratch


@pytest.mark.parametrize("partitions", [1, 4])
def test_numbered(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "bb", "b", "ä", ""]), i) for i in rng.sample(range(500), 300)]
    with Scratch(spark) as scratch:
        got = ranks.numbered(spark.createDataFrame(rows, "t string, n long").repartition(partitions), ["t", "n"], scratch).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    assert [(r.t, r.n) for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == [*range(1, 301)]
    with Scratch(spark) as scratch:
        assert ranks.numbered(spark.createDataFrame([], "t string, n long"), ["t"], scratch).collect() == []


def test_round_robin_over_quotas(spark):
    rng = random.Random(2)
    rows = [(f"f{rng.randint(0, 9)}", f"s{i}", rng.choice([0.1, 0.5, 0.9])) for i in range(80)]
    df = spark.createDataFrame(rows, "folder string, stem string, score double")
    by = {}
    for f, s, x in sorted(rows, key=lambda r: (-r[2], r[1])):
        by.setdefault(f, []).append(s)
    order = [(by[f][t]) for t in range(80) for f in sorted(by) if t < len(by[f])]
    for quota in (0, 1, 9, 10, 25, 79, 80, 500):
        assert {r.stem for r in sampling.round_robin(df, quota).collect()} == set(order[:quota])


def test_move_numbers_in_order(spark):
    schema = "id string, folder string, camera string, split string"
    source = spark.createDataFrame([(f"fp_{i:08d}", f"g{99 - i}", "c", "train") for i in range(50)], schema)
    target = spark.createDataFrame([("wf_00000007", "g60", "c", "val")], schema)
    left, added = sets.move(source, target, source.where("id < 'fp_00000045'").select("folder"), "wf")
    got = {r.folder: r.id for r in added.collect()}
    moved = sorted(f"g{99 - i}" for i in range(45) if 99 - i != 60)
    assert got == {"g60": "wf_00000007"} | {f: f"wf_{8 + i:08d}" for i, f in enumerate(moved)}
    assert {r.folder for r in left.collect()} == {f"g{99 - i}" for i in range(50)} - set(moved)


def test_assign_in_blocks(spark):
    rng = random.Random(3)
    vectors = {i: [rng.gauss(0, 1) for _ in range(3)] for i in range(40)}
    centres = {f"c{j:02d}": [rng.gauss(0, 1) for _ in range(3)] for j in range(20)} | {"c99": None}
    centres["c99"] = centres["c03"]
    df = spark.createDataFrame([*vectors.items(), (100, None)], "id long, embedding array<double>")
    table = spark.createDataFrame(list(centres.items()), "label string, centroid array<double>")
    want = {i: min(centres, key=lambda c: (-round(sum(a * b for a, b in zip(x, centres[c])), 9), c)) for i, x in vectors.items()}
    for most in (4, 1000):
        assert {r.id: r.label for r in select.assign(df, table, "label", "id", most).collect()} == want
    assert select.assign(df, table.limit(0), "label", "id").collect() == []
    assert select.assign(df.limit(0), table, "label", "id").where(F.col("id") > 0).collect() == []


def test_reading_asks_for_no_sizes(spark, tmp_path, monkeypatch):
    """One task lists a flat folder, so what it does for each file no other task shortens: it asks for no size that isn't used."""
    import pyarrow.fs

    from lookout.sources import places as p

    (tmp_path / "d").mkdir()
    for name in ("a.txt", "d/b.txt"):
        (tmp_path / name).write_text("text")
    assert sorted(p._entries(pyarrow.fs.LocalFileSystem(), str(tmp_path), sizes=False)) == [(f"{tmp_path}/a.txt", 0), (f"{tmp_path}/d", None)]
    assert sorted(map(tuple, p.listed(spark, str(tmp_path)).collect())) == [("a.txt", 4), ("d/b.txt", 4)]
    asked, whole = [], p.listed
    monkeypatch.setattr(p, "listed", lambda *a, **k: asked.append(k) or whole(*a, **k))
    assert sorted(map(tuple, p.read_files(spark, str(tmp_path)).collect())) == [("a.txt", "text"), ("d/b.txt", "text")]
    assert asked == [{"sizes": False}]
