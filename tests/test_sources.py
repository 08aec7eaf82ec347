import json

import pytest
from pyspark.sql import functions as F

from lookout import sources, streaming
from lookout.operators import quality


def test_registry(spark, tmp_path):
    assert sources.registry(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(FileNotFoundError):
        sources.registry(spark, str(tmp_path / "none.json"), strict=True)
    (tmp_path / "r.json").write_text(json.dumps({"sequences": [{"id": "wf_00000001", "folder": "f", "camera": "c", "split": "val"}]}, indent=2))
    assert [tuple(r) for r in sources.registry(spark, str(tmp_path / "r.json")).collect()] == [("wf_00000001", "f", "c", "val")]
    (tmp_path / "e.json").write_text("{}")
    assert sources.registry(spark, str(tmp_path / "e.json")).count() == 0


def test_files(spark, tmp_path):
    for name, text in {"s1/images/a.jpg": "x", "s1/images/b.PNG": "x", "s1/images/.c.jpg": "x", "s1/labels/a.txt": "0 1 1 1 1", "s1/images/d.gif": "x", ".hidden/images/a.jpg": "x"}.items():
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    got = {(r.folder, r.kind, r.stem, r.ext) for r in sources.files(spark, str(tmp_path)).collect()}
    assert got == {("s1", "images", "a", "jpg"), ("s1", "images", "b", "png"), ("s1", "labels", "a", "txt")}
    assert [(r.folder, r.stem, r.text) for r in sources.label_lines(spark, str(tmp_path / "s1")).collect()] == [("s1", "a", "0 1 1 1 1")]


def test_csv_and_decisions(spark, tmp_path):
    (tmp_path / "p.csv").write_text("site,azimuth_a,azimuth_b,n_kp_a,n_kp_b,n_good,n_inliers,dcx,h_scale,s_area,d_area\ns,1,2,3,4,5,6,0.5,,0.1,0.2\n")
    (r,) = sources.table(spark, str(tmp_path / "p.csv"), sources.PAIRS).collect()
    assert r.h_scale is None
    assert r.dcx == 0.5
    (tmp_path / "d.json").write_text(json.dumps({"s|1|2": {"status": "accepted", "kept_azimuth": 1, "n_inliers": 6, "decided_at": "t"}}, indent=1))
    (d,) = sources.decisions(spark, str(tmp_path / "d.json")).collect()
    assert (d.pair_id, d.azimuth_b, d.status, d.kept_azimuth, d.discarded_azimuth) == ("s|1|2", 2, "accepted", 1, None)
    assert sources.decisions(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "q.csv").write_text("a,b\n1,2\n")
    (tmp_path / "z.csv").write_text("")
    assert [tuple(r) for r in sources.tables(spark, [str(tmp_path / "q.csv"), str(tmp_path / "z.csv")]).collect()] == [("1", "2")]


def test_append_and_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a long, b string")
    for _ in range(2):
        sources.append_table(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"a": 3}\n{"a": 3}\n')
    for i in (1, 2):
        (tmp_path / f"in/{i}.json").write_text('{"a": 3}\n{"a": 3}\n{"a": 4}\n')
        streaming.ingest(spark, str(tmp_path / "in"), "a long, b string", str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2


def test_counts_and_yaml(spark):
    rows = quality.file_counts(spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "folder string, kind string"), ["x", "y"]).collect()
    assert {r.folder: r.agree for r in rows} == {"a": True, "b": False}
    assert "nc: 1" in sources.dataset_yaml(["smoke"])


def test_registry_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(f"wf_{i:08d}", f"f{i}", None if i == 3 else "c", "train") for i in range(1, 6)], sources.REGISTRY)
    path = str(tmp_path / "r")
    sources.save_registry(rows, path)
    assert sorted(map(repr, sources.registry(spark, path).collect())) == sorted(map(repr, rows.collect()))
    sources.save_registry(sources.registry(spark, path).where("id <> 'wf_00000001'"), path)  # from where it goes
    assert sources.registry(spark, path, strict=True).count() == 4
    sources.save_registry(rows.limit(0), path)
    assert sources.registry(spark, path).count() == 0
    sources.export_registry(rows, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())["sequences"][0] == {"id": "wf_00000001", "folder": "f1", "camera": "c", "split": "train"}
    assert (tmp_path / "r.json").read_text().startswith('{\n  "sequences": [\n    {')
    assert sorted(map(repr, sources.registry(spark, str(tmp_path / "r.json")).collect())) == sorted(map(repr, rows.collect()))


@pytest.mark.parametrize("text", ['{"id": "wf_1", "folder": "f"}\n{"id": "wf_2"}\n', "[1, 2]", "no json", '{"sequences": 5}'])
def test_no_registry_is_no_empty_table(spark, tmp_path, text):
    """A file with something else in it is an error, as far as it can be told from one without the key."""
    (tmp_path / "r.json").write_text(text)
    with pytest.raises(Exception, match="regist|sequences"):
        sources.registry(spark, str(tmp_path / "r.json"), strict=True).collect()
    if not text.startswith('{"id"'):
        with pytest.raises(Exception, match="regist"):
            sources.registry(spark, str(tmp_path / "r.json")).collect()


def test_names_with_spaces_and_empty_folders(spark, tmp_path):
    (tmp_path / "s 1/labels").mkdir(parents=True)
    (tmp_path / "s 1/labels/a b.txt").write_text("0 1 1 1 1")
    (tmp_path / "empty").mkdir()
    (tmp_path / ".dot").mkdir()
    assert [r.folder for r in sources.folders(spark, str(tmp_path)).collect()] == ["empty", "s 1"]
    a, b = sources.files(spark, str(tmp_path)).collect(), sources.label_lines(spark, str(tmp_path)).collect()
    assert [(r.folder, r.stem) for r in a] == [(r.folder, r.stem) for r in b] == [("s 1", "a b")]


def test_datasets(spark, tmp_path):
    schema = "folder string, stem string, split string, label string"
    a, b, c = (str(tmp_path / x) for x in "abc")
    sources.save_dataset(spark.createDataFrame([("f", "1", "train", "x"), ("f", "2", "val", "x"), ("f", "3", "test", "x")], schema), a)
    sources.save_dataset(spark.createDataFrame([("f", "1", "train", "y"), ("g", "1", "train", "y")], schema), b)
    sources.combine_datasets(spark, [a, b], c, ("train", "val"))
    assert {(r.folder, r.stem, r.split, r.label) for r in spark.read.parquet(c).collect()} == {("f", "1", "train", "y"), ("g", "1", "train", "y"), ("f", "2", "val", "x")}
    info = sources.dataset_info(spark, f"{c}.yaml")
    assert info["splits"] == ["train", "val"]
    assert (info["nc"], info["names"]) == (1, ["smoke"])
    sources.copy_dataset(spark, a, c, ("test",))
    assert spark.read.parquet(c).count() == 4  # what was there stays
    with pytest.raises(ValueError, match="split"):
        sources.copy_dataset(spark, a, c, ())
    sources.merge_dataset(spark.createDataFrame([("f", "2", "val", "z")], schema), c)
    assert {r.label for r in spark.read.parquet(c).where("split = 'val'").collect()} == {"z"}


def test_yaml():
    assert sources.parse_yaml("path: ..\n# note\ntrain: ./images/train  # here\nnc: 2\nnames:\n- smoke\n- 'fire'\nx:\ny: [1, b]\n") == {"path": "..", "train": "./images/train", "nc": 2, "names": ["smoke", "fire"], "x": None, "y": [1, "b"]}
    with pytest.raises(ValueError, match="not read"):
        sources.parse_yaml("a: 1\n  ? b")


def test_embeddings_and_runs(spark, tmp_path):
    rows = spark.createDataFrame([(1, "train", [1.0, 2.0]), (2, "val", [3.0, 4.0])], "id long, split string, embedding array<double>")
    path = str(tmp_path / "e")
    sources.save_embeddings(rows, path)
    assert [r.id for r in sources.embeddings(spark, path, "val").collect()] == [2]
    assert sources.embeddings(spark, path).count() == 2
    with pytest.raises(ValueError, match="no embeddings"):
        sources.embeddings(spark, path, "test")
    for odd in ([1.0], None):
        with pytest.raises(ValueError, match="numbers"):
            sources.save_embeddings(rows.unionByName(spark.createDataFrame([(3, "val", odd)], rows.schema)), path)
    log = str(tmp_path / "runs")
    assert sources.runs(spark, log, "n long, at string").count() == 0
    for n in (1, 2):
        sources.append_run(spark, log, {"n": n, "at": "now"})
    assert sorted((r.n, r["at"]) for r in sources.runs(spark, log, "n long, at string").collect()) == [(1, "now"), (2, "now")]


def test_append_by_key_and_platform_json(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "d1"), (2, None, "d1"), (3, "c", "d2")], "id long, name string, day string")
    path = str(tmp_path / "t")
    for _ in range(2):
        sources.append_table(rows, path, ["day"])
    sources.append_table(rows.where("day = 'd2'").withColumn("name", F.lit("x")), path, ["day"])
    assert sorted((r.id, r.name, r.day) for r in spark.read.parquet(path).select("id", "name", "day").collect() if r.id != 2) == [(1, "a", "d1"), (3, "c", "d2"), (3, "x", "d2")]
    assert spark.read.parquet(path).count() == 4
    (tmp_path / "c.json").write_text('{"id": 1, "name": "cam"}\n{"id": 2}\n')
    assert [tuple(r) for r in sources.platform_table(spark, str(tmp_path / "c.json"), "id long, name string").collect()] == [(1, "cam"), (2, None)]
    sources.save_csv(rows, str(tmp_path / "csv"), ["id"])
    assert sources.table(spark, str(tmp_path / "csv"), "id long, name string, day string").count() == 3
