"""The pipeline's stages over a small table: what each leaves, and that decisions take effect."""

import os

import pytest

from .helpers import prose, rows, table

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark):
    from lookout.llm import jaccard, langid, mil, mixing
    from lookout.llm.common import documents, materialise

    docs, names = documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF), "stage")
        names.append(name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert out.dtypes == docs.dtypes
        if name == "language":
            gone = {r.doc_id for r in langid.identify(docs).where("rejected").collect()}
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - gone
        elif name == "quality":
            scored = mil.score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in scored.where("predicted = 1").collect()}
        elif name == "near duplicates":
            groups = jaccard.jaccard_components(docs, 5, 80)
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.component_id for r in groups.select("component_id").distinct().collect())
        elif name == "mixture":
            taken = {r.doc_id: r.taken for r in mixing.mix_sources(docs).where("taken > 0").collect()}
            words = {}
            for r in out.collect():
                words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
            assert words == taken
        docs = out
    assert len(names) == 5
    result = corpus_pipeline.run(spark, SF)
    assert sorted(map(repr, result.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(repr, docs.select("doc_id", "piece", "ids_crc32").collect()))


def odd_tables(spark, folder, data):
    """Documents with awkward rows and columns whose names the operators use themselves, and labels."""
    from pyspark.sql import functions as F

    docs = table(spark, data).withColumns({c: F.lit("x") for c in ("_bucket", "_set_key", "set_key", "mix_bucket", "mix_at", "tie", "comp", "_mix_size", "bag", "rejected")})
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], int(i % 4 > 0)) for i, r in enumerate(data)] + [(None, 1), (10**6, None)], "doc_id long, quality int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_stages_with_awkward_rows(spark, tmp_path):
    """Nulls, repeats, empty and long texts and clashing names through all stages, one after another."""
    import random

    from lookout.llm.common import materialise

    rng = random.Random(1)
    data = rows(80) + [(500 + i, prose(rng, 120, "en"), "en", None if i % 2 else "s9", None) for i in range(30)]
    docs = odd_tables(spark, tmp_path, data)
    first = docs
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, str(tmp_path)), "stage")
        sizes.append(out.count())
        if name != "sequences":
            assert (out.columns, out.dtypes) == (first.columns, first.dtypes)
            assert out.where("_set_key <> 'x' or mix_at <> 'x' or tie <> 'x'").count() == 0
        if name in ("language", "quality", "near duplicates"):
            whole = {(r.doc_id, r.text) for r in docs.collect()}
            assert {(r.doc_id, r.text) for r in out.collect()} <= whole
        docs = out
    assert 0 < sizes[2] < sizes[0] < len(data)
    assert sizes[-1] > 0


def test_stages_of_an_empty_table(spark, tmp_path):
    odd_tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_tables_go(spark):
    """Of what run() writes only what its lazy result reads stays, until clear()."""
    from lookout.llm import common

    common.clear(spark)
    folder = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    result = corpus_pipeline.run(spark, SF)
    left = {x for x in os.listdir(folder) if x not in before and "-" in x and len(x.rpartition("-")[2]) == 32}
    assert {x.rpartition("-")[0] for x in left} == {"mixture", "pieces"}
    assert result.count() > 0
    common.clear(spark)
    assert not left & set(os.listdir(folder))


@pytest.mark.parametrize("partitions", [1, 3, 5])
def test_survivor_of_ties(spark, partitions):
    """Rows with one doc_id and one set of words: the same one stays however they are dealt."""
    from lookout.llm.jaccard import keep_one

    words = " ".join(f"w{i}" for i in range(20))
    data = [(1, f"{words} j", "a"), (1, f"{words} J", "b"), (1, f"{words}  j", "c"), (1, f"{words} j", "a"), (2, "other words", "d")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    survivors = {tuple(r) for n in (1, 2, 7) for r in keep_one(docs.repartition(n), 5, 80).collect()}
    assert len(survivors) == 2
    assert {tuple(r) for r in keep_one(docs.repartition(partitions), 5, 80).collect()} == survivors
