import numpy as np
from pyspark.sql import functions as F

from lookout.llm import common
from lookout.llm.common import PLAIN_CODES, WordHasher, bounded_sample, free_names, offsets_within, shared_sketch


def test_offsets(spark):
    data = [(i % 3, i, (i * 7) % 11) for i in range(300)]
    got = offsets_within(spark.createDataFrame(data, "g int, i int, w int"), ["g"], ["i"], "w", "at", buckets=8).collect()
    for g in range(3):
        at = 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: (r.at, r.w)):
            assert r.at == at or r.w == 0
            at = r.at + r.w
        assert at == sum(w for x, _, w in data if x == g)
    ranks = offsets_within(spark.createDataFrame([(None, 1), (None, 2)], "g int, i int"), ["g"], ["i"], None, "at").collect()
    assert sorted(r["at"] for r in ranks) == [0, 1]


def test_hasher_and_sketch(spark):
    h = WordHasher(PLAIN_CODES)
    a, b = h(b"The cat\nsat THE cat " + "é".encode()), h(b"  cat the\t")
    assert len(a) == 6
    assert a[0] == a[3] == b[1]
    assert a[1] == a[4] == b[0]
    assert len(set(a.tolist())) == 4
    assert len(h(b"")) == 0
    assert len(h(b"x " * 40_000)) == 40_000
    keys = lambda batch: np.array(batch.column(0).to_pylist(), np.uint64) << np.uint64(54)
    assert shared_sketch(spark.range(1000).select((F.col("id") % 10).alias("k")), keys, 10, slices=8).tolist()[:11] == [100] * 10 + [0]


def test_bounded_sample(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).alias("g"))
    one, two = bounded_sample(df, "g", 20, ["doc_id", "g"]), bounded_sample(df.repartition(7), "g", 20, ["doc_id", "g"])
    assert len(one) == 40
    assert [r.doc_id for r in one] == [r.doc_id for r in two]
    assert bounded_sample(df.limit(0), "g", 20, ["doc_id", "g"]) == []
    null = df.withColumn("g", F.when(F.col("g"), F.lit("a"))).withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    assert [r.g for r in bounded_sample(null, "g", 20, ["doc_id", "g"])] == ["a"] * 20  # null groups teach nothing; null ids do
    few = df.where("doc_id < 30")
    assert sorted(r.doc_id for r in bounded_sample(few, "g", 20, ["doc_id"])) == sorted(set(range(0, 30, 10)) | {r.doc_id for r in bounded_sample(few.where("not g"), "g", 20, ["doc_id"])})


def test_free_names():
    assert free_names(["A", "b_"], "a", "b", "b_") == ["a_", "b", "b__"]


def test_temporary_tables(spark, tmp_path):
    import os

    with common.temporary(spark) as keep:
        one = common.materialise(spark.range(5), "one")
        two = keep(common.materialise(one.selectExpr("id + 1 AS id"), "two"))
    paths = [p.removeprefix("file://") for p, df in common._written(spark) if df is two]
    assert len(paths) == 1
    assert not any(df is one for _, df in common._written(spark))
    assert sorted(r.id for r in two.collect()) == [1, 2, 3, 4, 5]
    common.clear(spark)
    assert not os.path.exists(paths[0])


def test_one_large_object_at_a_time():
    a = common.held("a", lambda: [1])
    assert common.held("a", lambda: [2]) is a
    common.held("b", lambda: [3])
    assert common.held("a", lambda: [4]) == [4]
