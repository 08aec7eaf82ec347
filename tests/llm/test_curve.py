"""Packing along the curve: the curve itself, a plain packing in memory, round trips and odd rows."""

import itertools
import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lookout.llm.common import mix
from lookout.llm.curve import BITS, BUCKETS, curve_digest, hilbert, pack_along_curve, projections, tail

from .helpers import rows, table

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encode():
    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("dimensions,bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_hilbert_visits_all_by_single_steps(dimensions, bits):
    points = np.array([*itertools.product(range(1 << bits), repeat=dimensions)])
    at = hilbert(points, bits)
    assert sorted(at) == [*range(len(points))]
    assert (np.abs(np.diff(points[np.argsort(at)], axis=0)).sum(1) == 1).all()


def test_tail():
    assert tail(0) == [0] and tail(4096) == [4096] and tail(2048 + 7) == [2048, 2052, 2054, 2055]


def plain(data, encode, capacity):
    """Whole texts sorted by key in memory, joined and cut."""
    docs = [(r[0], encode(r[1])) for r in data]
    p = projections(np.array([np.bincount((mix(np.array(ids[:-1], np.uint64)) % np.uint64(BUCKETS)).astype(int), minlength=BUCKETS) for _, ids in docs])).astype(float)
    z = (p - p.mean(0)) / np.maximum(1, p.std(0))
    keys = hilbert(np.minimum((1 << BITS) / (1 + np.exp(-1.702 * z)), (1 << BITS) - 1).astype(int))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    order = sorted(range(len(docs)), key=lambda i: (keys[i], docs[i][0] is not None, docs[i][0] or 0, len(docs[i][1]), crc(docs[i][1])))
    ends = tail(sum(len(ids) for _, ids in docs), capacity)
    cuts = [*range(0, ends[0], capacity), *ends]
    out, at = [], 0
    for i in order:
        doc_id, ids = docs[i]
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            lo, hi = max(a, at), min(b, at + len(ids))
            if lo < hi:
                out.append((doc_id, lo - at, hi - lo, len(ids), k, lo - a, crc(ids[lo - at : hi - at])))
        at += len(ids)
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, df.withColumn("ids_crc32", F.crc32("ids")).drop("ids").collect()), key=str)


@pytest.mark.parametrize("partitions", [1, 6])
def test_against_packing_in_memory(spark, encode, partitions):
    """Rows alike in key, id, tokens and crc are interchangeable, so results don't depend on partitions."""
    assert digest(pack_along_curve(table(spark).repartition(partitions), 256)) == plain(rows(), encode, 256)


def test_round_trip_without_padding(spark, encode):
    found = pack_along_curve(table(spark)).collect()
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at & (at - 1) == 0 and at <= 2048
    assert sum(n == 2048 for n in (sum(x[1] for x in s) for s in sequences.values())) >= len(sequences) - 11
    whole = defaultdict(list)
    for r in rows():
        whole[r[0], len(encode(r[1]))].append(np.array(encode(r[1]), "<u4").tobytes())
    assert docs.keys() == whole.keys()
    for k, texts in whole.items():
        if len(texts) == 1:
            assert b"".join(b for _, b in sorted(docs[k])) == texts[0]
        assert sum(len(b) for _, b in docs[k]) == sum(map(len, texts))


def test_texts_alike_are_neighbours(spark):
    """Along the line, neighbours share far more words than texts at a distance do; equal texts lie side by side."""
    topics = {t: [f"{t}{i}" for i in range(30)] for t in ("river", "stone", "winter", "market", "engine")}
    rng = np.random.default_rng(4)
    data = [(i, " ".join(rng.choice(topics[t], 60)), None, None, None) for i, t in enumerate(rng.choice([*topics], 200))] + [(1000 + i, "the same text again", None, None, None) for i in range(20)]
    from .helpers import SCHEMA

    first = pack_along_curve(spark.createDataFrame(data, SCHEMA)).where("start = 0").orderBy("sequence_id", "offset").collect()
    order = [r["doc_id"] for r in first]
    topic = {i: t.split()[0].rstrip("0123456789") for i, t, *_ in data}
    alike = np.mean([topic[a] == topic[b] for a, b in itertools.pairwise(order)])
    assert alike > 0.75
    at = [k for k, i in enumerate(order) if i >= 1000]
    assert at == [*range(at[0], at[0] + 20)]


def test_empty_and_null(spark, encode):
    df = table(spark)
    assert pack_along_curve(df.limit(0)).collect() == []
    only = curve_digest(df.where("text IS NULL OR text = ''"))
    assert sorted(only.columns) == sorted(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    assert {(r["doc_tokens"], r["length"], r["ids_crc32"]) for r in only.collect()} == {(1, 1, zlib.crc32(b"\1\0\0\0"))}


def test_words_are_kept_up_to_a_bound(encode, monkeypatch):
    """Whatever is remembered or forgotten, a text's ids are the tokenizer's; odd white space and special tokens too."""
    import random

    import public_tokenizers

    from lookout.llm import packing

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(packing, "WORDS_KEPT", 300)
    words, rng = packing.WordIds(path, path.removesuffix(".json") + ".tiktoken"), random.Random(6)
    some = ["", " ", "  ", "\n", "\t", "é", "漢", "'s", "<|endoftext|>", "z" * 40, *(f"w{i}" for i in range(400))]
    for size in (1, 3, 40, 40, 5, 40):
        texts = [rng.choice(["", " ", "a"]) + " ".join(rng.choices(some if i % 2 else some[5:], k=rng.randint(0, 20))) for i in range(size)]
        assert [list(np.frombuffer(x, "<u4")) for x in words.of(texts)] == [encode(t)[:-1] for t in texts]
        assert 0 < len(words.words) <= 300 and "z" * 40 not in words.words.to_pylist()
