"""The mix against a walk from word to word, and what it leaves of texts."""

import collections
import random

import numpy as np
from pyspark.sql import functions as F

from lookout.llm import mixing
from lookout.llm.common import SPACES

from .helpers import SCHEMA, WORD, prose, rows, table


def passage_ends(text):
    found, ends = list(WORD.finditer(text)), []
    for k, m in enumerate(found):
        gap = text[m.end() : found[k + 1].start()] if k + 1 < len(found) else "\n"
        if m[0][-1] in ".!?" or "\n" in gap:
            ends.append(k + 1)
    return [m.start() for m in found], ends


def test_passages():
    rng = random.Random(1)
    for text in ["", " ", "a", "a. b\nc  d\x0b\n e! f", *("".join(rng.choice("ab.!?\n \t") for _ in range(rng.randint(1, 60))) for _ in range(300))]:
        starts, ends = mixing.passages(text.encode())
        assert (starts.tolist(), ends.tolist()) == passage_ends(text)


def highest_quotients(votes, seats, most):
    won = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if votes[i] > 0 and won[i] < most[i]]
        if not open_:
            break
        won[max(open_, key=lambda i: (votes[i] / (2 * won[i] + 1), -i))] += 1
    return won


def brute_taken(data, buckets):
    """(doc_id, text) -> words taken.  data: (doc_id, text, source, bucket, tie)."""
    sizes = collections.Counter()
    for _, text, source, _, _ in data:
        sizes[source] += len(WORD.findall(text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = mixing.targets([sizes[s] for s in names])
    block = []
    for t in wanted:
        b = 256
        while b > 1 and t < 128 * b:
            b //= 2
        block.append(b)
    n = [-(-sizes[s] // b) for s, b in zip(names, block)]
    seats = {}
    for b in set(block):
        own = [i for i in range(len(names)) if block[i] == b]
        seats |= dict(zip(own, highest_quotients([wanted[i] for i in own], round(sum(wanted[i] for i in own) / b), [2 * n[i] for i in own])))
    plan = mixing.Plan([sizes[s] for s in names], wanted)  # for its permutations alone
    taken = collections.Counter()
    for i, s in enumerate(names):
        if not n[i]:
            continue
        shards = sorted({j * n[i] // 64 for j in range(65)})
        own = [b - a for a, b in zip(shards, shards[1:])]
        quota = highest_quotients(own, seats[i], [2 * x for x in own])
        times = []
        for j, (m, q) in enumerate(zip(own, quota)):
            for k in range(m):
                place = (k * int(plan.a[i][j]) + int(plan.c[i][j])) % m
                times.append(q // m + (place < q % m))
        at = 0
        for doc_id, text, _, _, _ in sorted((r for r in data if r[2] == s), key=lambda r: (r[3], r[0] is not None, r[0] or 0, r[4])):
            ends = [0, *passage_ends(text or "")[1]]
            size = ends[-1]
            edges = [0]
            for cut in range(1, size):
                if (at + cut) % block[i] == 0:
                    nearest = min(ends, key=lambda e: (abs(e - cut), e))
                    edges.append(nearest if abs(nearest - cut) <= block[i] // 2 else cut)
            for k, (a, b) in enumerate(zip(edges, [*edges[1:], size])):
                taken[doc_id, text] += times[(at + edges_at(at, block[i], k)) // block[i]] * (b - a) if size else 0
            at += size
    return taken


def edges_at(at, block, k):
    """A word of the k-th block that a document which starts at `at` has a part of."""
    return 0 if k == 0 else (at // block + k) * block - at


def sentences(rng, n):
    return " ".join(prose(rng, rng.randint(3, 15)) + rng.choice([".", "!", "\n", ""]) for _ in range(n))


def test_taken_by_brute_force(spark):
    rng = random.Random(3)
    data = rows() + [(300 + i, sentences(rng, rng.randint(1, 300)), "en", rng.choice(["hot", "s2", "s3", None]), 1) for i in range(60)]
    docs = table(spark, data)
    text = mixing.text_or_empty()
    buckets = mixing.buckets_for(docs)
    placed = docs.select("doc_id", "text", "source", F.xxhash64(text).alias("tie")).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(buckets)))
    want = brute_taken([(r.doc_id, r.text, r.source, r.bucket, r.tie) for r in placed.collect()], buckets)
    of = {}
    for r in data:
        of.setdefault(r[0], set()).add(r[1])
    got = collections.Counter()
    for r in mixing.mix_sources(docs).collect():
        (one,) = of[r.doc_id]
        got[r.doc_id, one] += r.taken
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_small_source_leaves_others_their_blocks(spark):
    """Beside a source of 60 words, other sources' texts are taken in runs of the full block, which begin and end with passages."""
    rng = random.Random(4)
    data = [(i, "\n".join(" ".join(f"w{i}x{rng.randint(0, 10**9)}" for _ in range(10)) for _ in range(300)), "en", "a" if i % 2 else "c", 0) for i in range(60)] + [(1000, prose(rng, 60), "en", "b", 0)]
    of = {r[0]: r[1].split("\n") for r in data}
    plan = mixing.plan_for(spark.createDataFrame([("a", 90_000), ("b", 60), ("c", 90_000)], "source string, n long"))[3]
    assert plan.block == [256, 1, 256]  # c's target stops at twice its size, b's at 120 words
    out = mixing.mixed_documents(table(spark, data)).collect()
    assert any(r.doc_id == 1000 for r in out)
    for r in out:
        if r.doc_id != 1000:
            lines = r.text.split("\n")
            assert set(lines) <= set(of[r.doc_id])  # whole lines
            places = [of[r.doc_id].index(x) for x in lines]
            runs = np.split(places, np.flatnonzero(np.diff(places) != 1) + 1)
            assert all(len(run) * 10 >= 256 - 10 for run in runs[1:-1])
    words = collections.Counter()
    for r in out:
        words[r.doc_id % 2 if r.doc_id < 1000 else "b"] += len(WORD.findall(r.text))
    wanted = mixing.targets([90_000, 60, 90_000])
    for key, t in ((1, wanted[0]), ("b", wanted[1]), (0, wanted[2])):
        assert abs(words[key] - t) <= 0.02 * t + 5


def test_mix_with_clashing_names(spark):
    data = rows()
    plain = mixing.mixed_documents(spark.createDataFrame(data, SCHEMA))
    odd = table(spark, data).withColumns({c: F.lit("x") for c in ("mix_bucket", "MIX_TIE", "mix_at", "mix_at_", "_bucket", "bucket", "n", "at", "_mix_size", "tie")})
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    assert sorted(map(repr, out.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    assert out.where("mix_at <> 'x' or MIX_TIE is null").count() == 0
    assert mixing.mixed_documents(odd.limit(0)).count() == 0


def test_mixed_texts_keep_their_white_space(spark):
    rng = random.Random(5)
    data = [(i, "  " + sentences(rng, 200).replace(" ", rng.choice([" ", "\t ", " \x0c"])) + " \n", "en", f"s{i % 3}", 0) for i in range(12)]
    of = {r[0]: r[1] for r in data}
    for r in mixing.mixed_documents(spark.createDataFrame(data, SCHEMA)).collect():
        whole = of[r.doc_id]
        assert r.text == whole or r.text.strip(SPACES)[:40] in whole
        assert r.n_chars == len(r.text)
