"""The k-d tree against one built in memory."""

import collections
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lookout.llm import sharding

from .helpers import prose, rows, table

TOP = 2**31 - 1


def plain_dimensions(text, size):
    return {"bytes": size, "chars": F.length(text), "spaces": F.length(text) - F.length(F.translate(text, " ", ""))}


def codes(values):
    low, span = min(values), float(max(values)) - float(min(values))
    return [min(TOP, int((v - low) / span * TOP)) if span else 0 for v in values]


def brute(data, k):
    """(doc_id, text) -> shard, splitting lists; data has no group of equal texts over a leaf."""
    texts = [r[1] or "" for r in data]
    size = [len(t.encode()) + 16 for t in texts]
    dims = [codes(x) for x in (size, [len(t) for t in texts], [t.count(" ") for t in texts])]
    share = sum(size) / k
    out = {}

    def split(own, m, path):
        if m == 1 or not own:
            out.update(dict.fromkeys(own, path))
            return
        axis = max(range(3), key=lambda d: max(dims[d][i] for i in own) - min(dims[d][i] for i in own))
        groups = collections.defaultdict(list)
        for i in own:
            groups[dims[axis][i], zlib.crc32(texts[i].encode())].append(i)
        total, wanted, left, right, run = sum(size[i] for i in own), sum(size[i] for i in own) * (m // 2) / m, [], [], 0
        reached = False
        for key in sorted(groups):
            group, w = groups[key], sum(size[i] for i in groups[key])
            if not reached and run + w >= wanted:
                reached = True
                assert w <= share
                (left if run + w - wanted < wanted - run else right).extend(group)
            else:
                (right if reached else left).extend(group)
            run += w
        n = min(m - 1, max(1, round(m * sum(size[i] for i in left) / total)))
        split(left, n, path + "0")
        split(right, m - n, path + "1")

    split(list(range(len(data))), k, "")
    order = {p: i for i, p in enumerate(sorted(set(out.values())))}
    return {i: order[p] for i, p in out.items()}


@pytest.mark.parametrize(("seed", "k"), [(1, 2), (2, 7), (3, 12)])
def test_tree(spark, seed, k):
    rng = random.Random(seed)
    data = [(i, prose(rng, rng.randint(1, 80)), "en", "s", 0) for i in range(400)]
    data += [(1000 + i, data[i % 5][1], "en", "s", 0) for i in range(12)] + [(2000, None, None, None, None), (2001, "", "en", None, 0), (None, "a b", None, None, 3)]
    want = brute(data, k)
    got = collections.defaultdict(set)
    for r in sharding.kd_shards(table(spark, data), shards=k, dimensions=plain_dimensions).collect():
        got[r.shard].add((r.doc_id, r.text_crc32))
    sets = collections.defaultdict(set)
    for i, s in want.items():
        sets[s].add((data[i][0], zlib.crc32((data[i][1] or "").encode())))
    assert sorted(map(sorted, (map(str, s) for s in got.values()))) == sorted(map(sorted, (map(str, s) for s in sets.values())))


def test_equal_texts_stay_together(spark):
    """Unless they don't fit a leaf."""
    rng = random.Random(5)
    data, i = [], 0
    for _ in range(120):
        text = prose(rng, rng.randint(20, 60))
        for _ in range(rng.randint(1, 9)):
            data.append((i, text, "en", "s", 0))
            i += 1
    hot = prose(rng, 40)
    data += [(10_000 + j, hot, "en", "s", 0) for j in range(600)]
    shards, sizes = collections.defaultdict(set), collections.Counter()
    for r in sharding.kd_shards(table(spark, data), shards=9).collect():
        shards[r.text_crc32].add(r.shard)
        sizes[r.shard] += r["size"]
    mean = sum(sizes.values()) / 9
    assert len(sizes) == 9
    assert max(sizes.values()) < 1.25 * mean
    assert min(sizes.values()) > 0.75 * mean
    assert [c for c, s in shards.items() if len(s) > 1] == [zlib.crc32(hot.encode())]


def test_by_target_bytes(spark):
    data = rows()
    got = sharding.kd_shards(table(spark, data), shards=None, target_bytes=50_000).collect()
    assert len(got) == len(data)
    assert len({r.shard for r in got}) > 1
    assert {r.shard for r in sharding.kd_shards(table(spark, data), shards=1).collect()} == {0}
