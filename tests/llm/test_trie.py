"""The trie against one made of all prefixes in memory, over few and many tasks."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lookout.llm.trie import TURN, common, conversation_trie, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + x[h:])
    members = defaultdict(list)
    for c, x in sorted(built.items()):
        for d in range(len(x) + 1):
            members[x[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    ends = {node: hashlib.sha256(",".join(str(c) for c in cs if built[c] == node).encode()).hexdigest() for node, cs in members.items()}
    return sorted(((cs[0], len(n), members[n[:-1]][0] if n else None, len(cs), len(children[n]), leaves[n], saved[n], ends[n]) for n, cs in members.items()), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def chats(n, seed, most=7, words=3):
    """Conversations of few texts, so that many share beginnings; a third are copies of one."""
    rng = random.Random(seed)
    texts = [f"t{i}" * rng.randint(0, 4) for i in range(words)] + [None]
    rows = []
    for c in rng.sample(range(5 * n), n):
        x = [(rng.choice(["user", None]), rng.choice(texts)) for _ in range(rng.randint(0, most))] if c % 3 else [("user", "hot"), ("assistant", "hot é")]
        rows += [(c, t, r, s) for t, (r, s) in enumerate(x)]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def many_tasks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_prefixes(spark, seed):
    rows = chats(150, seed)
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


@pytest.mark.parametrize("seed,n,most,held,chunk", [(3, 200, 7, 50_000, 1 << 16), (4, 300, 3, 3, 10), (5, 60, 40, 1, 1), (6, 9, 2, 2, 5)])
def test_over_many_tasks(spark, many_tasks, seed, n, most, held, chunk):
    """Equal conversations and shared beginnings across borders of tasks, tasks without rows, ids in pieces and parents that close late."""
    rows = chats(n, seed, most, words=2)
    assert got(prefix_trie(rebuilt(spark.createDataFrame(rows, SCHEMA).repartition(3)), held, chunk)) == plain(rows)


def test_odd_rows(spark, many_tasks):
    rows = [(0, None, "user", "first"), (0, None, "assistant", None), (0, 3, None, "x"), (0, 3, None, "x"), (None, 1, "user", "lost"), (1, 1, "user", "a"), (1, 1, "user", "a"), (7, 2, "assistant", "b"), (7, 2, "assistant", "a" * 50 + "z"), (7, 2, "assistant", "a" * 50), (101, 1, "user", ""), (-5, 1, "user", "below"), (-100, 1, "user", "first"), (12, 1, "user", "w" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("base", "turns", "head", "h", "key", "part", "kind", "t")})
    want = plain([r for r in rows if r[:2] != (7, 2)])
    assert got(conversation_trie(df.where("conv_id IS NULL OR conv_id <> 7"))) == want
    assert len(got(conversation_trie(df))) > len(want)  # texts alike in 32 characters stand in order of their hashes
    assert got(conversation_trie(df.limit(0))) == []
    assert got(conversation_trie(df.where("conv_id IS NULL"))) == []


def test_turnless_conversations_end_in_the_root(spark):
    """A conversation whose first turns are replaced by those of one that isn't there."""
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    root = (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == [root] == plain(rows)


def test_a_long_conversation_and_its_copy(spark, many_tasks):
    rows = [(c, t, "user", f"{t}") for c in (0, 100, 200) for t in range(1500)] + [(200, 1500, "user", "more")]
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_common():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice([b"a", b"b"]) * TURN for _ in range(rng.randint(0, 9))]
        b = a[: rng.randint(0, 9)] + [rng.choice([b"a", b"b"]) * TURN for _ in range(rng.randint(0, 3))]
        want = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common(b"".join(a), b"".join(b)) == want
