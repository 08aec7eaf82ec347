"""K-d tree partitioning of documents into shards of nearly equal bytes.

A node with k leaves is split at the key where floor(k / 2) of its k leaves' bytes are reached, along the metadata
dimension in which its documents are spread widest (of the whole table's spread).  The weighted quantile is exact and distributed:
a radix select over 63-bit keys, 16 bits a round, all nodes of a level at once; each round is one aggregate with map-side sums.
Keys are (dimension, hash of the text), and by default the dimensions depend on the text alone, so equal texts stay together: they go to the side that comes nearer,
and the leaves are then shared out by the bytes of the sides.  Only a group of equal texts that doesn't fit a leaf is cut, by a hash of doc_id.
The driver holds the tree alone: a row for each node, which plans join as a table, broadcast only where Spark finds it small.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lookout.llm.common import materialise, offsets_within, prepare, temporary

DIGIT = 16
TOP = (1 << 63) - 1


def text_dimensions(text: Column, size: Column) -> dict[str, Column]:
    """Metadata that equal texts share: length, words' lengths, and the share of bytes beyond ASCII."""
    chars = F.length(text)
    spaces = chars - F.length(F.translate(text, " \n", ""))
    return {"length": F.log2(size.cast("double")), "spacing": spaces / (chars + 1), "beyond_ascii": (F.octet_length(text) - chars) / (chars + 1)}


def _small(spark: SparkSession, **columns: tuple[list, pa.DataType]) -> DataFrame:
    """A table of what the driver knows of each node, with its size known to the planner."""
    return spark.createDataFrame(pa.table({name: pa.array(values, kind) for name, (values, kind) in columns.items()}))


def _select(rows: DataFrame, wanted: dict[int, float]) -> dict[int, tuple[int, int, int]]:
    """rows(node, key, w): for each node the key at which the running sum of w reaches wanted[node].

    Returns (key, sum below the key, sum at the key).
    """
    state = {n: (0, float(w), 0) for n, w in wanted.items()}  # key's bits so far, what is still wanted, sum below
    at = dict.fromkeys(wanted, 0)
    for shift in range(64 - DIGIT, -1, -DIGIT):
        if not state:
            break
        nodes = sorted(state)
        known = _small(rows.sparkSession, node=(nodes, pa.int64()), prefix=([state[n][0] for n in nodes], pa.int64()), left=([state[n][1] for n in nodes], pa.float64()))
        above = F.shiftright("key", shift + DIGIT) if shift + DIGIT < 64 else F.lit(0).cast("long")
        sums = rows.join(known, "node").where(above == F.col("prefix")).groupBy("node", "left", F.shiftright("key", shift).bitwiseAND((1 << DIGIT) - 1).alias("digit")).agg(F.sum("w").alias("w"))
        run = Window.partitionBy("node").orderBy("digit")
        reached = sums.withColumn("run", F.sum("w").over(run.rowsBetween(Window.unboundedPreceding, 0))).withColumn("last", F.lead("digit").over(run).isNull())
        hit = reached.where((F.col("run") >= F.col("left")) | F.col("last")).groupBy("node").agg(F.min(F.struct("digit", "run", "w")).alias("x")).select("node", "x.*").collect()
        new = {}
        for r in hit:
            bits, want, below = state[r["node"]]
            before = r["run"] - r["w"]
            new[r["node"]] = ((bits << DIGIT) | r["digit"], want - before, below + before)
            at[r["node"]] = r["w"]
        state = new
    return {n: (s[0], s[2], at[n]) for n, s in state.items()}


def kd_shards(docs: DataFrame, shards: int | None = 40, target_bytes: int | None = None, dimensions=text_dimensions) -> DataFrame:
    """Puts all documents into shards: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes (null: none) plus 16.  Without `shards`, as many as target_bytes asks for.  The law is `bytes`; grown_shard is null.
    slot counts a shard's rows from 0 without gaps.  Null or repeated doc_ids are placed like others, null and empty texts by their 16 bytes; a text longer than a
    leaf has one to itself as far as others allow; equal texts are in one shard unless all of them are more than a leaf.  Other columns, whatever
    their names, don't matter; no rows give no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    with temporary(spark) as keep:
        placed = keep(_placed(docs, shards, target_bytes, dimensions))
    numbered = offsets_within(placed, ["shard"], ["doc_id", "text_crc32", "size"], None, "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _placed(docs: DataFrame, shards: int | None, target_bytes: int | None, dimensions) -> DataFrame:
    """doc_id, size, text_crc32 and shard, as a table."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    size = (F.octet_length("t") + 16).cast("long")
    dims = dimensions(F.col("t"), size)
    base = base.select("doc_id", size.alias("size"), F.crc32(F.col("t").cast("binary")).alias("text_crc32"), *[c.cast("double").alias(f"d{i}") for i, c in enumerate(dims.values())])
    base = materialise(base, "shard-keys")
    d = [f"d{i}" for i in range(len(dims))]
    whole = base.agg(F.sum("size").alias("bytes"), *[f(x).alias(f"{n}_{x}") for x in d for n, f in (("min", F.min), ("max", F.max))]).first()
    total = int(whole["bytes"] or 0)
    k = shards or max(1, -(-total // (target_bytes or 1 << 30)))
    low = {x: float(whole[f"min_{x}"] or 0) for x in d}
    span = {x: float(whole[f"max_{x}"] or 0) - low[x] for x in d}
    code = [F.least(F.lit((1 << 31) - 1), F.floor((F.col(x) - low[x]) / span[x] * ((1 << 31) - 1))).cast("long") if span[x] > 0 else F.lit(0).cast("long") for x in d]
    rows = base.select("doc_id", "size", "text_crc32", F.array(*code).alias("codes"), F.xxhash64("doc_id", "text_crc32").bitwiseAND(TOP >> 1).alias("second"), F.lit(0).cast("long").alias("node"))
    leaves, share = {0: k}, max(total / k, 1)
    while max(leaves.values()) > 1:
        spread = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *[(F.max(F.col("codes")[i]) - F.min(F.col("codes")[i])).alias(f"s{i}") for i in range(len(d))]).collect()
        found = {r["node"]: r for r in spread if leaves.get(r["node"], 1) > 1}
        nodes = sorted(found)
        axis = _small(spark, node=(nodes, pa.int64()), axis=([max(range(len(d)), key=lambda i, n=n: found[n][f"s{i}"]) + 1 for n in nodes], pa.int32()))
        keyed = rows.join(axis, "node").withColumn("key", F.shiftleft(F.element_at("codes", F.col("axis")), 32).bitwiseOR(F.col("text_crc32")))
        wanted = {n: r["bytes"] * (leaves[n] // 2) / leaves[n] for n, r in found.items()}
        cut = _select(keyed.select("node", "key", F.col("size").alias("w")), wanted)
        first, second, left, hot = {}, {}, {}, {}
        for n, (key, below, at) in cut.items():
            first[n] = key
            if at > share:
                hot[n] = wanted[n] - below
            else:
                second[n] = TOP if below + at - wanted[n] < wanted[n] - below else 0
                left[n] = below + (at if second[n] else 0)
        if hot:
            own = _small(spark, node=([*hot], pa.int64()), first=([first[n] for n in hot], pa.int64()))
            group = keyed.join(own, "node").where(F.col("key") == F.col("first")).select("node", F.col("second").alias("key"), F.col("size").alias("w"))
            for n, (key, below, at) in _select(group, hot).items():
                over = below + at - hot[n] < hot[n] - below
                second[n] = key + int(over)
                left[n] = wanted[n] - hot[n] + below + (at if over else 0)
        plan = _small(spark, node=([*first], pa.int64()), first=([*first.values()], pa.int64()), then=([second[n] for n in first], pa.int64()))
        goes_left = (F.col("key") < F.col("first")) | ((F.col("key") == F.col("first")) & (F.col("second") < F.col("then")))
        split = keyed.join(plan, "node").withColumn("node", 2 * F.col("node") + F.when(goes_left, 0).otherwise(1))
        columns = ["doc_id", "size", "text_crc32", "codes", "second", "node"]
        whole_ones = rows.join(axis, "node", "left_anti").withColumn("node", 2 * F.col("node"))
        rows = materialise(split.select(columns).unionByName(whole_ones.select(columns)), "shard-nodes")  # else the joins of all levels pile up in one plan
        new = {}
        for n, m in leaves.items():
            if m < 2 or n not in found:
                new[2 * n] = m if m < 2 else 1
                continue
            k_left = min(m - 1, max(1, round(m * left[n] / found[n]["bytes"]))) if n not in hot else m // 2
            new |= {2 * n: k_left, 2 * n + 1: m - k_left}
        leaves = new
    order = sorted(leaves)
    numbers = _small(spark, node=(order, pa.int64()), shard=([*range(len(order))], pa.int32()))
    return materialise(rows.join(numbers, "node").select("doc_id", "size", "text_crc32", "shard"), "shards")
