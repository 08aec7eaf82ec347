"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each source's documents stand on one line in a seeded order, and the line is cut into blocks of equal numbers of words
(only a source's last block may be shorter).  A block has BLOCK_WORDS words; in a source whose target is under 128 such blocks, the largest power of
two of which it is 128, whatever other sources need.  The blocks the mix takes are seats, dealt to the sources with blocks of one size by highest
quotients target / (2k + 1), then likewise to the shards of each source's line, which gives every shard an integer quota.
In a shard of n blocks a quota q takes each block q div n times, and q mod n of them, picked by a seeded permutation, once more.

A block that begins within a document does so where a passage ends (a line or a sentence), if one ends at most half a block away, so
what is taken of a document is passages, not words out of their midst.  The driver holds one row for each source and SHARDS rows
for each source's line.  Documents are placed by sums over hash buckets of a line and a running sum in each bucket: op3 runs it
over sizes alone; to write the mix, texts are dealt once by bucket, and the sum runs over them as they are read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookout.llm.common import SPACES, WORD, free_names, materialise, offsets_within, prepare, tidy

BLOCK_WORDS, SHARDS, SEED = 256, 64, 17
#: Rows that a bucket of a line has, about.
ROWS_A_BUCKET = 5000
_SPACE, _STOP = (np.isin(np.arange(256), [ord(c) for c in chars]) for chars in (SPACES, ".!?"))


def passages(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start, and after how many words a passage ends: with a line, with a word that ends in . ! or ?, or with the text."""
    a = np.frombuffer(data, np.uint8)
    space = _SPACE[a]
    starts = np.flatnonzero(~space & np.append(True, space)[:-1])
    if not len(starts):
        return starts, starts
    ends = np.flatnonzero(~space & np.append(space, True)[1:])
    lines = np.flatnonzero(a == 10)
    over = _STOP[a[ends]]
    over[:-1] |= np.searchsorted(lines, ends[:-1]) < np.searchsorted(lines, starts[1:])
    over[-1] = True
    return starts, np.flatnonzero(over) + 1


def at_passages(cuts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """Each of the cuts at the nearest of 0 and the ends that is at most `most` words away, the earlier of two; else where it was."""
    stops = np.append(0, ends)
    after = np.searchsorted(stops, cuts, "left").clip(1, len(stops) - 1)
    lower, upper = stops[after - 1], stops[after]
    nearest = np.where(cuts - lower <= upper - cuts, lower, upper)
    return np.where(np.abs(nearest - cuts) <= most, nearest, cuts)


def sainte_lague(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2k + 1); ties go to the earlier party; a party gets `most` at most.

    All but a few seats for each party are given at once: a party certainly wins the seats whose quotient exceeds that of
    one seat more than all parties together can want.
    """
    most = most or [seats] * len(votes)
    seats = min(seats, sum(m for m, v in zip(most, votes, strict=True) if v > 0))
    total = sum(votes)
    won = [0] * len(votes)
    if total > 0 and seats > 2 * len(votes):
        quotient = total / (2 * max(seats - len(votes), 1))  # at 1/quotient a seat, parties round to fewer than `seats`
        won = [min(m, max(0, math.floor(v / quotient / 2 + 0.5) - 1)) for v, m in zip(votes, most, strict=True)]
        if sum(won) > seats:
            won = [0] * len(votes)
    heap = [(-v / (2 * won[i] + 1), i) for i, v in enumerate(votes) if v > 0 and won[i] < most[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(won)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        won[i] += 1
        if won[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * won[i] + 1), i))
    return won


def targets(sizes: list[int], weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> list[float]:
    """Shares `share` of all sizes by weight (repeating over sources in order); a target stops at cap times its source's
    size, and what is above goes to the others by weight, until none is above."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while open_:
        all_w = sum(w[i] for i in open_)
        above = [i for i in open_ if left * w[i] / all_w > cap * sizes[i]]
        if not above:
            for i in open_:
                out[i] = left * w[i] / all_w
            break
        for i in above:
            out[i] = cap * float(sizes[i])
        left -= sum(out[i] for i in above)
        open_ = [i for i in open_ if out[i] == 0 and i not in set(above)]
    return out


def block_words(target: float, most: int = BLOCK_WORDS) -> int:
    """The words of a block of a source: the largest power of two, `most` at most, of which the target is 128."""
    return 1 << (max(1, min(most, int(target / 128))).bit_length() - 1)


class Plan:
    """For each source (by position in order): its blocks, and how often each of them is taken."""

    def __init__(self, sizes: list[int], wanted: list[float], block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED):
        self.block = [block_words(t, block) for t in wanted]
        self.n = [-(-s // b) for s, b in zip(sizes, self.block, strict=True)]
        seats = [0] * len(sizes)
        for b in set(self.block):
            own = [i for i, x in enumerate(self.block) if x == b]
            for i, q in zip(own, sainte_lague([wanted[i] for i in own], round(sum(wanted[i] for i in own) / b), [2 * self.n[i] for i in own]), strict=True):
                seats[i] = q
        self.starts, self.base, self.extra, self.a, self.c = [], [], [], [], []
        for i, (n, q) in enumerate(zip(self.n, seats, strict=True)):
            edges = np.unique([j * n // shards for j in range(shards + 1)])
            own = np.diff(edges) if n else np.zeros(0, np.int64)
            quota = np.array(sainte_lague([float(x) for x in own], q, [2 * int(x) for x in own]), np.int64)
            key = [hashlib.blake2b(f"{seed}|{i}|{j}".encode(), digest_size=16).digest() for j in range(len(own))]
            step = [next(x for x in range(1 + int.from_bytes(k[:8], "big") % int(m), 2 * int(m) + 2) if math.gcd(x, int(m)) == 1) for k, m in zip(key, own, strict=True)]
            self.starts.append(edges[:-1] if n else edges[:0])
            self.base.append(quota // np.maximum(own, 1))
            self.extra.append(quota % np.maximum(own, 1))
            self.a.append(np.array(step, np.int64))
            self.c.append(np.array([int.from_bytes(k[8:], "big") % int(m) for k, m in zip(key, own, strict=True)], np.int64))

    def times(self, source: int, blocks: np.ndarray) -> np.ndarray:
        """How often the mix takes each of these blocks of the source."""
        starts = self.starts[source]
        at = np.searchsorted(starts, blocks, "right") - 1
        n = np.append(starts[1:], self.n[source])[at] - starts[at]
        # the product of two numbers below n: exact in Python's integers where 63 bits might not do
        i = blocks - starts[at]
        if len(n) and int(n.max()) >= 1 << 31:
            place = np.array([(int(x) * int(a) + int(c)) % int(m) for x, a, c, m in zip(i, self.a[source][at], self.c[source][at], n, strict=True)], np.int64)
        else:
            place = (i * self.a[source][at] + self.c[source][at]) % n
        return self.base[source][at] + (place < self.extra[source][at])

    def parts(self, source: int, start: int, size: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of each block that a document has which begins at `start` on its source's line, and their times.  ends: of its passages."""
        b = self.block[source]
        blocks = np.arange(start // b, (start + size - 1) // b + 1)
        cuts = at_passages(blocks[1:] * b - start, ends, b // 2)
        return np.diff(np.concatenate([[0], cuts, [size]])), self.times(source, blocks)


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def buckets_for(docs: DataFrame) -> int:
    """Into how many hash buckets a source's line is dealt: a power of two that grows with the table."""
    return 1 << max(6, (docs.count() // ROWS_A_BUCKET).bit_length())


def plan_for(sums: DataFrame, **options) -> tuple[list[str | None], list[int], list[float], Plan]:
    """sums(source, n): sources in order (by code point, null last), their sizes and targets, and the plan.  One row a source is collected."""
    rows = sums.groupBy("source").agg(F.sum("n").alias("n")).collect()
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))
    names, sizes = [r[0] for r in rows], [int(r["n"] or 0) for r in rows]
    wanted = targets(sizes)
    return names, sizes, wanted, Plan(sizes, wanted, **options)


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """For each document: doc_id, source, size, source_size, target (its source's) and taken, the words the mix takes.

    A null text has size 0 and nothing is taken from it; a null source is a source, the last; documents with null or
    repeated doc_ids each count; very long texts are many blocks; other columns don't matter.  An empty table gives no rows.
    Reruns agree: order and selection depend on ids, texts and seed.
    """
    prepare(docs.sparkSession)

    def measure(batches):
        for batch in batches:
            size, packed = [], []
            for text in batch.column(2).to_pylist():
                starts, ends = passages(text.encode())
                size.append(len(starts))
                packed.append(zlib.compress(np.diff(ends, prepend=0).astype("<u4").tobytes(), 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), batch.column(3), pa.array(packed, pa.binary())], ["doc_id", "source", "size", "tie", "ends"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("tie"))
    sized = materialise(rows.mapInArrow(tidy(measure), "doc_id long, source string, size long, tie long, ends binary"), "sizes")
    names, sizes, wanted, plan = plan_for(sized.select("source", F.col("size").alias("n")), **options)
    number = {x: i for i, x in enumerate(names)}

    def take(batches):
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            who = [number[x] for x in cols["source"].to_pylist()]
            taken = []
            for s, n, at, packed in zip(who, *(cols[c].to_pylist() for c in ("size", "start", "ends")), strict=True):
                taken.append(int(np.dot(*plan.parts(s, at, n, np.cumsum(np.frombuffer(zlib.decompress(packed), "<u4").astype(np.int64))))) if n else 0)
            yield pa.RecordBatch.from_arrays([cols["doc_id"], cols["source"], cols["size"], pa.array([sizes[s] for s in who], pa.int64()), pa.array([wanted[s] for s in who], pa.float64()), pa.array(taken, pa.int64())], ["doc_id", "source", "size", "source_size", "target", "taken"])

    placed = offsets_within(sized, ["source"], ["doc_id", "tie"], "size", "start", buckets=buckets_for(sized))
    return placed.mapInArrow(tidy(take), "doc_id long, source string, size long, source_size long, target double, taken long")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of docs: each document as often as its blocks are taken.

    A copy of which all blocks are taken is the document's whole text.  Of others it has the taken blocks' words, in order and
    with the white space between them; n_chars, where there is one, follows the text.  What is taken is what mix_sources() says.
    A null text, an empty one and one without words leave no row.  A null source is a source; null and repeated doc_ids count each, and rows that agree in doc_id
    and text may stand in each other's place; a very long text is cut like any other; columns of any name are kept; an empty table gives no rows.

    Texts are shuffled once: dealt by source and bucket, in order, each bucket behind a row with the sum that it begins at.
    """
    spark = docs.sparkSession
    prepare(spark)
    columns = docs.columns
    bucket, tie, at = free_names(columns, "mix_bucket", "mix_tie", "mix_at")
    dealt = docs.withColumn(tie, F.xxhash64(text_or_empty()))
    dealt = dealt.withColumn(bucket, F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col(tie)), F.lit(buckets_for(docs))).cast("int"))
    sums = materialise(dealt.groupBy(F.col("source").cast("string").alias("source"), F.col(bucket).alias("bucket")).agg(F.sum(F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")).alias("n")), "mix-buckets")
    names, _, _, plan = plan_for(sums, **options)
    number = {x: i for i, x in enumerate(names)}
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("at"))
    kinds = {f.name: f.dataType for f in docs.schema}
    heads = heads.select(*[(F.col("source") if c.lower() == "source" else F.lit(None)).cast(kinds[c]).alias(c) for c in columns], F.lit(None).cast("long").alias(tie), F.col("bucket").alias(bucket), F.col("at").alias(at))
    place = {c.lower(): i for i, c in enumerate(columns)}
    counted = place.get("n_chars")

    def emit(batches):
        start = 0
        for batch in batches:
            rows, new = [], []
            for i, (source, text, head) in enumerate(zip(*(batch.column(c).to_pylist() for c in (place["source"], place["text"], len(columns))), strict=True)):
                if head is not None:
                    start = head
                    continue
                data = (text or "").encode()
                words, ends = passages(data)
                if not len(words):
                    continue
                lengths, times = plan.parts(number[source if source is None else str(source)], start, len(words), ends)
                start += len(words)
                lengths, times = lengths[lengths > 0], times[lengths > 0]
                edges = np.append(words, len(data))[np.append(0, np.cumsum(lengths))]
                for copy in range(1, int(times.max()) + 1):
                    keep = times >= copy
                    rows.append(i)
                    if keep.all():
                        new.append(text)
                    else:
                        part = b"".join(data[edges[k] : edges[k + 1]] for k in np.flatnonzero(keep))
                        new.append((part if keep[-1] else part.rstrip()).decode())
            if not rows:
                continue
            picked = batch.take(pa.array(rows, pa.int64()))
            fixed = {place["text"]: pa.array(new, pa.string())}
            if counted is not None:
                fixed[counted] = pa.array(map(len, new), pa.int64()).cast(batch.column(counted).type)
            yield pa.RecordBatch.from_arrays([fixed.get(j, picked.column(j)) for j in range(len(columns))], columns)

    rows = dealt.withColumn(at, F.lit(None).cast("long")).select(*columns, tie, bucket, at).union(heads)
    ordered = rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "source", bucket).sortWithinPartitions("source", bucket, F.col(at).isNull(), F.col("doc_id").cast("long"), tie)
    return ordered.select(*columns, at).mapInArrow(tidy(emit), docs.schema)
