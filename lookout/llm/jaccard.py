"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

A document's set is its distinct shingles of `words` words.  Two documents link when the intersection is at least
`percent` / 100 of the union.  All links are accounted for:

1. Equal sets are one node from here on, whatever their number.
2. Shingles are put in one global order: how frequent they are (logarithmic levels, from a sketch of 2**SKETCH_BITS counters over all
   documents, beyond what chance fills a counter with), then by hash.  Any order gives the same links; rare first makes candidates few.
   A set of n has to overlap a partner by o, so both prefixes of n - o + 1 shingles share one, and prefixes of
   n - o + l share l.  Each node's prefix is lengthened (l grows) with the candidates its prefix is estimated to bring; two nodes are
   verified only if they share min(l, l') of their longer prefixes, besides passing the size and position bounds.
3. Nodes that share a prefix shingle meet in that shingle's group.  First every one is compared with one of the group alone, which
   costs a row for each; verified links are closed to components.  Then pairs from different components of a group are compared, as
   others can't change the result; groups over SPLIT nodes are compared block by block, spread over tasks.  One pair in WAVE is verified first,
   and of the rest those that still lie in different components.
4. Verification is exact, on whole texts: the two shingle sets are intersected.  Of a pair the one with more partners is the head; a head's partners
   are dealt into chunks of about CHUNK, and its text is sent once to each, so a head with any number of partners is spread over tasks.

Shingles are 64-bit hashes of their words' hashes; sets are told apart by 128 bits.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from lookout.llm.common import PLAIN_CODES, WORD, WordHasher, free_names, materialise, mix, prepare, shared_sketch, temporary, texts, tidy

SKETCH_BITS, SPLIT, CHUNK, WAVE = 22, 8000, 256, 8
#: Extra prefix shingles of every node, and for each doubling of its estimated candidates beyond CHEAP of them.
EXTRA, STEP, CHEAP = 16, 4, 8


@functools.cache
def hasher() -> WordHasher:
    return WordHasher(PLAIN_CODES, seed=3)


def shingles(text: str, words: int = 3) -> np.ndarray:
    """The sorted distinct shingles; with fewer words the whole sequence is one; none without words."""
    w = hasher()(text.encode())
    if not len(w):
        return w
    k = min(words, len(w))
    n = len(w) - k + 1
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + n])
    return np.unique(h)


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def overlap(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """The least intersection of two linked sets of n and m."""
    return -(-percent * (n + m) // (100 + percent))


class Order:
    """The global order of shingles, and prefixes by it."""

    def __init__(self, sketch: np.ndarray, percent: int):
        self.sketch, self.percent = sketch, percent
        self.chance = max(1.0, float(sketch.sum(dtype=np.float64)) / len(sketch))
        self.shift = np.uint64(64 - (len(sketch).bit_length() - 1))

    def prefix(self, s: np.ndarray) -> tuple[np.ndarray, int, bool]:
        """The longer prefix in order, the length of the plain one, and whether many candidates are estimated."""
        n = len(s)
        count = self.sketch[(s >> self.shift).astype(np.int64)].astype(float)
        level = np.where(count <= max(2 * self.chance, 4), 0, 1 + np.log2(np.maximum(count, 1) / (2 * self.chance)).clip(0).astype(np.int64))
        plain = n - -(-self.percent * n // 100) + 1
        order = np.lexsort((s, level))
        cost = float(np.maximum(count[order[:plain]] - 2 * self.chance, 0).sum())
        extra = EXTRA + (STEP * int(np.ceil(np.log2(cost / CHEAP))) if cost > CHEAP else 0)
        return s[order[: plain + min(n - plain, extra)]], plain, cost > CHEAP


def _nodes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A row for each document: doc_id, n, key (null: an empty set), prefix, mark (16 bits of each of the longer prefix), costly."""

    def keys(batch) -> np.ndarray:
        found = [shingles(t, words) for t in texts(batch)]
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    shared = docs.sparkSession.sparkContext.broadcast(shared_sketch(docs.select("text"), keys, SKETCH_BITS))  # 4 * 2**SKETCH_BITS bytes

    def run(batches):
        order = Order(shared.value, percent)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                s = shingles(text, words)
                if not len(s):
                    out.append((doc_id, 0, None, [], None, False))
                    continue
                longer, plain, costly = order.prefix(s)
                out.append((doc_id, len(s), set_key(s), longer[:plain].view(np.int64), (longer & np.uint64(0xFFFF)).astype("<u2").tobytes(), costly))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.bool_()), strict=True)], ["doc_id", "n", "key", "prefix", "mark", "costly"])

    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, n long, key binary, prefix array<long>, mark binary, costly boolean"), "shingle-sets")


def _met(postings: DataFrame, percent: int, partitions: int) -> DataFrame:
    """postings(shingle, key, n, pos): those in groups of two or more, with the group's first as `pivot`, and whether the two may link."""

    def run(batches):
        head, head_out = None, False  # the group that goes on from the batch before: its first row, and whether that is out
        names = ["shingle", "key", "n", "pos"]
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            carried = 0 if head is None else 1
            if carried:
                table = pa.concat_tables([head, table]).combine_chunks()
            code = table.column("shingle").to_numpy()
            first = np.append(True, code[1:] != code[:-1])
            at = np.maximum.accumulate(np.where(first, np.arange(len(code)), 0))
            member = ~first
            begins = np.append(member[1:], False) & first  # firsts that another row follows
            if carried and head_out:
                begins[0] = False
            rows = np.flatnonzero(member | begins)
            n, pos = table.column("n").to_numpy(), table.column("pos").to_numpy()
            p = at[rows]
            o = overlap(n[rows], n[p], percent)
            near = (rows != p) & (o <= np.minimum(n[rows], n[p])) & (np.minimum(n[rows] - pos[rows], n[p] - pos[p]) >= o)
            last = int(at[-1])
            head_out = last != len(code) - 1 or (last == 0 and carried and head_out)
            head = table.slice(last, 1)
            if len(rows):
                own, pivot = table.take(rows), table.column("key").take(pa.array(p))
                yield from pa.table([*(own.column(c) for c in names), pivot, pa.array(near)], [*names, "pivot", "near"]).to_batches()

    ordered = postings.withColumn("_turn", F.xxhash64("shingle", "key")).repartition(partitions, "shingle").sortWithinPartitions("shingle", "_turn", "key").drop("_turn")
    return ordered.mapInArrow(run, "shingle long, key binary, n long, pos int, pivot binary, near boolean")


def unmark(mark: bytes | None) -> list[int] | None:
    return None if mark is None else np.frombuffer(mark, "<u2").tolist()


def shares_enough(a: list[int] | None, n: int, b: list[int] | None, m: int, percent: int) -> bool:
    """Whether the longer prefixes share l shingles, with the greatest l that both allow (16 bits of each are compared, so never too few)."""
    if a is None or b is None:
        return True
    o = -(-percent * (n + m) // (100 + percent))
    if o > min(n, m):
        return False
    more = min(len(a) - (n - o), len(b) - (m - o))
    if more <= 1:
        return True
    other = set(b[: m - o + more])
    return sum(map(other.__contains__, a[: n - o + more])) >= more


def _filtered(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys whose longer prefixes share enough."""
    one, other = (marks.select(F.col("key").alias(x), F.col("n").alias(f"n{x}"), F.col("mark").alias(f"m{x}")) for x in "ab")

    def run(batches):
        for batch in batches:
            na, ma, nb, mb = (c.to_pylist() for c in batch.columns[2:])
            keep = pa.array([shares_enough(unmark(x), n, unmark(y), m, percent) for n, x, m, y in zip(na, ma, nb, mb, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], ["a", "b"])

    return pairs.join(one, "a").join(other, "b").select("a", "b", "na", "ma", "nb", "mb").mapInArrow(run, "a binary, b binary")


def _cross_pairs(met: DataFrame, percent: int, partitions: int) -> DataFrame:
    """met(shingle, part, block, key, n, pos, mark, comp), by group and part: pairs of different components that may link."""

    def pairs(rows: list[tuple]) -> tuple[list, list]:
        rows.sort(key=lambda r: r[4])  # by size, so that the sizes that may link are a stretch
        n, pos = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
        comp = np.unique([r[7].hex() for r in rows], return_inverse=True)[1]
        block = np.array([r[2] for r in rows])
        left, right = [], []
        if comp.max(initial=0) == 0:
            return left, right
        two_blocks = len(set(block.tolist())) > 1
        upto = np.searchsorted(n, n * 100 // percent, "right")
        for i in range(len(rows) - 1):
            js = np.arange(i + 1, upto[i])
            o = overlap(n[i], n[js], percent)
            ok = (comp[js] != comp[i]) & (o <= n[i]) & (np.minimum(n[i] - pos[i], n[js] - pos[js]) >= o)
            if two_blocks:
                ok &= block[js] != block[i]
            js = js[ok].tolist()
            mark = unmark(rows[i][6]) if js else None
            for j in js:
                if shares_enough(mark, rows[i][4], unmark(rows[j][6]), rows[j][4], percent):
                    a, b = sorted((rows[i][3], rows[j][3]))
                    left.append(a), right.append(b)
        return left, right

    def run(batches):
        group, at = [], None
        for batch in batches:
            left, right = [], []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:2] != at:
                    if len(group) > 1:
                        a, b = pairs(group)
                        left += a
                        right += b
                    group, at = [], r[:2]
                group.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])
        if len(group) > 1:
            a, b = pairs(group)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    ordered = met.select("shingle", "part", "block", "key", "n", "pos", "mark", "comp").repartition(partitions, "shingle", "part").sortWithinPartitions("shingle", "part")
    return ordered.mapInArrow(run, "a binary, b binary").distinct()


def _verify(pairs: DataFrame, docs: DataFrame, words: int, percent: int, partitions: int) -> DataFrame:
    """The pairs (a, b) of set keys that link, by their whole texts."""
    partners = pairs.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    partners = materialise(partners, "partners")  # as a table, so that Spark can split a hot key's rows in the joins
    sketch = shared_sketch(partners.select("key"), lambda batch: np.frombuffer(b"".join(k[:8] for k in batch.column(0).to_pylist()), ">u8").astype(np.uint64), SKETCH_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(sketch > 0))  # which texts can be needed: 2**SKETCH_BITS bits

    def pick(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        hit = np.unpackbits(shared.value)
        for batch in batches:
            keys, packed = [], []
            for text in texts(batch):
                s = shingles(text, words)
                if len(s):
                    key = set_key(s)
                    if hit[int.from_bytes(key[:8], "big") >> (64 - SKETCH_BITS)]:
                        keys.append(key), packed.append(pack(text.encode()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], ["key", "packed"])

    found = docs.select("text").mapInArrow(tidy(pick), "key binary, packed binary").groupBy("key").agg(F.first("packed").alias("packed"))
    both = pairs.join(partners.select(F.col("key").alias("a"), F.col("n").alias("na")), "a").join(partners.select(F.col("key").alias("b"), F.col("n").alias("nb")), "b")
    by_a = F.col("na") >= F.col("nb")
    turned = both.select(F.when(by_a, F.col("a")).otherwise(F.col("b")).alias("head"), F.when(by_a, F.col("b")).otherwise(F.col("a")).alias("key"), F.ceil(F.greatest("na", "nb") / CHUNK).alias("chunks"))
    turned = materialise(turned.select("head", F.pmod(F.xxhash64("key"), F.col("chunks")).alias("chunk"), "key"), "turned-pairs")
    members = turned.select("head", "chunk", "key", F.lit(False).alias("is_head")).union(turned.select("head", "chunk", F.col("head").alias("key"), F.lit(True)).distinct())

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        s = None
        for batch in batches:
            kept = []
            for i, (is_head, packed) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                own = shingles(unpack(packed).decode(), words)
                if is_head:
                    s = own
                elif linked(s, own, percent):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(kept, pa.int64())) for c in batch.columns[:2]], ["a", "b"])

    ordered = members.join(found, "key").repartition(partitions, "head", "chunk").sortWithinPartitions("head", "chunk", F.desc("is_head"))
    return ordered.select("head", "key", "is_head", "packed").mapInArrow(tidy(run), "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """key, comp (the least key reachable) for all keys in links(a, b), by alternating large and small stars.

    A step takes least neighbours by aggregation and hands them on by a join, so no neighbourhood is gathered in a task.
    """
    edges = materialise(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        large = materialise(large, "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where(F.col("u") != F.col("v")).distinct()
        edges = materialise(small, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return edges.select(F.col("u").alias("key"), F.col("v").alias("comp")).union(edges.select(F.col("v").alias("key"), F.col("v").alias("comp")).distinct())


def set_components(docs: DataFrame, words: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """The documents' sets (doc_id, n, key) and, for keys that link to another set, their component (key, comp).  Both are tables; all others go."""
    spark = docs.sparkSession
    prepare(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with temporary(spark) as keep:
        sets = _nodes(docs, words, percent)
        nodes = sets.where(F.col("key").isNotNull()).groupBy("key").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
        postings = nodes.select("key", "n", F.posexplode("prefix").alias("pos", "shingle"))
        met = materialise(_met(postings, percent, partitions), "met")
        marks = materialise(sets.where(F.col("key").isNotNull()).groupBy("key").agg(F.first("n").alias("n"), F.first("mark").alias("mark"), F.first("costly").alias("costly")), "marks")

        # each with its group's pivot
        pivots = met.where("near").select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).distinct()
        tried = materialise(_filtered(pivots, marks, percent), "pivot-pairs")
        first = materialise(_verify(tried, docs, words, percent, partitions), "links")
        comps = materialise(components(first), "components")

        # pairs of different components
        about = marks.where("costly").select("key", "mark").join(comps, "key", "full")  # in a group only costly nodes bring their marks
        big = met.groupBy("shingle").agg(F.count("*").alias("size")).where(F.col("size") > SPLIT).withColumn("blocks", F.ceil(F.col("size") / SPLIT).cast("int"))
        rows = met.select("shingle", "key", "n", "pos").join(big.select("shingle", "blocks"), "shingle", "left").join(about, "key", "left")
        rows = rows.withColumn("comp", F.coalesce("comp", "key")).withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        parts = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(j, F.col("block")) * F.col("blocks") + F.greatest(j, F.col("block")))
        cross = _cross_pairs(rows.withColumn("part", F.explode(parts)), percent, partitions)
        cross = materialise(_filtered(cross, marks, percent).join(tried, ["a", "b"], "left_anti"), "cross-pairs")
        # an even part of the pairs first: where many link, it joins most of a group, and pairs within a component needn't be verified
        turn = F.pmod(F.xxhash64("a", "b"), F.lit(WAVE))
        second = materialise(_verify(cross.where(turn == 0), docs, words, percent, partitions), "links")
        comps = materialise(components(first.union(second)), "components")
        of_a, of_b = (comps.select(F.col("key").alias(x), F.col("comp").alias(f"comp_{x}")) for x in "ab")
        rest = cross.where(turn != 0).join(of_a, "a", "left").join(of_b, "b", "left").where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b")
        third = materialise(_verify(materialise(rest, "rest-pairs"), docs, words, percent, partitions), "links")
        of = keep(materialise(components(first.union(second).union(third)), "components"))
        slim = keep(materialise(sets.select("doc_id", "n", "key"), "sets"))
    return slim, of


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, for each document.

    A null text or one without words has an empty set and is linked with nothing: it is its own component, also beside equal ones.
    Repeated rows have equal sets.  Null doc_ids link like others; a component of null ids alone has a null id.  Very long texts are compared
    whole; other columns don't matter; an empty table gives no rows.
    """
    sets, comps = set_components(docs, words, percent)
    lowest = sets.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("least")).join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    of_comp = lowest.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = lowest.select("key", "comp").join(of_comp, "comp").select("key", "component_id")
    return sets.join(ids, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """The rows of docs without those of which another of their component stays: the one with the smallest doc_id (null last).

    Documents with an empty set (a null or empty text, or one without words) all stay.  Of rows that share doc_id and set one stays, the one with the least hash of all its columns; ties between null ids go to the least set.
    Nulls in other columns don't matter, columns of any name are kept, and an empty table stays empty.  Texts are shuffled once, to meet the decisions.
    """
    columns = docs.columns
    set_key_, set_id, doc = free_names(columns, "set_key", "set_id", "set_doc")
    sets, comps = set_components(docs, words, percent)
    sets = sets.where(F.col("key").isNotNull())
    one = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key"))
    by_set = sets.groupBy("key").agg(F.count("*").alias("rows"), F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id")).alias("low")).join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    stays = by_set.select("comp", F.col("low.doc_id").alias("doc_id"), "key").groupBy("comp").agg(one.alias("s")).select(F.col("s.doc_id").alias(set_id), F.col("s.key").alias(set_key_))

    at = [c.lower() for c in columns].index("text")

    def keyed(batches):
        for batch in batches:
            keys = [set_key(s) if len(s) else None for s in (shingles(t or "", words) for t in batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, set_key_])

    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    rows = docs.where(has_words).mapInArrow(tidy(keyed), StructType([*docs.schema.fields, StructField(set_key_, BinaryType())])).withColumn(doc, F.col("doc_id").cast("long"))
    repeated = sets.groupBy("doc_id", "key").agg(F.count("*").alias("c")).where("c > 1").limit(1).count() > 0
    kept = rows.join(stays, set_key_).where(F.col(doc).eqNullSafe(F.col(set_id)))
    if repeated:
        whole = F.struct(*[F.col(c) for c in columns])
        kept = kept.groupBy(set_key_).agg(F.min_by(whole, F.struct(F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns))).alias(doc)).select(f"{doc}.*")
    return kept.select(columns).union(docs.where(~has_words))
