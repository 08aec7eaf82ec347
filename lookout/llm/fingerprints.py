"""I-Match document fingerprints with randomised lexicon subsets.

A term is a run of letters and digits, in lower case (A-Z).  The lexicon is the terms whose inverse document frequency lies in a band, by
exact counts over all documents: tasks add up the terms of their documents, and what is shuffled is one number for each term of a task.
A document keeps its distinct terms in the lexicon, sorted, and hashes those that fall into each of SUBSETS random subsets of the lexicon.
A document without a term in the band keeps all its terms.

The subsets are nested: a document uses those that have 2**-level of the lexicon, level being where a subset keeps one or two of its terms, and
the next ones, half as large.  So a fingerprint has both levels' hashes, and the likeness of two is the share of equal hashes on the levels they have in
common, without subsets that keep nothing of either.  Subsets this small are what lets a text that is a third different share hashes at all; of
large fixed subsets, each of which loses its hash with one term, it would share none.  In this the hashes are close to sampled minima.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import TERM_CODES, WordHasher, materialise, mix, prepare, temporary, texts, tidy

#: The band, as shares of all documents that hold a term: idf = -ln(share).
LEAST_SHARE, MOST_SHARE = 0.0005, 0.05
SUBSETS, ROWS_A_BUCKET = 32, 2000
#: Terms that a task adds up before it hands their counts on.
TERMS_AT_ONCE = 1 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)
TOP = (1 << 63) - 1


@functools.cache
def hasher() -> WordHasher:
    return WordHasher(TERM_CODES)


@functools.cache
def _multipliers() -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 63, SUBSETS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


def terms(text: str) -> np.ndarray:
    """The distinct terms of a text as sorted 64-bit hashes."""
    return np.unique(hasher()(text.encode()))


class Lexicon:
    """Which terms lie in the band; `inside` has their hashes, sorted."""

    def __init__(self, inside: np.ndarray):
        self.inside = inside

    def keep(self, found: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.inside, found)
        kept = found[(at < len(self.inside)) & (self.inside[np.minimum(at, len(self.inside) - 1)] == found)] if len(self.inside) else found[:0]
        return kept if len(kept) else found  # a text with no term in the band keeps all


def fingerprint(text: str, lexicon: Lexicon) -> str:
    """`level:` and SUBSETS hashes of 4 hex digits (0000: nothing kept) for the level and for the next; empty without terms."""
    kept = lexicon.keep(terms(text))
    if not len(kept):
        return ""
    level = max(1, int(len(kept)).bit_length() - 1)
    product = kept * _multipliers()
    out = []
    for one in (level, level + 1):
        subset, term = np.nonzero(product < np.uint64(1 << (64 - one)))
        hashes = np.zeros(SUBSETS, np.uint64)
        if len(subset):
            new = np.flatnonzero(np.append(True, subset[1:] != subset[:-1]))
            place = np.arange(len(subset)) - np.repeat(new, np.diff(np.append(new, len(subset))))
            sums = np.add.reduceat(mix(kept[term] + _GOLD * (place + 1).astype(np.uint64)), new)
            hashes[subset[new]] = mix(sums) % np.uint64(0xFFFF) + np.uint64(1)
        out.append(hashes.astype(">u2").tobytes().hex())
    return f"{level}:{''.join(out)}"


def likeness(a: str, b: str) -> float:
    """0 to 1; of two empty fingerprints 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (i, x), (j, y) = a.split(":"), b.split(":")
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2").reshape(2, SUBSETS) for s in (x, y))
    common = {int(i) + k: x[k] for k in (0, 1)}
    same = total = 0
    for k in (0, 1):
        if (other := common.get(int(j) + k)) is not None:
            some = (other != 0) | (y[k] != 0)
            same += int(((other == y[k]) & some).sum())
            total += int(some.sum())
    return same / total if total else 0.0


def lexicon_of(docs: DataFrame, n_docs: int, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> np.ndarray:
    """The hashes of all terms that `least` to `most` of the documents hold (an upper bound under one document counts as one), sorted.

    They number (distinct terms of a document, on average) / least at most, however many documents there are.
    """

    def count(batches):
        terms_, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(terms_.view(np.int64)), pa.array(counts)], ["term", "n"])

        for batch in batches:
            every = np.concatenate([terms_, *(terms(t) for t in texts(batch))])
            order = np.argsort(every, kind="stable")
            every = every[order]
            n = np.concatenate([counts, np.ones(len(every) - len(counts), np.int64)])[order]
            first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
            terms_, counts = every[first], np.add.reduceat(n, first) if len(first) else counts
            if len(terms_) > TERMS_AT_ONCE:
                yield rows()
                terms_, counts = terms_[:0], counts[:0]
        yield rows()

    total = docs.select("text").mapInArrow(tidy(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = total.where((F.col("n") >= least * n_docs) & (F.col("n") <= max(most * n_docs, 1))).select("term").toArrow()
    return np.sort(band.column(0).to_numpy().view(np.uint64))


def edges_of(rows: DataFrame) -> list[tuple[int, int]]:
    """The greatest (key, tie) of each of the ranges, of about ROWS_A_BUCKET rows(key, tie), that have rows.  A key with more rows is split by its ties.

    Cuts are quantiles, which needn't be exact; the greatest rows under them are.
    """
    ranges = max(1, min(100_000, rows.count() // ROWS_A_BUCKET))

    def shares(n: int):
        return F.array(*[F.lit((i + 1) / n) for i in range(n)])

    times = Counter(rows.agg(F.percentile_approx("key", shares(ranges), F.lit(max(10_000, 20 * ranges))).alias("b")).first()["b"] or [])
    cuts = {(k, TOP) for k in times}
    for bits in {n.bit_length() for n in times.values() if n > 2}:
        hot = [k for k, n in times.items() if n > 2 and n.bit_length() == bits]
        found = rows.where(F.col("key").isin(hot)).groupBy("key").agg(F.percentile_approx("tie", shares(1 << bits), F.lit(10_000 + (20 << bits))).alias("b"))
        cuts |= {(r["key"], t) for r in found.collect() for t in r["b"]}
    ordered = sorted(cuts)

    def tops(batches):
        best: dict[int, tuple[int, int]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = bisect.bisect_left(ordered, row)
                best[at] = max(best.get(at, row), row)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([*best], [k for k, _ in best.values()], [t for _, t in best.values()])], ["range", "key", "tie"])

    top = rows.select("key", "tie").mapInArrow(tops, "range long, key long, tie long").groupBy("range").agg(F.max(F.struct("key", "tie")).alias("top")).select("top.*").collect()
    return sorted((r["key"], r["tie"]) for r in top)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each document.

    The order is by descending doc_id (null last; repeated ids by a hash of the text); the edited text has its last floor(n_chars / 3)
    code points replaced by the first as many (or all) of the next document, after the last: the first.  A single document is its own next.
    A null text is empty: its fingerprint is empty, and it is like only another one.  Equal texts have equal fingerprints.  Very long texts are
    read whole; rows that agree in doc_id and text may stand in each other's place; other columns don't matter; an empty table gives no rows.

    Documents are dealt by ranges of (doc_id, hash of the text), so that a range's rows can be read in order; the first document of the range
    after it comes along as a guest.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"), F.xxhash64(text).alias("tie"))
    with temporary(spark):
        edges = edges_of(materialise(rows.select("key", "tie"), "document-keys"))
    shared = spark.sparkContext.broadcast((edges, lexicon_of(rows, rows.count())))  # some 100,000 edges at most, and the lexicon, as small as it says

    def deal(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        edges, inside = shared.value
        lexicon = Lexicon(inside)
        for batch in batches:
            out = []
            for doc_id, text, k, tie in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = bisect.bisect_left(edges, (k, tie))
                row = (doc_id, k, tie, len(text), fingerprint(text, lexicon), pack(text.encode()))
                out.append((at, False, *row))
                if (k, tie) == edges[at]:  # the first of its range: the one before it may be the last of another
                    out.append(((at + 1) % len(edges), True, *row))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)] if out else [pa.array([], t) for t in (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())], ["range", "guest", "doc_id", "key", "tie", "n_chars", "fingerprint", "packed"])

    def edit(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        lexicon = Lexicon(shared.value[1])
        before = None
        for batch in batches:
            out = []
            for r in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                here = (*r[:-1], unpack(r[-1]).decode())
                if before is not None and not before[1]:
                    count, text = before[5], before[7]
                    cut = count // 3
                    edited = text[: count - cut] + here[7][:cut] if cut else text
                    mark = fingerprint(edited, lexicon)
                    out.append((before[2], count, hashlib.sha256(edited.encode()).hexdigest(), before[6], mark, likeness(before[6], mark), likeness(before[6], here[6])))
                before = here
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    dealt = rows.mapInArrow(tidy(deal), "range int, guest boolean, doc_id long, key long, tie long, n_chars long, fingerprint string, packed binary")
    ordered = dealt.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "range").sortWithinPartitions("range", "guest", F.desc("key"), F.desc("tie"))
    return ordered.mapInArrow(tidy(edit), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def text_tie(text: str) -> int:
    """The signed 64-bit hash of the text that orders repeated doc_ids, as xxhash64() of Spark gives it."""
    import xxhash

    n = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return n - (1 << 64) if n > TOP else n
