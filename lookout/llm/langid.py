"""Language identification by compression.

Each language has a zstandard raw-content dictionary: letters of texts in that language.  A text is encoded with each of them,
and the language whose dictionary makes it smallest is chosen; where the runner-up comes within `margin`, the prediction
counts as rejected.  Long texts are encoded whole, in pieces of PIECE bytes.  Zstandard leaves very short inputs as they are, so
texts under SHORT bytes are encoded behind a stretch of the dictionary itself, at the highest level, and once more from each
of their words on, which gives a finer measure than whole bytes.

A dictionary is texts of a bounded sample of labelled rows, in a seeded order, as far as they fit.  Texts up to LONGEST bytes are taken whole; of a longer one the
letters are, SLICES stretches spread evenly over it.  So every language that has a letter in a row to learn from is learned.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.llm.common import bounded_sample, held, learned_split, prepare, texts, tidy

#: Labelled rows that a language is learned from, at most; the bytes of a text that are taken whole, and the stretches of a longer one; the bytes of a dictionary.
SAMPLE, LONGEST, SLICES, DICTIONARY = 600, 16 << 10, 8, 256 << 10
PIECE, SHORT, PREFIX = 2048, 300, 300
LEVEL, SHORT_LEVEL, MARGIN = 9, 19, 0.01
#: All but lower-case ASCII letters and bytes of longer characters become spaces.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def letters(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


def taught(text: Column) -> Column:
    """What a text teaches: itself up to LONGEST bytes, else SLICES stretches of its letters, as many characters together at most, from its beginning to its end."""
    bare = F.regexp_replace(text, r"[^\p{L}\p{M}]+", " ")
    size = LONGEST // SLICES
    slices = [F.substring(bare, (F.greatest(F.length(bare) - size, F.lit(0)) * i / (SLICES - 1)).cast("int") + 1, F.lit(size)) for i in range(SLICES)]
    return F.when(F.octet_length(text) <= LONGEST, text).when(F.length(bare) <= LONGEST, bare).otherwise(F.concat_ws(" ", *slices))


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Learns a dictionary for each language from rows with text and lang, outside the held-out quarter.

    The sample has at most SAMPLE rows of a language, of those with a letter, whatever their length; only what they teach leaves the executors.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~learned_split(F.col("doc_id"), 4, 2) & F.col("text").rlike(r"\p{L}"))
    found: dict[str, list[bytes]] = {}
    for r in bounded_sample(rows, "lang", SAMPLE, ["lang", "text"], shown={"taught": taught(F.col("text"))}):
        found.setdefault(r["lang"], []).append(letters(r["taught"]) + b" ")
    return {lang: content(parts) for lang, parts in sorted(found.items())}


def content(parts: list[bytes]) -> bytes:
    """A dictionary of the parts that fit; of very few letters they are repeated, as zstandard takes 8 bytes at least."""
    joined = b"".join(fill(parts, DICTIONARY - 1))
    return b" " + joined * (1 if len(joined) > 8 else -(-9 // len(joined)))


def fill(parts: list[bytes], most: int) -> list[bytes]:
    """The parts in order, without those for which there is no room left; the first one is in whatever its size."""
    out, room = parts[:1], most - sum(map(len, parts[:1]))
    for p in parts[1:]:
        if len(p) <= room:
            out.append(p)
            room -= len(p)
    return out


class Coders:
    """The compressors of all languages, in one worker."""

    def __init__(self, learned: dict[str, bytes]):
        import zstandard as zstd

        def coder(content: bytes, level: int):
            d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            return zstd.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

        self.names = list(learned)
        self.long = [coder(c, LEVEL) for c in learned.values()]
        self.short = [(coder(c, SHORT_LEVEL), c[len(c) // 3 : len(c) // 3 + PREFIX]) for c in learned.values()]
        self.own = [len(c.compress(prefix)) for c, prefix in self.short]
        self.word = re.compile(rb" [^ ]")

    def sizes(self, text: str) -> list[int]:
        data = b" " + letters(text) + b" "
        if len(data) < SHORT:
            parts = [data, *[data[m.start() :] for m in self.word.finditer(data)][1:]]
            return [sum(len(c.compress(prefix + p)) for p in parts) - own * len(parts) for (c, prefix), own in zip(self.short, self.own, strict=True)]
        parts = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.long]

    def predict(self, text: str) -> tuple[str, float, float]:
        """Language, score, and the margin by which the runner-up is larger, as a share of it."""
        if not self.names or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.names[0], 1.0, 1.0
        best, second = max(sizes[order[0]], 0), max(sizes[order[1]], 1)
        margin = max(0.0, (second - best) / second)
        return self.names[order[0]], margin / (margin + 0.05), margin


def _coders_of(shared) -> Coders:
    """One set of compressors per worker process and broadcast dictionaries."""
    return held(("coders", hash(tuple(shared.value.items()))), lambda: Coders(shared.value))


def _shared(spark: SparkSession, docs: DataFrame, learned: dict[str, bytes] | None):
    prepare(spark)
    return spark.sparkContext.broadcast(dictionaries(docs) if learned is None else learned)  # DICTIONARY bytes for each language


def identify(docs: DataFrame, learned: dict[str, bytes] | None = None, margin: float = MARGIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected, for each document.

    A text that is null or has no letter is `und`, score 0, rejected; so is all where nothing could be learned.  Equal sizes go to the
    language that comes first.  Null doc_ids count as not held out.  Null or empty lang only means that a row teaches nothing or its own value.
    Long texts are encoded whole; repeated rows are told each, alike; other columns don't matter; an empty table gives no rows.
    """
    shared = _shared(docs.sparkSession, docs, learned)

    def run(batches):
        for batch in batches:
            coders = _coders_of(shared)
            out = [coders.predict(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[0] == "und" or x[2] < margin for x in out], pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), learned_split(F.col("doc_id"), 4, 2).alias("held_out"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, learned: dict[str, bytes] | None = None, margin: float = MARGIN) -> DataFrame:
    """The rows of docs whose language is told without rejection, with all their columns, whatever their names.

    As identify() says: rows with a null or empty text, without a letter or with a narrow margin go; repeated rows stay or go together; null ids and
    nulls in other columns don't matter; an empty table stays empty.
    """
    shared = _shared(docs.sparkSession, docs, learned)

    def run(batches):
        for batch in batches:
            coders = _coders_of(shared)
            out = [coders.predict(t) for t in texts(batch)]
            yield batch.filter(pa.array([x[0] != "und" and x[2] >= margin for x in out], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
