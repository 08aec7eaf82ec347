"""Best-fit packing of documents into token sequences.

Method: best-fit decreasing.  A segment tree over the remaining capacities 0..C finds the tightest open bin that still
holds a piece in O(log C).  Pieces have integer lengths of at most C, so pieces of one length are interchangeable and
bins of one remaining capacity too: the packing is planned over the histogram of lengths (at most C rows, whatever
the corpus), a run of equal pieces at a time, and equals what best-fit decreasing does piece by piece.  The plan is a table
of runs "pieces rank a to b of length s go to bins from x on, k to each, from offset o"; every piece then looks up its
run by its rank among the pieces of its length.  Nothing the driver holds grows with the corpus.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import held, materialise, offsets_within, prepare, texts, tidy, tokenizer_path

CAPACITY = 2048
#: Words whose ids a worker remembers, and the longest of them in characters: 25 MB for ordinary words.  When full, all but those of a batch are forgotten; longer ones are not kept.
WORDS_KEPT, LONGEST_KEPT = 700_000, 32
#: A fixed value: how the public byte-level tokenizer cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tightest:
    """A segment tree over capacities 0..n that tells which of them have an open bin."""

    def __init__(self, n: int):
        self.leaves = 1 << max(1, n.bit_length())
        self.open = [False] * (2 * self.leaves)

    def set(self, at: int, is_open: bool) -> None:
        i = at + self.leaves
        self.open[i] = is_open
        i >>= 1
        while i:
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]
            i >>= 1

    def least(self, at_least: int) -> int | None:
        """The smallest open capacity that is at_least or more."""
        i = at_least + self.leaves
        if self.open[i]:
            return at_least
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths 1..capacity.

    Returns runs (length, first rank, end rank, first bin, pieces a bin, offset in the bin), in order of length and rank.
    """
    tree, bins, made, runs = Tightest(capacity), {}, 0, []  # bins: remaining capacity -> [(first bin, number of bins)]

    def give(left: int, first: int, n: int) -> None:
        if n and left:
            bins.setdefault(left, []).append((first, n))
            tree.set(left, True)

    for size in sorted(counts, reverse=True):
        rank, end = 0, counts[size]
        if end and not 0 < size <= capacity:
            raise ValueError(f"a piece of {size} tokens can't be packed into {capacity}")
        while rank < end:
            left = tree.least(size)
            if left is None:
                per = capacity // size
                left, first, n = capacity, made, -(-(end - rank) // per)
                made += n
            else:
                first, n = bins[left].pop()
                if not bins[left]:
                    tree.set(left, False)
            per = left // size
            full = min(n, (end - rank) // per)
            if full:
                runs.append((size, rank, rank + full * per, first, per, capacity - left))
                rank += full * per
                give(left - per * size, first, full)
            if full < n and rank < end:
                some = end - rank
                runs.append((size, rank, end, first + full, some, capacity - left))
                rank = end
                give(left - some * size, first + full, 1)
                full += 1
            if full < n:
                give(left, first + full, n - full)
    return runs


class WordIds:
    """Words and the ids of a space and the word, as little-endian 32-bit bytes; a worker remembers WORDS_KEPT of up to LONGEST_KEPT characters.

    The tokenizer's pattern starts a new word at every space that a character other than white space follows, and looks
    no further back.  So the ids of a text are those of its words, one after another, and words recur.  New words are
    encoded many at a time, by the rank file of the same vocabulary, and told apart by the lengths of their ids' bytes.  All are
    Arrow arrays: the distinct words of a batch are looked up, and their ids put in the words' places, without an object a word.  Without a rank file
    beside it, the tokenizer file encodes whole texts.
    """

    def __init__(self, path: str, ranks_path: str):
        import base64
        import os

        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.core, self.words, self.ids = None, pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        if not os.path.exists(ranks_path):
            return
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.core = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.bytes_of[i] = len(token)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.core.encode_ordinary(text), "<u4")

    def learn(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        if not len(words):
            return self.ids[:0]
        ends = np.cumsum(pc.binary_length(words).to_numpy() + 1)
        ids = self.plain(" " + " ".join(words.to_numpy(zero_copy_only=False)))
        to = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, "left") + 1
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(np.append(0, 4 * to).astype(np.int64)), pa.py_buffer(ids.tobytes())])

    def of_words(self, distinct: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of distinct words.  To look up costs as the words that are kept, so few words are encoded instead."""
        if 8 * len(distinct) < len(self.words):
            return self.learn(distinct)
        known = pc.index_in(distinct, value_set=self.words)
        missing = known.is_null()
        new = distinct.filter(missing)
        learned = self.learn(new)
        at = known.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[missing.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
        out = pa.concat_arrays([self.ids, learned]).take(pa.array(at))
        if len(self.words) + len(new) > WORDS_KEPT:  # only those of this batch, if they fit
            self.words, self.ids = self.words[:0], self.ids[:0]
            new, learned = (distinct, out) if len(distinct) <= WORDS_KEPT else (new[:0], learned[:0])
        short = pc.less_equal(pc.utf8_length(new), LONGEST_KEPT)
        self.words, self.ids = pa.concat_arrays([self.words, new.filter(short)]), pa.concat_arrays([self.ids, learned.filter(short)])
        return out

    def joined(self, words: pa.LargeStringArray, ends: np.ndarray) -> list[memoryview]:
        """The ids of the words between each two ends."""
        coded = words.dictionary_encode()
        ids = self.of_words(coded.dictionary).take(coded.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        data = memoryview(ids.buffers()[2] or b"")
        return [data[i:j] for i, j in itertools.pairwise(at)]

    @staticmethod
    def split(found: list[str]) -> tuple[list[str], pa.LargeStringArray, np.ndarray]:
        """Each text's first word, all others, and the ends of each text's."""
        words = pc.split_pattern(pa.array(found, pa.large_string()), " ")
        at = words.offsets.to_numpy()
        later = np.ones(len(words.values), bool)
        later[at[:-1]] = False
        return words.values.take(pa.array(at[:-1])).to_pylist(), words.values.filter(pa.array(later)), at - np.arange(len(at))

    @staticmethod
    def odd_texts(words: pa.LargeStringArray, ends: np.ndarray) -> list[int]:
        """Texts with a space before other white space or the end, at which the tokenizer does not cut."""
        first = pc.utf8_slice_codeunits(words, 0, 1).dictionary_encode()
        odd = [i for i, c in enumerate(first.dictionary.to_pylist()) if not c or c.isspace()]
        return np.unique(np.searchsorted(ends, np.flatnonzero(np.isin(first.indices.to_numpy(), odd)), "right") - 1).tolist() if odd else []

    def of(self, found: list[str]) -> Iterator[bytes]:
        if self.core is None or not found:
            yield from map(self.whole, found)
            return
        whole = {i for i, t in enumerate(found) if any(s in t for s in self.special)}
        first, words, ends = self.split(["" if i in whole else t for i, t in enumerate(found)])
        odd = self.odd_texts(words, ends)
        if odd:
            cut = {i: self.odd_split(found[i]) for i in odd}
            first, words, ends = self.split(["" if i in whole or i in cut else t for i, t in enumerate(found)])
            odd_ends = np.cumsum([0, *(len(x) - 1 for x in cut.values())])
            odd_ids = self.joined(pa.array([w for x in cut.values() for w in x[1:]], pa.large_string()), odd_ends)
            odd_ids = {i: self.plain(x[0]).tobytes() + ids for (i, x), ids in zip(cut.items(), odd_ids, strict=True)}
        for i, (text, word, ids) in enumerate(zip(found, first, self.joined(words, ends), strict=True)):
            yield self.whole(text) if i in whole else odd_ids[i] if odd and i in odd_ids else self.plain(word).tobytes() + ids

    @staticmethod
    def odd_split(text: str) -> list[str]:
        """For texts with a space before other white space: cuts only at spaces before another character."""
        return re.split(r" (?=\S)", text)


def word_ids(path: str, ranks_path: str) -> WordIds:
    """One per worker process."""
    return held(("ids", path, ranks_path), lambda: WordIds(path, ranks_path))


def token_bytes(found: list[str], path: str) -> Iterator[bytes]:
    """The ids of each text by the tokenizer file at path, as little-endian 32-bit bytes."""
    return word_ids(path, path.removesuffix(".json") + ".tiktoken").of(found)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length, ids_crc32.

    A document is its ids, then end_id (so an empty or null text has one token).  One longer than capacity is cut from its end
    into pieces of capacity tokens; what is left over is its first piece.
    """
    prepare(docs.sparkSession)
    path, end = tokenizer_path(tokenizer), np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for batch in batches:
            ids, piece, start, length, crc = [], [], [], [], []
            for doc_id, b in zip(batch.column(0).to_pylist(), token_bytes(texts(batch), path), strict=True):
                b += end
                n = len(b) // 4
                at, k = 0, 0
                while at < n:
                    to = at + ((n - at - 1) % capacity + 1)
                    ids.append(doc_id), piece.append(k), start.append(at), length.append(to - at)
                    crc.append(zlib.crc32(b[4 * at : 4 * to]))
                    at, k = to, k + 1
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """Packs all documents: token_pieces() and sequence_id, offset.

    Null doc_ids and repeated rows are packed like any other; a null or empty text is its end id alone; a very long one is cut; pieces of equal length stand
    in an order of hashes, in which rows that tie are alike; other columns of docs are ignored; an empty table gives no rows.
    """
    pieces = materialise(token_pieces(docs, capacity, tokenizer, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    runs = plan_runs(counts, capacity)
    table = {}
    for size, first, end, bin_, per, at in runs:
        table.setdefault(size, []).append((first, end, bin_, per, at))
    arrays = {size: np.array(x, np.int64) for size, x in table.items()}
    shared = docs.sparkSession.sparkContext.broadcast(arrays)  # its size depends on capacity only

    def place(batches):
        for batch in batches:
            names = batch.schema.names
            size = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("rank")).to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                own = np.flatnonzero(size == s)
                run = shared.value[int(s)]
                found = run[np.searchsorted(run[:, 0], rank[own], "right") - 1]
                nth = rank[own] - found[:, 0]
                sequence[own] = found[:, 2] + nth // found[:, 3]
                offset[own] = found[:, 4] + (nth % found[:, 3]) * s
            keep = [batch.column(names.index(n)) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = offsets_within(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], None, "rank")
    return ranked.mapInArrow(tidy(place), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
