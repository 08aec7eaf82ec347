"""Token counts by a count-only Viterbi search.

The vocabulary is the pieces and scores of a public piece model, read as a unigram model.  An Aho-Corasick automaton enumerates all
pieces in a text; dynamic programming over their ends carries the best score and its number of pieces, and keeps no path.

The rules are those of the unigram tokenizer: a space counts as U+2581, and one is put before the text; of two ways with
equal scores into a position the one whose last piece starts earlier stays; a character that is no piece by itself may be unknown, at
the lowest score less 10, and counts as its UTF-8 bytes.  No piece goes on past the characters before a space, so a text is the
sum of its words, each behind its spaces; and words recur, so a worker remembers theirs.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import held, prepare, texts, tidy, tokenizer_path

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words a worker remembers, and the longest of them in characters: under 300 MB, about 150 MB for ordinary words.  When full, they are forgotten; longer ones aren't kept.
WORDS_KEPT, LONGEST_KEPT = 700_000, 32


def vocabulary(path: str) -> dict[str, float]:
    """The plain pieces of a piece model and their scores; not its control, unknown and byte pieces."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return {m.id_to_piece(i): m.get_score(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))}


class Counter(dict):
    """word (with the spaces before it) -> (best score, pieces)."""

    def __init__(self, pieces: dict[str, float]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        within = re.compile(f"[^{SPACE}]{SPACE}")
        self.by_word = not any(within.search(p) for p in pieces)
        self.newline = not any("\n" in p for p in pieces)
        self.word = re.compile(r" *[^ \n]+|\n| +" if self.newline else r" *[^ ]+| +")

    def search(self, text: str) -> tuple[float, int]:
        """The best score and its pieces, of a text whose spaces are U+2581 already."""
        size = len(text)
        best: list[float | None] = [0.0] + [None] * size
        pieces = [0] * (size + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for end, (length, score) in self.automaton.iter(text):
            ends[end].append((end + 1 - length, score))
        for end, found in enumerate(ends):
            top, count, single = None, 0, False
            found.sort()
            for start, score in found:
                single |= start == end
                total = best[start] + score
                if top is None or total > top:
                    top, count = total, pieces[start] + 1
            if not single:
                total = best[end] + self.unknown
                if top is None or total > top:
                    top, count = total, pieces[end] + len(text[end].encode())
            best[end + 1], pieces[end + 1] = top, count
        return best[size], pieces[size]

    def __missing__(self, word: str) -> tuple[float, int]:
        found = self.search(word.replace(" ", SPACE))
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = found
        return found

    def count(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        text = text.replace(SPACE, " ")
        if not self.by_word:
            return self.search((" " + text).replace(" ", SPACE))
        score, pieces = 0.0, 0
        for s, n in map(self.__getitem__, self.word.findall(" " + text)):
            score += s
            pieces += n
        return score, pieces


def counter(path: str) -> Counter:
    """One per worker process."""
    return held(("pieces", path), lambda: Counter(vocabulary(path)))


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_tokens and score, the best segmentation's, for each whole text; a null or empty text has 0 tokens and score 0.

    Null and repeated doc_ids are counted each; a very long text or word is searched whole; other columns don't matter; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    path = tokenizer_path(model)

    def run(batches):
        c = counter(path)
        for batch in batches:
            found = [c.count(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.float64())], ["doc_id", "n_tokens", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, n_tokens long, score double")
