"""A ledger of quality rules as bit masks, with DataFrame functions only.

Every rule is evaluated once for each document; the ledger stores what was measured and one bit for each rule that failed.  A
policy is a version and a mask: a document is kept if none of its failed rules is in the mask.  What each policy keeps, and what
it would keep without one of its rules, are then bitwise aggregations over the ledger, without another look at a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import SPACES, WORD, materialise

SYMBOLS = "#*$%&|<>"
#: bit: (name, what fails), over the measurements.  The first two are the base rules of every policy.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 40 * n_words"),
    ("duplicate_lines", "n_lines >= 5 and 100 * n_dup_lines > 60 * n_lines"),
    ("short_words", "10 * word_chars < 20 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("upper_case", "n_letters >= 50 and 100 * n_upper > 70 * n_letters"),
    ("no_letters", "10 * n_letters < 5 * word_chars"),
    ("few_distinct_words", "n_words >= 100 and 100 * n_distinct_words < 8 * n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: Versioned policies; `standard` in its latest version decides op2's verdict.
POLICIES: dict[tuple[str, int], int] = {
    ("base", 1): BASE,
    ("standard", 1): BASE | BIT["symbols"] | BIT["duplicate_lines"] | BIT["no_letters"],
    ("standard", 2): sum(BIT.values()),
}
STANDARD = ("standard", 2)


def _let(value: Column, use) -> Column:
    """use(value), with value evaluated once: as the only element of an array that a lambda takes."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _shift(a: Column, by: int) -> Column:
    return F.slice(a, by + 1, F.greatest(F.size(a) - by, F.lit(0)))


def _repeated(values: Column) -> Column:
    """Of an ascending array of structs whose first field is `v`: those equal in v to a neighbour."""
    at = lambda a, i: F.try_element_at(a, i)
    return _let(values, lambda a: F.filter(F.transform(a, lambda x, i: F.struct(x["v"].alias("v"), x["p"].alias("p"), (at(a, i + 2)["v"].eqNullSafe(x["v"]) | ((i > 0) & at(a, F.when(i > 0, i).otherwise(1))["v"].eqNullSafe(x["v"]))).alias("twice"))), lambda x: x["twice"]))


def repeat_words(words: Column) -> Column:
    """How many words lie in windows of 3 words that occur twice or more.

    Windows are sorted as 64-bit numbers, the upper bits of a hash above the position, which sorts plain longs.  Windows whose
    hash bits recur are candidates; only these are compared word by word.  The words covered by the windows found are then
    counted from the gaps between their positions.
    """
    n = F.size(words)
    bits = F.length(F.bin(n.cast("long")))  # a position fits into as many bits
    second, third = F.slice(words, 2, F.greatest(n - 2, F.lit(0))), F.slice(words, 3, F.greatest(n - 2, F.lit(0)))
    first = F.slice(words, 1, F.greatest(n - 2, F.lit(0)))
    hashes = F.zip_with(F.zip_with(first, second, lambda a, b: F.xxhash64(a, b)), third, lambda h, c: F.xxhash64(h, c))
    shift = lambda f, a, b: F.call_function(f, a, b)
    packed = _let(bits, lambda k: F.transform(hashes, lambda h, i: shift("shiftleft", shift("shiftright", h, k), k) + i.cast("long")))
    ordered = F.sort_array(packed)

    def positions(sorted_: Column, k: Column) -> Column:
        top = lambda x: shift("shiftright", x, k)
        pairs = F.zip_with(sorted_, _shift(sorted_, 1), lambda a, b: F.when(top(a) == top(b), F.array(a, b)))
        found = F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull())))
        return F.transform(found, lambda x: (x - shift("shiftleft", top(x), k)).cast("int"))

    candidates = _let(ordered, lambda s: _let(bits, lambda k: positions(s, k)))
    windows = _let(words, lambda w: F.transform(candidates, lambda p: F.struct(F.struct(F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("v"), p.alias("p"))))
    found = F.sort_array(F.transform(_repeated(F.sort_array(windows)), lambda x: x["p"]))
    covered = _let(found, lambda p: F.aggregate(F.zip_with(p, _shift(p, 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))), F.lit(0).cast("long"), lambda s, x: s + x))
    return F.when(n < 3, F.lit(0).cast("long")).otherwise(covered)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each whole text (null: empty)."""
    strip = F.lit(SPACES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    rows = rows.select("doc_id", "t", F.array_remove(F.split(F.btrim("t", strip), r"[\x20\x09-\x0D]+"), "").alias("words"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, strip)) > 0)
    out = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.length(F.regexp_replace("t", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("t", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
    )
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "lines.n_lines", "lines.n_dup_lines", "n_repeat_words", "n_distinct_words", "n_letters", "n_upper")


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and fail_bits, one bit for each of RULES that the document fails."""
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(0).cast("long"))
    return measure(docs).withColumn("fail_bits", bits)


def verdict(mask: int) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0


def judge(docs: DataFrame, policy: tuple[str, int] = STANDARD) -> DataFrame:
    """The ledger with base_failed and kept, by one policy.

    A null or empty text has no words, so it fails few_words; very long texts are measured whole; repeated rows and null ids are judged each; other columns
    don't matter; an empty table gives no rows.
    """
    return ledger(docs).withColumns({"base_failed": ~verdict(BASE), "kept": verdict(BASE | POLICIES[policy])})


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger written to the shared folder, so that any number of policies and ablations read it without another look at a text."""
    return materialise(ledger(docs), "rule-ledger")


def ablations(rows: DataFrame, policies: dict[tuple[str, int], int] = POLICIES) -> DataFrame:
    """For each policy and each of its rules: how many documents it keeps, how many the rule fails, how many fail by it alone (and
    would be kept without it), and all bits that fail together with it.  rows: a ledger; of an empty one there are no rows."""
    bits = F.explode(F.array(*[F.struct(F.lit(name).alias("policy"), F.lit(version).alias("version"), F.lit(rule).alias("rule"), F.lit(mask).cast("long").alias("mask"), F.lit(BIT[rule]).cast("long").alias("bit")) for (name, version), mask in policies.items() for rule in BIT if BIT[rule] & mask])).alias("p")
    # first by the distinct masks, of which there are 2**len(RULES) at most: the policies then look at no more rows than that
    held = rows.groupBy("fail_bits").agg(F.count("*").alias("n")).select("fail_bits", "n", bits).select("fail_bits", "n", "p.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    total = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    fails = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    return held.groupBy("policy", "version", "rule").agg(total(hit == 0).alias("kept"), total(fails).alias("failed"), total(hit == F.col("bit")).alias("failed_alone"), F.coalesce(F.bit_or(F.when(fails, hit)), F.lit(0).cast("long")).alias("failed_with"))
