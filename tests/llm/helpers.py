"""Small tables that have every awkward row."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = {"en": "the of and river stone winter under bright morning walked slowly house".split(), "de": "der die und fluß stein winter unter heller morgen ging langsam haus".split()}


def prose(rng, n, lang="en"):
    return " ".join(rng.choice(VOCABULARY[lang]) + rng.choice(["", "", "s", "ly", "er"]) + str(rng.randint(0, 40) or "") for _ in range(n))


def rows(n=60, seed=1):
    """Documents in two languages with a hot source, copies, near copies, a repeated row, a very long, an empty and a null text, and nulls elsewhere."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = "de" if i % 3 == 0 else "en"
        text = prose(rng, rng.randint(1, 200), lang)
        out.append([i, text, lang, "hot" if i % 3 else f"s{i % 7}"])
    base = prose(rng, 300)
    words = base.split(" ")
    for k in range(8):  # near copies: one word changed each
        changed = list(words)
        changed[10 + 30 * k] = f"changed{k}"
        out.append([n + k, " ".join(changed), "en", "hot"])
    out += [[n + 10 + k, out[5][1], "en", "s1"] for k in range(4)]  # exact copies
    out.append(list(out[3]))  # a repeated row
    out += [[n + 20, None, None, None], [n + 21, "", "en", ""], [n + 22, " \n\t ", "de", "hot"], [None, prose(rng, 30), "en", "s2"], [n + 23, prose(rng, 20_000), "en", "hot"], [n + 24, "!!! ??? 123", "en", "s1"], [n + 25, "a b", None, "s1"], [n + 26, "a b", None, None]]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in out]


def table(spark, data=None):
    """With columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    return df.withColumns({c: F.lit(1) for c in ("size", "score", "shard", "key", "piece", "rank", "start", "taken", "range", "kept", "words")})
