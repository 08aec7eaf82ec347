"""The learned operators against plain versions of what they compute, and held-out accuracy."""

import collections
import math
import os
import random
import zlib

import numpy as np
import pytest
import zstandard

from lookout.llm import langid, mil

from .helpers import prose, rows

SF = "/root/testdata/sf0.01"


def plain_letters(text):
    return " ".join("".join(c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in text.lower()).split()).encode()


def plain_size(content, level, data):
    """A new compressor for each piece."""
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=level)
    return len(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(data))


def brute_language(learned, text):
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    data = b" " + plain_letters(text) + b" "
    sizes = {}
    for lang, content in learned.items():
        if len(data) < langid.SHORT:
            prefix = content[len(content) // 3 :][: langid.PREFIX]
            tails = [data] + [data[i:] for i in range(1, len(data) - 1) if data[i : i + 1] == b" " and data[i + 1 : i + 2] != b" "]
            sizes[lang] = sum(plain_size(content, langid.SHORT_LEVEL, prefix + t) - plain_size(content, langid.SHORT_LEVEL, prefix) for t in tails)
        else:
            sizes[lang] = sum(plain_size(content, langid.LEVEL, data[i : i + langid.PIECE]) for i in range(0, len(data), langid.PIECE))
    best, second = sorted(sizes, key=lambda x: (sizes[x], x))[:2]
    margin = max(0.0, (max(sizes[second], 1) - max(sizes[best], 0)) / max(sizes[second], 1))
    return best, margin / (margin + 0.05)


def test_language_by_brute_force():
    rng = random.Random(1)
    learned = {lang: (" " + prose(rng, 3000, lang) + " ").encode() for lang in ("de", "en")}
    coders = langid.Coders(learned)
    for text in [prose(rng, rng.randint(1, 500), rng.choice(["en", "de"])) for _ in range(25)] + ["", "12", "a", "Straße", "the the"]:
        lang, score, _ = coders.predict(text)
        want = brute_language(learned, text)
        assert lang == want[0], text
        assert score == pytest.approx(want[1])


def test_every_language_is_learned(spark):
    """Long rows, rows without a letter and languages with one short row: each language with a letter has a dictionary, and long texts teach it."""
    rng = random.Random(6)
    data = [(4 * i, prose(rng, 5000, "en"), "en") for i in range(39)] + [(1001, "ok", "en")] + [(2000 + i, prose(rng, 60, "de"), "de") for i in range(60)]
    data += [(3000 + i, "123 !!! 456", "junk") for i in range(9)] + [(4001, "é", "one"), (4002, "12 " * 20_000 + "żółw", "late"), (5001, None, "null"), (5002, "", "empty"), (5003, "abc", None)]
    data = [r for r in data if zlib.crc32(str(r[0]).encode()) % 4 != 2 or r[2] in ("de", "en")]
    data += [(i, t, lang) for lang, t in (("one", "é"), ("late", "12 " * 20_000 + "żółw")) for i in [next(i for i in range(6000, 6100) if zlib.crc32(str(i).encode()) % 4 != 2)]]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    learned = langid.dictionaries(docs)
    assert set(learned) == {"de", "en", "one", "late"}
    assert len(learned["en"]) > 100_000 and min(map(len, learned.values())) > 8
    assert max(map(len, learned.values())) <= langid.DICTIONARY
    assert "żółw".encode() in learned["late"]
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert all(got[i] == lang for i, _, lang in data if lang in ("de", "en") and i != 1001)


def test_dictionaries_by_brute_force(spark, monkeypatch):
    """What is learned, against the same rule over Python lists."""
    monkeypatch.setattr(langid, "SAMPLE", 5)
    rng = random.Random(7)
    data = [(i, prose(rng, rng.choice([3, 40, 4000]), lang), lang) for i, lang in enumerate(rng.choices(["de", "en"], k=60))]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    learned = langid.dictionaries(docs)

    def taught(text):
        if len(text.encode()) <= langid.LONGEST:
            return text
        bare = "".join(c if c.isalpha() else " " for c in text)
        bare = " ".join(bare.split(" ")) if bare != text else bare
        while "  " in bare:
            bare = bare.replace("  ", " ")
        size = langid.LONGEST // langid.SLICES
        return bare if len(bare) <= langid.LONGEST else " ".join(bare[int(max(len(bare) - size, 0) * i / (langid.SLICES - 1)) :][:size] for i in range(langid.SLICES))

    for lang, content in learned.items():
        parts = [plain_letters(taught(t)) + b" " for i, t, own in data if own == lang and zlib.crc32(str(i).encode()) % 4 != 2]
        used = []
        rest = content[1:]
        while rest:  # the dictionary is some of the parts, one after another, whole
            part = next(p for p in parts if rest.startswith(p) and p not in used)
            used.append(part)
            rest = rest[len(part) :]
        assert len(used) == 5


def test_learning_takes_one_row_an_id(spark, monkeypatch):
    """A labelled id on thousands of rows is one bag, whatever the partitions."""
    seen = []
    monkeypatch.setattr(mil.Model, "fit", classmethod(lambda cls, bags, labels, seed=1: seen.append((len(bags), [b.tobytes() for b in bags], labels)) or cls({})))
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5][:2]
    labels = spark.createDataFrame([(ids[0], 0), (ids[1], 1)], "doc_id long, quality int")
    docs = spark.createDataFrame([(ids[0], f"row {i}") for i in range(3000)] + [(ids[1], "other"), (ids[0], None)], "doc_id long, text string")
    for n in (1, 3, 5):
        mil.learn(docs.repartition(n), labels)
    assert [n for n, *_ in seen] == [2, 2, 2]
    assert seen[0] == seen[1] == seen[2]


def plain_score(w, text):
    """The score by sums over words and passages, without arrays."""
    words = text.encode().split()
    stops = list(range(0, max(1, len(words) - 16), 64)) + [len(words)]
    passages = [words[a:b] for a, b in zip(stops, stops[1:])] if words else [[]]
    encoded = mil.encode(text)
    hidden, energy = [], []
    for own, row in zip(passages, encoded):
        x = [float(v) for v in row[: mil.COUNTS]] + [0.0] * mil.BUCKETS
        for word in own:
            x[mil.COUNTS + int(mil.hasher()(word)[0] % np.uint64(mil.BUCKETS))] += 1 / len(own)
        assert np.allclose(x, row, atol=1e-6)
        x = [(a - float(m)) / float(s) for a, m, s in zip(x, w["mean"], w["scale"])]
        h = [math.tanh(sum(a * float(w["W"][i, j]) for i, a in enumerate(x)) + float(w["b"][j])) for j in range(mil.WIDTH)]
        gate = [math.tanh(sum(a * w["V"][i, j] for i, a in enumerate(h))) / (1 + math.exp(-sum(a * w["U"][i, j] for i, a in enumerate(h)))) for j in range(mil.GATE)]
        hidden.append(h)
        energy.append(sum(a * b for a, b in zip(gate, w["g"])))
    top = max(energy)
    a = [math.exp(e - top) for e in energy]
    z = [sum(p * h[j] for p, h in zip(a, hidden)) / sum(a) for j in range(mil.WIDTH)]
    return 1 / (1 + math.exp(-sum(x * y for x, y in zip(z, w["c"])) - float(w["d"][0])))


def test_quality_by_brute_force(monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(1, 300)) + rng.choice([" # $ %", "", "\na\na"]) for _ in range(40)]
    model = mil.Model.fit([mil.encode(t) for t in texts], [i % 2 for i in range(40)])
    for text in [*texts[:12], "", "   ", "one", *[r[1] for r in rows() if r[1] and len(r[1]) < 3000][:6]]:
        want = plain_score(model.w, text)
        assert model.score(mil.encode(text)) == pytest.approx(want, abs=1e-5)
        monkeypatch.setattr(mil, "STRETCH", 2)
        assert model.score(mil.encode(text)) == pytest.approx(want, abs=1e-5)
        monkeypatch.undo()


def test_words_alone_are_learned():
    """Two kinds of text with the same counts of characters and lengths of words: only the embedding of words tells them apart."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    text = lambda good: " ".join(rng.choice(vocabulary[:150] if good else vocabulary[150:]) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(200))
    labels = [i % 2 for i in range(400)]
    bags = [mil.encode(text(y)) for y in labels]
    model = mil.Model.fit(bags[:300], labels[:300])
    assert sum((model.score(b) > 0.5) == y for b, y in zip(bags[300:], labels[300:])) >= 90


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in langid.identify(docs).collect() if r.held_out and lang[r.doc_id]]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.97 * len(got) > 100
    truth = {r.doc_id: r.quality for r in labels.collect()}
    scored = [(r.score, truth[r.doc_id]) for r in mil.score_quality(docs, labels).collect() if r.held_out and truth.get(r.doc_id) in (0, 1)]
    pairs = collections.Counter(a > b for a, x in scored if x for b, y in scored if not y)
    assert pairs[True] >= 0.95 * sum(pairs.values()) > 0
