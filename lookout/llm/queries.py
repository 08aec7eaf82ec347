"""The corpus operators as queries over whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lookout.llm.common import documents


def op8_attention_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.mil import score_quality

    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.jaccard import jaccard_components

    return jaccard_components(documents(spark, sf_dir))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.packing import pack

    return pack(documents(spark, sf_dir))


def op1_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.fingerprints import fingerprints

    return fingerprints(documents(spark, sf_dir))


def op2_rule_bitmask_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.quality_rules import judge

    return judge(documents(spark, sf_dir))


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy version does, from op2's stored ledger."""
    from lookout.llm.quality_rules import ablations, stored_ledger

    return ablations(stored_ledger(documents(spark, sf_dir)))


def op3_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.mixing import mix_sources

    return mix_sources(documents(spark, sf_dir))


def op4_site_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.html import main_text

    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.langid import identify

    return identify(documents(spark, sf_dir))


def op6_count_only_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.token_count import count_tokens

    return count_tokens(documents(spark, sf_dir))


def op7_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.sharding import kd_shards

    return kd_shards(documents(spark, sf_dir))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.trie import conversation_trie

    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_hilbert_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.curve import curve_digest

    return curve_digest(documents(spark, sf_dir))


def op13_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lookout.llm.lloyd import clustered

    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_imatch_fingerprints": op1_imatch_fingerprints,
    "op2_rule_bitmask_ledger": op2_rule_bitmask_ledger,
    "op3_sainte_lague_mix": op3_sainte_lague_mix,
    "op4_site_template_removal": op4_site_template_removal,
    "op5_compression_language": op5_compression_language,
    "op6_count_only_viterbi": op6_count_only_viterbi,
    "op7_kd_tree_sharding": op7_kd_tree_sharding,
    "op8_attention_mil_quality": op8_attention_mil_quality,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_hilbert_curve_packing": op12_hilbert_curve_packing,
    "op13_delta_lloyd": op13_delta_lloyd,
    "rule_ablations": rule_ablations,
}

_LEDGER = r"""d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT k, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS v
        FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS p FROM w)),
twice AS (SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, v) AS n FROM win) WHERE n > 1),
covered AS (SELECT k, count(DISTINCT p + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY k),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
             len(list_distinct(words)) AS n_distinct_words, length(regexp_replace(t, '\P{L}+', '', 'g')) AS n_letters,
             length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS n_upper
      FROM w LEFT JOIN covered USING (k)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 100 * n_symbols > 40 * n_words THEN 4 ELSE 0 END)
             + (CASE WHEN n_lines >= 5 AND 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END)
             + (CASE WHEN 10 * word_chars < 20 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)
             + (CASE WHEN n_letters >= 50 AND 100 * n_upper > 70 * n_letters THEN 64 ELSE 0 END)
             + (CASE WHEN 10 * n_letters < 5 * word_chars THEN 128 ELSE 0 END)
             + (CASE WHEN n_words >= 100 AND 100 * n_distinct_words < 8 * n_words THEN 256 ELSE 0 END) AS fail_bits FROM m)
"""


#: The unsigned crc32 of a number's digits, bit by bit.
_CRC32 = "xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
_TRIE = f"""WITH o AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, conv_id - ((conv_id % 100) + 100) % 100 AS base, {_CRC32.format('conv_id')} % 6 AS h FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(b.t[1:h.h], []), h.t[h.h + 1:]) AS t FROM h LEFT JOIN o b ON b.conv_id = h.base),
p AS (SELECT conv_id, d, t[1:d] AS prefix, len(t) = d AS ends FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM r)),
n AS MATERIALIZED (SELECT prefix, d, prefix[1:d - 1] AS above, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends FROM p GROUP BY prefix, d),
c AS MATERIALIZED (SELECT n.*, coalesce(k.k, 0) AS k FROM n LEFT JOIN (SELECT above, count(*) AS k FROM n WHERE d > 0 GROUP BY above) k ON k.above = n.prefix),
s AS (SELECT prefix[1:e] AS prefix, count(*) FILTER (k = 0) AS leaves, sum(CASE WHEN d = 0 THEN 0 ELSE (n - 1) * length(prefix[d].text) END) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM c) GROUP BY 1)
SELECT c.conv_id, c.d AS depth, u.conv_id AS parent_conv_id, c.n AS n_convs, c.k AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, c.ends AS ends_sha256
FROM c JOIN s USING (prefix) LEFT JOIN n u ON c.d > 0 AND u.prefix = c.above"""


def _lloyd(k: int = 8, rounds: int = 10, dimensions: int = 64) -> str:
    """Every round compares all vectors with all centroids."""
    ctes = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS j, v AS c FROM v QUALIFY j < {k})",
    ]
    for i in range(rounds + 1):
        ctes.append(f"d{i} AS (SELECT r, j, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{i})")
        ctes.append(f"a{i} AS MATERIALIZED (SELECT r, min({{'d': d, 'j': j}}) AS b FROM d{i} GROUP BY r)")
        if i < rounds:
            ctes.append(f"s{i} AS (SELECT a.b.j AS j, p, sum(v.v[p]) AS s, count(*) AS n FROM a{i} a JOIN v USING (r), (SELECT unnest(range(1, {dimensions + 1})) AS p) GROUP BY 1, 2)")
            ctes.append(f"c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(x.c, c.c) AS c FROM c{i} c LEFT JOIN (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS c FROM s{i} GROUP BY j) x ON x.j = c.j)")
    return f"""WITH {', '.join(ctes)}
SELECT vec_id, CAST(a.b.j AS INTEGER) AS cluster, CAST(a.b.d AS BIGINT) AS distance, CAST(sum(a.b.d) OVER (PARTITION BY a.b.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c ON c.j = a.b.j"""


ORACLES: dict[str, str] = {
    "op11_conversation_prefix_trie": _TRIE,
    "op13_delta_lloyd": _lloyd(),
    "op2_rule_bitmask_ledger": f"""WITH {_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_distinct_words, n_letters, n_upper,
       CAST(fail_bits AS BIGINT) AS fail_bits, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept
FROM b""",
    "rule_ablations": f"""WITH {_LEDGER},
p(policy, version, mask) AS (VALUES ('base', 1, 3), ('standard', 1, 143), ('standard', 2, 511)),
r(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8), ('short_words', 16), ('long_words', 32), ('upper_case', 64), ('no_letters', 128), ('few_distinct_words', 256))
SELECT policy, version, rule, count(*) FILTER (fail_bits & mask = 0) AS kept, count(*) FILTER (fail_bits & bit <> 0) AS failed,
       count(*) FILTER (fail_bits & mask = bit) AS failed_alone, CAST(coalesce(bit_or(fail_bits & mask) FILTER (fail_bits & bit <> 0), 0) AS BIGINT) AS failed_with
FROM b, p, r WHERE mask & bit <> 0 GROUP BY policy, version, rule""",
}
