"""Queries of this subpackage, each over the whole table it is meant for, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deq.llm import (
    divergence, fingerprints, jaccard, lexical, lines, neighbours, packing, personal, quality, sampling, sharding, substrings, toxicity,
)
from deq.llm.common import documents


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_gumbel_segmentations(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sampled_segmentations(documents(spark, folder), tokenizer_path("piece_bpe_32k.model"), k=2, with_ids=True)


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, folder), 4, 85)


def op3_quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_table(documents(spark, folder))


def op4_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal.personal_table(documents(spark, folder))


def op5_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.ring_shards(documents(spark, folder), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "moved"
    )


def op6_seed_and_extend(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(documents(spark, folder), 35).drop("kept_text")


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(documents(spark, folder), tokenizer_path("word_bpe_49k.json"), 2048)
    return packing.best_fit_pack(pieces, 2048)


def op8_scaled_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_table(documents(spark, folder))


def op9_pu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.toxicity(documents(spark, folder), labels)


def op10_deletion_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_table(documents(spark, folder))


def op11_automaton_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), 20)


def op12_skyband_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, folder), 30, 50)


def op13_neighbour_packing(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.neighbour_pack(documents(spark, folder), tokenizer_path("byte_bpe_50k.json"), 1024)


QUERIES = {
    "op1_gumbel_segmentations": op1_gumbel_segmentations,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_quality_cascade": op3_quality_cascade,
    "op4_bootstrapped_pii": op4_bootstrapped_pii,
    "op5_ring_shards": op5_ring_shards,
    "op6_seed_and_extend": op6_seed_and_extend,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_scaled_sketch": op8_scaled_sketch,
    "op9_pu_toxicity": op9_pu_toxicity,
    "op10_deletion_lines": op10_deletion_lines,
    "op11_automaton_search": op11_automaton_search,
    "op12_skyband_divergence": op12_skyband_divergence,
    "op13_neighbour_packing": op13_neighbour_packing,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(kept: str) -> str:
    """All terms of a text, where ``kept`` excludes the other characters."""
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^{kept}]+')"


_WORDS = """
SELECT doc_id, coalesce(text, '') AS text,
       CASE WHEN trim(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN []
            ELSE string_split_regex(trim(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    '[\\x20\\x09-\\x0D]+') END AS w
FROM documents"""

ORACLES: dict[str, str] = {
    "op3_quality_cascade": f"""
WITH d AS (SELECT row_number() OVER () AS r, * FROM ({_WORDS})),
p AS (SELECT r, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] || chr(10) || w[i + 3] || chr(10) || w[i + 4] AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM p) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, i + unnest([0, 1, 2, 3, 4]) AS j FROM twice) GROUP BY r),
lines AS (SELECT r, x FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM d)
          WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM lines GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(text, '[^!]', '', 'g')) AS marks,
             length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
             length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits,
             len(string_split(text, chr(10))) AS n_lines,
             len([i FOR i IN range(2, len(w) + 1) IF w[i] = w[i - 1]]) AS n_same
      FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * marks > n_words OR 2 * capitals > word_chars
            OR 2 * digits > word_chars OR 10 * n_dup_lines > 3 * n_lines
            OR word_chars > 10 * n_words OR word_chars < 3 * n_words OR 5 * n_same > n_words) AS kept
FROM f""",    "op11_automaton_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms("\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F")} AS t FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, {_terms("\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F")} AS t FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
f AS (SELECT r, doc_id, n, term, count(*) AS tf
      FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
s AS (SELECT count(*) AS nd, CAST(sum(len(t)) AS BIGINT) AS nt FROM d WHERE len(t) > 0),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM f, s GROUP BY term, nd),
v AS (SELECT i, item_id, r, doc_id,
             CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt)))) AS BIGINT) AS score
      FROM f JOIN q USING (term) JOIN w USING (term), s GROUP BY ALL),
o AS (SELECT item_id, doc_id, score,
             CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
      FROM v WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20""",
    "op12_skyband_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  {_terms("\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F")} AS t FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
u AS (SELECT r, lang, source, unnest(t) AS term FROM d),
l AS (SELECT lang, term, count(*) AS c FROM u GROUP BY ALL HAVING count(DISTINCT r) >= 30),
n AS (SELECT lang, source, term, count(*) AS c FROM u SEMI JOIN l USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM l GROUP BY lang),
m AS (SELECT g.lang, g.source, coalesce(sum(n.c), 0) AS n FROM g LEFT JOIN n USING (lang, source) GROUP BY ALL),
p AS (SELECT m.lang, m.source, l.term, coalesce(n.c, 0) AS c,
             1 + (1000000000::HUGEINT * (coalesce(n.c, 0) + 5)) // (m.n + 5 * v.v) AS p,
             1 + (1000000000::HUGEINT * (l.c + 5)) // (v.n + 5 * v.v) AS q
      FROM m JOIN l USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = m.lang AND n.source = m.source AND n.term = l.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.f, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE c > 0 AND p > q),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM y)
SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= 50""",
}
