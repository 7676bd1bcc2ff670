"""Registered queries of this package and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trasvase.llm import (
    alignment, lexical, mixing, ngram_join, packing, quality_classifier, quality_rules, shuffling, substring_dedup, topk, toxicity, url_filter, wavelet,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"), quality_rules.trusted_sample(table(spark, folder, "labels")))


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_filter(table(spark, folder, "pages"))


def op3_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet.token_shards(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), "vec_id % 50 = 0", 5)


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, folder, "documents")).drop("spans")


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents")).select("doc_id", F.col("_mix.*"))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, folder, "documents"))


def op10_ngram_join_links(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_links(table(spark, folder, "documents")).drop("class_id")


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_uniform_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shuffling.shard_rows(spark, f"{folder}/documents.parquet")


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_url_filter,
        op3_token_shards,
        op4_toxicity,
        op5_packing,
        op6_exact_topk,
        op7_substring_dedup,
        op8_quality_classifier,
        op9_source_mix,
        op10_ngram_join,
        op10_ngram_join_links,
        op11_lexical_search,
        op12_uniform_shards,
        op13_token_alignment,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"


def _weight(names: dict[str, int], other: int, column: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {w}" for name, w in names.items())
    return f"CASE {column} {cases} ELSE {other} END" if names else str(other)


def _shares(nodes: str, above: str, name: str) -> str:
    """Budgets of siblings by filling up the smallest limits first."""
    parent = f"PARTITION BY {above} " if above else ""
    return f"""(
        SELECT *, CASE WHEN is_full THEN cap ELSE ((given - taken) * weight) // nullif(weights, 0) END AS budget
        FROM (
            SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({parent}) AS taken,
                      sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({parent}) AS weights
            FROM (
                SELECT *, cap * sum(weight) OVER ({parent}ORDER BY cap / greatest(weight, 1), {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                       <= (given - coalesce(sum(cap) OVER ({parent}ORDER BY cap / greatest(weight, 1), {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS is_full
                FROM {nodes})))"""


def _mix_sql(mix: mixing.Mix) -> str:
    up, down = mix.part
    return f"""
WITH held AS (
    SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS t,
           coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
           ['web', 'news', 'books', 'code'][1 + coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER), 0) % 4] AS domain
    FROM documents),
leaves AS (
    SELECT *, CASE WHEN least(wd, wl, ws) > 0 THEN tokens * {mix.max_epochs} ELSE 0 END AS cap
    FROM (SELECT domain, lang, source, sum(t)::BIGINT AS tokens, {_weight(mix.domain, mix.other, "domain")} AS wd,
                 {_weight(mix.lang, mix.other, "lang")} AS wl, {_weight(mix.source, mix.other, "source")} AS ws
          FROM held GROUP BY ALL)),
domains AS (SELECT domain, sum(cap) AS cap, max(wd) AS weight,
                   (SELECT least(sum(cap), sum(tokens) * {up} // {down}) FROM leaves) AS given FROM leaves GROUP BY domain),
domain_budget AS (SELECT domain, budget FROM {_shares("domains", "", "domain")}),
langs AS (SELECT l.domain, l.lang, sum(l.cap) AS cap, max(wl) AS weight, any_value(b.budget) AS given
          FROM leaves l JOIN domain_budget b ON l.domain = b.domain GROUP BY l.domain, l.lang),
lang_budget AS (SELECT domain, lang, budget FROM {_shares("langs", "domain", "lang")}),
sources AS (SELECT l.domain, l.lang, l.source, l.tokens, l.cap, l.ws AS weight, b.budget AS given
            FROM leaves l JOIN lang_budget b ON l.domain = b.domain AND l.lang = b.lang),
plan AS (SELECT domain, lang, source, coalesce(coalesce(budget, 0) // nullif(tokens, 0), 0) AS epochs,
                coalesce(coalesce(budget, 0) % nullif(tokens, 0), 0) AS rest
         FROM {_shares("sources", "domain, lang", "source")}),
keyed AS (SELECT h.*, p.epochs, p.rest, md5('{mix.seed}:' || p.epochs::BIGINT || ':' || h.doc_id) AS key
          FROM held h JOIN plan p ON h.domain = p.domain AND h.lang = p.lang AND h.source = p.source),
placed AS (SELECT *, sum(t) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, t::BIGINT AS n_tokens, e::INTEGER AS epoch
FROM (SELECT *, unnest(range((epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT)) AS e FROM placed)"""


ORACLES: dict[str, str] = {
    "op6_exact_topk": """
WITH held AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM held q JOIN held c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5""",
    "op7_substring_dedup": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20),
places AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) AS nth FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM places WHERE nth > 1),
each AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS text, count(*) AS n FROM each e
         ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id""",
    "op9_source_mix": _mix_sql(mixing.PRODUCTION),
    "op10_ngram_join": f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN ways l ON r.other = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.low AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id""",
}

ORACLES["op10_ngram_join_links"] = f"""
{ORACLES["op10_ngram_join"].rpartition("SELECT d.doc_id")[0]}
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.low AS component_id, coalesce(w.n_links, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, count(*) AS n_links FROM ways GROUP BY a) w ON w.a = d.doc_id
JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id"""

ORACLES["op11_lexical_search"] = r"""
WITH words AS (
    SELECT row_number() OVER () AS d, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
    FROM documents),
held AS (SELECT d, doc_id, len(ws) AS n, ws FROM words WHERE len(ws) > 0),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM held),
asked AS (
    SELECT i, item_id, term, count(*) AS times
    FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM benchmark)
    GROUP BY i, item_id, term),
found AS (SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, n, unnest(ws) AS term FROM held) GROUP BY d, doc_id, n, term),
rare AS (SELECT term, count(*) AS df FROM found GROUP BY term),
impacts AS (
    SELECT d, doc_id, term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS impact
    FROM found JOIN rare USING (term), corpus WHERE term IN (SELECT term FROM asked)),
scored AS (SELECT i, item_id, d, doc_id, sum(impact * times)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY i, item_id, d, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20"""
