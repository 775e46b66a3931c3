"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, counts, divergence, language, lines, mixing, neardup, neighbours, ngrams, pages, repeats, topk, turns
from tidemark.llm.common import fold, table

PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counts.count_tokens(documents, public_tokenizers.path(PIECES)).select("doc_id", "n_tokens")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode(documents, public_tokenizers.path(RANKS), offsets=None, decoded="decoded")
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"), width=3, share=85)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold("doc_id", 7)
    done = ngrams.score(table(spark, sf_dir, "documents"), part != 2)
    return done.select("doc_id", (part == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    part = fold("doc_id", 5)
    model = language.fit(documents.where(part != 0))
    found = language.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", (part == 0).alias("held_out"), "lang_pred", "score")


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.audit(table(spark, sf_dir, "conversations"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.remove_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_OPERATORS = (
    op1_token_counts, op2_bpe, op3_mixing, op4_topk, op5_neighbours, op6_neardup, op7_repeats, op8_katz, op9_main_text, op10_language,
    op11_turns, op12_divergence, op13_lines,
)
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _OPERATORS}
SQL: dict[str, str] = {
    "op3_mixing": """
WITH sizes AS (SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source),
rates AS (SELECT source, sqrt(size) / sum(sqrt(size)) OVER () * sum(size) OVER () / size AS rate FROM sizes),
draws AS (SELECT source, CAST(ceil(rate / 32) AS BIGINT) AS draws, rate / ceil(rate / 32) AS mean FROM rates),
sums AS (
  SELECT source, draws, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM draws, range(0, 121) AS t(k)
),
tables AS (SELECT source, any_value(draws) AS draws, list(p) AS p FROM sums GROUP BY source),
drawn AS (
  SELECT d.*, list_sum(list_transform(range(1, t.draws + 1), lambda j: len(list_filter(t.p, lambda x:
    x <= CAST(('0x' || substr(md5(concat_ws(':', '17', d.doc_id, j)), 1, 13)) AS BIGINT) / 4503599627370496.0)))) AS copies
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
),
copied AS (SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, CAST(copies AS BIGINT) + 1)) AS INTEGER) AS copy FROM drawn)
SELECT *, CAST(('0x' || substr(md5(concat_ws(':', '17-order', doc_id, copy)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS shuffle_key
FROM copied
""",
    "op4_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
""",
    "op12_divergence": rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i,
         regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
t AS (SELECT lang, source, i, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
langs AS (
  SELECT lang, coalesce(v, 0) AS v, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang FROM d)
  LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang) USING (lang)
),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(c) AS size FROM cells GROUP BY ALL),
p AS (
  SELECT lang, source, term, coalesce(c, 0) AS c,
         1 + 1000000000::HUGEINT * (coalesce(c, 0) + 1) // (coalesce(size, 0) + v) AS p, 1 + 1000000000::HUGEINT * (total + 1) // (n + v) AS q
  FROM groups JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term) LEFT JOIN sizes USING (lang, source)
),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, 0 AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, (a.p - b.p) * (a.p - b.p) // b.p FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q
),
ranked AS (
  SELECT lang, source, part, item, CAST(sum(value) AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY sum(value) DESC, item) AS INTEGER) AS rank
  FROM f GROUP BY lang, source, part, item
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
""",
    "op13_lines": f"""
WITH l AS (
  SELECT doc_id, generate_subscripts(x, 1) AS i, unnest(x) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)
),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_CAPITALS}', '{_SMALL}') AS key FROM l
),
f AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE top <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE top IS NULL OR top = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
""",
}
