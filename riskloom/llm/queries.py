"""Registered queries of the operators, each with its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    byte_bpe,
    exact_dedup,
    importance,
    language_id,
    line_dedup,
    minhash,
    packing,
    quality,
    spelling,
    token_counts,
    topk,
    toxicity,
    url_filter,
)
from riskloom.llm.common import fold, table
from riskloom.llm.url_sql import url_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


@registered(r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    bitmaps = line_dedup.keep_bitmaps(documents, min_docs=10, min_chars=1, keep_first=False)
    return line_dedup.apply_bitmaps(documents, bitmaps, digest=True)


@registered(r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON n.t = g.t
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@registered()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        limit=1024,
    )


@registered()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_and_decode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        digests=True,
    )


#: The rules of the url query.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


@registered(url_sql(URL_RULES))
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES).drop("score")


@registered()
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def judged(scores: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, score, predicted; a null id belongs to no fold."""
    return scores.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@registered()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    def held_out(doc_id):
        return fold(doc_id, 5) == 0

    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    labels = labels.select("doc_id", F.col("toxic").alias("label"))
    return judged(toxicity.toxicity_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), labels), held_out)


@registered()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    def held_out(doc_id):
        return fold(doc_id, 3) == 1

    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    return judged(quality.quality_scores(table(spark, sf_dir, "documents"), labels), held_out)


@registered()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        end_id=1,
    )


@registered("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@registered()
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    known = language_id.identify(documents.select("doc_id", "text"), documents.where(~held_out).select("text", "lang"))
    return known.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@registered()
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(
        table(spark, sf_dir, "documents"), min_chars=6, min_count=5, ratio=5, lost_every=199
    )


@registered()
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, longest=2, buckets=10_000
    )
