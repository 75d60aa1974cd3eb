"""One query for each operator of the package, over whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe, conversations, decontaminate, jaccard, language_model, mixing, negatives, quality, sharding, substring, token_counts, topk, toxicity,
)
from .labelled import fold
from .sql import CONVERSATIONS, MIXING, NEGATIVES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors for every 50th vector."""
    found = topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes they decode to, as digests."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 13-word runs that an earlier document has."""
    found = substring.dedupe(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labels."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.score(docs, model).withColumnRenamed("id", "doc_id").select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("sentences").alias("n_offending"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text."""
    counted = token_counts.count(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from three quarters of the labels."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return quality.score(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document under links of similar four-word shingle sets."""
    found = jaccard.join(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document words that also stand in a benchmark window of ten words."""
    found = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text, learned from nine tenths of them."""
    scored = language_model.score(_table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)
    return scored.select(
        F.col("id").alias("doc_id"), F.coalesce(fold("id", 10) == 0, F.lit(True)).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score")


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes, equal texts together."""
    placed = sharding.assign(_table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and the cheapest edits that mend it."""
    given = _table(spark, sf_dir, "conversations")
    report, rows = conversations.repair(conversations.damaged(given), given.select(F.col("conv_id").alias("id")))
    digest = conversations.digests(rows).withColumnRenamed("id", "of")
    return report.join(digest, F.col("id").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every 100th vector and its 5 best of the same label: the 10 best of other labels that score 30 to 90 % of it."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document are in a mix of 1.5 times all words, sources weighing 5, 2, 1."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES = {f.__name__: f for f in (op1_top_k, op2_byte_bpe, op3_substring_dedup, op4_toxicity, op5_token_counts, op6_quality, op7_jaccard_join, op8_decontamination, op9_language_model, op10_shards,
                                 op11_conversations, op12_hard_negatives, op13_source_mix)}

SQL = {
    "op11_conversations": CONVERSATIONS,
    "op12_hard_negatives": NEGATIVES,
    "op13_source_mix": MIXING,
    "op1_top_k": """
WITH kept AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM kept q JOIN kept c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM scored
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
""",
    "op8_decontamination": r"""
WITH lowered AS (
    SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), docs AS (
    SELECT doc_id, r, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), sized AS (
    SELECT item_id, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0
), wanted AS (
    SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM sized)
), placed AS (
    SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS phrase
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)
), found AS (
    SELECT r, n, p, item_id FROM placed JOIN wanted USING (n, phrase)
), hit AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM found) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""",
}
