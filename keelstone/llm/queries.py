"""The subpackage's queries over the tables of a folder, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import bpe, chat, decontam, langid, quality, sharding, simhash, suffix_dedup, topk, toxicity

RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id")))
    return toxicity.score(docs, field).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", "spans")


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out("doc_id", 4, 2)))
    return langid.identify(docs, model).select("doc_id", langid.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op4_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_decontamination(spark, sf_dir):
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op8_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_quality(spark, sf_dir):
    return quality.score_quality(table(spark, sf_dir, "documents"))


def op10_chat(spark, sf_dir):
    made = chat.format_chats(table(spark, sf_dir, "conversations"))
    return made.select("conv_id", "part", "n_rows", "n_turns", "cost", "merged", "relabelled", "inserted", F.sha2("rendered", 256).alias("rendered_sha256"), F.length("rendered").cast("long").alias("n_chars"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(ship(spark), sf_dir)


def queries() -> dict:
    own = (op1_suffix_dedup, op2_toxicity, op3_language_id, op4_sharding, op5_topk, op6_decontamination, op7_bpe, op8_simhash, op9_quality, op10_chat, pipeline)
    return {f.__name__: f for f in own}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP6 = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM g), win AS (
  SELECT rid, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT rid, i, n, item_id FROM win JOIN g USING (n, gram)
), words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hit)) GROUP BY rid
), items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_topk": OP5, "op6_decontamination": OP6}
