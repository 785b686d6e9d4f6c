"""From raw documents to token ids: the stages of the training-data pipeline, each over all that the one before has kept."""

from __future__ import annotations

import atexit
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keelstone.llm import bpe, decontam, langid, simhash, suffix_dedup
from keelstone.llm.common import ensure_checkpoint_dir, remove, shared_folder
from keelstone.session import ship


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't recognised go, null and letterless texts among them; `lang` becomes the recognised one."""
    return langid.keep_identified(_on(spark, docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays; without an id, that of the smallest digest. Null and empty texts are one group."""
    return simhash.one_of_each(_on(spark, docs))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that repeat anywhere are taken out; every row stays, be its text empty or null."""
    return suffix_dedup.without_repeats(_on(spark, docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark words are taken out; every row stays, be its text empty or null."""
    return decontam.decontaminate(_on(spark, docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, digests of ids and of what they decode to, and the ids; null and empty texts have none, repeated rows a row each."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(_on(spark, docs), path, public_tokenizers.PATTERN, carry=tuple(c for c in ("lang", "source") if c in docs.columns), with_ids=True)


def _on(spark: SparkSession, docs: DataFrame) -> DataFrame:
    ship(spark)
    return docs


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("benchmark", benchmark), ("tokens", tokens)]
#: SQL can't express centroids, SimHash components over XXH64, suffixes and BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each one's rows are written to the shared folder and read from there. What a stage has read goes when its own rows are written, the last folder when the driver ends."""
    ensure_checkpoint_dir(spark)
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    atexit.register(remove, spark, folder)
    return STAGES[-1][1](spark, docs, sf_dir)
