"""Each stage of the pipeline judged on its own input."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from keelstone.llm import bpe, decontam, suffix_dedup
from test_llm_operators import classes_by_force, fingerprint_by_force, repeats_by_force

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    own = spark.read.parquet(f"{DIR}/documents.parquet")
    odd = [(90001, None, "en", None, 0), (90002, "", None, "x", 0), (90003, "short text of few words", "en", "x", 23), (90003, "short text of few words", "en", "x", 23), (90004, "é" * 400, "fr", "x", 400)]
    docs, out = own.unionByName(spark.createDataFrame(odd, own.schema)), []
    for name in ("score", "rejected", "lang_pred", "n_removed", "n_hit", "contaminated", "cleaned", "fp", "component_id", "row", "c0", "__row", "a b"):  # as the operators call theirs
        docs = docs.withColumn(name, F.when(F.col("doc_id") % 2 == 0, F.lit("clash")))
    folder = tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, DIR)
        made.write.parquet(f"{folder}/{k}")
        made = spark.read.parquet(f"{folder}/{k}")
        out.append((docs, made))
        docs = made
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    for was, now in stages[:-1]:
        assert now.dtypes == was.dtypes
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"} <= set(stages[-1][1].columns)


def test_language_keeps_clean_documents(stages):
    was, now = stages[0]
    gone = was.join(now, "doc_id", "left_anti")
    assert {90001, 90002} <= {r.doc_id for r in gone.collect()}
    assert gone.where("length(text) > 100").count() <= 0.01 * was.count()
    assert texts(now).items() <= texts(was).items()


def test_one_document_of_each_group_stays(stages):
    was, now = (texts(x) for x in stages[1])
    ids = sorted(was)
    classes = classes_by_force([fingerprint_by_force(was[i]) for i in ids])
    assert now == {i: was[i] for i in {ids[c] for c in classes}}


def test_repeated_strings_go(stages):
    was, now = (texts(x) for x in stages[2])
    force = dict(zip(was, repeats_by_force(was.values(), 200)))
    assert now.keys() == was.keys()
    for i, (_, removed, _, sha) in force.items():
        if not removed:
            assert now[i] == was[i]
        elif hashlib.sha256(now[i].encode()).hexdigest() != sha:  # what is left of a cut character goes, too
            assert len(now[i].encode()) < len(was[i].encode()) - removed + 8


def test_benchmark_passages_go(spark, stages):
    was, now = stages[3]
    items = spark.read.parquet(f"{DIR}/benchmark.parquet")
    hit = {r.doc_id for r in decontam.contamination(was, items).where("contaminated").collect()}
    was, now = texts(was), texts(now)
    assert now.keys() == was.keys() and {i for i in was if was[i] != now[i]} == hit


def test_tokens(stages):
    was, now = stages[4]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    was = texts(was)
    rows = now.collect()
    assert len(rows) == len(was)
    for r in rows:
        ids = enc.encode_ordinary(was[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_columns_of_other_names_are_kept(stages):
    for was, now in stages[:-1]:
        assert {r.doc_id: r.rejected for r in now.collect()}.items() <= {r.doc_id: r.rejected for r in was.collect()}.items()


def test_empty_tables_and_null_rows_pass_all_stages(spark):
    own = spark.read.parquet(f"{DIR}/documents.parquet")
    for docs in (own.limit(0), own.limit(40).unionByName(spark.createDataFrame([(None, None, None, None, None)] * 2, own.schema))):
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, DIR)
            assert made.count() <= docs.count()
            if "text" in made.columns:
                docs = made


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, DIR).where(F.col("n_tokens") > 0).count() > 0
    assert suffix_dedup.GRAM < 200
