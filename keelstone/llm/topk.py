"""Exact top-k by inner product over a pivot-distance index.

Vectors gain one coordinate, so that all have the largest norm M; then the largest inner product with a query q is the least
distance, |q|^2 + M^2 - 2 q.x. Each vector is keyed by its nearest pivot and its distance from it; keys are range-partitioned, so
a partition holds sorted annuli of bounded size. A query is first answered within its own annulus, and then only in annuli which
by the triangle inequality can still hold a better answer.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, tidied

#: Rows of an annulus; queries that are sent to it together, and that meet it at once.
ANNULUS, QUERY_BLOCK, AT_ONCE = 4096, 8192, 512
#: Vectors that serve as pivots: a sample by hash of the id.
PIVOTS = 32


def _quantised(batch_column) -> tuple[list[bytes | None], np.ndarray]:
    """floor(256 x) of each vector as bytes of int64, None for vectors that take no part; and the squared norms."""
    out, norms = [], np.zeros(len(batch_column))
    for k, v in enumerate(batch_column):
        x = None if v.as_py() is None or v.values.null_count else v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if x is None or not np.isfinite(x).all():
            out.append(None)
            continue
        q = np.floor(256 * x)
        norms[k] = float(q @ q)
        out.append(q.astype("<i8").tobytes())
    return out, norms


def _matrix(column, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    out = np.zeros((len(column), width))
    for k, b in enumerate(column.to_pylist()):
        v = np.frombuffer(b, "<i8")
        out[k, : len(v)] = v
    return out


def _best(query_ids, q, ids, x, k: int, exact: bool) -> list[tuple[int, int, int]]:
    """(query, vec_id, score) of the k best of each query, its own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, x, out = ids[order], x[order], []
    for a in range(0, len(query_ids), AT_ONCE):
        some = q[a : a + AT_ONCE]
        score = np.rint(some @ x.T).astype(np.int64) if exact else some.astype(np.int64) @ x.astype(np.int64).T
        for row, own in zip(score, query_ids[a : a + AT_ONCE].tolist(), strict=True):
            keep = np.flatnonzero(ids != own)
            if len(keep) > k:
                s = row[keep]
                keep = keep[s >= np.partition(s, len(s) - k)[len(s) - k]]
            best = keep[np.argsort(-row[keep], kind="stable")][:k]
            out += [(own, int(ids[j]), int(row[j])) for j in best.tolist()]
    return out


def _rows(found) -> pa.Table:
    a, b, c = zip(*found, strict=True) if found else ((), (), ())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col="vec_id", vector_col="embedding", pivots: int = PIVOTS, annulus: int = ANNULUS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest integer inner product of floor(256 x) for each row of `is_query`.

    Ties go to the smaller id. Vectors that are null or hold a null or non-finite component take no part, nor do null ids; a
    shorter vector is filled with zeros. A row is its own query's if it has its id. With fewer than k candidates all are returned.
    Several query rows of one id are one query, whose k best are taken from the pairs of all of them; repeated rows are candidates
    each. An empty table, or one without queries, gives an empty result; other columns are ignored.
    Products are exact while the squared norms stay below 2**53 (doubles), and wrap as 64-bit integers beyond. Nothing is dropped:
    an annulus that the bound doesn't exclude is searched.
    """
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.col(vector_col).alias("v"))

    def quantise(batches):
        for batch in batches:
            q, norms = _quantised(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(q, pa.binary()), pa.array(norms)], ["vec_id", "asks", "q", "norm"])

    all_ = cut_lineage(rows.mapInArrow(tidied(quantise), "vec_id long, asks boolean, q binary, norm double").where("q is not null"))
    size = all_.agg(F.count(F.lit(1)), F.max("norm"), F.max(F.octet_length("q")), F.sum(F.col("asks").cast("long"))).first()
    if not size[0]:
        return all_.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    n, most, width, asking = size[0], float(size[1]), size[2] // 8, size[3] or 0
    exact = most < 2**53
    chosen = all_.select("q", "norm").orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).toArrow()
    p, p_norm = _matrix(chosen.column("q"), width), np.array(chosen.column("norm"))
    p_more = np.sqrt(np.maximum(most - p_norm, 0))
    slack = 1e-6 * max(1.0, most)

    def key(batches):
        for batch in batches:
            x, norm = _matrix(batch.column(2), width), np.array(batch.column(3))
            more = np.sqrt(np.maximum(most - norm, 0))
            d = np.sqrt(np.maximum(norm[:, None] + p_norm - 2 * x @ p.T + (more[:, None] - p_more) ** 2, 0))
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(4)), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], [*batch.schema.names, "pivot", "r"])

    keyed = all_.mapInArrow(tidied(key), "vec_id long, asks boolean, q binary, norm double, pivot int, r double")
    index = cut_lineage(keyed.repartitionByRange(max(1, math.ceil(n / annulus)), "pivot", "r", "vec_id").withColumn("part", F.spark_partition_id() * pivots + F.col("pivot")))

    def own(table: pa.Table) -> pa.Table:
        asks, x, ids = np.array(table.column("asks")), _matrix(table.column("q"), width), np.array(table.column("vec_id"))
        mine = np.flatnonzero(asks)
        return _rows(_best(ids[mine], x[mine], ids, x, k, exact))

    first = cut_lineage(index.groupBy("part").applyInArrow(own, "query_id long, vec_id long, score long"))
    rings = index.groupBy("part", "pivot").agg(F.min("r").alias("low"), F.max("r").alias("high"))
    kth = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    queries = index.where("asks").select(F.col("vec_id").alias("query_id"), "q", F.xxhash64("q").alias("qh"), "norm", F.col("part").alias("own")).join(kth, "query_id", "left")

    def reach(batches):
        for batch in batches:
            x, norm = _matrix(batch.column(1), width), np.array(batch.column(2))
            least = np.array([-np.inf if s is None else float(s) for s in batch.column(5).to_pylist()])
            d = np.sqrt(np.maximum(norm[:, None] + most - 2 * x @ p.T, 0))
            r = np.sqrt(np.maximum(norm + most - 2 * least + slack, 0))[:, None]
            m = len(p)
            take = pa.array(np.repeat(np.arange(batch.num_rows), m))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(3).take(take), batch.column(4).take(take), pa.array(np.tile(np.arange(m, dtype=np.int32), batch.num_rows)), pa.array((d - r - slack).ravel()), pa.array((d + r + slack).ravel())], ["query_id", "qh", "own", "pivot", "least", "most"])

    # equal rows of one id ask once here; each of them gets the answer below
    once = queries.select("query_id", "q", "norm", "qh", "own", "kth").dropDuplicates(["query_id", "qh"])
    wanted = once.mapInArrow(tidied(reach), "query_id long, qh long, own int, pivot int, least double, most double")
    pairs = wanted.join(rings, "pivot").where("high >= least and low <= most and part != own").select("query_id", "qh", "part")
    blocks = max(1, math.ceil(asking / QUERY_BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    left = pairs.join(queries.select("query_id", "qh", "q"), ["query_id", "qh"]).withColumn("block", block)
    met = left.select(F.col("part").alias("met_part"), F.col("block").alias("met_block")).distinct()
    right = index.select("part", "vec_id", "q").join(met, F.col("part") == F.col("met_part")).select("met_part", "met_block", "vec_id", "q")

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return _rows([])
        return _rows(_best(np.array(asked.column("query_id")), _matrix(asked.column("q"), width), np.array(held.column("vec_id")), _matrix(held.column("q"), width), k, exact))

    then = left.groupBy("part", "block").cogroup(right.groupBy("met_part", "met_block")).applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return first.unionByName(then).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
