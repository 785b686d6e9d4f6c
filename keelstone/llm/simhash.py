"""SimHash near-duplicates: fingerprints, a grid join on segment bit counts, exact verification and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, as_binary, cut_lineage, row_digest, tidied
from .graph import components

#: Grid points with more fingerprints than this are joined again on the finest grid, where a point has at most 65.
CROWDED = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64 bits, each set if it is set in more than half of the XXH64 hashes of the text's word shingles."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h(joined, seed)
    stops = ends[shingle - 1 :].tolist()
    firsts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    n, ones = len(stops), np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = np.fromiter((h(joined[a:b], seed) for a, b in zip(firsts[k : k + (1 << 16)], stops[k : k + (1 << 16)], strict=True)), np.uint64)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > n)))


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 3) -> DataFrame:
    """Per row: the id and `fp`, the fingerprint as a signed long. Null and empty texts: zero."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in as_binary(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(tidied(run), f"id {kind}, fp long")


def _grid_points(fps: DataFrame, segments: int) -> DataFrame:
    """Each fingerprint at every grid point within Manhattan distance 1 of its vector of bit counts per segment.

    Two vectors within distance 2 share such a point, and the distance of the vectors never exceeds that of the fingerprints.
    """
    width = 64 // segments

    def run(batches):
        place = np.array([pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(segments)], np.uint64)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts = bits.reshape(len(fp), segments, width).sum(axis=2).astype(np.int64)
            base = (counts.astype(np.uint64) * place).sum(axis=1, dtype=np.uint64)
            points, owners = [base], [fp]
            for j in range(segments):
                for step, fits in ((1, counts[:, j] < width), (-1, counts[:, j] > 0)):
                    points.append(base[fits] + np.uint64(step * int(place[j]) % (1 << 64)))
                    owners.append(fp[fits])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(points).view(np.int64)), pa.array(np.concatenate(owners))], ["point", "fp"])

    return fps.select("fp").mapInArrow(tidied(run), "point long, fp long")


def _neighbours(points: DataFrame) -> DataFrame:
    """(point, fp, crowd): the points that several fingerprints share."""
    from pyspark.sql import Window

    return points.withColumn("crowd", F.count(F.lit(1)).over(Window.partitionBy("point"))).where("crowd > 1")


def _pairs(points: DataFrame, distance: int) -> DataFrame:
    """Verified links among the fingerprints that share a point."""
    groups = points.groupBy("point").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
    left = groups.select("fps", F.posexplode("fps").alias("i", "src"))
    near = left.select("src", F.explode(F.filter(F.expr("slice(fps, i + 2, size(fps))"), lambda x: F.bit_count(F.col("src").bitwiseXOR(x)) <= distance)).alias("dst"))
    return near.distinct()


def links(fps: DataFrame, distance: int = 2, segments: int = 16) -> DataFrame:
    """(src, dst) of distinct fingerprints (column fp) so that all within `distance` <= 2 bits are connected.

    Segment bit counts are joined on a grid; candidates are verified on the bits. Where more than CROWDED fingerprints meet at a
    grid point, they are put on the grid of one-bit segments instead: there Manhattan and Hamming distance are the same, at most
    65 fingerprints meet at a point, and all of them are within 2 bits of each other, so one link each to the smallest suffices.
    """
    assert 0 <= distance <= 2
    met = cut_lineage(_neighbours(_grid_points(fps, segments)))
    found = _pairs(met.where(F.col("crowd") <= CROWDED), distance)
    crowded = met.where(F.col("crowd") > CROWDED).select("fp").distinct()
    finest = _grid_points(crowded, 64)
    if distance == 2:
        least = finest.groupBy("point").agg(F.min("fp").alias("src"), F.max("fp").alias("m")).where("src < m").select("point", "src")
        close = finest.join(least, "point").where("src < fp").select("src", F.col("fp").alias("dst")).distinct()
    else:
        close = _pairs(_neighbours(finest), distance)
    return found.unionByName(close)


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 3, distance: int = 2, segments: int = 16) -> DataFrame:
    """Per row of `docs`: the id, `fp` and `component_id`, the smallest id reachable over links of at most `distance` bits.

    Rows of equal fingerprint are one node, however many they are. Null and empty texts have fingerprint zero and link like any
    other. A null id is reported but never a component's smallest, unless all its members' ids are null. Repeated rows are each
    reported. An empty table gives an empty result; other columns are ignored.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")))
    root = components(links(nodes, distance, segments), "fp")  # (fp, root) of the linked ones
    joined = nodes.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = cut_lineage(joined.join(best, "root").select("fp", "component_id", "n"))
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = classes.where(F.col("n") >= max(64, total // 256))  # at most 256 of them
    big = F.broadcast(hot.select("fp", F.col("component_id").alias("hot_id"), F.lit(True).alias("is_hot")))
    marked = rows.join(big, "fp", "left")
    calm = marked.where("is_hot is null").select("id", "fp").join(classes.select("fp", "component_id"), "fp")
    out = marked.where("is_hot").select("id", "fp", F.col("hot_id").alias("component_id")).unionByName(calm.select("id", "fp", "component_id"))
    return out.select(F.col("id").alias(id_col), "fp", "component_id")


#: Rows to drop whose keys are broadcast, at most (24 bytes each); more are joined by a shuffle.
SENT_ROWS = 1_000_000


def one_of_each(docs: DataFrame, distance: int = 2) -> DataFrame:
    """One row of each component: the one of the smallest id, a null id last, and among equal ids that of the smallest digest.

    So documents without an id stay, one for each component that has no id at all; rows of one id are told apart by a digest of
    the whole row (128 bits over all columns). Rows that agree in every column are one. Null and empty texts are one component.
    An empty table gives an empty result; columns of any name are kept as they are.

    What is decided on are ids, digests and fingerprints; texts are read once for these and once more to be written. The keys of
    the rows that go are broadcast if there are at most SENT_ROWS of them, else joined.
    """
    h1, h2 = row_digest(docs)
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), h1.alias("h1"), h2.alias("h2")).alias("row"), F.col("text").alias("text"))
    classes = cut_lineage(near_duplicates(named, id_col="row", distance=distance).withColumn("stays", (F.col("row.h1") == F.col("component_id.h1")) & (F.col("row.h2") == F.col("component_id.h2"))))
    gone = classes.where("not stays").select("row.h1", "row.h2").distinct()
    again = classes.where("stays").groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row.h1", "row.h2")
    marked = cut_lineage(gone.withColumn("repeated", F.lit(False)).unionByName(again.withColumn("repeated", F.lit(True))).toDF("__h1", "__h2", "__repeated"))
    few = marked.count() <= SENT_ROWS
    met = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), h1.alias("__h1"), h2.alias("__h2")).join(F.broadcast(marked) if few else marked, ["__h1", "__h2"], "left")
    first = met.where("__repeated").dropDuplicates(["__h1", "__h2"])
    return met.where("__repeated is null").unionByName(first).select("__row.*")
