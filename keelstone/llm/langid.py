"""Language identification by the nearest of several clustered centroids per language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import as_binary, blocks, id_crc32, numbered, raw, tidied

#: Buckets of hashed character n-grams.
WIDTH = 1 << 13
#: Labelled documents per language that the centroids are fitted on, about.
SAMPLE = 400
CLUSTERS = 4
#: Bytes of a text whose n-grams are counted at once.
PIECE = 1 << 20


def counts_of(texts: pa.Array) -> np.ndarray:
    """Hashed counts of byte 2-, 3- and 4-grams of lower-cased texts, digits and ASCII punctuation read as spaces; a row each."""
    import pyarrow.compute as pc

    data, starts = raw(as_binary(pc.utf8_lower(texts)))
    out = np.zeros((len(texts), WIDTH), np.float32)
    if not len(data):
        return out
    x = np.arange(256, dtype=np.uint32)
    letters = ((x >= 97) & (x <= 122)) | (x >= 128)
    b = np.where(letters, x, 32)[data]
    for k in range(len(texts)):
        for a in range(int(starts[k]), int(starts[k + 1]), PIECE):
            out[k] += _grams(b[a : min(a + PIECE + 3, starts[k + 1])], PIECE)
    return out


def _grams(d: np.ndarray, most: int) -> np.ndarray:
    """Hashed counts of the 2-, 3- and 4-grams that begin in the first `most` bytes."""
    codes = []
    for n in (2, 3, 4):
        m = min(len(d) - n + 1, most)
        if m > 0:
            c = d[:m].copy()
            for j in range(1, n):
                c *= np.uint32(0x01000193)
                c += d[j : m + j]
            codes.append((c * np.uint32(0x9E3779B1)) >> np.uint32(19))
    return np.bincount(np.concatenate(codes), minlength=WIDTH) if codes else np.zeros(WIDTH, np.int64)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows; a row without n-grams stays zero."""
    v = np.log1p(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


class Centroids:
    def __init__(self, names: list[str], centres: np.ndarray, owner: np.ndarray, idf: np.ndarray, reach: np.ndarray):
        self.names, self.centres, self.owner, self.idf, self.reach = names, centres, owner, idf, reach

    def nearest(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and whether it lies beyond the language's reach."""
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = weighted(counts_of(texts), self.idf) @ self.centres.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0, 1)
        owner = self.owner[best]
        sizes = np.diff(raw(as_binary(texts))[1])
        return [self.names[k] for k in owner], score, score <= self.reach[owner, np.searchsorted(CUTS, sizes, "right")]


def spherical_clusters(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centres; the first is the densest direction, each next the row farthest from those chosen."""
    k = min(k, len(v))
    centres = v[[int((v @ v.mean(axis=0)).argmax())]]
    while len(centres) < k:
        centres = np.vstack([centres, v[int((v @ centres.T).max(axis=1).argmin())]])
    for _ in range(rounds):
        near = (v @ centres.T).argmax(axis=1)
        sums = np.vstack([v[near == c].sum(axis=0) if (near == c).any() else centres[c] for c in range(k)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


#: A document is rejected where its cosine isn't above a limit of its language and length in bytes. Cosines grow with the length,
#: so a limit is REACH of the lowest twentieth of the cosines of training texts cut to the length's lower bound in CUTS, at most
#: WHOLE of the lowest hundredth of those of whole training texts. Below the first bound only a cosine of zero is rejected.
REACH, WHOLE = 0.6, 0.9
CUTS = (8, 16, 32, 64, 128, 256, 512)


def limits(heads: list[bytes], centres: np.ndarray, idf: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The limit of a language for each length: below CUTS[0], and from each of CUTS on."""
    most, out = WHOLE * float(np.quantile(whole, 0.01)), [0.0]
    for cut in CUTS:
        texts = [h[:cut].decode(errors="ignore") for h in heads if len(h) >= cut]
        low = REACH * float(np.quantile((weighted(counts_of(pa.array(texts)), idf) @ centres.T).max(axis=1), 0.05)) if texts else out[-1]
        out.append(min(low, most))
    return np.array(out)


def fit(labelled: DataFrame, text_col="text", lang_col="lang", sample: int = SAMPLE, clusters: int = CLUSTERS) -> Centroids:
    """Document frequencies are counted over all of `labelled`; centroids are fitted on about `sample` distinct texts per language.

    The sample is chosen by a hash of the text and read whole; of copies one is taken, so their number doesn't matter. Null texts
    and null languages are left out; without any labelled document every text is answered `und`. Languages are few: their names,
    sizes and samples come to the driver.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("kinds")).collect()
    sizes, kinds = {r.lang: r.n for r in found}, {r.lang: r.kinds for r in found}
    names = sorted(sizes)

    def frequencies(batches):
        seen = np.zeros(WIDTH, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a in range(0, len(texts), 256):
                seen += (counts_of(texts.slice(a, 256)) > 0).sum(axis=0)
        hit = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(seen[hit])], ["k", "n"])

    df = np.zeros(WIDTH)
    for r in rows.select("text").mapInArrow(tidied(frequencies), "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        df[r.k] = r.n
    total = sum(sizes.values())
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    part = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, sample / max(1, kinds[n]))))]) if names else F.lit(None)
    chosen = rows.where((F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(1 << 20)) / float(1 << 20)) < part[F.col("lang")]) if names else rows

    def vectors(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                c = counts_of(batch.column(1).slice(a, 256)).astype(np.float16)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 256), pa.array([row.tobytes() for row in c], pa.binary()), pa.array([(t or "")[: CUTS[-1]].encode()[: CUTS[-1]] for t in batch.column(1).slice(a, 256).to_pylist()], pa.binary())], ["lang", "v", "head"])

    by: dict[str, list[tuple[bytes, bytes]]] = {n: [] for n in names}
    for r in chosen.distinct().mapInArrow(tidied(vectors), "lang string, v binary, head binary").toLocalIterator():
        by[r.lang].append((bytes(r.v), bytes(r.head)))
    centres, owner, reach = [], [], []
    for k, n in enumerate(names):
        rows_n = sorted(by[n]) or [(np.zeros(WIDTH, np.float16).tobytes(), b"")]
        v = weighted(np.minimum(np.frombuffer(b"".join(r[0] for r in rows_n), np.float16).reshape(-1, WIDTH).astype(np.float32), 6e4), idf)
        c = spherical_clusters(v, clusters)
        centres.append(c)
        owner += [k] * len(c)
        reach.append(limits([r[1] for r in rows_n], c, idf, (v @ c.T).max(axis=1)))
    return Centroids(names, np.vstack(centres) if centres else np.zeros((0, WIDTH), np.float32), np.array(owner, np.int64), idf, np.array(reach))


def _answers(shared, at: int):
    """For each batch its slices of bounded size, whose column `at` holds texts and the next one whether they have a letter, with (languages, scores, rejected)."""

    def of(batch):
        starts = raw(batch.column(at))[1]
        for a, b in ((i, min(i + 256, y)) for x, y in blocks(starts, 16 << 20) for i in range(x, y, 256)):
            part = batch.slice(a, b - a)
            names, score, far = shared.value.nearest(part.column(at).fill_null(""))
            some = np.array(part.column(at + 1).to_pylist(), bool)
            yield part, [n if s else "und" for n, s in zip(names, some, strict=True)], np.where(some, score, 0.0), ~some | far

    return of


def _letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Centroids, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: the id, lang_pred, score (cosine to the nearest centroid), rejected (no letter, or beyond the language's reach).

    `und` with score 0 where the text is null or has no letter. Repeated rows are each reported; an empty table gives an empty
    result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH floats a centroid
    rows = numbered([F.col(id_col), F.col(text_col), _letters(F.col(text_col))], docs)
    answers = _answers(shared, 1)

    def run(batches):
        for batch in batches:
            for part, names, score, far in answers(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(far)], ["c0", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(tidied(run), f"c0 {rows.schema[0].dataType.simpleString()}, lang_pred string, score double, rejected boolean").withColumnRenamed("c0", id_col)


def held_out(id_col: str, folds: int, fold: int):
    return F.pmod(id_crc32(id_col), F.lit(folds)) == fold


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is recognised, their `lang` set to it; all other columns, of any name, as they are.

    The centroids learn from the rows that aren't held out. Rows of null or letterless text go, and with no labelled row all do;
    repeated rows each stay or go. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~held_out("doc_id", 4, 2))))
    text, lang = docs.columns.index("text"), docs.columns.index("lang")
    others = [k for k in range(len(docs.columns)) if k not in (text, lang)]
    rows = numbered([*[F.col(f"`{docs.columns[k]}`") for k in others], F.col("text"), _letters(F.col("text"))], docs)
    answers = _answers(shared, len(others))
    schema = StructType([*rows.schema[: len(others) + 1], StructField("lang", StringType())])

    def run(batches):
        for batch in batches:
            for part, names, _, far in answers(batch):
                kept = pa.array(np.flatnonzero(~far))
                yield pa.RecordBatch.from_arrays([*(part.column(k).take(kept) for k in range(len(others) + 1)), pa.array(names, pa.string()).take(kept)], schema.names)

    place = {**{k: f"c{j}" for j, k in enumerate(others)}, text: f"c{len(others)}", lang: "lang"}
    return rows.mapInArrow(tidied(run), schema).select(*[F.col(place[k]).alias(c) for k, c in enumerate(docs.columns)])
