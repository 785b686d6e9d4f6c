"""Text quality from weak labels: overlapping heuristics weighed by expectation-maximisation train a hashed linear scorer."""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_binary, tidied

#: Buckets of hashed features; documents that the scorer is trained on, about.
WIDTH, SAMPLE = 1 << 12, 3_000
#: What each labeller measures, below which value it votes good and above which bad (between: it abstains).
LABELLERS = (
    ("repeated_words", 0.02, 0.08),  # words equal to the one before
    ("upper_case", 0.2, 0.5),  # capitals among ASCII letters
    ("symbols", 0.02, 0.06),  # ASCII other than letters, digits, spaces, .,;:'"-()?
    ("digits", 0.1, 0.3),
    ("few_words", 0.01, 0.05),  # one by the number of words
    ("odd_word_length", 3.0, 5.0),  # distance of the mean from six bytes
    ("unended_lines", 0.5, 0.9),  # lines that end without . ! or ?
    ("bars", 0.001, 0.03),  # | among words
    ("not_letters", 0.12, 0.2),  # share of the bytes within words that belong to no letter
    ("squeezed", 0.7, 0.8),  # what compression saves of texts of some length
)
GOOD, BAD, NONE = 1, 0, 2


_press = zstandard.ZstdCompressor(level=1)


def measures(text: bytes) -> tuple[list[float], np.ndarray]:
    words = text.split()
    same = np.fromiter(map(eq, words, words[1:]), np.int8, max(0, len(words) - 1))
    saved = 1 - len(_press.compress(text)) / len(text) if len(text) >= 256 else 0.0
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    total, upper, lower, digit = max(1, len(text)), int(n[65:91].sum()), int(n[97:123].sum()), int(n[48:58].sum())
    plain = int(n[[9, 10, 13, 32, 46, 44, 59, 58, 39, 34, 45, 40, 41, 63]].sum())
    lines = [s for s in (line.rstrip() for line in text.split(b"\n")) if s]
    unended = sum(not s.endswith((b".", b"!", b"?")) for s in lines) / max(1, len(lines))
    count = max(1, len(words))
    out = [int(same.sum()) / count, upper / max(1, upper + lower), (int(n[:128].sum()) - plain - upper - lower - digit) / total, digit / total, 1 / count, abs((total - int(n[[9, 10, 13, 32]].sum())) / count - 6), unended, int(n[124]) / count, 1 - (upper + lower + int(n[128:].sum())) / max(1, total - int(n[[9, 10, 13, 32]].sum())), saved]
    return out, n


def votes(values: list[float]) -> int:
    """The labellers' votes as digits of a number to base 3."""
    return sum((GOOD if v < low else BAD if v > high else NONE) * 3**k for k, (v, (_, low, high)) in enumerate(zip(values, LABELLERS, strict=True)))


def hashed(text: bytes, byte_counts: np.ndarray, values: list[float]) -> np.ndarray:
    """Features: hashed byte 2- and 3-grams with case, byte frequencies, and the measures."""
    d = np.frombuffer(text, np.uint8).astype(np.uint32)
    v = np.zeros(WIDTH + 256 + len(values), np.float32)
    codes = [((d[:-1] * np.uint32(0x01000193) + d[1:]) * np.uint32(0x9E3779B1)) >> np.uint32(20)] if len(d) > 1 else []
    codes += [(((d[:-2] * np.uint32(0x01000193) + d[1:-1]) * np.uint32(0x01000193) + d[2:]) * np.uint32(0x85EBCA6B)) >> np.uint32(20)] if len(d) > 2 else []
    if codes:
        v[:WIDTH] = np.bincount(np.concatenate(codes), minlength=WIDTH)
    v[WIDTH : WIDTH + 256] = byte_counts
    v[: WIDTH + 256] = np.sqrt(v[: WIDTH + 256] / max(1, len(d)))
    v[WIDTH + 256 :] = np.minimum(np.array(values, np.float32), 8) / 4
    return v


def accuracies(counts: dict[int, int], rounds: int = 100) -> tuple[np.ndarray, float, dict[int, float]]:
    """EM over how often each pattern of votes occurs: P(votes good | class, votes) of each labeller, the share of good documents, P(good | pattern)."""
    m = len(LABELLERS)
    digits = {p: [(p // 3**k) % 3 for k in range(m)] for p in counts}
    patterns = sorted(counts)
    v = np.array([digits[p] for p in patterns]).reshape(-1, m)
    n = np.array([counts[p] for p in patterns], float)
    good, bad = (v == GOOD), (v == BAD)
    p = np.where((bad.sum(axis=1) > 0), 0.005, np.where(good.sum(axis=1) > 0, 0.99, 0.5))  # one complaint weighs more than praise
    rate, share = np.full((2, m), 0.5), 0.5
    for _ in range(rounds):
        share = float(np.clip((n * p).sum() / max(n.sum(), 1), 0.02, 0.98))
        for c, q in ((1, n * p), (0, n * (1 - p))):
            rate[c] = (q @ good + 1.0 + c) / (q @ (good | bad) + 3.0)
        z = np.log(share / (1 - share)) + good @ np.log(rate[1] / rate[0]) + bad @ np.log((1 - rate[1]) / (1 - rate[0]))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return rate, share, dict(zip(patterns, p.tolist(), strict=True))


def _regress(x: np.ndarray, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Logistic regression on soft labels by gradient steps of adaptive size."""
    w, square = np.zeros(x.shape[1] + 1, np.float32), np.full(x.shape[1] + 1, 1e-6, np.float32)
    y = y.astype(np.float32)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        g = np.concatenate([x.T @ (y - p) / len(y) - 1e-4 * w[:-1], [(y - p).mean()]])
        square += g**2
        w += np.float32(0.2) * g / np.sqrt(square)
    return w


def score_quality(docs: DataFrame, id_col="doc_id", text_col="text", sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """Per row: score (0 to 1, higher is better), predicted (1 if score >= threshold), weak_label (posterior of the votes).

    The votes of all documents are counted by pattern (3 to the power of the labellers at most) and weighed by EM. The scorer is
    trained on about `sample` distinct texts chosen by hash, read whole, and their posteriors; of copies one is taken, so their
    number doesn't matter. Null counts as empty text; an empty table gives an empty result; repeated rows are each reported; other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()

    def vote(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([votes(measures(t.as_py())[0]) for t in as_binary(batch.column(0))], pa.int32())], ["v"])

    counts = {r.v: r.n for r in rows.select("t").mapInArrow(tidied(vote), "v int").groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}
    _, _, posterior = accuracies(counts) if counts else (None, None, {})
    kinds = max(1, rows.agg(F.approx_count_distinct(F.xxhash64("t"), 0.02)).first()[0])
    chosen = rows.select("t").where(F.pmod(F.xxhash64(F.lit(21), "t"), F.lit(1 << 20)) / float(1 << 20) < min(1.0, sample / kinds)).distinct()

    def features(batches):
        for batch in batches:
            for t in as_binary(batch.column(0)):
                values, n = measures(t.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([votes(values)], pa.int32()), pa.array([hashed(t.as_py(), n, values).astype(np.float16).tobytes()], pa.binary())], ["v", "x"])

    trained = sorted((bytes(r.x), r.v) for r in chosen.mapInArrow(tidied(features), "v int, x binary").toLocalIterator())
    x = np.frombuffer(b"".join(a for a, _ in trained), np.float16).reshape(len(trained), -1).astype(np.float32) if trained else np.zeros((1, WIDTH + 256 + len(LABELLERS)), np.float32)
    w = _regress(x, np.array([posterior.get(v, 0.5) for _, v in trained] or [0.5]))
    shared = docs.sparkSession.sparkContext.broadcast((w.astype(np.float32), posterior))

    def run(batches):
        w, posterior = shared.value
        for batch in batches:
            out, weak = [], []
            for t in as_binary(batch.column(1)):
                values, n = measures(t.as_py())
                z = float(hashed(t.as_py(), n, values) @ w[:-1] + w[-1])
                out.append(1 / (1 + np.exp(-max(-500.0, min(500.0, z)))))
                weak.append(posterior.get(votes(values), 0.5))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64()), pa.array([int(s >= threshold) for s in out], pa.int32()), pa.array(weak, pa.float64())], ["id", "score", "predicted", "weak_label"])

    return rows.mapInArrow(tidied(run), f"id {kind}, score double, predicted int, weak_label double").withColumnRenamed("id", id_col)
