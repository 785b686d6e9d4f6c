"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, as_binary, cut_lineage, id_crc32, tidied

#: Labelled documents that the model is fitted on, at most (about); those whose tokens train the field; tokens of a training sequence.
SAMPLE, SEQUENCES, STRETCH = 20_000, 3_000, 128
#: A feature is a sign of toxicity if it is so much likelier in toxic documents (log odds), and that by so many standard errors.
LEAST_ODDS, LEAST_ERRORS = 3.0, 2.5
#: Signs that the field weighs, at most: they are broadcast.
FEATURES = 5_000
#: ASCII that is neither letter nor digit ends a token.
SPACED = bytes(LOWER[b] if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
REMEMBERED = 300_000


def tokens_of(text: bytes) -> list[bytes]:
    """Runs of letters and digits, lower-cased beyond ASCII, too."""
    return text.decode().lower().encode().translate(SPACED).split()


def features_of(token: bytes) -> list[bytes]:
    """The token, its first three to six characters, and its last four, each under a name of its own."""
    text = token.decode(errors="replace")
    return [b"w" + token, *(b"%d" % n + text[:n].encode() for n in (3, 4, 5, 6) if len(text) > n), *([b"s" + text[-4:].encode()] if len(text) > 4 else [])]


@dataclass
class Field:
    weights: dict[bytes, float]  # of the toxic state; the clean state has none
    bias: float
    into: float  # transitions: clean to toxic, toxic to clean, toxic to toxic
    out: float
    stay: float
    scale: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def emission(self, token: bytes) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features_of(token))

    def marginals(self, emissions: list[float]) -> list[float]:
        """P(toxic) of each token by the forward-backward recursion, in odds."""
        a, b, c = math.exp(self.into), math.exp(self.out), math.exp(self.stay)
        forward, r = [], None
        for e in emissions:
            r = math.exp(min(e, 50.0)) * (1.0 if r is None else (a + r * c) / (1.0 + r * b))
            forward.append(r)
        out, s, after = [0.0] * len(emissions), 1.0, None
        for k in range(len(emissions) - 1, -1, -1):
            if after is not None:
                x = math.exp(min(after, 50.0)) * s
                s = (b + c * x) / (1.0 + a * x)
            odds = forward[k] * s
            out[k] = odds / (1.0 + odds)
            after = emissions[k]
        return out

    def score(self, expected: float, tokens: int) -> float:
        a, b, c = self.scale
        z = a * math.log1p(expected) + b * math.log1p(1000 * expected / max(tokens, 1)) + c
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


class _Remembered(dict):
    """What `of` gives for the tokens met so far, up to REMEMBERED of them."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, token: bytes):
        out = self.of(token)
        if len(self) < REMEMBERED:
            self[token] = out
        return out


class _Emissions(_Remembered):
    """Emissions of the tokens met so far, and the sum and peak of the marginals of texts without any feature, by length."""

    def __init__(self, field: Field):
        super().__init__(field.emission)
        self.plain: dict[int, tuple[float, float]] = {}


def excess_toxic(field: Field, memory: _Emissions, e: list[float], span_at: float) -> tuple[float, list[float] | None]:
    """Expected toxic tokens of a text of these emissions beyond those of a text of its length without any feature, and the marginals (None if none reaches `span_at`).

    The bias alone gives each token a small chance; without subtracting what it adds up to, long clean texts would look toxic and
    texts of one token, too. A text without any feature has no excess.
    """
    n = len(e)
    if not n:
        return 0.0, None
    if n not in memory.plain:
        m = field.marginals([field.bias] * n)
        if len(memory.plain) > REMEMBERED:
            memory.plain.clear()
        memory.plain[n] = sum(m), max(m)
    total, peak = memory.plain[n]
    if max(e) == field.bias == min(e) and peak < span_at:
        return 0.0, None
    m = field.marginals(e)
    return max(0.0, sum(m) - total), m


def _with_kind(batches):
    """Rows of (i, y, t) with the least hash of the text's shingles of five tokens, which near copies mostly share."""
    for batch in batches:
        kinds = []
        for text in as_binary(batch.column(2)):
            tokens = tokens_of(text.as_py())
            kinds.append(min((xxhash.xxh3_64_intdigest(b" ".join(tokens[j : j + 5])) for j in range(max(1, len(tokens) - 4)))) >> 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kinds, pa.int64())], ["i", "y", "t", "kind"])


def _feature_counts(batches):
    """(f, p, n) of rows of (y, t): toxic and other texts that have the feature, summed in the worker up to REMEMBERED features at a time."""
    sums: dict[bytes, list[int]] = {}
    features = _Remembered(features_of)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), *(pa.array([v[k] for v in sums.values()], pa.int64()) for k in (1, 0))], ["f", "p", "n"])

    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), as_binary(batch.column(1)), strict=True):
            for f in {f for token in set(tokens_of(text.as_py())) for f in features[token]}:
                sums.setdefault(f, [0, 0])[int(y > 0)] += 1
            if len(sums) > REMEMBERED:
                yield out()
                sums.clear()
    if sums:
        yield out()


def _train(sequences: list[tuple[np.ndarray, np.ndarray]], patterns: np.ndarray, n_features: int, rounds: int = 80) -> tuple[np.ndarray, float, float, float, float]:
    """Gradient ascent on the penalised likelihood of labelled sequences (pattern of each token, label of each token)."""
    m, length = len(sequences), max(len(s) for s, _ in sequences)
    x, y, some = np.zeros((m, length), np.int64), np.zeros((m, length)), np.zeros((m, length), bool)
    for k, (s, t) in enumerate(sequences):
        x[k, : len(s)], y[k, : len(s)], some[k, : len(s)] = s, t, True
    w = np.zeros(n_features + 1)  # 0: no feature
    theta = np.array([-3.0, -1.0, 0.0, 0.5])  # bias, into, out, stay
    squares = np.full(n_features + 1, 1e-3), np.full(4, 1e-3)
    labels = np.array([((y[:, :-1] == i) & (y[:, 1:] == j) & some[:, 1:]).sum() for i, j in ((0, 1), (1, 0), (1, 1))], float)
    counted = np.bincount(x[some], minlength=len(patterns))
    positive = np.bincount(x[some & (y == 1)], minlength=len(patterns))
    for _ in range(rounds):
        w[0] = 0
        e = np.clip(theta[0] + w[patterns].sum(axis=1)[x], -30, 30)
        a, b, c = np.exp(theta[1:])
        f, s, g = np.exp(e), np.ones((m, length)), np.exp(e)
        for k in range(1, length):
            f[:, k] = g[:, k] * (a + f[:, k - 1] * c) / (1 + f[:, k - 1] * b)
        for k in range(length - 2, -1, -1):
            z = np.where(some[:, k + 1], g[:, k + 1] * s[:, k + 1], -1)
            s[:, k] = np.where(z < 0, 1.0, (b + c * z) / (1 + a * z))
        p = f * s / (1 + f * s)
        r, z = f[:, :-1], g[:, 1:] * s[:, 1:]
        total = 1 + a * z + b * r + c * r * z
        pairs = np.array([(t / total * some[:, 1:]).sum() for t in (a * z, b * r, c * r * z)])
        seen = np.bincount(x[some], weights=p[some], minlength=len(patterns))
        slope = np.zeros(n_features + 1)
        for j in range(patterns.shape[1]):
            np.add.at(slope, patterns[:, j], positive - seen)
        for value, grad, square in ((w, slope - 0.05 * w, squares[0]), (theta, np.concatenate([[positive.sum() - seen.sum()], labels - pairs]), squares[1])):
            square += grad**2
            value += 0.5 * grad / np.sqrt(square)
    w[0] = 0
    assert counted.sum() == some.sum()
    return w, *theta


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", sample: int = SAMPLE, sequences: int = SEQUENCES) -> Field:
    """A field fitted on at most about `sample` labelled documents (chosen by hash of the id), whole texts.

    Labels are of documents; those of tokens are derived: a feature that is far likelier in toxic documents is a sign, and in a
    toxic document tokens with a sign are toxic. Near copies must not count as evidence again and again, so documents are counted
    by kind, the least hash of their five-word shingles: the document of the smallest id stands for its kind, which is toxic if any
    of its documents is. The sample is written once to the shared folder and counted from there. How many it takes follows from the sample: a sign has to be LEAST_ODDS
    likelier, by LEAST_ERRORS standard errors; of more than FEATURES signs those in most kinds are used. An id labelled several
    times is toxic if any label says so. Without labelled documents of both classes, or with so few that no feature is a sign,
    nothing is toxic and all scores are equal. Null texts teach nothing.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("i")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    sizes = {r.y: r.n for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Field({}, -20.0, 0.0, 0.0, 0.0, (0.0, 0.0, -20.0))
    at = F.pmod(F.xxhash64(F.lit(11), "i"), F.lit(1 << 20)) / float(1 << 20)
    toxic, clean = (min(1.0, sample / 2 / sizes[y]) for y in (1, 0))
    chosen = marked.where(at < F.when(F.col("y") == 1, toxic).otherwise(clean))
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null").join(F.broadcast(chosen), "i")  # `sample` rows of two numbers
    drawn = cut_lineage(rows.select("i", "y", "t").mapInArrow(tidied(_with_kind), f"i {rows.schema['i'].dataType.simpleString()}, y int, t string, kind long").withColumn("row", F.monotonically_increasing_id()))
    firsts = drawn.groupBy("kind").agg(F.max("y").alias("y"), F.min(F.struct("i", F.xxhash64("t"), "row")).alias("first")).select("y", F.col("first.row").alias("row"))
    counted = drawn.select("row", "t").join(firsts, "row").select("y", "t").mapInArrow(tidied(_feature_counts), "f binary, p long, n long").groupBy("f").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).where("p >= 2")
    n1, n0 = (max(1.0, sizes[y] * s) for y, s in ((1, toxic), (0, clean)))
    odds = F.log((F.col("p") + 0.5) / (n1 + 1)) - F.log((F.col("n") + 0.5) / (n0 + 1))
    error = F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") + 0.5))
    signs = [bytes(r.f) for r in counted.withColumns({"o": odds, "e": error}).where((F.col("o") >= LEAST_ODDS) & (F.col("o") >= LEAST_ERRORS * F.col("e"))).orderBy(F.desc("p"), "f").limit(FEATURES).collect()]
    if not signs:
        return Field({}, -20.0, 0.0, 0.0, 0.0, (0.0, 0.0, -20.0))
    number = {f: k + 1 for k, f in enumerate(signs)}
    share = min(1.0, sequences / (n1 + n0))
    part = drawn.where(F.pmod(F.xxhash64(F.lit(12), "i"), F.lit(1 << 20)) / float(1 << 20) < F.when(F.col("y") == 1, min(1.0, share * (n1 + n0) / 2 / n1)).otherwise(min(1.0, share * (n1 + n0) / 2 / n0)))

    def sequence(batches):
        signs_of = _Remembered(lambda x: ",".join(map(str, sorted(number[f] for f in features_of(x) if f in number))) or "0")
        for batch in batches:
            out = [" ".join(map(signs_of.__getitem__, tokens_of(t.as_py()))) for t in as_binary(batch.column("t"))]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(out, pa.string())], ["y", "s"])

    pattern_of: dict[str, int] = {"0": 0}
    stretches, documents = [], []
    for r in part.select("i", "t", "y").mapInArrow(tidied(sequence), "y int, s string").toLocalIterator():
        ids = np.array([pattern_of.setdefault(p, len(pattern_of)) for p in r.s.split()], np.int64)
        y = (ids > 0) & (r.y == 1)
        documents.append((r.y, ids))
        # stretches without a sign say the same again and again: those with one, and the first of each document
        stretches += [(ids[a : a + STRETCH], y[a : a + STRETCH]) for a in range(0, len(ids), STRETCH) if a == 0 or ids[a : a + STRETCH].any()]
    sets = [[int(x) for x in p.split(",")] for p in pattern_of]
    patterns = np.zeros((len(sets), max(map(len, sets))), np.int64)
    for k, s in enumerate(sets):
        patterns[k, : len(s)] = s
    w, bias, into, out, stay = _train(stretches, patterns, len(signs))
    field = Field({f: float(w[k]) for f, k in number.items() if abs(w[k]) > 1e-6}, float(bias), float(into), float(out), float(stay))
    per = field.bias + w[patterns].sum(axis=1)
    x, y, memory = [], [], _Emissions(field)
    for label, ids in documents:
        e = per[ids].tolist()
        expected, _ = excess_toxic(field, memory, e, 1.0)
        x.append((math.log1p(expected), math.log1p(1000 * expected / max(len(e), 1)), 1.0))
        y.append(label)
    field.scale = _calibrate(np.array(x), np.array(y, float), n1, n0)
    return field


def _calibrate(x: np.ndarray, y: np.ndarray, n1: float, n0: float) -> tuple[float, float, float]:
    """Logistic regression of the label on the aggregates, classes in balance, by Newton's method with a ridge; the slopes stay positive."""
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    theta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - 0.5 * theta
        theta += np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3), grad)
    a, b, c = theta.tolist()
    return max(a, 0.0), max(b, 0.0), c


def score(docs: DataFrame, field: Field, id_col="doc_id", text_col="text", threshold: float = 0.7, span_at: float = 0.5) -> DataFrame:
    """Per row: score (0 to 1), predicted (score >= threshold) and spans, the first and last offending token of each run by marginals.

    Offending are tokens whose marginal reaches `span_at`; if none of a document predicted toxic does, those of the highest one.
    Token numbers count letter-and-digit runs from 0. Null and empty texts have no tokens and the lowest score. Repeated rows are
    each reported; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # at most FEATURES weights
    rows = docs.select(id_col, F.col(text_col).alias("__text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches):
        field = shared.value
        memory = _Emissions(field)
        for batch in batches:
            scores, spans = [], []
            for text in as_binary(batch.column(1)):
                tokens = tokens_of(text.as_py())
                expected, marginals = excess_toxic(field, memory, list(map(memory.__getitem__, tokens)), span_at)
                scores.append(field.score(expected, len(tokens)))
                least = span_at if not marginals or scores[-1] < threshold else min(span_at, max(marginals))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], (np.array(marginals) >= least).astype(np.int8), [0]]))) if marginals else np.zeros(0, int)
                spans.append([{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))], [id_col, "score", "predicted", "spans"])

    return rows.mapInArrow(tidied(run), f"`{id_col}` {kind}, score double, predicted int, spans array<struct<first: int, last: int>>")


def held_out(id_col: str, folds: int = 3, fold: int = 1):
    return F.pmod(id_crc32(id_col), F.lit(folds)) == fold
