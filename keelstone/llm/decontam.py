"""Benchmark decontamination: token windows of documents looked up in a hash set of test n-grams."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from .common import LOWER, as_binary, cut_lineage, numbered, tidied

#: Every ASCII byte that belongs to no word becomes a space; A-Z become a-z; other bytes stay.
WORDS = bytes(LOWER[b] if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= LOWER[b] <= 0x7A else 0x20 for b in range(256))
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class NgramSet:
    """Hash set of the word windows of all test items. Windows are equal only if their words are: a hit of the hash is verified.

    Kept are the words of all items as numbers in one array and, for each length of window, the sorted hashes and where the windows
    start: 16 bytes a window, besides the vocabulary.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [item_id for item_id, _ in items]
        numbers, sizes = [], []
        for _, text in items:
            words = words_of(text)
            numbers.append(np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words), np.int32, len(words)))
            sizes.append(len(words))
        self.words = np.concatenate([*numbers, np.zeros(0, np.int32)])
        self.stops = np.cumsum(sizes)
        starts: dict[int, list[np.ndarray]] = {}
        for stop, size in zip(self.stops.tolist(), sizes, strict=True):
            if size:
                starts.setdefault(min(n, size), []).append(np.arange(stop - size, stop - min(n, size) + 1))
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length, parts in starts.items():
            at = np.concatenate(parts).astype(np.int32)
            h = self.hashed(self.words.astype(np.uint64), at.astype(np.int64), length)
            order = np.argsort(h, kind="stable")
            self.windows[length] = h[order], at[order]
        self.met: dict[tuple[int, int], dict[bytes, frozenset[str]]] = {}

    @staticmethod
    def hashed(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for j in range(length):
            h += ids[at + j] * np.uint64(pow(int(MIX), j + 1, 1 << 64))
        return h

    def _items(self, length: int, low: int, high: int) -> dict[bytes, frozenset[str]]:
        """Of the windows low to high, which share a hash: their words, and the items that have them."""
        if (length, low) not in self.met:
            by: dict[bytes, set[str]] = {}
            for start in self.windows[length][1][low:high].tolist():
                name = self.names[int(np.searchsorted(self.stops, start, "right"))]
                by.setdefault(self.words[start : start + length].tobytes(), set()).update([] if name is None else [name])
            if len(self.met) > 100_000:
                self.met.clear()
            self.met[length, low] = {k: frozenset(v) for k, v in by.items()}
        return self.met[length, low]

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie inside an occurring window, and the items that have one."""
        hit, items = np.zeros(len(words), bool), set()
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        foreign, wide = np.concatenate([[0], np.cumsum(ids == 0)]), ids.astype(np.uint64)
        for length, (hashes, _) in self.windows.items():
            m = len(words) - length + 1
            if m <= 0:
                continue
            at = np.flatnonzero(foreign[length:] == foreign[:m])  # windows of known words only
            if not len(at):
                continue
            h = self.hashed(wide, at, length)
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for k in np.flatnonzero(high > low).tolist():
                i = int(at[k])
                found = self._items(length, int(low[k]), int(high[k])).get(ids[i : i + length].tobytes())
                if found is not None:
                    hit[i : i + length] = True
                    items |= found
        return hit, items


def spans_removed(text: bytes, words: list[bytes], hit: np.ndarray) -> bytes:
    """The text without its runs of hit words; each run leaves one line break."""
    if not hit.any():
        return text
    flat, at, place = text.translate(WORDS), 0, np.empty((len(words), 2), np.int64)
    for k, w in enumerate(words):
        at = flat.index(w, at)
        place[k] = at, at + len(w)
        at += len(w)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    kept, last = [], 0
    for a, b in zip(edge[::2], edge[1::2] - 1, strict=True):
        kept.append(text[last : place[a, 0]])
        last = place[b, 1]
    return b"\n".join([*kept, text[last:]])


#: Bytes of test items whose set is sent to every executor at once; more are scanned in parts of this size, one after another.
#: A set takes some 3 bytes for each byte of text and 100 to 150 for each distinct word: 180 MB at the worst, if none occurs twice.
BROADCAST_BYTES = 8 << 20


def contamination(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_id_col="item_id", item_text_col="text", n: int = 10) -> DataFrame:
    """Per document row: n_words, n_hit, n_items, items_sha256, contaminated.

    Words are maximal runs of digits, a-z (after lower-casing A-Z) and non-ASCII bytes. A window is n consecutive words of an
    item, or all of them if it has fewer. The items are collected only after their total size has been checked; beyond
    BROADCAST_BYTES they are dealt into parts by hash, and each part is scanned in turn (see `_in_parts`). Null texts have no
    words; items with null ids still hit but are not listed; repeated rows are each reported; an empty test set contaminates
    nothing; an empty table gives an empty result; other columns are ignored.
    """
    return _found(docs, [id_col], text_col, items, item_id_col, item_text_col, n, False)


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """`docs` (doc_id, text, n_chars and whatever else it has) with every span of benchmark words taken out of the text.

    Documents without a hit stay as they are, null and empty texts among them; no row goes. Columns of any name are kept. An empty
    table gives an empty result.
    """
    others = [c for c in docs.columns if c != "text"]
    made = _found(docs, others, "text", items, "item_id", "text", n, True).toDF(*[f"c{k}" for k in range(len(others) + 2)])
    place = {c: F.col(f"c{k}") for k, c in enumerate(others)} | {"text": F.col(f"c{len(others)}")}
    if "n_chars" in place:
        place["n_chars"] = F.when(F.col(f"c{len(others) + 1}"), F.length(place["text"]).cast("long")).otherwise(place["n_chars"])
    return made.select(*[place[c].alias(c) for c in docs.columns])


def _found(docs: DataFrame, kept: list[str], text_col: str, items: DataFrame, item_id_col: str, item_text_col: str, n: int, cleaned: bool) -> DataFrame:
    """The columns `kept` with the figures, or with the cleaned text and whether it was contaminated."""
    items = items.select(F.col(item_id_col).cast("string").alias("i"), F.col(item_text_col).alias("t")).where("t is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t") + 64), F.lit(0))).first()[0]
    rows = numbered([*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`")], docs)
    if size <= BROADCAST_BYTES:
        return _scan(rows, items, n, cleaned)[0].toDF(*kept, *FIGURES[cleaned])
    return _in_parts(rows, items, 1 + size // BROADCAST_BYTES, n, cleaned).toDF(*kept, *FIGURES[cleaned])


FIGURES = {False: ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"], True: ["text", "contaminated"]}


def _figures(words: list[bytes], hit: np.ndarray, items) -> tuple[int, int, int, str, bool]:
    return len(words), int(hit.sum()), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit.any())


def _schema(rows: DataFrame, cleaned: bool) -> StructType:
    types = [StringType(), BooleanType()] if cleaned else [LongType(), LongType(), LongType(), StringType(), BooleanType()]
    return StructType([*rows.schema[:-1], *[StructField(f"f{k}", t) for k, t in enumerate(types)]])


def _batch(own: list[pa.Array], schema: StructType, texts: list, made: list[tuple], cleaned: bool) -> pa.RecordBatch:
    """made: words, which are hit, and items of each text."""
    if cleaned:
        out = [pa.array([t if t is None or not h.any() else spans_removed(t, w, h) for t, (w, h, _) in zip(texts, made, strict=True)], pa.binary()).cast(pa.string()), pa.array([bool(h.any()) for _, h, _ in made], pa.bool_())]
    else:
        figures = [_figures(*m) for m in made]
        out = [pa.array([f[k] for f in figures], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))]
    return pa.RecordBatch.from_arrays([*own, *out], schema.names)


def _texts(column) -> list[bytes | None]:
    return [None if x is None else bytes(x) for x in column.cast(pa.binary()).to_pylist()]


def _scan(rows: DataFrame, items: DataFrame, n: int, cleaned: bool) -> tuple[DataFrame, object]:
    """`rows` (the text last) looked up in the whole set, and the broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(NgramSet([(r.i, r.t.encode()) for r in items.collect()], n))
    schema, width = _schema(rows, cleaned), len(rows.columns) - 1

    def run(batches):
        grams = shared.value
        for batch in batches:
            texts = _texts(batch.column(width))
            made = [(w, *grams.hits(w)) for w in (words_of(t or b"") for t in texts)]
            yield _batch([batch.column(k) for k in range(width)], schema, texts, made, cleaned)

    return rows.mapInArrow(tidied(run), schema), shared


def _in_parts(rows: DataFrame, items: DataFrame, parts: int, n: int, cleaned: bool) -> DataFrame:
    """A test set too large to send whole: one part of it after another. What has been hit goes along with the row, and each part's rows are written to the shared folder, so that one set at a time is in memory."""
    width = len(rows.columns) - 1
    state = rows.withColumns({"hit": F.array().cast("array<int>"), "items": F.array().cast("array<string>")})
    names = state.columns
    for p in range(parts):
        shared = rows.sparkSession.sparkContext.broadcast(NgramSet([(r.i, r.t.encode()) for r in items.where(F.pmod(F.xxhash64(F.lit(5), "i", "t"), F.lit(parts)) == p).collect()], n))

        def run(batches, shared=shared):
            grams = shared.value
            for batch in batches:
                hits, lists = [], []
                for t, h, i in zip(_texts(batch.column(width)), batch.column(width + 1).to_pylist(), batch.column(width + 2).to_pylist(), strict=True):
                    hit, items = grams.hits(words_of(t or b""))
                    hits.append(sorted({*h, *np.flatnonzero(hit).tolist()}))
                    lists.append(sorted({*i, *items}))
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(width + 1)), pa.array(hits, pa.list_(pa.int32())), pa.array(lists, pa.list_(pa.string()))], names)

        state = cut_lineage(state.mapInArrow(tidied(run), state.schema))
        shared.unpersist()
    schema = _schema(rows, cleaned)

    def figures(batches):
        for batch in batches:
            texts, made = _texts(batch.column(width)), []
            for t, h, i in zip(texts, batch.column(width + 1).to_pylist(), batch.column(width + 2).to_pylist(), strict=True):
                words = words_of(t or b"")
                hit = np.zeros(len(words), bool)
                hit[np.array(h, np.int64)] = True
                made.append((words, hit, i))
            yield _batch([batch.column(k) for k in range(width)], schema, texts, made, cleaned)

    return state.mapInArrow(tidied(figures), schema)
