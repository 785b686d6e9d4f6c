"""Removal of byte strings that repeat anywhere in the corpus, by hash-compared suffixes.

Every window (string of `width` bytes) is sent where all its equals go: it belongs to the smallest hash among its grams, and
consecutive windows of one smallest hash form a segment. Segments are known by that hash and a digest; only where they are not
equal as a whole does their text travel. There suffixes are put in lexicographic order by a mergesort that compares two of them by
the byte after their common extension, found by binary search over prefix hashes; every match of neighbours is verified on the bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_binary, partitions, tidied

#: Bytes of a gram; windows of a segment at most; bytes of text that are worked on at once.
GRAM, LONGEST, AT_ONCE = 32, 4096, 2 << 20
#: Words of eight bytes that suffixes are sorted by before the mergesort; strings compared at once; segments hashed at once.
HEADS, COMPARED, SOME = 4, 16_384, 1_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE2 = np.uint64(0xD6E8FEB86659FD93)
SELF, CROWDED, COUNT = 1 << 15, 1 << 14, (1 << 13) - 1
#: Bytes in segments of one gram hash that a task matches; more are matched window by window over the cluster.
CROWD = 16 << 20


_powers: dict[np.uint64, np.ndarray] = {}


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64; the longest table asked for is kept."""
    if len(_powers.get(base, ())) < n:
        table = np.full(n, base, np.uint64)
        table[0] = 1
        _powers[base] = np.multiply.accumulate(table)
    return _powers[base][:n]


class PrefixHashes:
    """Polynomial hashes modulo 2**64 of all substrings of `data`, mixed so that low bits are good, too."""

    def __init__(self, data: np.ndarray, base: np.uint64 = BASE):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n, base), out=self.sums[1:])
        self.inverse = powers(n + 1, np.uint64(pow(int(base), -1, 1 << 64)))

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.inverse[at]

    def all(self, length: int) -> np.ndarray:
        h = (self.sums[length:] - self.sums[: len(self.sums) - length]) * self.inverse[: len(self.sums) - length]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffix pairs, up to `most`, by binary search."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.of(a, mid) == self.of(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _least_in_windows(h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each w consecutive hashes the smallest and its first place."""
    n = len(h)
    m = -(-n // w) * w
    x = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    x[:n] = h
    x = x.reshape(-1, w)
    place = np.arange(m, dtype=np.int64).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1)
    fresh = np.ones_like(x, bool)
    fresh[:, 1:] = x[:, 1:] < ahead[:, :-1]
    ahead_at = np.maximum.accumulate(np.where(fresh, place, 0), axis=1).ravel()
    rev = x[:, ::-1]
    back = np.minimum.accumulate(rev, axis=1)
    fresh[:, 0], fresh[:, 1:] = True, rev[:, 1:] <= back[:, :-1]
    back_at = np.minimum.accumulate(np.where(fresh, place[:, ::-1], m), axis=1)[:, ::-1].ravel()
    ahead, back = ahead.ravel(), back[:, ::-1].ravel()
    k = n - w + 1
    left = back[:k] <= ahead[w - 1 : w - 1 + k]
    return np.where(left, back[:k], ahead[w - 1 : w - 1 + k]), np.where(left, back_at[:k], ahead_at[w - 1 : w - 1 + k])


def segments(data: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window in `data`, windows, repeats inside) of the segments of texts that lie end to end, each of `width` bytes at least."""
    least, place = _least_in_windows(PrefixHashes(data).all(GRAM), width - GRAM + 1)
    ends = np.cumsum(lengths)
    first, stop = ends - lengths, ends - width + 1
    cut = np.ones(len(least) + 1, bool)
    cut[1:-1] = least[1:] != least[:-1]
    cut[first] = cut[stop] = True
    starts = np.flatnonzero(cut)
    n = np.diff(starts)
    starts = starts[:-1]
    if (n > LONGEST).any():
        starts = np.concatenate([np.arange(s, s + k, LONGEST) for s, k in zip(starts.tolist(), n.tolist(), strict=True)])
        n = np.diff(np.concatenate([starts, [len(least)]]))
    moves = np.zeros(len(least), np.int64)
    moves[1:] = place[1:] != place[:-1]
    moves[starts] = 0
    inside = (np.add.reduceat(moves, starts) > 0) | (n == LONGEST)
    inside[1:] |= n[:-1] == LONGEST  # the rest of a long run
    text = np.searchsorted(ends, starts, "right")
    keep = starts < stop[np.minimum(text, len(stop) - 1)]
    return least[starts][keep], starts[keep], n[keep], inside[keep]


def suffix_order(data: np.ndarray, prefix: PrefixHashes, whole: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Places of `starts` in the lexicographic order of the `width` bytes that begin there; equal ones keep their order.

    Begins with the order of the first HEADS words of eight bytes and goes on with a mergesort among those that agree in them: an
    element's place among the other run's is found by binary search, and two suffixes are compared by the byte after their common
    extension. `whole` are the hashes of the strings themselves: equal hashes need no search.
    """
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    heads = [words[starts + 8 * k].astype(np.uint64) for k in range(min(HEADS, width // 8))]
    order = np.lexsort(heads[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in heads])
    first = np.flatnonzero(new)
    mixed = np.zeros(len(order), bool)
    mixed[1:] = ~new[1:] & (whole[order[1:]] != whole[order[:-1]])
    size = np.diff(np.concatenate([first, [len(order)]]))
    unsorted = np.logical_or.reduceat(mixed, first) if len(first) else mixed
    place = np.flatnonzero(np.repeat(unsorted, size))
    base, size = np.repeat(first, size)[place], np.repeat(size, size)[place]
    inner = place - base

    def compared(x, y):
        out = np.zeros(len(x), np.int16)
        differ = np.flatnonzero(whole[x] != whole[y])
        a, b = starts[x[differ]], starts[y[differ]]
        at = prefix.common(a, b, np.full(len(a), width - 1))
        out[differ] = data[a + at].astype(np.int16) - data[b + at]
        return out

    run, longest = 1, size.max(initial=0)
    while run < longest:
        pair = inner // (2 * run) * (2 * run)
        left = inner - pair < run
        high = np.where(left, np.minimum(pair + 2 * run, size), pair + run)
        low = np.minimum(np.where(left, pair + run, pair), high)
        begin, live = low.copy(), np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) >> 1
            c = compared(order[place[live]], order[base[live] + mid])
            after = c >= np.where(left[live], 1, 0)
            low[live], high[live] = np.where(after, mid + 1, low[live]), np.where(after, high[live], mid)
            live = live[low[live] < high[live]]
        order[base + inner - np.where(left, 0, run) + low - begin] = order[place]
        run *= 2
    return order


def _agree(data: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Whether the strings of `width` bytes at a and b are equal, byte by byte."""
    rows = np.lib.stride_tricks.sliding_window_view(data, width)
    out = np.zeros(len(a), bool)
    for k in range(0, len(a), COMPARED):
        out[k : k + COMPARED] = (rows[a[k : k + COMPARED]] == rows[b[k : k + COMPARED]]).all(axis=1)
    return out


def _recount(data: np.ndarray, starts: np.ndarray, doubtful: np.ndarray, out: np.ndarray, width: int) -> None:
    """Put right `out` where hashes have collided: the strings themselves are counted."""
    text = memoryview(data)
    seen: dict[bytes, list[int]] = {}
    for k in np.flatnonzero(doubtful).tolist():
        seen.setdefault(bytes(text[starts[k] : starts[k] + width]), []).append(k)
    out[doubtful] = False
    for ks in seen.values():
        if len(ks) > 1:
            out[ks] = True


def repeated_windows(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of the window starts in `data` have an equal among the others; all strings are of `width` bytes."""
    prefix = PrefixHashes(data)
    whole = prefix.of(starts, width)
    order = suffix_order(data, prefix, whole, starts, width)
    same = np.flatnonzero(whole[order[1:]] == whole[order[:-1]])
    a, b = order[same], order[same + 1]  # neighbours, a before b in the text
    out = np.zeros(len(starts), bool)
    if not len(a):
        return out
    back = np.argsort(b, kind="stable")
    a, b = a[back], b[back]
    pa_, pb = starts[a], starts[b]
    runs = np.concatenate([[0], np.flatnonzero((np.diff(pa_) != 1) | (np.diff(pb) != 1)) + 1])
    lengths = np.diff(np.concatenate([runs, [len(a)]]))
    reach = prefix.common(pa_[runs], pb[runs], lengths + width - 1)
    text, wrong = memoryview(data), []
    for r, n, x, y, e in zip(runs.tolist(), lengths.tolist(), pa_[runs].tolist(), pb[runs].tolist(), reach.tolist(), strict=True):
        if e == n + width - 1 and text[x : x + e] == text[y : y + e]:
            out[a[r : r + n]] = out[b[r : r + n]] = True
        else:
            wrong += b[r : r + n].tolist() + a[r : r + n].tolist()
    if wrong:
        _recount(data, starts, np.isin(whole, whole[wrong]), out, width)
    return out


def _pack(d2: np.ndarray | int, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """16 bits of the text's second digest, 32 of the first window, 16 of how many."""
    return ((np.asarray(d2).astype(np.int64) & 0xFFFF) << 48) | (first.astype(np.int64) << 16) | n.astype(np.int64)


def _unpack(packed: np.ndarray, d2: int) -> tuple[np.ndarray, np.ndarray]:
    packed = packed[(packed >> 48) & 0xFFFF == d2 & 0xFFFF]
    return (packed >> 16) & 0xFFFFFFFF, packed & COUNT


def _texts(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """(d1, d2, blob): the distinct texts long enough to hold a window, compressed, dealt by d1."""
    rows = docs.select(F.col(text_col).alias("t")).where(F.octet_length("t") >= width).select(F.xxhash64("t").alias("d1"), F.xxhash64(F.lit(1), "t").alias("d2"), "t")

    def pack(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            keep = [k for k, key in enumerate(keys) if not (key in seen or seen.add(key))]
            if len(seen) > 200_000:
                seen.clear()
            press, texts = zstandard.ZstdCompressor(level=1), as_binary(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64())), pa.array([press.compress(texts[k].as_buffer()) for k in keep], pa.binary())], ["d1", "d2", "blob"])

    n = partitions(docs.sparkSession)
    return rows.mapInArrow(tidied(pack), "d1 long, d2 long, blob binary").where("d1 is not null").repartition(n, "d1").sortWithinPartitions("d1", "d2")


def _firsts(batches):
    """Rows of sorted batches without immediate repeats of (d1, d2), their texts unpacked."""
    last, unpress = None, zstandard.ZstdDecompressor()
    for batch in batches:
        for k, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if key != last:
                last = key
                yield batch, k, *key, np.frombuffer(unpress.decompress(batch.column(2)[k].as_buffer()), np.uint8)


def _segment_rows(width: int):
    schema = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("d1", pa.int64()), ("p", pa.int64())])

    def of(texts):
        """Segments of [(d1, d2, where the text stands in its document, bytes)]."""
        lengths = np.array([len(t[3]) for t in texts], np.int64)
        data = np.concatenate([t[3] for t in texts])
        h, first, n, inside = segments(data, lengths, width)
        view = memoryview(data)
        g = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (first + n + width - 1).tolist(), strict=True)), np.uint64, len(h))
        ends = np.cumsum(lengths)
        own = np.searchsorted(ends, first, "right")
        d1, d2, at = (np.array([t[k] for t in texts], np.int64)[own] for k in range(3))
        packed = _pack(d2, first - (ends - lengths)[own] + at, n | np.where(inside, SELF, 0))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (h.view(np.int64), g.view(np.int64), d1, packed)], schema=schema)

    def run(batches):
        held, size = [], 0
        for _, _, d1, d2, data in _firsts(batches):
            for at in range(0, len(data) - width + 1, AT_ONCE):
                held.append((d1, d2, at, data[at : at + AT_ONCE + width - 1]))
                size += len(held[-1][3])
                if size > AT_ONCE // 4:
                    yield of(held)
                    held, size = [], 0
        if held:
            yield of(held)

    return run


def _cut(width: int):
    """(h, d1, p, s): the text of the segments that are asked for."""

    def run(batches):
        for batch, k, d1, _, data in _firsts(batches):
            asked = batch.column(4)[k].values
            p = asked.field(1).to_numpy(zero_copy_only=False)
            calm = np.flatnonzero(p & CROWDED == 0)
            h, p = asked.field(0).take(pa.array(calm)), p[calm]
            first, n = (p >> 16) & 0xFFFFFFFF, p & COUNT
            text = memoryview(data)
            yield pa.RecordBatch.from_arrays([h, pa.array(np.full(len(p), d1, np.int64)), pa.array(p), pa.array([bytes(text[a:b]) for a, b in zip(first.tolist(), (first + n + width - 1).tolist(), strict=True)], pa.binary())], ["h", "d1", "p", "s"])

    return run


def _windows(width: int):
    """(w1, w2, d1, p): each window of the crowded segments, by two hashes."""

    def run(batches):
        for batch, k, d1, d2, data in _firsts(batches):
            p = batch.column(4)[k].values.field(1).to_numpy(zero_copy_only=False)
            first, n = _unpack(p[p & CROWDED != 0], d2)
            if not len(first):
                continue
            at = np.concatenate([np.arange(a, a + m) for a, m in zip(first.tolist(), n.tolist(), strict=True)])
            w1, w2 = (PrefixHashes(data, base).of(at, width).view(np.int64) for base in (BASE, BASE2))
            yield pa.RecordBatch.from_arrays([pa.array(w1), pa.array(w2), pa.array(np.full(len(at), d1, np.int64)), pa.array(_pack(d2, at, np.ones(len(at), np.int64)))], ["w1", "w2", "d1", "p"])

    return run


def _without_repeats(rows):
    last = None
    for r in rows:
        if r[1:3] != last:
            last = r[1:3]
            yield r


def _match(width: int, at_once: int = AT_ONCE // 4):
    """(d1, p) of the runs of repeated windows among segments that come sorted by h. Whole groups of h are matched together; one too large to be sorted at once is matched in parts by window hash."""

    def found(d1, p, texts):
        lengths = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        base = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        n = lengths - width + 1
        owner = np.repeat(np.arange(len(n)), n)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        return runs(d1, p, owner, inner, repeated_windows(data, base[owner] + inner, width))

    def runs(d1, p, owner, inner, yes):
        edge = np.flatnonzero(yes & np.concatenate([[True], ~yes[:-1] | (owner[1:] != owner[:-1])]))
        stop = np.flatnonzero(yes & np.concatenate([~yes[1:] | (owner[1:] != owner[:-1]), [True]]))
        o = owner[edge]
        first = ((p[o] >> 16) & 0xFFFFFFFF) + inner[edge]
        return d1[o], _pack((p[o] >> 48) & 0xFFFF, first, stop - edge + 1)

    def batch_of(d1, p):
        return pa.RecordBatch.from_arrays([pa.array(d1), pa.array(p)], ["d1", "p"])

    def large(rows):
        """One group of at most about CROWD bytes, a part of its windows (by hash) at a time."""
        d1, p, texts = zip(*rows, strict=True)
        d1, p, n = np.array(d1, np.int64), np.array(p, np.int64), np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        del texts
        at = np.cumsum(n) - n
        base = np.concatenate([[0], np.cumsum(n - width + 1)])
        flags = np.zeros(base[-1], bool)
        parts = max(1, -(-len(data) // (2 * at_once)))
        for k in range(parts):
            places, hashes = [], []
            for j in range(0, len(n), SOME):
                a, b = at[j], (at[j : j + SOME] + n[j : j + SOME])[-1]
                h = PrefixHashes(data[a:b]).all(width)
                # strings across two segments don't count
                inner = np.arange(base[j], base[min(j + SOME, len(n))])
                h = h[inner + (np.searchsorted(base, inner, "right") - 1) * (width - 1) - a]
                mine = np.flatnonzero((h >> np.uint64(40)) % np.uint64(parts) == k)
                places.append(inner[mine])
                hashes.append(h[mine])
            place, h = np.concatenate(places), np.concatenate(hashes)
            start = place + (np.searchsorted(base, place, "right") - 1) * (width - 1)
            order = np.argsort(h, kind="stable")
            same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
            a, b = order[same], order[same + 1]
            yes = np.zeros(len(place), bool)
            yes[a] = yes[b] = True
            wrong = ~_agree(data, start[a], start[b], width)
            if wrong.any():
                _recount(data, start, np.isin(h, h[a[wrong]]), yes, width)
            flags[place] = yes
        return runs(d1, p, np.repeat(np.arange(len(n)), n - width + 1), np.arange(base[-1]) - np.repeat(base[:-1], n - width + 1), flags)

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)

        from itertools import chain, groupby

        held, size = [], 0

        def flush():
            d1, p, s = zip(*held, strict=True)
            return batch_of(*found(np.array(d1, np.int64), np.array(p, np.int64), s))

        for _, group in groupby(rows(), key=lambda r: r[0]):
            mine, big, group = [], 0, _without_repeats(group)
            for r in group:
                mine.append(r[1:])
                big += len(r[3])
                if big > 2 * at_once:
                    yield batch_of(*large(chain(mine, (r[1:] for r in group))))
                    mine, big = [], 0
                    break
            if held and size + big > at_once:
                yield flush()
                held, size = [], 0
            held += mine
            size += big
        if held:
            yield flush()

    return run


def covered(n: int, first: np.ndarray, windows: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that lie in a repeated window."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    a, b = first[order], np.maximum.accumulate((first + windows + width - 1)[order])
    new = np.concatenate([[True], a[1:] > b[:-1]])
    ends = np.concatenate([b[:-1][new[1:]], b[-1:]])
    return list(zip(a[new].tolist(), np.minimum(ends, n).tolist(), strict=True))


def _kept(width: int, with_text: bool):
    def run(batches):
        for batch, k, d1, d2, data in _firsts(batches):
            marks = [batch.column(c)[k].values for c in (3, 4)]
            p = np.concatenate([m.to_numpy(zero_copy_only=False).astype(np.int64) if m is not None else np.zeros(0, np.int64) for m in marks])
            spans = covered(len(data), *_unpack(p, d2), width)
            text, at, kept = memoryview(data), 0, []
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            kept = b"".join([*kept, text[at:]])
            out = [[d1], [d2], [len(data) - len(kept)], [len(spans)], [hashlib.sha256(kept).hexdigest()]] + [[kept.decode(errors="ignore") if spans else None]] * with_text
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=False)], ["d1", "d2", "n_removed", "n_spans", "kept_sha256", *["cleaned"] * with_text])

    return run


def remove_repeats(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 200, carry: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """Per row: n_bytes, n_removed, n_spans, kept_sha256 (and with `with_text` `cleaned`, null where nothing is removed).

    Removed is every byte in a string of `width` bytes that starts anywhere else, too, in this row or another. Matches never
    cross rows. A text that several rows have is looked at once and wholly removed if it is long enough to hold a window. Null
    counts as empty; texts below `width` bytes lose nothing; `cleaned` drops what is left of a cut character. Equal rows are each
    reported. Other columns are ignored unless named in `carry`.
    """
    assert width > GRAM
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    own = F.when(size < width, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    rows = docs.select(F.col(id_col), *carry, size.alias("n_bytes"), own.alias("__own"), F.xxhash64(text_col).alias("__d1"), F.xxhash64(F.lit(1), text_col).alias("__d2"))
    texts = _texts(docs, text_col, width)
    ends = Window.partitionBy("h").orderBy("g", "d1", "p")
    near = texts.mapInArrow(tidied(_segment_rows(width)), "h long, g long, d1 long, p long")
    for name, f in (("b", F.lag), ("a", F.lead)):
        near = near.withColumn(name, f("g").over(ends))
    near = near.withColumn("crowd", F.sum(F.col("p").bitwiseAND(F.lit(COUNT)) + width - 1).over(Window.partitionBy("h")))
    same = lambda c: F.coalesce(F.col(c) == F.col("g"), F.lit(False))
    other = lambda c: F.coalesce(F.col(c) != F.col("g"), F.lit(False))
    crowded = F.col("p").bitwiseOR(F.when(F.col("crowd") > CROWD, F.lit(CROWDED)).otherwise(F.lit(0)))
    marks = near.select("h", "d1", crowded.alias("p"), (same("b") | same("a")).alias("full"), (other("b") | other("a") | (F.col("p").bitwiseAND(F.lit(SELF)) != 0)).alias("ask")).where("full or ask")
    asked = marks.groupBy("d1").agg(F.collect_list(F.when(F.col("full"), F.col("p").bitwiseAND(F.lit(~(SELF | CROWDED))))).alias("full"), F.collect_list(F.when(F.col("ask"), F.struct("h", F.col("p").bitwiseAND(F.lit(~SELF)).alias("p")))).alias("ask"))
    both = texts.join(asked, "d1", "left")
    cut = both.where(F.size("ask") > 0).select("d1", "d2", "blob", "full", "ask").mapInArrow(tidied(_cut(width)), "h long, d1 long, p long, s binary")
    matched = cut.repartition(partitions(docs.sparkSession), "h").sortWithinPartitions("h", "d1", "p").mapInArrow(tidied(_match(width)), "d1 long, p long")
    alone = both.where(F.exists("ask", lambda x: x["p"].bitwiseAND(F.lit(CROWDED)) != 0)).select("d1", "d2", "blob", "full", "ask").mapInArrow(tidied(_windows(width)), "w1 long, w2 long, d1 long, p long")
    often = alone.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")  # summed before the shuffle, so a common window is no task's burden
    found = matched.unionByName(alone.join(often, ["w1", "w2"], "left_semi").select("d1", "p"))
    extra = found.groupBy("d1").agg(F.collect_list("p").alias("more"))
    done = both.join(extra, "d1", "left").select("d1", "d2", "blob", "full", "more").mapInArrow(tidied(_kept(width, with_text)), "d1 long, d2 long, n_removed long, n_spans long, kept_sha256 string" + ", cleaned string" * with_text)
    times = rows.where(F.col("n_bytes") >= width).groupBy("__d1", "__d2").agg((F.count(F.lit(1)) > 1).alias("__copied"))
    known = done.toDF(*(f"__{c}" for c in done.columns)).dropDuplicates(["__d1", "__d2"]).join(times, ["__d1", "__d2"])
    copied, short = F.col("__copied"), F.col("n_bytes") < width
    return rows.join(known, ["__d1", "__d2"], "left").select(
        id_col, *carry, "n_bytes",
        F.when(short, 0).when(copied, F.col("n_bytes")).otherwise(F.col("__n_removed")).cast("long").alias("n_removed"),
        F.when(short, 0).when(copied, 1).otherwise(F.col("__n_spans")).cast("long").alias("n_spans"),
        F.when(short, F.col("__own")).when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("__kept_sha256")).alias("kept_sha256"),
        *([F.when(~short & copied, F.lit("")).otherwise(F.col("__cleaned")).alias("cleaned")] if with_text else []),
    )


def without_repeats(docs: DataFrame, width: int = 200) -> DataFrame:
    """`docs` (doc_id, text, n_chars and whatever else it has) with every repeated string taken out of the texts.

    No row is dropped: a text may end up empty, and texts that lose nothing, null ones too, stay as they are with their n_chars.
    Repeated rows lose alike. An empty table gives an empty result; columns of any name are kept as they are.
    """
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    found = remove_repeats(packed, width=width, carry=("__row",), with_text=True)
    lost, own = F.col("n_removed") > 0, lambda c: F.col("__row").getField(c)
    new = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return found.select(*[(F.when(lost, new[c]).otherwise(own(c)) if c in new else own(c)).alias(c) for c in docs.columns])
