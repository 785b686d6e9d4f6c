"""Byte-level BPE: overlapping chunks pre-tokenised in parallel, stitched where their boundaries meet, encoded piece by piece."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, tidied

#: Characters of a chunk, and how far it looks into the next one.
CHUNK, OVERLAP = 32_768, 2_048
#: Pieces whose ids a worker remembers.
REMEMBERED = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class _Memory(dict):
    """Ids of a piece as little-endian 32-bit integers, kept for the pieces met first."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = np.asarray(self.encode(piece.encode()), "<u4").tobytes()
        if len(self) < REMEMBERED:
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder for one rank file and pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import tiktoken

        self.find = regex.compile(pattern)
        self.whole = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.memory = _Memory(self.whole._encode_single_piece)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece

    def ends(self, text: str) -> list[int]:
        """Where each pre-token ends; what the pattern skips belongs to none."""
        return [m.end() for m in self.find.finditer(text)]

    def encode(self, text: str) -> bytes:
        """Ids of a chunk, or of a part of one between two pre-token boundaries: a pre-token that ends a text ends it alone, too."""
        return self.whole.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def encode_pieces(self, text: str) -> bytes:
        """Ids of a text of any length, whose pre-tokens may be of any length."""
        return b"".join(self.memory[m.group()] for m in self.find.finditer(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    if shared.id not in _codecs:
        _codecs.clear()
        _codecs[shared.id] = Codec(*shared.value)
    return _codecs[shared.id]


class _Shared:
    """Ranks and pattern, sent once to each executor (a vocabulary file: about a megabyte)."""

    def __init__(self, spark, path: str, pattern: str):
        self.broadcast = spark.sparkContext.broadcast((read_ranks(path), pattern))
        self.id = f"{path}\0{pattern}"

    @property
    def value(self):
        return self.broadcast.value


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col="doc_id", text_col="text", carry: tuple[str, ...] = (), with_ids: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row: n_tokens, ids_sha256, decoded_sha256, the columns of `carry`, and with `with_ids` the ids as an array.

    Texts of up to `chunk` characters are encoded where they are read. Longer ones are cut into chunks that overlap; chunks are
    dealt over the cluster and pre-tokenised alone, two neighbours are stitched at the first boundary that both have in their
    overlap (from there on both must agree), and each chunk's pieces are encoded apart. A document in which two neighbours share
    no boundary, such as one enormous word, is encoded in one go. Null and empty texts have no tokens; repeated rows are each
    reported; other columns are ignored.
    """
    shared = _Shared(docs.sparkSession, path, pattern)
    kept = [id_col, *carry]
    rows = docs.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    result = f"{head}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    short = rows.where(F.length("__text") <= chunk).mapInArrow(tidied(_encode_short(shared, len(kept), with_ids)), result)
    return short.unionByName(_encode_long(rows.where(F.length("__text") > chunk), shared, kept, result, with_ids, chunk, overlap))


def _digests(codec: Codec, ids: bytes) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()


def _id_lists(found: list[bytes]) -> pa.Array:
    starts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(found), "<i4")))


def _encode_short(shared, width: int, with_ids: bool):
    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [codec.encode(t.as_py()) for t in part.column(width)]
                n, a, b = zip(*(_digests(codec, x) for x in found), strict=True)
                more = [_id_lists(found)] if with_ids else []
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(width)), pa.array(n, pa.int64()), pa.array(a), pa.array(b), *more], [*part.schema.names[:width], "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])

    return run


def _encode_long(rows: DataFrame, shared, kept: list[str], result: str, with_ids: bool, chunk: int, overlap: int) -> DataFrame:
    keyed = rows.select(F.struct(*kept).alias("row"), F.xxhash64("__text").alias("a"), F.xxhash64(F.lit(1), "__text").alias("b"), F.col("__text").alias("t"))
    row = keyed.schema["row"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                text, one = batch.column(3)[k].as_py(), batch.slice(k, 1)
                for at in range(0, len(text), chunk):
                    yield pa.RecordBatch.from_arrays([*(one.column(j) for j in range(3)), pa.array([at // chunk], pa.int64()), pa.array([at + chunk >= len(text)]), pa.array([text[at : at + chunk + overlap]])], ["row", "a", "b", "k", "last", "t"])

    def boundaries(batches):
        codec = _codec(shared)
        for batch in batches:
            heads, tails = [], []
            for text, last in zip(batch.column(5).to_pylist(), batch.column(4).to_pylist(), strict=True):
                ends = [0, *codec.ends(text)]
                sure = [e for e in ends if last or e < len(text)]  # the last pre-token may go on
                heads.append([e for e in sure if e <= overlap])
                tails.append([e - chunk for e in sure if e >= chunk])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], [*batch.schema.names, "heads", "tails"])

    chunks = keyed.mapInArrow(tidied(cut), f"row {row}, a long, b long, k long, last boolean, t string").repartition(partitions(rows.sparkSession), "row", "a", "b", "k")
    found = chunks.mapInArrow(tidied(boundaries), f"row {row}, a long, b long, k long, last boolean, t string, heads array<int>, tails array<int>").dropDuplicates(["row", "a", "b", "k"])
    times = keyed.groupBy("row", "a", "b").agg(F.count(F.lit(1)).alias("times"))
    w = Window.partitionBy("row", "a", "b").orderBy("k")
    met = lambda tails, heads: F.array_min(F.array_intersect(tails, heads))
    stitched = found.withColumn("first", F.when(F.col("k") == 0, F.lit(0)).otherwise(met(F.lag("tails").over(w), F.col("heads")))).withColumn("stop", F.when(F.col("last"), F.length("t")).otherwise(F.lit(chunk) + met(F.col("tails"), F.lead("heads").over(w))))

    def pieces(batches):
        codec = _codec(shared)
        for batch in batches:
            at = {n: batch.column(n).to_pylist() for n in ("t", "first", "stop")}
            ids = [None if f is None or s is None else codec.encode(t[f:s]) for t, f, s in zip(at["t"], at["first"], at["stop"], strict=True)]
            text = [t[:chunk] for t in at["t"]]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("row", "a", "b", "k", "times")), pa.array(text), pa.array(ids, pa.binary())], ["row", "a", "b", "k", "times", "t", "ids"])

    spread = stitched.drop("heads", "tails", "last").join(times, ["row", "a", "b"]).select("row", "a", "b", "k", "times", "t", "first", "stop").repartition(partitions(rows.sparkSession), "row", "a", "b", "k")
    encoded = spread.mapInArrow(tidied(pieces), f"row {row}, a long, b long, k long, times long, t string, ids binary")

    def whole(table: pa.Table) -> pa.Table:
        codec, table = _codec(shared), table.sort_by("k")
        ids = table.column("ids").to_pylist()
        ids = codec.encode_pieces("".join(table.column("t").to_pylist())) if None in ids else b"".join(ids)
        times, row = table.column("times")[0].as_py(), table.column("row").combine_chunks().slice(0, 1)
        row = row.chunk(0) if isinstance(row, pa.ChunkedArray) else row
        digests = [[x] for x in _digests(codec, ids)] + ([_id_lists([ids])] if with_ids else [])
        out = pa.table([*row.flatten(), *digests], [*kept, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])
        return pa.concat_tables([out] * times)

    return encoded.groupBy("row", "a", "b").applyInArrow(whole, result)
