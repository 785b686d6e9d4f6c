"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import logging
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's own. Only a master on this machine (tests) may do without one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    return named or "/tmp/keelstone-checkpoints"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's shared folder; set one only where none is set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them from there from now on; the files go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/keelstone/{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is still there."""
    try:
        jvm = spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended before
        logging.getLogger(__name__).info("left behind: %s", path)


def numbered(columns: list[Column], docs: DataFrame) -> DataFrame:
    """The columns under names c0, c1, ... of our own, so that none can clash."""
    return docs.select(*[c.alias(f"c{k}") for k, c in enumerate(columns)])


def row_digest(docs: DataFrame) -> list[Column]:
    """128 bits over all columns of a row, nulls told from empty values."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    columns = [F.to_json(F.struct(c)) if "map<" in t else c for c, (_, t) in zip(columns, docs.dtypes, strict=True)]
    absent = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return [F.xxhash64(F.lit(seed), absent, *columns) for seed in (31, 32)]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc32(column: str) -> Column:
    """CRC-32 of an id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def as_binary(array) -> pa.Array:
    """A string or binary Arrow column as binary, nulls as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not (pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type)):
        array = array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary())
    return array.fill_null(b"") if array.null_count else array


def tidied(run):
    """A batch function that gives memory back when its partition ends: workers live on, and several share an executor."""

    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)

    return tidy


def raw(array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column laid end to end, and where each value starts (one more than values)."""
    array = as_binary(array)
    wide = pa.types.is_large_binary(array.type)
    _, starts, data = array.buffers()
    starts = np.frombuffer(starts, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if len(array) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def blocks(starts: np.ndarray, most: int):
    """Runs [a, b) of consecutive values of at most `most` bytes together; a longer value stands alone."""
    a, n = 0, len(starts) - 1
    while a < n:
        b = int(np.searchsorted(starts, starts[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
