"""Versioned tables over Parquet: every commit is a manifest that lists the folders which are the table from then on.

A manifest is written whole under another name and then takes its own exclusively, so of two writers one has to try again, and one
that dies leaves nothing that readers see. Data goes to a folder of its own first; readers resolve one manifest, so overwriting a table from itself and reading old versions are safe.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ConflictError, Refused

ATTEMPTS = 3


def validate_uri(uri: str) -> str:
    """A path or URI without credentials, query or fragment."""
    if not uri or uri != uri.strip() or re.search(r"[?#]|://[^/]*@", uri):
        raise Refused("a table's place has no credentials, query or fragment")
    return uri.rstrip("/")


class VersionedTable:
    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, validate_uri(uri)
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.uri).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commits(self):
        return self._path(f"{self.uri}/_commits")

    def version(self) -> int:
        """The latest version, -1 if the table doesn't exist."""
        if not self._fs.exists(self._commits()):
            return -1
        names = [s.getPath().getName() for s in self._fs.listStatus(self._commits())]
        return max((int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n)), default=-1)

    def exists(self) -> bool:
        return self.version() >= 0

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        path = self._path(f"{self.uri}/_commits/{version:020d}.json")
        if version < 0 or not self._fs.exists(path):
            raise Refused(f"no version {version} of {self.uri}")
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the latest."""
        m = self.manifest(version)
        schema = self.spark._jvm.org.apache.spark.sql.types.DataType.fromJson(json.dumps(m["schema"])).toDDL()
        if not m["folders"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.uri}/{f}" for f in m["folders"]])

    def _write(self, df: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.uri}/{folder}")
        return folder

    def _commit(self, version: int, folders: list[str], schema, properties: dict) -> bool:
        """False if another writer has taken this version."""
        body = json.dumps({"version": version, "folders": folders, "schema": json.loads(schema.json()), "properties": properties})
        target, draft = (self._path(f"{self.uri}/_commits/{name}") for name in (f"{version:020d}.json", f"{uuid.uuid4().hex}.draft"))
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(body.encode()))
        finally:
            stream.close()
        try:
            return self._publish(draft, target)
        finally:
            self._fs.delete(draft, False)

    def _publish(self, draft, target) -> bool:
        """Give a whole file its name, unless another file has it: by rename, on a local disk, where that would replace it, by a link."""
        if self._fs.getUri().getScheme() != "file":
            return not self._fs.exists(target) and self._fs.rename(draft, target)
        place = lambda p: self.spark._jvm.java.io.File(self._fs.makeQualified(p).toUri().getPath()).toPath()
        try:
            self.spark._jvm.java.nio.file.Files.createLink(place(target), place(draft))
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def overwrite(self, df: DataFrame, **properties) -> int:
        """A version that holds these rows only."""
        folder = self._write(df)
        for _ in range(ATTEMPTS):
            at = self.version() + 1
            known = self.manifest()["properties"] if at else {}
            if known.get("append_only"):
                raise Refused("an append-only table isn't overwritten")
            if self._commit(at, [folder], df.schema, known | properties):
                return at
        raise Refused("other writers were always first")

    def append_new(self, df: DataFrame, key: str, ignore: tuple[str, ...] = ("ingested_at",), append_only: bool = True, **properties) -> tuple[int, int, int]:
        """Insert rows of unknown key: (version, written, already present). Fails on repeated keys in the batch and on known keys with other content."""
        df = df.persist()
        try:
            repeated = [r[0] for r in df.groupBy(key).count().where(f"count > 1 or `{key}` is null").select(key).limit(20).collect()]
            if repeated:
                raise Refused(f"keys that are null or repeated in the batch: {repeated}")
            total = df.count()
            for _ in range(ATTEMPTS):
                at = self.version()
                if at < 0:
                    folders, new, known = [], df, {}
                else:
                    m = self.manifest(at)
                    folders, known = m["folders"], m["properties"]
                    if append_only and not known.get("append_only"):
                        raise Refused("the table isn't append-only")
                    target = self.read(at)
                    reject_conflicts(target, df, key, ignore)
                    new = df.join(target.select(key), key, "left_anti").select(*df.columns)
                written = total if at < 0 else new.count()
                if at >= 0 and not written:
                    return at, 0, total
                folder = self._write(new)
                if self._commit(at + 1, [*folders, folder], df.schema, known | {"append_only": append_only} | properties):
                    return at + 1, written, total - written
            raise Refused("other writers were always first")
        finally:
            df.unpersist()

    def delete_keys(self, keys: DataFrame, key: str) -> tuple[int, int]:
        """A version without the rows of these keys: (version, rows gone). Retention's way; it holds for append-only tables, too."""
        for _ in range(ATTEMPTS):
            at = self.version()
            m, rows = self.manifest(at), self.read(at)
            gone = rows.join(keys.select(key), key, "left_semi").count()
            if not gone:
                return at, 0
            folder = self._write(rows.join(keys.select(key), key, "left_anti").select(*rows.columns))
            if self._commit(at + 1, [folder], rows.schema, m["properties"]):
                return at + 1, gone
        raise Refused("other writers were always first")


def differing(target: DataFrame, source: DataFrame, key: str, ignore: tuple[str, ...] = ("ingested_at",)) -> DataFrame:
    """The keys that both have with different content in any column but the ignored ones."""
    columns = [c for c in source.columns if c in target.columns and c != key and c not in ignore]
    other = target.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in columns])
    changed: Column = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns], F.lit(False))
    return source.join(other, key).where(changed).select(key)


def reject_conflicts(target: DataFrame, source: DataFrame, key: str, ignore: tuple[str, ...] = ("ingested_at",), named: int = 20) -> None:
    bad = sorted(str(r[0]) for r in differing(target, source, key, ignore).limit(named).collect())
    if bad:
        raise ConflictError(bad)
