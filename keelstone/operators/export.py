"""GeoParquet export with a lineage sidecar."""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import Refused
from ..functions.geometry import wkt_to_wkb
from ..sources.storage import export_target

#: Fixed value: rows of an export at most; a larger one is written with `export_folder`.
MAX_ROWS = 1_000_000
PIECE = 4 << 20


def with_geometry(rows: DataFrame, wkt_col: str) -> DataFrame:
    """Columns by name, geometry as WKB last; refused if a geometry can't be read."""
    made = rows.withColumn("__g", wkt_to_wkb(wkt_col))
    bad = [r[0] for r in made.where("__g.fault is not null").select("__g.fault").limit(5).collect()]
    if bad:
        raise Refused(f"geometries that can't be read: {bad}")
    others = sorted(c for c in rows.columns if c != wkt_col)
    return made.select(*others, F.col("__g.wkb").alias("geometry"), F.col("__g").alias("__g"))


def extent(made: DataFrame) -> tuple[list[float], list[str], int]:
    """Bounding box, geometry types and number of rows."""
    r = made.agg(F.min("__g.min_x"), F.min("__g.min_y"), F.max("__g.max_x"), F.max("__g.max_y"), F.collect_set("__g.kind"), F.count(F.lit(1))).first()
    names = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon", "MULTIPOLYGON": "MultiPolygon"}
    return list(r[:4]), sorted(names[k] for k in r[4]), r[5]


def id_range(rows: DataFrame, columns: list[str]) -> tuple[str | None, str | None]:
    """Smallest and largest id over several columns."""
    if not columns:
        return None, None
    low = [F.min(F.col(c).cast("string")) for c in columns]
    high = [F.max(F.col(c).cast("string")) for c in columns]
    r = rows.agg(*low, *high).first()
    some = [x for x in r if x is not None]
    return (min(some), max(some)) if some else (None, None)


def geo_metadata(box: list[float], kinds: list[str]) -> bytes:
    return json.dumps({"version": "1.0.0", "primary_column": "geometry", "columns": {"geometry": {"encoding": "WKB", "geometry_types": kinds, "bbox": box}}}).encode()


def quality_metrics(rows: DataFrame) -> dict:
    """What a lineage says about the rows: their number, and as far as they have the columns, objects, points of tracks before and after simplification, and observations in geofences."""
    parts = {"row_count": F.count(F.lit(1))}
    if "mmsi" in rows.columns:
        parts["distinct_mmsi"] = F.count_distinct("mmsi")
    if "quality_json" in rows.columns:
        points = lambda name: F.coalesce(F.sum(F.get_json_object("quality_json", f"$.{name}").cast("long")), F.lit(0))
        parts |= {"segments_with_quality": F.count("quality_json"), "total_track_points": points("point_count"), "simplified_track_points": points("simplified_point_count")}
    if "observation_count" in rows.columns:
        parts["geofence_observations"] = F.coalesce(F.sum(F.col("observation_count").cast("long")), F.lit(0))
    found = rows.agg(*[c.alias(name) for name, c in parts.items()]).first().asDict()
    if found.get("segments_with_quality"):
        total = found["total_track_points"]
        return {k: v for k, v in found.items() if v or "track" in k or k == "row_count"} | {"simplification_ratio": round(found["simplified_track_points"] / total, 6) if total else 1.0}
    return {k: v for k, v in found.items() if v or k == "row_count"}


def put(spark: SparkSession, path: str, content) -> None:
    """Write bytes to a file of any file system that Hadoop reaches, piece by piece."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        for at in range(0, len(content), PIECE):
            stream.write(bytearray(content[at : at + PIECE]))
    finally:
        stream.close()


def export_geoparquet(rows: DataFrame, wkt_col: str, path: str, source: str, source_version: int, id_columns: list[str] = (), env: dict[str, str] | None = None) -> dict:
    """One file of at most MAX_ROWS rows, whose footer says where its geometry is, and `path`.lineage.json, written last. With `env` the path has to lie in the storage that it names."""
    path = path if env is None else export_target(path, env)
    made = with_geometry(rows, wkt_col)
    box, kinds, n = extent(made)
    if not 1 <= n <= MAX_ROWS:
        raise Refused(f"{n} rows; 1 to {MAX_ROWS} can be exported")
    table = made.drop("__g").toArrow()
    sink = pa.BufferOutputStream()
    pq.write_table(table.replace_schema_metadata((table.schema.metadata or {}) | {b"geo": geo_metadata(box, kinds)}), sink, compression="zstd")
    content = memoryview(sink.getvalue())
    put(rows.sparkSession, path, content)
    first, last = id_range(rows, list(id_columns))
    digest = hashlib.sha256(content).hexdigest()
    lineage = {"source": source, "source_version": source_version, "rows": n, "bbox": box, "geometry_types": kinds, "first_id": first, "last_id": last, "sha256": digest, "quality": quality_metrics(rows), "exported_at": datetime.now(UTC).isoformat()}
    put(rows.sparkSession, f"{path}.lineage.json", json.dumps(lineage, sort_keys=True).encode())
    return lineage


def export_folder(rows: DataFrame, wkt_col: str, path: str) -> tuple[list[float], list[str], int]:
    """Any number of rows, as a folder of files that executors write; the geometry's metadata goes beside them."""
    made = with_geometry(rows, wkt_col)
    made.drop("__g").write.option("compression", "zstd").parquet(path)
    return extent(made)


