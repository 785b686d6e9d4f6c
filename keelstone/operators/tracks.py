"""Tracks of moving objects: segments at gaps, lines, geofences, motion and encounters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import Refused
from ..functions.ais import mmsi
from ..functions.geometry import in_polygons, line_wkt, point_wkt, simplified, validate_geofence
from ..functions.text import instant, iso_instant
from ..sources.envelopes import position_faults
from .products import refuse

EARTH_METRES = 6_371_008.8
#: Fixed value: observations of one document for an engine of movement at most.
MAX_FEATURES = 250_000


def without_repeats(rows: DataFrame, key: str, order: list[str], same: list[str]) -> DataFrame:
    """Rows that differ in any of `same` from the one before under the key."""
    w = Window.partitionBy(key).orderBy(*order)
    before = [F.lag(c).over(w).eqNullSafe(F.col(c)) for c in same]
    marked = rows.withColumn("__first", F.row_number().over(w) == 1).withColumn("__same", F.lit(True) if not before else _all(before))
    return marked.where("__first or not __same").drop("__first", "__same")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def segmented(rows: DataFrame, key: str, time: str, tie: str, gap_seconds: float) -> DataFrame:
    """Adds segment_index: a gap strictly longer than `gap_seconds` begins the next segment."""
    if gap_seconds <= 0:
        raise Refused("the gap has to be positive")
    w = Window.partitionBy(key).orderBy(time, tie)
    gap = F.unix_micros(time) - F.lag(F.unix_micros(time)).over(w)
    new = F.when(gap > int(gap_seconds * 1_000_000), 1).otherwise(0)
    return rows.withColumn("__new", new).withColumn("segment_index", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long")).drop("__new")


def trajectories(observations: DataFrame, gap_seconds: float = 7200, tolerance: float = 0.001) -> DataFrame:
    """One row for each object and segment of observations (mmsi, occurred_at, event_id, longitude, latitude): id, times, points, line, simplified line, first and last source."""
    order = ["occurred_at", "event_id"]
    rows = without_repeats(observations, "mmsi", order, ["occurred_at", "longitude", "latitude"])
    rows = segmented(rows, "mmsi", "occurred_at", "event_id", gap_seconds)
    point = F.struct("occurred_at", "event_id", F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    tracks = rows.groupBy("mmsi", "segment_index").agg(F.array_sort(F.collect_list(point)).alias("points"))
    first, last = F.element_at("points", 1), F.element_at("points", -1)
    made = tracks.select(
        F.sha2(F.concat_ws("/", "mmsi", F.col("segment_index").cast("string"), first["event_id"], last["event_id"]), 256).alias("trajectory_id"), "mmsi", "segment_index",
        first["occurred_at"].alias("started_at"), last["occurred_at"].alias("ended_at"), F.size("points").cast("long").alias("point_count"),
        F.when(F.size("points") == 1, "POINT").otherwise("LINESTRING").alias("geometry_type"), line_wkt(F.col("points")).alias("geometry_wkt"),
        simplified(F.transform("points", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))), tolerance).alias("kept"),
        F.lit("EPSG:4326").alias("crs"), first["event_id"].alias("source_first_event_id"), last["event_id"].alias("source_last_event_id"),
    )
    quality = F.to_json(F.struct(F.col("point_count"), F.size("kept").alias("simplified_point_count"), F.lit(float(gap_seconds)).alias("gap_threshold_seconds")))
    return made.withColumn("simplified_wkt", line_wkt(F.col("kept"))).withColumn("quality_json", quality).drop("kept")


def fences(spark, geofences: dict[str, dict]) -> DataFrame:
    """(geofence_id, polygons, low_x, low_y, high_x, high_y) of GeoJSON geofences: a dimension of a deployment's own size."""
    rows = []
    for name, geometry in sorted(geofences.items()):
        polygons = validate_geofence(geometry)
        xs, ys = zip(*[p for rings in polygons for ring in rings for p in ring], strict=True)
        rows.append((name, [[[{"x": x, "y": y} for x, y in ring] for ring in rings] for rings in polygons], min(xs), min(ys), max(xs), max(ys)))
    return spark.createDataFrame(rows, "geofence_id string, polygons array<array<array<struct<x: double, y: double>>>>, low_x double, low_y double, high_x double, high_y double")


def geofence_summary(observations: DataFrame, fence: DataFrame, key: str = "mmsi", cell: float = 1.0) -> DataFrame:
    """Observations inside each fence by object: count, first and last time and their events (of equal times the smallest id).

    Fences and observations meet in cells of `cell` degrees that the fence's box touches, an equi-join that Spark may broadcast
    if the fences are few; the exact test follows.
    """
    grid = lambda c: F.floor(c / cell).cast("long")
    cells = fence.withColumn("cx", F.explode(F.sequence(grid(F.col("low_x")), grid(F.col("high_x"))))).withColumn("cy", F.explode(F.sequence(grid(F.col("low_y")), grid(F.col("high_y")))))
    rows = observations.withColumn("cx", grid(F.col("longitude"))).withColumn("cy", grid(F.col("latitude")))
    box = F.col("longitude").between(F.col("low_x"), F.col("high_x")) & F.col("latitude").between(F.col("low_y"), F.col("high_y"))
    inside = rows.join(cells, ["cx", "cy"]).where(box & in_polygons(F.col("polygons"), F.col("longitude"), F.col("latitude")))
    when = F.unix_micros("occurred_at")
    return inside.groupBy("geofence_id", key).agg(
        F.count(F.lit(1)).alias("observation_count"), F.min("occurred_at").alias("first_seen_at"), F.max("occurred_at").alias("last_seen_at"),
        F.min(F.struct(when, F.col("event_id")))["event_id"].alias("first_event_id"), F.min(F.struct(-when, F.col("event_id")))["event_id"].alias("last_event_id"),
    )


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    s = F.sqrt(a)
    return 2 * EARTH_METRES * F.asin(F.when(s > 1, F.lit(1.0)).otherwise(s))  # least() would make a null position an antipode


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


def motion(observations: DataFrame, key: str = "mmsi", window: int = 1, idle_speed: float = 0.5) -> DataFrame:
    """Per observation: metres, seconds, speed (m/s, averaged over `window` rows), acceleration, bearing from the one before; running distance and time; idle below `idle_speed`."""
    if window < 1:
        raise Refused("the window has at least one row")
    w = Window.partitionBy(key).orderBy("occurred_at", "event_id")
    back = lambda c: F.lag(c).over(w)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = observations.withColumns({
        "segment_metres": F.coalesce(haversine(back("longitude"), back("latitude"), F.col("longitude"), F.col("latitude")), F.lit(0.0)),
        "elapsed_seconds": F.coalesce((F.unix_micros("occurred_at") - back(F.unix_micros("occurred_at"))) / F.lit(1e6), F.lit(0.0)),
        "bearing_degrees": bearing(back("longitude"), back("latitude"), F.col("longitude"), F.col("latitude")),
    })
    rows = rows.withColumn("raw_speed", F.when(F.col("elapsed_seconds") > 0, F.col("segment_metres") / F.col("elapsed_seconds")).otherwise(F.lit(0.0)))
    rows = rows.withColumn("speed", F.avg("raw_speed").over(w.rowsBetween(-(window - 1), 0)))
    return rows.withColumns({
        "acceleration": F.when(F.col("elapsed_seconds") > 0, (F.col("speed") - F.lag("speed").over(w)) / F.col("elapsed_seconds")).otherwise(F.lit(0.0)),
        "cumulative_metres": F.sum("segment_metres").over(run), "cumulative_seconds": F.sum("elapsed_seconds").over(run), "idle": F.col("speed") < idle_speed,
    }).drop("raw_speed")


def reconstructed(observations: DataFrame, key: str = "mmsi", gap_hours: float = 2) -> DataFrame:
    """Tracks split at gaps: points, length and mean speed."""
    rows = segmented(motion(observations, key), key, "occurred_at", "event_id", gap_hours * 3600)
    first = F.row_number().over(Window.partitionBy(key, "segment_index").orderBy("occurred_at", "event_id")) == 1
    rows = rows.withColumn("m", F.when(first, 0.0).otherwise(F.col("segment_metres"))).withColumn("s", F.when(first, 0.0).otherwise(F.col("elapsed_seconds")))
    made = rows.groupBy(key, "segment_index").agg(F.count(F.lit(1)).alias("n_points"), F.min("occurred_at").alias("started_at"), F.max("occurred_at").alias("ended_at"), F.sum("m").alias("length_metres"), F.sum("s").alias("seconds"))
    return made.withColumn("mean_speed", F.when(F.col("seconds") > 0, F.col("length_metres") / F.col("seconds")).otherwise(F.lit(0.0)))


def encounters(observations: DataFrame, distance: float, min_seconds: float, key: str = "mmsi", step_seconds: int = 600, entities: list[str] | None = None) -> DataFrame:
    """(track_a, track_b, started_at, ended_at, n_steps, min_distance): pairs that stay within `distance` (coordinate units) for at least `min_seconds`.

    Each object's last position in every time step is put in a grid of cells of that distance; pairs meet in equal or
    neighbouring cells of the same step (an equi-join), and consecutive steps are one encounter.
    """
    if distance <= 0 or step_seconds <= 0:
        raise Refused("distance and step have to be positive")
    step = F.floor(F.unix_micros("occurred_at") / (step_seconds * 1_000_000)).cast("long")
    last = observations.withColumn("step", step).groupBy(key, "step").agg(F.max_by(F.struct("longitude", "latitude"), F.struct("occurred_at", "event_id")).alias("p"))
    pos = last.select(F.col(key).alias("k"), "step", F.col("p.longitude").alias("x"), F.col("p.latitude").alias("y"))
    pos = pos.withColumns({"cx": F.floor(F.col("x") / distance).cast("long"), "cy": F.floor(F.col("y") / distance).cast("long")})
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    near = pos.withColumn("o", F.explode(around)).select("step", (F.col("cx") + F.col("o.i")).alias("cx"), (F.col("cy") + F.col("o.j")).alias("cy"), F.col("k").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    met = near.join(pos, ["step", "cx", "cy"]).where("a < k").withColumn("d", F.hypot(F.col("ax") - F.col("x"), F.col("ay") - F.col("y"))).where(F.col("d") <= distance)
    if entities is not None:
        met = met.where(F.col("a").isin(*entities) | F.col("k").isin(*entities))
    island = F.col("step") - F.row_number().over(Window.partitionBy("a", "k").orderBy("step"))
    made = met.withColumn("island", island).groupBy("a", "k", "island").agg(F.min("step").alias("s"), F.max("step").alias("e"), F.count(F.lit(1)).alias("n_steps"), F.min("d").alias("min_distance"))
    at = lambda c: F.timestamp_micros(F.col(c) * (step_seconds * 1_000_000))
    return made.where((F.col("e") - F.col("s") + 1) * step_seconds >= min_seconds).select(F.col("a").alias("track_a"), F.col("k").alias("track_b"), at("s").alias("started_at"), (at("e") + F.expr(f"interval {step_seconds} seconds")).alias("ended_at"), "n_steps", "min_distance")


def observation_wkt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("geometry_wkt", point_wkt(F.col("longitude"), F.col("latitude")))


def movement_features(observations: DataFrame) -> DataFrame:
    """(mmsi, occurred_at, feature): every observation as a GeoJSON feature of one line, for engines that read those; written as text, a folder of them has any size.

    Times are timestamps or RFC 3339 text. Refused if a coordinate isn't a number in its range, or an MMSI or time isn't one.
    """
    kinds = dict(observations.dtypes)
    odd = [c for c in ("latitude", "longitude") if kinds.get(c) not in ("double", "float", "int", "bigint")]
    if odd:
        raise Refused(f"{odd} have to be numbers")
    at = instant(F.col("occurred_at")) if kinds["occurred_at"] == "string" else F.col("occurred_at")
    checked = observations.select(F.col("mmsi").alias("given"), mmsi(F.col("mmsi")).alias("mmsi"), at.alias("occurred_at"), F.col("longitude").cast("double").alias("x"), F.col("latitude").cast("double").alias("y"))
    none = F.lit(None).cast("double")
    refuse(checked, F.col("mmsi").isNull() | F.col("occurred_at").isNull() | (F.size(position_faults(F.col("y"), F.col("x"), none, none)) > 0), "observations without a valid MMSI, time or position", "given")
    shape = F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates"))
    told = F.struct("mmsi", iso_instant(F.col("occurred_at")).alias("occurred_at"))
    return checked.select("mmsi", "occurred_at", F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), told.alias("properties"))).alias("feature"))


def feature_collection(features: DataFrame) -> str:
    """One GeoJSON document of 1 to MAX_FEATURES features, by MMSI and time; refused beyond."""
    found = features.orderBy("mmsi", "occurred_at", "feature").select("feature").limit(MAX_FEATURES + 1).collect()
    if not 1 <= len(found) <= MAX_FEATURES:
        raise Refused(f"a document holds 1 to {MAX_FEATURES} observations")
    return f'{{"type":"FeatureCollection","features":[{",".join(r.feature for r in found)}]}}'
