"""Vessel observations from signed payloads: raw sentences are authoritative, stated coordinates have to agree with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ais import decode_reports, mmsi, sentence_valid
from ..functions.geometry import point_wkt
from ..sources.envelopes import position_faults, with_domain_fields
from ..sources.tables import VersionedTable
from .products import refuse

KIND = "vessels.observation.v1"
#: Fixed value: degrees by which stated and decoded coordinates may differ.
AGREEMENT = 1e-3
FIELDS = {"mmsi": "word", "latitude": "number", "longitude": "number", "speedKnots": "number", "headingDegrees": "number", "nmeaSentences": "texts"}
#: Columns of an event that its bronze row keeps.
CARRIED = ("producer", "source_record_reference", "payload_json")
DESCRIPTION = "Vessel observations, one for each accepted event; rows are only added"


def observations(events: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Typed bronze rows of vessel events, with the `carried` columns of the events; any payload that breaks a rule is refused."""
    rows = with_domain_fields(events.where(F.col("event_type") == KIND), FIELDS)
    refuse(rows, F.col("fault").isNotNull(), "payloads that can't be read")
    f = F.col("f")
    raw = F.size(F.coalesce(f["nmeaSentences"], F.array().cast("array<string>"))) > 0
    rows = rows.withColumn("r", F.when(raw, decode_reports(f["nmeaSentences"])))
    r = F.col("r")
    refuse(rows, raw & (F.exists(f["nmeaSentences"], lambda s: ~sentence_valid(s)) | r["fault"].isNotNull() | r["latitude"].isNull()), "sentences that can't be read")
    far = lambda a, b: a.isNotNull() & (F.abs(a - b) > AGREEMENT)
    refuse(rows, raw & (far(f["latitude"], r["latitude"]) | far(f["longitude"], r["longitude"]) | (f["mmsi"].isNotNull() & (f["mmsi"] != r["mmsi"]))), "payloads that disagree with their sentences")
    made = rows.select(
        "event_id", F.coalesce(r["mmsi"], mmsi(f["mmsi"])).alias("mmsi"), "occurred_at", F.coalesce(r["latitude"], f["latitude"]).alias("latitude"), F.coalesce(r["longitude"], f["longitude"]).alias("longitude"),
        F.coalesce(r["speed_knots"], f["speedKnots"]).alias("speed_knots"), F.coalesce(r["heading_degrees"], f["headingDegrees"]).alias("heading_degrees"), r["course_degrees"].alias("course_degrees"), r["message_type"].alias("message_type"),
        F.when(raw, "ais-nmea").otherwise("payload").alias("decode_source"), *carried,
    )
    faults = position_faults(F.col("latitude"), F.col("longitude"), F.col("speed_knots"), F.col("heading_degrees"))
    refuse(made, F.col("mmsi").isNull() | (F.size(faults) > 0), "observations without a valid position or MMSI")
    return made.withColumn("geometry_wkt", point_wkt(F.col("longitude"), F.col("latitude")))


def append_observations(table: VersionedTable, events: DataFrame) -> tuple[int, int, int]:
    """Add the typed rows of new vessel events to their bronze table: (version, written, already present). A replay writes nothing, a known event with other content fails."""
    made = observations(events, CARRIED).withColumn("ingested_at", F.current_timestamp())
    return table.append_new(made, "event_id", description=DESCRIPTION)
