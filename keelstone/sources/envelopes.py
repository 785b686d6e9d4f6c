"""Signed event envelopes: scan, rules, and the row that an envelope becomes."""

from __future__ import annotations

import os
import stat

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import Refused
from ..functions.canonical import to_canonical_json
from ..functions.text import instant, is_canonical_text, matches

#: Limits of a batch, in bytes and records.
MAX_FILE, MAX_LINE, MAX_PAYLOAD, MAX_RECORDS = 256 << 20, 2 << 20, 1 << 20, 100_000
#: Vocabularies of an envelope.
CLASSIFICATIONS = ("FIDUCIARY_SEGREGATED", "CONFIDENTIAL", "RESTRICTED", "INTERNAL", "PUBLIC")
CLEARANCES = ("UNCLASSIFIED", "RESTRICTED", "CONFIDENTIAL", "SECRET")
#: What of a resource is carriage, not domain data.
CARRIAGE = ("resourceType", "id", "code", "extension", "provenance", "meta", "text")
#: End of the address of the extension that holds a domain record; a deployment may set its whole address.
DOMAIN_PAYLOAD = "/StructureDefinition/domain-payload"
#: Faults of a payload as a whole, of which no field can be told.
UNREADABLE = ("payload", "extension", "domain-payload")

PROVENANCE = "struct<principalId: string, principalRole: string, signature: string, ledgerCommitHash: string>"
ENVELOPE = f"struct<envelopeVersion: string, eventId: string, eventType: string, occurredAt: string, producer: string, correlationId: string, fhir: struct<resourceType: string, type: string, entry: array<struct<resource: string>>>, provenance: {PROVENANCE}, classification: string, recordClassification: string>"
KEYS = ("envelopeVersion", "eventId", "eventType", "occurredAt", "producer", "correlationId", "fhir", "provenance", "classification", "recordClassification")
EVENT_COLUMNS = ("event_id", "event_type", "producer", "occurred_at", "recorded_at", "data_classification", "source_system", "source_record_reference", "correlation_id", "payload_json", "ingested_at", "record_classification")


def require_regular_file(path: str, most: int = MAX_FILE) -> str:
    """A file that isn't a link and has 1 to `most` bytes."""
    s = os.lstat(path)
    if not stat.S_ISREG(s.st_mode) or not 1 <= s.st_size <= most:
        raise Refused(f"not a regular file of 1 to {most} bytes: {path}")
    return path


def scan_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """(line): one JSON document a line; blank lines are skipped."""
    return spark.read.text(path).withColumnRenamed("value", "line").where(F.trim("line") != "")


def parsed(lines: DataFrame) -> DataFrame:
    """The envelope `e` of each line, and the keys it has."""
    options = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false"}
    return lines.withColumn("e", F.from_json("line", ENVELOPE, options)).withColumn("keys", F.json_object_keys("line"))


def faults() -> Column:
    """What is wrong with an envelope: an array of rule names, empty if nothing is. Every rule is a predicate over `line`, `e` and `keys`."""
    e, p = F.col("e"), F.col("e.provenance")
    short = lambda c: F.coalesce(F.length(c).between(1, 256), F.lit(False))
    rules = {
        "size": F.octet_length("line") <= MAX_LINE,
        "document": F.col("keys").isNotNull() & e.isNotNull(),
        "keys": F.coalesce((F.size(F.array_except("keys", F.lit(list(KEYS)))) == 0) & (F.size(F.array_distinct("keys")) == F.size("keys")), F.lit(False)),
        "version": F.coalesce(e["envelopeVersion"] == "1.0", F.lit(False)),
        "event_id": matches(e["eventId"], "uuid"),
        "event_type": matches(e["eventType"], "event_type"),
        "occurred_at": instant(e["occurredAt"]).isNotNull(),
        "producer": short(e["producer"]),
        "correlation_id": short(e["correlationId"]),
        "bundle": F.coalesce((e["fhir"]["resourceType"] == "Bundle") & (e["fhir"]["type"] == "message") & (F.size(e["fhir"]["entry"]) >= 1) & F.json_object_keys(e["fhir"]["entry"][0]["resource"]).isNotNull(), F.lit(False)),
        "provenance": F.coalesce(short(p["principalId"]) & short(p["principalRole"]) & p["signature"].rlike(r"\A[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\z"), F.lit(False)),
        "classification": F.coalesce(e["classification"].isin(*CLASSIFICATIONS), F.lit(False)),
        "record_classification": F.coalesce(e["recordClassification"].isin(*CLEARANCES), e["recordClassification"].isNull()),
    }
    return F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())


def _members(v: Column, *names: str) -> Column:
    """A struct of the members of these names, each as a variant or null if it isn't there; null if the value isn't an object. A path to a member that isn't there would cost a thrown exception for each row."""
    return F.try_variant_get(v, "$", f"struct<{', '.join(f'`{n}`: variant' for n in names)}>")


def _kind(v: Column) -> Column:
    """What a JSON value is (STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, OBJECT<..>, ARRAY<..>, VOID for null); null where there is none."""
    return F.schema_of_variant(v)


#: How a field of a kind is read, and told from the JSON kind it has and what was read. A null or missing field is null.
READERS = {
    "text": (lambda v: F.try_variant_get(v, "$", "string"), lambda k, x: (k == "STRING") & (F.trim(x) != "")),
    "number": (lambda v: F.try_variant_get(v, "$", "double"), lambda k, x: F.substring(k, 1, 6).isin("BIGINT", "DECIMA", "DOUBLE", "FLOAT")),
    "whole": (lambda v: F.try_variant_get(v, "$", "long"), lambda k, x: k == "BIGINT"),
    "instant": (lambda v: instant(F.try_variant_get(v, "$", "string")), lambda k, x: (k == "STRING") & x.isNotNull()),
    "flag": (lambda v: (_kind(v) == "BOOLEAN") & F.try_variant_get(v, "$", "boolean"), lambda k, x: F.lit(True)),
    "object": (lambda v: F.to_json(v), lambda k, x: k.startswith("OBJECT")),
    "array": (lambda v: F.to_json(v), lambda k, x: k.startswith("ARRAY")),
    "texts": (lambda v: F.try_variant_get(v, "$", "array<string>"), lambda k, x: k.startswith("ARRAY")),
    "word": (lambda v: F.try_variant_get(v, "$", "string"), lambda k, x: k.isin("STRING", "BIGINT")),
}


def with_domain_fields(events: DataFrame, fields: dict[str, str], payload: str = "payload_json", extension: str = DOMAIN_PAYLOAD) -> DataFrame:
    """Adds `f`, the typed domain fields of a payload, and `fault`, the first thing that is wrong with it or null.

    fields: the kind of each (see READERS), with a ! after it if the field has to be there. The record is the resource's own fields
    but those of carriage, overridden in turn by the documents of its domain-payload extensions; a null overrides, too. A payload
    or document that isn't a JSON object, an extension that isn't a list of objects, or one without its document is a fault.

    Each step is a column of its own that the next ones use more than once, so the optimiser doesn't write it out again. Below a
    filter it would: `found_faults` and `where_read` are for that.
    """
    v, own, listed, ext, docs = F.col("__v"), F.col("__own"), F.col("__listed"), F.col("__ext"), F.col("__docs")
    x, k, t = (lambda name, kind=kind: F.col(f"`__{kind}_{name}`") for kind in "xkt")
    text = lambda x: F.try_variant_get(x, "$", "string")
    ours = lambda e: F.coalesce(text(e["url"]).endswith(extension), F.lit(False))
    document = lambda e: _members(F.try_parse_json(F.when(_kind(e["valueString"]) == "STRING", text(e["valueString"]))), *fields)
    given = lambda name: F.lit(None).cast("variant") if name in CARRIAGE else own[name]
    having = lambda name: lambda d: d[name].isNotNull()
    last = lambda name: F.try_element_at(F.filter(docs, having(name)), F.lit(-1))
    present = lambda name: k(name).isNotNull() & (k(name) != "VOID")
    rows = events.withColumn("__v", F.try_parse_json(payload)).withColumn("__own", _members(v, "extension", *[n for n in fields if n not in CARRIAGE])).withColumn("__listed", _kind(own["extension"]))
    # the extensions, each null if it isn't an object, and the documents of ours likewise
    rows = rows.withColumn("__ext", F.when(listed != "VOID", F.transform(F.try_variant_get(own["extension"], "$", "array<variant>"), lambda e: _members(e, "url", "valueString"))))
    rows = rows.withColumn("__docs", F.when(ext.isNotNull(), F.transform(F.filter(ext, ours), document)))
    rows = rows.withColumns({f"__x_{n}": F.when(F.coalesce(F.exists(docs, having(n)), F.lit(False)), last(n)[n]).otherwise(given(n)) for n in fields})
    rows = rows.withColumns({f"__k_{n}": _kind(x(n)) for n in fields})
    rows = rows.withColumns({f"__t_{n}": F.when(present(n), READERS[kind.removesuffix("!")][0](x(n))) for n, kind in fields.items()})
    opens = F.substring(F.ltrim(F.col(payload), F.lit(" \t\r\n")), 1, 1) == "{"  # what parses and opens so is an object
    faults = [
        F.when(~F.coalesce(v.isNotNull() & opens, F.lit(False)), F.lit("payload")),
        F.when((listed != "VOID") & (ext.isNull() | F.exists(ext, F.isnull)), F.lit("extension")),
        F.when(docs.isNotNull() & F.exists(docs, F.isnull), F.lit("domain-payload")),
    ]
    for n, kind in fields.items():
        told = F.coalesce(READERS[kind.removesuffix("!")][1](k(n), t(n)), F.lit(False))
        faults.append(F.when(F.when(present(n), ~told).otherwise(F.lit(kind.endswith("!"))), F.lit(n)))
    rows = rows.withColumns({"fault": F.coalesce(*faults), "f": F.struct(*[t(n).alias(n) for n in fields])})
    return rows.drop("__v", "__own", "__listed", "__ext", "__docs", *[f"__{kind}_{n}" for n in fields for kind in "xkt"])


def where_read(rows: DataFrame, condition: Column) -> DataFrame:
    """The rows of a condition over fields that have been read. A plain filter would be moved below the reading, and read them again; none passes what a generator has made."""
    return rows.withColumn("__where", F.explode(F.array(condition))).where("__where").drop("__where")


def found_faults(read: DataFrame, fault: Column, most: int = 5) -> list[tuple[str, str]]:
    """A few (event_id, fault) of the rows that have a fault. They are counted first, over all partitions at once; only if there are any another pass names some."""
    told = read.select("event_id", fault.alias("fault"))
    if not told.agg(F.count("fault")).first()[0]:
        return []
    return [(r[0], r[1]) for r in where_read(told, F.col("fault").isNotNull()).limit(most).collect()]


def event_columns(ingested_at: Column, source_system: str = "event-stream") -> list[Column]:
    """Columns of an internal row, from the envelope `e`. The payload is the first resource with the provenance added, as canonical JSON."""
    e = F.col("e")
    resource = e["fhir"]["entry"][0]["resource"]
    body = F.concat(F.regexp_replace(resource, r"\}\s*\z", ""), F.when(F.size(F.json_object_keys(resource)) > 0, F.lit(",")).otherwise(F.lit("")), F.lit('"provenance":'), F.to_json(e["provenance"]), F.lit("}"))
    occurred = instant(e["occurredAt"])
    return [
        e["eventId"].alias("event_id"), e["eventType"].alias("event_type"), e["producer"].alias("producer"), occurred.alias("occurred_at"), occurred.alias("recorded_at"),
        e["classification"].alias("data_classification"), F.lit(source_system).alias("source_system"), e["eventId"].alias("source_record_reference"), e["correlationId"].alias("correlation_id"),
        to_canonical_json(body).alias("payload_json"), ingested_at.alias("ingested_at"), e["recordClassification"].alias("record_classification"),
    ]


def to_events(envelopes: DataFrame, ingested_at: Column, source_system: str = "event-stream") -> DataFrame:
    """Internal rows of valid envelopes."""
    return envelopes.select(*event_columns(ingested_at, source_system))


def event_faults(row: str = "") -> Column:
    """What is wrong with an internal row; `row` is the prefix of its columns."""
    c = lambda name: F.col(f"{row}{name}")
    rules = {
        "payload": F.coalesce(F.octet_length(c("payload_json")) <= MAX_PAYLOAD, F.lit(False)),
        "order": F.coalesce(c("recorded_at") >= c("occurred_at"), F.lit(False)),
        "producer": is_canonical_text(c("producer"), 256),
        "correlation_id": c("correlation_id").isNull() | is_canonical_text(c("correlation_id"), 256),
    }
    return F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())


def position_faults(lat: Column, lon: Column, speed: Column, heading: Column) -> Column:
    """Null-safe range rules of a position; speed and heading may be absent."""
    ok = lambda c, low, high: F.coalesce(c.between(low, high) & ~F.isnan(c), F.lit(False))
    rules = {"latitude": ok(lat, -90, 90), "longitude": ok(lon, -180, 180), "speed": speed.isNull() | ok(speed, 0, 102.2), "heading": heading.isNull() | (ok(heading, 0, 360) & (heading < 360))}
    return F.filter(F.array(*[F.when(~r, F.lit(n)) for n, r in rules.items()]), lambda x: x.isNotNull())


def read_events(spark: SparkSession, path: str, ingested_at: Column, most: int = MAX_RECORDS) -> DataFrame:
    """All rows of an NDJSON file, or none: the first faults are named, and so are repeated ids."""
    checked = parsed(scan_ndjson(spark, require_regular_file(path))).withColumn("faults", faults())
    if checked.limit(most + 1).count() > most:
        raise Refused(f"more than {most} records")
    bad = checked.where(F.size("faults") > 0).select("e.eventId", "faults").limit(5).collect()
    if bad:
        raise Refused(f"invalid envelopes: {[(r[0], r[1]) for r in bad]}")
    events = to_events(checked, ingested_at)
    bad = events.withColumn("faults", event_faults()).where(F.size("faults") > 0).select("event_id", "faults").limit(5).collect()
    repeated = events.groupBy("event_id").count().where("count > 1").limit(5).collect()
    if bad or repeated:
        raise Refused(f"invalid rows: {[tuple(r) for r in bad]}; repeated ids: {[r[0] for r in repeated]}")
    return events
