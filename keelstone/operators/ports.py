"""Port statistics: facts of calls, gate scans and bookings, key figures with quantiles, and rows for what has no data."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import Refused
from ..functions.canonical import canonical_json
from ..functions.text import digest_key, hours_between, in_period, matches
from ..sources.envelopes import UNREADABLE, found_faults, where_read, with_domain_fields

#: Event types.
CALL, SCAN, BOOKING = "ports.port-call.v1", "ports.gate.scan.v1", "ports.booking.created.v1"
#: The statuses of a call, and those that count it: it has been accepted.
STATUSES = ("DRAFT", "SUBMITTED", "ACCEPTED", "ARRIVED", "BERTHED", "DEPARTED", "COMPLETED", "REJECTED")
COUNTED = ("ACCEPTED", "ARRIVED", "BERTHED", "DEPARTED", "COMPLETED")
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "keelstone:port-statistics")
SALT = "keelstone/vessel"


@dataclass(frozen=True)
class Kpi:
    kpi_id: str
    unit: str
    percentiles: tuple[str | None, ...] = (None,)
    gap: str | None = None  # why it can't be computed
    version: str = "1.0.0"


#: Key figures and their units; the two with a gap lack source data.
KPIS = (
    Kpi("vessel_calls", "calls"),
    Kpi("vessel_turnaround_hours", "hours", ("P50", "P90")),
    Kpi("waiting_time_hours", "hours", ("P50", "P90")),
    Kpi("berth_occupancy_pct", "percent", gap="no authoritative number of berths"),
    Kpi("throughput_tonnes", "tonnes"),
    Kpi("truck_gate_turnaround_minutes", "minutes", ("P50",)),
    Kpi("booking_lead_time_hours", "hours", ("P50",)),
    Kpi("slot_utilisation_pct", "percent"),
    Kpi("declaration_clearance_hours", "hours", gap="declarations aren't bridged into this scope"),
)


def definitions_hash() -> str:
    return hashlib.sha256(canonical_json([asdict(k) for k in KPIS]).encode()).hexdigest()


def run_id(root: str, period: str, versions: dict[str, int]) -> str:
    """The same inputs always give the same run."""
    return str(uuid.uuid5(NAMESPACE, canonical_json({"root": root.rstrip("/"), "period": period, "versions": versions, "definitions": definitions_hash()})))


#: Fields of the events, with the kind of JSON value that each has to be.
CALL_FIELDS = {"portCallId": "text!", "portCode": "text!", "status": "text!", "vesselRef": "text", "shipClass": "text", "arrivedAt": "instant", "berthedAt": "instant", "departedAt": "instant", "declaredTonnage": "number"}
SCAN_FIELDS = {"truckRef": "text", "truck_plate": "text", "direction": "text!", "terminal": "text", "terminalReference": "text", "portCode": "text"}
BOOKING_FIELDS = {"bookingId": "text", "portCode": "text", "createdAt": "instant", "slotWindowStart": "instant", "bookedSlots": "number", "offeredSlots": "number"}


def _checked(events: DataFrame, kind: str, fields: dict[str, str], more, what: str) -> DataFrame:
    """Events of a kind as (event_id, occurred_at, f). One pass looks for a fault in any of them, or in the payload of any other event; more: further rules, fault by predicate over `f`."""
    read = with_domain_fields(events, fields)
    own = F.col("event_type") == kind
    rules = F.coalesce(F.col("fault"), *[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in more(F.col("f")).items()])
    fault = F.when(own, rules).when(F.col("fault").isin(*UNREADABLE), F.col("fault"))
    if bad := found_faults(read, fault):
        raise Refused(f"{what}: {bad}")
    return read.where(own).select("event_id", "occurred_at", "f")


def last_known(value: Column, at: Column) -> Column:
    """Of a group the last value that isn't null."""
    return F.max_by(value, F.when(value.isNotNull(), at))


def call_facts(events: DataFrame, period: str) -> DataFrame:
    """One row for each port call of the period: the latest status by (occurred_at, event_id), of every attribute the last value that isn't null. Calls that aren't accepted are facts, too."""
    rows = _checked(events, CALL, CALL_FIELDS, lambda f: {"portCode": ~matches(f["portCode"], "port_code"), "status": ~f["status"].isin(*STATUSES)}, "port calls")
    f, at = F.col("f"), F.struct("occurred_at", "event_id")
    last = lambda value, name: last_known(f[value], at).alias(name)
    calls = rows.groupBy(f["portCallId"].alias("port_call_id")).agg(
        F.max(f["portCode"]).alias("other"), F.min(f["portCode"]).alias("port_code"), F.max_by(f["status"], at).alias("status"), F.max("occurred_at").alias("latest"),
        last("vesselRef", "vessel_ref"), last("shipClass", "ship_class"), last("arrivedAt", "arrived_at"), last("berthedAt", "berthed_at"),
        last("departedAt", "departed_at"), last("declaredTonnage", "declared_tonnage"), F.to_json(F.array_sort(F.collect_list("event_id"))).alias("source_event_ids_json"),
    )
    moved = [r[0] for r in calls.where("port_code != other").select("port_call_id").limit(5).collect()]
    if moved:
        raise Refused(f"port calls that changed their port: {moved}")
    hashed = F.when(F.col("vessel_ref").isNotNull(), F.sha2(F.concat_ws("/", F.lit(SALT), "vessel_ref"), 256)).alias("vessel_ref_hashed")
    return calls.where(in_period(F.coalesce("arrived_at", "latest"), period)).select("port_call_id", "port_code", hashed, "ship_class", "status", "arrived_at", "berthed_at", "departed_at", "declared_tonnage", "source_event_ids_json")


def gate_scans(events: DataFrame, period: str) -> DataFrame:
    """Scans of the period: truck, terminal (empty if none), direction, port."""
    truck = lambda f: F.coalesce(f["truckRef"], f["truck_plate"])
    rows = _checked(events.where(in_period(F.col("occurred_at"), period)), SCAN, SCAN_FIELDS, lambda f: {"truck": truck(f).isNull(), "direction": ~f["direction"].isin("in", "out")}, "gate scans")
    f = F.col("f")
    return rows.select("event_id", "occurred_at", truck(f).alias("truck"), f["direction"].alias("direction"), F.coalesce(f["terminal"], f["terminalReference"], F.lit("")).alias("terminal"), f["portCode"].alias("port_code"))


def gate_turnarounds(scans: DataFrame) -> DataFrame:
    """(port_code, minutes) from a scan in to the scan out that follows it, by truck and terminal; the port is that of the scan out."""
    w = Window.partitionBy("truck", "terminal").orderBy("occurred_at", "event_id")
    pairs = scans.withColumns({"was": F.lag("direction").over(w), "since": F.lag("occurred_at").over(w)}).where("was = 'in' and direction = 'out'")
    return pairs.select("port_code", (hours_between(F.col("since"), F.col("occurred_at")) * 60).alias("value"))


def bookings(events: DataFrame, period: str) -> DataFrame:
    """Bookings whose slot begins in the period, with the hours from creation to it. Those without a slot are left out; a slot before the creation, or counters that aren't a share of an offer, are refused."""

    def rules(f: Column) -> dict[str, Column]:
        here = F.coalesce(in_period(f["slotWindowStart"], period), F.lit(False))
        both = here & f["bookedSlots"].isNotNull() & f["offeredSlots"].isNotNull()
        return {"slotWindowStart": here & (f["slotWindowStart"] < F.coalesce(f["createdAt"], F.col("occurred_at"))), "slots": F.coalesce(both & ((f["offeredSlots"] <= 0) | (f["bookedSlots"] < 0)), F.lit(False))}

    rows = _checked(events, BOOKING, BOOKING_FIELDS, rules, "bookings")
    f = F.col("f")
    made = rows.select("event_id", F.coalesce(f["bookingId"], "event_id").alias("booking_id"), f["portCode"].alias("port_code"), F.coalesce(f["createdAt"], F.col("occurred_at")).alias("created_at"), f["slotWindowStart"].alias("slot_at"), f["bookedSlots"].alias("booked"), f["offeredSlots"].alias("offered"))
    return where_read(made, in_period(F.col("slot_at"), period)).withColumn("lead_hours", hours_between(F.col("created_at"), F.col("slot_at")))


def quantiles(rows: DataFrame, kpi: str, value: str, names: tuple[str, ...]) -> DataFrame:
    """Exact type-7 quantiles by port, one row each."""
    of = {"P50": 0.5, "P90": 0.9}
    made = rows.where(F.col(value).isNotNull()).groupBy("port_code").agg(F.percentile(value, [of[n] for n in names]).alias("q"), F.count(F.lit(1)).alias("n"))
    return made.select(F.lit(kpi).alias("kpi_id"), "port_code", F.lit(None).cast("string").alias("ship_class"), F.posexplode("q").alias("k", "value"), "n").select("kpi_id", "port_code", "ship_class", F.element_at(F.lit(list(names)), F.col("k") + 1).alias("percentile"), F.round("value", 6).alias("value"), F.col("n").alias("n_observations"))


def observations(facts: DataFrame, scans: DataFrame, booked: DataFrame) -> DataFrame:
    """(kpi_id, port_code, ship_class, percentile, value, n_observations) of everything that has data; of calls only the accepted count."""
    none = F.lit(None).cast("string")
    single = lambda df, kpi, value, n, ship=none: df.select(F.lit(kpi).alias("kpi_id"), "port_code", ship.alias("ship_class"), none.alias("percentile"), F.round(value, 6).alias("value"), n.cast("long").alias("n_observations"))
    counted = facts.where(F.col("status").isin(*COUNTED))
    calls = counted.groupingSets([["port_code", "ship_class"], ["port_code"]], "port_code", "ship_class").agg(F.count(F.lit(1)).alias("n"), F.grouping("ship_class").alias("whole")).where("whole = 1 or ship_class is not null")
    hours = counted.withColumns({"turnaround": F.when(F.col("departed_at") >= F.col("arrived_at"), hours_between(F.col("arrived_at"), F.col("departed_at"))), "waiting": F.when(F.col("berthed_at") >= F.col("arrived_at"), hours_between(F.col("arrived_at"), F.col("berthed_at")))})
    tonnes = counted.where("declared_tonnage is not null").groupBy("port_code").agg(F.sum(F.col("declared_tonnage").cast("decimal(28,6)")).cast("double").alias("v"), F.count(F.lit(1)).alias("n"))
    slots = booked.where("booked is not null and offered is not null").groupBy("port_code").agg(*[F.sum(F.col(c).cast("decimal(28,6)")).cast("double").alias(a) for c, a in (("booked", "b"), ("offered", "o"))], F.count(F.lit(1)).alias("n"))
    parts = [
        single(calls, "vessel_calls", F.col("n").cast("double"), F.col("n"), F.col("ship_class")),
        quantiles(hours, "vessel_turnaround_hours", "turnaround", ("P50", "P90")),
        quantiles(hours, "waiting_time_hours", "waiting", ("P50", "P90")),
        single(tonnes, "throughput_tonnes", F.col("v"), F.col("n")),
        quantiles(gate_turnarounds(scans), "truck_gate_turnaround_minutes", "value", ("P50",)),
        quantiles(booked, "booking_lead_time_hours", "lead_hours", ("P50",)),
        single(slots, "slot_utilisation_pct", 100 * F.col("b") / F.col("o"), F.col("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ports_of(facts: DataFrame, scans: DataFrame, booked: DataFrame) -> DataFrame:
    """All ports that anything names; one null port if nothing does."""
    named = facts.select("port_code").union(scans.select("port_code")).union(booked.select("port_code")).where("port_code is not null").distinct()
    nothing = facts.sparkSession.range(1).select(F.lit(None).cast("string").alias("port_code"))
    return named.unionByName(nothing.join(named.limit(1).select(F.lit(1).alias("x")), F.lit(True), "left_anti"))


def value_rows(spark: SparkSession, found: DataFrame, ports: DataFrame, run: str, period: str) -> DataFrame:
    """A row for each key figure, percentile and port, with a note where there is no data; and a key that replays share."""
    grid = spark.createDataFrame([(k.kpi_id, k.unit, k.version, p, k.gap) for k in KPIS for p in (k.percentiles if not k.gap else (None,))], "kpi_id string, unit string, definition_version string, percentile string, gap string")
    dense = grid.crossJoin(F.broadcast(ports))  # a dozen figures by the ports
    f = found.alias("f")
    on = (dense["kpi_id"] == f["kpi_id"]) & dense["port_code"].eqNullSafe(f["port_code"]) & dense["percentile"].eqNullSafe(f["percentile"])
    rows = dense.join(f, on, "left").select(dense["kpi_id"], "unit", "definition_version", dense["percentile"], dense["port_code"], "f.ship_class", "f.value", F.coalesce("f.n_observations", F.lit(0)).alias("n_observations"), F.when(F.col("gap").isNotNull(), F.concat(F.lit("GAP: "), "gap")).when(F.col("f.value").isNull(), F.lit("NO_DATA")).alias("note"))
    rows = rows.withColumns({"run_id": F.lit(run), "period": F.lit(period)})
    return rows.withColumn("value_key", digest_key(*[F.col(c) for c in ("run_id", "kpi_id", "period", "port_code", "ship_class", "percentile")]))


def run_statistics(silver, period: str, root: str, version: int | None = None) -> tuple[str, DataFrame, DataFrame]:
    """(run id, facts, value rows) of one month over a pinned version of the silver table (a VersionedTable)."""
    version = silver.version() if version is None else version
    events = silver.read(version).select("event_id", "event_type", "occurred_at", "payload_json")
    facts, scans, booked = call_facts(events, period), gate_scans(events, period), bookings(events, period)
    run = run_id(root, period, {"silver": version})
    values = value_rows(events.sparkSession, observations(facts, scans, booked), ports_of(facts, scans, booked), run, period)
    return run, facts.withColumn("run_id", F.lit(run)), values


