"""Operators against hand-computed expectations, refusals and replays."""

import hashlib
import json
from datetime import UTC, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from keelstone.errors import AccessError, BoundaryError, ConflictError, Refused
from keelstone.functions import signing
from keelstone.operators import export, governance, ports, products, retention, serving, tracks
from keelstone.sources import envelopes
from keelstone.sources.tables import VersionedTable
from keelstone.streaming import ingest

T0 = datetime(2026, 3, 1, tzinfo=UTC)
EVENT = "event_id string, event_type string, occurred_at timestamp, payload_json string, record_classification string"


def events(spark, rows):
    """Rows of (type, payload, hours after T0, clearance)."""
    data = [(f"e{k:02d}", t, T0 + timedelta(hours=h), json.dumps(p), c) for k, (t, p, h, c) in enumerate(rows)]
    return spark.createDataFrame(data, EVENT)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ---- tables


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert not t.exists() and t.version() == -1
    with pytest.raises(Refused):
        t.read()
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert t.append_new(a, "k") == (0, 2, 0)
    assert t.append_new(a, "k") == (0, 0, 2)
    assert t.append_new(spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string"), "k") == (1, 1, 1)
    assert t.read().count() == 3 and t.read(0).count() == 2
    with pytest.raises(ConflictError, match="2"):
        t.append_new(spark.createDataFrame([(2, "x")], "k int, v string"), "k")
    with pytest.raises(Refused):
        t.append_new(spark.createDataFrame([(7, "x"), (7, "x")], "k int, v string"), "k")
    with pytest.raises(Refused):
        t.overwrite(a)
    assert t.delete_keys(a.where("k = 1"), "k") == (2, 1)
    assert rows(t.read(), "k") == [(2,), (3,)] and t.read(1).count() == 3


def test_overwrite_from_itself_and_lost_races(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.overwrite(spark.range(3))
    t.overwrite(t.read().where("id > 0"))
    assert t.read().count() == 2
    assert not t._commit(1, [], t.read().schema, {})  # taken
    for bad in ("s3://user:pw@x/y", "/a?b", "", " /a"):
        with pytest.raises(Refused):
            VersionedTable(spark, bad)


# ---- envelopes and streaming


def envelope(k=1, kind="ports.gate.scan.v1", label="INTERNAL", **more):
    resource = {"resourceType": "Basic", "truckRef": f"t{k}", "extension": [{"url": "https://x/StructureDefinition/domain-payload", "valueString": json.dumps({"direction": "in", "n": 2})}]}
    doc = {"envelopeVersion": "1.0", "eventId": f"00000000-0000-4000-8000-{k:012d}", "eventType": kind, "occurredAt": "2026-03-01T10:00:00+01:00", "producer": "p", "correlationId": "c", "fhir": {"resourceType": "Bundle", "type": "message", "entry": [{"resource": resource}]}, "provenance": {"principalId": "p", "principalRole": "r", "ledgerCommitHash": "ab" * 32}, "classification": label}
    return signing.signed_envelope(doc | more, bytes(range(32)), "k")


def test_read_events(spark, tmp_path):
    f = tmp_path / "in.ndjson"
    f.write_text("\n".join([json.dumps(envelope(1)), "", json.dumps(envelope(2, recordClassification="SECRET"))]))
    got = envelopes.read_events(spark, str(f), F.lit(T0)).orderBy("event_id").collect()
    assert len(got) == 2 and got[0].occurred_at == datetime(2026, 3, 1, 9) and got[1].record_classification == "SECRET"
    body = json.loads(got[0].payload_json)
    assert body["truckRef"] == "t1" and body["provenance"]["principalId"] == "p"
    fields = envelopes.read_events(spark, str(f), F.lit(T0)).transform(lambda e: envelopes.with_domain_fields(e, {"truckRef": "text", "direction": "text!", "n": "whole"})).first().f
    assert (fields.truckRef, fields.direction, fields.n) == ("t1", "in", 2)
    f.write_text(json.dumps(envelope(1)) + "\n" + json.dumps(envelope(1)))
    with pytest.raises(Refused, match="repeated"):
        envelopes.read_events(spark, str(f), F.lit(T0))
    (tmp_path / "link").symlink_to(f)
    with pytest.raises(Refused):
        envelopes.read_events(spark, str(tmp_path / "link"), F.lit(T0))


@pytest.mark.parametrize(("change", "rule"), [({"extra": 1}, "keys"), ({"envelopeVersion": "2"}, "version"), ({"eventId": "x"}, "event_id"), ({"eventType": "X"}, "event_type"), ({"occurredAt": "2026-03-01"}, "occurred_at"), ({"producer": ""}, "producer"), ({"fhir": {}}, "bundle"), ({"provenance": {}}, "provenance"), ({"classification": "SECRET"}, "classification"), ({"recordClassification": "TOP"}, "record_classification")])
def test_envelope_rules(spark, change, rule):
    lines = spark.createDataFrame([(json.dumps(envelope() | change),)], "line string")
    assert envelopes.parsed(lines).select(envelopes.faults().alias("f")).first().f == [rule]


def test_positions(spark):
    fault = lambda *v: spark.range(1).select(envelopes.position_faults(*[F.lit(x).cast("double") for x in v]).alias("f")).first().f
    assert fault(1, 2, None, None) == [] and fault(91, 2, None, 360) == ["latitude", "heading"] and fault(None, float("nan"), -1, 0) == ["latitude", "longitude", "speed"]


def test_stream_to_bronze_and_quarantine(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    forged = envelope(4) | {"producer": "someone"}
    (folder / "a.json").write_text("\n".join([json.dumps(envelope(1)), json.dumps(envelope(2)), "{oops", json.dumps(envelope(3) | {"extra": 1}), json.dumps(forged), json.dumps(envelope(1))]))
    bronze, dlq = (VersionedTable(spark, str(tmp_path / n)) for n in ("b", "q"))
    scope = governance.Scope("platform", str(tmp_path / "lake"))
    go = lambda n: ingest.start(ingest.file_lines(spark, str(folder), "ports.gate"), scope, bronze, dlq, str(tmp_path / n), {"k": signing.public_key(bytes(range(32)))}).awaitTermination()
    go("c1")
    assert bronze.read().count() == 2 and {r.data_classification for r in bronze.read().collect()} == {"internal"}
    reasons = sorted(r.reason for r in dlq.read().collect())
    assert reasons == ["malformed-json", "payload-mismatch", "schema-violation"] or reasons == ["duplicate-in-batch", "malformed-json", "payload-mismatch", "schema-violation"]
    go("c1")
    go("c2")  # a replay from the start changes nothing
    assert bronze.read().count() == 2 and len(dlq.read().collect()) == len(reasons)


# ---- governance


def test_scopes(spark, tmp_path):
    label = lambda c, t: spark.range(1).select(governance.internal_label(F.lit(c), F.lit(t)).alias("x")).first().x
    assert label("INTERNAL", "ports.gate.scan.v1") == "internal" and label("CONFIDENTIAL", "mrv.soc.v1") == "mrv_confidential"
    assert label("FIDUCIARY_SEGREGATED", "cvff.disbursement.v1") == "fiduciary_segregated"
    assert label("FIDUCIARY_SEGREGATED", "ports.x.v1") is None and label("INTERNAL", "cvff.x.v1") is None and label("ODD", "ports.x.v1") is None
    assert governance.Scope("mrv", "/lake/root").table("gold", "vessel_annual") == "/lake/root/mrv_gold/vessel_annual"
    with pytest.raises(BoundaryError):
        governance.Scope("mrv", "/lake/cvff_bronze")
    scope = governance.Scope("isr", str(tmp_path))
    df = spark.createDataFrame([("isr_classified", "SECRET"), ("isr_classified", None)], "data_classification string, record_classification string")
    for bad in (df, df.limit(0), df.withColumn("data_classification", F.lit("public"))):
        with pytest.raises(BoundaryError):
            scope.check(bad)
    assert scope.check(df.limit(1), "maritime.isr.tracks").count() == 1
    with pytest.raises(BoundaryError):
        scope.check(df.limit(1), "ports.x")


def test_access(spark, tmp_path):
    policy = governance.Policy({"analyst": governance.whole_scope("isr"), "insurer": governance.whole_scope("isr", "gold")})
    policy.authorize(["insurer"], "isr_gold", "CONFIDENTIAL")
    for roles, schema, clearance in ((["insurer"], "isr_silver", "SECRET"), (["analyst"], "isr_silver", "CONFIDENTIAL"), (["nobody"], "isr_gold", "SECRET"), ([], "isr_gold", "SECRET"), (["analyst"], "isr_gold", "odd"), (["analyst"], "x_gold", "SECRET")):
        with pytest.raises(AccessError):
            policy.authorize(roles, schema, clearance)
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.overwrite(spark.createDataFrame([(1, "SECRET"), (2, "confidential"), (3, None), (4, "odd")], "k int, record_classification string"))
    assert rows(policy.read(t, ["analyst"], "isr_gold", "CONFIDENTIAL"), "k") == [(2,)]


def test_roles_only_read():
    policy = governance.Policy({"desk": governance.whole_scope("platform", "gold"), "isr": governance.whole_scope("isr")})
    policy.authorize(["desk"], "platform_gold")
    assert policy.readable(["desk", "isr"]) == {"platform_gold", "isr_bronze", "isr_silver", "isr_gold"}
    for call in (
        lambda: policy.authorize_write(["desk"], "platform_gold"), lambda: policy.authorize_write(["nobody"], "platform_gold"), lambda: policy.authorize(["isr"], "isr_gold"),
        lambda: policy.authorize([" desk"], "platform_gold"), lambda: policy.authorize(["desk"], "platform_gold", "odd"), lambda: policy.readable([]),
    ):
        with pytest.raises(AccessError):
            call()


# ---- port statistics


def call(i, port, status, **f):
    return {"portCallId": i, "portCode": port, "status": status, **f}


def at(h):
    return (T0 + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M:%SZ")


def port_events(spark):
    c, s, b = ports.CALL, ports.SCAN, ports.BOOKING
    record = json.dumps({"status": "BERTHED", "berthedAt": at(7), "shipClass": None})
    return events(spark, [
        (c, call("q1", "XKQRS", "SUBMITTED", vesselRef="ship-17", shipClass="tanker", arrivedAt=at(2), declaredTonnage=731.25), 0, None),
        (c, {"resourceType": "Basic", "code": "x", "id": "y", **call("q1", "XKQRS", "DRAFT"), "extension": [{"url": "urn:other"}, {"url": "https://example.org/StructureDefinition/domain-payload", "valueString": record}]}, 7, None),
        (c, call("q2", "XKQRS", "COMPLETED", shipClass="tanker", arrivedAt=at(3), berthedAt=at(4), departedAt=at(9.5), declaredTonnage=12), 9, None),
        (c, call("q3", "XKQRS", "DEPARTED", shipClass="ferry", arrivedAt=at(5), berthedAt=at(4), departedAt=at(18)), 18, None),  # berthed before it arrived: no waiting time
        (c, call("q4", "XKQRS", "REJECTED", shipClass="ferry", arrivedAt=at(1), berthedAt=at(2), departedAt=at(3), declaredTonnage=9999.0), 3, None),
        (c, call("q5", "XKQRS", "DRAFT"), 4, None), (c, call("q6", "YLTUV", "SUBMITTED", arrivedAt=at(1), departedAt=at(9), declaredTonnage=5.5), 1, None),
        (c, call("q7", "XKQRS", "ARRIVED", arrivedAt=at(24 * 33)), 6, None),
        *[(s, {"truckRef": "lorry", "direction": d, "terminal": "north", "portCode": "XKQRS"}, h, None) for d, h in (("out", 0), ("in", 1), ("in", 2), ("out", 2.75), ("out", 3))], (s, {"truck_plate": "van", "direction": "out", "portCode": "YLTUV"}, 1, None),
        (b, {"bookingId": "m", "portCode": "YLTUV", "createdAt": at(6), "slotWindowStart": at(17), "bookedSlots": 3, "offeredSlots": 8}, 0, None), (b, {"portCode": "YLTUV", "slotWindowStart": at(30), "bookedSlots": 0, "offeredSlots": 5.0}, 10, None),
        (b, {"portCode": "YLTUV", "slotWindowStart": at(25), "bookedSlots": 4}, 2, None), (b, {"portCode": "YLTUV"}, 2, None), (b, {"portCode": "YLTUV", "slotWindowStart": at(-9999), "offeredSlots": 0, "bookedSlots": 1}, 2, None),
    ])


def test_port_statistics(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "silver"))
    t.overwrite(port_events(spark))
    run, facts, values = ports.run_statistics(t, "2026-03", "/lake")
    assert run == ports.run_statistics(t, "2026-03", "/lake/")[0]
    assert rows(facts, "port_call_id", "status", "ship_class", "declared_tonnage")[:1] == [("q1", "BERTHED", "tanker", 731.25)] and facts.count() == 6
    v = {(r.kpi_id, r.port_code, r.ship_class, r.percentile): (r.value, r.n_observations, r.note) for r in values.collect()}
    x = lambda k, s=None, p=None: v[k, "XKQRS", s, p][:2]
    y = lambda k, s=None, p=None: v[k, "YLTUV", s, p]
    assert x("vessel_calls") == (3, 3) and x("vessel_calls", "tanker") == (2, 2) and x("vessel_calls", "ferry") == (1, 1)  # neither the rejected call nor the draft
    assert x("vessel_turnaround_hours", p="P50") == (9.75, 2) and x("vessel_turnaround_hours", p="P90") == (12.35, 2)
    assert x("waiting_time_hours", p="P50") == (3.0, 2) and x("throughput_tonnes") == (743.25, 2)
    assert x("truck_gate_turnaround_minutes", p="P50") == (45.0, 1) and y("truck_gate_turnaround_minutes", p="P50") == (None, 0, "NO_DATA")
    assert y("vessel_calls") == y("throughput_tonnes") == (None, 0, "NO_DATA")
    assert y("booking_lead_time_hours", p="P50")[:2] == (20.0, 3) and y("slot_utilisation_pct")[:2] == (23.076923, 2)
    assert v["berth_occupancy_pct", "XKQRS", None, None][2].startswith("GAP")
    assert values.select("value_key").distinct().count() == values.count()
    _, _, nothing = ports.run_statistics(t, "2020-01", "/lake")
    assert {(r.port_code, r.value) for r in nothing.collect()} == {(None, None)} and nothing.select("kpi_id").distinct().count() == 9


GOOD = {ports.CALL: call("z", "XKQRS", "ARRIVED"), ports.SCAN: {"truckRef": "t", "direction": "in"}, ports.BOOKING: {"portCode": "XKQRS", "slotWindowStart": at(5), "bookedSlots": 1, "offeredSlots": 2}}


def refused(spark, f, bad):
    """Each of the events (type, payload) is refused by name; five go together, as so many are named."""
    for k in range(0, len(bad), 5):
        some = events(spark, [(t, p, 0, "SECRET") for t, p in bad[k : k + 5]])
        with pytest.raises(Refused) as e:
            f(some)
        assert all(f"e{n:02d}" in str(e.value) for n in range(len(bad[k : k + 5]))), (k, str(e.value))


PAYLOAD = "u/StructureDefinition/domain-payload"
CHANGES = {
    ports.CALL: ({"portCode": "xkqrs"}, {"portCallId": " "}, {"portCallId": None}, {"status": "CLOSED"}, {"status": "A"}, {"declaredTonnage": "7"}, {"declaredTonnage": True}, {"arrivedAt": "2026-03-01"}, {"shipClass": 4}, {"extension": {}}, {"extension": ["x"]}, {"extension": [{"url": PAYLOAD}]}, {"extension": [{"url": PAYLOAD, "valueString": "[1]"}]}, {"extension": [{"url": PAYLOAD, "valueString": "{"}]}, {"extension": [{"url": PAYLOAD, "valueString": '{"status": null}'}]}),
    ports.SCAN: ({"truckRef": None}, {"direction": "up"}, {"terminal": 1}),
    ports.BOOKING: ({"createdAt": at(9)}, {"offeredSlots": 0}, {"bookedSlots": -1}, {"slotWindowStart": 9}, {"slotWindowStart": "soon"}),
}


@pytest.mark.parametrize("kind", [ports.CALL, ports.SCAN, ports.BOOKING])
def test_port_refusals(spark, kind):
    f = {ports.CALL: ports.call_facts, ports.SCAN: ports.gate_scans, ports.BOOKING: ports.bookings}[kind]
    assert f(events(spark, [(kind, GOOD[kind], 0, None)]), "2026-03").count() == 1
    refused(spark, lambda e: f(e, "2026-03"), [(kind, GOOD[kind] | c) for c in CHANGES[kind]])


def test_a_call_stays_in_its_port(spark):
    with pytest.raises(Refused, match="changed"):
        ports.call_facts(events(spark, [(ports.CALL, call("z", p, "ARRIVED"), k, None) for k, p in enumerate(("XKQRS", "YLTUV"))]), "2026-03")
    with pytest.raises(Refused):  # an event of another kind that can't be read
        ports.call_facts(events(spark, [(ports.CALL, GOOD[ports.CALL], 0, None)]).unionByName(events(spark, [("ports.other.v1", [], 0, None)])), "2026-03")


# ---- products


def test_ledger(spark):
    h = "ab" * 32
    e = events(spark, [("cvff.x.v1", {"ledgerCommitHash": h}, 0, None), ("cvff.x.v1", {"provenance": {"ledgerCommitHash": h}}, 1, None)]).withColumns({"source_system": F.lit("s"), "kafka_topic": F.lit("cvff.x"), "kafka_partition": F.lit(0), "kafka_offset": F.lit(7), "ingested_at": F.lit(T0)})
    silver = products.silver_rows(e, ledger=True)
    r = products.ledger_rollup(silver).first()
    assert (r.record_count, json.loads(r.event_ids_json), json.loads(r.source_systems_json)) == (2, ["e00", "e01"], ["s"])
    with pytest.raises(Refused):
        products.silver_rows(e.withColumn("payload_json", F.lit("{}")), ledger=True)


def annual(i, state="VERIFIED", **more):
    return {"reportId": i, "imoNumber": "7654321", "calendarYear": 2031, "state": state, "attainedCii": 4.75, "ciiRating": "D", "totals": {"n": [2], "co2Tonnes": 31.125, "a": {"z": 1, "b": None}}, **more}


def test_vessel_annual(spark):
    soc = {"reportId": "second", "artifactSha256": "0f" * 32}
    r = products.vessel_annual(events(spark, [(products.ANNUAL, annual("first"), 0, None), (products.ANNUAL, annual("second"), 1, None), (products.ANNUAL, {"state": "DRAFT", "calendarYear": "odd"}, 2, None), (products.STATEMENT, soc | {"artifactSha256": "11" * 32}, 2, None), (products.STATEMENT, soc, 3, None)])).collect()
    assert len(r) == 1 and (r[0].report_id, r[0].co2_tonnes, r[0].soc_artifact_sha256, json.loads(r[0].source_event_ids_json)) == ("second", 31.125, "0f" * 32, ["e01", "e04"])
    assert r[0].fuel_totals_json == '{"a":{"b":null,"z":1},"co2Tonnes":31.125,"n":[2]}' and r[0].attained_cii == 4.75 and r[0].required_cii is None
    changes = ({"imoNumber": "765432"}, {"ciiRating": "Z"}, {"totals": None}, {"totals": [1]}, {"totals": {"co2Tonnes": "31"}}, {"calendarYear": "2031"}, {"calendarYear": 1999}, {"calendarYear": 2031.5}, {"attainedCii": False}, {"reportId": ""})
    refused(spark, products.annual_reports, [(products.ANNUAL, annual("r") | c) for c in changes])
    refused(spark, products.statements, [(products.STATEMENT, soc | {"artifactSha256": "0F" * 32}), (products.STATEMENT, {"artifactSha256": "0f" * 32})])
    with pytest.raises(Refused, match="second"):  # of an older report
        products.vessel_annual(events(spark, [(products.ANNUAL, annual("second"), 0, None), (products.ANNUAL, annual("third"), 1, None), (products.STATEMENT, soc, 2, None)]))


RETIRED = {"retirementId": "w", "projectId": "mangrove", "beneficiary": "someone", "purpose": "offset", "quantityKgCo2e": 41.5, "artifactSha256": "5a" * 32}


def test_public_registry(spark):
    block = lambda i, s, q, v="2027", **x: {"blockId": i, "projectId": "mangrove", "vintage": v, "status": s, "quantityKgCo2e": q, **x}
    e = [(products.PROJECT, {"projectId": "mangrove", "projectName": "before", "state": "DRAFT"}, 0, None), (products.PROJECT, {"projectId": "mangrove", "projectName": "after", "state": "LISTED", "strataCentroids": [[1, 2.5]], "privatePhone": "x"}, 1, None)]
    e += [(products.BLOCK, b, 2 + k, None) for k, b in enumerate((block("a", "ACTIVE", 7), block("a", "RETIRED", 41.5), block("b", "CANCELLED", 0.25), block("c", "ACTIVE", 3.5, bufferPool=True), block("d", "ACTIVE", 2, "2026", bufferPool="yes"), block("f", "RETIRED", 100, bufferPool=True)))]
    e += [(products.RETIREMENT, RETIRED, 9, None), (products.RETIREMENT, RETIRED | {"retirementId": "v", "retiredAt": "soon"}, 9, None)]
    made = products.public_registry(events(spark, e))
    r = made.first()
    assert (r.project_name, r.state, r.buffer_balance_kg_co2e, r.strata_centroids_json) == ("after", "LISTED", 3.5, "[[1,2.5]]") and "private" not in str(r).lower()
    assert r.vintage_totals_json == '[{"vintage":"2026","issued_kg_co2e":2.0,"retired_kg_co2e":0.0,"cancelled_kg_co2e":0.0},{"vintage":"2027","issued_kg_co2e":145.25,"retired_kg_co2e":141.5,"cancelled_kg_co2e":0.25}]'
    found = json.loads(r.retirements_json)
    assert [x["retirement_id"] for x in found] == ["v", "w"] and found[1] == {"retirement_id": "w", "serial": None, "beneficiary": "someone", "purpose": "offset", "quantity_kg_co2e": 41.5, "artifact_sha256": "5a" * 32, "retired_at": None}
    assert json.loads(r.source_event_ids_json) == ["e01", "e03", "e04", "e05", "e06", "e07", "e08", "e09"]
    refused(spark, products.credit_blocks, [(products.BLOCK, b) for b in (block("a", "SOLD", 1), block("a", "ACTIVE", -1), block("a", "ACTIVE", "1"), block("", "ACTIVE", 1))])
    refused(spark, products.retirements, [(products.RETIREMENT, {k: v for k, v in RETIRED.items() if k != gone}) for gone in ("beneficiary", "purpose", "artifactSha256", "quantityKgCo2e", "projectId")])
    refused(spark, products.public_registry, [(products.PROJECT, {"projectId": "p"})])


def test_excise(spark):
    a, p, i, t = products.ASSESSED, products.APPROVED, products.ISSUED, products.ACTIVATED
    carried = {"extension": [{"url": "urn:x/StructureDefinition/domain-payload", "valueString": json.dumps({"batchId": "nine", "quantity": 17})}], "quantity": 3}
    got = rows(products.excise_facts(events(spark, [(a, {"assessmentId": "m", "totalDutyKobo": 0, "stampsRequired": 88}, 0, None), (p, {"declarationRef": "d", "totalDutyKobo": 5}, 1, None), (i, carried, 2, None), (t, {"activatedCount": 6}, 3, None), ("stamps.other.v1", {}, 4, None)])), "event_id", "batch_id", "total_duty_kobo", "quantity")
    assert got == [("e00", "", 0, 88), ("e01", "", None, None), ("e02", "nine", None, 17), ("e03", "", None, 6)]
    text = {"extension": [{"url": "urn:x/StructureDefinition/domain-payload", "valueString": json.dumps({"quantity": "17"})}]}
    refused(spark, products.excise_facts, [(a, {"totalDutyKobo": 3.5, "stampsRequired": 1}), (a, {"totalDutyKobo": -2, "stampsRequired": 1}), (a, {"totalDutyKobo": "4", "stampsRequired": 1}), (a, {"stampsRequired": 1}), (a, {"totalDutyKobo": False, "stampsRequired": 1}), (a, {"totalDutyKobo": 1}), (i, {"quantity": 0}), (i, text), (t, {"activatedCount": -1})])


def test_consignments(spark):
    c = {"consignmentId": "lot-7.b"}
    e = [("fisheries.catch.landed.v1", c | {"speciesCode": "SOL", "catchWeightKg": 0}, 0, "UNCLASSIFIED"), *[("fisheries.custody.moved.v1", c, h, "RESTRICTED") for h in (1, 2, 3)], ("coldchain.temperature.v1", c | {"temperatureCelsius": 4}, 2.5, "CONFIDENTIAL"), ("coldchain.temperature.v1", c | {"temperatureCelsius": -1.75}, 2.000001, None), *[("export.declared.v1", c | {"exportReference": x}, h, "RESTRICTED") for x, h in (("late", 9), ("early", 8))]]
    e[5] = (*e[5][:3], "SECRET")
    a, b = (products.consignments(events(spark, e).orderBy(F.desc("event_id") if back else "event_id")).first() for back in (False, True))
    assert a == b and (a.custody_event_count, a.coldchain_sample_count, a.min_temperature_celsius, a.max_temperature_celsius, a.export_reference, a.record_classification) == (3, 2, -1.75, 4.0, "late", "SECRET")
    written = [(i, (T0 + timedelta(hours=h)).isoformat(), t) for i, h, t in (("e05", 2.000001, -1.75), ("e04", 2.5, 4.0))]
    assert a.coldchain_digest_sha256 == hashlib.sha256(json.dumps([{"event_id": i, "occurred_at": w, "temperature_celsius": t} for i, w, t in written], sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert json.loads(a.source_event_ids_json) == [f"e{k:02d}" for k in range(8)]
    refused(spark, products.consignments, [("coldchain.temperature.v1", c | {"temperatureCelsius": 60.5}), ("fisheries.licence.v1", c), ("ports.export.v1", c), ("export.declared.v1", c), ("fisheries.custody.v1", {"consignmentId": "-x"}), ("fisheries.catch.v1", c | {"speciesCode": "S" * 65, "catchWeightKg": 1}), ("fisheries.catch.v1", c | {"speciesCode": "S", "catchWeightKg": -1})])
    for bad in (e[1:], [*e, e[0]]):  # none or two catches
        with pytest.raises(Refused, match="lot-7.b"):
            products.consignments(events(spark, bad))
    with pytest.raises(Refused):
        products.consignments(events(spark, e).limit(0))


def test_nearest_rank(spark):
    many = spark.range(1, 11).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v")).unionByName(spark.range(2).select(F.lit("b").alias("g"), F.lit(1.0).alias("v")))
    got = {r.g: r for r in products.nearest_rank(many, "v", "g").collect()}
    assert (got["a"].p50, got["a"].p90, got["a"].p95, got["a"].mean) == (5, 9, 10, 5.5) and (got["b"].p50, got["b"].note) == (None, "INSUFFICIENT_DATA")
    assert products.snapshot({"a": 1}, "2026-01") == products.snapshot({"a": 1}, "2026-01")


# ---- tracks


def observed(spark, data):
    return spark.createDataFrame([(m, e, T0 + timedelta(seconds=s), float(x), float(y)) for m, e, s, x, y in data], "mmsi string, event_id string, occurred_at timestamp, longitude double, latitude double")


def test_trajectories(spark):
    data = [("m1", "e1", 0, 0, 0), ("m1", "e2", 60, 0, 1), ("m1", "e3", 120, 1, 1), ("m1", "e4", 7320, 2, 2), ("m1", "e4b", 7320, 2, 2), ("m1", "e5", 14521, 3, 3), ("m2", "f1", 0, 5, 5)]
    got = {(r.mmsi, r.segment_index): r for r in tracks.trajectories(observed(spark, data[::-1])).collect()}
    assert set(got) == {("m1", 0), ("m1", 1), ("m2", 0)}  # exactly two hours don't split
    assert got["m1", 0].point_count == 4 and (got["m1", 0].source_first_event_id, got["m1", 0].source_last_event_id) == ("e1", "e4")
    assert got["m1", 0].geometry_wkt == "LINESTRING (0 0, 0 1, 1 1, 2 2)" and got["m2", 0].geometry_wkt == "POINT (5 5)"
    assert json.loads(got["m1", 0].quality_json)["gap_threshold_seconds"] == 7200
    with pytest.raises(Refused):
        tracks.trajectories(observed(spark, data), gap_seconds=0)


def test_geofences(spark):
    square = {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}
    data = [("m1", "a", 0, 0, 0), ("m1", "b", 60, 1, 1), ("m1", "c", 60, 2, 1), ("m1", "d", 90, 3, 1)]
    r = tracks.geofence_summary(observed(spark, data), tracks.fences(spark, {"f": square})).collect()
    assert len(r) == 1 and (r[0].observation_count, r[0].first_event_id, r[0].last_event_id) == (3, "a", "b")


def test_motion(spark):
    got = tracks.motion(observed(spark, [("m", "a", 0, 0, 0), ("m", "b", 3600, 0, 1), ("m", "c", 7200, 0, 1)])).orderBy("event_id").collect()
    assert got[0].speed == 0 and abs(got[1].segment_metres - 111195) < 1 and got[1].bearing_degrees == 0 and got[2].idle
    assert abs(got[2].cumulative_metres - 111195) < 1 and got[2].cumulative_seconds == 7200
    assert tracks.reconstructed(observed(spark, [("m", "a", 0, 0, 0), ("m", "b", 9000, 0, 1)])).count() == 2


def test_encounters(spark):
    data = [(m, f"{m}{k}", 600 * k, k + d, 0) for m, d in (("a", 0), ("b", 3)) for k in range(4)]
    near = tracks.encounters(observed(spark, data), 5.0, 1200).collect()
    assert len(near) == 1 and (near[0].track_a, near[0].track_b, near[0].n_steps, near[0].min_distance) == ("a", "b", 4, 3.0)
    assert tracks.encounters(observed(spark, data), 1e-9, 1).count() == 0 and tracks.encounters(observed(spark, data), 5.0, 9999).count() == 0
    assert tracks.encounters(observed(spark, data), 5.0, 1200, entities=["z"]).count() == 0


# ---- retention, export, serving


def test_retention(spark, tmp_path):
    days = [-1, -29, -31, -(7 * 365 - 10), -(7 * 365 + 1), -(7 * 365 + 40)]
    df = spark.createDataFrame([(f"e{k}", T0 + timedelta(days=d)) for k, d in enumerate(days)], "event_id string, occurred_at timestamp")
    policy = retention.Retention()
    assert retention.report(df, policy, T0) == {"hot": 2, "cold": 2, "expired": 2}
    table, audit, cold = (VersionedTable(spark, str(tmp_path / n)) for n in ("t", "a", "c"))
    table.append_new(df, "event_id")
    for _ in range(2):  # the same plan is audited once
        assert retention.enforce(table, audit, policy, T0, False, "me") == {"windows": 2, "deleted": 0, "dry_run": True}
    assert table.read().count() == 6 and audit.read().count() == 2
    assert retention.enforce(table, audit, policy, T0, True, "me", cold)["deleted"] == 2
    assert rows(table.read(), "event_id") == [("e0",), ("e1",), ("e2",), ("e3",)] and cold.read().count() == 2 and table.manifest()["properties"]["append_only"]
    assert rows(audit.read().groupBy("mode").agg(F.count("*").alias("n"), F.sum("n_rows").alias("r")), "mode", "n", "r") == [("delete", 2, 2), ("plan-delete", 2, 2), ("tier-archive", 2, 2)]
    assert retention.enforce(table, audit, policy, T0, True, "me", cold)["deleted"] == 0
    for gone in ("e4", "e0"):  # not in the table any more; not expired
        with pytest.raises(Refused):
            retention.recheck(df.where(F.col("event_id") == gone).select("event_id"), table.read(), policy, T0)
    with pytest.raises(Refused):
        retention.enforce(table, audit, policy, T0, False, " ")
    with pytest.raises(Refused):
        retention.report(df, policy, T0 - timedelta(days=5))
    with pytest.raises(Refused):
        retention.Retention(400, 1)


def test_geoparquet(spark, tmp_path):
    df = spark.createDataFrame([("e2", "POINT (1 2)", 5), ("e1", "LINESTRING (0 0, 3 4)", 6)], "event_id string, wkt string, a int")
    path = str(tmp_path / "x.parquet")
    lineage = export.export_geoparquet(df, "wkt", path, "t", 3, ["event_id"])
    meta = json.loads(pq.read_schema(path).metadata[b"geo"])
    assert meta["columns"]["geometry"]["bbox"] == [0, 0, 3, 4] and pq.read_schema(path).names == ["a", "event_id", "geometry"]
    assert (lineage["first_id"], lineage["last_id"], lineage["rows"]) == ("e1", "e2", 2) and json.load(open(f"{path}.lineage.json")) == lineage
    with pytest.raises(Refused):
        export.export_geoparquet(df.withColumn("wkt", F.lit("oops")), "wkt", path, "t", 3)
    assert export.export_folder(df, "wkt", str(tmp_path / "f"))[2] == 2
    env = {"STORAGE_BACKEND": "local", "STORAGE_ROOT": str(tmp_path / "root"), "STORAGE_ALLOW_LOCAL": "1"}
    inside = str(tmp_path / "root" / "d" / "y.parquet")
    assert export.export_geoparquet(df, "wkt", inside, "t", 3, env=env)["quality"] == {"row_count": 2} and pq.read_table(inside).num_rows == 2
    for outside in (path, str(tmp_path / "root" / ".." / "z.parquet"), str(tmp_path / "rooted" / "z.parquet")):
        with pytest.raises(Refused):
            export.export_geoparquet(df, "wkt", outside, "t", 3, env=env)


def test_quality_metrics(spark):
    q = lambda a, b: json.dumps({"point_count": a, "simplified_point_count": b})
    df = spark.createDataFrame([("1", q(9, 3), 4), ("1", q(3, 1), None), (None, None, 2)], "mmsi string, quality_json string, observation_count int")
    wanted = {"row_count": 3, "distinct_mmsi": 1, "segments_with_quality": 2, "total_track_points": 12, "simplified_track_points": 4, "simplification_ratio": 0.333333}
    assert export.quality_metrics(df) == wanted | {"geofence_observations": 6} and export.quality_metrics(df.limit(0)) == {"row_count": 0}


def test_movement_features(spark):
    at = T0 + timedelta(microseconds=5)
    df = spark.createDataFrame([("123456789", 1.5, 2.0, at), ("123456788", -3.0, 4.0, T0)], "mmsi string, latitude double, longitude double, occurred_at timestamp")
    made = json.loads(tracks.feature_collection(tracks.movement_features(df)))
    assert [f["geometry"]["coordinates"] for f in made["features"]] == [[4.0, -3.0], [2.0, 1.5]]
    assert [f["properties"]["occurred_at"] for f in made["features"]] == [T0.isoformat(), at.isoformat()] and made["features"][0]["properties"]["mmsi"] == "123456788"
    text = df.withColumn("occurred_at", F.lit("2026-03-01T00:00:00Z"))
    assert tracks.movement_features(text).where(F.col("occurred_at") == F.lit(T0)).count() == 2
    for change in ({"latitude": F.lit(91.0)}, {"longitude": F.lit(float("nan"))}, {"mmsi": F.lit("12")}, {"occurred_at": F.lit("soon")}, {"latitude": F.lit("1")}, {"longitude": F.lit(None).cast("double")}):
        with pytest.raises(Refused):
            tracks.movement_features(df.withColumns(change))
    with pytest.raises(Refused):
        tracks.feature_collection(tracks.movement_features(df.limit(0)))


def test_serving(spark):
    v = spark.createDataFrame([("r1", "k", "2026-01", "AAAAA", None, "P50", 1.0, "h", 1, None), ("r1", "k", "2026-01", None, None, "P90", 2.0, "h", 1, None)], "run_id string, kpi_id string, period string, port_code string, ship_class string, percentile string, value double, unit string, n_observations long, note string")
    runs = spark.createDataFrame([("r1", T0)], "run_id string, created_at timestamp")
    assert [r.percentile for r in serving.values(v, runs).collect()] == ["P50", "P90"] and serving.values(v, runs, port_code="AAAAA").count() == 1
    for bad in (lambda: serving.values(v, runs.limit(0)), lambda: serving.values(v, runs, value="1")):
        with pytest.raises(Refused):
            bad()
    r = serving.report(v, "r1", "2026-01", bytes(range(32)), "k")
    assert r == serving.report(v, "r1", "2026-01", bytes(range(32)), "k") and serving.report_csv(r["core"]).count("\n") == 3
    token = serving.bearer({"roles": ["a"], "exp": 100}, b"s")
    assert serving.bearer_roles(token, b"s", now=99) == ["a"]
    for header, secret, now in ((token, b"t", 99), (token, b"s", 101), (None, b"s", 0), ("Bearer x", b"s", 0)):
        with pytest.raises(AccessError):
            serving.bearer_roles(header, secret, now)
