"""Whole ways through the layers, storage rules, telemetry and the HTTP shell."""

import json
import threading
import urllib.error
import urllib.request
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from keelstone.errors import ConflictError, Refused
from keelstone.operators import governance, ports, serving, tracks, vessels
from keelstone.plans import assembly, http
from keelstone.sources import storage
from keelstone.sources.tables import VersionedTable
from keelstone.streaming import telemetry
from test_functions import SENTENCE
from test_operators import T0, events, observed, port_events


@pytest.fixture()
def scope(tmp_path):
    return governance.Scope("platform", str(tmp_path / "lake"))


def test_published_months(spark, scope, tmp_path):
    assembly.table(spark, scope, "silver").overwrite(port_events(spark))
    at = datetime(2026, 4, 1, tzinfo=UTC)
    a = assembly.publish_month(spark, scope, "2026-03", at, str(tmp_path), bytes(32), "k")
    b = assembly.publish_month(spark, scope, "2026-03", at.replace(day=2), None, bytes(32), "k")
    assert a == b and assembly.table(spark, scope, "gold", "port_kpi_runs").read().count() == 1
    assert json.loads((tmp_path / f"{a['run_id']}.json").read_text())["sha256"] == a["sha256"] and (tmp_path / f"{a['run_id']}.csv").stat().st_mode & 0o777 == 0o640

    policy, secret = governance.Policy({"reader": governance.whole_scope("platform", "gold"), "other": governance.whole_scope("mrv")}), b"s"
    server = http.serve(spark, scope, policy, secret)
    threading.Thread(target=server.serve_forever, daemon=True).start()

    def get(path, role="reader"):
        request = urllib.request.Request(f"http://127.0.0.1:{server.server_port}{path}", headers={"Authorization": serving.bearer({"roles": [role], "exp": 1e12}, secret)} if role else {})
        try:
            with urllib.request.urlopen(request) as r:
                return r.status, json.load(r)
        except urllib.error.HTTPError as e:
            return e.code, None

    try:
        assert get("/health", None)[0] == 200 and get("/runs", None)[0] == 401 and get("/runs", "other")[0] == 403
        assert len(get("/runs")[1]) == 1 and len(get("/kpis")[1]) == len(ports.KPIS)
        assert {r["port_code"] for r in get("/values?port_code=YLTUV")[1]} == {"YLTUV"}
        assert get("/values?color=red")[0] == 400 and get("/nothing")[0] == 404 and get("/reports/x")[0] == 404
        assert get(f"/reports/{a['run_id']}")[1]["sha256"] == a["sha256"]
    finally:
        server.shutdown()


def test_nothing_is_published(spark, scope):
    policy = governance.Policy({"reader": governance.whole_scope("platform", "gold")})
    assert http.answer(spark, scope, policy, b"s", "/runs", serving.bearer({"roles": ["reader"], "exp": 1e12}, b"s"))[0] == 503


def test_promotion_and_gold(spark, tmp_path):
    scope = governance.Scope("cvff", str(tmp_path / "lake"))
    e = events(spark, [("cvff.x.v1", {"ledgerCommitHash": c * 64}, k, None) for k, c in enumerate("aab")]).withColumns({"source_system": F.lit("s"), "data_classification": F.lit("fiduciary_segregated"), "ingested_at": F.lit(T0)})
    assembly.table(spark, scope, "bronze").append_new(e, "event_id")
    where = e.select("event_id", F.lit("cvff.x").alias("kafka_topic"), F.lit(0).alias("kafka_partition"), F.substring("event_id", 2, 2).cast("long").alias("kafka_offset"))
    assert assembly.promote(spark, scope, where)[1:] == (3, 0) and assembly.promote(spark, scope, where)[1:] == (0, 3)
    assembly.assemble(spark, scope)
    gold = assembly.table(spark, scope, "gold", "ledger").read()
    assert sorted(r.record_count for r in gold.collect()) == [1, 2]
    with pytest.raises(Refused):
        assembly.assemble(spark, governance.Scope("isr", str(tmp_path / "x")))


def vessel(**f):
    return (vessels.KIND, f, 0, None)


def test_vessels(spark, scope, tmp_path):
    good = [vessel(mmsi="123456789", latitude=1.0, longitude=2.0, speedKnots=3.0), vessel(nmeaSentences=[SENTENCE])]
    r = vessels.observations(events(spark, good)).orderBy("event_id").collect()
    assert (r[0].mmsi, r[0].geometry_wkt) == ("123456789", "POINT (2 1)") and (r[1].mmsi, r[1].message_type) == ("477553000", 1)
    for bad in (vessel(mmsi="12", latitude=1.0, longitude=2.0), vessel(mmsi="123456789", latitude=91.0, longitude=2.0), vessel(nmeaSentences=[SENTENCE[:-1] + "D"]), vessel(nmeaSentences=[SENTENCE], latitude=1.0)):
        with pytest.raises(Refused):
            vessels.observations(events(spark, [bad]))
    bronze, seen = VersionedTable(spark, str(tmp_path / "seen")), events(spark, good).withColumns({c: F.lit(c) for c in ("producer", "source_record_reference")})
    assert vessels.append_observations(bronze, seen)[1:] == (2, 0) and vessels.append_observations(bronze, seen)[1:] == (0, 2)
    assert sorted(r.decode_source for r in bronze.read().collect()) == ["ais-nmea", "payload"] and bronze.manifest()["properties"]["append_only"]
    with pytest.raises(ConflictError):
        vessels.append_observations(bronze, seen.withColumn("producer", F.lit("other")))
    assembly.table(spark, scope, "bronze").append_new(events(spark, good), "event_id")
    fence = tracks.fences(spark, {"f": {"type": "Polygon", "coordinates": [[[0, 0], [3, 0], [3, 3], [0, 3], [0, 0]]]}})
    made = assembly.rebuild_tracks(spark, scope, fence)
    assert made == {"trajectories": 0, "geofence_summary": 0} and assembly.table(spark, scope, "gold", "geofence_summary").read().count() == 1


def test_storage():
    s3 = storage.resolve({"STORAGE_BACKEND": "MinIO", "STORAGE_ROOT": "s3://bucket/x", "S3_ENDPOINT": "https://s3.local"})
    assert s3[:2] == ("s3", "s3a://bucket/x") and s3[2]["spark.hadoop.fs.s3a.endpoint"] == "https://s3.local"
    assert storage.resolve({"STORAGE_BACKEND": "adls-gen2", "STORAGE_ROOT": "abfss://c@acc.dfs.core.windows.net/x"})[0] == "adls"
    assert storage.resolve({"STORAGE_BACKEND": "local", "STORAGE_ROOT": "/x", "STORAGE_ALLOW_LOCAL": "1"})[0] == "local"
    for bad in ({"STORAGE_BACKEND": "local", "STORAGE_ROOT": "/x"}, {"STORAGE_BACKEND": "s3", "STORAGE_ROOT": "s3://u:p@b"}, {"STORAGE_BACKEND": "s3", "STORAGE_ROOT": "/x"}, {"STORAGE_BACKEND": "odd", "STORAGE_ROOT": "/x"}, {"STORAGE_BACKEND": "s3", "STORAGE_ROOT": "s3://b", "S3_ENDPOINT": "http://far"}):
        with pytest.raises(Refused):
            storage.resolve(bad)


def test_transport():
    assert storage.kafka_options({"KAFKA_SERVERS": "localhost:9092", "KAFKA_PROTOCOL": "PLAINTEXT"})["kafka.security.protocol"] == "PLAINTEXT"
    full = {"KAFKA_SERVERS": "a.b:9093", "KAFKA_MECHANISM": "SCRAM-SHA-512", "KAFKA_USER": "u", "KAFKA_PASSWORD": "p"}
    assert storage.sink_options(full)["kafka.acks"] == "all" and "p" not in storage.described(storage.kafka_options(full))["kafka.sasl.jaas.config"]
    for bad in ({"KAFKA_SERVERS": "far:9092", "KAFKA_PROTOCOL": "PLAINTEXT"}, {"KAFKA_SERVERS": ""}, full | {"KAFKA_MECHANISM": "GSSAPI"}, full | {"KAFKA_PASSWORD": ""}):
        with pytest.raises(Refused):
            storage.kafka_options(bad)


def test_observed_counts(spark):
    rows, seen = telemetry.observed(observed(spark, [("m", "a", 0, 0, 0), ("m", "b", 9, 0, 0)]), "batch")
    rows.collect()
    assert seen.get["n_rows"] == 2
    assert telemetry.Progress(2).reports.maxlen == 2
