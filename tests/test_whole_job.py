"""Queries and ways that have to work on everything they are given, not on a part of it."""

import json
from datetime import UTC, datetime

from pyspark.sql import functions as F

from keelstone.operators import governance, serving
from keelstone.plans import assembly, fixtures, http, workload
from keelstone.sources.tables import VersionedTable
from keelstone.streaming import ingest
from test_operators import envelope, port_events

SMALL = "/root/testdata/sf0.01"


def test_port_statistics_sees_all_orders(spark):
    orders = workload.table(spark, SMALL, "orders")
    assert fixtures._port_events(spark, SMALL).count() == 3 * orders.count() + orders.where("o_orderstatus = 'F'").count()
    slot = F.timestamp_micros(F.unix_micros("o_orderdate") + F.col("o_orderkey") % 97 * 3_600_000_000)
    port = F.concat(F.lit("AB"), F.lpad((F.col("o_custkey") % 7).cast("string"), 3, "0"))
    due = orders.where((slot >= "1997-05-01") & (slot < "1997-06-01"))
    assert due.where("o_orderdate < '1997-05-01'").count() > 0  # ordered in April for a slot in May
    wanted = {r.port: r["count"] for r in due.groupBy(port.alias("port")).count().collect()}
    values = workload.queries()["port_statistics"](spark, SMALL).where("kpi_id = 'slot_utilisation_pct'").collect()
    assert {r.port_code: r.n_observations for r in values if r.n_observations} == wanted


def test_lines_that_make_no_valid_event_are_quarantined(spark, tmp_path):
    wide = {"resourceType": "Bundle", "type": "message", "entry": [{"resource": {"a": "x" * (1 << 20)}}]}
    bad = [envelope(1, producer=" p"), envelope(2, correlationId="c\u0007"), envelope(3, producer="é" * 200), envelope(4, fhir=wide)]
    bad[3]["provenance"]["signature"] = "a.b.c"  # which repeats the whole envelope, too long for a line
    lines = [json.dumps(x) for x in [*bad, envelope(1), envelope(5), envelope(5)]]
    batch = spark.createDataFrame([(x, "t", 0, k) for k, x in enumerate(lines)], "line string, topic string, partition int, offset long")
    bronze, dlq = (VersionedTable(spark, str(tmp_path / n)) for n in ("b", "q"))
    scope = governance.Scope("platform", str(tmp_path / "lake"))
    for _ in range(2):  # a replay changes nothing
        counts = ingest.ingest_batch(batch, scope, bronze, dlq, None)
        assert {k: counts.get(k) for k in ("accepted", "invalid-event", "duplicate-in-batch")} == {"accepted": 2, "invalid-event": 4, "duplicate-in-batch": 1}
        assert sorted(r.event_id[-1] for r in bronze.read().collect()) == ["1", "5"]  # a bad line of an id doesn't stand in the way of a good one
        found = {r.offset: (r.reason, r.detail) for r in dlq.read().collect()}
        bad = "invalid-event"
        assert found == {0: (bad, "producer"), 1: (bad, "correlation_id"), 2: (bad, "producer"), 3: (bad, "payload"), 6: ("duplicate-in-batch", "")}


def test_answers_are_whole_or_refused(spark, tmp_path, monkeypatch):
    scope = governance.Scope("platform", str(tmp_path / "lake"))
    assembly.table(spark, scope, "silver").overwrite(port_events(spark))
    assembly.publish_month(spark, scope, "2026-03", datetime(2026, 4, 1, tzinfo=UTC), str(tmp_path), bytes(32), "k")
    policy = governance.Policy({"reader": governance.whole_scope("platform", "gold")})
    ask = lambda target: http.answer(spark, scope, policy, b"s", target, serving.bearer({"roles": ["reader"], "exp": 1e12}, b"s"))
    n = len(ask("/values")[1])
    monkeypatch.setattr(http, "MAX_ROWS", n)
    assert ask("/values")[0] == 200 and len(ask("/values")[1]) == n
    monkeypatch.setattr(http, "MAX_ROWS", n - 1)
    status, body = ask("/values")
    assert status == 413 and "more than" in body["error"]
    assert ask("/values?port_code=YLTUV")[0] == 200 and ask("/runs")[0] == 200
