"""A payload is parsed once for each row that a plan reads, also where rows are kept by a field of it."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from keelstone.operators import ports, products
from keelstone.sources.envelopes import with_domain_fields

T = datetime(2026, 3, 1, tzinfo=UTC)
BLOCK = {"blockId": "b", "projectId": "p", "vintage": "2020", "status": "ACTIVE", "quantityKgCo2e": 1}
REPORT = {"imoNumber": "1234567", "calendarYear": 2025, "reportId": "r", "state": "VERIFIED", "totals": {"co2Tonnes": 1}}
SLOT = {"portCode": "XKQRS", "slotWindowStart": "2026-03-05T00:00:00Z", "bookedSlots": 1, "offeredSlots": 2}
CATCH = {"consignmentId": "c", "speciesCode": "TUN", "catchWeightKg": 1}
CASES = {
    "blocks": (products.BLOCK, BLOCK, lambda e: products.vintage_totals(products.credit_blocks(e))),
    "reports": (products.ANNUAL, REPORT, products.annual_reports),
    "bookings": (ports.BOOKING, SLOT, lambda e: ports.bookings(e, "2026-03")),
    "consignments": ("fisheries.catch.landed.v1", CATCH, products.consignments),
}


def stored(spark, path, kind, *payloads):
    rows = [(f"{kind}-{n}", kind, T, p if isinstance(p, str) else json.dumps(p), "RESTRICTED") for n, p in enumerate(payloads)]
    spark.createDataFrame(rows, "event_id string, event_type string, occurred_at timestamp, payload_json string, record_classification string").write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("case", CASES)
def test_payloads_are_parsed_once(spark, tmp_path, case):
    kind, payload, make = CASES[case]
    made = make(stored(spark, tmp_path / "e", kind, payload))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(payload_json") == 1 and made.count() == 1


def test_registry_reads_blocks_once(spark, tmp_path):
    blocks = stored(spark, tmp_path / "b", products.BLOCK, BLOCK | {"bufferPool": True}, BLOCK | {"blockId": "c", "vintage": "2021"})
    events = blocks.union(stored(spark, tmp_path / "p", products.PROJECT, {"projectId": "p", "state": "LISTED"}))
    made = products.public_registry(events)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [row_number()") == 2  # the latest of projects, and of blocks once for totals and buffers
    row = made.select("buffer_balance_kg_co2e", "vintage_totals_json", F.size(F.from_json("source_event_ids_json", "array<string>"))).first()
    assert row[0] == 1.0 and [x["issued_kg_co2e"] for x in json.loads(row[1])] == [1.0, 1.0] and row[2] == 3


def test_consignments_are_read_twice(spark, tmp_path):
    """Once to count faults and catches, once for the rows."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    events = stored(spark, tmp_path / "e", "fisheries.catch.landed.v1", *[CATCH | {"consignmentId": f"c{n}"} for n in range(30)])
    assert len(products.consignments(events.mapInArrow(count, events.schema)).collect()) == 30 and seen.value == 60


def test_members_are_taken_without_paths(spark, tmp_path):
    """A path to a member that isn't there throws an exception for each row."""
    made = with_domain_fields(stored(spark, tmp_path / "e", "k", CATCH), {"consignmentId": "text!", "absent": "number", "when": "instant"})
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "try_variant_get" in plan and "$." not in plan
    row = made.first()
    assert (row.fault, row.f.consignmentId, row.f.absent, row.f.when) == (None, "c", None, None)
