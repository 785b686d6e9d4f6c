"""The ways through the layers: bronze to silver, silver to each gold product, and the published month."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import Refused
from ..operators import ports, products, serving, tracks, vessels
from ..operators.governance import Scope
from ..sources.tables import VersionedTable

#: Gold products of each scope: table name and what makes its rows of silver events.
PRODUCTS: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    "cvff": {"ledger": products.ledger_rollup},
    "mrv": {"vessel_annual": products.vessel_annual},
    "bluecarbon": {"public_registry": products.public_registry},
    "platform": {"excise_stamp_facts": products.excise_facts},
    "fisheries": {"export_consignments": products.consignments},
}


def table(spark: SparkSession, scope: Scope, layer: str, name: str = "events") -> VersionedTable:
    return VersionedTable(spark, scope.table(layer, name))


def promote(spark: SparkSession, scope: Scope, coordinates: DataFrame) -> tuple[int, int, int]:
    """Bronze events with their coordinates (event_id, kafka_topic, kafka_partition, kafka_offset) into silver: (version, written, present)."""
    events = scope.check(table(spark, scope, "bronze").read())
    rows = products.silver_rows(events.join(coordinates, "event_id"), ledger=scope.name == "cvff").withColumn("promoted_at", F.current_timestamp())
    return table(spark, scope, "silver").append_new(rows, "dedup_key", ignore=("promoted_at",))


def assemble(spark: SparkSession, scope: Scope) -> dict[str, int]:
    """Overwrite the scope's gold products from its silver events: versions by name."""
    if scope.name not in PRODUCTS:
        raise Refused(f"{scope.name} has no gold product")
    silver = table(spark, scope, "silver").read()
    return {name: table(spark, scope, "gold", name).overwrite(make(silver).withColumn("curated_at", F.current_timestamp())) for name, make in PRODUCTS[scope.name].items()}


def rebuild_tracks(spark: SparkSession, scope: Scope, fences: DataFrame | None = None, gap_seconds: float = 7200, tolerance: float = 0.001) -> dict[str, int]:
    """Vessel observations of bronze into trajectories and, given fences, their summary."""
    seen = vessels.observations(table(spark, scope, "bronze").read())
    made = {"trajectories": table(spark, scope, "silver", "trajectories").overwrite(tracks.trajectories(seen, gap_seconds, tolerance).withColumn("assembled_at", F.current_timestamp()))}
    if fences is not None:
        made["geofence_summary"] = table(spark, scope, "gold", "geofence_summary").overwrite(tracks.geofence_summary(seen, fences).withColumn("summarized_at", F.current_timestamp()))
    return made


def publish_month(spark: SparkSession, scope: Scope, period: str, created_at: datetime, reports: str | None = None, seed: bytes | None = None, kid: str = "") -> dict:
    """A month's port statistics: facts, then the run, then its values, each by insert-only merge, so a month that broke off is completed by running it again; and the report's files."""
    silver = table(spark, scope, "silver")
    version = silver.version()
    run, facts, values = ports.run_statistics(silver, period, scope.root, version)
    facts = facts.withColumn("fact_key", F.sha2(F.concat_ws("/", "run_id", "port_call_id"), 256))
    table(spark, scope, "gold", "port_call_facts").append_new(facts, "fact_key")
    report = serving.report(values, run, period, seed, kid)
    manifest = spark.createDataFrame([(run, period, version, ports.definitions_hash(), report["sha256"], report.get("signature"), created_at)], "run_id string, period string, silver_version long, definitions_sha256 string, report_sha256 string, signature string, created_at timestamp")
    table(spark, scope, "gold", "port_kpi_runs").append_new(manifest, "run_id", ignore=("created_at",))
    table(spark, scope, "gold", "port_kpi_values").append_new(values, "value_key")
    if reports:
        write_atomically(os.path.join(reports, f"{run}.json"), json.dumps(report, sort_keys=True))
        write_atomically(os.path.join(reports, f"{run}.csv"), serving.report_csv(report["core"]))
    return {"run_id": run, "silver_version": version, "sha256": report["sha256"]}


def write_atomically(path: str, text: str, mode: int = 0o640) -> None:
    """A file that is there as a whole or not at all."""
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    try:
        with os.fdopen(handle, "w") as f:
            f.write(text)
        os.chmod(temporary, mode)
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise
