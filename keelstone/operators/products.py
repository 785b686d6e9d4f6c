"""Derived products: ledger roll-up, annual emissions, carbon registry, excise facts, consignments, clearance times."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import Refused
from ..functions.canonical import canonical_json, to_canonical_json
from ..functions.text import is_canonical_text, matches
from ..functions.udf import vectorised
from ..sources.envelopes import UNREADABLE, found_faults, where_read, with_domain_fields
from .governance import CLEARANCES, rank

#: Event types and vocabularies.
ANNUAL, STATEMENT = "mrv.emissions-annual.v1", "mrv.soc.v1"
PROJECT, BLOCK, RETIREMENT = "bluecarbon.project.v1", "bluecarbon.credit-block.v1", "bluecarbon.retirement.v1"
ASSESSED, APPROVED, ISSUED, ACTIVATED = "stamps.assessed.v1", "stamps.approved.v1", "stamps.issued.v1", "stamps.activated.v1"
BLOCK_STATES, RATINGS = ("ACTIVE", "RETIRED", "CANCELLED"), ("A", "B", "C", "D", "E")


def refuse(rows: DataFrame, fault: Column, what: str, name: str = "event_id") -> DataFrame:
    """Fails if any row has the fault (or it can't be told); rules are checked before anything is written."""
    bad = [r[0] for r in rows.where(F.coalesce(fault, F.lit(True))).select(name).limit(5).collect()]
    if bad:
        raise Refused(f"{what}: {bad}")
    return rows


def latest(rows: DataFrame, *keys: str) -> DataFrame:
    """The last row of each key by (occurred_at, event_id)."""
    w = Window.partitionBy(*keys).orderBy(F.desc("occurred_at"), F.desc("event_id"))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def _read(events: DataFrame, kind: str | Column, fields: dict[str, str], more=lambda f: {}, what: str = "") -> DataFrame:
    """Events of a kind with their domain fields `f`, all rules checked in one pass; more: further rules, fault by predicate."""
    own = F.col("event_type") == kind if isinstance(kind, str) else kind
    read = with_domain_fields(events.where(own), fields)
    if bad := found_faults(read, _first_fault(more(F.col("f")))):
        raise Refused(f"{what or kind}: {bad}")
    return read.drop("fault")


def _first_fault(rules: dict[str, Column]) -> Column:
    return F.coalesce("fault", *[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()])


def ledger_rollup(silver: DataFrame) -> DataFrame:
    """By ledger commitment: records, first and last time, sources and event ids as sorted JSON."""
    return silver.groupBy("ledger_commit_hash").agg(
        F.count(F.lit(1)).alias("record_count"), F.min("occurred_at").alias("first_occurred_at"), F.max("occurred_at").alias("last_occurred_at"),
        F.to_json(F.array_sort(F.collect_set("source_system"))).alias("source_systems_json"), F.to_json(F.array_sort(F.collect_list("event_id"))).alias("event_ids_json"),
    )


def ledger_hash(payload: Column) -> Column:
    """The commitment of a payload, its own or its provenance's; null if it isn't a SHA-256."""
    value = F.coalesce(F.get_json_object(payload, "$.ledgerCommitHash"), F.get_json_object(payload, "$.provenance.ledgerCommitHash"))
    return F.when(matches(value, "sha256"), value)


def silver_rows(events: DataFrame, ledger: bool) -> DataFrame:
    """Silver rows of bronze events with (kafka_topic, kafka_partition, kafka_offset): the coordinates become the key."""
    key = F.sha2(F.concat_ws("/", "kafka_topic", F.col("kafka_partition").cast("string"), F.col("kafka_offset").cast("string")), 256)
    out = events.drop("ingested_at").withColumn("dedup_key", key)
    if not ledger:
        return out
    out = out.withColumn("ledger_commit_hash", ledger_hash(F.col("payload_json")))
    return refuse(out, F.col("ledger_commit_hash").isNull(), "events without a ledger commitment")


def annual_reports(events: DataFrame) -> DataFrame:
    """The latest VERIFIED report of each vessel and year. Others aren't looked at; a verified one with a fault is refused."""
    fields = {"imoNumber": "text!", "calendarYear": "whole!", "reportId": "text!", "ciiRating": "text", "totals": "object!", "attainedCii": "number", "requiredCii": "number", "state": "text"}
    rules = lambda f: {"imoNumber": ~matches(f["imoNumber"], "imo_number"), "calendarYear": ~f["calendarYear"].between(2000, 9999), "ciiRating": f["ciiRating"].isNotNull() & ~f["ciiRating"].isin(*RATINGS), "co2Tonnes": ~F.coalesce(_number_or_none(f["totals"], "co2Tonnes"), F.lit(False))}
    read = with_domain_fields(events.where(F.col("event_type") == ANNUAL), fields)
    verified = F.coalesce(F.col("f.state") == "VERIFIED", F.lit(False))
    bad = found_faults(read, F.when(F.col("fault").isin(*UNREADABLE), F.col("fault")).when(verified, _first_fault(rules(F.col("f")))))
    if lost := [i for i, fault in bad if fault in UNREADABLE]:
        raise Refused(f"annual reports that can't be read: {lost}")
    if bad:
        raise Refused(f"{ANNUAL}: {bad}")
    rows = where_read(read.drop("fault"), verified)
    f = F.col("f")
    return latest(rows.select("event_id", "occurred_at", f["imoNumber"].alias("imo_number"), f["calendarYear"].cast("int").alias("calendar_year"), f["reportId"].alias("report_id"), to_canonical_json(f["totals"]).alias("totals"), F.try_variant_get(F.try_parse_json(f["totals"]), "$.co2Tonnes", "double").alias("co2_tonnes"), f["attainedCii"].alias("attained_cii"), f["requiredCii"].alias("required_cii"), f["ciiRating"].alias("cii_rating")), "imo_number", "calendar_year")


def _number_or_none(text: Column, name: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), f"$.{name}", "variant"))
    return kind.isNull() | kind.rlike("^(VOID|BIGINT|DECIMAL|DOUBLE|FLOAT)")


def statements(events: DataFrame) -> DataFrame:
    """The latest statement of each report."""
    f = F.col("f")
    rows = _read(events, STATEMENT, {"reportId": "text!", "artifactSha256": "text!"}, lambda f: {"artifactSha256": ~matches(f["artifactSha256"], "sha256")})
    return latest(rows.select("event_id", "occurred_at", f["reportId"].alias("report_id"), f["artifactSha256"].alias("soc_artifact_sha256")), "report_id")


def orphans(reports: DataFrame, soc: DataFrame) -> DataFrame:
    """Statements of reports that aren't among the verified ones."""
    return soc.join(reports.select("report_id"), "report_id", "left_anti")


def vessel_annual(events: DataFrame) -> DataFrame:
    """The latest VERIFIED report of each vessel and year with its statement; a statement of any other report is refused."""
    reports, soc = annual_reports(events), statements(events)
    # of several rows of one report the first takes the statement
    reports = reports.withColumn("turn", F.row_number().over(Window.partitionBy("report_id").orderBy("imo_number", "calendar_year")))
    lost = [r[0] for r in orphans(reports, soc).select("report_id").limit(5).collect()]
    if lost:
        raise Refused(f"statements of reports that aren't verified: {lost}")
    s = soc.select("report_id", "soc_artifact_sha256", F.col("event_id").alias("soc_event"), F.lit(1).alias("turn"))
    made = reports.join(s, ["report_id", "turn"], "left")
    ids = F.to_json(F.array_sort(F.array_compact(F.array("event_id", "soc_event"))))
    return made.select("imo_number", "calendar_year", "report_id", F.col("totals").alias("fuel_totals_json"), "co2_tonnes", "attained_cii", "required_cii", "cii_rating", "soc_artifact_sha256", ids.alias("source_event_ids_json"))


EXACT = "decimal(28,6)"


def _plain(amount: Column) -> Column:
    """A decimal as JSON text with one decimal at least."""
    return F.regexp_replace(F.regexp_replace(amount.cast(EXACT).cast("string"), "0+$", ""), r"\.$", ".0")


def credit_blocks(events: DataFrame) -> DataFrame:
    """The latest state of each block, quantities as exact decimals."""
    f = F.col("f")
    fields = {"blockId": "text!", "projectId": "text!", "vintage": "text!", "status": "text!", "quantityKgCo2e": "number!", "bufferPool": "flag"}
    rows = _read(events, BLOCK, fields, lambda f: {"status": ~f["status"].isin(*BLOCK_STATES), "quantityKgCo2e": ~(f["quantityKgCo2e"] >= 0)})
    return latest(rows.withColumn("block_id", f["blockId"]), "block_id").select("event_id", "block_id", f["projectId"].alias("project_id"), f["vintage"].alias("vintage"), f["status"].alias("status"), f["quantityKgCo2e"].cast(EXACT).alias("q"), F.coalesce(f["bufferPool"], F.lit(False)).alias("buffer"))


def vintage_totals(blocks: DataFrame, *more: Column) -> DataFrame:
    """Issued, retired and cancelled by project and vintage; exact, in whatever order the rows come. more: further aggregates."""
    of = lambda state: F.coalesce(F.sum(F.when(F.col("status") == state, F.col("q"))), F.lit(0)).cast(EXACT)
    return blocks.groupBy("project_id", "vintage").agg(F.sum("q").cast(EXACT).alias("issued_kg_co2e"), of("RETIRED").alias("retired_kg_co2e"), of("CANCELLED").alias("cancelled_kg_co2e"), *more)


def retirements(events: DataFrame) -> DataFrame:
    """Retirements, each with its beneficiary, purpose, quantity and artifact."""
    fields = {"retirementId": "text!", "projectId": "text!", "serial": "text", "beneficiary": "text!", "purpose": "text!", "quantityKgCo2e": "number!", "artifactSha256": "text!", "retiredAt": "text"}
    return _read(events, RETIREMENT, fields, lambda f: {"quantityKgCo2e": ~(f["quantityKgCo2e"] >= 0)})


def public_registry(events: DataFrame) -> DataFrame:
    """Public fields of the latest state of each project with totals by vintage, buffer balance and retirements. Only listed fields are copied."""
    f = F.col("f")
    fields = {"projectId": "text!", "state": "text!", "projectName": "text", "ecosystem": "text", "methodology": "text", "countryCode": "text", "strataCentroids": "array", "externalRegistry": "text", "externalProjectId": "text"}
    projects = latest(_read(events, PROJECT, fields).withColumn("project_id", f["projectId"]), "project_id")
    blocks = credit_blocks(events)
    line = F.concat(F.lit('{"vintage":'), F.regexp_replace(F.to_json(F.array("vintage")), r"^\[|\]$", ""), *[x for c in ("issued", "retired", "cancelled") for x in (F.lit(f',"{c}_kg_co2e":'), _plain(F.col(f"{c}_kg_co2e")))], F.lit("}"))
    lines = lambda order, text: F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text.alias("line")))), lambda x: x["line"]), ","), F.lit("]"))
    # totals, buffer and ids by vintage first, so the blocks are read once
    held = F.sum(F.when(F.col("buffer") & (F.col("status") == "ACTIVE"), F.col("q")))
    by_vintage = vintage_totals(blocks, held.alias("held"), F.collect_list("event_id").alias("block_ids"))
    totals = by_vintage.groupBy("project_id").agg(lines(["vintage"], line).alias("vintage_totals_json"), F.coalesce(F.sum("held"), F.lit(0)).cast("double").alias("buffer"), F.flatten(F.collect_list("block_ids")).alias("block_ids"))
    item = F.to_json(F.struct(f["retirementId"].alias("retirement_id"), f["serial"].alias("serial"), f["beneficiary"].alias("beneficiary"), f["purpose"].alias("purpose"), f["quantityKgCo2e"].alias("quantity_kg_co2e"), f["artifactSha256"].alias("artifact_sha256"), f["retiredAt"].alias("retired_at")), {"ignoreNullFields": "false"})
    lists = retirements(events).withColumn("retirement", f["retirementId"]).groupBy(f["projectId"].alias("project_id")).agg(lines(["retirement", "event_id"], item).alias("retirements_json"), F.collect_list("event_id").alias("retirement_ids"))
    none = F.array().cast("array<string>")
    ids = F.array_sort(F.concat(F.array("event_id"), F.coalesce("block_ids", none), F.coalesce("retirement_ids", none)))
    return projects.join(totals, "project_id", "left").join(lists, "project_id", "left").select(
        "project_id", f["projectName"].alias("project_name"), f["state"].alias("state"), f["ecosystem"].alias("ecosystem"), f["methodology"].alias("methodology"), f["countryCode"].alias("country_code"), f["strataCentroids"].alias("strata_centroids_json"),
        f["externalRegistry"].alias("external_registry"), f["externalProjectId"].alias("external_project_id"), F.coalesce("vintage_totals_json", F.lit("[]")).alias("vintage_totals_json"), F.coalesce("buffer", F.lit(0.0)).alias("buffer_balance_kg_co2e"), F.coalesce("retirements_json", F.lit("[]")).alias("retirements_json"), F.to_json(ids).alias("source_event_ids_json"),
    )


def excise_facts(events: DataFrame) -> DataFrame:
    """One row for each stamp event. Money and quantities are whole numbers of minor units: 12.5, true and text are refused, in a domain document, too."""
    kind = F.col("event_type")
    fields = {"assessmentId": "text", "declarationRef": "text", "batchId": "text", "totalDutyKobo": "whole", "stampsRequired": "whole", "quantity": "whole", "activatedCount": "whole"}
    amounts = lambda f: (F.when(kind == ASSESSED, f["totalDutyKobo"]), F.when(kind == ASSESSED, f["stampsRequired"]).when(kind == ISSUED, f["quantity"]).when(kind == ACTIVATED, f["activatedCount"]))

    def rules(f: Column) -> dict[str, Column]:
        duty, quantity = amounts(f)
        return {"totalDutyKobo": (kind == ASSESSED) & ~F.coalesce(duty >= 0, F.lit(False)), "quantity": (kind != APPROVED) & ~F.coalesce(quantity >= F.when(kind == ISSUED, 1).otherwise(0), F.lit(False))}

    rows = _read(events, kind.isin(ASSESSED, APPROVED, ISSUED, ACTIVATED), fields, rules, "stamp events")
    f = F.col("f")
    duty, quantity = amounts(f)
    return rows.select("event_id", "event_type", "occurred_at", F.coalesce(f["assessmentId"], F.lit("")).alias("assessment_id"), F.coalesce(f["declarationRef"], F.lit("")).alias("declaration_ref"), F.coalesce(f["batchId"], F.lit("")).alias("batch_id"), duty.alias("total_duty_kobo"), quantity.alias("quantity"), "payload_json")


@vectorised("string")
def sample_digest(samples: pd.Series) -> pd.Series:
    """SHA-256 of ordered samples as canonical JSON."""
    return samples.map(lambda rows: hashlib.sha256(canonical_json([{"event_id": r["event_id"], "occurred_at": r["at"], "temperature_celsius": r["t"]} for r in rows]).encode()).hexdigest())


#: Families of consignment events by the beginning of their type, and what a consignment's name may be.
FAMILIES = {"catch": "fisheries.catch.", "custody": "fisheries.custody.", "coldchain": "coldchain.", "export": "export."}
CONSIGNMENT = r"\A[A-Za-z0-9][A-Za-z0-9._-]{0,127}\z"


def consignments(events: DataFrame) -> DataFrame:
    """One row for each consignment with exactly one catch: custody, temperatures and their digest, last export, the highest clearance of its events (unlabelled: SECRET). An event of any other family is refused, and so is an empty batch."""
    family = F.coalesce(*[F.when(F.col("event_type").startswith(p), F.lit(k)) for k, p in FAMILIES.items()])
    fields = {"consignmentId": "text!", "speciesCode": "text", "catchWeightKg": "number", "temperatureCelsius": "number", "exportReference": "text"}
    f, kind = F.col("f"), F.col("kind")
    level = F.when(F.col("record_classification").isNull(), F.lit(3)).otherwise(rank(F.col("record_classification")))

    def rules(f: Column) -> dict[str, Column]:
        no = lambda c: ~F.coalesce(c, F.lit(False))
        return {
            "family": kind.isNull(), "consignmentId": ~f["consignmentId"].rlike(CONSIGNMENT), "record_classification": level.isNull(),
            "catch": F.coalesce(kind == "catch", F.lit(False)) & (no(is_canonical_text(f["speciesCode"], 64)) | no((f["catchWeightKg"] >= 0) & (f["catchWeightKg"] < float("inf")))),
            "temperatureCelsius": F.coalesce(kind == "coldchain", F.lit(False)) & no(f["temperatureCelsius"].between(-80, 60)),
            "exportReference": F.coalesce(kind == "export", F.lit(False)) & no(is_canonical_text(f["exportReference"], 256)),
        }

    read = with_domain_fields(events.withColumn("kind", family), fields)
    fault, name = _first_fault(rules(f)), f["consignmentId"].alias("consignment_id")
    # faults and catches are counted in one pass; only if any are wrong another names some
    told = read.groupBy(name).agg(F.count(fault).alias("faults"), F.count_if(kind == "catch").alias("catches"))
    n, faulty, odd = told.agg(F.count(F.lit(1)), F.sum("faults"), F.count_if(F.col("catches") != 1)).first()
    if not n:
        raise Refused("no events to assemble consignments from")
    if faulty:
        raise Refused(f"consignment events: {found_faults(read, fault)}")
    if odd:
        refuse(told, F.col("catches") != 1, "consignments without exactly one catch", "consignment_id")
    of = lambda k, c: F.when(kind == k, c)
    at = F.struct("occurred_at", "event_id")
    micros = F.pmod(F.unix_micros("occurred_at"), F.lit(1_000_000))  # written only where there are some
    text = F.concat(F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))), F.date_format("occurred_at", "xxx"))
    sample = F.struct(F.col("occurred_at"), F.col("event_id"), text.alias("at"), f["temperatureCelsius"].alias("t"))
    made = read.groupBy(name).agg(
        F.max(of("catch", F.col("event_id"))).alias("catch_event_id"), F.max(of("catch", F.col("occurred_at"))).alias("catch_occurred_at"), F.max(of("catch", f["speciesCode"])).alias("species_code"), F.max(of("catch", f["catchWeightKg"])).alias("catch_weight_kg"),
        F.array_sort(F.collect_list(of("custody", F.col("event_id")))).alias("custody"), F.array_sort(F.collect_list(of("coldchain", sample))).alias("samples"), F.min(of("coldchain", f["temperatureCelsius"])).alias("min_temperature_celsius"), F.max(of("coldchain", f["temperatureCelsius"])).alias("max_temperature_celsius"),
        F.max_by(f["exportReference"], of("export", at)).alias("export_reference"), F.max(level).alias("level"), F.array_sort(F.collect_list("event_id")).alias("ids"),
    )
    return made.select(
        "consignment_id", "catch_event_id", "catch_occurred_at", "species_code", "catch_weight_kg", F.size("custody").cast("long").alias("custody_event_count"), F.to_json("custody").alias("custody_event_ids_json"), F.size("samples").cast("long").alias("coldchain_sample_count"),
        "min_temperature_celsius", "max_temperature_celsius", sample_digest(F.transform("samples", lambda s: F.struct(s["event_id"].alias("event_id"), s["at"].alias("at"), s["t"].alias("t")))).alias("coldchain_digest_sha256"), "export_reference", F.element_at(F.lit(list(CLEARANCES)), F.col("level").cast("int") + 1).alias("record_classification"), F.to_json("ids").alias("source_event_ids_json"),
    )


def nearest_rank(rows: DataFrame, value: str, *keys: str, least: int = 5) -> DataFrame:
    """p50, p90, p95 by nearest rank, and the mean, of the finite values from 0 on, where there are at least `least`; else a note."""
    enough = F.col("n") >= least
    q = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})")
    made = rows.where((F.col(value) >= 0) & (F.col(value) < float("inf"))).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), q(0.5).alias("p50"), q(0.9).alias("p90"), q(0.95).alias("p95"), F.avg(value).alias("mean"))
    return made.select(*keys, "n", *[F.when(enough, F.col(c)).alias(c) for c in ("p50", "p90", "p95", "mean")], F.when(~enough, F.lit("INSUFFICIENT_DATA")).alias("note"))


def snapshot(figures: dict, period: str) -> dict:
    """Figures of a period with the digest of their canonical form."""
    body = {"figures": figures, "period": period}
    return body | {"sha256": hashlib.sha256(canonical_json(body).encode()).hexdigest()}


def paper_visits_avoided(digital: DataFrame, share: float = 0.5) -> float:
    """Estimated visits that digital submissions have replaced."""
    return digital.count() * share


def as_json(rows: DataFrame) -> list[dict]:
    return [json.loads(x) for x in rows.toJSON().collect()]
