"""Retention: tiers by age, expired windows, and deletion with an audit that is written before anything goes."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import Refused
from ..functions.text import digest_key
from ..sources.tables import VersionedTable

DAY = 86_400_000_000


@dataclass(frozen=True)
class Retention:
    """30 hot days and 7 cold years of 365 days by default."""

    hot_days: int = 30
    cold_years: int = 7

    def __post_init__(self):
        if not (1 <= self.hot_days and 1 <= self.cold_years and self.cold_years * 365 > self.hot_days):
            raise Refused("the cold horizon has to be beyond the hot window")

    def tier(self, occurred_at: Column, reference: Column) -> Column:
        """hot, cold or expired; null for what is later than the reference, which is an error."""
        age = F.unix_micros(reference) - F.unix_micros(occurred_at)
        return F.when(age < 0, F.lit(None)).when(age <= self.hot_days * DAY, "hot").when(age <= self.cold_years * 365 * DAY, "cold").otherwise("expired")


def tiers(rows: DataFrame, policy: Retention, reference: datetime) -> DataFrame:
    """Rows with their tier; refused if any is later than the reference."""
    made = rows.withColumn("tier", policy.tier(F.col("occurred_at"), F.lit(reference)))
    if made.where("tier is null").limit(1).count():
        raise Refused("rows without a time or later than the reference")
    return made


def report(rows: DataFrame, policy: Retention, reference: datetime) -> dict[str, int]:
    found = {r.tier: r["count"] for r in tiers(rows, policy, reference).groupBy("tier").count().collect()}
    return {t: found.get(t, 0) for t in ("hot", "cold", "expired")}


def windows(rows: DataFrame, key: str = "event_id") -> DataFrame:
    """(day, n_rows, keys_sha256, audit_id), a row a day. The day's keys are digested without collecting them in order in one place: as the sum of their hashes."""
    days = rows.groupBy(F.to_date("occurred_at").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(key).cast("decimal(38,0)")).cast("string").alias("s"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    return days.withColumn("keys_sha256", F.sha2(F.concat_ws("/", F.col("n_rows").cast("string"), "s", F.col("first_key").cast("string"), F.col("last_key").cast("string")), 256)).withColumn("audit_id", digest_key(F.col("day"), F.col("keys_sha256"))).drop("s")


def plan(rows: DataFrame, policy: Retention, reference: datetime, key: str = "event_id") -> DataFrame:
    """The windows of what has expired."""
    return windows(tiers(rows, policy, reference).where("tier = 'expired'"), key)


def recheck(keys: DataFrame, current: DataFrame, policy: Retention, reference: datetime, key: str = "event_id") -> None:
    """Refused unless every key is still in the table and expired there."""
    held = current.select(key, policy.tier(F.col("occurred_at"), F.lit(reference)).alias("__tier"))
    bad = keys.join(held, key, "left").where("__tier is null or __tier <> 'expired'").limit(5).collect()
    if bad:
        raise Refused(f"keys that are gone or not expired: {[(r[0], r[1]) for r in bad]}")


def enforce(table: VersionedTable, audit: VersionedTable, policy: Retention, reference: datetime, apply: bool, operator: str, archive: VersionedTable | None = None, key: str = "event_id") -> dict:
    """Audit what has expired, and (if `apply`) archive what is cold, check the keys again, delete what has expired in one new version, audit that, and look whether just that is gone.

    Audited are windows of a day by what is done with them: plan-delete before anything goes, tier-archive and delete once it is
    done. The same plan of one operator, version and time is audited once. All statements of one run are about one version of
    the table; properties, append-only among them, hold on in the new one.
    """
    if not operator or operator != operator.strip():
        raise Refused("the audit names who enforces")
    version = table.version()
    rows = table.read(version)
    tiered = tiers(rows, policy, reference)
    expired, cold = (tiered.where(F.col("tier") == t).drop("tier") for t in ("expired", "cold"))

    def audited(mode: str, about: DataFrame) -> tuple[int, int]:
        told = {"mode": mode, "operator": operator, "table_uri": table.uri, "table_version": version, "policy_hot_days": policy.hot_days, "policy_cold_years": policy.cold_years, "reference_time": reference}
        made = windows(about, key).withColumns({name: F.lit(value) for name, value in told.items()})
        made = made.withColumn("audit_id", digest_key(*[F.col(c) for c in ("audit_id", "mode", "operator", "table_uri", "table_version", "policy_hot_days", "policy_cold_years")], F.unix_micros("reference_time"))).withColumn("executed_at", F.current_timestamp())
        n = made.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
        if n[0]:
            audit.append_new(made, "audit_id", ignore=("executed_at",))
        return n[0], n[1]

    n, planned = audited("plan-delete", expired)
    deleted = 0
    if apply and archive is not None:
        archive.append_new(cold, key)
        audited("tier-archive", cold)
    if apply and n:
        recheck(expired.select(key), table.read(), policy, reference, key)
        _, deleted = table.delete_keys(expired.select(key), key)
        audited("delete", expired)
        if deleted != planned or report(table.read(), policy, reference)["expired"]:
            raise Refused(f"{deleted} rows of {planned} went, or expired rows are still there")
    return {"windows": n, "deleted": deleted, "dry_run": not apply}
