"""Read-only serving of published figures: runs, values by equality filters, reports; and bearer tokens."""

from __future__ import annotations

import csv
import hashlib
import hmac
import io
import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import AccessError, Refused
from ..functions.canonical import canonical_json
from ..functions.signing import b64url, from_b64url, sign_document

FILTERS = ("kpi_id", "period", "port_code", "ship_class", "percentile")


def list_runs(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("created_at"), "run_id")


def values(value_rows: DataFrame, runs: DataFrame, **filters: str) -> DataFrame:
    """Published rows that match, with their run's manifest; nulls sort as the text None. A row whose run is unknown is an error."""
    unknown = filters.keys() - set(FILTERS)
    if unknown:
        raise Refused(f"can't filter by {sorted(unknown)}")
    rows = value_rows
    for c, v in filters.items():
        rows = rows.where(F.col(c) == v)
    lost = rows.join(runs, "run_id", "left_anti").select("run_id").distinct().limit(5).collect()
    if lost:
        raise Refused(f"values of unknown runs: {[r[0] for r in lost]}")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    manifest = runs.select("run_id", *[c for c in runs.columns if c not in rows.columns])
    return rows.join(manifest, "run_id").orderBy(text("kpi_id"), text("period"), text("port_code"), text("ship_class"), text("percentile"), "run_id")


def report(value_rows: DataFrame, run: str, period: str, seed: bytes | None = None, kid: str = "") -> dict:
    """Core of a run's report with its digest and, given a key, its signature. Rows are a dozen figures by the ports."""
    rows = [json.loads(x) for x in values_of(value_rows).toJSON().collect()]
    core = {"period": period, "run_id": run, "values": rows}
    out = {"core": core, "sha256": hashlib.sha256(canonical_json(core).encode()).hexdigest()}
    return out | ({"signature": sign_document({"sha256": out["sha256"]}, seed, kid)} if seed else {})


def values_of(value_rows: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c), F.lit("None"))
    return value_rows.orderBy("kpi_id", text("port_code"), text("ship_class"), text("percentile"))


def report_csv(core: dict) -> str:
    columns = ["kpi_id", "period", "port_code", "ship_class", "percentile", "value", "unit", "n_observations", "note"]
    out = io.StringIO()
    w = csv.DictWriter(out, columns, extrasaction="ignore", lineterminator="\n")
    w.writeheader()
    w.writerows({c: r.get(c) for c in columns} for r in core["values"])
    return out.getvalue()


def bearer_roles(header: str | None, secret: bytes, now: float | None = None) -> list[str]:
    """Roles of an HS256 bearer token that hasn't expired."""
    try:
        kind, token = (header or "").split(" ")
        head, body, signature = token.split(".")
        good = hmac.compare_digest(hmac.digest(secret, f"{head}.{body}".encode(), "sha256"), from_b64url(signature))
        claims = json.loads(from_b64url(body))
        if kind != "Bearer" or not good or json.loads(from_b64url(head)).get("alg") != "HS256" or claims["exp"] <= (time.time() if now is None else now):
            raise AccessError("token isn't valid")
        return [str(r) for r in claims["roles"]]
    except (ValueError, KeyError, TypeError) as e:
        raise AccessError("token isn't valid") from e


def bearer(claims: dict, secret: bytes) -> str:
    head, body = (b64url(canonical_json(x).encode()) for x in ({"alg": "HS256", "typ": "JWT"}, claims))
    return f"Bearer {head}.{body}.{b64url(hmac.digest(secret, f'{head}.{body}'.encode(), 'sha256'))}"
