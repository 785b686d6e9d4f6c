"""A read-only HTTP shell over the published figures: health, runs, values by equality, reports."""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import AccessError, Refused
from ..operators import ports, serving
from ..operators.governance import Policy, Scope
from .assembly import table

#: An answer of more rows is refused; it has to be narrowed by values to equal.
MAX_ROWS = 10_000


def _rows(df: DataFrame) -> list:
    """All rows, or none if they are more than MAX_ROWS."""
    found = [json.loads(x) for x in df.limit(MAX_ROWS + 1).toJSON().collect()]
    if len(found) > MAX_ROWS:
        raise TooMany(f"more than {MAX_ROWS} rows; narrow the question")
    return found


class TooMany(Exception):
    """An answer that would have to be cut."""


def answer(spark: SparkSession, scope: Scope, policy: Policy, secret: bytes, target: str, authorization: str | None) -> tuple[int, object]:
    """Status and body of a GET request. Only published tables are read; a missing one is 503."""
    url = urlsplit(target)
    if url.path == "/health":
        return 200, {"status": "ok"}
    try:
        roles = serving.bearer_roles(authorization, secret)
    except AccessError:
        return 401, {"error": "unauthorized"}
    try:
        policy.authorize(roles, f"{scope.name}_gold", "UNCLASSIFIED")
    except AccessError:
        return 403, {"error": "forbidden"}
    if url.path == "/kpis":
        return 200, [{"kpi_id": k.kpi_id, "unit": k.unit, "gap": k.gap, "version": k.version} for k in ports.KPIS]
    runs, values = (table(spark, scope, "gold", n) for n in ("port_kpi_runs", "port_kpi_values"))
    if not runs.exists() or not values.exists():
        return 503, {"error": "nothing is published"}
    try:
        if url.path == "/runs":
            return 200, _rows(serving.list_runs(runs.read()))
        if url.path == "/values":
            return 200, _rows(serving.values(values.read(), runs.read(), **dict(parse_qsl(url.query, strict_parsing=bool(url.query)))))
        if url.path.startswith("/reports/"):
            run = url.path.removeprefix("/reports/")
            found = runs.read().where(F.col("run_id") == run).collect()
            return (200, serving.report(values.read().where(F.col("run_id") == run), run, found[0].period)) if found else (404, {"error": "no such run"})
    except TooMany as e:
        return 413, {"error": str(e)}
    except (Refused, ValueError) as e:
        return 400, {"error": str(e)}
    return 404, {"error": "no such page"}


def serve(spark: SparkSession, scope: Scope, policy: Policy, secret: bytes, port: int = 0) -> ThreadingHTTPServer:
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            status, body = answer(spark, scope, policy, secret, self.path, self.headers.get("Authorization"))
            data = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
