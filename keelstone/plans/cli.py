"""The jobs as commands, for spark-submit: python -m keelstone.plans.cli COMMAND --scope NAME ...

Tables lie under the root that the environment's storage names (STORAGE_BACKEND, STORAGE_ROOT). A job prints its report as one line
of JSON and, with --report, writes it as a file that is there as a whole or not at all. Exit status: 0 done, 1 refused (the cause on
standard error, no report), 2 wrong arguments.
"""

from __future__ import annotations

import argparse
import base64
import json
import re
import sys
from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import Refused
from ..functions.signing import load_key_directory
from ..functions.text import PATTERNS
from ..operators import export, retention, vessels
from ..operators.governance import LAYERS, PREFIXES, Scope
from ..session import ship
from ..sources import envelopes, storage
from ..sources.tables import VersionedTable
from ..streaming import ingest
from . import assembly

Job = Callable[[SparkSession, Scope, argparse.Namespace, dict[str, str]], dict]


def _merged(of: tuple[int, int, int]) -> dict:
    return dict(zip(("version", "written", "already_present"), of, strict=True))


def _events(spark: SparkSession, scope: Scope, path: str) -> DataFrame:
    """The file's events under their internal labels; refused if any is outside the scope."""
    return scope.check(ingest.labelled(envelopes.read_events(spark, path, F.current_timestamp())))


def ingest_file(spark, scope, given, env) -> dict:
    """An NDJSON file of envelopes into bronze, all of it or nothing."""
    return _merged(assembly.table(spark, scope, "bronze").append_new(_events(spark, scope, given.input), "event_id"))


def ingest_vessels(spark, scope, given, env) -> dict:
    """An NDJSON file of vessel envelopes into the typed observations of bronze, all of it or nothing."""
    events = _events(spark, scope, given.input)
    others = events.where(F.col("event_type") != vessels.KIND).select("event_type").distinct().limit(5).collect()
    if others:
        raise Refused(f"events that are no vessel observations: {[r[0] for r in others]}")
    return _merged(vessels.append_observations(assembly.table(spark, scope, "bronze", "vessel_observations"), events))


def ingest_stream(spark, scope, given, env) -> dict:
    """All that a topic, or a folder of NDJSON files, holds now into bronze and quarantine. Signatures are checked against the keys of --keys, without which nothing starts."""
    if not given.topic.startswith(PREFIXES[scope.name]):
        raise Refused(f"topic {given.topic} is outside {scope.name}")
    keys = load_key_directory(given.keys)
    if given.folder:
        lines = ingest.file_lines(spark, given.folder, given.topic)
    else:
        options = storage.kafka_options(env)
        lines = ingest.kafka_lines(spark, options.pop("kafka.bootstrap.servers"), given.topic, given.most, startingOffsets="earliest", **options)
    bronze, quarantine = (assembly.table(spark, scope, "bronze", name) for name in ("events", "quarantine"))
    before = {t: t.version() for t in (bronze, quarantine)}
    query = ingest.start(lines, scope, bronze, quarantine, given.checkpoint, keys)
    query.awaitTermination()
    return {"lines": sum(p["numInputRows"] for p in query.recentProgress), "bronze_version": bronze.version(), "quarantine_version": quarantine.version(), "changed": any(t.version() != v for t, v in before.items())}


def promote(spark, scope, given, env) -> dict:
    """Bronze into silver, with the coordinates of a Parquet table (event_id, kafka_topic, kafka_partition, kafka_offset)."""
    return _merged(assembly.promote(spark, scope, spark.read.parquet(given.coordinates)))


def gold(spark, scope, given, env) -> dict:
    """The scope's gold products anew; with --period, the month's port statistics before them."""
    made = {}
    if given.period:
        if scope.name != "platform":
            raise Refused("port statistics are of the platform scope")
        if bool(env.get("REPORT_SIGNING_SEED")) != bool(env.get("REPORT_SIGNING_KID")):
            raise Refused("a signing seed and its key id go together")
        seed = _seed(env["REPORT_SIGNING_SEED"]) if env.get("REPORT_SIGNING_SEED") else None
        made["month"] = assembly.publish_month(spark, scope, given.period, datetime.now(UTC), given.reports, seed, env.get("REPORT_SIGNING_KID", ""))
    return made | {"products": assembly.assemble(spark, scope)}


def _seed(text: str) -> bytes:
    try:
        seed = base64.b64decode(text, validate=True)
    except ValueError:
        seed = b""
    if len(seed) != 32:
        raise Refused("a signing seed is 32 bytes in base64")
    return seed


def rebuild_tracks(spark, scope, given, env) -> dict:
    """Trajectories, and with --fences (a Parquet table) their summary."""
    fences = spark.read.parquet(given.fences) if given.fences else None
    return assembly.rebuild_tracks(spark, scope, fences, given.gap_seconds, given.tolerance)


def enforce_retention(spark, scope, given, env) -> dict:
    """What has expired, audited; deleted only with --apply."""
    at = lambda layer, name: VersionedTable(spark, scope.table(layer, name))
    policy = retention.Retention(given.hot_days, given.cold_years)
    archive = at(given.layer, given.archive) if given.archive else None
    return retention.enforce(at(given.layer, given.table), at(given.layer, f"{given.table}_retention_audit"), policy, given.reference or datetime.now(UTC), given.apply, given.operator, archive, given.key)


def export_table(spark, scope, given, env) -> dict:
    """A version of a table with a WKT geometry as GeoParquet under the root of the storage: a file, or with --whole-folder any number of rows."""
    table = assembly.table(spark, scope, given.layer, given.table)
    version = table.version()
    if given.whole_folder:
        place = storage.export_target(given.output, env)
        box, kinds, n = export.export_folder(table.read(version), given.geometry, place)
        return {"written": place, "bbox": box, "geometry_types": kinds, "row_count": n, "table_version": version}
    return export.export_geoparquet(table.read(version), given.geometry, given.output, table.uri, version, given.id_columns, env)


def _instant(text: str) -> datetime:
    made = datetime.fromisoformat(text)
    if made.tzinfo is None:
        raise argparse.ArgumentTypeError("a time has a zone")
    return made


def _period(text: str) -> str:
    if not re.match(PATTERNS["period"][:-2] + r"\Z", text):
        raise argparse.ArgumentTypeError("a period is YYYY-MM")
    return text


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="keelstone", description=__doc__.partition("\n")[0])
    commands = parser.add_subparsers(required=True, metavar="COMMAND")

    def command(name: str, job: Job):
        made = commands.add_parser(name, help=job.__doc__, description=job.__doc__)
        made.set_defaults(job=job)
        made.add_argument("--scope", required=True, choices=sorted(PREFIXES))
        made.add_argument("--report", help="file for the report")
        return made.add_argument

    command("ingest-file", ingest_file)("--input", required=True)
    command("ingest-vessels", ingest_vessels)("--input", required=True)
    of = command("ingest-stream", ingest_stream)
    of("--topic", required=True)
    of("--folder", help="NDJSON files that stand for the topic; without it Kafka, as the environment's KAFKA_... say")
    of("--keys", required=True, help="JSON object of key ids and public keys")
    of("--checkpoint", required=True)
    of("--most", type=int, default=envelopes.MAX_RECORDS, help="messages a batch")
    command("promote", promote)("--coordinates", required=True)
    of = command("gold", gold)
    of("--period", type=_period)
    of("--reports", help="folder for the month's report")
    of = command("tracks", rebuild_tracks)
    of("--fences")
    of("--gap-seconds", type=float, default=7200)
    of("--tolerance", type=float, default=0.001)
    of = command("retention", enforce_retention)
    of("--layer", default="bronze", choices=LAYERS)
    of("--table", default="events")
    of("--key", default="event_id")
    of("--operator", required=True, help="who enforces")
    of("--apply", action="store_true", help="delete; without it the plan is audited only")
    of("--archive", help="table of the layer that cold rows go to")
    of("--hot-days", type=int, default=30)
    of("--cold-years", type=int, default=7)
    of("--reference", type=_instant, help="time that ages are counted to, with its zone; now by default")
    of = command("export", export_table)
    of("--layer", default="silver", choices=LAYERS)
    of("--table", default="trajectories")
    of("--geometry", default="geometry_wkt")
    of("--output", required=True)
    of("--id-columns", nargs="*", default=[])
    of("--whole-folder", action="store_true")
    return parser


def main(argv: Sequence[str] | None = None, env: dict[str, str] | None = None, spark: SparkSession | None = None) -> int:
    given, env = arguments().parse_args(argv), storage.environment() if env is None else env
    try:
        _, root, options = storage.resolve(env)
        scope = Scope(given.scope, root)
        if spark is None:
            builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC")
            for k, v in options.items():
                builder = builder.config(k, v)
            spark = builder.getOrCreate()
        report = {"scope": scope.name, "job": given.job.__name__} | given.job(ship(spark), scope, given, env)
        text = json.dumps(report, sort_keys=True, default=str)
        if given.report:
            assembly.write_atomically(given.report, text)
    except (ValueError, OSError) as e:  # Refused is a ValueError
        print(f"refused: {e}", file=sys.stderr)
        return 1
    print(text)
    return 0


if __name__ == "__main__":
    sys.exit(main())
