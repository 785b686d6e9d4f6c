"""From a stream of signed envelopes to bronze: rejects to quarantine first, accepted rows by insert-only merge, then the checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.signing import envelope_fault
from ..operators.governance import Scope, internal_label
from ..sources.envelopes import MAX_LINE, event_columns, event_faults, faults, parsed
from ..sources.tables import VersionedTable

#: Text of a fault that is kept.
DETAIL = 512


def classified(batch: DataFrame, keys: dict[str, bytes] | None, at: Column) -> DataFrame:
    """Lines (line, topic, partition, offset, and `raw`, their bytes, if the source has them) with their envelope, the internal `event` it becomes, and `reason`: empty, or the first cause to reject the line. Of repeated ids in a batch the first good one by (partition, offset) is accepted."""
    rows = parsed(batch).withColumn("faults", faults())
    trust = envelope_fault(F.col("line"), keys) if keys is not None else F.lit("")
    rows = rows.withColumn("trust", F.when(F.size("faults") == 0, trust))
    garbled = F.coalesce(~F.is_valid_utf8("raw"), F.lit(False)) if "raw" in batch.columns else F.lit(False)
    rows = rows.withColumn("reason", F.when(F.octet_length("line") > MAX_LINE, "oversized").when(garbled | F.array_contains("faults", "document"), "malformed-json").when(F.size("faults") > 0, "schema-violation").when(F.col("trust") != "", F.col("trust")).otherwise(""))
    sound = rows.where("reason = ''").withColumn("event", F.struct(*event_columns(at))).withColumn("faults", event_faults("event."))
    sound = sound.withColumn("reason", F.when(F.size("faults") > 0, "invalid-event").otherwise(""))
    again = F.row_number().over(Window.partitionBy("e.eventId").orderBy("partition", "offset"))
    good = sound.where("reason = ''").withColumn("again", again).withColumn("reason", F.when(F.col("again") > 1, "duplicate-in-batch").otherwise(""))
    return good.drop("again").unionByName(sound.where("reason != ''")).unionByName(rows.where("reason != ''"), allowMissingColumns=True)


def quarantine_rows(rejected: DataFrame, at: Column) -> DataFrame:
    """Rejected lines as records with an id of their coordinates, so that a replay finds them there."""
    coordinates = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    raw = F.coalesce(F.col("raw"), F.col("line").cast("binary")) if "raw" in rejected.columns else F.col("line").cast("binary")
    return rejected.select(
        F.sha2(coordinates, 256).alias("dlq_event_id"), "reason", F.substring(F.array_join("faults", ","), 1, DETAIL).alias("detail"), "topic", "partition", "offset",
        F.sha2(raw, 256).alias("payload_sha256"), F.base64(raw).alias("payload_base64"), F.octet_length(raw).cast("long").alias("payload_bytes"), at.alias("ingested_at"),
    )


def ingest_batch(batch: DataFrame, scope: Scope, bronze: VersionedTable, quarantine: VersionedTable, keys: dict[str, bytes] | None, at: Column | None = None) -> dict[str, int]:
    """Write one batch: quarantine, then bronze. Both merges are idempotent, so a batch that is replayed after a failure changes nothing twice."""
    at = F.current_timestamp() if at is None else at
    rows = classified(batch, keys, at).persist()
    try:
        events = labelled(rows.where("reason = ''").select("event.*"))
        counts = {r.reason or "accepted": r.n for r in rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
        if sum(v for k, v in counts.items() if k != "accepted"):
            # equal lines of a file have equal coordinates and are one record
            quarantine.append_new(quarantine_rows(rows.where("reason != ''"), at).dropDuplicates(["dlq_event_id"]), "dlq_event_id")
        if counts.get("accepted"):
            version, written, present = bronze.append_new(scope.check(events), "event_id")
            counts |= {"version": version, "written": written, "already_present": present}
        return counts
    finally:
        rows.unpersist()


def labelled(events: DataFrame) -> DataFrame:
    """Events with the internal label of their classification and type, `unmapped` if there is none."""
    label = internal_label(F.col("data_classification"), F.col("event_type"))
    return events.withColumn("data_classification", F.coalesce(label, F.lit("unmapped")))


def start(lines: DataFrame, scope: Scope, bronze: VersionedTable, quarantine: VersionedTable, checkpoint: str, keys: dict[str, bytes] | None = None) -> StreamingQuery:
    """Ingest all that is there now from a streaming frame of (line, topic, partition, offset); offsets are committed only after both writes."""
    return lines.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: ingest_batch(df, scope, bronze, quarantine, keys)).start()


def file_lines(spark, folder: str, topic: str) -> DataFrame:
    """A folder of NDJSON files as a stream. Coordinates come from the file and the line's hash, so they hold over replays."""
    lines = spark.readStream.text(folder)
    return lines.select(F.col("value").alias("line"), F.lit(topic).alias("topic"), F.pmod(F.xxhash64(F.col("_metadata.file_path")), F.lit(1 << 31)).cast("int").alias("partition"), F.pmod(F.xxhash64("value"), F.lit(1 << 62)).alias("offset")).where(F.trim("line") != "")


def kafka_lines(spark, servers: str, topic: str, most: int = 100_000, **options: str) -> DataFrame:
    """A topic as a stream, `most` messages a batch; needs Spark's Kafka package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("maxOffsetsPerTrigger", str(most))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("line"), F.col("value").alias("raw"), "topic", "partition", "offset")
