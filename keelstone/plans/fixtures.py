"""Queries over events that are made of the tables: the products' operators, and what SQL can't give (binary geometry, signatures)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import ais, canonical, geometry, signing
from ..operators import ports, products, tracks
from ..sources.envelopes import with_domain_fields
from ..sources.tables import VersionedTable
from .workload import query, table


def _observations(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.select(F.lpad(F.col("user_id").cast("string"), 9, "2").alias("mmsi"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event_id"), F.col("ts").alias("occurred_at"), (F.col("value") / 10).alias("longitude"), ((F.col("user_id") % 60) + F.pmod("event_id", F.lit(10)) / F.lit(100.0)).cast("double").alias("latitude"))


@query()
def trajectories(spark, sf_dir):
    """Segmented, simplified tracks as text geometry."""
    return tracks.trajectories(_observations(spark, sf_dir), gap_seconds=12 * 3600, tolerance=0.5)


@query("""
    WITH p AS (
        SELECT lpad(CAST(user_id AS VARCHAR), 9, '2') AS mmsi, event_id, epoch_us(ts) AS us, value / 10 AS lon, (user_id % 60)::DOUBLE + (event_id % 10) / 100.0 AS lat FROM events
    ), l AS (
        SELECT *, lag(lon) OVER w AS lon0, lag(lat) OVER w AS lat0, us - lag(us) OVER w AS gap FROM p WINDOW w AS (PARTITION BY mmsi ORDER BY us, event_id)
    ), m AS (
        SELECT *, gap IS NULL OR gap > 43200000000 AS begins,
            2 * 6371008.8 * asin(least(sqrt(pow(sin(radians(lat - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat)) * pow(sin(radians(lon - lon0) / 2), 2)), 1.0)) AS metres FROM l
    ), s AS (
        SELECT *, sum(CASE WHEN begins AND gap IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY mmsi ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS segment FROM m
    ), t AS (
        SELECT mmsi, segment, count(*) AS n_points, min(us) AS first_us, max(us) AS last_us, sum(CASE WHEN begins THEN 0 ELSE metres END) AS length, sum(CASE WHEN begins THEN 0 ELSE gap END) AS elapsed FROM s GROUP BY mmsi, segment
    )
    SELECT mmsi, CAST(segment AS BIGINT) AS segment_index, n_points, first_us, last_us, CAST(round(length, 1) AS DOUBLE) AS length_metres, CAST(elapsed AS BIGINT) AS elapsed_us,
        CAST(CASE WHEN elapsed > 0 THEN round(length / (elapsed / 1e6), 3) ELSE 0 END AS DOUBLE) AS mean_speed FROM t
""")
def reconstructed_tracks(spark, sf_dir):
    """Length, duration and mean speed of segments."""
    made = tracks.reconstructed(_observations(spark, sf_dir), gap_hours=12)
    return made.select(
        "mmsi", F.col("segment_index").cast("long").alias("segment_index"), "n_points", F.unix_micros("started_at").alias("first_us"), F.unix_micros("ended_at").alias("last_us"),
        F.round("length_metres", 1).alias("length_metres"), F.round(F.col("seconds") * 1e6).cast("long").alias("elapsed_us"), F.round("mean_speed", 3).alias("mean_speed"),
    )


@query()
def wkb_roundtrip(spark, sf_dir):
    """Text geometry as well-known binary with its extent."""
    lines = trajectories(spark, sf_dir)
    return lines.select("trajectory_id", geometry.wkt_to_wkb("simplified_wkt").alias("g")).select("trajectory_id", F.hex("g.wkb").alias("wkb_hex"), "g.kind", "g.min_x", "g.max_y")


@query("""
    WITH sorted AS (
        SELECT event_id, '{"event_type":' || to_json(event_type) || ',"props":' || to_json(props) || ',"value":' || CAST(value AS VARCHAR) || '}' AS sorted FROM events
    )
    SELECT event_id, sorted, sha256(regexp_replace(sorted, '[.]0}$', '}')) AS jcs_sha256 FROM sorted
""")
def canonical_documents(spark, sf_dir):
    """Event properties in both canonical forms, with digests."""
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct("value", "event_type", "props")).alias("j"))
    return rows.select("event_id", canonical.to_canonical_json("j").alias("sorted"), F.sha2(canonical.to_jcs("j"), 256).alias("jcs_sha256"))


@query()
def signed_envelopes(spark, sf_dir):
    """Envelopes of nations, signed on the driver and verified on the executors."""
    seed = bytes(range(32))
    names = [r.n_name for r in table(spark, sf_dir, "nation").select("n_name").orderBy("n_name").collect()]  # 25 of them
    signed = [signing.dumps(signing.signed_envelope({"eventId": n, "provenance": {"principalId": "p"}}, seed if k % 5 else bytes(32), "k1")) for k, n in enumerate(names)]
    rows = spark.createDataFrame(list(zip(names, signed, strict=True)), "name string, envelope string")
    return rows.select("name", signing.envelope_fault(F.col("envelope"), {"k1": signing.public_key(seed)}).alias("fault"))


@query("""
    WITH bodies AS (
        SELECT event_id, 'AIVDM,1,1,,A,1' || translate(substr(md5(CAST(event_id AS VARCHAR)), 1, 27), 'abcdef', 'PQRSTU') || ',0' AS body FROM events
    ), bits AS (
        SELECT event_id, list_aggregate(list_transform(string_split(split_part(body, ',', 6), ''), lambda c: lpad(bin(ascii(c) - 48 - CASE WHEN ascii(c) - 48 > 40 THEN 8 ELSE 0 END), 6, '0')), 'string_agg', '') AS b FROM bodies
    ), numbers AS (
        SELECT event_id,
            CAST(list_sum(list_transform(range(6), lambda i: CAST(b[1 + i] AS BIGINT) << (5 - i))) AS INTEGER) AS message_type,
            CAST(list_sum(list_transform(range(30), lambda i: CAST(b[9 + i] AS BIGINT) << (29 - i))) AS BIGINT) AS m,
            CAST(list_sum(list_transform(range(28), lambda i: CAST(b[62 + i] AS BIGINT) << (27 - i))) AS BIGINT) - CASE WHEN b[62] = '1' THEN 1 << 28 ELSE 0 END AS x,
            CAST(list_sum(list_transform(range(27), lambda i: CAST(b[90 + i] AS BIGINT) << (26 - i))) AS BIGINT) - CASE WHEN b[90] = '1' THEN 1 << 27 ELSE 0 END AS y
        FROM bits
    ), placed AS (SELECT *, event_id % 7 <> 3 AS sound, abs(x) <= 108000000 AND abs(y) <= 54000000 AS here FROM numbers)
    SELECT event_id, sound AS valid, CASE WHEN sound THEN message_type ELSE 0 END AS message_type,
        CASE WHEN NOT sound THEN NULL WHEN m < 1000000000 THEN lpad(CAST(m AS VARCHAR), 9, '0') ELSE CAST(m AS VARCHAR) END AS mmsi,
        CASE WHEN sound AND here THEN x / 600000.0::DOUBLE END AS longitude, CASE WHEN sound AND here THEN y / 600000.0::DOUBLE END AS latitude,
        CASE WHEN NOT sound THEN 'not a valid sentence' END AS fault
    FROM placed
""")
def ais_checksums(spark, sf_dir):
    """Position reports made of digests of all events, every seventh with a wrong checksum: checksums told by Catalyst, and what the sentences decode to."""
    body = F.concat(F.lit("AIVDM,1,1,,A,1"), F.translate(F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 27), "abcdef", "PQRSTU"), F.lit(",0"))
    codes = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), F.ascii)
    wrong = F.when(F.col("event_id") % 7 == 3, 1).otherwise(0)
    check = F.lpad(F.hex(F.aggregate(codes, wrong, lambda a, c: a.bitwiseXOR(c))), 2, "0")
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("!"), body, F.lit("*"), check).alias("s"))
    return rows.select("event_id", ais.sentence_valid(F.col("s")).alias("valid"), ais.decode_reports(F.array("s")).alias("r")).select("event_id", "valid", F.coalesce("r.message_type", F.lit(0)).alias("message_type"), "r.mmsi", "r.longitude", "r.latitude", "r.fault")


def event(kind, i, at, *fields):
    """An event as a struct: its id is made of its kind and a key, its payload of the fields that aren't null."""
    return F.struct(F.concat_ws("-", F.lit(kind), i.cast("string")).alias("event_id"), F.lit(kind).alias("event_type"), at.alias("occurred_at"), F.to_json(F.struct(*fields)).alias("payload_json"))


def carried(*fields):
    """Fields as a resource that carries them in a domain document."""
    document = F.to_json(F.struct(*fields))
    return F.array(F.struct(F.lit("urn:other").alias("url"), F.lit(None).cast("string").alias("valueString")), F.struct(F.lit("https://example.org/StructureDefinition/domain-payload").alias("url"), document.alias("valueString"))).alias("extension")


def instant_text(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def events_of(rows, *events):
    return rows.select(F.explode(F.array(*events)).alias("e")).where("e is not null").select("e.*")  # compacting the array first would make its events twice, to infer a filter


def _port_events(spark, sf_dir):
    """Events of port calls (two of one that has departed, the second in a domain document), gates and bookings, made of all orders."""
    orders, key, at = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_orderdate")
    port = F.concat(F.lit("AB"), F.lpad((F.col("o_custkey") % 7).cast("string"), 3, "0")).alias("portCode")
    plus = lambda n: F.timestamp_micros(F.unix_micros("o_orderdate") + key % n * 3_600_000_000)
    later = F.timestamp_micros(F.unix_micros("o_orderdate") + 3_600_000_000)
    call = key.cast("string").alias("portCallId")
    status = F.element_at(F.array(*map(F.lit, ("SUBMITTED", "REJECTED", "ACCEPTED", "ARRIVED", "BERTHED"))), (key % 5 + 1).cast("int")).alias("status")
    left = event(ports.CALL, F.concat(key.cast("string"), F.lit("-left")), later, call, port, F.lit("DRAFT").alias("status"), carried(F.lit("DEPARTED").alias("status"), instant_text(plus(11)).alias("berthedAt"), instant_text(plus(53)).alias("departedAt")))
    return events_of(
        orders,
        event(ports.CALL, key, at, call, port, status, F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("shipClass"), F.concat(F.lit("v"), F.col("o_custkey").cast("string")).alias("vesselRef"), instant_text(at).alias("arrivedAt"), F.col("o_totalprice").alias("declaredTonnage")),
        F.when(F.col("o_orderstatus") == "F", left),
        event(ports.SCAN, key, at, (F.col("o_custkey") % 50).cast("string").alias("truckRef"), F.when(key % 2 == 0, "in").otherwise("out").alias("direction"), F.lit("T1").alias("terminal"), port),
        event(ports.BOOKING, key, at, key.cast("string").alias("bookingId"), port, instant_text(at).alias("createdAt"), instant_text(plus(97)).alias("slotWindowStart"), F.lit(2.0).alias("bookedSlots"), F.lit(3.0).alias("offeredSlots")),
    )


MONTH = "1997-05"
#: The month's facts, scans and bookings, and what is observed in them, straight from the orders.
PORTS = """
WITH o AS (SELECT *, 'AB' || lpad(CAST(o_custkey % 7 AS VARCHAR), 3, '0') AS port, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS ship,
  CASE WHEN o_orderstatus = 'F' THEN 'DEPARTED' ELSE ['SUBMITTED', 'REJECTED', 'ACCEPTED', 'ARRIVED', 'BERTHED'][o_orderkey % 5 + 1] END AS status FROM orders),
f AS (SELECT *, status IN ('ACCEPTED', 'ARRIVED', 'BERTHED', 'DEPARTED') AS ok FROM o WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-01'),
g AS (SELECT port, o_orderkey % 2 AS way, lag(o_orderkey % 2) OVER w AS way0, (epoch_us(o_orderdate) - lag(epoch_us(o_orderdate)) OVER w) / 60000000.0 AS minutes FROM f WINDOW w AS (PARTITION BY o_custkey % 50 ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR))),
b AS (SELECT port, CAST(o_orderkey % 97 AS DOUBLE) AS hours FROM o WHERE o_orderdate + to_hours(o_orderkey % 97) >= TIMESTAMP '1997-05-01' AND o_orderdate + to_hours(o_orderkey % 97) < TIMESTAMP '1997-06-01'),
seen AS (
  SELECT 'vessel_calls' AS kpi_id, port AS port_code, ship AS ship_class, NULL::VARCHAR AS percentile, CAST(count(*) AS DOUBLE) AS value, count(*) AS n FROM f WHERE ok AND ship IS NOT NULL GROUP BY port, ship
  UNION ALL SELECT 'vessel_calls', port, NULL, NULL, CAST(count(*) AS DOUBLE), count(*) FROM f WHERE ok GROUP BY port
  UNION ALL SELECT 'throughput_tonnes', port, NULL, NULL, round(CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE), 6), count(*) FROM f WHERE ok GROUP BY port
  UNION ALL SELECT 'vessel_turnaround_hours', port, NULL, 'P50', round(quantile_cont(CAST(o_orderkey % 53 AS DOUBLE), 0.5), 6), count(*) FROM f WHERE o_orderstatus = 'F' GROUP BY port
  UNION ALL SELECT 'vessel_turnaround_hours', port, NULL, 'P90', round(quantile_cont(CAST(o_orderkey % 53 AS DOUBLE), 0.9), 6), count(*) FROM f WHERE o_orderstatus = 'F' GROUP BY port
  UNION ALL SELECT 'waiting_time_hours', port, NULL, 'P50', round(quantile_cont(CAST(o_orderkey % 11 AS DOUBLE), 0.5), 6), count(*) FROM f WHERE o_orderstatus = 'F' GROUP BY port
  UNION ALL SELECT 'waiting_time_hours', port, NULL, 'P90', round(quantile_cont(CAST(o_orderkey % 11 AS DOUBLE), 0.9), 6), count(*) FROM f WHERE o_orderstatus = 'F' GROUP BY port
  UNION ALL SELECT 'truck_gate_turnaround_minutes', port, NULL, 'P50', round(quantile_cont(minutes, 0.5), 6), count(*) FROM g WHERE way = 1 AND way0 = 0 GROUP BY port
  UNION ALL SELECT 'booking_lead_time_hours', port, NULL, 'P50', round(quantile_cont(hours, 0.5), 6), count(*) FROM b GROUP BY port
  UNION ALL SELECT 'slot_utilisation_pct', port, NULL, NULL, round(100.0 * 2 * count(*) / (3 * count(*)), 6), count(*) FROM b GROUP BY port)
"""


def _observed(spark, sf_dir):
    events = _port_events(spark, sf_dir)
    return ports.call_facts(events, MONTH), ports.gate_scans(events, MONTH), ports.bookings(events, MONTH)


def _seen(spark, sf_dir, kpi):
    return ports.observations(*_observed(spark, sf_dir)).where(F.col("kpi_id") == kpi)


@query(PORTS + """, ports AS (SELECT DISTINCT port FROM (SELECT port FROM f UNION ALL SELECT port FROM b)),
grid(kpi_id, unit, percentile, gap) AS (VALUES ('vessel_calls', 'calls', NULL, NULL), ('vessel_turnaround_hours', 'hours', 'P50', NULL), ('vessel_turnaround_hours', 'hours', 'P90', NULL), ('waiting_time_hours', 'hours', 'P50', NULL), ('waiting_time_hours', 'hours', 'P90', NULL),
  ('berth_occupancy_pct', 'percent', NULL, 'no authoritative number of berths'), ('throughput_tonnes', 'tonnes', NULL, NULL), ('truck_gate_turnaround_minutes', 'minutes', 'P50', NULL), ('booking_lead_time_hours', 'hours', 'P50', NULL), ('slot_utilisation_pct', 'percent', NULL, NULL), ('declaration_clearance_hours', 'hours', NULL, 'declarations aren''t bridged into this scope'))
SELECT grid.kpi_id, unit, '1.0.0' AS definition_version, grid.percentile, port AS port_code, ship_class, value, coalesce(n, 0) AS n_observations, CASE WHEN gap IS NOT NULL THEN 'GAP: ' || gap WHEN value IS NULL THEN 'NO_DATA' END AS note, 'run' AS run_id, '1997-05' AS period,
  sha256(concat_ws('/', 'run', grid.kpi_id, '1997-05', port, coalesce(ship_class, 'None'), coalesce(grid.percentile, 'None'))) AS value_key
FROM grid, ports LEFT JOIN seen ON seen.kpi_id = grid.kpi_id AND seen.port_code = port AND seen.percentile IS NOT DISTINCT FROM grid.percentile""")
def port_statistics(spark, sf_dir):
    """A month's key figures with rows for what has no data, from the events of all orders."""
    facts, scans, booked = _observed(spark, sf_dir)
    return ports.value_rows(spark, ports.observations(facts, scans, booked), ports.ports_of(facts, scans, booked), "run", MONTH)


@query(PORTS + """SELECT CAST(o_orderkey AS VARCHAR) AS port_call_id, port AS port_code, sha256('keelstone/vessel/v' || CAST(o_custkey AS VARCHAR)) AS vessel_ref_hashed, ship AS ship_class, status, epoch_us(o_orderdate) AS arrived_us,
CASE WHEN o_orderstatus = 'F' THEN epoch_us(o_orderdate) + o_orderkey % 11 * 3600000000 END AS berthed_us, CASE WHEN o_orderstatus = 'F' THEN epoch_us(o_orderdate) + o_orderkey % 53 * 3600000000 END AS departed_us, o_totalprice AS declared_tonnage,
CASE WHEN o_orderstatus = 'F' THEN '["ports.port-call.v1-' || o_orderkey || '","ports.port-call.v1-' || o_orderkey || '-left"]' ELSE '["ports.port-call.v1-' || o_orderkey || '"]' END AS source_event_ids_json FROM f""")
def lifecycle_merge(spark, sf_dir):
    """Port calls of a month: the last status and of each attribute the last value, of all their events."""
    us = lambda c: F.unix_micros(c).alias(c.replace("_at", "_us"))
    return _observed(spark, sf_dir)[0].select("port_call_id", "port_code", "vessel_ref_hashed", "ship_class", "status", us("arrived_at"), us("berthed_at"), us("departed_at"), "declared_tonnage", "source_event_ids_json")


@query(PORTS + "SELECT port_code, ship_class, value, n AS n_observations FROM seen WHERE kpi_id = 'vessel_calls'")
def calls_grouping_sets(spark, sf_dir):
    """Accepted calls by port and class, and by port, in one pass."""
    return _seen(spark, sf_dir, "vessel_calls").select("port_code", "ship_class", "value", "n_observations")


@query(PORTS + "SELECT port_code, value, n AS n_observations FROM seen WHERE kpi_id = 'throughput_tonnes'")
def throughput_sum(spark, sf_dir):
    """Tonnes of accepted calls by port, summed as decimals."""
    return _seen(spark, sf_dir, "throughput_tonnes").select("port_code", "value", "n_observations")


@query(PORTS + "SELECT kpi_id, port_code, value, n AS n_observations FROM seen WHERE kpi_id IN ('slot_utilisation_pct', 'booking_lead_time_hours')")
def slot_ratio(spark, sf_dir):
    """Bookings by port: a ratio of sums, not a mean of ratios, and the median lead time."""
    rows = ports.observations(*_observed(spark, sf_dir)).where(F.col("kpi_id").isin("slot_utilisation_pct", "booking_lead_time_hours"))
    return rows.select("kpi_id", "port_code", "value", "n_observations")


@query("""SELECT event_id, CASE event_type WHEN 'purchase' THEN CAST(floor(value * 100) AS BIGINT) END AS total_duty_kobo, CASE event_type WHEN 'purchase' THEN CAST(json_extract(props, '$.k') AS BIGINT) WHEN 'view' THEN CAST(json_extract(props, '$.k') AS BIGINT) + 1 WHEN 'click' THEN 1 END AS quantity,
CASE WHEN event_type = 'signup' THEN '' ELSE CAST(user_id AS VARCHAR) END AS batch_id FROM (SELECT * REPLACE (CAST(event_id AS VARCHAR) AS event_id) FROM events) WHERE event_type <> 'error'""")
def excise_case(spark, sf_dir):
    """One fact for each stamp event, its amounts by type, in whole minor units; those of issues come in a domain document."""
    k, kind, of = F.from_json("props", "k long")["k"], F.col("event_type"), lambda t, c: F.when(F.col("event_type") == t, c)
    amounts = [of("purchase", F.floor(F.col("value") * 100).cast("long")).alias("totalDutyKobo"), of("purchase", k).alias("stampsRequired"), of("view", F.lit(0)).alias("quantity"), of("click", F.lit(1)).alias("activatedCount"), F.when(kind != "signup", F.col("user_id").cast("string")).alias("batchId")]
    payload = F.to_json(F.struct(*amounts, of("view", carried((k + 1).alias("quantity"))).alias("extension")))
    type_ = F.coalesce(of("purchase", F.lit(products.ASSESSED)), of("view", F.lit(products.ISSUED)), of("click", F.lit(products.ACTIVATED)), of("signup", F.lit(products.APPROVED)), F.lit("ports.other.v1"))
    rows = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), type_.alias("event_type"), F.col("ts").alias("occurred_at"), payload.alias("payload_json"))
    return products.excise_facts(rows).select("event_id", "total_duty_kobo", "quantity", "batch_id")


LINES = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


@query(f"""WITH l AS (SELECT DISTINCT ON (k) *, {LINES} AS k FROM lineitem ORDER BY k, l_shipdate, l_partkey), c AS (SELECT * FROM l WHERE l_linestatus = 'O')
SELECT CAST(o_orderkey AS VARCHAR) AS consignment_id, 'fisheries.catch.landed.v1-' || o_orderkey AS catch_event_id, o_totalprice AS catch_weight_kg, coalesce(custody, 0) AS custody_event_count, coalesce(samples, 0) AS coldchain_sample_count, low AS min_temperature_celsius, high AS max_temperature_celsius,
sha256('[' || coalesce(list, '') || ']') AS coldchain_digest_sha256, last AS export_reference, CASE WHEN secret > 0 OR o_orderpriority = '5-LOW' THEN 'SECRET' WHEN coalesce(samples, 0) > 0 THEN 'CONFIDENTIAL' ELSE 'RESTRICTED' END AS record_classification
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'N') AS custody, max_by('x' || k, (l_shipdate, 'export.declared.v1-' || k)) FILTER (WHERE l_returnflag = 'R') AS last, count(*) FILTER (WHERE l_returnflag = 'N' AND l_linenumber = 7) AS secret FROM l GROUP BY ALL) a ON a.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey, count(*) AS samples, min(l_quantity - 60) AS low, max(l_quantity - 60) AS high, string_agg('{{"event_id":"coldchain.temperature.v1-' || k || '","occurred_at":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '+00:00","temperature_celsius":' || CAST(CAST(l_quantity - 60 AS BIGINT) AS VARCHAR) || '.0}}', ',' ORDER BY l_shipdate, 'coldchain.temperature.v1-' || k) AS list FROM c GROUP BY ALL) b ON b.l_orderkey = o_orderkey""")
def consignment_pivot(spark, sf_dir):
    """Consignments of all orders: catch, custody, temperatures with their digest, the last export and the highest clearance."""
    # dealt by order, so that a consignment's events are counted and gathered where they are made
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_shipdate", "l_partkey")
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey").withColumn("n", F.row_number().over(w)).where("n = 1")
    lines = lines.withColumn("k", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    label = lambda e, x: e.withField("record_classification", x)
    name = F.col("l_orderkey").cast("string").alias("consignmentId")
    catch = event("fisheries.catch.landed.v1", F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderkey").cast("string").alias("consignmentId"), F.lit("TUN").alias("speciesCode"), F.col("o_totalprice").alias("catchWeightKg"))
    caught = events_of(table(spark, sf_dir, "orders"), label(catch, F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.lit("restricted"))))
    at, k = F.col("l_shipdate"), F.col("k")
    more = events_of(
        lines,
        F.when(F.col("l_returnflag") == "N", label(event("fisheries.custody.moved.v1", k, at, name), F.when(F.col("l_linenumber") == 7, F.lit("SECRET")).otherwise(F.lit("UNCLASSIFIED")))),
        F.when(F.col("l_returnflag") == "R", label(event("export.declared.v1", k, at, name, F.concat(F.lit("x"), k).alias("exportReference")), F.lit("RESTRICTED"))),
        F.when(F.col("l_linestatus") == "O", label(event("coldchain.temperature.v1", k, at, name, (F.col("l_quantity") - 60).cast("double").alias("temperatureCelsius")), F.lit("CONFIDENTIAL"))),
    )
    return products.consignments(caught.unionByName(more)).select("consignment_id", "catch_event_id", "catch_weight_kg", "custody_event_count", "coldchain_sample_count", "min_temperature_celsius", "max_temperature_celsius", "coldchain_digest_sha256", "export_reference", "record_classification")


def _carbon_events(spark, sf_dir):
    """Projects of suppliers, and credit blocks of line items, some of which change their state."""
    project = events_of(table(spark, sf_dir, "supplier"), event(products.PROJECT, F.col("s_suppkey"), F.lit("1990-01-01").cast("timestamp"), F.col("s_suppkey").cast("string").alias("projectId"), F.col("s_name").alias("projectName"), F.lit("LISTED").alias("state"), F.col("s_nationkey").alias("secret")))
    lines = table(spark, sf_dir, "lineitem").withColumn("k", F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]))
    state = F.when(F.col("l_returnflag") == "R", "RETIRED").when(F.col("l_returnflag") == "A", "CANCELLED").otherwise("ACTIVE")
    of = lambda kind, at, s: event(products.BLOCK, F.concat(F.lit(kind), "k"), at, F.col("k").alias("blockId"), F.col("l_suppkey").cast("string").alias("projectId"), F.year("l_shipdate").cast("string").alias("vintage"), s.alias("status"), F.col("l_quantity").alias("quantityKgCo2e"), (F.col("l_linestatus") == "O").alias("bufferPool"))
    return project.unionByName(events_of(lines, of("new-", F.lit("1990-01-01").cast("timestamp"), F.lit("ACTIVE")), F.when(state != "ACTIVE", of("end-", F.col("l_shipdate"), state))))


VINTAGES = """WITH l AS (SELECT l_suppkey, year(l_shipdate) AS y, any_value(l_returnflag) AS s, any_value(l_linestatus) AS b, CAST(any_value(l_quantity) AS DECIMAL(28,6)) AS q FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, y),
v AS (SELECT CAST(l_suppkey AS VARCHAR) AS project_id, CAST(y AS VARCHAR) AS vintage, sum(q) AS issued, coalesce(sum(q) FILTER (WHERE s = 'R'), 0) AS retired, coalesce(sum(q) FILTER (WHERE s = 'A'), 0) AS cancelled FROM l GROUP BY ALL)
"""


@query(VINTAGES + "SELECT project_id, vintage, CAST(issued AS DOUBLE) AS issued, CAST(retired AS DOUBLE) AS retired, CAST(cancelled AS DOUBLE) AS cancelled FROM v")
def vintage_totals(spark, sf_dir):
    """Credits issued, retired and cancelled by project and vintage, from the latest state of each block."""
    made = products.vintage_totals(products.credit_blocks(_carbon_events(spark, sf_dir)))
    return made.select("project_id", "vintage", *[F.col(f"{c}_kg_co2e").cast("double").alias(c) for c in ("issued", "retired", "cancelled")])


@query(VINTAGES + """SELECT CAST(s_suppkey AS VARCHAR) AS project_id, s_name AS project_name, 'LISTED' AS state, coalesce(t, '[]') AS vintage_totals_json, coalesce(CAST(buffer AS DOUBLE), 0) AS buffer_balance_kg_co2e, '[]' AS retirements_json FROM supplier
LEFT JOIN (SELECT project_id, '[' || string_agg('{"vintage":"' || vintage || '","issued_kg_co2e":' || CAST(CAST(issued AS BIGINT) AS VARCHAR) || '.0,"retired_kg_co2e":' || CAST(CAST(retired AS BIGINT) AS VARCHAR) || '.0,"cancelled_kg_co2e":' || CAST(CAST(cancelled AS BIGINT) AS VARCHAR) || '.0}', ',' ORDER BY vintage) || ']' AS t FROM v GROUP BY project_id) x ON x.project_id = CAST(s_suppkey AS VARCHAR)
LEFT JOIN (SELECT l_suppkey, sum(q) FILTER (WHERE b = 'O' AND s = 'N') AS buffer FROM l GROUP BY ALL) y ON l_suppkey = s_suppkey""")
def allow_list_projection(spark, sf_dir):
    """The public registry: listed fields of projects with their totals; what else a project carries stays out."""
    made = products.public_registry(_carbon_events(spark, sf_dir))
    return made.select("project_id", "project_name", "state", "vintage_totals_json", "buffer_balance_kg_co2e", "retirements_json")


def _report_events(spark, sf_dir):
    """An annual report of each order, every third corrected, pending ones drafts, and statements of the finished ones."""
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    later = F.timestamp_micros(F.unix_micros("o_orderdate") + 3_600_000_000)
    of = lambda kind, when, cii: event(products.ANNUAL, F.concat(F.lit(kind), key.cast("string")), when, key.cast("string").alias("reportId"), F.lpad(key.cast("string"), 7, "0").alias("imoNumber"), (F.year("o_orderdate") + 20).alias("calendarYear"), F.when(F.col("o_orderstatus") == "P", "DRAFT").otherwise("VERIFIED").alias("state"), F.lit(cii).alias("attainedCii"), F.struct(F.lit(2).alias("z"), F.col("o_custkey").alias("co2Tonnes")).alias("totals"))
    soc = event(products.STATEMENT, key, at, key.cast("string").alias("reportId"), F.sha2(key.cast("string"), 256).alias("artifactSha256"))
    return events_of(table(spark, sf_dir, "orders"), of("a", at, 1.5), F.when(key % 3 == 0, of("b", later, 2.5)), F.when(F.col("o_orderstatus") == "F", soc))


@query("""SELECT lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS imo_number, CAST(year(o_orderdate) + 20 AS INTEGER) AS calendar_year, CAST(o_orderkey AS VARCHAR) AS report_id, '{"co2Tonnes":' || o_custkey || ',"z":2}' AS fuel_totals_json, CAST(o_custkey AS DOUBLE) AS co2_tonnes,
CASE WHEN o_orderkey % 3 = 0 THEN 2.5 ELSE 1.5 END::DOUBLE AS attained_cii, CASE WHEN o_orderstatus = 'F' THEN sha256(CAST(o_orderkey AS VARCHAR)) END AS soc_artifact_sha256,
'["mrv.emissions-annual.v1-' || CASE WHEN o_orderkey % 3 = 0 THEN 'b' ELSE 'a' END || o_orderkey || '"' || CASE WHEN o_orderstatus = 'F' THEN ',"mrv.soc.v1-' || o_orderkey || '"' ELSE '' END || ']' AS source_event_ids_json FROM orders WHERE o_orderstatus <> 'P'""")
def verified_left(spark, sf_dir):
    """The latest verified report of each vessel and year with its statement, if any."""
    return products.vessel_annual(_report_events(spark, sf_dir)).drop("required_cii", "cii_rating")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS report_id FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0")
def orphan_anti(spark, sf_dir):
    """Statements of reports that aren't verified: here of every other draft."""
    events = _report_events(spark, sf_dir)
    key = F.col("o_orderkey")
    early = events_of(table(spark, sf_dir, "orders").where("o_orderstatus = 'P' and o_orderkey % 2 = 0"), event(products.STATEMENT, key, F.col("o_orderdate"), key.cast("string").alias("reportId"), F.sha2(key.cast("string"), 256).alias("artifactSha256")))
    return products.orphans(products.annual_reports(events), products.statements(events.unionByName(early))).select("report_id")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS k, CASE WHEN event_id % 5 = 0 THEN 'name' END AS fault FROM events")
def json_domain_fields(spark, sf_dir):
    """Typed fields of payloads, their own or a domain document's, and what is wrong with them."""
    k, i = F.from_json("props", "k long")["k"], F.col("event_id")
    payload = F.to_json(F.struct(k.alias("k"), F.when(i % 5 == 0, F.lit(" ")).otherwise(F.lit("x")).alias("name"), F.when(i % 3 == 0, carried((k + 1).alias("k"))).alias("extension")))
    rows = table(spark, sf_dir, "events").select("event_id", payload.alias("payload_json"))
    return with_domain_fields(rows, {"k": "whole!", "name": "text!"}).select("event_id", "f.k", "fault")


def _scratch(spark):
    """A folder of its own for a query that writes: in the shared folder if the cluster names one."""
    return f"{spark.conf.get('spark.checkpoint.dir', None) or tempfile.gettempdir()}/keelstone-tables/{uuid.uuid4().hex}"


@query("WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'), s AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01') SELECT 1 AS version, (SELECT count(*) FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)) AS written, (SELECT count(*) FROM s WHERE o_orderkey IN (SELECT o_orderkey FROM t)) AS already_present, (SELECT count(*) FROM t) AS n_before, (SELECT count(*) FROM orders) AS n_after, (SELECT sum(o_orderkey) FROM orders)::BIGINT AS keys")
def insert_only_merge(spark, sf_dir):
    """Two overlapping halves of the orders appended to a versioned table: what the second has written and found present, and both versions' rows."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    made = VersionedTable(spark, _scratch(spark))
    made.append_new(rows.where("o_orderdate < timestamp '1998-01-01'"), "o_orderkey")
    version, written, present = made.append_new(rows.where("o_orderdate >= timestamp '1997-01-01'"), "o_orderkey")
    found = lambda v: made.read(v).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    before, after = found(0).select(F.col("n").alias("n_before")), found(version).select(F.col("n").alias("n_after"), "keys")
    return before.join(after).select(F.lit(version).alias("version"), F.lit(written).cast("long").alias("written"), F.lit(present).cast("long").alias("already_present"), "n_before", "n_after", "keys")
