"""Queries over the star-schema tables; each applies an operator of the library and has its SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import digest_key, hours_between, in_period
from ..operators import governance, ports, products, retention, tracks
from ..sources.tables import differing
from .workload import query, table




def micros(c):
    return F.unix_micros(c)


def money(c):
    return F.col(c).cast("decimal(18,2)")


SEGMENTS = """
WITH g AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, CAST(sum(CASE WHEN gap > 43200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_index FROM g)
"""


def _segments(spark, sf_dir):
    return tracks.segmented(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", 12 * 3600)


@query(SEGMENTS + "SELECT user_id, segment_index, count(*) AS n_points, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS ended_us FROM s GROUP BY ALL")
def track_segments(spark, sf_dir):
    """Segments of each user's events at gaps over twelve hours."""
    return _segments(spark, sf_dir).groupBy("user_id", "segment_index").agg(F.count(F.lit(1)).alias("n_points"), micros(F.min("ts")).alias("started_us"), micros(F.max("ts")).alias("ended_us"))


@query(SEGMENTS + """SELECT user_id, segment_index, first_event, last_event, sha256(concat_ws('/', user_id, segment_index, first_event, last_event)) AS track_id
FROM (SELECT user_id, segment_index, arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_id, (ts, event_id)) AS last_event FROM s GROUP BY ALL)""")
def track_ids(spark, sf_dir):
    """Segments named by the digest of their owner, number and ends."""
    points = _segments(spark, sf_dir).groupBy("user_id", "segment_index").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id"))).alias("p"))
    made = points.select("user_id", "segment_index", F.element_at("p", 1)["event_id"].alias("first_event"), F.element_at("p", -1)["event_id"].alias("last_event"))
    return made.withColumn("track_id", digest_key(*[F.col(c) for c in ("user_id", "segment_index", "first_event", "last_event")]))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE event_type IS DISTINCT FROM b")
def consecutive_dedup(spark, sf_dir):
    """Events whose type differs from the user's event before."""
    return tracks.without_repeats(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ["event_type"]).select("user_id", "event_id", "event_type")


@query("SELECT user_id, event_id, event_type, epoch_us(ts) AS at_us FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_key(spark, sf_dir):
    """Each user's last event."""
    rows = table(spark, sf_dir, "events").withColumnRenamed("ts", "occurred_at")
    return products.latest(rows, "user_id").select("user_id", "event_id", "event_type", micros("occurred_at").alias("at_us"))


@query("SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders WHERE o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1997-03-01' GROUP BY ALL")
def period_filter(spark, sf_dir):
    """Orders of one month, half open."""
    return table(spark, sf_dir, "orders").where(in_period(F.col("o_orderdate"), "1997-02")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total"))


@query("""SELECT c_nationkey AS nation, round(quantile_cont(h, 0.5), 6) AS p50, round(quantile_cont(h, 0.9), 6) AS p90, count(*) AS n
FROM (SELECT c_nationkey, date_diff('hour', o_orderdate, l_shipdate)::DOUBLE AS h FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_shipdate >= o_orderdate) GROUP BY ALL""")
def quantiles_linear(spark, sf_dir):
    """Exact interpolated quantiles of shipping delay by nation."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.where("l_shipdate >= o_orderdate").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("string").alias("port_code"), hours_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("value"))
    both = ports.quantiles(rows, "delay", "value", ("P50", "P90"))
    of = lambda p: F.max(F.when(F.col("percentile") == p, F.col("value")))
    return both.groupBy(F.col("port_code").cast("int").alias("nation")).agg(of("P50").alias("p50"), of("P90").alias("p90"), F.max("n_observations").alias("n"))


@query("""WITH r AS (SELECT event_type, user_id % 7 AS lane, value, cume_dist() OVER (PARTITION BY event_type, user_id % 7 ORDER BY value) AS d, count(*) OVER (PARTITION BY event_type, user_id % 7) AS n FROM events)
SELECT event_type, lane, n, CASE WHEN n >= 5 THEN min(value) FILTER (WHERE d >= 0.5) END AS p50, CASE WHEN n >= 5 THEN min(value) FILTER (WHERE d >= 0.9) END AS p90,
CASE WHEN n >= 5 THEN min(value) FILTER (WHERE d >= 0.95) END AS p95, CASE WHEN n < 5 THEN 'INSUFFICIENT_DATA' END AS note FROM r GROUP BY event_type, lane, n""")
def nearest_rank_gate(spark, sf_dir):
    """Nearest-rank percentiles where there are five values at least."""
    rows = table(spark, sf_dir, "events").withColumn("lane", F.col("user_id") % 7)
    return products.nearest_rank(rows, "value", "event_type", "lane").drop("mean")


@query("""SELECT port_code, count(*) AS n, CAST(sum(us) AS BIGINT) AS total_us FROM (SELECT user_id % 5 AS port_code, event_type, lag(event_type) OVER w AS b, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS us FROM events WHERE event_type IN ('view', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE b = 'view' AND event_type = 'purchase' GROUP BY ALL""")
def pair_in_out(spark, sf_dir):
    """Each view paired with the purchase that follows it."""
    rows = table(spark, sf_dir, "events").where("event_type in ('view', 'purchase')")
    scans = rows.select("event_id", F.col("ts").alias("occurred_at"), F.col("user_id").alias("truck"), F.lit("").alias("terminal"), F.when(F.col("event_type") == "view", "in").otherwise("out").alias("direction"), (F.col("user_id") % 5).alias("port_code"))
    return ports.gate_turnarounds(scans).groupBy("port_code").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 60_000_000).cast("long")).alias("total_us"))


@query("""WITH grid AS (SELECT k, n_name AS port FROM (VALUES ('F'), ('O'), ('P'), ('X')) v(k), nation),
o AS (SELECT o_orderstatus AS k, n_name AS port, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 450000 GROUP BY ALL)
SELECT grid.k, grid.port, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'NO_DATA' END AS note FROM grid LEFT JOIN o USING (k, port)""")
def dense_grid_no_data(spark, sf_dir):
    """Every figure for every port, with a note where nothing was observed."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("port"))
    found = table(spark, sf_dir, "orders").where("o_totalprice > 450000").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("o_orderstatus").alias("k"), "port").agg(F.count(F.lit(1)).alias("n"))
    grid = nation.select("port", F.explode(F.array(*map(F.lit, "FOPX"))).alias("k"))
    return grid.join(found, ["k", "port"], "left").select("k", "port", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), "NO_DATA").alias("note"))


@query("""SELECT sha256(CAST(o_custkey AS VARCHAR)) AS ledger_commit_hash, count(*) AS record_count, epoch_us(min(o_orderdate)) AS first_us, epoch_us(max(o_orderdate)) AS last_us,
'["' || string_agg(DISTINCT o_orderpriority, '","' ORDER BY o_orderpriority) || '"]' AS source_systems_json, '["' || string_agg(CAST(o_orderkey AS VARCHAR), '","' ORDER BY CAST(o_orderkey AS VARCHAR)) || '"]' AS event_ids_json FROM orders GROUP BY o_custkey""")
def ledger_rollup(spark, sf_dir):
    """Orders by customer as ledger commitments."""
    rows = table(spark, sf_dir, "orders").select(F.sha2(F.col("o_custkey").cast("string"), 256).alias("ledger_commit_hash"), F.col("o_orderdate").alias("occurred_at"), F.col("o_orderpriority").alias("source_system"), F.col("o_orderkey").cast("string").alias("event_id"))
    made = products.ledger_rollup(rows)
    return made.select("ledger_commit_hash", "record_count", micros("first_occurred_at").alias("first_us"), micros("last_occurred_at").alias("last_us"), "source_systems_json", "event_ids_json")


@query("SELECT event_id, sha256(concat_ws('/', event_type, CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR))) AS dedup_key FROM events")
def dedup_key(spark, sf_dir):
    """Keys from coordinates."""
    return table(spark, sf_dir, "events").select("event_id", digest_key(F.col("event_type"), F.col("user_id"), F.col("event_id")).alias("dedup_key"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'P'")
def replay_conflicts(spark, sf_dir):
    """Keys whose replay differs from what is stored: here pending orders arrive as final."""
    rows = table(spark, sf_dir, "orders")
    replay = rows.where("o_orderdate >= timestamp '2000-01-01'").withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")))
    return differing(rows, replay, "o_orderkey")


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'SECRET' WHEN '2-HIGH' THEN 'CONFIDENTIAL' WHEN '3-MEDIUM' THEN 'RESTRICTED' WHEN '4-NOT SPECIFIED' THEN 'unclassified' END AS record_classification FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')""")
def clearance_filter(spark, sf_dir):
    """Rows that a CONFIDENTIAL reader may see; unlabelled ones are withheld."""
    labels = {"1-URGENT": "SECRET", "2-HIGH": "CONFIDENTIAL", "3-MEDIUM": "RESTRICTED", "4-NOT SPECIFIED": "unclassified"}
    label = F.coalesce(*[F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in labels.items()])
    return governance.visible(table(spark, sf_dir, "orders").select("o_orderkey", label.alias("record_classification")), "CONFIDENTIAL")


REFERENCE = datetime(2003, 1, 1)
POLICY = retention.Retention(hot_days=365, cold_years=4)


def _aged(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("event_id"), F.col("l_shipdate").alias("occurred_at")).where(F.col("occurred_at") <= F.lit("2003-01-01").cast("timestamp"))


@query("""SELECT CASE WHEN a <= 365 THEN 'hot' WHEN a <= 1460 THEN 'cold' ELSE 'expired' END AS tier, count(*) AS n FROM (SELECT (epoch_us(TIMESTAMP '2003-01-01') - epoch_us(l_shipdate)) / 86400000000.0 AS a FROM lineitem WHERE l_shipdate <= TIMESTAMP '2003-01-01') GROUP BY ALL""")
def retention_tiers(spark, sf_dir):
    """Rows by retention tier."""
    tier = POLICY.tier(F.col("occurred_at"), F.lit("2003-01-01 00:00:00").cast("timestamp"))
    return _aged(spark, sf_dir).groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS n_rows, min(k) AS first_key, max(k) AS last_key FROM (SELECT *, concat_ws('-', l_orderkey, l_linenumber) AS k FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-02') GROUP BY ALL""")
def expired_windows(spark, sf_dir):
    """What has expired, by day: the plan of a deletion."""
    made = retention.plan(_aged(spark, sf_dir), POLICY, REFERENCE)
    return made.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n_rows", "first_key", "last_key")


@query("""WITH f(geofence_id, x0, y0, x1, y1) AS (VALUES ('strip', 0, 0, 20, 60), ('corner', 10, 60, 40, 85))
SELECT geofence_id, user_id, count(*) AS observation_count, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, arg_min(event_id, (ts, event_id)) AS first_event_id, arg_max(event_id, (ts, -event_id)) AS last_event_id
FROM (SELECT *, value AS x, (user_id % 90)::DOUBLE AS y FROM events) JOIN f ON x >= x0 AND x <= x1 AND y >= y0 AND y <= y1 GROUP BY ALL""")
def geofence_summary(spark, sf_dir):
    """Events inside fences, by user."""
    box = lambda a, b, c, d: {"type": "Polygon", "coordinates": [[[a, b], [c, b], [c, d], [a, d], [a, b]]]}
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("occurred_at"), F.col("value").alias("longitude"), (F.col("user_id") % 90).cast("double").alias("latitude"))
    made = tracks.geofence_summary(rows, tracks.fences(spark, {"strip": box(0, 0, 20, 60), "corner": box(10, 60, 40, 85)}), "user_id", cell=10.0)
    return made.select("geofence_id", "user_id", "observation_count", micros("first_seen_at").alias("first_us"), micros("last_seen_at").alias("last_us"), "first_event_id", "last_event_id")


@query("SELECT min(value) AS min_x, max(value) AS max_x, min(user_id) AS min_y, max(user_id) AS max_y, min(CAST(event_id AS VARCHAR)) AS first_id, max(CAST(event_id AS VARCHAR)) AS last_id, count(DISTINCT event_type) AS kinds FROM events")
def bbox_lineage(spark, sf_dir):
    """Extent, range of ids and number of kinds."""
    key = F.col("event_id").cast("string")
    return table(spark, sf_dir, "events").agg(F.min("value").alias("min_x"), F.max("value").alias("max_x"), F.min("user_id").alias("min_y"), F.max("user_id").alias("max_y"), F.min(key).alias("first_id"), F.max(key).alias("last_id"), F.count_distinct("event_type").alias("kinds"))


@query("""WITH p AS (SELECT *, value / 10 AS lon, (user_id % 60)::DOUBLE + (event_id % 10) / 100.0 AS lat FROM events),
l AS (SELECT *, lag(lon) OVER w AS lon0, lag(lat) OVER w AS lat0, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS us FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (SELECT *, CASE WHEN lon0 IS NULL THEN 0 ELSE 2 * 6371008.8 * asin(least(sqrt(pow(sin(radians(lat - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat)) * pow(sin(radians(lon - lon0) / 2), 2)), 1.0)) END AS metres FROM l)
SELECT user_id, event_id, CAST(round(metres, 1) AS DOUBLE) AS metres, coalesce(us, 0) AS elapsed_us, CAST(round(avg(CASE WHEN us > 0 THEN metres / (us / 1e6) ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING), 3) AS DOUBLE) AS speed FROM m""")
def motion_stats(spark, sf_dir):
    """Distance, time and smoothed speed from one event to the next."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("occurred_at"), (F.col("value") / 10).alias("longitude"), ((F.col("user_id") % 60).cast("double") + (F.col("event_id") % 10) / F.lit(100.0)).alias("latitude"))
    made = tracks.motion(rows, "user_id", window=3)
    return made.select("user_id", "event_id", F.round("segment_metres", 1).alias("metres"), F.round(F.col("elapsed_seconds") * 1e6).cast("long").alias("elapsed_us"), F.round("speed", 3).alias("speed"))


@query("""WITH s AS (SELECT user_id AS k, CAST(floor(epoch_us(ts) / 21600000000) AS BIGINT) AS step, arg_max(value, (ts, event_id)) AS x, (user_id % 10)::DOUBLE AS y FROM events GROUP BY ALL),
m AS (SELECT a.k AS a, b.k AS b, a.step, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM s a JOIN s b ON a.step = b.step AND a.k < b.k AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
i AS (SELECT *, step - row_number() OVER (PARTITION BY a, b ORDER BY step) AS island FROM m WHERE d <= 1)
SELECT a AS track_a, b AS track_b, min(step) * 21600000000 AS started_us, (max(step) + 1) * 21600000000 AS ended_us, count(*) AS n_steps FROM i GROUP BY a, b, island HAVING (max(step) - min(step) + 1) * 21600 >= 21600""")
def proximity_pairs(spark, sf_dir):
    """Pairs of users that are close in consecutive six-hour steps."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("occurred_at"), F.col("value").alias("longitude"), (F.col("user_id") % 10).cast("double").alias("latitude"))
    made = tracks.encounters(rows, 1.0, 21600, "user_id", step_seconds=21600)
    return made.select("track_a", "track_b", micros("started_at").alias("started_us"), micros("ended_at").alias("ended_us"), "n_steps")


@query("""SELECT event_type, count(*) AS n, CASE WHEN event_type LIKE 'pur%' OR event_type LIKE 'cl%' THEN 'trade' WHEN event_type LIKE 'vi%' THEN 'browse' WHEN event_type LIKE 'err%' THEN 'faults' END AS scope FROM events GROUP BY ALL""")
def scope_prefix_map(spark, sf_dir):
    """Namespaces to scopes by prefix; null outside all of them."""
    scope = governance.scope_of(F.col("event_type"), {"trade": ("pur", "cl"), "browse": ("vi",), "faults": ("err",)})
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("scope", scope)


@query("SELECT o_orderkey, o_orderstatus, c_mktsegment, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' AND c_mktsegment = 'MACHINERY' AND o_orderpriority = '1-URGENT'")
def serving_values(spark, sf_dir):
    """Values by equality filters with their manifest."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
    customers = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderstatus", "c_mktsegment", "n_name")


@query("SELECT k, 'both' AS side FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT k, 'customer only' FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier)")
def set_operations(spark, sf_dir):
    """Nations of customers and suppliers together, and those of customers alone."""
    a, b = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return a.union(b).distinct().withColumn("side", F.lit("both")).unionByName(a.subtract(b).withColumn("side", F.lit("customer only")))


@query("SELECT event_id, user_id, 'POINT (' || CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE rtrim(printf('%.7f', value), '0') END || ' ' || CAST(user_id % 90 AS VARCHAR) || ')' AS wkt FROM events")
def point_text(spark, sf_dir):
    """Points as text with up to seven decimals."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("value").alias("longitude"), (F.col("user_id") % 90).cast("double").alias("latitude"))
    return tracks.observation_wkt(rows).select("event_id", "user_id", F.col("geometry_wkt").alias("wkt"))


@query("SELECT o_orderkey, rn FROM (SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC, o_orderkey) AS INTEGER) AS rn FROM orders) WHERE rn <= 3")
def top_orders(spark, sf_dir):
    """Each customer's three largest orders."""
    w = Window.partitionBy("o_custkey").orderBy(money("o_totalprice").desc(), "o_orderkey")
    return table(spark, sf_dir, "orders").withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("o_orderkey", "rn")
