"""The engine's registered queries over the `events` table, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .config import DetectorConfig, StateConfig
from .functions.expr import hex_id, index_of_uuid, map_json, partition_key
from .operators import client, conformance, detector, intervals, reconcile, replay, residency, scan
from .operators.route import batch_outcomes, retryable_sqlstate, retryable_status, status_of
from .operators.validate import batch_verdicts, enriched_failure, raw_failure
from .plans import metrics
from .schemas import EVENTS_TABLE, RECEIPTS, schema_gaps
from .sources import exposition, generate
from .sources.adapt import read_events, telemetry, with_offsets
from .tables import shared_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    return telemetry(read_events(spark, sf_dir), coarse)


T_SQL = """t AS (SELECT event_id AS id, '00000000-0000-4000-8000-' || lpad(lower(to_hex(event_id)), 12, '0') AS event_id, epoch_us(ts) AS event_us,
  CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS clock, 'svc-' || event_type AS service_name, '/v1/route-' || CAST(user_id % 8 AS VARCHAR) AS route, CAST(round(value * 1000) AS BIGINT) AS latency_us,
  CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS BIGINT) AS status_code, 'demo-' || lpad(lower(to_hex(event_id)), 16, '0') AS trace_id, props,
  CAST((user_id % 8 + length(event_type)) % 3 AS INTEGER) AS partition FROM events)"""
COARSE_SQL = T_SQL.replace("'/v1/route-' || CAST(user_id % 8 AS VARCHAR) AS route", "'/v1/all' AS route").replace("(user_id % 8 + length(event_type)) % 3", "length(event_type) % 3")
OFFSET_SQL = "o AS (SELECT *, row_number() OVER (PARTITION BY partition ORDER BY event_us, id) - 1 AS \"offset\" FROM t)"


def scores_sql(ttl_ms: int | None, warmup: int, coarse: bool) -> str:
    """CTEs up to `s`: the scored events, by recursion over each key's (or key's segment's) rows."""
    seg = "0" if ttl_ms is None else f"sum(CASE WHEN gap >= {ttl_ms} THEN 1 ELSE 0 END) OVER (PARTITION BY service_name, route ORDER BY clock, id)"
    return f"""{COARSE_SQL if coarse else T_SQL},
g AS (SELECT *, clock - lag(clock) OVER (PARTITION BY service_name, route ORDER BY clock, id) AS gap FROM t),
k AS (SELECT *, {seg} AS segment FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY service_name, route, segment ORDER BY clock, id) AS n FROM k),
s AS (SELECT id, event_id, service_name, route, segment, clock, latency_us, n, CAST(latency_us AS DOUBLE) AS m, CAST(0 AS DOUBLE) AS v, CAST(0 AS DOUBLE) AS mean, CAST(0 AS DOUBLE) AS std, CAST(0 AS DOUBLE) AS score, false AS odd FROM r WHERE n = 1
  UNION ALL SELECT r.id, r.event_id, r.service_name, r.route, r.segment, r.clock, r.latency_us, r.n,
    s.m + 0.1::DOUBLE * (r.latency_us - s.m), 0.9::DOUBLE * (s.v + 0.1::DOUBLE * (r.latency_us - s.m) * (r.latency_us - s.m)), s.m, sqrt(s.v),
    greatest(r.latency_us - s.m, 0::DOUBLE) / greatest(sqrt(s.v), 1000::DOUBLE), s.n >= {warmup} AND greatest(r.latency_us - s.m, 0::DOUBLE) / greatest(sqrt(s.v), 1000::DOUBLE) >= 3
  FROM s JOIN r ON r.service_name = s.service_name AND r.route = s.route AND r.segment = s.segment AND r.n = s.n + 1)"""


SCORE_COLUMNS = "id, service_name, route, latency_us, mean AS ewma_mean_us, std AS ewma_stddev_us, score AS anomaly_score, odd AS is_anomaly"


def _scored(spark: SparkSession, sf_dir: str, coarse: bool, ttl_ms: int | None, warmup: int) -> DataFrame:
    t = _events(spark, sf_dir, coarse).select("id", "event_id", "service_name", "route", "clock", "latency_us")
    return detector.score(t, tie=("id",), config=DetectorConfig(warmup=warmup), ttl=ttl_ms)


def _verdict(df: DataFrame, *more: str) -> DataFrame:
    return df.select("id", "service_name", "route", "latency_us", "ewma_mean_us", "ewma_stddev_us", "anomaly_score", "is_anomaly", *more)


@query(f"WITH {T_SQL} SELECT id, event_id, event_us, service_name, route, latency_us, status_code, trace_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS attribute, partition FROM t")
def telemetry_projection(spark, sf_dir):
    t = _events(spark, sf_dir)
    return t.select("id", "event_id", "event_us", "service_name", "route", "latency_us", "status_code", "trace_id", F.col("attributes")["k"].alias("attribute"), "partition")


@query(f"WITH RECURSIVE {scores_sql(None, 100, True)} SELECT {SCORE_COLUMNS} FROM s")
def ewma_scores(spark, sf_dir):
    return _verdict(_scored(spark, sf_dir, True, None, 100))


#: Ranges that queries over one hot key or one order ask for; larger tables get as many as their size asks for by default.
BLOCKS = 16


@query(f"""WITH RECURSIVE {scores_sql(None, 100, True).replace("'svc-' || event_type AS service_name", "'svc-all' AS service_name")} SELECT {SCORE_COLUMNS} FROM s""")
def ewma_scores_hot_key(spark, sf_dir):
    """All events under one key, by a blocked scan."""
    t = _events(spark, sf_dir, True).withColumn("service_name", F.lit("svc-all")).select("id", "event_id", "service_name", "route", "clock", "latency_us")
    return _verdict(scan.score(t, tie=("id",), blocks=BLOCKS))


_ARRIVAL_SQL = "a AS (SELECT id, event_us + (id * 7919 % 1201) * 1000000 AS arrival_us, event_us, partition FROM t)"


def _arrivals(t: DataFrame) -> DataFrame:
    """The events in another order than their times': each arrives up to 20 minutes late."""
    return t.select("id", (F.col("event_us") + F.col("id") * 7919 % 1201 * 1_000_000).alias("arrival_us"), "event_us", "partition")


@query(f"""WITH {T_SQL}, {_ARRIVAL_SQL}, l AS (SELECT *, max(event_us) OVER (ORDER BY arrival_us, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM a)
SELECT id, arrival_us, event_us, last, coalesce(event_us >= coalesce(last, event_us), false) AS accepted FROM l""")
def backward_times(spark, sf_dir):
    """Which events come with a time before one that was accepted already."""
    return scan.backwards(_arrivals(_events(spark, sf_dir)), ["arrival_us", "id"], "event_us", blocks=BLOCKS).select("id", "arrival_us", "event_us", "last", "accepted")


@query(f"""WITH {T_SQL}, {_ARRIVAL_SQL}, l AS (SELECT *, max(event_us) OVER (PARTITION BY partition ORDER BY arrival_us, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM a)
SELECT partition, count(*) FILTER (WHERE event_us >= coalesce(last, event_us)) AS accepted, count(*) FILTER (WHERE event_us < last) AS rejected, CAST(coalesce(max(last - event_us) FILTER (WHERE event_us < last), 0) AS BIGINT) AS most_behind_us FROM l GROUP BY partition""")
def backward_times_by_partition(spark, sf_dir):
    """How many events of each log partition are rejected for going back in time, and how far at most."""
    out = scan.backwards(_arrivals(_events(spark, sf_dir)), ["arrival_us", "id"], "event_us", ["partition"], BLOCKS)
    late = ~F.col("accepted")
    return out.groupBy("partition").agg(F.count_if("accepted").alias("accepted"), F.count_if(late).alias("rejected"), F.coalesce(F.max(F.when(late, F.col("last") - F.col("event_us"))), F.lit(0)).alias("most_behind_us"))


@query(f"WITH RECURSIVE {scores_sql(86_400_000, 20, False)} SELECT {SCORE_COLUMNS} FROM s")
def ewma_scores_routes(spark, sf_dir):
    return _verdict(_scored(spark, sf_dir, False, 86_400_000, 20))


@query(f"WITH RECURSIVE {scores_sql(900_000, 2, True)} SELECT {SCORE_COLUMNS}, CAST(segment AS BIGINT) AS segment FROM s")
def ewma_scores_ttl(spark, sf_dir):
    return _verdict(_scored(spark, sf_dir, True, 900_000, 2), "segment")


@query(f"WITH RECURSIVE {scores_sql(None, 100, True)} SELECT service_name, route, m AS mean_us, v AS variance, n AS observations FROM s QUALIFY row_number() OVER (PARTITION BY service_name, route ORDER BY n DESC) = 1")
def ewma_final_baseline(spark, sf_dir):
    t = _events(spark, sf_dir, True)
    out = detector.final_baselines(t, tie=("id",))
    return out.select("service_name", "route", "mean_us", F.round("variance", 3).alias("variance"), "observations")


SQL["ewma_final_baseline"] = SQL["ewma_final_baseline"].replace("v AS variance", "round(v, 3) AS variance")


@query(f"WITH RECURSIVE {scores_sql(86_400_000, 20, False)} SELECT event_id, service_name, route, latency_us, score AS anomaly_score FROM s WHERE odd")
def anomaly_events(spark, sf_dir):
    return detector.anomalies(_scored(spark, sf_dir, False, 86_400_000, 20)).select("event_id", "service_name", "route", "latency_us", "anomaly_score")


@query(f"WITH RECURSIVE {scores_sql(86_400_000, 20, False)} SELECT service_name, count(*) AS enriched, count(*) FILTER (WHERE odd) AS anomalies, count(*) FILTER (WHERE n <= 20) AS warmup_suppressions, count(DISTINCT (route, segment)) - count(DISTINCT route) AS ttl_evictions FROM s GROUP BY service_name")
def processor_counters(spark, sf_dir):
    s = _scored(spark, sf_dir, False, 86_400_000, 20)
    out = s.groupBy("service_name").agg(*detector.counters(s), F.count_distinct("route", "segment").alias("runs"), F.count_distinct("route").alias("routes"))
    return out.select("service_name", "enriched", "anomalies", "warmup_suppressions", (F.col("runs") - F.col("routes")).alias("ttl_evictions"))


@query(f"""WITH {T_SQL}, q AS (SELECT id AS seq, service_name || route AS key, clock FROM (SELECT row_number() OVER (ORDER BY event_us, id) - 1 AS id, service_name, route, clock FROM t)),
p AS (SELECT *, lag(seq) OVER w AS previous, clock - lag(clock) OVER w AS gap FROM q WINDOW w AS (PARTITION BY key ORDER BY seq)),
d AS (SELECT p.seq, count(DISTINCT o.key) AS others FROM p JOIN q o ON o.seq > p.previous AND o.seq < p.seq WHERE p.gap < 86400000 GROUP BY p.seq)
SELECT p.seq, p.key, p.previous, coalesce(p.previous IS NOT NULL AND p.gap < 86400000 AND coalesce(d.others, 0) < 10, false) AS resident FROM p LEFT JOIN d ON p.seq = d.seq""")
def lru_residency(spark, sf_dir):
    t = _events(spark, sf_dir).select("id", "event_us", "clock", F.concat("service_name", "route").alias("key"))
    hours = F.floor(F.col("event_us") / 3_600_000_000)
    return residency.residency(reconcile.numbered(t, ["event_us", "id"], hours), "key", "clock", "seq", 86_400_000, 10).select("seq", "key", "previous", F.coalesce("resident", F.lit(False)).alias("resident"))


# Faults are injected by id % 17, so that every rule fires somewhere.
def _faulty(t: DataFrame) -> DataFrame:
    k = F.col("id") % 17
    event = F.struct(
        F.when(k == 1, "not-an-id").when(k == 9, F.upper("event_id")).otherwise(F.col("event_id")).alias("event_id"),
        F.when(k == 2, F.lit(None)).when(k == 3, F.struct(F.lit(253_402_300_800).alias("seconds"), F.lit(0).alias("nanos"))).otherwise(F.struct(F.floor(F.col("event_us") / 1_000_000).alias("seconds"), ((F.col("event_us") % 1_000_000) * 1000).cast("int").alias("nanos"))).alias("event_time"),
        F.when(k == 4, "").when(k == 5, F.concat("service_name", F.char(F.lit(0)))).otherwise(F.col("service_name")).alias("service_name"),
        F.when(k == 6, "").when(k == 7, F.repeat(F.lit("é"), 129)).when(k == 8, F.repeat(F.lit("é"), 128)).otherwise(F.col("route")).alias("route"),
        F.when(k == 14, F.lit("9223372036854775808").cast("decimal(20,0)")).otherwise(F.col("latency_us").cast("decimal(20,0)")).alias("latency_us"),
        F.when(k == 15, F.lit(2_147_483_648)).otherwise(F.col("status_code")).alias("status_code"),
        F.when(k == 13, F.concat("trace_id", F.char(F.lit(0)))).otherwise(F.col("trace_id")).alias("trace_id"),
        F.when(k == 10, F.map_from_arrays(F.transform(F.sequence(F.lit(1), F.lit(17)), lambda i: F.concat(F.lit("k"), i.cast("string"))), F.transform(F.sequence(F.lit(1), F.lit(17)), lambda i: F.lit("v"))))
        .when(k == 11, F.create_map(F.repeat(F.lit("k"), 65), F.lit("v"))).otherwise(F.col("attributes")).alias("attributes"),
    )
    return t.withColumn("event", event).withColumn("key", F.when(k == 12, F.lit("wrong")).otherwise(partition_key("event.service_name", "event.route")))


# The rules' categories and messages.
_RAW_CASE = """CASE id % 17 WHEN 1 THEN 'event_id' WHEN 2 THEN 'event_time' WHEN 3 THEN 'event_time' WHEN 4 THEN 'service_name' WHEN 5 THEN 'service_name' WHEN 6 THEN 'route' WHEN 7 THEN 'route' WHEN 10 THEN 'attributes' WHEN 11 THEN 'attributes' WHEN 12 THEN 'key' ELSE 'valid' END"""
_RAW_REASON = """CASE id % 17 WHEN 1 THEN 'event_id must be a UUID' WHEN 2 THEN 'event_time is missing or invalid' WHEN 3 THEN 'event_time is missing or invalid' WHEN 4 THEN 'service_name must not be empty' WHEN 5 THEN 'service_name must not contain NUL'
 WHEN 6 THEN 'route must not be empty' WHEN 7 THEN 'route exceeds 256 bytes' WHEN 10 THEN 'attributes exceed 16 entries' WHEN 11 THEN 'attribute key or value exceeds its byte limit' WHEN 12 THEN 'source key does not match service_name and route' END"""


@query(f"WITH {T_SQL} SELECT {_RAW_CASE} AS category, count(*) AS records FROM t GROUP BY 1")
def raw_validation_categories(spark, sf_dir):
    f = _faulty(_events(spark, sf_dir)).select(raw_failure(F.col("event"), F.col("key")).alias("failure"))
    return f.groupBy(F.coalesce("failure.category", F.lit("valid")).alias("category")).agg(F.count("*").alias("records"))


@query(f"""WITH {T_SQL}, {OFFSET_SQL} SELECT 1 AS stage, 'telemetry.raw' AS source_topic, partition AS source_partition, "offset" AS source_offset, {_RAW_CASE} AS error_category, {_RAW_REASON} AS reason, CASE WHEN id % 17 = 1 THEN '' ELSE event_id END AS event_id
FROM o WHERE id % 17 IN (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)""")
def raw_dlq_envelope(spark, sf_dir):
    from .operators.route import dead_letters
    from .schemas import STAGE_PROCESSOR

    f = _faulty(with_offsets(_events(spark, sf_dir)))
    f = f.withColumn("failure", raw_failure(F.col("event"), F.col("key"))).withColumn("value", F.lit(b""))
    return dead_letters(f, STAGE_PROCESSOR, F.lit(0)).drop("original_payload", "failed_at")


@query(f"""WITH {T_SQL}, k AS (SELECT *, id % 17 AS k FROM t) SELECT CASE WHEN k IN (2, 3) THEN 'timestamp' WHEN k IN (1, 4, 5, 6, 7, 10, 11, 13, 14, 15) OR k = 16 THEN 'validation' ELSE 'valid' END AS category,
 CASE k WHEN 1 THEN 'event_id must be a canonical UUID' WHEN 2 THEN 'event_time is missing or outside the supported UTC range' WHEN 3 THEN 'event_time is missing or outside the supported UTC range' WHEN 4 THEN 'service_name must be nonempty and contain no NUL bytes'
 WHEN 5 THEN 'service_name must be nonempty and contain no NUL bytes' WHEN 6 THEN 'route must be nonempty and contain no NUL bytes' WHEN 7 THEN 'route exceeds 256 UTF-8 bytes' WHEN 10 THEN 'attributes exceed 16 entries' WHEN 11 THEN 'attribute key or value exceeds the processor contract byte limit'
 WHEN 13 THEN 'trace_id must not contain NUL bytes' WHEN 14 THEN 'latency_us exceeds PostgreSQL BIGINT range' WHEN 15 THEN 'status_code exceeds PostgreSQL INTEGER range' WHEN 16 THEN 'detector values must be finite and nonnegative' END AS reason, count(*) AS records FROM k GROUP BY 1, 2""")
def sink_validation_categories(spark, sf_dir):
    t = _faulty(_events(spark, sf_dir))
    ok = F.struct(F.lit(1_800_000_000).cast("long").alias("seconds"), F.lit(0).alias("nanos"))
    e = F.struct("event", F.lit(1.0).alias("ewma_mean_us"), F.when(F.col("id") % 17 == 16, float("nan")).otherwise(0.0).alias("ewma_stddev_us"), F.lit(0.5).alias("anomaly_score"), F.lit(False).alias("is_anomaly"), ok.alias("processed_at"))
    f = t.select(e.alias("e")).select(enriched_failure(F.col("e")).alias("failure"))
    return f.groupBy(F.coalesce("failure.category", F.lit("valid")).alias("category"), F.col("failure.reason").alias("reason")).agg(F.count("*").alias("records"))


# Batches of 100 consecutive ids at the time of their last event; faults in some events, batches and deliveries.
_GATE_BATCH = "'00000000-0000-4000-9000-' || lpad(lower(to_hex(b)), 12, '0')"


@query(f"""WITH {T_SQL}, e AS (SELECT *, id // 100 AS b, id % 100 AS i, max(event_us) OVER (PARTITION BY id // 100) AS now FROM t),
f AS (SELECT *, CASE WHEN id % 700 = 5 THEN 'events[' || i || '].event_id must be a valid UUID' WHEN event_us < now - 86400000000 THEN 'events[' || i || '].event_time must not be older than 24 hours' WHEN id % 900 = 7 THEN 'events[' || i || '].route is required' END AS r FROM e),
v AS (SELECT b, count(*) AS n_events, CASE WHEN b % 11 = 3 THEN 'batch_id must be a valid UUID' ELSE min_by(r, i) FILTER (WHERE r IS NOT NULL) END AS reason FROM f GROUP BY b)
SELECT CASE WHEN b % 11 = 3 THEN 'x' ELSE {_GATE_BATCH} END AS batch_id, n_events, reason, CASE WHEN reason IS NOT NULL THEN 'InvalidArgument' WHEN b % 5 = 0 THEN 'ResourceExhausted' WHEN b % 5 = 1 THEN 'InvalidArgument' ELSE 'OK' END AS code,
 CASE WHEN reason IS NULL AND b % 5 NOT IN (0, 1) THEN n_events ELSE 0 END AS accepted_count FROM v""")
def gateway_batch_verdicts(spark, sf_dir):
    t = _events(spark, sf_dir)
    b, i = F.floor(F.col("id") / 100), F.col("id") % 100
    event = F.struct(
        F.when(F.col("id") % 700 == 5, "x").otherwise(F.col("event_id")).alias("event_id"), F.struct(F.floor(F.col("event_us") / 1_000_000).alias("seconds"), ((F.col("event_us") % 1_000_000) * 1000).cast("int").alias("nanos")).alias("event_time"),
        "service_name", F.when(F.col("id") % 900 == 7, "").otherwise(F.col("route")).alias("route"), "attributes",
    )
    # a request is an array of its events; the batch size bounds it
    packed = t.groupBy(b.alias("b")).agg(F.max("event_us").alias("now"), F.collect_list(F.struct(i.alias("i"), event.alias("v"))).alias("events"))
    packed = packed.withColumn("events", F.array_sort("events", lambda x, y: (x["i"] - y["i"]).cast("int"))).withColumn("events", F.transform("events", lambda x: x["v"]))
    packed = packed.withColumn("batch_id", F.when(F.col("b") % 11 == 3, "x").otherwise(hex_id("00000000-0000-4000-9000-", F.col("b"), 12)))
    error = F.when(F.col("b") % 5 == 0, "buffer_full").when(F.col("b") % 5 == 1, "record_too_large")
    out = batch_verdicts(packed, F.col("now"), keep=["b"]).withColumn("s", status_of(F.col("reason"), F.lit(None).cast("string"), error))
    return out.select("batch_id", "n_events", "reason", F.col("s.code").alias("code"), F.when(F.col("s.code") == "OK", F.col("n_events")).otherwise(0).alias("accepted_count"))


@query("""WITH b AS (SELECT event_id // 100 AS b, count(*) AS n FROM events GROUP BY 1), v AS (SELECT *, b % 4 = 1 AS bad, CASE b % 5 WHEN 0 THEN 'buffer_full' WHEN 1 THEN 'canceled' END AS error FROM b)
SELECT CAST(sum(n) AS BIGINT) AS received, CAST(coalesce(sum(n) FILTER (WHERE NOT bad AND error IS NULL), 0) AS BIGINT) AS accepted, count(*) FILTER (WHERE bad) AS rejected, count(*) FILTER (WHERE NOT bad AND error = 'buffer_full') AS publish_errors,
 count(*) FILTER (WHERE n > 0) AS batch_sizes, count(*) FILTER (WHERE NOT bad) AS publish_durations FROM v""")
def gateway_counters(spark, sf_dir):
    b = read_events(spark, sf_dir).groupBy(F.floor(F.col("event_id") / 100).alias("b")).agg(F.count("*").alias("n_events"))
    b = b.withColumn("reason", F.when(F.col("b") % 4 == 1, "bad")).withColumn("error", F.when(F.col("b") % 5 == 0, "buffer_full").when(F.col("b") % 5 == 1, "canceled"))
    return metrics.gateway_counters(b)


@query("""WITH d AS (SELECT event_id // 100 AS batch_id, event_id % 100 AS i, CASE WHEN event_id % 331 = 0 THEN 'record_too_large' WHEN event_id % 157 = 0 THEN 'permanent' WHEN event_id % 97 = 0 THEN 'timeout' END AS error FROM events)
SELECT batch_id, max_by(error, (CASE error WHEN 'record_too_large' THEN 3 WHEN 'permanent' THEN 2 ELSE 1 END) * 1000 - i) FILTER (WHERE error IS NOT NULL) AS error FROM d GROUP BY batch_id""")
def delivery_outcomes(spark, sf_dir):
    n = F.col("event_id")
    d = read_events(spark, sf_dir).select(F.floor(n / 100).alias("batch_id"), (n % 100).alias("index"), F.when(n % 331 == 0, "record_too_large").when(n % 157 == 0, "permanent").when(n % 97 == 0, "timeout").alias("error"))
    return batch_outcomes(d)


_COPIES_SQL = "c AS (SELECT *, 0 AS copy FROM o UNION ALL SELECT * REPLACE (upper(event_id) AS event_id, latency_us + 1 AS latency_us), 1 AS copy FROM o WHERE id % 5 = 0)"


def _with_copies(t: DataFrame) -> DataFrame:
    """Every fifth event again, later, in upper case and with another latency."""
    again = t.where("id % 5 = 0").withColumn("event_id", F.upper("event_id")).withColumn("latency_us", F.col("latency_us") + 1)
    return t.withColumn("copy", F.lit(0)).unionByName(again.withColumn("copy", F.lit(1)))


@query(f"WITH {T_SQL}, {OFFSET_SQL}, {_COPIES_SQL} SELECT lower(event_id) AS event_id, latency_us, copy FROM c QUALIFY row_number() OVER (PARTITION BY lower(event_id) ORDER BY copy, partition, \"offset\") = 1")
def dedup_first_wins(spark, sf_dir):
    c = _with_copies(with_offsets(_events(spark, sf_dir)))
    return reconcile.first_per_id(c, "event_id", ["copy", "partition", "offset"]).select(F.lower("event_id").alias("event_id"), "latency_us", "copy")


@query(f"""WITH {T_SQL}, {OFFSET_SQL}, {_COPIES_SQL}, x AS (SELECT DISTINCT lower(event_id) AS event_id FROM c WHERE id % 3 = 0), n AS (SELECT DISTINCT lower(event_id) AS event_id FROM c)
SELECT (SELECT count(*) FROM c) AS total, (SELECT count(*) FROM n WHERE event_id NOT IN (SELECT event_id FROM x)) AS inserted, (SELECT count(*) FROM c) - (SELECT count(*) FROM n WHERE event_id NOT IN (SELECT event_id FROM x)) AS conflicts""")
def receipt_merge_conflicts(spark, sf_dir):
    c = _with_copies(_events(spark, sf_dir).select("id", "event_id", "latency_us")).withColumn("event_id", F.lower("event_id"))
    receipts = c.where("id % 3 = 0").select("event_id").distinct().withColumn("known", F.lit(True))
    per = c.groupBy("event_id").agg(F.count("*").alias("copies")).join(receipts, "event_id", "left")
    return per.agg(F.sum("copies").alias("total"), F.count_if(F.col("known").isNull()).alias("inserted")).withColumn("conflicts", F.col("total") - F.col("inserted"))


@query(f"""WITH {T_SQL}, {OFFSET_SQL}, {_COPIES_SQL}, b AS (SELECT DISTINCT lower(event_id) AS event_id, id // 2000 AS batch FROM c WHERE id % 3 = 0 AND id < 6000 UNION ALL SELECT DISTINCT lower(event_id), 1000 FROM c),
f AS (SELECT event_id, min(batch) AS batch FROM b GROUP BY event_id), n AS (SELECT id // 2000 AS batch, count(*) AS total FROM c WHERE id % 3 = 0 AND id < 6000 GROUP BY 1 UNION ALL SELECT 1000, count(*) FROM c)
SELECT n.batch, n.total, count(f.event_id) AS inserted, n.total - count(f.event_id) AS conflicts FROM n LEFT JOIN f ON n.batch = f.batch GROUP BY n.batch, n.total""")
def receipt_batches(spark, sf_dir):
    """Batches of identifiers merged into receipts one after another, the last one being everything: what is new of each."""
    from .sources.receipts import Receipts

    c = _with_copies(_events(spark, sf_dir).select("id", "event_id", "latency_us")).select("id", F.col("event_id").alias("id_text"))
    store = Receipts(spark, shared_folder(spark, "receipts"), buckets=8)
    out = None
    for number, rows in [*((b, c.where((F.floor(F.col("id") / 2000) == b) & (F.col("id") % 3 == 0))) for b in range(3)), (1000, c)]:
        new = store.merge(rows.select(F.col("id_text").alias("id")), str(number)).agg(F.count("*").alias("inserted"))
        one = rows.agg(F.count("*").alias("total")).join(new).select(F.lit(number).cast("long").alias("batch"), "total", "inserted", (F.col("total") - F.col("inserted")).alias("conflicts"))  # two single rows
        out = one if out is None else out.unionByName(one)
    return out.where("total > 0")


@query(f"WITH {T_SQL}, {OFFSET_SQL} SELECT 'telemetry.raw' AS topic, partition, max(\"offset\") + 1 AS next_offset, count(*) AS records FROM o GROUP BY partition")
def next_offsets(spark, sf_dir):
    return reconcile.next_offsets(with_offsets(_events(spark, sf_dir)))


@query(f"WITH {T_SQL} SELECT partition, count(*) AS records, min(event_id) AS first_event_id, max(event_id) AS last_event_id FROM t GROUP BY partition")
def partition_distribution(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("partition").agg(F.count("*").alias("records"), F.min("event_id").alias("first_event_id"), F.max("event_id").alias("last_event_id"))


@query(f"WITH {T_SQL}, {OFFSET_SQL}, h AS (SELECT *, lag(\"offset\") OVER (PARTITION BY partition ORDER BY \"offset\") + 1 AS expected FROM o WHERE id % 101 <> 7) SELECT partition, \"offset\", expected FROM h WHERE \"offset\" <> expected")
def offset_gaps(spark, sf_dir):
    return reconcile.offset_gaps(with_offsets(_events(spark, sf_dir)).where("id % 101 <> 7")).select("partition", "offset", "expected")


@query(f"WITH {T_SQL}, {OFFSET_SQL}, b AS (SELECT partition, (row_number() OVER (PARTITION BY partition ORDER BY \"offset\") - 1) // 500 AS batch, \"offset\" FROM o) SELECT partition, batch, count(*) AS records, max(\"offset\") + 1 AS commit_offset FROM b GROUP BY ALL")
def micro_batches(spark, sf_dir):
    b = reconcile.batches(with_offsets(_events(spark, sf_dir)))
    return b.groupBy("partition", "batch").agg(F.count("*").alias("records"), (F.max("offset") + 1).alias("commit_offset"))


@query(f"""WITH {T_SQL}, w AS (SELECT partition, count(*) AS high FROM t GROUP BY partition), p AS (SELECT *, CASE partition WHEN 0 THEN high // 2 WHEN 1 THEN high ELSE 4 END AS base FROM w)
SELECT count(*) AS partitions, CAST(sum(greatest(high - base, 0)) AS BIGINT) AS lag FROM p""")
def consumer_lag(spark, sf_dir):
    w = _events(spark, sf_dir).groupBy("partition").agg(F.count("*").alias("high")).withColumn("topic", F.lit("telemetry.raw")).withColumn("low", F.lit(4).cast("long"))
    p = F.col("partition")
    committed = w.select("topic", "partition", F.when(p == 0, "offset").when(p == 1, "end").otherwise("invalid").alias("kind"), F.when(p == 0, F.floor(F.col("high") / 2)).alias("value"))
    return reconcile.consumer_lag(committed, w)


@query("""WITH n AS (SELECT max(event_id) + 5 AS n FROM events), x AS (SELECT '00000000-0000-4000-8000-' || lpad(lower(to_hex(i)), 12, '0') AS event_id FROM n, range(0, n) r(i)),
t AS (SELECT '00000000-0000-4000-8000-' || lpad(lower(to_hex(event_id)), 12, '0') AS event_id, event_id AS id FROM events)
SELECT (SELECT count(*) FROM t) AS receipts, (SELECT count(*) FROM t WHERE id % 97 <> 0) AS events, (SELECT count(DISTINCT event_id) FROM t WHERE id % 97 <> 0) AS distinct_events,
 (SELECT count(*) FROM x LEFT JOIN t USING (event_id) WHERE t.event_id IS NULL) AS missing_receipts, (SELECT count(*) FROM x LEFT JOIN (SELECT event_id FROM t WHERE id % 97 <> 0) s USING (event_id) WHERE s.event_id IS NULL) AS missing_events""")
def missing_expected_ids(spark, sf_dir):
    t = _events(spark, sf_dir).select(index_of_uuid(F.col("event_id")).alias("id"))
    return reconcile.stored_counts_dense(t, t.where("id % 97 <> 0"), F.max("id") + 5)


@query("""WITH n AS (SELECT max(event_id) + 70000 AS n FROM events), x AS (SELECT i FROM n, range(0, n) r(i) WHERE i NOT IN (SELECT event_id FROM events WHERE event_id % 97 <> 0 AND event_id % 1000 NOT BETWEEN 500 AND 509)),
g AS (SELECT i, i - row_number() OVER (ORDER BY i) AS island FROM x) SELECT min(i) AS first_id, max(i) AS last_id, count(*) AS ids FROM g GROUP BY island""")
def missing_id_ranges(spark, sf_dir):
    """Which expected identifiers aren't stored, as ranges."""
    t = _events(spark, sf_dir).select(index_of_uuid(F.col("event_id")).alias("id"))
    return reconcile.missing_ranges(t.where("id % 97 <> 0 AND id % 1000 NOT BETWEEN 500 AND 509"), F.max("id") + 70_000, bounds=t)


@query(f"""WITH {T_SQL}, a AS (SELECT trace_id, event_id FROM t), b AS (SELECT trace_id, event_id FROM t WHERE id % 211 <> 3 UNION ALL SELECT trace_id, event_id FROM t WHERE id % 503 = 1)
SELECT 'left' AS side, trace_id, event_id, count(*) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL UNION ALL SELECT 'right', trace_id, event_id, count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL""")
def reconcile_multiset(spark, sf_dir):
    t = _events(spark, sf_dir)
    a = t.select("trace_id", "event_id")
    b = t.where("id % 211 <> 3").select("trace_id", "event_id").unionByName(t.where("id % 503 = 1").select("trace_id", "event_id"))
    return reconcile.multiset_difference(a, b)


@query(SQL["reconcile_multiset"])
def reconcile_hash_tree(spark, sf_dir):
    """The same by a hash tree."""
    t = _events(spark, sf_dir)
    a = t.select("trace_id", "event_id")
    b = t.where("id % 211 <> 3").select("trace_id", "event_id").unionByName(t.where("id % 503 = 1").select("trace_id", "event_id"))
    return reconcile.hash_tree_difference(a, b)


@query("SELECT count(*) AS raw, count(*) FILTER (WHERE event_id % 17 NOT IN (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)) AS enriched, count(*) FILTER (WHERE event_id % 17 IN (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)) AS dlq, true AS conserved FROM events")
def conservation(spark, sf_dir):
    f = _faulty(_events(spark, sf_dir)).select(raw_failure(F.col("event"), F.col("key")).alias("failure"))
    out = f.agg(F.count("*").alias("raw"), F.count_if(F.col("failure").isNull()).alias("enriched"), F.count_if(F.col("failure").isNotNull()).alias("dlq"))
    c = F.col
    return out.withColumn("conserved", reconcile.all_hold(reconcile.conservation(c("raw"), c("enriched"), c("dlq"), c("enriched"), c("dlq"), c("raw"))))


@query("SELECT * FROM (VALUES ('events', 'trace_id', 'string'), ('events', 'status_code', 'int'), ('receipts', 'first_seen_at', 'timestamp')) v(table_name, column_name, data_type)")
def schema_conformance(spark, sf_dir):
    """What a damaged pair of tables lacks."""
    empty = spark.createDataFrame([], EVENTS_TABLE)
    events = schema_gaps(empty.drop("trace_id").withColumn("status_code", F.col("status_code").cast("long")), EVENTS_TABLE)
    receipts = schema_gaps(spark.createDataFrame([], RECEIPTS).drop("first_seen_at"), RECEIPTS)
    return events.withColumn("table_name", F.lit("events")).unionByName(receipts.withColumn("table_name", F.lit("receipts"))).select("table_name", "column_name", "data_type")


#: What the given tables are held against; some of it is not so.
CONTRACTS = [
    conformance.Contract("events", {"event_id": ("bigint", True), "ts": ("timestamp_ntz", True), "user_id": ("bigint", True), "value": ("double", True), "trace_id": ("string", True), "props": ("string", False)}, ("event_id",)),
    conformance.Contract("orders", {"o_orderkey": ("bigint", True), "o_custkey": ("bigint", True), "o_totalprice": ("decimal(12,2)", True), "o_orderdate": ("timestamp_ntz", True)}, ("o_orderkey",)),
    conformance.Contract("lineitem", {"l_orderkey": ("bigint", True), "l_linenumber": ("int", True), "l_quantity": ("double", True)}, ("l_orderkey",)),
    conformance.Contract("customer", {"c_custkey": ("bigint", True), "c_nationkey": ("bigint", True), "c_name": ("string", True)}, ("c_custkey",)),
    conformance.Contract("nation", {"n_nationkey": ("int", True)}, ("n_nationkey",), ("n_regionkey",)),
    conformance.Contract("supplier", {"s_suppkey": ("bigint", True), "s_name": ("string", True)}, ("s_suppkey",)),
    conformance.Contract("shipments", {"shipment_id": ("bigint", True)}),
]
_TYPES_SQL = "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE lower(data_type) END"
_WANTED_SQL = ", ".join(f"('{c.table}', '{name}', '{kind}')" for c in CONTRACTS for name, (kind, _) in c.columns.items())
_REPEATS_SQL = " UNION ALL ".join(f"SELECT '{c.table}' AS table_name, '{','.join(c.key)}' AS subject, 'values of the key repeat' AS problem, count(*) AS n FROM (SELECT 1 FROM {c.table} GROUP BY {','.join(c.key)} HAVING count(*) > 1) HAVING count(*) > 0" for c in CONTRACTS if c.key)
_CONFORMANCE_SQL = f"""wanted AS (SELECT * FROM (VALUES {_WANTED_SQL}) v(table_name, column_name, wanted)), have AS (SELECT table_name, column_name, {_TYPES_SQL} AS data_type FROM information_schema.columns),
problems AS (SELECT DISTINCT table_name, table_name AS subject, 'the table is missing' AS problem, CAST(NULL AS BIGINT) AS n FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.table_name = w.table_name)
 UNION ALL SELECT table_name, column_name, 'the column is missing', NULL FROM wanted w WHERE EXISTS (SELECT 1 FROM have h WHERE h.table_name = w.table_name) AND NOT EXISTS (SELECT 1 FROM have h WHERE h.table_name = w.table_name AND h.column_name = w.column_name)
 UNION ALL SELECT table_name, column_name, 'the type is ' || data_type || ' instead of ' || wanted, NULL FROM wanted JOIN have USING (table_name, column_name) WHERE wanted <> data_type
 UNION ALL SELECT 'nation', 'nation', 'partitioned by () instead of (n_regionkey)', NULL UNION ALL {_REPEATS_SQL})"""


def _given(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"WITH {_CONFORMANCE_SQL} SELECT * FROM problems")
def table_contracts(spark, sf_dir):
    """What the given tables' files lack against their contracts."""
    return conformance.problems(spark, CONTRACTS, _given(spark, sf_dir))


@query(f"WITH {_CONFORMANCE_SQL} SELECT DISTINCT table_name, table_name NOT IN (SELECT table_name FROM problems) AS ready FROM wanted")
def tables_ready(spark, sf_dir):
    return conformance.ready(spark, CONTRACTS, _given(spark, sf_dir))


# Labels of any length that overlap: every 29th event opens one at its time, every tenth event may be what it waits for.
_INTERVAL_SQL = f"""{COARSE_SQL}, i AS (SELECT service_name, id AS priority, clock AS start, clock + (id % 7 + 1) * 21600000 AS finish, clock + 7200000 AS label_end FROM t WHERE id % 29 = 0), p AS (SELECT service_name, id AS seq, clock AS t FROM t WHERE id % 10 = 3),
w AS (SELECT service_name, list(struct_pack(n := priority, s := start, e := finish) ORDER BY priority) AS own FROM i GROUP BY service_name), q AS (SELECT p.*, row_number() OVER (PARTITION BY p.service_name ORDER BY t, seq) AS k, own FROM p LEFT JOIN w USING (service_name)),
r AS (SELECT service_name, k, seq, t, own, list_min(list_transform(list_filter(own, lambda x: x.s <= t AND x.e >= t), lambda x: x.n)) AS priority, CAST([] AS BIGINT[]) AS gone FROM q WHERE k = 1
 UNION ALL SELECT z.service_name, z.k, z.seq, z.t, z.own, list_min(list_transform(list_filter(z.own, lambda x: x.s <= z.t AND x.e >= z.t AND NOT list_contains(z.gone, x.n)), lambda x: x.n)), z.gone
 FROM (SELECT q.service_name, q.k, q.seq, q.t, q.own, CASE WHEN r.priority IS NULL THEN r.gone ELSE list_append(r.gone, r.priority) END AS gone FROM r JOIN q ON q.service_name = r.service_name AND q.k = r.k + 1) z)"""


def _labels(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    t, n, c = _events(spark, sf_dir, True), F.col("id"), F.col("clock")
    i = t.where(n % 29 == 0).select("service_name", n.alias("priority"), c.alias("start"), (c + (n % 7 + 1) * 21_600_000).alias("finish"), (c + 7_200_000).alias("label_end"))
    return intervals.match(t.where(n % 10 == 3).select("service_name", n.alias("seq"), c.alias("t")), i, ["service_name"], BLOCKS)


@query(f"WITH RECURSIVE {_INTERVAL_SQL} SELECT i.service_name, i.priority, i.start, i.finish, r.seq, r.t FROM i LEFT JOIN r ON r.service_name = i.service_name AND r.priority = i.priority")
def interval_first_matches(spark, sf_dir):
    """Each interval's first event that no interval before it took."""
    return _labels(spark, sf_dir)[0]


@query(f"WITH RECURSIVE {_INTERVAL_SQL} SELECT r.service_name, r.seq, r.t FROM r WHERE r.priority IS NULL AND NOT EXISTS (SELECT 1 FROM i WHERE i.service_name = r.service_name AND r.t BETWEEN i.start AND i.label_end)")
def interval_false_points(spark, sf_dir):
    """Events that no label covers and no interval took."""
    return _labels(spark, sf_dir)[1].where("priority IS NULL AND NOT labelled").select("service_name", "seq", "t")


# Replay over the arithmetic manifest, whose noise any engine repeats.
MANIFEST_SQL = """e AS (SELECT i AS seq, i AS event_time_ms, 'replay-service-' || CAST((i % 10) // 2 + 1 AS VARCHAR) AS service_name, '/v1/resource-' || CAST((i % 10) % 5 + 1 AS VARCHAR) || '/{id}' AS route,
  10000 + (i * 7919) % 501 AS base, CASE WHEN i >= 10000 THEN (i - 10000) // 3000 END AS w FROM range(0, 100000) r(i)),
f AS (SELECT *, 10000 + 3000 * w + w % 10 AS begin_at FROM e),
m AS (SELECT seq, event_time_ms, service_name, route, CASE WHEN w < 25 AND seq >= begin_at AND (seq - begin_at) % 10 = 0 AND (seq - begin_at) // 10 <= 100 THEN CASE WHEN (seq - begin_at) // 10 < 80 THEN base + (seq - begin_at) // 10 * 250 ELSE 60000 END ELSE base END AS latency_us FROM f),
windows AS (SELECT 'replay-service-' || CAST((a % 10) // 2 + 1 AS VARCHAR) AS service_name, '/v1/resource-' || CAST((a % 10) % 5 + 1 AS VARCHAR) || '/{id}' AS route, a AS injected_at_ms, a + 1000 AS window_end_ms FROM (SELECT 10000 + 3000 * i + i % 10 AS a FROM range(0, 25) r(i)))"""
REPLAY_SQL = MANIFEST_SQL + """, r AS (SELECT *, row_number() OVER (PARTITION BY service_name, route ORDER BY seq) AS n FROM m),
s AS (SELECT seq, service_name, route, latency_us, n, CAST(latency_us AS DOUBLE) AS mu, CAST(0 AS DOUBLE) AS v, CAST(0 AS DOUBLE) AS score FROM r WHERE n = 1
  UNION ALL SELECT r.seq, r.service_name, r.route, r.latency_us, r.n, s.mu + 0.1::DOUBLE * (r.latency_us - s.mu), 0.9::DOUBLE * (s.v + 0.1::DOUBLE * (r.latency_us - s.mu) * (r.latency_us - s.mu)), greatest(r.latency_us - s.mu, 0::DOUBLE) / greatest(sqrt(s.v), 1000::DOUBLE)
  FROM s JOIN r ON r.service_name = s.service_name AND r.route = s.route AND r.n = s.n + 1),
verdicts AS (SELECT seq, seq AS event_time_ms, service_name, route, latency_us, score FROM s WHERE n > 100 AND score >= 3),
found AS (SELECT w.*, min(v.event_time_ms) AS detected_at_ms, min(v.seq) AS verdict_seq FROM windows w LEFT JOIN verdicts v ON v.service_name = w.service_name AND v.route = w.route AND v.event_time_ms BETWEEN w.injected_at_ms AND w.injected_at_ms + 5000 GROUP BY ALL),
false_ones AS (SELECT * FROM verdicts v WHERE NOT EXISTS (SELECT 1 FROM windows w WHERE w.service_name = v.service_name AND w.route = v.route AND v.event_time_ms BETWEEN w.injected_at_ms AND w.window_end_ms) AND seq NOT IN (SELECT verdict_seq FROM found WHERE verdict_seq IS NOT NULL))"""


_SPIKED_SQL = REPLAY_SQL.replace("ELSE base END AS latency_us FROM f)", "WHEN seq % 9973 = 17 AND seq > 0 THEN 60000 ELSE base END AS latency_us FROM f)")


def _replay(spark, spiked: bool = False):
    events, windows = generate.manifest(spark, 100_000)
    if spiked:  # latencies that no label explains
        inside = F.col("latency_us") != 10_000 + F.pmod(F.col("seq") * 7919, F.lit(501))
        events = events.withColumn("latency_us", F.when((F.col("seq") % 9973 == 17) & ~inside, 60_000).otherwise(F.col("latency_us")).cast("long"))
    return replay.evaluate(events, windows)


@query(f"WITH RECURSIVE {REPLAY_SQL} SELECT service_name, route, injected_at_ms, window_end_ms, detected_at_ms, detected_at_ms - injected_at_ms AS detection_latency_ms FROM found")
def replay_detection(spark, sf_dir):
    return _replay(spark)[1].select("service_name", "route", "injected_at_ms", "window_end_ms", "detected_at_ms", "detection_latency_ms")


@query(f"WITH RECURSIVE {_SPIKED_SQL} SELECT event_time_ms, service_name, route, latency_us, score FROM false_ones")
def replay_false_positives(spark, sf_dir):
    return _replay(spark, spiked=True)[2].select("event_time_ms", "service_name", "route", "latency_us", "score")


@query(f"""WITH RECURSIVE {REPLAY_SQL} SELECT (SELECT count(*) FROM m) AS event_count, count(*) AS anomaly_window_count, count(*) FILTER (WHERE detected_at_ms IS NULL) AS missed_windows, max(detected_at_ms - injected_at_ms) AS max_detection_latency_ms,
 (SELECT count(*) FROM false_ones) AS false_positive_count, count(*) >= 25 AND count(*) FILTER (WHERE detected_at_ms IS NULL) = 0 AND max(detected_at_ms - injected_at_ms) <= 5000 AS passed FROM found""")
def replay_report(spark, sf_dir):
    return _replay(spark)[0]


@query(f"""WITH {MANIFEST_SQL}, x AS (SELECT * FROM windows UNION ALL SELECT service_name, route, injected_at_ms, window_end_ms + 500 FROM windows WHERE injected_at_ms = 10000 UNION ALL SELECT service_name, route, injected_at_ms + 2000, window_end_ms + 2000 FROM windows WHERE injected_at_ms = 13001
  UNION ALL SELECT service_name, route, 200000, 199000 FROM windows WHERE injected_at_ms = 16002), k AS (SELECT DISTINCT service_name, route, injected_at_ms FROM x),
n AS (SELECT *, lead(injected_at_ms) OVER (PARTITION BY service_name, route ORDER BY injected_at_ms) AS next FROM x)
SELECT service_name, route, injected_at_ms, 'end precedes injection' AS problem FROM x WHERE window_end_ms < injected_at_ms UNION ALL SELECT service_name, route, injected_at_ms, 'span exceeds one second' FROM x WHERE window_end_ms - injected_at_ms > 1000
UNION ALL SELECT service_name, route, injected_at_ms, 'identity must be unique' FROM x GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT k.service_name, k.route, k.injected_at_ms, 'no event at injection' FROM k LEFT JOIN m ON m.event_time_ms = k.injected_at_ms AND m.service_name = k.service_name AND m.route = k.route WHERE m.seq IS NULL
UNION ALL SELECT service_name, route, injected_at_ms, 'label spans overlap' FROM n WHERE next <= injected_at_ms + 1000 UNION ALL SELECT service_name, route, injected_at_ms, 'detection intervals overlap' FROM n WHERE next <= injected_at_ms + 5000""")
def label_window_validation(spark, sf_dir):
    events, w = generate.manifest(spark, 100_000)
    c = F.col
    bad = w.unionByName(w.where("injected_at_ms = 10000").withColumn("window_end_ms", c("window_end_ms") + 500)).unionByName(w.where("injected_at_ms = 13001").withColumn("injected_at_ms", c("injected_at_ms") + 2000).withColumn("window_end_ms", c("window_end_ms") + 2000))
    bad = bad.unionByName(w.where("injected_at_ms = 16002").withColumn("injected_at_ms", F.lit(200_000).cast("long")).withColumn("window_end_ms", F.lit(199_000).cast("long")))
    return replay.window_problems(events, bad)


@query("SELECT event_type, CAST(epoch_us(ts) // 60000000 * 60 AS BIGINT) AS window_start, count(*) AS events, count(*) / 60.0::DOUBLE AS rate FROM events GROUP BY ALL")
def event_rate_1m(spark, sf_dir):
    return metrics.event_rate(read_events(spark, sf_dir), F.col("ts").cast("timestamp"), 60, ["event_type"])


@query(f"WITH RECURSIVE {scores_sql(86_400_000, 20, False)} SELECT CAST(clock // 60000 * 60 AS BIGINT) AS window_start, count(*) AS events, count(*) / 60.0::DOUBLE AS rate FROM s WHERE odd GROUP BY ALL")
def anomaly_rate_1m(spark, sf_dir):
    return metrics.event_rate(detector.anomalies(_scored(spark, sf_dir, False, 86_400_000, 20)), F.timestamp_millis("clock"), 60)


@query("""WITH c AS (SELECT epoch_us(ts) // 1000000 AS ts, event_type, count(*) AS n FROM events GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY ts) AS value, min(ts) OVER (PARTITION BY event_type) AS t0, first(n) OVER (PARTITION BY event_type ORDER BY ts) AS n0 FROM c),
g AS (SELECT *, ts - first(ts) OVER w AS dt, value - first(value) OVER w AS dv FROM t WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW))
SELECT event_type, ts, CAST(value AS BIGINT) AS value, CASE WHEN dt > 0 THEN dv / dt::DOUBLE END AS rate FROM g""")
def counter_rate_1h(spark, sf_dir):
    c = read_events(spark, sf_dir).groupBy(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("ts"), "event_type").count()
    samples = c.select("event_type", "ts", F.sum("count").over(W.partitionBy("event_type").orderBy("ts")).alias("value"))
    return metrics.counter_rate(samples, 3600, ["event_type"])


_LES = "(VALUES (5000::DOUBLE), (10000), (25000), (50000), (100000), (250000), (500000), ('Infinity'::DOUBLE)) l(le)"
_BOUNDS = (5000.0, 10000.0, 25000.0, 50000.0, 100000.0, 250000.0, 500000.0)


@query(f"WITH {T_SQL} SELECT service_name, le, count(*) FILTER (WHERE latency_us <= le) AS count FROM t, {_LES} GROUP BY ALL")
def latency_histogram(spark, sf_dir):
    return metrics.histogram(_events(spark, sf_dir), F.col("latency_us"), _BOUNDS, ["service_name"])


@query(f"""WITH {T_SQL}, h AS (SELECT service_name, le, count(*) FILTER (WHERE latency_us <= le) AS c FROM t, {_LES} GROUP BY ALL),
b AS (SELECT *, coalesce(lag(c) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS low, 0.99::DOUBLE * max(c) OVER (PARTITION BY service_name) AS rank FROM h WINDOW w AS (PARTITION BY service_name ORDER BY le)),
f AS (SELECT * FROM b WHERE c >= rank QUALIFY row_number() OVER (PARTITION BY service_name ORDER BY le) = 1) SELECT service_name, CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (rank - below) / (c - below) END AS value FROM f""")
def latency_p99_histogram_quantile(spark, sf_dir):
    return metrics.histogram_quantile(0.99, metrics.histogram(_events(spark, sf_dir), F.col("latency_us"), _BOUNDS, ["service_name"]), ["service_name"])


def _scraped_sql(increments: str, by: str, interval: int, restart: int) -> str:
    """CTE samples (by, ts, value) from increments (by, sec, n)."""
    return f"""inc AS ({increments}), slots AS (SELECT {by}, CAST(ceil(sec / {interval}) * {interval} AS BIGINT) AS ts, sum(n) AS n FROM inc GROUP BY ALL),
grid AS (SELECT unnest(generate_series((SELECT min(ts) FROM slots), (SELECT max(ts) FROM slots), {interval})) AS ts), series AS (SELECT DISTINCT {by} FROM inc),
every AS (SELECT {", ".join("series." + b for b in by.split(", "))}, grid.ts, coalesce(n, 0) AS n FROM series CROSS JOIN grid LEFT JOIN slots ON {" AND ".join(f"series.{b} = slots.{b}" for b in by.split(", "))} AND grid.ts = slots.ts),
samples AS (SELECT {by}, ts, CAST(sum(n) OVER (PARTITION BY {by}, ts // {restart} ORDER BY ts) AS BIGINT) AS value FROM every)"""


def _rate_sql(by: str, window: int, step: int) -> str:
    """CTE rates (by, ts, rate) from samples."""
    return f"""rx AS (SELECT *, lag(value) OVER w AS pv, lag(ts) OVER w AS pt FROM samples WINDOW w AS (PARTITION BY {by} ORDER BY ts)),
ry AS (SELECT *, unnest(range(CAST(ceil(ts / {step}) AS BIGINT), (ts + {window} - 1) // {step} + 1)) AS k FROM rx),
ra AS (SELECT {by}, k * {step} AS ts, count(*) AS n, CAST(min_by(value, ts) AS DOUBLE) AS a, CAST(max_by(value, ts) AS DOUBLE) AS z, CAST(min(ts) AS DOUBLE) AS t0, CAST(max(ts) AS DOUBLE) AS t1, CAST(sum(CASE WHEN pv > value AND pt > k * {step} - {window} THEN pv ELSE 0 END) AS DOUBLE) AS drops FROM ry GROUP BY {by}, k),
rb AS (SELECT {by}, ts, a, z - a + drops AS up, t1 - t0 AS taken, t0 - (ts - {window}) AS begins, ts - t1 AS ends, (t1 - t0) / (n - 1) AS mean FROM ra WHERE n > 1),
rc AS (SELECT *, CASE WHEN begins >= mean * 1.1::DOUBLE THEN mean / 2 ELSE begins END AS b0, CASE WHEN ends >= mean * 1.1::DOUBLE THEN mean / 2 ELSE ends END AS e0, CASE WHEN up > 0 THEN taken * a / up END AS zero FROM rb),
rates AS (SELECT {by}, ts, up * ((taken + CASE WHEN zero >= 0 AND zero < b0 THEN zero ELSE b0 END + e0) / taken) / {window}::DOUBLE AS rate FROM rc)"""


#: Counters restart every five days here, so that resets occur.
_RESTART = 432_000


@query(f"""WITH {_scraped_sql("SELECT 'gateway' AS job, epoch_us(ts) // 1000000 AS sec, count(*) AS n FROM events GROUP BY ALL", "job", 15, _RESTART)}, {_rate_sql("job", 60, 60)} SELECT job, ts, rate FROM rates""")
def received_rate_steps(spark, sf_dir):
    """rate(received[1m]) at 1-minute steps over a counter scraped every 15 seconds."""
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    inc = read_events(spark, sf_dir).select(F.lit("gateway").alias("job"), at.alias("at"), F.lit(1).alias("n"))
    return metrics.range_rate(metrics.scraped(inc, ["job"], 15, _RESTART), 60, 60, ["job"]).select("job", F.col("ts").cast("long").alias("ts"), "rate")


_BUCKETS_SQL = f"SELECT partition, le, event_us // 1000000 AS sec, count(*) FILTER (WHERE latency_us <= le) AS n FROM t, {_LES} GROUP BY ALL"


@query(f"""WITH {T_SQL}, {_scraped_sql(_BUCKETS_SQL, "partition, le", 60, _RESTART)}, {_rate_sql("partition, le", 300, 60)},
s AS (SELECT le, ts, sum(rate) AS c FROM rates GROUP BY ALL), m AS (SELECT *, max(c) OVER (PARTITION BY ts) AS most FROM s), b AS (SELECT *, coalesce(lag(c) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS low, 0.99::DOUBLE * most AS rank FROM m WHERE most > 0 WINDOW w AS (PARTITION BY ts ORDER BY le)),
f AS (SELECT * FROM b WHERE c >= rank QUALIFY row_number() OVER (PARTITION BY ts ORDER BY le) = 1) SELECT ts, round(CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (rank - below) / (c - below) END, 6) AS value FROM f""")
def latency_p99_steps(spark, sf_dir):
    """histogram_quantile(0.99, sum by (le) (rate(bucket[5m]))) at 1-minute steps over bucket counters of each log partition, scraped every minute."""
    t, c = _events(spark, sf_dir), F.col
    les = F.explode(F.array(*(F.lit(b) for b in (*_BOUNDS, float("inf"))))).alias("le")
    inc = t.select("partition", F.floor(c("event_us") / 1_000_000).alias("at"), "latency_us", les).select("partition", "le", "at", (c("latency_us") <= c("le")).cast("long").alias("n"))
    out = metrics.range_quantile(0.99, metrics.scraped(inc, ["partition", "le"], 60, _RESTART), 300, 60, ["partition", "le"])
    return out.select(c("ts").cast("long").alias("ts"), F.round("value", 6).alias("value"))


@query(f"""WITH RECURSIVE {scores_sql(86_400_000, 20, False)}, {_scraped_sql("SELECT service_name, clock // 1000 AS sec, count(*) FILTER (WHERE odd) AS n FROM s GROUP BY ALL", "service_name", 60, _RESTART)}, {_rate_sql("service_name", 300, 300)} SELECT service_name, ts, rate FROM rates WHERE rate > 0""")
def anomaly_rate_steps(spark, sf_dir):
    """rate(anomalies[5m]) at 5-minute steps for each service, over a counter scraped every minute; steps in which it grew."""
    s = _scored(spark, sf_dir, False, 86_400_000, 20)
    inc = s.select("service_name", F.floor(F.col("clock") / 1000).alias("at"), F.col("is_anomaly").cast("long").alias("n"))
    return metrics.range_rate(metrics.scraped(inc, ["service_name"], 60, _RESTART), 300, 300, ["service_name"]).where("rate > 0").select("service_name", F.col("ts").cast("long").alias("ts"), "rate")


_ACTIVE_SQL = "SELECT event_type AS job, epoch_us(ts) // 1000000 AS sec, 1 AS n FROM events WHERE event_id % 20 = 0 UNION ALL SELECT event_type, epoch_us(ts) // 1000000 + (event_id % 97 + 1) * 60, -1 FROM events WHERE event_id % 20 = 0 AND event_id % 700 <> 0"


@query(f"WITH {_scraped_sql(_ACTIVE_SQL, 'job', 300, 10**12)} SELECT job, ts, value FROM samples WHERE value > 0")
def active_requests_steps(spark, sf_dir):
    """Requests under way at scrapes every five minutes: every 20th event begins one, of up to 97 minutes; some never finish."""
    at, n = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000), F.col("event_id")
    r = read_events(spark, sf_dir).where(n % 20 == 0).select(F.col("event_type").alias("job"), at.alias("begin"), F.when(n % 700 != 0, at + (n % 97 + 1) * 60).alias("finish"))
    return metrics.active_requests(r, ["job"], 300).where("value > 0").select("job", F.col("ts").cast("long").alias("ts"), "value")


@query(f"WITH {T_SQL}, r AS (SELECT service_name, route, event_id, event_us, row_number() OVER (PARTITION BY service_name, route ORDER BY event_us DESC, event_id) AS rank FROM t) SELECT service_name, route, event_id, event_us, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3")
def latest_per_route(spark, sf_dir):
    w = W.partitionBy("service_name", "route").orderBy(F.desc("event_us"), "event_id")
    return _events(spark, sf_dir).select("service_name", "route", "event_id", "event_us", F.row_number().over(w).alias("rank")).where("rank <= 3")


@query(SQL["latest_per_route"])
def latest_per_route_by_date(spark, sf_dir):
    """The same out of a table in date partitions, of which only those are read that hold one of the rows."""
    from .sources.dated import DatedTable

    t = _events(spark, sf_dir).select("service_name", "route", "event_id", "event_us")
    dated = DatedTable(spark, shared_folder(spark, "dated"), ["service_name", "route"])
    dated.append(t, "timestamp_micros(event_us)")
    return dated.latest(3, [F.desc("event_us"), F.col("event_id")]).select("service_name", "route", "event_id", "event_us", "rank")


@query(f"WITH {T_SQL} SELECT service_name, max_by(latency_us, (event_us, id)) AS value FROM t GROUP BY service_name")
def latest_gauge(spark, sf_dir):
    t = _events(spark, sf_dir).select("service_name", F.col("latency_us").alias("value"), F.struct("event_us", "id").alias("ts"))
    return metrics.last_value(t, ["service_name"])


@query("SELECT elapsed_ns, total, total - coalesce(lag(total) OVER (ORDER BY elapsed_ns), 0) AS due FROM (SELECT elapsed_ns, elapsed_ns // 1000000000 * 1000 + (elapsed_ns % 1000000000) * 1000 // 1000000000 AS total FROM (VALUES (10000000::BIGINT), (40000000), (100000000), (1000000000), (1234567890)) v(elapsed_ns))")
def pacer_schedule(spark, sf_dir):
    ticks = spark.createDataFrame([(n,) for n in (10_000_000, 40_000_000, 100_000_000, 1_000_000_000, 1_234_567_890)], "elapsed_ns long")
    return generate.pacer(ticks, 1000)


_RUN = "WITH m AS (SELECT event_type, count(*) AS expected_attempted, count(*) AS attempted, count(*) FILTER (WHERE user_id % 4 > 0 OR event_type <> 'error') AS queued, CAST(0 AS BIGINT) AS invalid, count(*) FILTER (WHERE user_id % 4 = 0 AND event_type = 'error') AS dropped_full, CAST(0 AS BIGINT) AS dropped_closed, count(*) FILTER (WHERE (user_id % 4 > 0 OR event_type <> 'error') AND NOT (event_type = 'click' AND event_id % 50 = 1)) AS acknowledged, CAST(0 AS BIGINT) AS permanent_failures, count(*) / 500.0::DOUBLE AS elapsed_seconds FROM events GROUP BY event_type)"


@query(f"""{_RUN} SELECT *, dropped_full + dropped_closed AS dropped, CASE WHEN elapsed_seconds > 0 THEN acknowledged / elapsed_seconds ELSE 0 END AS acknowledged_events_per_second, attempted = expected_attempted AND invalid = 0 AND dropped_full = 0 AND dropped_closed = 0 AND permanent_failures = 0 AND acknowledged = queued AS valid,
 dropped_full = 0 AND acknowledged = attempted AND queued = attempted AS loss_free FROM m""")
def run_summary(spark, sf_dir):
    """A run per kind of event: errors of some users are dropped, some clicks are queued and never acknowledged."""
    dropped = (F.col("user_id") % 4 == 0) & (F.col("event_type") == "error")
    lost = (F.col("event_type") == "click") & (F.col("event_id") % 50 == 1)
    zero = F.lit(0).cast("long")
    m = read_events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("expected_attempted"), F.count("*").alias("attempted"), F.count_if(~dropped).alias("queued"), zero.alias("invalid"), F.count_if(dropped).alias("dropped_full"), zero.alias("dropped_closed"), F.count_if(~dropped & ~lost).alias("acknowledged"), zero.alias("permanent_failures"), (F.count("*") / 500.0).alias("elapsed_seconds"))
    s = reconcile.run_summary(m)
    return s.withColumn("loss_free", reconcile.loss_free({c: F.col(c) for c in s.columns}, F.col("attempted")))


@query("SELECT count(*) AS attempted, count(*) FILTER (WHERE event_id % 13 > 3) AS queued, count(*) FILTER (WHERE event_id % 13 = 1) AS invalid, count(*) FILTER (WHERE event_id % 13 IN (0, 2)) AS dropped_full, count(*) FILTER (WHERE event_id % 13 = 3) AS dropped_closed FROM events")
def client_counters(spark, sf_dir):
    k = F.col("event_id") % 13
    return metrics.client_snapshot(read_events(spark, sf_dir).select(F.when(k == 1, "invalid").when(k.isin(0, 2), "dropped_full").when(k == 3, "dropped_closed").otherwise("queued").alias("outcome")))


_CODES = ("40001", "40P01", "08006", "53300", "57P01", "57P02", "57P03", "42P01", "42703", "42883", "3F000", "23514", "57P04", "99999")
_STATES = ("Aborted", "Cancelled", "DeadlineExceeded", "Internal", "ResourceExhausted", "Unavailable", "Unknown", "InvalidArgument", "NotFound", "FailedPrecondition", "OK")


def _coded(spark, sf_dir, codes: tuple[str, ...]) -> DataFrame:
    """The events, each with one of the codes in turn."""
    return read_events(spark, sf_dir).select(F.element_at(F.array(*map(F.lit, codes)), (F.col("event_id") % len(codes) + 1).cast("int")).alias("code"))


def _coded_sql(codes: tuple[str, ...], retryable: str) -> str:
    return f"SELECT code, {retryable} AS retryable, count(*) AS attempts FROM (SELECT list_extract([{', '.join(map(repr, codes))}], event_id % {len(codes)} + 1) AS code FROM events) GROUP BY code"


@query(_coded_sql(_CODES, "code LIKE '08%' OR code LIKE '53%' OR code IN ('40001', '40P01', '57P01', '57P02', '57P03')"))
def sqlstate_classification(spark, sf_dir):
    return _coded(spark, sf_dir, _CODES).groupBy("code", retryable_sqlstate(F.col("code")).alias("retryable")).agg(F.count("*").alias("attempts"))


@query(_coded_sql(_STATES, "code IN ('Aborted', 'Cancelled', 'DeadlineExceeded', 'Internal', 'ResourceExhausted', 'Unavailable', 'Unknown')"))
def status_classification(spark, sf_dir):
    return _coded(spark, sf_dir, _STATES).groupBy("code", retryable_status(F.col("code")).alias("retryable")).agg(F.count("*").alias("attempts"))


@query(f"""WITH {T_SQL}, e AS (SELECT partition, count(*) AS n FROM t GROUP BY partition) SELECT CAST(sum(n - CASE WHEN partition = 2 THEN 5 ELSE 0 END) AS BIGINT) AS current, CAST(sum(n) AS BIGINT) AS "end", CAST(5 AS BIGINT) AS lag, count(*) AS partitions, false AS ok, true AS ok_behind FROM e""")
def group_status(spark, sf_dir):
    """Status lines of a group that lags by 5 in one partition, among lines of other topics: not caught up, but in order otherwise."""
    ends = reconcile.next_offsets(with_offsets(_events(spark, sf_dir)))
    late = F.when(F.col("partition") == 2, 5).otherwise(0)
    lines = ends.select(F.format_string("proc telemetry.raw %d %d %d %d c h i", "partition", F.col("next_offset") - late, "next_offset", late).alias("line"))
    more = spark.createDataFrame([(x,) for x in ("GROUP TOPIC PARTITION CURRENT-OFFSET LOG-END-OFFSET LAG CONSUMER-ID HOST CLIENT-ID", "proc other 0 1 9 8 c h i", "")], "line string")
    lines = lines.unionAll(more)
    strict, loose = (reconcile.group_status(lines, "telemetry.raw", 3, "proc", caught_up=c) for c in (True, False))
    return strict.join(loose.select(F.col("ok").alias("ok_behind")))  # two single rows


@query("SELECT CAST(i % 3 AS INTEGER) AS partition, '00000000-0000-4000-8000-' || lpad(lower(to_hex(i)), 12, '0') AS event_id, 250 + i % 10000 AS latency_us, 'sink-' || lpad(lower(to_hex(i)), 12, '0') AS trace_id FROM range(0, 50000) r(i)")
def deterministic_enriched(spark, sf_dir):
    return generate.enriched_events(spark, 50_000).select("partition", "event_id", "latency_us", "trace_id")


@query(f"WITH {T_SQL} SELECT event_id, lower(hex(encode(service_name))) || '00' || lower(hex(encode(route))) AS key_hex, '{{\"k\":\"' || CAST(json_extract(props, '$.k') AS VARCHAR) || '\"}}' AS attributes FROM t")
def record_inspection(spark, sf_dir):
    from .functions.codec import hex_dump

    return _events(spark, sf_dir).select("event_id", hex_dump(partition_key("service_name", "route").cast("binary")).alias("key_hex"), map_json("attributes").alias("attributes"))


@query(f"WITH {T_SQL} SELECT id, event_id, service_name, route, latency_us, status_code, trace_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS attribute, true AS ok FROM t")
def codec_round_trip(spark, sf_dir):
    """Encode every event to its wire form and decode it again."""
    from .functions.codec import decode_event, encode_event

    t = _events(spark, sf_dir)
    event = F.struct("event_id", F.struct(F.floor(F.col("event_us") / 1_000_000).alias("seconds"), ((F.col("event_us") % 1_000_000) * 1000).cast("int").alias("nanos")).alias("event_time"), "service_name", "route", F.col("latency_us").cast("decimal(20,0)").alias("latency_us"), "status_code", "trace_id", "attributes")
    d = t.select("id", "event_us", decode_event(encode_event(event)).alias("d"))
    e = F.col("d.event")
    ok = F.col("d.ok") & (e["event_time"]["seconds"] * 1_000_000 + F.floor(e["event_time"]["nanos"] / 1000) == F.col("event_us"))
    return d.select("id", e["event_id"].alias("event_id"), e["service_name"].alias("service_name"), e["route"].alias("route"), e["latency_us"].cast("long").alias("latency_us"), e["status_code"].alias("status_code"), e["trace_id"].alias("trace_id"), e["attributes"]["k"].alias("attribute"), ok.alias("ok"))


def _log_records(t: DataFrame) -> DataFrame:
    """The events in wire form, for a raw log."""
    from .functions.codec import encode_event

    event = F.struct("event_id", F.struct(F.floor(F.col("event_us") / 1_000_000).alias("seconds"), ((F.col("event_us") % 1_000_000) * 1000).cast("int").alias("nanos")).alias("event_time"), "service_name", "route", F.col("latency_us").cast("decimal(20,0)").alias("latency_us"), "status_code", "trace_id", "attributes")
    return t.select("id", F.floor(F.col("event_us") / 1000).alias("clock"), partition_key("service_name", "route").cast("binary").alias("key"), encode_event(event).alias("value"), "partition")


def _stored_scores(spark, sf_dir, state, warmup: int):
    """Raw log, scoring job, enriched log, sink job, events table."""
    from .sources.filelog import FileLog
    from .sources.store import EventStore
    from .streaming.pipeline import persist_query, score_query

    root = shared_folder(spark, "stream")
    log, store = FileLog(spark, f"{root}/log"), EventStore(spark, f"{root}/store")
    log.append(_log_records(_events(spark, sf_dir, True)), "telemetry.raw", "0", ["clock", "id"])
    clock = F.col("event.event_time.seconds") * 1000 + F.floor(F.col("event.event_time.nanos") / 1_000_000)
    score_query(log, f"{root}/checkpoint", clock=clock, detector=DetectorConfig(warmup=warmup), state=state).awaitTermination()
    persist_query(log, store, f"{root}/checkpoint").awaitTermination()
    return store.events().select("event_id", "ewma_mean_us", "ewma_stddev_us", "anomaly_score", "is_anomaly")


_STORED = "SELECT event_id, mean AS ewma_mean_us, std AS ewma_stddev_us, score AS anomaly_score, odd AS is_anomaly"


@query(SQL["ewma_scores"].replace(f"SELECT {SCORE_COLUMNS}", _STORED))
def stream_score_parity(spark, sf_dir):
    """The stored verdicts equal the batch scan's."""
    return _stored_scores(spark, sf_dir, None, 100)


@query(SQL["ewma_scores_ttl"].replace(f"SELECT {SCORE_COLUMNS}, CAST(segment AS BIGINT) AS segment", _STORED))
def stream_score_ttl(spark, sf_dir):
    """The same with the default inactivity limit and capacity."""
    return _stored_scores(spark, sf_dir, StateConfig(), 2)


@query(SQL["ewma_scores"])
def stream_score_resumed(spark, sf_dir):
    """The first half of the events scored as a batch, the second half by a stream that starts from the batch's states: the scores of the whole."""
    from .streaming.keyed import read_in_order, run_to_end, score_by_key

    t = _events(spark, sf_dir, True).select("id", "service_name", "route", "clock", "latency_us")
    half = t.agg(F.floor(F.avg("clock")).cast("long")).first()[0] or 0
    early, late, root = t.where(F.col("clock") < half), t.where(F.col("clock") >= half), shared_folder(spark, "resumed")
    stream = read_in_order(late, f"{root}/late", ["clock", "id"])
    run_to_end(score_by_key(stream, tie=("id",), initial=detector.baselines(early, tie=("id",))), f"{root}/scored", f"{root}/checkpoint")
    return _verdict(detector.score(early, tie=("id",))).unionByName(_verdict(spark.read.parquet(f"{root}/scored")))


@query(f"""WITH {T_SQL}, q AS (SELECT row_number() OVER (ORDER BY event_us, id) - 1 AS seq, service_name || route AS key, clock FROM t),
p AS (SELECT *, lag(seq) OVER w AS previous, clock - lag(clock) OVER w AS gap FROM q WINDOW w AS (PARTITION BY key ORDER BY seq)),
d AS (SELECT p.seq, count(DISTINCT o.key) AS others FROM p JOIN q o ON o.seq > p.previous AND o.seq < p.seq GROUP BY p.seq),
k AS (SELECT key, max(clock) AS last FROM q GROUP BY key)
SELECT 'inactivity' AS store, CAST((SELECT count(*) FROM p WHERE gap >= 86400000) + (SELECT count(*) FROM k WHERE (SELECT max(clock) FROM q) - last >= 86400000) AS BIGINT) AS ttl_evictions, CAST(0 AS BIGINT) AS capacity_evictions
UNION ALL SELECT 'capacity', CAST(0 AS BIGINT), CAST((SELECT count(*) FROM p LEFT JOIN d ON p.seq = d.seq WHERE p.previous IS NULL OR coalesce(d.others, 0) >= 10) - least((SELECT count(*) FROM k), 10) AS BIGINT)""")
def store_evictions(spark, sf_dir):
    t = _events(spark, sf_dir).select("id", "event_us", "clock", F.concat("service_name", "route").alias("key"))
    rows = reconcile.numbered(t, ["event_us", "id"], F.floor(F.col("event_us") / 3_600_000_000))
    out = [residency.evictions(residency.residency(rows, "key", "clock", "seq", ttl, cap), ttl, cap).select(F.lit(name).alias("store"), "*") for name, ttl, cap in (("inactivity", 86_400_000, None), ("capacity", None, 10))]
    return out[0].unionByName(out[1])


def _wire_event():
    return F.struct("event_id", F.struct(F.floor(F.col("event_us") / 1_000_000).alias("seconds"), ((F.col("event_us") % 1_000_000) * 1000).cast("int").alias("nanos")).alias("event_time"), "service_name", "route", F.col("latency_us").cast("decimal(20,0)").alias("latency_us"), "status_code", "trace_id", "attributes")


@query(f"""WITH {T_SQL} SELECT '00000000-0000-4000-9000-' || lpad(lower(to_hex(id // 100)), 12, '0') AS batch_id, CAST(id % 100 AS INTEGER) AS i, event_id, service_name, route, latency_us, status_code, trace_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS attribute FROM t
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'truncated varint', NULL""")
def gateway_decode(spark, sf_dir):
    """Export requests from their bytes; one that can't be decoded says why."""
    from .functions.codec import decode_batch, encode_batch

    t = _events(spark, sf_dir)
    packed = t.groupBy(F.floor(F.col("id") / 100).alias("b")).agg(F.array_sort(F.collect_list(F.struct((F.col("id") % 100).alias("i"), _wire_event().alias("v"))), lambda x, y: (x["i"] - y["i"]).cast("int")).alias("events"))  # a request's events are bounded
    requests = packed.select(encode_batch(F.struct(hex_id("00000000-0000-4000-9000-", F.col("b"), 12).alias("batch_id"), F.transform("events", lambda x: x["v"]).alias("events"))).alias("payload"))
    requests = requests.unionAll(spark.range(1).select(F.lit(b"\x12\xff")))
    d = requests.select(decode_batch(F.col("payload")).alias("d"))
    rows = d.select("d.error", "d.batch.batch_id", F.posexplode_outer("d.batch.events").alias("i", "e"))
    return rows.select("batch_id", "i", "e.event_id", "e.service_name", "e.route", F.col("e.latency_us").cast("long").alias("latency_us"), "e.status_code", F.coalesce("error", "e.trace_id").alias("trace_id"), F.col("e.attributes")["k"].alias("attribute"))


_SINK_CASE = "CASE WHEN id % 17 IN (2, 3) THEN 'timestamp' WHEN id % 17 IN (1, 4, 5, 6, 7, 10, 11, 13, 14, 15, 16) THEN 'validation' END"


@query(f"""WITH {T_SQL}, {OFFSET_SQL} SELECT 2 AS stage, 'telemetry.raw' AS source_topic, partition AS source_partition, "offset" AS source_offset, {_SINK_CASE} AS error_category, CASE WHEN id % 17 = 1 THEN '' ELSE event_id END AS event_id FROM o WHERE {_SINK_CASE} IS NOT NULL""")
def sink_dlq_envelope(spark, sf_dir):
    from .operators.route import dead_letters
    from .schemas import STAGE_SINK

    t = _faulty(with_offsets(_events(spark, sf_dir)))
    now = F.struct(F.lit(1_800_000_000).cast("long").alias("seconds"), F.lit(0).alias("nanos"))
    t = t.withColumn("enriched", F.struct("event", F.lit(1.0).alias("ewma_mean_us"), F.when(F.col("id") % 17 == 16, float("nan")).otherwise(0.0).alias("ewma_stddev_us"), F.lit(0.5).alias("anomaly_score"), F.lit(False).alias("is_anomaly"), now.alias("processed_at")))
    t = t.withColumn("failure", enriched_failure(F.col("enriched"))).withColumn("value", F.lit(b""))
    return dead_letters(t, STAGE_SINK, F.lit(0)).select("stage", "source_topic", "source_partition", "source_offset", "error_category", "event_id")


@query(f"""WITH {T_SQL}, {OFFSET_SQL}, {_COPIES_SQL}, b AS (SELECT *, "offset" // 500 AS batch, id % 23 = 5 AS dead, row_number() OVER (PARTITION BY lower(event_id) ORDER BY copy, partition, "offset") = 1 AS first FROM c),
r AS (SELECT copy, partition, batch, count(*) AS consumed, count(*) FILTER (WHERE dead) AS dlq, count(*) FILTER (WHERE NOT dead AND first) AS inserted, CASE WHEN batch % 5 = 2 THEN 1 ELSE 0 END AS retries FROM b GROUP BY copy, partition, batch)
SELECT CAST(sum(consumed) AS BIGINT) AS consumed, CAST(sum(inserted) AS BIGINT) AS persisted, CAST(sum(consumed - dlq - inserted) AS BIGINT) AS conflicts, CAST(sum(retries) AS BIGINT) AS retries, CAST(sum(dlq) AS BIGINT) AS dlq, count(*) AS batches FROM r""")
def sink_counters(spark, sf_dir):
    """Batches of 500 of the log and of its copies; dead rows and conflicts are counted per batch."""
    c = _with_copies(with_offsets(_events(spark, sf_dir)))
    first = c.groupBy(F.lower("event_id").alias("k")).agg(F.min(F.struct("copy", "partition", "offset")).alias("first"))
    c = c.join(first, F.lower("event_id") == F.col("k")).withColumn("is_first", F.col("first") == F.struct("copy", "partition", "offset")).withColumn("dead", F.col("id") % 23 == 5)
    b = c.groupBy("copy", "partition", F.floor(F.col("offset") / 500).alias("batch")).agg(F.count("*").alias("consumed"), F.count_if("dead").alias("dlq"), F.count_if(~F.col("dead") & F.col("is_first")).alias("inserted"))
    b = b.withColumn("conflicts", F.col("consumed") - F.col("dlq") - F.col("inserted")).withColumn("retries", F.when(F.col("batch") % 5 == 2, 1).otherwise(0))
    return metrics.sink_counters(b)


@query(f"""WITH RECURSIVE {T_SQL}, {OFFSET_SQL}, b AS (SELECT partition, "offset", event_us, 0 AS batch, 1 AS size, event_us AS begin_us FROM o WHERE "offset" = 0
 UNION ALL SELECT o.partition, o."offset", o.event_us, CASE WHEN b.size >= 50 OR o.event_us - b.begin_us >= 3600000000 THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.size >= 50 OR o.event_us - b.begin_us >= 3600000000 THEN 1 ELSE b.size + 1 END,
 CASE WHEN b.size >= 50 OR o.event_us - b.begin_us >= 3600000000 THEN o.event_us ELSE b.begin_us END FROM b JOIN o ON o.partition = b.partition AND o."offset" = b."offset" + 1)
SELECT partition, CAST(batch AS BIGINT) AS batch, count(*) AS records, max("offset") + 1 AS commit_offset FROM b GROUP BY ALL""")
def timed_batches(spark, sf_dir):
    """The first of a count and a time closes a batch."""
    b = reconcile.timed_batches(with_offsets(_events(spark, sf_dir)).select("topic", "partition", "offset", F.col("event_us").alias("clock_us")), 50, 3_600_000_000)
    return b.groupBy("partition", "batch").agg(F.count("*").alias("records"), (F.max("offset") + 1).alias("commit_offset"))


@query(f"""WITH {T_SQL}, s AS (SELECT service_name, CAST(clock // 21600000 * 21600 AS BIGINT) AS window_start, latency_us FROM t), h AS (SELECT service_name, window_start, le, count(*) FILTER (WHERE latency_us <= le) AS c FROM s, {_LES} GROUP BY ALL),
b AS (SELECT *, coalesce(lag(c) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS low, 0.99::DOUBLE * max(c) OVER (PARTITION BY service_name, window_start) AS rank FROM h WINDOW w AS (PARTITION BY service_name, window_start ORDER BY le)),
f AS (SELECT * FROM b WHERE c >= rank QUALIFY row_number() OVER (PARTITION BY service_name, window_start ORDER BY le) = 1) SELECT service_name, window_start, CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (rank - below) / (c - below) END AS value FROM f""")
def latency_p99_windows(spark, sf_dir):
    return metrics.windowed_quantile(0.99, _events(spark, sf_dir), F.col("latency_us"), _BOUNDS, F.timestamp_micros("event_us"), 21_600, ["service_name"])


@query("""WITH c AS (SELECT epoch_us(ts) // 1000000 AS ts, event_type, count(*) AS n FROM events GROUP BY ALL), t AS (SELECT event_type, ts, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY ts) AS BIGINT) AS value FROM c),
g AS (SELECT *, count(*) OVER w AS n, first(ts) OVER w AS t0, first(value) OVER w AS v0 FROM t WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW)),
e AS (SELECT *, value - v0 AS up, ts - t0 AS taken, (t0 - (ts - 3600))::DOUBLE AS gap FROM g), m AS (SELECT *, CASE WHEN n > 1 THEN CASE WHEN gap >= taken / (n - 1) * 1.1::DOUBLE THEN taken / (n - 1) / 2 ELSE gap END END AS gap1 FROM e),
z AS (SELECT *, CASE WHEN up > 0 AND taken * v0 / up < gap1 THEN taken * v0 / up ELSE gap1 END AS gap2 FROM m) SELECT event_type, ts, value, CASE WHEN n > 1 THEN round(up * ((taken + gap2) / taken) / 3600, 12) END AS rate FROM z""")
def extrapolated_rate_1h(spark, sf_dir):
    c = read_events(spark, sf_dir).groupBy(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("ts"), "event_type").count()
    samples = c.select("event_type", "ts", F.sum("count").over(W.partitionBy("event_type").orderBy("ts")).alias("value"))
    return metrics.extrapolated_rate(samples, 3600, ["event_type"]).withColumn("rate", F.round("rate", 12))


@query(f"""WITH {T_SQL}, {OFFSET_SQL} SELECT 'telemetry.raw' AS topic, partition, "offset", CASE WHEN id % 13 = 4 THEN '{{"key_hex":"' || lower(hex(encode(service_name))) || '00' || lower(hex(encode(route))) || '","kind":"malformed","offset":' || "offset" || ',"partition":' || partition || ',"payload_hex":"ff00","topic":"telemetry.raw"}}'
 ELSE '{{"event_id":"' || event_id || '","kind":"valid","offset":' || "offset" || ',"partition":' || partition || ',"topic":"telemetry.raw","trace_id":"' || trace_id || '"}}' END AS line FROM o""")
def record_lines(spark, sf_dir):
    from .functions.codec import encode_event
    from .operators.route import raw_lines

    t = with_offsets(_events(spark, sf_dir)).withColumn("value", encode_event(_wire_event()))
    return raw_lines(t.select("topic", "partition", "offset", partition_key("service_name", "route").cast("binary").alias("key"), F.when(F.col("id") % 13 == 4, F.lit(b"\xff\x00")).otherwise(F.col("value")).alias("value")))


@query(f"""WITH {T_SQL} SELECT CASE WHEN id % 19 IN (3, 4, 5) THEN 'retry' WHEN {_RAW_CASE} <> 'valid' THEN 'dlq' ELSE 'enriched' END AS outcome, count(*) AS records FROM t GROUP BY 1""")
def processing_outcomes(spark, sf_dir):
    """An invalid processing clock makes a record wait, whatever else is wrong with it."""
    from .operators.route import processing_outcome

    k = F.col("id") % 19
    wall = F.when(k != 5, F.struct(F.when(k == 3, 253_402_300_800).otherwise(1_800_000_000).alias("seconds"), F.when(k == 4, 1_000_000_000).otherwise(0).alias("nanos")))
    f = _faulty(_events(spark, sf_dir))
    return f.groupBy(processing_outcome(wall, raw_failure(F.col("event"), F.col("key"))).alias("outcome")).agg(F.count("*").alias("records"))


_CLIENT_US = "CASE id % 7 WHEN 0 THEN -62135596800000000 WHEN 1 THEN -62135596800000001 WHEN 2 THEN 253402300799999999 WHEN 3 THEN 253402300800000000 WHEN 4 THEN -event_us ELSE event_us END"


@query(f"""WITH {T_SQL}, x AS (SELECT id, trace_id, {_CLIENT_US} AS us FROM t), o AS (SELECT *, CASE WHEN id % 7 IN (1, 3) THEN 'invalid' WHEN id % 11 = 2 THEN 'dropped_closed' WHEN id % 5 = 1 THEN 'dropped_full' ELSE 'queued' END AS outcome FROM x)
SELECT id, outcome, CASE WHEN outcome = 'queued' THEN '00000000-0000-4000-8000-' || lpad(lower(to_hex(id)), 12, '0') END AS event_id, CASE WHEN outcome = 'queued' THEN CAST(floor(us / 1000000::HUGEINT) AS BIGINT) END AS seconds,
 CASE WHEN outcome = 'queued' THEN CAST(((us % 1000000) + 1000000) % 1000000 * 1000 AS INTEGER) END AS nanos, CASE WHEN outcome = 'queued' THEN CASE WHEN id % 3 = 0 THEN '' ELSE trace_id END END AS trace_id FROM o""".replace("CAST(floor(us / 1000000::HUGEINT) AS BIGINT)", "(us - (((us % 1000000) + 1000000) % 1000000)) // 1000000"))
def client_events(spark, sf_dir):
    k = F.col("id") % 7
    us = F.when(k == 0, F.lit(-62_135_596_800_000_000)).when(k == 1, F.lit(-62_135_596_800_000_001)).when(k == 2, F.lit(253_402_300_799_999_999)).when(k == 3, F.lit(253_402_300_800_000_000)).when(k == 4, -F.col("event_us")).otherwise(F.col("event_us"))
    emits = _events(spark, sf_dir).withColumn("event_us", us).withColumn("n", F.col("id")).withColumn("trace_id", F.when(F.col("id") % 3 != 0, F.col("trace_id"))).withColumn("room", F.col("id") % 5 != 1).withColumn("closed", F.col("id") % 11 == 2)
    w = client.wire_events(emits)
    return w.select("id", "outcome", F.col("event.event_id").alias("event_id"), F.col("event.event_time.seconds").alias("seconds"), F.col("event.event_time.nanos").alias("nanos"), F.col("event.trace_id").alias("trace_id"))


@query("""WITH e AS (SELECT event_type AS client, event_id AS seq, CASE WHEN event_id > 300 AND event_id % 101 = 7 THEN 'status ' || (event_id % 3) END AS failure FROM events WHERE event_id % 50 <> 49), f AS (SELECT event_type AS client, event_id AS seq FROM events WHERE event_id % 50 = 49),
x AS (SELECT client, min(seq) AS first, min_by(failure, seq) AS failure FROM e WHERE failure IS NOT NULL GROUP BY client) SELECT f.client, f.seq, CASE WHEN x.first < f.seq THEN x.failure END AS failure FROM f LEFT JOIN x ON f.client = x.client""")
def flush_results(spark, sf_dir):
    rows = read_events(spark, sf_dir).select(F.col("event_type").alias("client"), F.col("event_id").alias("seq"))
    failure = F.when((F.col("seq") > 300) & (F.col("seq") % 101 == 7), F.concat(F.lit("status "), (F.col("seq") % 3).cast("string")))
    return client.flush_results(rows.where("seq % 50 <> 49").withColumn("failure", failure), rows.where("seq % 50 = 49"))


@query(f"""WITH {T_SQL}, e AS (SELECT partition, count(*) AS n FROM t GROUP BY partition) SELECT 'telemetry.raw' AS topic, partition, n // 2 AS before, CASE WHEN partition = 1 THEN n // 2 + 3 ELSE n // 2 END AS after, partition = 1 AS moved, n - CASE WHEN partition = 1 THEN n // 2 + 3 ELSE n // 2 END AS lag FROM e""")
def moved_offsets(spark, sf_dir):
    """Committed offsets before and after a crash, which moved on in one partition."""
    ends = reconcile.next_offsets(with_offsets(_events(spark, sf_dir)))
    before = ends.select("topic", "partition", F.floor(F.col("next_offset") / 2).alias("value"))
    return reconcile.moved_offsets(before, before.withColumn("value", F.col("value") + F.when(F.col("partition") == 1, 3).otherwise(0)), ends)


@query(f"""WITH {T_SQL} SELECT 'route_events_total' AS name, service_name || CASE WHEN service_name = 'svc-error' THEN ' "odd\\' ELSE '' END AS service, route, count(*)::DOUBLE AS value FROM t GROUP BY ALL
UNION ALL SELECT 'up', NULL, NULL, 'Infinity'::DOUBLE""")
def scrape_samples(spark, sf_dir):
    """Counters written in exposition format and read back, among comments and broken lines."""
    t = _events(spark, sf_dir)
    name = F.concat("service_name", F.when(F.col("service_name") == "svc-error", F.lit(' "odd\\')).otherwise(F.lit("")))
    lines = t.groupBy(name.alias("service"), "route").agg(F.count("*").alias("n")).select(exposition.line(F.lit("route_events_total"), {"service": F.col("service"), "route": F.col("route")}, F.col("n")).alias("line"))
    more = spark.createDataFrame([(x,) for x in ("# HELP up whether it is", "# TYPE up gauge", "up +Inf", "", "1bad 3", "nothing", "up x")], "line string")
    s = exposition.samples(lines.unionAll(more))
    return s.select("name", F.col("labels")["service"].alias("service"), F.col("labels")["route"].alias("route"), "value")


@query("SELECT '{\"raw\":' || count(*) || ',\"enriched\":' || count(*) FILTER (WHERE event_id % 17 NOT IN (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)) || ',\"dlq\":' || count(*) FILTER (WHERE event_id % 17 IN (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)) || ',\"conserved\":true}' AS line FROM events")
def conservation_report(spark, sf_dir):
    """The report as the JSON line that goes to a file or a terminal."""
    c = conservation(spark, sf_dir)
    return c.select(F.to_json(F.struct(*c.columns)).alias("line"))
