"""Ordered rules, envelopes and classes, case by case."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.functions import expr
from driftwell.operators import reconcile
from driftwell.operators.route import batch_outcomes, retryable_sqlstate, status_of
from driftwell.operators.validate import batch_verdicts, enriched_failure, raw_failure
from driftwell.schemas import ENRICHED, EVENT

ID = "550e8400-e29b-41d4-a716-446655440000"
NOW = 1_791_115_200_000_000  # 2026-10-04T12:00:00Z


def event(**change):
    from decimal import Decimal

    base = dict(event_id=ID, event_time=Row(seconds=1, nanos=2), service_name="svc", route="/r", latency_us=Decimal(10), status_code=200, trace_id="trace-1", attributes={"region": "west"})
    return Row(**{**base, **change})


RAW = [
    ({}, None, None),
    ({"event_id": "not-an-id"}, None, "event_id"),
    ({"event_id": ID + "\n"}, None, "event_id"),
    ({"event_id": ID.upper()}, None, None),
    ({"event_time": None}, None, "event_time"),
    ({"event_time": Row(seconds=253_402_300_799, nanos=999_999_999)}, None, None),
    ({"event_time": Row(seconds=253_402_300_800, nanos=0)}, None, "event_time"),
    ({"event_time": Row(seconds=-62_135_596_801, nanos=0)}, None, "event_time"),
    ({"event_time": Row(seconds=0, nanos=-1)}, None, "event_time"),
    ({"event_time": Row(seconds=0, nanos=1_000_000_000)}, None, "event_time"),
    ({"service_name": ""}, None, "service_name"),
    ({"service_name": "s\0"}, None, "service_name"),
    ({"route": ""}, None, "route"),
    ({"route": "/\0"}, None, "route"),
    ({"route": "é" * 128}, None, None),
    ({"route": "é" * 129}, None, "route"),
    ({"attributes": {f"k{i}": "v" for i in range(16)}}, None, None),
    ({"attributes": {f"k{i}": "v" for i in range(17)}}, None, "attributes"),
    ({"attributes": {"k" * 64: "v" * 256}}, None, None),
    ({"attributes": {"k" * 65: "v"}}, None, "attributes"),
    ({"attributes": {"k": "é" * 129}}, None, "attributes"),
    ({}, b"wrong", "key"),
    ({"event_id": "x", "route": ""}, None, "event_id"),
    ({"trace_id": "t\0"}, None, None),
]


def test_raw_rules(spark):
    rows = [(i, event(**c), key if key is not None else f"{c.get('service_name', 'svc')}\0{c.get('route', '/r')}".encode()) for i, (c, key, _) in enumerate(RAW)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("i", T.LongType()), T.StructField("event", EVENT), T.StructField("key", T.BinaryType())]))
    got = {r.i: r.c for r in df.select("i", raw_failure(F.col("event"), F.col("key"))["category"].alias("c")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(RAW)}


ENRICHED_CASES = [
    ({}, {}, None), ({"event_id": "x"}, {}, "validation"), ({"event_time": None}, {}, "timestamp"), ({}, {"processed_at": Row(seconds=0, nanos=-1)}, "timestamp"), ({"event_id": "x", "event_time": None}, {}, "timestamp"), ({"service_name": "a\0"}, {}, "validation"),
    ({"route": "é" * 129}, {}, "validation"), ({"trace_id": "a\0"}, {}, "validation"), ({"attributes": {"a": "b\0"}}, {}, "validation"), ({"latency_us": 2**63}, {}, "validation"), ({"latency_us": 2**63 - 1}, {}, None), ({"status_code": 2**31}, {}, "validation"),
    ({}, {"anomaly_score": float("nan")}, "validation"), ({}, {"ewma_mean_us": float("inf")}, "validation"), ({}, {"ewma_stddev_us": -1.0}, "validation"), ({}, {"ewma_mean_us": -0.0}, None), ({}, {"event": None}, "validation"),
]


def test_enriched_rules(spark):
    from decimal import Decimal

    rows = []
    for i, (e, c, _) in enumerate(ENRICHED_CASES):
        e = {k: Decimal(v) if k == "latency_us" else v for k, v in e.items()}
        rows.append((i, Row(**{**dict(event=event(**e), ewma_mean_us=100.0, ewma_stddev_us=20.0, anomaly_score=0.5, is_anomaly=False, processed_at=Row(seconds=1_700_000_001, nanos=456_000_000)), **c})))
    df = spark.createDataFrame(rows, T.StructType([T.StructField("i", T.LongType()), T.StructField("e", ENRICHED)]))
    got = {r.i: r.c for r in df.select("i", enriched_failure(F.col("e"))["category"].alias("c")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(ENRICHED_CASES)}


def gate(**change):
    return event(**{"event_time": Row(seconds=NOW // 1_000_000, nanos=0), "service_name": "checkout", "route": "/orders", **change})


DAY, FIVE = 24 * 3600, 300
BATCHES = [
    (ID, [gate()], None),
    (None, None, "request is required"),
    ("", [gate()], "batch_id must be a valid UUID"),
    (ID, [], "events must contain at least 1 event"),
    (ID, [gate()] * 500, None),
    (ID, [gate()] * 501, "events must contain at most 500 events"),
    (ID, [None], "events[0] is required"),
    (ID, [gate(), gate(event_id="x")], "events[1].event_id must be a valid UUID"),
    (ID, [gate(event_time=None)], "events[0].event_time is required"),
    (ID, [gate(event_time=Row(seconds=0, nanos=-1))], "events[0].event_time is invalid"),
    (ID, [gate(event_time=Row(seconds=NOW // 1_000_000 - DAY, nanos=0))], None),
    (ID, [gate(event_time=Row(seconds=NOW // 1_000_000 - DAY - 1, nanos=999_999_999))], "events[0].event_time must not be older than 24 hours"),
    (ID, [gate(event_time=Row(seconds=NOW // 1_000_000 + FIVE, nanos=0))], None),
    (ID, [gate(event_time=Row(seconds=NOW // 1_000_000 + FIVE, nanos=1))], "events[0].event_time must not be more than 5 minutes in the future"),
    (ID, [gate(service_name="")], "events[0].service_name is required"),
    (ID, [gate(service_name="\0")], "events[0].service_name must not contain NUL"),
    (ID, [gate(route="é" * 129)], "events[0].route must be at most 256 bytes"),
    (ID, [gate(attributes={f"k{i}": "v" for i in range(17)})], "events[0].attributes must contain at most 16 attributes"),
    (ID, [gate(attributes={"b": "v" * 257, "a": "v" * 257})], 'events[0].attributes value for key "a" must be at most 256 bytes'),
    (ID, [gate(attributes={"k" * 65: "v"})], f'events[0].attributes["{"k" * 65}"] key must be at most 64 bytes'),
]


def test_gateway_rules(spark):
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("batch_id", T.StringType()), T.StructField("events", T.ArrayType(EVENT))])
    df = spark.createDataFrame([(i, b, e) for i, (b, e, _) in enumerate(BATCHES)], schema)
    got = {r.i: r.reason for r in batch_verdicts(df, F.lit(NOW), keep=["i"]).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(BATCHES)}


def test_status_and_priorities(spark):
    d = spark.createDataFrame([(1, 0, None), (1, 1, "timeout"), (1, 2, "record_too_large"), (1, 3, "permanent"), (2, 0, "timeout"), (2, 1, "permanent"), (3, 0, None)], "batch_id long, index long, error string")
    assert {r.batch_id: r.error for r in batch_outcomes(d).collect()} == {1: "record_too_large", 2: "permanent", 3: None}
    cases = [(None, None, None, "OK"), ("bad", "canceled", "buffer_full", "InvalidArgument"), (None, "canceled", "buffer_full", "Canceled"), (None, None, "deadline", "DeadlineExceeded"), (None, None, "buffer_full", "ResourceExhausted"), (None, None, "record_too_large", "InvalidArgument"), (None, None, "permanent", "FailedPrecondition"), (None, None, "empty_batch", "Internal"), (None, None, "other", "Unavailable")]
    df = spark.createDataFrame(cases, "reason string, context string, error string, want string")
    assert all(r.code == r.want for r in df.select(status_of(F.col("reason"), F.col("context"), F.col("error"))["code"].alias("code"), "want").collect())
    codes = [("40001", True), ("08006", True), ("53300", True), ("57P03", True), ("42P01", False), ("57P04", False), (None, False)]
    df = spark.createDataFrame(codes, "code string, want boolean")
    assert all(r.got == r.want for r in df.select(retryable_sqlstate(F.col("code")).alias("got"), "want").collect())


def test_scalars(spark):
    r = spark.range(1).select(
        expr.instant_from_micros(F.lit(-1)).alias("before"), expr.uuid_from_index(F.lit(255)).alias("u"), expr.positive_integer(F.lit("007")).alias("seven"), expr.positive_integer(F.lit("0")).alias("zero"), expr.positive_integer(F.lit("9223372036854775808")).alias("big"), expr.positive_integer(F.lit("x")).alias("x"),
        expr.checked_product(F.lit(2**62), F.lit(4)).alias("over"), expr.map_json(F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2"))).alias("j"), expr.has_nul(F.lit("a\0b")).alias("nul"),
    ).first()
    assert (r.before.seconds, r.before.nanos, r.u, r.seven, r.zero, r.big, r.x, r.over, r.j, r.nul) == (-1, 999_999_000, "00000000-0000-4000-8000-0000000000ff", 7, None, None, None, None, '{"a":"2","b":"1"}', True)


STATUS = ["GROUP TOPIC PARTITION CURRENT-OFFSET LOG-END-OFFSET LAG X", "g telemetry.raw 0 4 4 0 x", "g telemetry.raw 1 8 8 0 x", "g telemetry.raw 2 3 3 0 x"]


@pytest.mark.parametrize(
    ("lines", "want"),
    [
        (STATUS, (15, 15, 0, 3, True)), ([*STATUS[:3], "g telemetry.raw 2 - 0 - x"], (12, 12, 0, 3, True)), (STATUS[1:], (15, 15, 0, 3, False)), (STATUS[:3], (12, 12, 0, 2, False)), ([*STATUS, STATUS[1]], (19, 19, 0, 4, False)), ([*STATUS[:3], "g telemetry.raw 2 2 3 1 x"], (14, 15, 1, 3, False)), ([*STATUS[:3], "h telemetry.raw 2 3 3 0 x"], (15, 15, 0, 3, False)),
    ],
)
def test_group_status(spark, lines, want):
    assert tuple(reconcile.group_status(spark.createDataFrame([(x,) for x in lines], "line string"), "telemetry.raw", 3, "g").first()) == want


def test_lag_bases(spark):
    rows = [("offset", 12, 12), ("offset", 2, 4), ("offset", 23, 4), ("beginning", None, 4), ("end", None, 20), ("invalid", None, 4), ("stored", None, None)]
    df = spark.createDataFrame(rows, "kind string, value long, want long")
    assert all(r.got == r.want for r in df.select(reconcile.offset_base(F.col("kind"), F.col("value"), F.lit(4), F.lit(20)).alias("got"), "want").collect())


def test_502_records_make_a_batch_of_500_and_commit_the_highest_offsets(spark):
    # one reader of two partitions, whose offsets are the arrival's numbers
    df = spark.range(502).select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("offset"), F.lit(0).cast("long").alias("clock_us"))
    b = reconcile.timed_batches(df, 500, 10_000, by=("topic",))
    sizes = {r.batch: r["count"] for r in b.groupBy("batch").count().collect()}
    commits = {(r.batch, r.partition): r.next_offset for r in b.groupBy("batch", "partition").agg((F.max("offset") + 1).alias("next_offset")).collect()}
    assert sizes == {0: 500, 1: 2} and commits == {(0, 0): 499, (0, 1): 500, (1, 0): 501, (1, 1): 502}


def test_a_deadline_ends_a_batch(spark):
    df = spark.createDataFrame([("t", 0, o, t) for o, t in enumerate((0, 9_999, 10_000, 15_000, 19_999, 20_000, 60_000))], "topic string, partition int, offset long, clock_us long")
    got = [r.batch for r in reconcile.timed_batches(df, 500, 10_000).orderBy("offset").collect()]
    assert got == [0, 0, 1, 1, 1, 2, 3]
    assert [r.batch for r in reconcile.timed_batches(df, 2, 10_000).orderBy("offset").collect()] == [0, 0, 1, 1, 2, 2, 3]


def test_quoted_attribute_keys(spark):
    from driftwell.operators.validate import event_failure

    event = lambda key: F.struct(F.lit("550e8400-e29b-41d4-a716-446655440000").alias("event_id"), F.struct(F.lit(0).cast("long").alias("seconds"), F.lit(0).alias("nanos")).alias("event_time"), F.lit("s").alias("service_name"), F.lit("/r").alias("route"), F.create_map(F.lit(key), F.repeat(F.lit("v"), 257)).alias("attributes"))
    got = spark.range(1).select(event_failure(event('a"\\\n\t'), F.lit(3), F.lit(0)).alias("r")).first().r
    assert got == 'events[3].attributes value for key "a\\"\\\\\\n\\t" must be at most 256 bytes'


@pytest.mark.parametrize("gap", [False, True])
def test_batches_and_gaps(spark, gap):
    df = spark.range(2500).select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), F.floor(F.col("id") / 2).alias("offset"))
    df = df.where("NOT (partition = 1 AND offset IN (7, 999))") if gap else df
    got = {(r.partition, r.batch): r["count"] for r in reconcile.batches(df).groupBy("partition", "batch").count().collect()}
    assert got == {(0, 0): 500, (0, 1): 500, (0, 2): 250, (1, 0): 500, (1, 1): 500, (1, 2): 248 if gap else 250}
    gaps = {(r.partition, r.expected, r.offset) for r in reconcile.offset_gaps(df, 100).collect()}
    assert gaps == ({(1, 7, 8), (1, 999, 1000)} if gap else set())
