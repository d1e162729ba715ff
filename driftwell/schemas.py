"""Declared schemas, limits and topic names. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_TOPIC, ENRICHED_TOPIC, DLQ_TOPIC = "telemetry.raw", "telemetry.enriched", "telemetry.dlq"
#: Valid events that could not be scored yet (out of time, out of range): neither enriched nor dead, kept to be sent again.
DEFERRED_TOPIC = "telemetry.deferred"
PARTITIONS = {RAW_TOPIC: 3, ENRICHED_TOPIC: 3, DLQ_TOPIC: 1, DEFERRED_TOPIC: 3}

MAX_BATCH_EVENTS = 500
MAX_ROUTE_BYTES = 256
MAX_ATTRIBUTES = 16
MAX_KEY_BYTES = 64
MAX_VALUE_BYTES = 256
MIN_SECONDS, MAX_SECONDS = -62_135_596_800, 253_402_300_799
STAGE_PROCESSOR, STAGE_SINK = 1, 2

INSTANT = T.StructType.fromJson({"type": "struct", "fields": [{"name": "seconds", "type": "long", "nullable": True, "metadata": {}}, {"name": "nanos", "type": "integer", "nullable": True, "metadata": {}}]})


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EVENT = _struct(
    ("event_id", T.StringType()), ("event_time", INSTANT), ("service_name", T.StringType()), ("route", T.StringType()), ("latency_us", T.DecimalType(20, 0)),
    ("status_code", T.LongType()), ("trace_id", T.StringType()), ("attributes", T.MapType(T.StringType(), T.StringType())),
)
ENRICHED = _struct(("event", EVENT), ("ewma_mean_us", T.DoubleType()), ("ewma_stddev_us", T.DoubleType()), ("anomaly_score", T.DoubleType()), ("is_anomaly", T.BooleanType()), ("processed_at", INSTANT))
#: An export request.
BATCH = _struct(("batch_id", T.StringType()), ("events", T.ArrayType(EVENT)))
DEAD_LETTER = _struct(
    ("original_payload", T.BinaryType()), ("stage", T.IntegerType()), ("source_topic", T.StringType()), ("source_partition", T.IntegerType()), ("source_offset", T.LongType()),
    ("error_category", T.StringType()), ("reason", T.StringType()), ("failed_at", INSTANT), ("event_id", T.StringType()),
)
#: The columns of a topic, as Spark's Kafka source has them.
LOG = _struct(("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()), ("timestamp", T.TimestampType()))
RECEIPTS = T.StructType([T.StructField("event_id", T.StringType(), False), T.StructField("first_seen_at", T.TimestampType(), False)])
EVENTS_TABLE = T.StructType(
    [
        T.StructField(n, t, False)
        for n, t in (
            ("event_id", T.StringType()), ("event_time", T.TimestampType()), ("service_name", T.StringType()), ("route", T.StringType()), ("latency_us", T.LongType()), ("status_code", T.IntegerType()), ("trace_id", T.StringType()),
            ("attributes", T.StringType()), ("ewma_mean_us", T.DoubleType()), ("ewma_stddev_us", T.DoubleType()), ("anomaly_score", T.DoubleType()), ("is_anomaly", T.BooleanType()), ("processed_at", T.TimestampType()),
        )
    ]
)


def schema_gaps(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Expected columns (column_name, data_type) that df lacks or has with another type."""
    spark = df.sparkSession
    want = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in expected], "column_name string, data_type string")
    have = spark.createDataFrame(df.dtypes, "column_name string, data_type string")
    return want.join(have, ["column_name", "data_type"], "left_anti")


def assert_schema(df: DataFrame, expected: T.StructType) -> None:
    have = dict(df.dtypes)
    wrong = [f"{f.name}: {have.get(f.name)} instead of {f.dataType.simpleString()}" for f in expected if have.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise ValueError("unexpected schema: " + "; ".join(wrong))
