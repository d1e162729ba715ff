"""The `events` table as telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import hex_id, uuid_from_index


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def route_of(coarse: bool) -> Column:
    return F.lit("/v1/all") if coarse else F.concat(F.lit("/v1/route-"), (F.col("user_id") % 8).cast("string"))


def telemetry(events: DataFrame, coarse: bool = False) -> DataFrame:
    """id, event_id, clock (ms), event_us, service_name, route, latency_us, status_code, trace_id, attributes, partition."""
    n = F.col("event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    partition = F.length("event_type") % 3 if coarse else (F.col("user_id") % 8 + F.length("event_type")) % 3
    return events.select(
        n.alias("id"), uuid_from_index(n).alias("event_id"), F.floor(us / 1000).alias("clock"), us.alias("event_us"), F.concat(F.lit("svc-"), F.col("event_type")).alias("service_name"), route_of(coarse).alias("route"),
        F.round(F.col("value") * 1000).cast("long").alias("latency_us"), F.when(F.col("event_type") == "error", 500).otherwise(200).cast("long").alias("status_code"), hex_id("demo-", n, 16).alias("trace_id"),
        F.from_json("props", "map<string,string>").alias("attributes"), partition.cast("int").alias("partition"),
    )


def with_offsets(t: DataFrame) -> DataFrame:
    """Adds topic and offset: the row's number inside its log partition by time."""
    from ..operators.reconcile import numbered

    out = numbered(t, ["event_us", "id"], F.floor(F.col("event_us") / 3_600_000_000), ["partition"], "offset")
    return out.withColumn("topic", F.lit("telemetry.raw"))
