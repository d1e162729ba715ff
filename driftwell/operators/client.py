"""The client's side: which events it accepts, what it puts on the wire, and what a flush reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import instant_from_micros, uuid_from_index, valid_instant


def outcome(event_us: Column, room: Column, closed: Column) -> Column:
    """An emit's outcome: the time is judged first, then whether the client is closed, then the queue's room."""
    return F.when(~valid_instant(instant_from_micros(event_us)), "invalid").when(closed, "dropped_closed").when(~room, "dropped_full").otherwise("queued")


def wire_events(emits: DataFrame) -> DataFrame:
    """Adds outcome and, for queued events alone, event (the wire form): a fresh identifier from `n`, the time floored to seconds and
    nanos, and an empty trace where there is none. emits: n, event_us, service_name, route, latency_us, status_code, trace_id, attributes, room, closed."""
    out = emits.withColumn("outcome", outcome(F.col("event_us"), F.col("room"), F.col("closed")))
    event = F.struct(
        uuid_from_index("n").alias("event_id"), instant_from_micros("event_us").alias("event_time"), "service_name", "route", F.col("latency_us").cast("decimal(20,0)").alias("latency_us"),
        "status_code", F.coalesce("trace_id", F.lit("")).alias("trace_id"), "attributes",
    )
    return out.withColumn("event", F.when(F.col("outcome") == "queued", event))


def flush_results(exports: DataFrame, flushes: DataFrame) -> DataFrame:
    """The flushes (client, seq) with `failure`: the client's first permanent export failure before it (null: all went well), which stays
    forever. exports: client, seq, failure (null: delivered). One aggregation per client instead of a window over its history."""
    first = exports.where("failure IS NOT NULL").groupBy("client").agg(F.min(F.struct("seq", "failure")).alias("_first"))
    out = flushes.join(first, "client", "left")
    return out.select("client", "seq", F.when(F.col("_first.seq") < F.col("seq"), F.col("_first.failure")).alias("failure"))
