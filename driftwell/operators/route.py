"""Routing: one output per record, dead-letter envelopes, delivery outcomes and error classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codec
from ..functions.expr import is_uuid, valid_instant
from ..schemas import STAGE_PROCESSOR
from .validate import enriched_failure, raw_failure


def judge_raw(records: DataFrame) -> DataFrame:
    """Raw records (key, value, topic, partition, offset) with `event` and `failure` (null: valid)."""
    out = records.withColumn("_d", codec.decode_event(F.coalesce("value", F.lit(b"")))).withColumn("event", F.col("_d.event"))
    broken = F.struct(F.lit("decode").alias("category"), F.concat(F.lit("invalid protobuf: "), F.col("_d.error")).alias("reason"))
    return out.withColumn("failure", F.when(~F.col("_d.ok"), broken).otherwise(raw_failure(F.col("event"), F.coalesce(F.col("key"), F.lit(b""))))).drop("_d")


RETRY_CLOCK = "processing timestamp is invalid"


def processing_outcome(wall_time: Column, failure: Column) -> Column:
    """retry, dlq or enriched: an invalid processing clock is judged before the record and is nobody's fault but ours, so nothing is dead."""
    return F.when(~valid_instant(wall_time), "retry").when(failure.isNotNull(), "dlq").otherwise("enriched")


def record_line(kind: Column, fields: dict[str, Column]) -> Column:
    """A record as one JSON line, keys in order; fields that are null are left out."""
    return F.to_json(F.struct(*(v.alias(k) for k, v in sorted({"kind": kind, **fields}.items()))))


def raw_lines(records: DataFrame) -> DataFrame:
    """topic, partition, offset, line of raw records: the event's identifiers, or the bytes in hexadecimal if it can't be decoded."""
    d = records.withColumn("_d", codec.decode_event(F.coalesce("value", F.lit(b""))))
    ok, event = F.col("_d.ok"), F.col("_d.event")
    bad = lambda c: F.when(~ok, codec.hex_dump(F.col(c)))
    fields = {"topic": F.col("topic"), "partition": F.col("partition"), "offset": F.col("offset"), "event_id": event["event_id"], "trace_id": event["trace_id"], "key_hex": bad("key"), "payload_hex": bad("value")}
    return d.select("topic", "partition", "offset", record_line(F.when(ok, "valid").otherwise("malformed"), fields).alias("line"))


def letter_lines(letters: DataFrame, topic: str = "telemetry.dlq") -> DataFrame:
    """source_topic, source_partition, source_offset, line of dead letters (partition, offset and the envelope's columns)."""
    names = ("partition", "offset", "stage", "source_topic", "source_partition", "source_offset", "error_category", "reason", "event_id")
    fields = {**{n: F.col(n) for n in names}, "topic": F.lit(topic), "original_payload_hex": codec.hex_dump(F.col("original_payload"))}
    return letters.select("source_topic", "source_partition", "source_offset", record_line(F.lit("dlq"), fields).alias("line"))


def judge_enriched(records: DataFrame) -> DataFrame:
    """Enriched records with `enriched` and `failure`; metadata that no log can have stops the job instead."""
    sound = F.assert_true((F.col("partition") >= 0) & (F.col("offset") >= 0) & (F.col("topic") != "") & ~F.contains("topic", F.char(F.lit(0))), F.lit("source record metadata is invalid"))
    out = records.where(sound.isNull()).withColumn("_d", codec.decode_enriched(F.coalesce("value", F.lit(b"")))).withColumn("enriched", F.col("_d.enriched"))
    broken = F.struct(F.lit("decode").alias("category"), F.lit("invalid enriched protobuf payload").alias("reason"))
    return out.withColumn("failure", F.when(~F.col("_d.ok"), broken).otherwise(enriched_failure(F.col("enriched")))).drop("_d")


def dead_letters(judged: DataFrame, stage: int, failed_at: Column) -> DataFrame:
    """The envelopes of the failed rows: original bytes, lineage, verdict; the identifier only where it is one."""
    own = F.col("event.event_id") if stage == STAGE_PROCESSOR else F.lower(F.col("enriched.event.event_id"))
    kept = F.when(is_uuid(own) & (F.col("failure.category") != "decode"), own).otherwise("")
    return judged.where("failure IS NOT NULL").select(
        F.coalesce("value", F.lit(b"")).alias("original_payload"), F.lit(stage).alias("stage"), F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"),
        F.col("failure.category").alias("error_category"), F.col("failure.reason").alias("reason"), failed_at.alias("failed_at"), kept.alias("event_id"),
    )


def validated_rows(judged: DataFrame) -> DataFrame:
    """The valid enriched rows in the events table's columns."""
    from ..functions.expr import map_json, timestamp_from_instant

    e = "enriched.event."
    return judged.where("failure IS NULL").select(
        F.lower(F.col(e + "event_id")).alias("event_id"), timestamp_from_instant(F.col(e + "event_time")).alias("event_time"), F.col(e + "service_name").alias("service_name"), F.col(e + "route").alias("route"),
        F.col(e + "latency_us").cast("long").alias("latency_us"), F.col(e + "status_code").cast("int").alias("status_code"), F.col(e + "trace_id").alias("trace_id"), map_json(F.col(e + "attributes")).alias("attributes"),
        F.col("enriched.ewma_mean_us").alias("ewma_mean_us"), F.col("enriched.ewma_stddev_us").alias("ewma_stddev_us"), F.col("enriched.anomaly_score").alias("anomaly_score"), F.col("enriched.is_anomaly").alias("is_anomaly"),
        timestamp_from_instant(F.col("enriched.processed_at")).alias("processed_at"), "partition", "offset",
    )


# Delivery failures by priority, and the status each gives.
DELIVERY_PRIORITY = {"record_too_large": 3, "permanent": 2}
STATUS = {
    "empty_batch": ("Internal", "publisher received an empty batch"),
    "buffer_full": ("ResourceExhausted", "Kafka producer buffer is full"),
    "record_too_large": ("InvalidArgument", "telemetry record exceeds Kafka's size limit"),
    "permanent": ("FailedPrecondition", "Kafka permanently rejected the telemetry batch"),
    "canceled": ("Canceled", "context canceled"),
    "deadline": ("DeadlineExceeded", "context deadline exceeded"),
}
RETRYABLE_STATUS = ("Aborted", "Cancelled", "DeadlineExceeded", "Internal", "ResourceExhausted", "Unavailable", "Unknown")
RETRYABLE_SQLSTATES = ("40001", "40P01", "57P01", "57P02", "57P03")


def delivery_priority(error: Column) -> Column:
    out = F.lit(1)
    for name, rank in DELIVERY_PRIORITY.items():
        out = F.when(error == name, rank).otherwise(out)
    return out


def batch_outcomes(deliveries: DataFrame) -> DataFrame:
    """batch_id, error: the strongest failure among a batch's deliveries (batch_id, index, error; null: delivered), null if all are delivered."""
    rank = F.when(F.col("error").isNotNull(), F.struct(delivery_priority(F.col("error")).alias("p"), (-F.col("index")).alias("i")))
    return deliveries.groupBy("batch_id").agg(F.max_by("error", rank).alias("error"))


def status_of(reason: Column, context: Column, error: Column) -> Column:
    """struct(code, message): validation comes first, then the request's own context, then the publisher's error."""
    pair = lambda code, message: F.struct(F.lit(code).alias("code"), (message if isinstance(message, Column) else F.lit(message)).alias("message"))
    out = F.when(reason.isNotNull(), pair("InvalidArgument", reason))
    for name in ("canceled", "deadline"):
        out = out.when(context == name, pair(*STATUS[name]))
    for name, (code, message) in STATUS.items():
        out = out.when(error == name, pair(code, message))
    return out.when(error.isNotNull(), pair("Unavailable", "publishing telemetry batch")).otherwise(pair("OK", ""))


def retryable_status(code: Column) -> Column:
    return F.coalesce(code.isin(*RETRYABLE_STATUS), F.lit(False))


def retryable_sqlstate(code: Column) -> Column:
    return F.coalesce(code.startswith("08") | code.startswith("53") | code.isin(*RETRYABLE_SQLSTATES), F.lit(False))
