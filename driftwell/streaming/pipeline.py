"""Structured Streaming jobs: score the raw log, persist the enriched log.

score: raw log -> decode -> validate -> (valid rows) keyed baselines -> enriched log | deferred log | dead letters. Invalid rows bypass the
stateful operator; valid rows that can't be scored are deferred instead of failing the job for good. Outputs are named by batch id and published by rename, so a replayed batch repeats itself without effect;
offsets, state and outputs commit in Spark's checkpoint in that order.
persist: enriched log -> decode -> validate -> events store -> dead letters; the store commits before the dead letters and
offsets, and replays are absorbed by receipts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DetectorConfig, RetryConfig, StateConfig
from ..functions import codec
from ..functions.expr import instant_from_micros, partition_key
from ..operators.detector import STREAMED, packed, stream_processor, unpacked
from ..operators.retry import with_retry
from ..operators.route import dead_letters, judge_enriched, judge_raw, validated_rows
from ..schemas import DEFERRED_TOPIC, DLQ_TOPIC, ENRICHED_TOPIC, RAW_TOPIC, STAGE_PROCESSOR, STAGE_SINK
from ..sources.filelog import FileLog
from ..sources.store import EventStore

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIELDS = "service_name string, route string, clock long, partition int, offset long, event_id string, event binary, latency_us double"
#: Shards of keys; each holds at most max_keys baselines and has one time, like one consumer of the raw log.
SHARDS = 16


def wall_clock() -> Column:
    """One processing time per micro-batch."""
    return instant_from_micros(F.unix_micros(F.current_timestamp()))


def scored_stream(judged: DataFrame, clock: Column, detector: DetectorConfig, state: StateConfig | None, shards: int = SHARDS, epoch: int = 0) -> DataFrame:
    """The valid rows of a judged stream with their verdicts, or an error and none; state is kept by shard of service and route."""
    valid = judged.where("failure IS NULL").select(F.col("event.service_name").alias("service_name"), F.col("event.route").alias("route"), clock.cast("long").alias("clock"), "partition", "offset", F.col("event.event_id").alias("event_id"), codec.encode_event(F.col("event")).alias("event"), F.col("event.latency_us").cast("double").alias("latency_us"))
    fields = [f.split()[0] for f in FIELDS.split(", ")]
    processor = stream_processor(detector, state.ttl_ms if state else None, state.max_keys if state else None, "latency_us", "clock", ["service_name", "route"], ["partition", "offset"], fields, epoch)
    pieces = packed(valid, F.pmod(F.xxhash64("service_name", "route"), F.lit(shards)))
    scored = pieces.groupBy("shard").transformWithStateInPandas(processor, "rows binary", "append", "none")
    spread = int(judged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return unpacked(scored.repartition(spread), f"{FIELDS}, {STREAMED}")  # a few hot shards are a few tasks, which only score


def enriched_records(scored: DataFrame, processed_at: Column) -> DataFrame:
    """key, value of the enriched log from scored rows (event as bytes, which are put into the record as they are)."""
    value = F.struct("event", "ewma_mean_us", "ewma_stddev_us", "anomaly_score", "is_anomaly", processed_at.alias("processed_at"))
    return scored.select(partition_key("service_name", "route").cast("binary").alias("key"), codec.encode_around(value).alias("value"), F.col("offset").alias("source_offset"))


def score_query(log: FileLog, checkpoint: str, clock: Column | None = None, detector: DetectorConfig = DetectorConfig(), state: StateConfig | None = StateConfig(), max_records: int | None = None, shards: int = SHARDS, epoch: int = 0):
    """Start the scoring job on what the raw log holds; ends when it is caught up. `clock`: milliseconds, arrival time by default.

    Rows that can't be scored (their time is before their shard's, say) go to the deferred log with their key, and the job goes on. A job that is
    started with another `epoch` forgets all baselines.
    """
    log.spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    judged = judge_raw(log.read_stream(RAW_TOPIC, max_records))
    scored = scored_stream(judged, clock if clock is not None else F.unix_millis("timestamp"), detector, state, shards, epoch)

    def publish(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            log.append(enriched_records(batch.where("error IS NULL"), wall_clock()), ENRICHED_TOPIC, f"score-{number:010d}", ["source_offset"])
            late = batch.where("error IS NOT NULL")
            if not late.isEmpty():
                log.append(late.select(partition_key("service_name", "route").cast("binary").alias("key"), F.col("event").alias("value"), F.col("offset").alias("source_offset")), DEFERRED_TOPIC, f"score-{number:010d}", ["source_offset"])
        finally:
            batch.unpersist()

    return scored.writeStream.foreachBatch(publish).option("checkpointLocation", f"{checkpoint}/score").trigger(availableNow=True).start()


def dead_letter_query(log: FileLog, checkpoint: str, max_records: int | None = None):
    """Start the job that routes what the raw rules reject; stateless, so it never waits for the scoring job."""

    def publish(batch: DataFrame, number: int) -> None:
        letters = dead_letters(judge_raw(batch), STAGE_PROCESSOR, wall_clock())
        log.append(_letters(letters), DLQ_TOPIC, f"raw-{number:010d}", ["value"])

    return log.read_stream(RAW_TOPIC, max_records).writeStream.foreachBatch(publish).option("checkpointLocation", f"{checkpoint}/raw-dlq").trigger(availableNow=True).start()


def persist_query(log: FileLog, store: EventStore, checkpoint: str, retry: RetryConfig = RetryConfig(), max_records: int | None = None, failpoint=None):
    """Start the sink job; ends when it is caught up."""

    def publish(batch: DataFrame, number: int) -> None:
        judged = judge_enriched(batch).persist()
        try:
            with_retry(lambda: store.persist(validated_rows(judged), number, failpoint=failpoint), retry)
            if not judged.where("failure IS NOT NULL").isEmpty():
                log.append(_letters(dead_letters(judged, STAGE_SINK, wall_clock())), DLQ_TOPIC, f"sink-{number:010d}", ["value"])
        finally:
            judged.unpersist()

    return log.read_stream(ENRICHED_TOPIC, max_records).writeStream.foreachBatch(publish).option("checkpointLocation", f"{checkpoint}/persist").trigger(availableNow=True).start()


def _letters(letters: DataFrame) -> DataFrame:
    return letters.select(F.lit(b"").alias("key"), codec.encode_dead_letter(F.struct(*letters.columns)).alias("value"))
