"""Labelled replay: checks of the labels, detection matching, false positives and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import table

DEADLINE_MS = 5000
LABEL_MS = 1000
MIN_EVENTS, MIN_WINDOWS = 100_000, 25
#: Windows beyond this number are joined by shuffle instead of broadcast.
BROADCAST_WINDOWS = 100_000
_KEY = ["service_name", "route"]


def _small(windows: DataFrame) -> DataFrame:
    return F.broadcast(windows) if windows.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else windows


def event_problems(events: DataFrame) -> DataFrame:
    """Adjacent events (by seq) whose times don't increase strictly, found per time slice: no global window."""
    slices = events.withColumn("slice", F.floor(F.col("seq") / 100_000))
    w = W.partitionBy("slice").orderBy("seq")
    inside = slices.withColumn("before", F.lag("event_time_ms").over(w)).where("before >= event_time_ms").select("seq", F.lit("event times must increase").alias("problem"))
    ends = slices.groupBy("slice").agg(F.min_by("event_time_ms", "seq").alias("first"), F.max_by("event_time_ms", "seq").alias("last"), F.min("seq").alias("seq"))
    after = ends.select((F.col("slice") + 1).alias("slice"), F.col("last").alias("before"))
    between = ends.join(after, "slice").where("before >= first").select("seq", F.lit("event times must increase").alias("problem"))
    return inside.unionByName(between)


def window_problems(events: DataFrame, windows: DataFrame) -> DataFrame:
    """service_name, route, injected_at_ms, problem for every broken rule of the labels."""
    c = F.col
    key = [*_KEY, "injected_at_ms"]
    own = windows.select(*key, F.explode(F.filter(F.array(
        F.when(c("window_end_ms") < c("injected_at_ms"), "end precedes injection"),
        F.when(c("window_end_ms") - c("injected_at_ms") > LABEL_MS, "span exceeds one second"),
    ), lambda x: x.isNotNull())).alias("problem"))
    twice = windows.groupBy(*key).count().where("count > 1").select(*key, F.lit("identity must be unique").alias("problem"))
    wide = _small(windows.select(*key).distinct())
    there = events.join(wide, [events.service_name == wide.service_name, events.route == wide.route, events.event_time_ms == wide.injected_at_ms]).select(wide.service_name, wide.route, wide.injected_at_ms)
    lost = windows.select(*key).distinct().join(there.distinct(), key, "left_anti").withColumn("problem", F.lit("no event at injection"))
    w = W.partitionBy(*_KEY).orderBy("injected_at_ms")
    pairs = windows.withColumn("next", F.lead("injected_at_ms").over(w))
    over = pairs.where(c("next") <= c("window_end_ms")).select(*key, F.lit("label spans overlap").alias("problem"))
    near = pairs.where(c("next") <= c("injected_at_ms") + DEADLINE_MS).select(*key, F.lit("detection intervals overlap").alias("problem"))
    return own.unionByName(twice).unionByName(lost).unionByName(over).unionByName(near)


def detections(verdicts: DataFrame, windows: DataFrame) -> DataFrame:
    """The windows with detected_at_ms and detection_latency_ms: the earliest verdict (by seq) from injection to the deadline.

    Valid labels keep same-key detection intervals apart, so no verdict can serve two windows.
    """
    # equi-joins on key and time bucket, so that a verdict meets the windows of its time only
    bucket = lambda t: F.floor(t / DEADLINE_MS)
    v = verdicts.select(*_KEY, F.col("event_time_ms").alias("_t"), F.col("seq").alias("_seq"), bucket(F.col("event_time_ms")).alias("_b"))
    spread = windows.withColumn("_b", F.explode(F.sequence(bucket(F.col("injected_at_ms")), bucket(F.col("injected_at_ms") + DEADLINE_MS))))
    hit = v.join(_small(spread), [*_KEY, "_b"]).where((F.col("_t") >= F.col("injected_at_ms")) & (F.col("_t") <= F.col("injected_at_ms") + DEADLINE_MS))
    first = hit.groupBy(*_KEY, "injected_at_ms").agg(F.min_by("_t", "_seq").alias("detected_at_ms"), F.min("_seq").alias("verdict_seq"))
    out = windows.join(first, [*_KEY, "injected_at_ms"], "left")
    return out.withColumn("detection_latency_ms", F.col("detected_at_ms") - F.col("injected_at_ms"))


def false_positives(verdicts: DataFrame, windows: DataFrame, found: DataFrame) -> DataFrame:
    """Verdicts outside every label of their key that no window counts as its detection."""
    bucket = lambda t: F.floor(t / DEADLINE_MS)
    w = windows.select(F.col("service_name").alias("_s"), F.col("route").alias("_r"), "injected_at_ms", "window_end_ms", F.explode(F.sequence(bucket(F.col("injected_at_ms")), bucket(F.col("window_end_ms")))).alias("_b"))
    w = _small(w)
    inside = (F.col("service_name") == F.col("_s")) & (F.col("route") == F.col("_r")) & (bucket(F.col("event_time_ms")) == F.col("_b")) & F.col("event_time_ms").between(F.col("injected_at_ms"), F.col("window_end_ms"))
    used = _small(found.where("verdict_seq IS NOT NULL").select(F.col("verdict_seq").alias("seq")))
    return verdicts.join(w, inside, "left_anti").join(used, "seq", "left_anti")


def report(events: DataFrame, found: DataFrame, false: DataFrame) -> DataFrame:
    """One row: event_count, anomaly_window_count, missed_windows, max_detection_latency_ms, false_positive_count, passed."""
    n = events.agg(F.count("*").alias("event_count"))
    w = found.agg(F.count("*").alias("anomaly_window_count"), F.count_if(F.col("detected_at_ms").isNull()).alias("missed_windows"), F.max("detection_latency_ms").alias("max_detection_latency_ms"))
    out = n.join(w).join(false.agg(F.count("*").alias("false_positive_count")))  # three single rows
    ok = (F.col("event_count") >= MIN_EVENTS) & (F.col("anomaly_window_count") >= MIN_WINDOWS) & (F.col("missed_windows") == 0) & F.coalesce(F.col("max_detection_latency_ms") <= DEADLINE_MS, F.lit(False))
    return out.withColumn("passed", ok)


def evaluate(events: DataFrame, windows: DataFrame, config=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report, window results, false positives) of a manifest: events (seq, event_time_ms, service_name, route, latency_us), windows.

    Raises ValueError for labels or event times that break a rule.
    """
    from ..config import DetectorConfig, StateConfig
    from .detector import score

    wrong = event_problems(events).select("problem").unionByName(window_problems(events, windows).select("problem")).limit(5).collect()
    if wrong:
        raise ValueError("invalid manifest: " + "; ".join(sorted({r.problem for r in wrong})))
    scored = score(events, clock="event_time_ms", tie=("seq",), config=config or DetectorConfig(), ttl=StateConfig().ttl_ms)
    verdicts = scored.where("is_anomaly").select("seq", "event_time_ms", *_KEY, "latency_us", F.col("anomaly_score").alias("score"))
    verdicts = table(verdicts, "verdicts")
    found = detections(verdicts, windows)
    false = false_positives(verdicts, windows, found)
    return report(events, found, false), found, false
