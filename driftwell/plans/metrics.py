"""Dashboards: counters and rates, gauges, cumulative histograms and quantiles read off them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Bucket bounds.
BATCH_SIZE = (1.0, 10.0, 50.0, 100.0, 250.0, 500.0)
DEFAULT = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def exponential(start: float, factor: float, count: int) -> tuple[float, ...]:
    return tuple(start * factor**i for i in range(count))


SINK_BATCH_SIZE, SINK_DURATION = exponential(1, 2, 10), exponential(0.001, 2, 16)


def histogram(df: DataFrame, value: Column, bounds: tuple[float, ...], by: list[str] | None = None) -> DataFrame:
    """by, le, count: cumulative counts per upper bound and for +Inf. One pass with one counter a bound, unpivoted after."""
    by = by or []
    les = [*bounds, float("inf")]
    per = df.groupBy(*by).agg(*(F.count_if(value <= b if b != float("inf") else value.isNotNull()).alias(f"_{i}") for i, b in enumerate(les)))
    pairs = F.array(*(F.struct(F.lit(float(b)).alias("le"), F.col(f"_{i}").alias("count")) for i, b in enumerate(les)))
    return per.select(*by, F.explode(pairs).alias("_b")).select(*by, "_b.le", "_b.count")


def histogram_quantile(q: float, buckets: DataFrame, by: list[str] | None = None, count: str = "count") -> DataFrame:
    """by, value: the quantile by linear interpolation inside the first bucket that reaches it; in the +Inf bucket the highest finite bound."""
    by = by or []
    w = W.partitionBy(*by).orderBy("le") if by else W.partitionBy(F.lit(0)).orderBy("le")
    whole = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    c = F.col(count)
    b = buckets.withColumn("below", F.coalesce(F.lag(c).over(w), F.lit(0))).withColumn("low", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
    b = b.withColumn("rank", F.max(c).over(whole) * q)
    hit = b.where(c >= F.col("rank")).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    inside = F.col("low") + (F.col("le") - F.col("low")) * (F.col("rank") - F.col("below")) / F.when(c > F.col("below"), c - F.col("below"))
    return hit.select(*by, F.when(F.col("le") == float("inf"), F.col("low")).otherwise(F.coalesce(inside, F.col("low"))).alias("value"))


def event_rate(df: DataFrame, ts: Column, window_s: int = 60, by: list[str] | None = None) -> DataFrame:
    """window_start (epoch seconds), events, rate: events a second in tumbling windows."""
    start = (F.floor(F.unix_micros(ts) / (window_s * 1_000_000)) * window_s).alias("window_start")
    return df.groupBy(*(by or []), start).agg(F.count("*").alias("events")).withColumn("rate", F.col("events") / float(window_s))


def counter_rate(samples: DataFrame, window_s: int = 60, by: list[str] | None = None) -> DataFrame:
    """Adds rate at each sample (ts seconds, value): growth over the samples of the window before, resets counted, a second.

    The growth is divided by the time between the window's first and last sample; it isn't extrapolated to the window's edges.
    """
    by = by or []
    w = W.partitionBy(*by).orderBy("ts") if by else W.partitionBy(F.lit(0)).orderBy("ts")
    span = w.rangeBetween(-window_s, 0)
    grown = F.col("value") - F.coalesce(F.when(F.lag("value").over(w) <= F.col("value"), F.lag("value").over(w)), F.lit(0))
    s = samples.withColumn("_g", F.when(F.lag("value").over(w).isNull(), 0).otherwise(grown))
    s = s.withColumn("_total", F.sum("_g").over(w))
    first = F.first("_total").over(span)
    dt = F.col("ts") - F.first("ts").over(span)
    return s.withColumn("rate", F.when(dt > 0, (F.col("_total") - first) / dt)).drop("_g", "_total")


def extrapolated_rate(samples: DataFrame, window_s: int, by: list[str]) -> DataFrame:
    """Adds rate at each sample (ts seconds, value): a counter's growth a second over the window that ends there, as dashboards have it.

    Resets count; the growth between the window's first and last sample is extrapolated to the window's start: by half the mean distance of
    samples if the first one is further from it than 1.1 of that, and never beyond where the counter would have been 0.
    """
    w = W.partitionBy(*by).orderBy("ts")
    before = F.lag("value").over(w)
    grown = F.when(before.isNull(), 0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    s = samples.withColumn("_g", grown).withColumn("_total", F.sum("_g").over(w))
    span = w.rangeBetween(1 - window_s, 0)
    s = s.withColumns({"_n": F.count("*").over(span), "_t0": F.first("ts").over(span), "_v0": F.first("value").over(span), "_up": F.col("_total") - F.first("_total").over(span)})
    taken, start = F.col("ts") - F.col("_t0"), (F.col("_t0") - (F.col("ts") - window_s)).cast("double")
    mean = taken / (F.col("_n") - 1)
    start = F.when(start >= mean * 1.1, mean / 2).otherwise(start)
    zero = taken * F.col("_v0") / F.col("_up")
    start = F.when((F.col("_up") > 0) & (F.col("_v0") >= 0) & (zero < start), zero).otherwise(start)
    rate = F.when(F.col("_n") > 1, F.col("_up") * ((taken + start) / taken) / float(window_s))
    return s.withColumn("rate", rate).drop("_g", "_total", "_n", "_t0", "_v0", "_up")


def range_rate(samples: DataFrame, window_s: int, step_s: int, by: list[str], chunk_s: int | None = None) -> DataFrame:
    """by, ts, rate: a counter's growth a second over (ts - window_s, ts] at every aligned step ts = k * step_s, as a dashboard's range query has it.

    samples: by, ts (seconds), value. Steps with fewer than two samples in their window have no row. Resets count; growth is
    extrapolated to both edges of the window: by half the mean distance of samples where the edge is further than 1.1 of that, and at the start
    never beyond where the counter would have been 0.

    Samples are first reduced to slots (the largest ones that steps and windows consist of), so what is shuffled is slots, not samples. A
    slot's predecessor is looked up in chunks of time that overlap by one window, so no task sorts a whole series. Each slot then counts for the
    steps whose windows hold it.
    """
    slot_s = math.gcd(window_s, step_s)
    per, each = window_s // slot_s, step_s // slot_s
    chunk = max(per, (chunk_s or 64 * window_s) // slot_s)  # slots
    c = F.col
    rows = samples.select(*by, "ts", "value", F.ceil(c("ts") / slot_s).cast("long").alias("_slot"))  # a slot holds (its start, its end]
    slots = rows.groupBy(*by, "_slot").agg(F.array_sort(F.collect_list(F.struct("ts", "value"))).alias("_s"))
    drops = F.aggregate("_s", F.struct(F.lit(0.0).alias("sum"), c("_s")[0]["value"].cast("double").alias("last")), lambda acc, x: F.struct((acc["sum"] + F.when(x["value"] < acc["last"], acc["last"]).otherwise(0.0)).alias("sum"), x["value"].cast("double").alias("last")))
    slots = slots.select(*by, "_slot", F.size("_s").alias("_n"), c("_s")[0].alias("_first"), F.element_at("_s", -1).alias("_last"), drops["sum"].alias("_drops"))
    here = F.floor(c("_slot") / chunk)
    spread = slots.withColumn("_chunk", F.explode(F.when(F.floor((c("_slot") + per - 1) / chunk) > here, F.array(here, F.floor((c("_slot") + per - 1) / chunk))).otherwise(F.array(here))))
    w = W.partitionBy(*by, "_chunk").orderBy("_slot")
    seen = spread.withColumns({"_before": F.lag("_slot").over(w), "_fell": F.when(F.lag("_last").over(w)["value"] > c("_first")["value"], F.lag("_last").over(w)["value"].cast("double")).otherwise(0.0)})
    seen = seen.where(c("_chunk") == here)
    # the steps k with slot <= k * each < slot + per
    least, most = F.ceil(c("_slot") / each), F.floor((c("_slot") + per - 1) / each)
    at = seen.where(least <= most).withColumn("_k", F.explode(F.sequence(least, most)))
    within = c("_before") > c("_k") * each - per
    steps = at.groupBy(*by, "_k").agg(F.sum("_n").alias("_n"), F.min("_first").alias("_a"), F.max("_last").alias("_z"), F.sum(c("_drops") + F.when(within, c("_fell")).otherwise(0.0)).alias("_drops")).where("_n > 1")
    ts, a, z = c("_k") * step_s, c("_a")["value"].cast("double"), c("_z")["value"].cast("double")
    steps = steps.select(*by, ts.alias("ts"), (z - a + c("_drops")).alias("_up"), a.alias("_v0"), (c("_z")["ts"] - c("_a")["ts"]).cast("double").alias("_taken"), (c("_a")["ts"] - (ts - window_s)).cast("double").alias("_start"), (ts - c("_z")["ts"]).cast("double").alias("_end"), (c("_n") - 1).alias("_gaps")).where("_taken > 0")
    mean = c("_taken") / c("_gaps")
    start = F.when(c("_start") >= mean * 1.1, mean / 2).otherwise(c("_start"))
    zero = F.try_divide(c("_taken") * c("_v0"), c("_up"))
    start = F.when((c("_up") > 0) & (c("_v0") >= 0) & (zero < start), zero).otherwise(start)
    end = F.when(c("_end") >= mean * 1.1, mean / 2).otherwise(c("_end"))
    return steps.select(*by, "ts", (c("_up") * ((c("_taken") + start + end) / c("_taken")) / float(window_s)).alias("rate"))


def range_quantile(q: float, samples: DataFrame, window_s: int, step_s: int, series: list[str], by: list[str] | None = None) -> DataFrame:
    """by, ts, value: the quantile at every step of a histogram's growth, from scraped bucket counters (series with le among them, ts, value): the
    rate of each bucket's series, their sum by le, then the quantile. Steps in which nothing grew have no row."""
    by = by or []
    rates = range_rate(samples, window_s, step_s, series).groupBy(*by, "le", "ts").agg(F.sum("rate").alias("rate"))
    grown = rates.withColumn("_most", F.max("rate").over(W.partitionBy(*by, "ts"))).where("_most > 0").drop("_most")  # a row a bucket
    return histogram_quantile(q, grown, [*by, "ts"], "rate")


def scraped(increments: DataFrame, by: list[str], interval_s: int, restart_s: int | None = None, blocks: int | None = None) -> DataFrame:
    """by, ts, value: counters as scrapes every interval_s see them, from their increments (by, at: seconds, n), between the first
    and the last one of all series; a restart every restart_s sets them to 0.

    The running totals are a blocked scan: no task holds a series.
    """
    from ..operators.scan import running

    c = F.col
    slots = increments.groupBy(*by, (F.ceil(c("at") / interval_s) * interval_s).cast("long").alias("ts")).agg(F.sum("n").alias("n"))
    ends = slots.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).where("low IS NOT NULL")
    every = increments.select(*by).distinct().join(F.broadcast(ends))  # a single row
    every = every.select(*by, F.explode(F.sequence("low", "high", F.lit(interval_s).cast("long"))).alias("ts"))
    rows = every.join(slots, [*by, "ts"], "left").select(*by, "ts", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    epoch = F.floor(c("ts") / restart_s) if restart_s else F.lit(0)
    out = running(rows.withColumn("epoch", epoch), ["ts"], "sum", "n", "value", [*by, "epoch"], blocks, inclusive=True)
    return out.select(*by, "ts", "value")


def active_requests(requests: DataFrame, by: list[str], interval_s: int, blocks: int | None = None) -> DataFrame:
    """by, ts, value: how many requests (by, begin, finish: seconds; a null finish is open) are active at scrapes every interval_s: begun, not finished."""
    c = F.col
    steps = F.filter(F.array(F.struct(c("begin").alias("at"), F.lit(1).alias("n")), F.struct(F.when(c("finish").isNotNull(), F.greatest("finish", "begin")).alias("at"), F.lit(-1).alias("n"))), lambda s: s["at"].isNotNull())
    return scraped(requests.where("begin IS NOT NULL").select(*by, F.explode(steps).alias("s")).select(*by, "s.at", "s.n"), by, interval_s, blocks=blocks)


def windowed_quantile(q: float, df: DataFrame, value: Column, bounds: tuple[float, ...], ts: Column, window_s: int, by: list[str]) -> DataFrame:
    """by, window_start, value: the quantile of the growth of a histogram's buckets in tumbling windows (the rate, then the quantile)."""
    rows = df.withColumn("window_start", F.floor(F.unix_micros(ts) / (window_s * 1_000_000)) * window_s)
    keys = [*by, "window_start"]
    return histogram_quantile(q, histogram(rows, value, bounds, keys), keys)


def last_value(samples: DataFrame, by: list[str]) -> DataFrame:
    """An instant gauge: the latest sample's value."""
    return samples.groupBy(*by).agg(F.max_by("value", "ts").alias("value"))


def gateway_counters(batches: DataFrame) -> DataFrame:
    """One row from batch outcomes (n_events, reason, error): received counts events before validation, rejected and failed batches count as batches."""
    c = F.col
    fine = c("reason").isNull()
    failed = fine & c("error").isNotNull() & ~c("error").isin("canceled", "deadline")
    return batches.agg(
        F.sum("n_events").alias("received"), F.coalesce(F.sum(F.when(fine & c("error").isNull(), c("n_events"))), F.lit(0)).alias("accepted"), F.count_if(~fine).alias("rejected"), F.count_if(failed).alias("publish_errors"),
        F.count_if(c("n_events") > 0).alias("batch_sizes"), F.count_if(fine).alias("publish_durations"),
    )


def sink_counters(batches: DataFrame) -> DataFrame:
    """consumed, persisted, conflicts, retries, dlq and the number of batches from batch results (consumed, inserted, conflicts, retries, dlq)."""
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name) for c, name in (("consumed", "consumed"), ("inserted", "persisted"), ("conflicts", "conflicts"), ("retries", "retries"), ("dlq", "dlq"))]
    return batches.agg(*total, F.count("*").alias("batches"))


def client_snapshot(emits: DataFrame) -> DataFrame:
    """attempted, queued, invalid, dropped_full, dropped_closed from emit outcomes; attempted is the sum of the others."""
    o = F.col("outcome")
    return emits.agg(F.count("*").alias("attempted"), *(F.count_if(o == k).alias(k) for k in ("queued", "invalid", "dropped_full", "dropped_closed")))
