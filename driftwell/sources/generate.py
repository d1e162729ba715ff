"""Deterministic generators: demo load, pacer schedule, labelled replay manifest, enriched events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import hex_id, uuid_from_index

# The replay manifest's shape.
KEYS, WINDOWS, FIRST, EVERY, SPIKE_US, SPAN_MS = 10, 25, 10_000, 3_000, 60_000, 1_000
# Base latencies of the demo services in microseconds.
BASES = (8_000, 35_000, 120_000)


def draw(n: Column | int, seed: int, salt: str, at: Column) -> Column:
    """A uniform draw from [0, n) that depends on the seed, the salt and the row's number alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), at), F.lit(n) if isinstance(n, int) else n)


def demo_events(spark: SparkSession, count: int, seed: int = 42, routes: int = 8, prefix: str = "demo") -> DataFrame:
    """Draws in order route, service, latency, status; equal in distribution to the load generator's."""
    i = F.col("id")
    service = draw(3, seed, "service", i)
    base = F.element_at(F.array(*map(F.lit, BASES)), (service + 1).cast("int"))
    return spark.range(count).select(
        i.alias("sequence"), F.concat(F.lit(f"{prefix}-service-"), (service + 1).cast("string")).alias("service_name"), F.concat(F.lit("/v1/route-"), draw(routes, seed, "route", i).cast("string")).alias("route"),
        (base + draw((base / 2 + 1).cast("long"), seed, "latency", i)).cast("long").alias("latency_us"), F.when(draw(100, seed, "status", i) == 0, 500).otherwise(200).cast("long").alias("status_code"), hex_id("demo-", i, 16).alias("trace_id"),
    )


def pacer(ticks: DataFrame, rate: int, at: str = "elapsed_ns") -> DataFrame:
    """due: events to emit at each tick so that the total follows the rate; late ticks catch up. total is computed from the tick alone."""
    from pyspark.sql import Window as W

    whole = F.floor(F.col(at) / 1_000_000_000) * rate + F.floor((F.col(at) % 1_000_000_000) * rate / 1_000_000_000)
    out = ticks.withColumn("total", whole.cast("long"))
    return out.withColumn("due", F.col("total") - F.coalesce(F.lag("total").over(W.partitionBy(F.lit(0)).orderBy(at)), F.lit(0)))


def baseline_noise(seed: int | None, i: Column) -> Column:
    """0 to 500; without a seed by arithmetic that any engine repeats."""
    return (i * 7919) % 501 if seed is None else draw(501, seed, "noise", i)


def manifest(spark: SparkSession, count: int = 100_000, seed: int | None = None, prefix: str = "replay") -> tuple[DataFrame, DataFrame]:
    """(events, windows): one event a millisecond over ten keys round-robin; 25 labelled ramps, by arithmetic instead of a join."""
    i = F.col("id")
    name = lambda k: F.concat(F.lit(f"{prefix}-service-"), (F.floor(k / 2) + 1).cast("string"))
    route = lambda k: F.concat(F.lit("/v1/resource-"), (k % 5 + 1).cast("string"), F.lit("/{id}"))
    w = F.floor((i - FIRST) / EVERY)
    begin = FIRST + EVERY * w + w % KEYS
    sample = (i - begin) / KEYS
    on = (w >= 0) & (w < WINDOWS) & (i >= begin) & ((i - begin) % KEYS == 0) & (sample <= SPAN_MS / KEYS)
    base = 10_000 + baseline_noise(seed, i)
    latency = F.when(on & (sample < 80), base + sample.cast("long") * 250).when(on, SPIKE_US).otherwise(base)
    events = spark.range(count).select(i.alias("seq"), i.alias("event_time_ms"), name(i % KEYS).alias("service_name"), route(i % KEYS).alias("route"), latency.cast("long").alias("latency_us"))
    at = FIRST + EVERY * i + i % KEYS
    windows = spark.range(WINDOWS).select(name(at % KEYS).alias("service_name"), route(at % KEYS).alias("route"), at.alias("injected_at_ms"), (at + SPAN_MS).alias("window_end_ms"))
    return events, windows


def enriched_events(spark: SparkSession, count: int, partitions: int = 3, service: str = "sink-harness") -> DataFrame:
    """Deterministic enriched events with their log partition; identifiers have 12 hexadecimal digits."""
    if count > 1 << 48:
        raise ValueError("event index exceeds 12 hexadecimal digits")
    i, t = F.col("id"), F.struct(F.lit(1_791_200_000).cast("long").alias("seconds"), F.lit(0).alias("nanos"))
    return spark.range(count).select(
        (i % partitions).cast("int").alias("partition"), uuid_from_index(i).alias("event_id"), t.alias("event_time"), F.lit(service).alias("service_name"), F.lit("/deterministic").alias("route"), (250 + i % 10_000).alias("latency_us"),
        F.lit(200).cast("long").alias("status_code"), hex_id("sink-", i, 12).alias("trace_id"), F.lit(250.0).alias("ewma_mean_us"), F.lit(25.0).alias("ewma_stddev_us"), F.lit(0.0).alias("anomaly_score"), F.lit(False).alias("is_anomaly"), t.alias("processed_at"),
    )
