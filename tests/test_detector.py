"""Baselines: golden vectors, scans, residency, replay."""

import math
import random

import pytest
from pyspark.sql import functions as F

from driftwell.config import BatchConfig, ClientConfig, DetectorConfig, LoadConfig, RetryConfig, StateConfig, from_values
from driftwell.operators import detector, replay, residency
from driftwell.operators.detector import Baseline, ScoreError
from driftwell.sources import generate

HALF = DetectorConfig(alpha=0.5, warmup=1, threshold=3.0, floor_us=1.0)


def steps(config, values):
    b = Baseline()
    return b, [b.step(x, config) for x in values]


def test_golden_vectors():
    _, s = steps(HALF, [10.0])
    assert s == [(None, None, 0.0, False, 1, False)]
    _, s = steps(HALF, [10.0, 14.0, 12.0])
    assert s[1] == (10.0, 0.0, 4.0, True, 2, True) and s[2] == (12.0, 2.0, 0.0, False, 3, True)
    _, s = steps(DetectorConfig(0.5, 1, 3.0, 2.0), [10.0, 16.0])
    assert s[1][1:4] == (0.0, 3.0, True)
    _, s = steps(DetectorConfig(0.1, 3, 0.5, 1.0), [10.0, 10.0, 10.0, 20.0])
    assert [x[3] for x in s] == [False, False, False, True] and s[3][4] == 4
    _, s = steps(DetectorConfig(0.5, 1, 0.1, 1.0), [10.0, 5.0])
    assert s[1][2] == 0.0


def test_errors_leave_the_state_alone():
    c = DetectorConfig(0.1, 1, 3.0, 2.2250738585072014e-308)
    b, _ = steps(c, [1.0])
    for bad in (1.7976931348623157e308, math.nan, math.inf):
        with pytest.raises(ScoreError):
            b.step(bad, c)
    assert b.step(1.0, c)[0] == 1.0 and b.count == 2


def test_settings_keep_their_limits():
    for bad in (dict(alpha=0.0), dict(alpha=1.0), dict(warmup=0), dict(threshold=0.0), dict(floor_us=math.inf)):
        with pytest.raises(ValueError, match="must be"):
            DetectorConfig(**bad)
    for kind, bad in ((StateConfig, dict(max_keys=0)), (StateConfig, dict(ttl_ms=0)), (BatchConfig, dict(max_records=0)), (RetryConfig, dict(max_attempts=0)), (ClientConfig, dict(max_batch=501)), (LoadConfig, dict(route_count=0))):
        with pytest.raises(ValueError, match="must be"):
            kind(**bad)
    with pytest.raises(ValueError, match="500"):
        BatchConfig(max_records=501, bounded=True)
    assert from_values(LoadConfig, {"X_EVENTS_PER_SECOND": "7"}, "X_").expected == 420
    with pytest.raises(ValueError, match="not a valid int"):
        from_values(LoadConfig, {"ROUTE_COUNT": "many"})


def test_scan_equals_steps_across_batches(spark):
    rng = random.Random(1)
    rows = [(f"s{rng.randrange(3)}", "/r", i, rng.randrange(5000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "service_name string, route string, clock long, latency_us long").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 97)
    try:
        got = {r.clock: r for r in detector.score(df, config=HALF).collect()}
        capped = {r.clock: r for r in detector.score(df, config=HALF, ttl=6).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    state, gaps = {}, {}
    for s, _, t, x in rows:
        mean, std, score, odd, n, _ = state.setdefault(s, Baseline()).step(float(x), HALF)
        assert (got[t].ewma_mean_us, got[t].ewma_stddev_us, got[t].anomaly_score, got[t].is_anomaly, got[t].observations) == (mean or 0.0, std or 0.0, score, odd, n)
        base, last = gaps.get(s, (Baseline(), None))
        base = Baseline() if last is not None and t - last >= 6 else base
        mean = base.step(float(x), HALF)[0]
        gaps[s] = (base, t)
        assert capped[t].ewma_mean_us == (mean or 0.0)


def simulate(trace, ttl, max_keys):
    """Residency by a direct simulation of the ordered map."""
    held, out = {}, []
    for key, now in trace:
        if ttl is not None:
            for k in [k for k, t in held.items() if now - t >= ttl]:
                del held[k]
        out.append(key in held)
        held.pop(key, None)
        if not out[-1] and max_keys is not None and len(held) >= max_keys:
            del held[next(iter(held))]
        held[key] = now
    return out


@pytest.mark.parametrize("part", [64, 100_000])
@pytest.mark.parametrize(("ttl", "cap"), [(None, 2), (15, 2), (15, None), (40, 5), (7, 1), (None, 9)])
def test_residency_is_the_simulated_map(spark, monkeypatch, ttl, cap, part):
    monkeypatch.setattr(residency, "PART", part)
    rng, now, trace = random.Random(cap or 9), 0, []
    for i in range(1500):
        now += rng.choice([0, 0, 1, 2, 9])
        trace.append((f"k{rng.randrange(9 if i % 400 < 200 else 2)}", now))  # some stretches see two keys only
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(trace)], "key string, clock long, seq long")
    rows = residency.residency(df, "key", "clock", "seq", ttl, cap).orderBy("seq").collect()
    assert [r.resident for r in rows] == simulate(trace, ttl, cap)
    last = {}
    for r in rows:
        assert r.previous == last.get(r.key)
        last[r.key] = r.seq


def test_segments_spread_a_hot_key(spark):
    rng, now, rows = random.Random(5), 0, []
    for i in range(2000):
        now += rng.choice([0, 1, 5, 30])
        rows.append(("hot" if i % 10 else None, now, i))
    df = spark.createDataFrame(rows, "key string, clock long, i long")
    got = {r.i: r.segment for r in detector.segments(df, ["key"], "clock", 30, slice_size=50).collect()}
    seen, want = {}, {}
    for k, t, i in rows:
        last, n = seen.get(k, (t, 0))
        n += t - last >= 30
        seen[k], want[i] = (t, n), n
    assert got == want
    plan = detector.segments(df.where("key = 'hot'"), ["key"], "clock", 30, slice_size=50)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = plan.withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert parts > 1  # one key's rows are dealt by time slice


def observed(trace, ttl, cap, config=HALF):
    """Through the engine's store: (observations or the error, evictions by the limit, by capacity) for (key, value, time)."""
    store, out = detector.KeyStore(config, ttl, cap), []
    for key, x, t in trace:
        try:
            verdict, expired, full = store.observe((key, "/r"), x, t)
            out.append((verdict[4], expired, full))
        except ScoreError:
            out.append(None)
    return out, store


def test_state_traces():
    assert observed([("a", 1.0, 0), ("b", 1.0, 0), ("a", 1.0, 0), ("c", 1.0, 0), ("a", 1.0, 0), ("b", 1.0, 0)], None, 2)[0] == [(1, 0, 0), (1, 0, 0), (2, 0, 0), (1, 0, 1), (3, 0, 0), (1, 0, 1)]
    assert observed([("a", 1.0, 0), ("b", 1.0, 15), ("a", 1.0, 15)], 15, None)[0] == [(1, 0, 0), (1, 1, 0), (1, 0, 0)]
    assert observed([("a", 1.0, 0), ("a", 1.0, 10), ("a", 1.0, 24), ("b", 1.0, 39), ("a", 1.0, 39)], 15, None)[0] == [(1, 0, 0), (2, 0, 0), (3, 0, 0), (1, 1, 0), (1, 0, 0)]
    # one time for all keys: a row before the last successful one of any key is refused and changes nothing
    out, store = observed([("a", 1.0, 0), ("b", 1.0, 10), ("a", 1.0, 5), ("c", 1.0, 20), ("d", 1.0, 26)], 15, 2)
    assert out == [(1, 0, 0), (1, 0, 0), None, (1, 1, 0), (1, 1, 0)] and list(store.keys) == [("c", "/r"), ("d", "/r")]
    # a value that can't be scored doesn't advance the time
    small, huge = DetectorConfig(0.1, 1, 3.0, 2.2250738585072014e-308), 1.7976931348623157e308
    assert [x and x[0] for x in observed([("a", 1.0, 0), ("a", huge, 10), ("b", 1.0, 5)], 15, 2, small)[0]] == [1, None, 1]
    assert [x and x[0] for x in observed([("a", 1.0, 0), ("b", math.nan, 2), ("a", 1.0, 2), ("a", huge, 3), ("a", 1.0, 3)], None, 1, small)[0]] == [1, None, 2, None, 3]
    store.clear()
    assert not store.keys and store.observe(("a", "/r"), 1.0, 0)[0][4] == 1


def test_replay_gate(spark):
    events, windows = generate.manifest(spark, 100_000, seed=42)
    report, found, _ = replay.evaluate(events, windows)
    r = report.first()
    assert (r.event_count, r.anomaly_window_count, r.missed_windows, r.false_positive_count, r.passed) == (100_000, 25, 0, 0, True)
    assert all(0 < x.detection_latency_ms <= 5000 for x in found.collect())
    spiked = events.withColumn("latency_us", F.when((F.col("event_time_ms") == 99_990) & F.col("service_name").endswith("-1"), 60_000).otherwise(F.col("latency_us")))
    report, _, false = replay.evaluate(spiked, windows)
    assert report.first().false_positive_count == 1 and report.first().passed and [r.event_time_ms for r in false.collect()] == [99_990]
    short, _, _ = replay.evaluate(events.where("seq < 99999"), windows)
    assert not short.first().passed


def small_replay(spark, n, spike, window):
    events = spark.range(n).select(F.col("id").alias("seq"), F.col("id").alias("event_time_ms"), F.lit("s").alias("service_name"), F.lit("/r").alias("route"), F.when(F.col("id") == spike, 60_000).otherwise(10_000).cast("long").alias("latency_us"))
    return events, spark.createDataFrame([("s", "/r", *w) for w in window], "service_name string, route string, injected_at_ms long, window_end_ms long")


def test_late_detection_and_labels(spark):
    report, found, false = replay.evaluate(*small_replay(spark, 3001, 3000, [(1000, 1500)]))
    assert found.first().detected_at_ms == 3000 and found.first().detection_latency_ms == 2000 and false.count() == 0
    for bad in ([(1000, 1500), (1000, 1500)], [(100, 200), (2100, 2200)], [(100, 1101)], [(100, 99)], [(5000, 5100)]):
        with pytest.raises(ValueError, match="invalid manifest"):
            replay.evaluate(*small_replay(spark, 3001, 3000, bad))
    events, windows = small_replay(spark, 3001, 3000, [(1000, 1500)])
    with pytest.raises(ValueError, match="increase"):
        replay.evaluate(events.withColumn("event_time_ms", F.when(F.col("seq") == 5, 4).otherwise(F.col("event_time_ms"))), windows)


def test_generators(spark):
    demo = generate.demo_events(spark, 20_000)
    assert demo.exceptAll(generate.demo_events(spark, 20_000)).isEmpty()
    r = demo.agg(F.count_distinct("service_name").alias("s"), F.count_distinct("route").alias("r"), F.avg((F.col("status_code") == 500).cast("int")).alias("e"), F.min("latency_us").alias("lo"), F.max("latency_us").alias("hi")).first()
    assert (r.s, r.r) == (3, 8) and 0.005 < r.e < 0.015 and r.lo >= 8000 and r.hi <= 180_000
    ticks = spark.createDataFrame([(10_000_000,), (40_000_000,), (100_000_000,), (1_000_000_000,)], "elapsed_ns long")
    assert [r.due for r in generate.pacer(ticks, 1000).orderBy("elapsed_ns").collect()] == [10, 30, 60, 900]
    with pytest.raises(ValueError, match="12 hexadecimal digits"):
        generate.enriched_events(spark, (1 << 48) + 1)
