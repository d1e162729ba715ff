"""Blocked scans, interval sweeps and range queries, against plain readings."""

import random

import pytest
from pyspark.sql import functions as F

from driftwell.config import DetectorConfig
from driftwell.operators import detector, intervals, scan
from driftwell.plans import metrics


def rows_of(spark, keys, n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(keys), "/r", t // 3, t, int(rng.lognormvariate(9, 1))) for t in range(n)]
    return spark.createDataFrame(rows, "service_name string, route string, clock long, id long, latency_us long").repartition(6)


def plain_scores(frame, config):
    out, state = {}, {}
    for r in sorted(frame.collect(), key=lambda r: (r.clock, r.id)):
        mean, std, s, odd, n, warmed = state.setdefault((r.service_name, r.route), detector.Baseline()).step(float(r.latency_us), config)
        out[r.id] = (mean or 0.0, std or 0.0, s, odd, n, warmed)
    return out


@pytest.mark.parametrize("keys,n,blocks", [(["a"], 6000, 6), (["a"], 400, 40), (["a", "b", None], 2500, 9), ([f"k{i}" for i in range(60)], 900, 13), (["a"], 5, 8)])
def test_blocked_scores_have_the_bits_of_the_recursion(spark, keys, n, blocks):
    config = DetectorConfig(warmup=20)
    frame = rows_of(spark, keys, n, n)
    want = plain_scores(frame, config)
    got = scan.score(frame, tie=("id",), config=config, blocks=blocks)
    assert got.columns == [*frame.columns, "ewma_mean_us", "ewma_stddev_us", "anomaly_score", "is_anomaly", "observations", "warmed"]
    got = got.collect()
    assert len(got) == n and {r.id: tuple(r)[5:] for r in got} == want


def test_a_hot_key_is_spread_and_needs_few_rounds(spark):
    frame = rows_of(spark, ["hot"], 8000, 1).withColumn("_key", F.lit("k"))
    order = ["service_name", "route", "clock", "id"]
    t = scan.blocked(frame, order, 8)
    sizes = [r["count"] for r in t.groupBy("_block").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2500
    starts, rounds = scan.starting_states(t, order, "latency_us", DetectorConfig())
    assert len(starts) == len(sizes) - 1 and rounds <= 2
    # the maps alone are already close: the mean and variance before each block, up to rounding
    states = {}
    base = detector.Baseline()
    for i, r in enumerate(sorted(t.collect(), key=lambda r: (r.clock, r.id))):
        if r["_block"] not in states:
            states[r["_block"]] = (base.mean, base.variance, base.count)
        base.step(float(r.latency_us), DetectorConfig())
    assert all((s.mean, s.variance, s.count) == states[b] for b, s in starts.items())


def test_block_maps_are_the_recursion(spark):
    rng = random.Random(3)
    for _ in range(50):
        c = DetectorConfig(alpha=rng.choice([0.01, 0.1, 0.7]))
        a = detector.Baseline(rng.uniform(0, 1e5), rng.uniform(0, 1e8), 7)
        xs = [rng.lognormvariate(9, 1) for _ in range(rng.randrange(1, 60))]
        moves = scan.BlockMap(xs[0], c.alpha)
        want = detector.Baseline(a.mean, a.variance, a.count)
        for x in xs:
            moves.then(x)
            want.step(x, c)
        got = moves.apply(a)
        assert got.count == want.count and got.mean == pytest.approx(want.mean, rel=1e-9) and got.variance == pytest.approx(want.variance, rel=1e-7)


def test_values_that_cannot_be_scored_fail_the_blocked_scan(spark):
    frame = spark.createDataFrame([("a", "r", 1, 1, None)], "service_name string, route string, clock long, id long, latency_us long")
    with pytest.raises(Exception, match="finite"):
        scan.score(frame, tie=("id",)).collect()
    assert scan.score(frame.limit(0), tie=("id",)).count() == 0


@pytest.mark.parametrize("kind,plain", [("max", max), ("min", min), ("sum", lambda a, b: a + b)])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_values(spark, kind, plain, inclusive):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", None]), i, rng.choice([None, rng.randrange(-50, 50)])) for i in range(700)]
    frame = spark.createDataFrame(rows, "g string, at long, v long").repartition(5)
    for by in ([], ["g"]):
        want, now = {}, {}
        for g, i, v in rows:
            key = g if by else 0
            before = now.get(key)
            after = before if v is None else v if before is None else plain(before, v)
            want[i], now[key] = after if inclusive else before, after
        got = {r["at"]: r.out for r in scan.running(frame, ["at"], kind, "v", "out", by, 9, inclusive).collect()}
        assert got == want
    assert scan.running(frame.limit(0), ["at"], kind, "v", "out").count() == 0


def test_time_that_goes_back_is_rejected_and_changes_nothing(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["p", "q"]), rng.choice([None, i * 3 + rng.randrange(-40, 40)])) for i in range(500)]
    frame = spark.createDataFrame(rows, "seq long, part string, t long")
    for by in ([], ["part"]):
        last, want = {}, {}
        for i, p, t in rows:
            key = p if by else 0
            want[i] = t is not None and t >= last.get(key, t)
            if want[i]:
                last[key] = t
        got = {r.seq: r.accepted for r in scan.backwards(frame, ["seq"], "t", by, 7).collect()}
        assert got == want and not all(v for i, v in want.items() if rows[i][2] is not None)


def test_overlapping_intervals_take_their_first_free_point(spark):
    rng = random.Random(13)
    for trial in range(6):
        span = rng.choice([60, 400, 3000])
        points = [(rng.choice(["a", "b"]), i, rng.choice([None, *[rng.randrange(1000)] * 6])) for i in range(150)]
        windows = []
        for i in range(60):
            start = rng.randrange(1000)
            windows.append((rng.choice(["a", "b", "c"]), i, start, start + rng.randrange(-2, span), start + rng.randrange(0, 40)))
        rng.shuffle(windows)
        taken, want = set(), {}
        for k, n, s, e, _ in sorted(windows, key=lambda w: w[1]):  # in the list's order, each the earliest free point
            found = min(((t, q) for key, q, t in points if key == k and t is not None and s <= t <= e and (key, q) not in taken), default=None)
            want[k, n] = found[::-1] if found else (None, None)
            if found:
                taken.add((k, found[1]))
        got, marked = intervals.match(spark.createDataFrame(points, "key string, seq long, t long"), spark.createDataFrame(windows, "key string, priority long, start long, finish long, label_end long"), ["key"], 5)
        assert {(r.key, r.priority): (r.seq, r.t) for r in got.collect()} == want
        labelled = {(k, q): t is not None and any(w[0] == k and w[2] <= t <= w[4] and w[3] >= w[2] for w in windows) for k, q, t in points}
        marked = marked.collect()
        assert len(marked) == len(points) and {(r.key, r.seq): r.labelled for r in marked} == labelled
        assert {(r.key, r.seq) for r in marked if r.priority is not None} == taken


def test_the_interval_sweep_compares_no_pairs(spark):
    points = spark.range(200).selectExpr("'k' AS key", "id AS seq", "id * 7 AS t")
    windows = spark.range(50).selectExpr("'k' AS key", "id AS priority", "id * 20 AS start", "id * 20 + 500 AS finish", "id * 20 AS label_end")
    for out in intervals.match(points, windows, ["key"]):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert [x.count() for x in intervals.match(points.limit(0), windows, ["key"])] == [50, 0]
    assert [x.count() for x in intervals.match(points, windows.limit(0), ["key"])] == [0, 200]


def plain_rate(samples, window, ts):
    s = [(t, float(v)) for t, v in sorted(samples) if ts - window < t <= ts]
    if len(s) < 2:
        return None
    up = s[-1][1] - s[0][1] + sum(p[1] for p, q in zip(s, s[1:], strict=False) if q[1] < p[1])
    taken, mean = s[-1][0] - s[0][0], (s[-1][0] - s[0][0]) / (len(s) - 1)
    start, end = s[0][0] - (ts - window), ts - s[-1][0]
    start, end = mean / 2 if start >= 1.1 * mean else start, mean / 2 if end >= 1.1 * mean else end
    if up > 0 and s[0][1] >= 0:
        start = min(start, taken * s[0][1] / up)
    return up * (taken + start + end) / taken / window


@pytest.mark.parametrize("window,step,chunk", [(60, 60, None), (300, 60, 300), (90, 60, 90), (60, 300, 600), (7, 3, 7)])
def test_range_rates_at_aligned_steps(spark, window, step, chunk):
    rng = random.Random(window + step)
    series = {}
    for name in "ab":
        t, v, own = 1000, 0, []
        while t < 4000:
            t += rng.choice([3, 10, 15, 200])
            v = rng.randrange(5) if rng.random() < 0.1 else v + rng.randrange(4)
            own.append((t, v))
        series[name] = own
    frame = spark.createDataFrame([(n, t, v) for n, own in series.items() for t, v in own], "name string, ts long, value long").repartition(4)
    got = {(r.name, r.ts): r.rate for r in metrics.range_rate(frame, window, step, ["name"], chunk).collect()}
    want = {(n, ts): r for n, own in series.items() for ts in range(0, 6000, step) if (r := plain_rate(own, window, ts)) is not None}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    assert metrics.range_rate(frame.limit(0), window, step, ["name"]).count() == 0


def test_no_window_goes_over_a_whole_series(spark):
    frame = spark.createDataFrame([("a", t, t // 7) for t in range(0, 5000, 5)], "name string, ts long, value long")
    plan = metrics.range_rate(frame, 300, 60, ["name"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_chunk" in line for line in windows)


def test_scraped_counters_restart(spark):
    frame = spark.createDataFrame([("a", 3, 2), ("a", 61, 1), ("b", 130, 5)], "name string, at long, n long")
    got = {(r.name, r.ts): r.value for r in metrics.scraped(frame, ["name"], 30, 120, blocks=3).collect()}
    assert got == {("a", 30): 2, ("a", 60): 2, ("a", 90): 3, ("a", 120): 0, ("a", 150): 0, ("b", 30): 0, ("b", 60): 0, ("b", 90): 0, ("b", 120): 0, ("b", 150): 5}
