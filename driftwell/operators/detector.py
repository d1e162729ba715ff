"""Per-key exponentially weighted baselines: batch scan, final baseline and the stateful streaming operator.

The score of a value depends on all earlier ones of its key, so the scan needs each key's rows in order: one shuffle by key, a
sort inside the partitions, and one pass that carries a single key's state from batch to batch (bounded memory whatever a
key's length). A gap of at least the inactivity limit starts a key afresh, so the rows between two such gaps are
independent: with a limit set, (key, segment) is what is dealt out, and one hot key spreads over many tasks. Gaps are found per key
and time slice and between slices, so that no task sorts a whole key for that either.
"""

from __future__ import annotations

import gc
import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DetectorConfig

SCORES = "ewma_mean_us double, ewma_stddev_us double, anomaly_score double, is_anomaly boolean, observations long, warmed boolean"


class ScoreError(ValueError):
    """The value can't be scored; the state is as before."""


@dataclass
class Baseline:
    """One key's state: mean, variance and number of observations."""

    mean: float = 0.0
    variance: float = 0.0
    count: int = 0

    def step(self, x: float, c: DetectorConfig) -> tuple[float | None, float | None, float, bool, int, bool]:
        """(earlier mean, earlier deviation, score, anomaly, observations now, warmed); one-sided score, deviation floored."""
        if not math.isfinite(x):
            raise ScoreError("latency must be finite")
        warmed = self.count >= c.warmup
        if self.count == 0:
            self.mean, self.variance, self.count = x, 0.0, 1
            return None, None, 0.0, False, 1, warmed
        mean, std = self.mean, math.sqrt(self.variance)
        score = max(x - mean, 0.0) / max(std, c.floor_us)
        d = x - mean
        variance = (1.0 - c.alpha) * (self.variance + c.alpha * d * d)
        new = mean + c.alpha * d
        if not (math.isfinite(score) and math.isfinite(variance) and math.isfinite(new)):
            raise ScoreError("score or state is not finite")
        self.mean, self.variance, self.count = new, variance, self.count + 1
        return mean, std, score, warmed and score >= c.threshold, self.count, warmed


#: Clock units (ms) of a slice in which a key's gaps are found together.
SLICE = 3_600_000


def segments(events: DataFrame, keys: list[str], clock: str, ttl: int, slice_size: int = SLICE) -> DataFrame:
    """Adds `segment`: how many gaps of at least ttl (in the clock's unit) a key's rows have had so far."""
    names = [*keys, "_slice"]
    rows = events.withColumn("_slice", F.floor(F.col(clock) / slice_size))
    order = W.partitionBy(*names).orderBy(clock)
    jump = lambda now, last: F.coalesce((now - last >= ttl).cast("long"), F.lit(0))
    rows = rows.withColumn("_gap", jump(F.col(clock), F.lag(clock).over(order))).withColumn("_gaps", F.sum("_gap").over(order))
    ends = rows.groupBy(*names).agg(F.min(clock).alias("_first"), F.max(clock).alias("_last"), F.sum("_gap").alias("_own"))
    slices = W.partitionBy(*keys).orderBy("_slice")  # a row per slice
    ends = ends.withColumn("_jump", jump(F.col("_first"), F.lag("_last").over(slices)))
    base = ends.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(names)), (F.sum(F.col("_own") + F.col("_jump")).over(slices) - F.col("_own")).alias("_base"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(names)]
    out = rows.join(base, same).withColumn("segment", F.col("_base") + F.col("_gaps"))
    return out.select(*events.columns, "segment")


def score(events: DataFrame, value: str = "latency_us", keys: tuple[str, ...] = ("service_name", "route"), clock: str = "clock", tie: tuple[str, ...] = (), config: DetectorConfig = DetectorConfig(), ttl: int | None = None, segment: str | None = None, skip_errors: bool = False) -> DataFrame:
    """All columns of events and the verdict's (ewma_mean_us, ewma_stddev_us, anomaly_score, is_anomaly, observations, warmed).

    The mean and deviation are those before the row, 0.0 for a key's first. `segment` names a column that splits keys
    into independent runs already; `ttl` computes one. Rows that can't be scored fail the job or, with skip_errors, get a null score.
    """
    keys, tie = list(keys), list(tie)
    if ttl is not None:
        events, segment = segments(events, keys, clock, ttl), "segment"
    group = [*keys, segment] if segment else keys
    names = events.columns
    at = [names.index(k) for k in group]
    x = names.index(value)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_type = StructType.fromDDL(SCORES)
    schema = StructType([*events.schema.fields, *out_type.fields])
    kinds = list(to_arrow_schema(out_type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, Baseline()
        for batch in batches:
            cols: list[list] = [[] for _ in kinds]
            for row in zip(*(batch.column(i).to_pylist() for i in (*at, x)), strict=True):
                if row[:-1] != now:
                    now, state = row[:-1], Baseline()
                try:
                    mean, std, s, odd, n, warmed = state.step(math.nan if row[-1] is None else float(row[-1]), config)
                    got = (mean or 0.0, std or 0.0, s, odd, n, warmed)
                except ScoreError:
                    if not skip_errors:
                        raise
                    got = (None, None, None, None, state.count, None)
                for c, v in zip(cols, got, strict=True):
                    c.append(v)
            arrays = [*batch.columns, *(pa.array(c, k.type) for c, k in zip(cols, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *(k.name for k in kinds)])

    return events.repartition(*group).sortWithinPartitions(*group, clock, *tie).mapInArrow(run, schema)


def final_baselines(events: DataFrame, value: str = "latency_us", keys: tuple[str, ...] = ("service_name", "route"), clock: str = "clock", tie: tuple[str, ...] = (), config: DetectorConfig = DetectorConfig()) -> DataFrame:
    """keys, mean, variance, observations after each key's last row."""
    scored = score(events.select(*keys, clock, *tie, value), value, keys, clock, tie, config)
    last = scored.groupBy(*keys).agg(F.max_by(F.struct("ewma_mean_us", "ewma_stddev_us", "observations", value), "observations").alias("l"))
    first = F.col("l.observations") == 1
    x, m = F.col(f"l.{value}").cast("double"), F.col("l.ewma_mean_us")
    d = x - m
    spread = F.col("l.ewma_stddev_us") * F.col("l.ewma_stddev_us")
    return last.select(*keys, F.when(first, x).otherwise(m + F.lit(config.alpha) * d).alias("mean_us"), F.when(first, 0.0).otherwise((1.0 - config.alpha) * (spread + config.alpha * d * d)).alias("variance"), F.col("l.observations").alias("observations"))


def baselines(events: DataFrame, value: str = "latency_us", keys: tuple[str, ...] = ("service_name", "route"), clock: str = "clock", tie: tuple[str, ...] = (), config: DetectorConfig = DetectorConfig(), ttl: int | None = None) -> DataFrame:
    """keys, mean, variance, count, last: each key's state after its last row, to the bit, and that row's time; a stream can go on from there."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    k = len(keys)
    rows = events.select(*keys, clock, value, *tie)
    schema = StructType([*(rows.schema[x] for x in keys), *StructType.fromDDL("mean double, variance double, count long, last long")])
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, last, out = None, Baseline(), None, []
        for batch in batches:
            for *key, t, x in zip(*(batch.column(i).to_pylist() for i in range(k + 2)), strict=True):
                if key != now:
                    if now is not None:
                        out.append((*now, state.mean, state.variance, state.count, last))
                    now, state, last = key, Baseline(), None
                if ttl is not None and last is not None and t - last >= ttl:
                    state = Baseline()
                state.step(math.nan if x is None else float(x), config)
                last = t
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*now, state.mean, state.variance, state.count, last), kinds, strict=True)], schema=kinds)

    return rows.repartition(*keys).sortWithinPartitions(*keys, clock, *tie).mapInArrow(run, schema)


def anomalies(scored: DataFrame) -> DataFrame:
    return scored.where("is_anomaly")


def counters(scored: DataFrame, dead: Column | None = None) -> list[Column]:
    """Aggregates behind the processor's counters, over scored rows."""
    c = F.col
    return [F.count("*").alias("enriched"), F.count_if(c("is_anomaly")).alias("anomalies"), F.count_if(~c("warmed")).alias("warmup_suppressions")]


class KeyStore:
    """The baselines of one shard of keys in order of last use: an inactivity limit, a capacity, and one time for all keys.

    A value that can't be scored, or whose time is before the last successful one of any key, raises and changes nothing.
    """

    def __init__(self, config: DetectorConfig, ttl_ms: int | None = None, max_keys: int | None = None):
        self.config, self.ttl, self.max_keys = config, ttl_ms, max_keys
        self.keys: OrderedDict[tuple, tuple[Baseline, int]] = OrderedDict()
        self.last: int | None = None

    def clear(self) -> None:
        """A new assignment epoch starts without any baseline."""
        self.keys.clear()
        self.last = None

    def observe(self, key: tuple, x: float, now: int) -> tuple[tuple, int, int]:
        """(verdict, evictions by the limit, evictions by capacity)."""
        if self.last is not None and now < self.last:
            raise ScoreError("observation time must not move backwards")
        base, seen = self.keys.get(key, (None, 0))
        if base is None or self.ttl is not None and now - seen >= self.ttl:
            base = Baseline()
        verdict = base.step(x, self.config)
        expired = full = 0
        while self.ttl is not None and self.keys and now - next(iter(self.keys.values()))[1] >= self.ttl:
            self.keys.popitem(last=False)
            expired += 1
        if self.keys.pop(key, None) is None and self.max_keys is not None and len(self.keys) >= self.max_keys:
            self.keys.popitem(last=False)
            full = 1
        self.keys[key] = (base, now)
        self.last = now
        return verdict, expired, full


#: Verdicts that stand as Python objects at a time.
OUT_ROWS = 10_000
#: What the streaming scorer adds to a row: its verdict or the error, and the evictions that the row caused.
STREAMED = SCORES + ", error string, evicted_ttl long, evicted_capacity long"


def _piece(rows: pa.Table | pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write(rows)
    return out.getvalue().to_pybytes()


def packed(rows: DataFrame, shard: Column) -> DataFrame:
    """shard, rows: each Arrow batch's rows of a shard as one binary value, as Spark hands rows to a stateful operator in Python one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column("_shard"))
            batch = batch.drop_columns(["_shard"])
            for s in np.unique(at):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([_piece(batch.take(pa.array(np.flatnonzero(at == s))))], pa.binary())], names=["shard", "rows"])

    return rows.withColumn("_shard", shard).mapInArrow(run, "shard long, rows binary")


def unpacked(pieces: DataFrame, schema: str) -> DataFrame:
    """The rows of pieces (column rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.column("rows"):
                yield from pa.ipc.open_stream(piece.as_buffer()).read_all().to_batches()

    return pieces.select("rows").mapInArrow(run, schema)


def stream_processor(config: DetectorConfig, ttl_ms: int | None, max_keys: int | None, value: str, clock: str, keys: list[str], order: list[str], fields: list[str], epoch: int = 0):
    """A StatefulProcessor for transformWithStateInPandas over shards of keys, for `packed` rows; each shard holds one KeyStore in its state.

    A micro-batch's rows of a shard are sorted by clock and order and scored. A row that can't be scored gets an error and no verdict; the
    batch goes on. An epoch other than the state's clears it. The result is pieces of rows again.
    """
    import pandas as pd
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.streaming import StatefulProcessor
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(STREAMED))

    class Scorer(StatefulProcessor):
        def init(self, handle) -> None:
            self.held = handle.getMapState("baselines", ", ".join(f"{k} string" for k in keys), "mean double, variance double, count long, last long, used long")
            self.meta = handle.getValueState("meta", "epoch long, last long, used long")

        def handleInputRows(self, key, rows, timers) -> Iterator[pd.DataFrame]:
            frame = pa.concat_tables([pa.ipc.open_stream(x).read_all() for part in rows for x in part["rows"]])
            frame = frame.take(pc.sort_indices(frame, sort_keys=[(c, "ascending") for c in (clock, *order)]))
            store, used, stored = KeyStore(config, ttl_ms, max_keys), 0, {}
            meta = self.meta.get() if self.meta.exists() else None
            if meta is not None and meta[0] == epoch:
                store.last, used = meta[1], meta[2]
                stored = {tuple(k): tuple(v) for k, v in self.held.iterator()}
                for k, v in sorted(stored.items(), key=lambda kv: kv[1][4]):
                    store.keys[k] = (Baseline(v[0], v[1], v[2]), v[3])
            elif meta is not None:
                self.held.clear()
            touched = {}
            for a in range(0, frame.num_rows, OUT_ROWS):
                part, out = frame.slice(a, OUT_ROWS), []
                for *k, x, t in zip(*(part[c].to_pylist() for c in (*keys, value, clock)), strict=True):
                    used += 1
                    k = tuple(k)
                    try:
                        (mean, std, s, odd, n, warmed), expired, full = store.observe(k, math.nan if x is None else x, t)
                        out.append((mean or 0.0, std or 0.0, s, odd, n, warmed, None, expired, full))
                        touched[k] = used
                    except ScoreError as e:
                        out.append((None, None, None, None, None, None, str(e), 0, 0))
                part = part.select(fields)
                for kind, values in zip(kinds, zip(*out, strict=True), strict=True):
                    part = part.append_column(kind, pa.array(values, kind.type))
                yield pd.DataFrame({"rows": [_piece(part)]})
            for k in stored.keys() - store.keys.keys():
                self.held.removeKey(k)
            for k, at in touched.items():
                if k in store.keys:
                    base, last = store.keys[k]
                    self.held.updateValue(k, (base.mean, base.variance, base.count, last, at))
            if store.last is not None:
                self.meta.update((epoch, store.last, used))

        def close(self) -> None:
            gc.collect()  # a worker lives on through later micro-batches

    return Scorer()
