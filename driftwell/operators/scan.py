"""Blocked scans: running values over an order of all rows, or over a hot key, spread over many tasks.

Rows are dealt into blocks, ranges of the order that Spark samples to be of equal size, and written with their block's number. Each block is
summed up by an element of a monoid; what comes before a block is the combination of the elements before it; inside, a block is scanned in
its own task from there. One row a block passes the driver, and blocks are as many as the range shuffle's partitions, however many rows.

Two kinds of element are used. Running maxima and sums are plain SQL aggregates (`running`). The exponentially weighted baseline is an
action on the state: mean and variance after some rows are linear in (1, d, d^2, v) of the state before, d being the mean's distance from a
fixed point, so a block is one such map (`BlockMap`).

The maps round differently than the recursion does. So `score` takes what they give as a guess and verifies it: blocks are replayed from the
guessed states, and where a block ends on other bits than the next one was guessed to start from, that one is replayed from there, until
nothing changes. What is left is the recursion's own result, bit for bit, by induction from the key's first row. A replay forgets its start
exponentially, so it takes a round or two; only blocks in the middle of a key are replayed at all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import DetectorConfig
from ..tables import table
from .detector import SCORES, Baseline


def blocked(rows: DataFrame, order: list[str], blocks: int | None = None) -> DataFrame:
    """The rows as a written table with `_block`: consecutive ranges of the order, numbered."""
    dealt = rows.repartitionByRange(blocks, *order) if blocks else rows.repartitionByRange(*order)
    return table(dealt.withColumn("_block", F.spark_partition_id()), "blocks")


#: For each kind of running value: its aggregate, and how two of them combine.
MONOIDS: dict[str, tuple[Callable, Callable]] = {"max": (F.max, F.greatest), "min": (F.min, F.least), "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b))}


_PLAIN = {"max": max, "min": min, "sum": lambda p, q: p + q}


def running_all(rows: DataFrame, order: list[str], values: dict[str, tuple[str, str]], by: list[str] | None = None, blocks: int | None = None, inclusive: bool = False) -> DataFrame:
    """Adds, for each name: (kind, column), the max, min or sum of the column over the rows before (and at, if inclusive) each row in the
    order, within `by`; null if there are none.

    The order has to be total for a definite result; rows with equal order may come either way.
    """
    by = by or []
    group = F.struct(*by) if by else F.lit(0)
    t = blocked(rows, [*by, *order], blocks)
    # only a block's last group goes on in a later block
    last = t.groupBy("_block").agg(F.max(group).alias("_last"))
    own = t.join(F.broadcast(last), "_block").where(group.eqNullSafe(F.col("_last")))  # a row a block is broadcast
    own = own.groupBy("_block", "_last").agg(*(MONOIDS[kind][0](value).alias(name) for name, (kind, value) in values.items()))
    carried, now = [], None
    for r in sorted(own.collect(), key=lambda r: r["_block"]):  # what a block starts from, for the group that the blocks before ended with
        if now is not None:
            carried.append((r["_block"], *now))
        sums = []
        for i, (name, (kind, _)) in enumerate(values.items()):
            parts = [v for v in (now[i + 1] if now is not None and now[0] == r["_last"] else None, r[name]) if v is not None]
            sums.append(reduce(_PLAIN[kind], parts) if parts else None)
        now = (r["_last"], *sums)
    carry = t.sparkSession.createDataFrame(carried, StructType([own.schema["_block"], own.schema["_last"], *(own.schema[n] for n in values)]))
    carry = carry.withColumnsRenamed({"_block": "_b", **{n: f"_carry_{n}" for n in values}})
    inside = W.partitionBy("_block", *by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    out = t.join(F.broadcast(carry), (F.col("_block") == F.col("_b")) & group.eqNullSafe(F.col("_last")), "left")
    return out.select(*rows.columns, *(MONOIDS[kind][1](MONOIDS[kind][0](value).over(inside), F.col(f"_carry_{name}")).alias(name) for name, (kind, value) in values.items()))


def running(rows: DataFrame, order: list[str], kind: str, value: str, name: str, by: list[str] | None = None, blocks: int | None = None, inclusive: bool = False) -> DataFrame:
    """One running value."""
    return running_all(rows, order, {name: (kind, value)}, by, blocks, inclusive)


@dataclass
class BlockMap:
    """What some rows make of a state, as a map from d (its mean's distance from centre) and its variance; rows of one key only."""

    centre: float
    alpha: float
    a: float = 0.0
    b: float = 1.0
    v0: float = 0.0
    v1: float = 0.0
    v2: float = 0.0
    v3: float = 1.0
    rows: int = 0

    def then(self, x: float) -> None:
        """One more row."""
        keep, e = 1.0 - self.alpha, x - self.centre - self.a
        self.v0, self.v1, self.v2, self.v3 = keep * (self.v0 + self.alpha * e * e), keep * (self.v1 - 2.0 * self.alpha * e * self.b), keep * (self.v2 + self.alpha * self.b * self.b), keep * self.v3
        self.a, self.b, self.rows = self.a + self.alpha * e, keep * self.b, self.rows + 1

    def apply(self, s: Baseline) -> Baseline:
        d = s.mean - self.centre
        return Baseline(self.centre + self.a + self.b * d, max(0.0, self.v0 + self.v1 * d + self.v2 * d * d + self.v3 * s.variance), s.count + self.rows)


_SUMMARY = "_block int, first string, last string, map array<double>, rows long, mean double, variance double, count long"
_END = "_block int, mean double, variance double, count long"


def _in_order(t: DataFrame, order: list[str]) -> DataFrame:
    return t.repartition("_block").sortWithinPartitions("_block", *order)


def _number(x) -> float:
    return math.nan if x is None else float(x)


def _summaries(t: DataFrame, order: list[str], value: str, c: DetectorConfig) -> DataFrame:
    """A row a block: its first and last key, its map if these are one (null if not), and the state it ends on from its last key's first row here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first, last, moves, state = None, None, None, None, Baseline()

        def done() -> dict:
            packed = None if moves is None else [moves.centre, moves.a, moves.b, moves.v0, moves.v1, moves.v2, moves.v3]
            return {"_block": block, "first": first, "last": last, "map": packed, "rows": moves.rows if moves else 0, "mean": state.mean, "variance": state.variance, "count": state.count}

        out = []
        for batch in batches:
            for b, key, x in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                x = _number(x)
                if b != block:
                    if block is not None:
                        out.append(done())
                    block, first, last, moves, state = b, key, key, BlockMap(x, c.alpha), Baseline()
                elif key != last:
                    last, moves, state = key, None, Baseline()
                state.step(x, c)
                if moves is not None:
                    moves.then(x)
        if block is not None:
            out.append(done())
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("_block", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("map", pa.list_(pa.float64())), ("rows", pa.int64()), ("mean", pa.float64()), ("variance", pa.float64()), ("count", pa.int64())]))

    return _in_order(t, order).select("_block", "_key", value).mapInArrow(run, _SUMMARY)


def _replayed(t: DataFrame, order: list[str], value: str, c: DetectorConfig, starts: dict[int, Baseline]) -> dict[int, Baseline]:
    """The states on which the blocks of `starts` end, from the given ones."""
    held = t.sparkSession.sparkContext.broadcast({b: (s.mean, s.variance, s.count) for b, s in starts.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[int, Baseline] = {}
        for batch in batches:
            for b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b not in ends:
                    ends[b] = Baseline(*held.value[b])
                ends[b].step(_number(x), c)
        yield pa.RecordBatch.from_pylist([{"_block": b, "mean": s.mean, "variance": s.variance, "count": s.count} for b, s in ends.items()], schema=pa.schema([("_block", pa.int32()), ("mean", pa.float64()), ("variance", pa.float64()), ("count", pa.int64())]))

    rows = _in_order(t.where(F.col("_block").isin(*starts)), order).select("_block", value).mapInArrow(run, _END).collect()  # a row a block
    held.destroy()
    return {r["_block"]: Baseline(r["mean"], r["variance"], r["count"]) for r in rows}


def starting_states(t: DataFrame, order: list[str], value: str, c: DetectorConfig) -> tuple[dict[int, Baseline], int]:
    """(the state that a block's first key has when the block starts, for blocks in the middle of a key; rounds of replays)."""
    found = sorted(_summaries(t, order, value, c).collect(), key=lambda r: r["_block"])
    ends: dict[int, tuple[Baseline, Baseline]] = {}  # of a block: the start it was replayed from, and its end
    rounds = 0
    while True:
        starts: dict[int, Baseline] = {}
        before, state = None, Baseline()
        for r in found:
            whole = r["map"] is not None  # one key
            if before is not None and before["last"] == r["first"]:
                starts[r["_block"]] = state
                if whole:
                    known = ends.get(r["_block"])
                    state = known[1] if known else BlockMap(r["map"][0], c.alpha, *r["map"][1:], rows=r["rows"]).apply(state)
            if not whole or r["_block"] not in starts:
                state = Baseline(r["mean"], r["variance"], r["count"])
            before = r
        follows = {r["_block"] for r, after in zip(found, found[1:], strict=False) if r["map"] is not None and after["first"] == r["last"]}
        stale = {b: s for b, s in starts.items() if b in follows and (b not in ends or ends[b][0] != s)}
        if not stale:
            return starts, rounds
        rounds += 1
        for b, end in _replayed(t, order, value, c, stale).items():
            ends[b] = stale[b], end


def score(events: DataFrame, value: str = "latency_us", keys: tuple[str, ...] = ("service_name", "route"), clock: str = "clock", tie: tuple[str, ...] = (), config: DetectorConfig = DetectorConfig(), blocks: int | None = None) -> DataFrame:
    """As `detector.score` without a limit, with the same bits, but with a key's rows spread over as many tasks as they fill blocks.

    A value that can't be scored fails the job.
    """
    order = [*keys, clock, *tie]
    names = events.columns
    t = blocked(events.withColumn("_key", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})), order, blocks)
    starts, _ = starting_states(t, order, value, config)
    held = t.sparkSession.sparkContext.broadcast({b: (s.mean, s.variance, s.count) for b, s in starts.items()})
    from pyspark.sql.pandas.types import to_arrow_schema

    out_type = StructType.fromDDL(SCORES)
    schema, kinds = StructType([*events.schema.fields, *out_type.fields]), list(to_arrow_schema(out_type))
    at = names.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now, state = None, None, Baseline()
        for batch in batches:
            cols: list[list] = [[] for _ in kinds]
            n = batch.num_columns
            for b, key, x in zip(*(batch.column(i).to_pylist() for i in (n - 1, n - 2, at)), strict=True):
                if b != block or key != now:
                    state = Baseline(*held.value[b]) if b != block and b in held.value else Baseline()
                    block, now = b, key
                mean, std, s, odd, count, warmed = state.step(_number(x), config)
                for c, v in zip(cols, (mean or 0.0, std or 0.0, s, odd, count, warmed), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([*batch.columns[: n - 2], *(pa.array(c, k.type) for c, k in zip(cols, kinds, strict=True))], names=[*names, *(k.name for k in kinds)])

    return _in_order(t, order).select(*names, "_key", "_block").mapInArrow(run, schema)


def backwards(rows: DataFrame, order: list[str], time: str, by: list[str] | None = None, blocks: int | None = None) -> DataFrame:
    """Adds last (the latest accepted time of the rows before) and accepted: times before it are rejected and change nothing.

    What is rejected lies before the latest accepted time, so that is the running maximum of all times. A null time is rejected.
    """
    out = running(rows, order, "max", time, "last", by, blocks)
    return out.withColumn("accepted", F.coalesce(F.col(time) >= F.coalesce("last", F.col(time)), F.lit(False)))
