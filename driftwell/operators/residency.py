"""Which earlier state of its key a row still finds: inactivity limit and least-recently-used capacity.

A row's key is still resident iff the gap to the key's row before is below the limit and fewer than max_keys other keys were seen
in between, that is, iff it is among the max_keys keys used last. The sequence is cut into parts; what a part has to know of
those before it is small: for each of its own keys the last row before, and, if there are more than max_keys keys at all, which
max_keys keys were used last. The latter come from the parts' own summaries by merging ever longer stretches of parts
(1, 2, 4, ... before it), max_keys rows a part each time. Each part is then one pass in order, whatever the keys' skew.
"""

from __future__ import annotations

from collections import OrderedDict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import table

#: Rows of a part at least, and parts at most.
PART, PARTS = 65_536, 20_000


def residency(events: DataFrame, key: str, clock: str, seq: str, ttl: int | None, max_keys: int | None) -> DataFrame:
    """key, clock, seq, previous (seq of the key's row before, null for its first), resident.

    seq numbers all rows from 0 without gaps in order of the clock.
    """
    rows = events.select(F.col(key).cast("string").alias("key"), F.col(clock).cast("long").alias("clock"), F.col(seq).cast("long").alias("seq"))
    n = (rows.agg(F.max("seq")).first()[0] or 0) + 1
    size = max(PART, -(-n // PARTS))
    parts = -(-n // size)
    rows = rows.withColumn("part", F.floor(F.col("seq") / size))
    ends = rows.groupBy("part", "key").agg(F.max("seq").alias("last"), F.max_by("clock", "seq").alias("last_clock"))
    before = W.partitionBy("key").orderBy("part")  # a row per part
    carried = ends.select("part", F.lit(1).alias("kind"), "key", F.lag("last_clock").over(before).alias("clock"), F.lag("last").over(before).alias("seq")).where("seq IS NOT NULL")
    feed = rows.select("part", F.lit(2).alias("kind"), "key", "clock", "seq").unionByName(carried)
    binds = max_keys is not None and ends.select("key").distinct().limit(max_keys + 1).count() > max_keys
    if binds and parts > 1:
        used = last_used(ends.select("part", "key", "last"), parts, max_keys)
        feed = feed.unionByName(used.select((F.col("part") + 1).alias("part"), F.lit(0).alias("kind"), "key", F.lit(None).cast("long").alias("clock"), F.col("last").alias("seq")).where(F.col("part") < parts))

    def run(batches):
        now, held, seen = None, OrderedDict(), {}
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for part, kind, k, t, s in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if part != now:
                    now, held, seen = part, OrderedDict(), {}
                if kind == 0:
                    held[k] = True
                    continue
                if kind == 2:
                    last = seen.get(k)
                    fresh = last is not None and (ttl is None or t - last[1] < ttl)
                    row = (k, t, s, last and last[0], fresh and (not binds or k in held))
                    for column, v in zip(out, row, strict=True):
                        column.append(v)
                    if binds:
                        held.pop(k, None)
                        held[k] = True
                        if len(held) > max_keys:
                            held.popitem(last=False)
                seen[k] = (s, t)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["key", "clock", "seq", "previous", "resident"])

    return feed.repartition("part").sortWithinPartitions("part", "kind", "seq").mapInArrow(run, "key string, clock long, seq long, previous long, resident boolean")


def last_used(ends: DataFrame, parts: int, max_keys: int) -> DataFrame:
    """part, key, last: the max_keys keys used last up to each part's end, from every part's own keys and their last rows."""

    def top(df: DataFrame) -> DataFrame:
        return df.withColumn("_r", F.row_number().over(W.partitionBy("part").orderBy(F.desc("last")))).where(F.col("_r") <= max_keys).drop("_r")

    state, reach = table(top(ends), "used"), 1
    while reach < parts:
        later = state.withColumn("part", F.col("part") + reach).where(F.col("part") < parts)
        state = table(top(state.unionByName(later).groupBy("part", "key").agg(F.max("last").alias("last"))), "used")
        reach *= 2
    return state


def evictions(resident: DataFrame, ttl: int | None, max_keys: int | None) -> DataFrame:
    """One row (ttl_evictions, capacity_evictions) of a store with one of the two limits, from its rows by `residency`.

    A state goes by the limit at the first row of any key that comes so late after its last one; by capacity when a new key needs its place.
    """
    keys = resident.groupBy("key").agg(F.max("clock").alias("last"), F.count_if(~F.col("resident") & F.col("previous").isNotNull()).alias("again"), F.count_if(~F.col("resident")).alias("new"))
    if max_keys is None:
        end = resident.agg(F.max("clock").alias("end"))  # one row
        return keys.join(F.broadcast(end)).agg((F.sum("again") + F.count_if(F.col("end") - F.col("last") >= ttl)).cast("long").alias("ttl_evictions"), F.lit(0).cast("long").alias("capacity_evictions"))
    return keys.agg(F.lit(0).cast("long").alias("ttl_evictions"), (F.sum("new") - F.least(F.count("*"), F.lit(max_keys))).cast("long").alias("capacity_evictions"))
