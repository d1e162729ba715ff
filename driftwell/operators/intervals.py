"""Interval join with first unconsumed match: a sweep over the sorted union of points and interval starts.

Intervals of a key are served in the order of their priority; each takes the earliest point inside it (both ends count) that no other took.
As all intervals prefer earlier points, the same matching comes from the points' side: in order of time each point goes to the open interval of
least priority number that has none yet. So a sweep over time with the open intervals at hand does it, whatever intervals overlap and however
long they are, and no point is copied or compared with every interval.

Keys are cut where no interval is open: running maxima of the ends so far (a blocked scan) say where, and a cluster of overlapping
intervals is what is dealt out. A point outside all of them goes to none. A task holds a cluster's open intervals, and reads the rest in order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from ..tables import table
from .scan import running, running_all

SLICE = 8192


def match(points: DataFrame, intervals: DataFrame, keys: list[str], blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(intervals, points) with what was matched.

    points: keys, seq (unique in a key), t. intervals: keys, priority (unique in a key), start, finish, and label_end: a point from start to label_end of
    any interval is labelled. All but keys are longs.

    Results: keys, priority, start, finish, seq, t (both null without a match); keys, seq, t, priority (null if none took it), labelled. Points and
    intervals without a time (or an end) match nothing; an interval that ends before it starts neither. Of a time, intervals open before points.
    """
    c = F.col
    none = F.lit(None).cast("long")
    opened = intervals.where("start IS NOT NULL AND finish >= start").select(*keys, c("start").alias("t"), F.lit(0).alias("kind"), c("priority").alias("n"), c("finish"), c("label_end"))
    seen = points.where("t IS NOT NULL").select(*keys, "t", F.lit(1).alias("kind"), c("seq").alias("n"), none.alias("finish"), none.alias("label_end"))
    order = ["t", "kind", "n"]
    rows = running_all(opened.unionByName(seen), order, {"_end": ("max", "finish"), "_label": ("max", "label_end")}, keys, blocks)
    outside = (c("kind") == 1) & (c("_end").isNull() | (c("_end") < c("t")))
    fresh = F.when((c("kind") == 0) & (c("_end").isNull() | (c("_end") < c("t"))), c("t"))
    rows = rows.withColumn("_starts", fresh).withColumn("labelled", F.coalesce(c("_label") >= c("t"), F.lit(False)))
    inside = running(rows.where(~outside).select(*keys, *order, "finish", "labelled", "_starts"), order, "max", "_starts", "cluster", keys, blocks, inclusive=True)

    shape = StructType([*(inside.schema[k] for k in keys), StructField("priority", LongType()), StructField("seq", LongType()), StructField("t", LongType())])
    kind = to_arrow_schema(shape)
    k = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each match."""
        now, free, out = None, [], []
        for batch in batches:
            for *group, t, is_point, n, finish in zip(*(batch.column(i).to_pylist() for i in range(k + 5)), strict=True):
                if group != now:
                    now, free = group, []
                if not is_point:
                    heapq.heappush(free, (n, finish))
                    continue
                while free and free[0][1] < t:
                    heapq.heappop(free)
                if free:
                    out.append((*group[:-1], heapq.heappop(free)[0], n, t))
                if len(out) >= SLICE:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), kind, strict=True)], schema=kind)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), kind, strict=True)], schema=kind)

    swept = inside.repartition(*keys, "cluster").sortWithinPartitions(*keys, "cluster", *order).select(*keys, "cluster", *order, "finish")
    found = table(swept.mapInArrow(run, shape), "matches")
    renamed = found.select(*(c(x).alias(f"_k{i}") for i, x in enumerate(keys)), c("priority").alias("_p"), c("seq").alias("_s"), c("t").alias("_t"))
    same = [c(x).eqNullSafe(c(f"_k{i}")) for i, x in enumerate(keys)]
    matched = intervals.join(renamed, [*same, c("priority") == c("_p")], "left").select(*keys, "priority", "start", "finish", c("_s").alias("seq"), c("_t").alias("t"))
    marked = rows.where("kind = 1").select(*keys, c("n").alias("seq"), "t", "labelled")
    lost = points.where("t IS NULL").select(*keys, "seq", "t", F.lit(False).alias("labelled"))
    taken = marked.unionByName(lost).join(renamed, [*same, c("seq") == c("_s")], "left").select(*keys, "seq", "t", c("_p").alias("priority"), "labelled")
    return matched, taken
