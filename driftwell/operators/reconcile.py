"""Reconciliation: offsets, lag, expected against stored, multiset equality, conservation laws, status texts."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import uuid_from_index
from ..tables import table
from .scan import running

#: Rows of a running count that are broadcast at most.
SLICES = 1_000_000


def first_per_id(events: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """The first row of each identifier (values compare in any case) by the given order.

    Spark limits each task's groups to their first row before the shuffle (a window group limit), so an identifier with very many copies stays
    small, and rows are sorted, not packed into an aggregate's buffer.
    """
    order_of = W.partitionBy(F.lower(id_col)).orderBy(*order)
    return events.withColumn("_first", F.row_number().over(order_of)).where("_first = 1").drop("_first")


def numbered(df: DataFrame, order: list[str], slice_of: Column, by: list[str] | None = None, name: str = "seq") -> DataFrame:
    """Adds numbers from 0 in the given order (within `by`) without sorting everything in one task.

    slice_of must not decrease along the order (a day, say): rows are numbered inside slices, slices by a running count. There
    is one row per slice in that count, which is broadcast if there are at most SLICES of them.
    """
    by = by or []
    rows = df.withColumn("_slice", slice_of).withColumn("_n", F.row_number().over(W.partitionBy(*by, "_slice").orderBy(*order)))
    sizes = rows.groupBy(*by, "_slice").agg(F.count("*").alias("_size"))
    run = W.partitionBy(*(by or [F.lit(0)])).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(*by, "_slice", F.coalesce(F.sum("_size").over(run), F.lit(0)).alias("_before"))
    before = F.broadcast(before) if before.limit(SLICES + 1).count() <= SLICES else before
    return rows.join(before, [*by, "_slice"]).withColumn(name, (F.col("_before") + F.col("_n") - 1).cast("long")).drop("_slice", "_n", "_before")


def next_offsets(records: DataFrame) -> DataFrame:
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"), F.count("*").alias("records"))


def offset_gaps(records: DataFrame, slice_size: int = 1_000_000) -> DataFrame:
    """Rows whose offset doesn't follow the one before in their partition, found per slice of offsets and between slices."""
    key = ["topic", "partition"]
    rows = records.select(*key, "offset").withColumn("_slice", F.floor(F.col("offset") / slice_size))
    inside = rows.withColumn("expected", F.lag("offset").over(W.partitionBy(*key, "_slice").orderBy("offset")) + 1)
    ends = rows.groupBy(*key, "_slice").agg(F.min("offset").alias("offset"), F.max("offset").alias("_last"))
    between = ends.withColumn("expected", F.lag("_last").over(W.partitionBy(*key).orderBy("_slice")) + 1)
    return inside.select(*key, "offset", "expected").unionByName(between.select(*key, "offset", "expected")).where("offset <> expected")


def batches(records: DataFrame, cap: int = 500) -> DataFrame:
    """Adds `batch`: a partition's rows by offset in groups of at most `cap`, counted from its first row.

    Without gaps the offset itself says which; only partitions with gaps need their rows numbered.
    """
    key = ["topic", "partition"]
    low = records.groupBy(*key).agg(F.min("offset").alias("_low"), (F.max("offset") - F.min("offset") + 1 == F.count("*")).alias("_dense"))
    rows = records.join(F.broadcast(low), key)  # a row per log partition
    dense = rows.where("_dense").withColumn("batch", F.floor((F.col("offset") - F.col("_low")) / cap))
    if low.where("NOT _dense").isEmpty():
        return dense.drop("_low", "_dense")
    gappy = numbered(rows.where("NOT _dense"), ["offset"], F.floor(F.col("offset") / 1_000_000), key, "_seq")
    return dense.unionByName(gappy.withColumn("batch", F.floor(F.col("_seq") / cap)).drop("_seq")).drop("_low", "_dense")


def timed_batches(records: DataFrame, cap: int = 500, wait_us: int = 10_000, clock: str = "clock_us", by: tuple[str, ...] = ("topic", "partition"), order: tuple[str, ...] = ("offset",)) -> DataFrame:
    """Adds `batch`: the rows of each reader (`by`) in their order; a batch ends with its cap-th row, or before a row that comes wait_us or more
    after its first. A reader of several partitions has them in the order of arrival.

    Where a batch begins depends on the one before, so a reader's rows are read in order, by a pass that holds three numbers.
    """
    import pyarrow as pa
    from pyspark.sql.types import LongType, StructField, StructType

    names = records.columns
    at = [names.index(n) for n in (*by, clock)]

    def run(found):
        now, batch, size, begin = None, 0, 0, 0
        for rows in found:
            out = []
            for *reader, t in zip(*(rows.column(i).to_pylist() for i in at), strict=True):
                if reader != now:
                    now, batch, size, begin = reader, 0, 0, t
                elif size >= cap or t - begin >= wait_us:
                    batch, size, begin = batch + 1, 0, t
                size += 1
                out.append(batch)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.int64())], names=[*rows.schema.names, "batch"])

    kind = StructType([*records.schema.fields, StructField("batch", LongType())])
    return records.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, kind)


def moved_offsets(before: DataFrame, after: DataFrame, ends: DataFrame) -> DataFrame:
    """topic, partition, before, after, moved, lag: committed offsets around a crash, which must not have moved, against the log's ends."""
    key = ["topic", "partition"]
    both = ends.select(*key, F.col("next_offset").alias("_end")).join(before.select(*key, F.col("value").alias("before")), key, "left").join(after.select(*key, F.col("value").alias("after")), key, "left")
    return both.select(*key, "before", "after", (~F.col("before").eqNullSafe(F.col("after"))).alias("moved"), (F.col("_end") - F.coalesce("after", F.lit(0))).alias("lag"))


def offset_base(kind: Column, value: Column, low: Column, high: Column) -> Column:
    """Where a group would go on: a committed offset in range, else the range's start; unknown positions are null."""
    return F.when(kind == "offset", F.when(value.between(low, high), value).otherwise(low)).when(kind.isin("beginning", "invalid"), low).when(kind == "end", high)


def consumer_lag(committed: DataFrame, watermarks: DataFrame) -> DataFrame:
    """One row: partitions, lag; -1 when any partition's position is unknown. committed: topic, partition, kind, value."""
    both = watermarks.join(committed, ["topic", "partition"], "left")
    base = offset_base(F.col("kind"), F.col("value"), F.col("low"), F.col("high"))
    per = both.select(F.greatest(F.col("high") - base, F.lit(0)).alias("lag"))
    return per.agg(F.count("*").alias("partitions"), F.when(F.count_if(F.col("lag").isNull()) > 0, -1).otherwise(F.coalesce(F.sum("lag"), F.lit(-1))).cast("long").alias("lag"))


def expected_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(uuid_from_index("id").alias("event_id"))


def stored_counts(expected: DataFrame, receipts: DataFrame, events: DataFrame) -> DataFrame:
    """One row: receipts, events, distinct_events, missing_receipts, missing_events."""
    r, e = receipts.agg(F.count("*").alias("receipts")), events.agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("distinct_events"))
    mr = expected.join(receipts, "event_id", "left_anti").agg(F.count("*").alias("missing_receipts"))
    me = expected.join(events, "event_id", "left_anti").agg(F.count("*").alias("missing_events"))
    return r.join(e).join(mr).join(me)  # four single rows


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side beyond the other's, with multiplicity, and the side; empty iff the multisets are equal.

    One aggregation over the union instead of two exceptAll.
    """
    cols = a.columns
    both = a.withColumn("_s", F.lit(1)).unionByName(b.withColumn("_s", F.lit(-1)))
    left = both.groupBy(*cols).agg(F.sum("_s").alias("_d")).where("_d <> 0")
    return left.select(*cols, F.when(F.col("_d") > 0, "left").otherwise("right").alias("side"), F.abs("_d").alias("copies"))


#: Children of a node of the hash tree, as bits of the hash; its depth; and rows a node from which on its children are looked at.
FAN_BITS, DEPTH, NODE_ROWS = 8, 3, 100_000


def _sums(rows: DataFrame, level: int, sign: int) -> DataFrame:
    """Order-insensitive sums of the rows' hashes by node of a level, with a sign for the side: all zero iff the node's multisets are equal, but for
    odds of 2^-64 and less. Sums of 32-bit halves, in decimals, can't overflow."""
    node = F.shiftrightunsigned("_h", 64 - FAN_BITS * (level + 1))
    half = lambda c, low: (c.bitwiseAND(F.lit(0xFFFFFFFF)) if low else F.shiftrightunsigned(c, 32)).cast("decimal(18,0)") * sign
    return rows.select(node.alias("node"), F.lit(sign).alias("n"), *(half(F.col(c), low).alias(f"{c}{low:d}") for c in ("_h", "_g") for low in (True, False)))


def hash_tree_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """As multiset_difference, by a hash tree: sums of hashes are compared level by level, and only rows in leaves that differ are shuffled.

    A level's sums are combined in the tasks, so what moves is a row for each task and node, whatever the number of rows; nodes that are
    equal are never looked at again. Equal tables are told by one pass over each. The levels end at leaves of about NODE_ROWS rows or at
    DEPTH. At most 2^(FAN_BITS * DEPTH) nodes can differ; below a level, those are broadcast while they are at most SLICES.
    """
    cols = a.columns
    c = F.col

    def hashed(df: DataFrame) -> DataFrame:  # nulls count: a hash skips them, so their places are part of it
        nulls = F.concat(*(F.when(c(f"`{x}`").isNull(), "1").otherwise("0") for x in cols))
        own = [c(f"`{x}`") for x in cols]
        return df.select(*cols).withColumns({"_h": F.xxhash64(nulls, *own), "_g": F.xxhash64(F.lit(1), *own, nulls)})

    sides = [hashed(a), hashed(b.select(*cols))]
    for level in range(DEPTH):
        both = _sums(sides[0], level, 1).unionAll(_sums(sides[1], level, -1))
        nodes = both.groupBy("node").agg(F.sum("n").alias("n"), F.sum(F.abs("n")).alias("rows"), *(F.sum(x).alias(x) for x in ("_h1", "_h0", "_g1", "_g0")))
        uneven = table(nodes.where("n <> 0 OR _h1 <> 0 OR _h0 <> 0 OR _g1 <> 0 OR _g0 <> 0").select("node", "rows"), "uneven")
        n, rows = uneven.agg(F.count("*"), F.sum("rows")).first()
        if not n:
            return a.limit(0).select(*cols).withColumns({"side": F.lit(""), "copies": F.lit(0).cast("long")})
        if n > SLICES:
            break
        # the nodes that differ; their rows are all that is read on
        keep = F.broadcast(uneven.select("node"))
        sides = [s.withColumn("node", F.shiftrightunsigned("_h", 64 - FAN_BITS * (level + 1))).join(keep, "node", "left_semi").drop("node") for s in sides]
        if rows / n <= NODE_ROWS:
            break
    return multiset_difference(*(s.select(*cols) for s in sides))


#: Identifiers of a bitmap.
BITMAP = 32_768


def bitmaps(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """range (number of BITMAP identifiers), bits, n: which identifiers (whole numbers from 0) there are, a row for each range that has some."""
    i = F.col(id_col)
    rows = ids.where(i >= 0).select(F.bitmap_bucket_number(i + 1).alias("range"), F.bitmap_bit_position(i + 1).alias("bit"))
    return rows.groupBy("range").agg(F.bitmap_construct_agg("bit").alias("bits")).select((F.col("range") - 1).alias("range"), "bits", F.bitmap_count("bits").alias("n"))


def missing_ranges(ids: DataFrame, n: Column, id_col: str = "id", bounds: DataFrame | None = None) -> DataFrame:
    """first_id, last_id, ids: the gaps of identifiers among 0 .. n - 1, by bitmaps; n is an aggregate over ids (or over bounds).

    Whole ranges without any identifier aren't spelled out, nor are full ones; no identifier passes the driver, and none is joined.
    """
    c = F.col
    found = bitmaps(ids, id_col)
    limit = (ids if bounds is None else bounds).agg(n.cast("long").alias("limit"))  # a single row
    # gaps inside ranges that have some: maximal stretches of zero bits, out of their first and last places
    bit = lambda i: F.getbit(F.conv(F.hex(F.substring("bits", (F.shiftright(i, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int"), i.bitwiseAND(F.lit(7)).cast("int"))
    places = F.sequence(F.lit(0), F.lit(BITMAP - 1))
    some = found.where(c("n") < BITMAP).select("range", F.filter(places, lambda i: bit(i) == 0).alias("zeros"))
    edges = some.select("range", F.filter(F.transform("zeros", lambda z, k: F.when((k == 0) | (F.get("zeros", k - 1) != z - 1), z)), lambda z: z.isNotNull()).alias("firsts"), F.filter(F.transform("zeros", lambda z, k: F.when((k == F.size("zeros") - 1) | (F.get("zeros", k + 1) != z + 1), z)), lambda z: z.isNotNull()).alias("lasts"))
    inside = edges.select("range", F.explode(F.arrays_zip("firsts", "lasts")).alias("g")).select((c("range") * BITMAP + c("g.firsts")).alias("first_id"), (c("range") * BITMAP + c("g.lasts")).alias("last_id"))
    # ranges without any: between neighbouring ranges that have some, and at the end
    ends = limit.select(F.ceil(c("limit") / BITMAP).alias("range"))
    known = running(found.select("range").unionAll(ends), ["range"], "max", "range", "_before")
    holes = known.withColumn("_before", F.coalesce("_before", F.lit(-1))).where("range > _before + 1").select(((c("_before") + 1) * BITMAP).alias("first_id"), (c("range") * BITMAP - 1).alias("last_id"))
    gaps = inside.unionAll(holes).join(F.broadcast(limit)).where("first_id < limit").select("first_id", F.least("last_id", c("limit") - 1).alias("last_id"))  # a single row
    # gaps that touch at the border of ranges are one
    touching = running(gaps, ["first_id"], "max", "last_id", "_before")
    touching = touching.withColumn("_begins", F.when(c("_before").isNull() | (c("_before") < c("first_id") - 1), c("first_id")))
    runs = running(touching.drop("_before"), ["first_id"], "max", "_begins", "_run", inclusive=True)
    return runs.groupBy(c("_run").alias("first_id")).agg(F.max("last_id").alias("last_id")).withColumn("ids", c("last_id") - c("first_id") + 1)


def stored_counts_dense(receipts: DataFrame, events: DataFrame, n: Column, id_col: str = "id") -> DataFrame:
    """As stored_counts for identifiers that are numbers among 0 .. n - 1 (n: an aggregate over the receipts), by bitmaps instead of anti-joins."""
    c = F.col
    limit = receipts.agg(n.cast("long").alias("limit"))  # a single row
    rows = receipts.select(c(id_col).alias("id"), F.lit(0).alias("kind")).unionByName(events.select(c(id_col).alias("id"), F.lit(1).alias("kind")))
    rows = rows.join(F.broadcast(limit), how="left")
    within = F.coalesce(c("id") < c("limit"), F.lit(False))
    per = rows.groupBy("kind", within.alias("within"), F.bitmap_bucket_number(c("id") + 1).alias("range")).agg(F.count("*").alias("rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(c("id") + 1))).alias("n"))
    total = lambda what, *when: F.coalesce(F.sum(F.when(reduce(lambda p, q: p & q, when), c(what))), F.lit(0)).cast("long")
    sums = per.agg(total("rows", c("kind") == 0).alias("receipts"), total("rows", c("kind") == 1).alias("events"), total("n", c("kind") == 1).alias("distinct_events"), total("n", c("kind") == 0, c("within")).alias("_r"), total("n", c("kind") == 1, c("within")).alias("_e"))
    out = limit.join(sums)  # two single rows
    return out.select("receipts", "events", "distinct_events", (c("limit") - c("_r")).alias("missing_receipts"), (c("limit") - c("_e")).alias("missing_events"))


def conservation(raw: Column, enriched: Column, dlq: Column, valid: Column, malformed: Column, acknowledged: Column) -> dict[str, Column]:
    return {"raw_is_enriched_plus_dlq": raw == enriched + dlq, "enriched_is_valid": enriched == valid, "dlq_is_malformed": dlq == malformed, "raw_is_acknowledged": raw == acknowledged}


def all_hold(checks: dict[str, Column]) -> Column:
    out = F.lit(True)
    for c in checks.values():
        out = out & F.coalesce(c, F.lit(False))
    return out


_HEADER = ["GROUP", "TOPIC", "PARTITION", "CURRENT-OFFSET", "LOG-END-OFFSET", "LAG"]


def group_status(lines: DataFrame, topic: str, partitions: int, group: str | None = None, caught_up: bool = True) -> DataFrame:
    """One row (committed, ends, lag, partitions, ok) from a consumer group's status lines (column `line`).

    ok: the header is there, every partition occurs once, numbers are numbers ("-" with end 0 counts as 0) and, with
    caught_up, nothing lags.
    """
    f = F.filter(F.split(F.trim("line"), r"\s+"), lambda x: x != "")
    got = lambda i: F.try_element_at(f, F.lit(i + 1))
    header = (got(0) == "GROUP") & (got(1) == "TOPIC")
    rows = lines.select(f.alias("f"), header.alias("is_header"), (header & (F.slice(f, 1, 6) == F.array(*map(F.lit, _HEADER)))).alias("good_header"))
    f = F.col("f")
    mine = (~F.col("is_header")) & (got(1) == topic)
    digits = lambda x: F.when(x.rlike("^[0-9]+$"), x.try_cast("bigint"))
    idle = (got(3) == "-") & (got(4) == "0") & (got(5) == "-")
    rows = rows.select(
        "is_header", "good_header", mine.alias("mine"), digits(got(2)).alias("p"), F.when(idle, 0).otherwise(digits(got(3))).alias("current"), F.when(idle, 0).otherwise(digits(got(4))).alias("end"), F.when(idle, 0).otherwise(digits(got(5))).alias("lag"), got(0).alias("g"),
    )
    bad = F.col("p").isNull() | (F.col("p") >= partitions) | F.col("current").isNull() | F.col("end").isNull() | F.col("lag").isNull()
    if group is not None:
        bad = bad | (F.col("g") != group)
    if caught_up:
        bad = bad | (F.col("current") != F.col("end")) | (F.col("lag") != 0)
    m = F.col("mine")
    ok = (F.count_if("good_header") > 0) & (F.count_if(F.col("is_header") & ~F.col("good_header")) == 0) & (F.count_if(m & bad) == 0) & (F.count_if(m) == partitions) & (F.count_distinct(F.when(m, F.col("p"))) == partitions)
    total = lambda c: F.coalesce(F.sum(F.when(m, F.col(c))), F.lit(0)).alias(c)
    return rows.agg(total("current"), total("end"), total("lag"), F.count_if(m).alias("partitions"), F.coalesce(ok, F.lit(False)).alias("ok"))


def loss_free(s: dict[str, Column], expected: Column) -> Column:
    """A run summary's exact, loss-free acknowledgement."""
    zero = [s[k] == 0 for k in ("invalid", "dropped", "dropped_full", "dropped_closed", "permanent_failures")]
    same = [s[k] == expected for k in ("attempted", "expected_attempted", "acknowledged", "queued")]
    out = F.lit(True)
    for c in zero + same:
        out = out & F.coalesce(c, F.lit(False))
    return out


def run_summary(metrics: DataFrame) -> DataFrame:
    """Adds dropped, acknowledged_events_per_second and valid to a run's counters."""
    c = F.col
    valid = (c("attempted") == c("expected_attempted")) & (c("invalid") == 0) & (c("dropped_full") == 0) & (c("dropped_closed") == 0) & (c("permanent_failures") == 0) & (c("acknowledged") == c("queued"))
    rate = F.when(c("elapsed_seconds") > 0, c("acknowledged") / c("elapsed_seconds")).otherwise(0.0)
    return metrics.withColumn("dropped", c("dropped_full") + c("dropped_closed")).withColumn("acknowledged_events_per_second", rate).withColumn("valid", valid)


def file_manifest(spark: SparkSession, path: str, expected: list[str] | None = None) -> DataFrame:
    """path (below the folder), type, bytes, sha256, of every file below path by name; with `expected`, of those paths only: a path without a file is of
    type "missing", a folder "unsupported". Empty files count. Names are listed on the driver, as Spark's readers do; contents are hashed in tasks.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
    rows = []
    if expected is None:
        found = fs.listFiles(root, True)
        while found.hasNext():
            f = found.next()
            rows.append((f.getPath().toUri().getPath().removeprefix(base), "file", f.getLen()))
    else:
        for name in sorted(set(expected)):
            at = spark._jvm.org.apache.hadoop.fs.Path(base + name)
            status = fs.getFileStatus(at) if fs.exists(at) else None
            rows.append((name, "missing" if status is None else "file" if status.isFile() else "unsupported", status.getLen() if status is not None and status.isFile() else None))
    listed = spark.createDataFrame(rows, "path string, type string, bytes long")
    full = [f"{path.rstrip('/')}/{name}" for name, kind, n in rows if kind == "file" and n]
    none = F.sha2(F.lit(""), 256)
    if not full:
        return listed.withColumn("sha256", F.when(F.col("type") == "file", none)).orderBy("path")
    name = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), f"^{re.escape(base)}", "")
    sums = spark.read.format("binaryFile").load([re.sub(r"([\\*?\[\]{}])", r"\\\1", f) for f in full]).select(name.alias("path"), F.sha2("content", 256).alias("_sum"))
    return listed.join(sums, "path", "left").select("path", "type", "bytes", F.when((F.col("type") == "file") & (F.col("bytes") == 0), none).otherwise(F.col("_sum")).alias("sha256")).orderBy("path")


def manifest_holds(manifest: DataFrame) -> bool:
    """Whether every path of a manifest is a file."""
    return manifest.where("type <> 'file'").isEmpty()


def write_report(report: DataFrame, path: str) -> str:
    """Writes a one-row table as a JSON object to a file that appears whole, and returns its text. More rows, or none, are an error."""
    rows = report.toJSON().take(2)
    if len(rows) != 1:
        raise ValueError(f"a report has one row, not {'several' if rows else 'none'}")
    spark = report.sparkSession
    at, held = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(held, True)
    try:
        out.write(bytearray((rows[0] + "\n").encode()))
    finally:
        out.close()
    fs.delete(at, False)
    if not fs.rename(held, at):
        raise OSError(f"could not write {path}")
    return rows[0]


def redact(config: Column, pattern: str = "(?i)(password|secret|token|key)") -> Column:
    """A map of settings with the values of telling keys hidden."""
    return F.transform_values(config, lambda k, v: F.when(k.rlike(pattern), "<redacted>").otherwise(v))
