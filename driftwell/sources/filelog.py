"""Topics as append-only folders of Parquet files with the columns of Spark's Kafka source, or Kafka itself where its connector is.

Appending numbers the rows of each partition from the partition's next offset; every append is one folder that becomes
visible by a rename, so that readers never see half of it and a repeated append of the same batch changes nothing. The next offsets
stand in a small head file that is created before the rename, by one writer at a time, so an append reads nothing
of what the log holds and several jobs may append to one topic. Rows are sorted by ranges and numbered by a running count over the ranges: no task sorts a whole partition.

A file holds a range of the append's order with the rows of all partitions in it, and files are stamped in that order: a stream takes them by time, so
its micro-batches follow the order of the appends, wherever a trigger cuts.
"""

from __future__ import annotations

import json
import os
import time

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import LOG, PARTITIONS
from ..tables import in_ranges, stamp_in_order, write_in_order


#: Records of a log file at most, and files that a trigger reads by default: together they bound the records of a micro-batch.
FILE_RECORDS, TRIGGER_FILES = 100_000, 8


class FileLog:
    def __init__(self, spark: SparkSession, root: str, claim_wait_s: float = 600.0):
        """claim_wait_s: how long an append waits for another writer's batch that has its offsets and isn't published yet."""
        self.spark, self.root, self.claim_wait_s = spark, root.rstrip("/"), claim_wait_s
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(p)

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def batches(self, topic: str) -> list[str]:
        if not self._fs.exists(self._path(self.path(topic))):
            return []
        return sorted(n for s in self._fs.listStatus(self._path(self.path(topic))) if (n := s.getPath().getName()).startswith("batch="))

    def read(self, topic: str) -> DataFrame:
        """All records so far; null keys and values are empty bytes."""
        found = self.batches(topic)
        rows = self.spark.read.schema(LOG).parquet(*(f"{self.path(topic)}/{b}" for b in found)) if found else self.spark.createDataFrame([], LOG)
        return rows.withColumns({c: F.coalesce(c, F.lit(b"")) for c in ("key", "value")})

    def read_range(self, topic: str, partition: int, start: int, end: int) -> DataFrame:
        """Offsets start to end - 1 of a partition; a gap is an error, an empty range is not."""
        rows = self.read(topic).where((F.col("partition") == partition) & (F.col("offset") >= start) & (F.col("offset") < end))
        n, low, high = rows.agg(F.count_distinct("offset"), F.min("offset"), F.max("offset")).first()
        if n != end - start or n and (low != start or high != end - 1):
            raise ValueError(f"offset gap in {topic}[{partition}]: {n} records in {start}..{end}")
        return rows.orderBy("offset")

    def read_stream(self, topic: str, max_records: int | None = None) -> DataFrame:
        """A stream of the topic; a micro-batch holds at most max_records, in whole files of at most FILE_RECORDS, and one file at least."""
        self._fs.mkdirs(self._path(self.path(topic)))
        files = TRIGGER_FILES if max_records is None else max(1, max_records // FILE_RECORDS)
        return self.spark.readStream.schema(LOG).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).parquet(self.path(topic))

    def _published(self, topic: str, batch: str) -> bool:
        return self._fs.exists(self._path(f"{self.path(topic)}/batch={batch}"))

    def _heads(self, topic: str) -> list[tuple[int, dict]]:
        """(number, content) of the heads, latest first; one that is being written has no content yet."""
        folder = self._path(f"{self.root}/_heads/{topic}")
        names = sorted((s.getPath().getName() for s in self._fs.listStatus(folder)), reverse=True) if self._fs.exists(folder) else []
        out = []
        for name in (n for n in names if n.endswith(".json")):
            stream = self._fs.open(self._path(f"{self.root}/_heads/{topic}/{name}"))
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            out.append((int(name[:-5]), json.loads(text) if text.endswith("}") else {}))
            if len(out) == 2:
                break
        return out

    def _create(self, path: str, content: str) -> bool:
        """Create a file unless it is there; of several writers one succeeds. Its content may be seen late."""
        at = self._path(path)
        if (at.toUri().getScheme() or self._fs.getUri().getScheme()) == "file":  # Hadoop's local files aren't created atomically
            try:
                held = os.open(at.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(held, "w") as out:
                out.write(content)
            return True
        try:
            out = self._fs.create(at, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName() or self._fs.exists(at):
                return False
            raise
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()
        return True

    def _claim(self, topic: str, batch: str, counts: dict[int, int]) -> dict[int, int]:
        """The first offset of each partition for this batch, claimed for it alone.

        The next head is created only if nobody else has created it. A claim whose batch isn't published yet is waited for; this batch's own,
        left by a writer that failed, is used again. So offsets are distinct and gapless however many writers there are.
        """
        self._fs.mkdirs(self._path(f"{self.root}/_heads/{topic}"))
        until = time.monotonic() + self.claim_wait_s
        while True:
            heads = self._heads(topic)
            number, head = heads[0] if heads else (-1, {"batch": None, "next": {}, "first": {}})
            if head.get("batch") == batch:
                return {int(p): n for p, n in head["first"].items()}
            if head and (head["batch"] is None or self._published(topic, head["batch"])):
                first = {int(p): n for p, n in head["next"].items()}
                after = {p: first.get(p, 0) + counts.get(p, 0) for p in {*first, *counts}}
                if self._create(f"{self.root}/_heads/{topic}/{number + 1:012d}.json", json.dumps({"batch": batch, "first": first, "next": after})):
                    self._fs.delete(self._path(f"{self.root}/_heads/{topic}/{number - 7:012d}.json"), False)
                    return first
            elif time.monotonic() > until:
                raise TimeoutError(f"batch {head.get('batch')!r} has claimed offsets of {topic} and isn't published: run it again, or release() it if it is given up")
            else:
                time.sleep(0.05)

    def release(self, topic: str) -> None:
        """Give up the latest claim of a topic, whose writer is known to be gone for good; an unpublished claim only."""
        heads = self._heads(topic)
        if heads and not (heads[0][1] and self._published(topic, heads[0][1]["batch"])):
            self._fs.delete(self._path(f"{self.root}/_heads/{topic}/{heads[0][0]:012d}.json"), False)

    def append(self, records: DataFrame, topic: str, batch: str, order: list[str] | None = None) -> None:
        """records: key, value and optionally partition (else by the key's hash); `batch` names the append."""
        final = self._path(f"{self.path(topic)}/batch={batch}")
        if self._fs.exists(final):
            return
        order = order or ["key", "value"]
        part = F.col("partition") if "partition" in records.columns else F.pmod(F.xxhash64("key"), F.lit(PARTITIONS.get(topic, 1))).cast("int")
        own = {c: c if c in ("partition", "key", "value") else f"_order{i}" for i, c in enumerate(order)}
        rows = records.select(part.cast("int").alias("partition"), "key", "value", *(F.col(c).alias(n) for c, n in own.items() if n != c))
        order, order_only = list(own.values()), [n for c, n in own.items() if n != c]
        given = f"{self.root}/_staging/{topic}-{batch}-given"
        rows.write.mode("overwrite").parquet(given)  # a sort by ranges takes its input twice, and records may be dear to make
        rows = self.spark.read.schema(rows.schema).parquet(given)
        held = f"{self.root}/_staging/{topic}-{batch}"
        rows = in_ranges(rows, order, rows.count(), FILE_RECORDS).sortWithinPartitions("partition", *order).withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", 33)).persist(StorageLevel.DISK_ONLY)
        try:
            self._publish(rows, topic, batch, order, order_only, held, final)
        finally:
            rows.unpersist()
        self._fs.delete(self._path(given), True)

    def _publish(self, rows: DataFrame, topic: str, batch: str, order: list[str], order_only: list[str], held: str, final) -> None:
        """Numbers rows that lie in ranges of the order, and writes each range as it lies: one shuffle orders an append."""
        runs = rows.groupBy("partition", "_task").agg(F.min("_at").alias("_low"), F.count("*").alias("_n"))
        counts = {r.partition: r.n for r in runs.groupBy("partition").agg(F.sum("_n").alias("n")).collect()}  # a row per log partition
        first = self._claim(topic, batch, counts)
        w = W.partitionBy("partition").orderBy("_task")
        base = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p, n in first.items() for x in (p, n))), F.col("partition")), F.lit(0)) if first else F.lit(0)
        runs = runs.select("partition", "_task", "_low", "_n", (F.sum("_n").over(w) - F.col("_n") + base).cast("long").alias("_base"))
        out = rows.join(F.broadcast(runs.drop("_n")), ["partition", "_task"])  # a row per task of the sort and log partition
        out = out.select("key", "value", F.lit(topic).alias("topic"), "partition", (F.col("_base") + F.col("_at") - F.col("_low")).alias("offset"), F.current_timestamp().alias("timestamp"), *order_only)
        began = time.time()
        write_in_order(out, held, order, FILE_RECORDS, drop=order_only)
        stamp_in_order(self.spark, held, began)
        self._fs.mkdirs(self._path(self.path(topic)))
        if not self._fs.rename(self._path(held), final):
            raise OSError(f"could not publish {final}")

    def next_offsets(self, topic: str) -> DataFrame:
        from ..operators.reconcile import next_offsets

        return next_offsets(self.read(topic))


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_records: int | None = None) -> DataFrame:
    """The same columns from Kafka; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("failOnDataLoss", "true")
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load().select(*LOG.fieldNames())


def kafka_write(batch: DataFrame, servers: str, topic: str) -> None:
    """An acknowledged, idempotent write of key and value."""
    batch.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", "all").option("kafka.enable.idempotence", "true").option("kafka.compression.type", "lz4").option("kafka.linger.ms", "5").save()
