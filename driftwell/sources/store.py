"""The idempotent events store: receipts and events commit together, the first payload of an identifier wins.

Each batch is a folder of its number in both tables; a manifest file, written last under its final name, publishes both at once.
Readers see published batches only, and a repeated batch number rewrites its own folders, so a replay after any crash gives
the same tables. Events are partitioned by date and sorted for latest-first access per service and route.

Manifests are folded into one file every FOLD batches, so that opening the store reads a bounded number of files. What is new in a batch is
found by sending the batch's identifiers to the receipts (if there are at most BATCH_IDS): one column of history is read, none of it is shuffled.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import first_per_id
from ..schemas import EVENTS_TABLE, RECEIPTS, assert_schema


#: Loose manifests that are folded into one, and identifiers of a batch that are broadcast.
FOLD, BATCH_IDS = 64, 1_000_000


class EventStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{p}" if p else self.root)

    def _load(self, path) -> dict:
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, name: str, content: dict) -> None:
        self._fs.mkdirs(self._path("manifests"))
        held = self._path(f"manifests/.{name}.tmp")
        out = self._fs.create(held, True)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        if not self._fs.rename(held, self._path(f"manifests/{name}.json")):
            raise OSError(f"could not publish {name}")

    def published(self) -> dict[int, dict]:
        """Batch number to its result: the latest fold and the loose manifests since."""
        if not self._fs.exists(self._path("manifests")):
            return {}
        names = [n[:-5] for s in self._fs.listStatus(self._path("manifests")) if (n := s.getPath().getName()).endswith(".json")]
        folds = sorted((n for n in names if n.startswith("fold-")), key=lambda n: int(n[5:]))
        out = {int(k): v for k, v in self._load(self._path(f"manifests/{folds[-1]}.json")).items()} if folds else {}
        loose = [int(n) for n in names if n.isdigit() and int(n) not in out]
        out.update({n: self._load(self._path(f"manifests/{n}.json")) for n in loose})
        return out

    def _fold(self, done: dict[int, dict]) -> None:
        """Fold the loose manifests; a crash on the way leaves some that the fold holds already."""
        names = {s.getPath().getName() for s in self._fs.listStatus(self._path("manifests"))}
        loose = [n for n in names if n[:-5].isdigit()]
        if len(loose) >= FOLD:
            name = f"fold-{max(done)}"
            if f"{name}.json" not in names:
                self._publish(name, done)
            for n in [*loose, *(n for n in names if n.startswith("fold-") and n != f"{name}.json")]:
                self._fs.delete(self._path(f"manifests/{n}"), False)

    def _read(self, name: str, schema, below: int | None = None) -> DataFrame:
        found = [f"{self.root}/{name}/batch={b}" for b, m in sorted(self.published().items()) if (below is None or b < below) and m["inserted"]]
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*found).select(*schema.fieldNames())

    def receipts(self, below: int | None = None) -> DataFrame:
        return self._read("receipts", RECEIPTS, below)

    def events(self) -> DataFrame:
        return self._read("events", EVENTS_TABLE)

    def verify(self) -> None:
        assert_schema(self.receipts(), RECEIPTS)
        assert_schema(self.events(), EVENTS_TABLE)

    def persist(self, batch: DataFrame, number: int, order: tuple[str, ...] = ("partition", "offset"), failpoint=None) -> dict:
        """Insert what is new of a batch of validated rows; returns {"total", "inserted", "conflicts"}. `failpoint` is called after the commit."""
        done = self.published()
        if number not in done:
            total, batch = batch.count(), batch.withColumn("event_id", F.lower("event_id"))
            first = first_per_id(batch, "event_id", list(order))
            new = self._without_known(first, batch.select("event_id"), total, number).select(*EVENTS_TABLE.fieldNames())
            events = f"{self.root}/events/batch={number}"
            new.withColumn("event_date", F.to_date("event_time")).repartition("event_date", F.pmod(F.xxhash64("event_id"), F.lit(4))).sortWithinPartitions("event_date", "service_name", "route", F.desc("event_time")).write.mode("overwrite").partitionBy("event_date").parquet(events)
            stored = self.spark.read.schema(EVENTS_TABLE).parquet(events)
            stored.select("event_id", F.current_timestamp().alias("first_seen_at")).write.mode("overwrite").parquet(f"{self.root}/receipts/batch={number}")
            inserted = stored.count()
            result = {"total": total, "inserted": inserted, "conflicts": total - inserted}
            self._publish(str(number), result)
            self._fold({**done, number: result})
            done = {number: result}
        if failpoint is not None:
            failpoint(number)
        return done[number]

    def _without_known(self, first: DataFrame, ids: DataFrame, total: int, number: int) -> DataFrame:
        known = self.receipts(below=number).select("event_id")
        if total <= BATCH_IDS or (ids := first.select("event_id")).limit(BATCH_IDS + 1).count() <= BATCH_IDS:
            hashes = F.broadcast(ids.select(F.xxhash64("event_id").alias("_hash")).distinct())  # one long each; who shares a hash falls out below
            known = known.withColumn("_hash", F.xxhash64("event_id")).join(hashes, "_hash", "left_semi").drop("_hash")
        return first.join(known, "event_id", "left_anti")

    def latest(self, k: int = 1) -> DataFrame:
        """The k latest events per service and route."""
        from pyspark.sql import Window as W

        w = W.partitionBy("service_name", "route").orderBy(F.desc("event_time"), "event_id")
        return self.events().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
