"""Receipts: the identifiers seen so far, with a Bloom filter for each cell of them, so that a batch reads filters instead of history.

An identifier's hash names its bucket (a folder), its cell in the bucket and HASHES bits of the cell's filter of BITS bits. A batch of identifiers
reads the filters of its own cells only: where one of an identifier's bits is missing it is new, and no receipt is read for it. The others may
be known; receipts are read of their buckets alone, and there of their hashes' row groups (files are sorted by hash). Filters are built and merged by Spark's own
bitmap aggregates. A cell is meant for CELL identifiers; `capacity` says for how many identifiers there are cells.

What a batch reads doesn't follow the number of identifiers stored, as long as the capacity holds: a filter for each cell that it touches, and receipts
for identifiers that are known or hit by chance (about one in a hundred). Beyond the capacity more is read, nothing is wrong; `grow` deals the
cells anew for another capacity.

A batch's receipts and filters are a run: two folders that become visible together, when the list of runs that names them is renamed into
place. A repeated batch finds its run and gives the same result. FOLD runs of one tier are folded into a run of the next, so that there are few runs and
each receipt is rewritten a logarithmic number of times. One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS, HASHES, CELL = 32_768, 6, 3_000
#: Folders until they are folded into one.
FOLD = 16


class Receipts:
    def __init__(self, spark: SparkSession, root: str, capacity: int = 10_000_000, buckets: int = 64):
        """capacity and buckets hold for a new store; one that exists keeps its own."""
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.list = self._latest()
        if self.list is None:
            self._publish({"number": 0, "cells": max(1, -(-capacity // CELL)), "buckets": buckets, "runs": []})
        #: Files of receipts and of filters that the last merge read.
        self.files_read: dict[str, int] = {}

    def _path(self, p: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(p)

    def _latest(self) -> dict | None:
        at = self._path(f"{self.root}/lists")
        names = sorted(n for s in self._fs.listStatus(at) if (n := s.getPath().getName()).endswith(".json")) if self._fs.exists(at) else []
        if not names:
            return None
        stream = self._fs.open(self._path(f"{self.root}/lists/{names[-1]}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, new: dict) -> None:
        folder, name = f"{self.root}/lists", f"{new['number']:012d}.json"
        self._fs.mkdirs(self._path(folder))
        out = self._fs.create(self._path(f"{folder}/.{name}.tmp"), True)
        try:
            out.write(bytearray(json.dumps(new).encode()))
        finally:
            out.close()
        if not self._fs.rename(self._path(f"{folder}/.{name}.tmp"), self._path(f"{folder}/{name}")):
            raise OSError(f"could not publish {name}")
        self._fs.delete(self._path(f"{folder}/{new['number'] - 8:012d}.json"), False)
        self.list = new

    def _keyed(self, ids: DataFrame) -> DataFrame:
        """id, h (a hash), bucket and cell; the cell follows from the hash's upper half."""
        cell = F.pmod(F.shiftrightunsigned("h", 32), F.lit(self.list["cells"]))
        rows = ids.withColumn("h", F.xxhash64("id")).withColumn("cell", cell)
        return rows.withColumn("bucket", F.pmod("cell", F.lit(self.list["buckets"])).cast("int"))

    @staticmethod
    def _bits() -> Column:
        """The places of an identifier's bits: two hashes combined."""
        other = F.xxhash64("id", F.lit(1))
        return F.array(*(F.pmod(F.col("h").bitwiseAND(F.lit(0x7FFFFFFF)) + F.lit(i) * other.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(BITS)) for i in range(HASHES)))

    def _filters(self, keyed: DataFrame) -> DataFrame:
        return keyed.select("bucket", "cell", F.explode(self._bits()).alias("bit")).groupBy("bucket", "cell").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def _read(self, what: str, schema: str, buckets: list[int]) -> DataFrame:
        """The rows of some buckets; lists and reads only their folders."""
        folders = [f"{self.root}/{what}/{run}/bucket={b}" for run, _ in self.list["runs"] for b in buckets]
        folders = [f for f in folders if self._fs.exists(self._path(f))]
        out = self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
        self.files_read[what] = len(out.inputFiles()) if folders else 0
        return out

    def ids(self) -> DataFrame:
        return self._read("ids", "id string, h long", list(range(self.list["buckets"])))

    def _write(self, rows: DataFrame, run: str) -> None:
        """The two folders of a run, from its receipts (id, h, bucket, cell)."""
        rows.select("id", "h", "cell", "bucket").repartition("bucket").sortWithinPartitions("bucket", "h").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/ids/{run}")
        held = self.spark.read.schema("id string, h long, cell long, bucket int").parquet(f"{self.root}/ids/{run}")
        self._filters(held).repartition("bucket").sortWithinPartitions("bucket", "cell").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/filters/{run}")

    def known(self, ids: DataFrame) -> DataFrame:
        """Those of the distinct identifiers (id, h, bucket, cell) that there is a receipt for."""
        self.files_read = {"filters": 0, "ids": 0}
        touched = [r.bucket for r in ids.select("bucket").distinct().collect()]  # a row a bucket
        filters = self._read("filters", "cell long, bits binary", touched)
        filters = filters.join(F.broadcast(ids.select("cell").distinct()) if ids.limit(1_000_001).count() <= 1_000_000 else ids.select("cell").distinct(), "cell", "left_semi").groupBy("cell").agg(F.bitmap_or_agg("bits").alias("bits"))
        byte = lambda i: F.conv(F.hex(F.substring("bits", (F.shiftright(i, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        has = lambda i: F.getbit(byte(i), i.bitwiseAND(F.lit(7)).cast("int")) == 1
        maybe = ids.join(filters, "cell").where(F.forall(self._bits(), has)).select(*ids.columns)
        hit = [r.bucket for r in maybe.select("bucket").distinct().collect()]
        receipts = self._read("ids", "id string, h long", hit)
        return maybe.join(receipts, ["h", "id"], "left_semi")

    def merge(self, ids: DataFrame, batch: str) -> DataFrame:
        """Adds the identifiers (column id; compared in any case) that are new and returns them; those of a batch merged before again."""
        run, mark = f"batch={batch}", self._path(f"{self.root}/merged/{batch}")
        if not self._fs.exists(mark):
            if [run, 0] not in self.list["runs"]:
                staging = f"{self.root}/_staging/{batch}"
                self._keyed(ids.where("id IS NOT NULL").select(F.lower("id").alias("id")).distinct()).write.mode("overwrite").parquet(staging)
                distinct = self.spark.read.schema("id string, h long, cell long, bucket int").parquet(staging)
                self._write(distinct.join(self.known(distinct).select("h", "id"), ["h", "id"], "left_anti"), run)
                self._publish({**self.list, "number": self.list["number"] + 1, "runs": [*self.list["runs"], [run, 0]]})
                self._fs.delete(self._path(staging), True)
            self._fs.create(mark, True).close()
            self.fold()
        return self.spark.read.schema("id string").option("recursiveFileLookup", "true").parquet(f"{self.root}/ids/{run}")

    def fold(self) -> None:
        """FOLD runs of a tier become one of the next; the receipts of batches stay for their repetition, until they are cleaned up."""
        for tier in sorted({t for _, t in self.list["runs"]}):
            runs = [r for r, t in self.list["runs"] if t == tier]
            if len(runs) >= FOLD:
                number = self.list["number"] + 1
                self._write(self._rows(runs), f"tier{tier + 1}-{number}")
                self._publish({**self.list, "number": number, "runs": [*(x for x in self.list["runs"] if x[1] != tier), [f"tier{tier + 1}-{number}", tier + 1]]})

    def _rows(self, runs: list[str]) -> DataFrame:
        return self._keyed(self.spark.read.schema("id string").option("recursiveFileLookup", "true").parquet(*(f"{self.root}/ids/{r}" for r in runs)))

    def grow(self, capacity: int) -> None:
        """Cells for another number of identifiers: everything is dealt anew, once."""
        runs, before, number = [r for r, _ in self.list["runs"]], self.list, self.list["number"] + 1
        self.list = {**before, "cells": max(1, -(-capacity // CELL))}
        try:
            rows = self._rows(runs) if runs else None
            if rows is not None:
                self._write(rows, f"all-{number}")
        except BaseException:
            self.list = before
            raise
        self._publish({**self.list, "number": number, "runs": [[f"all-{number}", max(t for _, t in before["runs"])]] if runs else []})
