"""Receipts, hash trees and bitmaps against plain readings, and what they read."""

import random

import pytest
from pyspark.sql import functions as F

from driftwell.functions.expr import index_of_uuid, uuid_from_index
from driftwell.operators import reconcile
from driftwell.sources import receipts
from driftwell.sources.receipts import Receipts


def ids_of(spark, ids):
    return spark.createDataFrame([(x,) for x in ids], "id string")


def test_receipts_give_what_is_new(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(receipts, "FOLD", 3)
    rng = random.Random(2)
    store, seen = Receipts(spark, str(tmp_path), capacity=5000, buckets=4), set()
    batches = []
    for b in range(7):
        batch = [rng.choice([f"Id-{rng.randrange(600)}", f"iD-{rng.randrange(600)}", None]) for _ in range(150)]
        batches.append(batch)
        want = {x.lower() for x in batch if x} - seen
        got = [r.id for r in store.merge(ids_of(spark, batch), str(b)).collect()]
        assert sorted(got) == sorted(want)
        seen |= want
        if b == 4:  # another process goes on
            store = Receipts(spark, str(tmp_path), capacity=1, buckets=1)
            assert store.list["buckets"] == 4
    assert len(store.list["runs"]) < 7 and {r.id for r in store.ids().collect()} == seen and store.ids().count() == len(seen)
    # repetitions give the same again, also of batches that were folded
    again = Receipts(spark, str(tmp_path))
    first = {x.lower() for x in batches[0] if x}
    assert {r.id for r in again.merge(ids_of(spark, batches[0]), "0").collect()} == first and again.ids().count() == len(seen)
    again.grow(100_000)
    assert again.ids().count() == len(seen) and again.merge(ids_of(spark, [*list(seen)[:50], "fresh"]), "later").collect()[0].id == "fresh"
    assert again.merge(ids_of(spark, []), "none").count() == 0


def test_a_batch_reads_filters_not_history(spark, tmp_path):
    """Batches of new identifiers read no receipts, and as many filters whatever there is already; known ones read their buckets only."""
    store = Receipts(spark, str(tmp_path), capacity=1_000_000, buckets=8)
    read = []
    for b, n in enumerate((500, 5000, 20_000, 500, 500)):
        store.merge(spark.range(n).select(F.concat(F.lit(f"batch{b}-"), F.col("id").cast("string")).alias("id")), str(b))
        read.append(dict(store.files_read))
    # the chance hits of so many cells are few: no file of receipts at all for the small batches
    assert read[3]["ids"] == 0 and read[4]["ids"] == 0
    assert read[4]["filters"] <= 8 * 4
    store.merge(ids_of(spark, ["batch1-7"]), "known")
    assert store.files_read["filters"] <= 5 and 1 <= store.files_read["ids"] <= 5


def test_what_is_not_published_is_not_there(spark, tmp_path, monkeypatch):
    store = Receipts(spark, str(tmp_path), capacity=1000, buckets=2)
    store.merge(ids_of(spark, ["a"]), "0")

    def crash(_):
        raise OSError("lost")

    monkeypatch.setattr(store, "_publish", crash)
    with pytest.raises(OSError, match="lost"):
        store.merge(ids_of(spark, ["a", "b"]), "1")
    again = Receipts(spark, str(tmp_path))
    assert [r.id for r in again.ids().collect()] == ["a"]
    assert [r.id for r in again.merge(ids_of(spark, ["a", "b"]), "1").collect()] == ["b"]


def test_hash_tree_finds_what_the_multisets_differ_in(spark):
    rng = random.Random(4)
    for trial in range(5):
        rows = [(rng.choice(["x", "y", None]), rng.choice([None, rng.randrange(60)])) for _ in range(400)]
        other = list(rows)
        for _ in range(trial * 3):
            other.pop(rng.randrange(len(other)))
            other.append(rng.choice(rows))
        rng.shuffle(other)
        a, b = (spark.createDataFrame(x, "`a.b` string, v long").repartition(3) for x in (rows, other))
        a, b = a.withColumnRenamed("a.b", "k"), b.withColumnRenamed("a.b", "k")
        key = lambda r: tuple(map(str, r))
        want = sorted(map(tuple, reconcile.multiset_difference(a, b).collect()), key=key)
        out = reconcile.hash_tree_difference(a, b)
        assert sorted(map(tuple, out.collect()), key=key) == want and (trial > 0 or not want)
        assert out.columns == ["k", "v", "side", "copies"]


def test_swapped_nulls_and_copies_are_differences(spark):
    a = spark.createDataFrame([("x", None), (None, "y"), ("z", "z")], "p string, q string")
    b = spark.createDataFrame([(None, "x"), ("y", None), ("z", "z"), ("z", "z")], "p string, q string")
    assert reconcile.hash_tree_difference(a, b).count() == 5
    assert reconcile.hash_tree_difference(a, a.limit(0)).count() == 3 and reconcile.hash_tree_difference(a.limit(0), a.limit(0)).count() == 0


def test_equal_sides_move_a_row_for_each_node(spark):
    """Of 200 000 rows no more reaches a shuffle than a sum for each task and node."""
    a = spark.range(200_000, numPartitions=4).selectExpr("id", "concat('trace-', id) AS t")
    out = reconcile.hash_tree_difference(a, a.orderBy(F.desc("id")))
    assert out.isEmpty() and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_missing_ranges_by_bitmaps(spark):
    rng = random.Random(6)
    k = reconcile.BITMAP
    cases = [
        (set(), 5),
        ({0, 1, 2}, 3),
        ({5}, 10),
        (set(range(k)) | {2 * k, 2 * k + 1}, 5 * k + 3),
        ({i for i in range(3 * k) if rng.random() < 0.999}, 3 * k + 1),
        (set(range(0, k - 1)) | set(range(k + 1, 2 * k)), 2 * k),
        ({10 * k - 1, 10 * k}, 20 * k),
        (set(range(100)), 50),
    ]
    for have, n in cases:
        want, start = [], None
        for i in range(n + 1):
            gone = i < n and i not in have
            if gone and start is None:
                start = i
            elif not gone and start is not None:
                want.append((start, i - 1, i - start))
                start = None
        frame = spark.createDataFrame([(i,) for i in [*have, *list(have)[:3]]], "id long")
        got = sorted(map(tuple, reconcile.missing_ranges(frame, F.lit(n) + F.count("id") * 0).collect()))
        assert got == want, (len(have), n)


def test_dense_counts_are_those_of_joins(spark):
    r = spark.createDataFrame([(i,) for i in [0, 1, 1, 4, 9, 12]], "id long")
    e = spark.createDataFrame([(i,) for i in [1, 4, 4, 9]], "id long")
    got = reconcile.stored_counts_dense(r, e, F.max("id") + 1).first()
    want = reconcile.stored_counts(spark.range(13).select(uuid_from_index("id").alias("event_id")), r.select(uuid_from_index("id").alias("event_id")), e.select(uuid_from_index("id").alias("event_id"))).first()
    assert got.asDict() == want.asDict()


def test_indices_come_back_out_of_identifiers(spark):
    rows = spark.createDataFrame([(0,), (255,), (2**48 - 1,)], "n long").select("n", uuid_from_index("n").alias("u"))
    assert all(r.n == r.a == r.b for r in rows.select("n", index_of_uuid("u").alias("a"), index_of_uuid(F.upper("u")).alias("b")).collect())
    assert spark.createDataFrame([("x",), (None,), ("10000000-0000-4000-8000-000000000001",)], "u string").where(index_of_uuid("u").isNotNull()).count() == 0
