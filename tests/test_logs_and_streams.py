"""Codec, logs, store, streaming jobs, metrics and the driver contract."""

import json
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from driftwell.functions import codec
from driftwell.config import DetectorConfig
from driftwell.operators.detector import KeyStore
from driftwell.operators.retry import Retryable, backoff_bounds, jittered, parse_failpoint, with_retry
from driftwell.plans import metrics
from driftwell.queries import _log_records
from driftwell.schemas import DEFERRED_TOPIC, DLQ_TOPIC, ENRICHED_TOPIC, EVENTS_TABLE, RAW_TOPIC, assert_schema, schema_gaps
from driftwell.sources.adapt import read_events, telemetry
from driftwell.sources.filelog import FileLog
from driftwell.sources.store import EventStore
from driftwell.streaming.pipeline import dead_letter_query, persist_query, score_query


def test_codec_agrees_with_a_protobuf_library():
    pb = pytest.importorskip("google.protobuf")
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    assert pb
    f = descriptor_pb2.FileDescriptorProto(name="t.proto", syntax="proto3", package="t")
    inst = f.message_type.add(name="Instant")
    inst.field.add(name="seconds", number=1, type=3, label=1)
    inst.field.add(name="nanos", number=2, type=5, label=1)
    m = f.message_type.add(name="Event")
    for number, (name, kind) in {1: ("event_id", 9), 3: ("service_name", 9), 4: ("route", 9), 5: ("latency_us", 4), 6: ("status_code", 13), 7: ("trace_id", 9)}.items():
        m.field.add(name=name, number=number, type=kind, label=1)
    m.field.add(name="event_time", number=2, type=11, label=1, type_name=".t.Instant")
    e = m.nested_type.add(name="AttributesEntry")
    e.options.map_entry = True
    e.field.add(name="key", number=1, type=9, label=1)
    e.field.add(name="value", number=2, type=9, label=1)
    m.field.add(name="attributes", number=8, type=11, label=3, type_name=".t.Event.AttributesEntry")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(f)
    kind = message_factory.GetMessageClass(pool.FindMessageTypeByName("t.Event"))
    row = dict(event_id="é" * 20, event_time=dict(seconds=-5, nanos=999_999_999), service_name="s", route="", latency_us=2**64 - 1, status_code=2**32 - 1, trace_id="t", attributes={"a": "b", "c": ""})
    data = codec.serialise(row, codec._EVENT)
    got = kind.FromString(data)
    assert (got.event_id, got.event_time.seconds, got.event_time.nanos, got.latency_us, got.status_code, dict(got.attributes)) == (row["event_id"], -5, 999_999_999, 2**64 - 1, 2**32 - 1, row["attributes"])
    assert codec.parse(got.SerializeToString(), codec._EVENT) == row


@pytest.mark.parametrize("data", [b"\xff", b"not-a-protobuf-record", b"\x08\x01", b"\x0a\x05ab", b"\x0a\x01\xff", b"\x00\x00", b"\x2b"])
def test_codec_is_strict(data):
    with pytest.raises(codec.WireError):
        codec.parse(data, codec._EVENT)


def test_codec_defaults_and_unknown_fields():
    assert codec.parse(b"", codec._EVENT)["event_id"] == "" and codec.parse(b"", codec._EVENT)["event_time"] is None
    known = codec.parse(b"\x0a\x01a\x78\x05\x0a\x01b", codec._EVENT)  # an unknown field, and the last value wins
    assert known["event_id"] == "b" and codec.serialise(known, codec._EVENT) == b"\x0a\x01b"
    assert codec.parse(b"\x30\xff\xff\xff\xff\xff\x0f", codec._EVENT)["status_code"] == 4_294_967_295


def test_log_appends_once_and_finds_gaps(spark, tmp_path):
    log = FileLog(spark, str(tmp_path))
    rows = spark.range(10).select(F.col("id").cast("string").cast("binary").alias("key"), F.lit(b"v").alias("value"), F.lit(0).alias("partition"))
    log.append(rows, RAW_TOPIC, "a", ["key"])
    log.append(rows, RAW_TOPIC, "a", ["key"])
    log.append(rows, RAW_TOPIC, "b", ["key"])
    assert log.read(RAW_TOPIC).count() == 20 and log.next_offsets(RAW_TOPIC).first().next_offset == 20
    assert [r.offset for r in log.read_range(RAW_TOPIC, 0, 8, 12).collect()] == [8, 9, 10, 11] and log.read_range(RAW_TOPIC, 0, 3, 3).count() == 0
    with pytest.raises(ValueError, match="offset gap"):
        log.read_range(RAW_TOPIC, 0, 15, 25)


def test_log_appends_read_nothing_of_what_it_holds(spark, tmp_path, monkeypatch):
    log = FileLog(spark, str(tmp_path))
    rows = spark.range(1000).select(F.col("id").cast("string").cast("binary").alias("key"), F.lit(b"v").alias("value"), (F.col("id") % 3).cast("int").alias("partition"), "id")
    monkeypatch.setattr(FileLog, "read", None)
    for i in range(12):
        log.append(rows, RAW_TOPIC, f"b{11 - i}", ["id"])  # names that don't sort by time
    (number, head), *_ = log._heads(RAW_TOPIC)
    after = {int(p): n for p, n in head["next"].items()}
    assert number == 11 and after == {0: 12 * 334, 1: 12 * 333, 2: 12 * 333}
    monkeypatch.undo()
    for p in range(3):
        own = log.read(RAW_TOPIC).where(F.col("partition") == p).select("offset", F.col("key").cast("string").cast("long").alias("id"))
        assert own.agg(F.count_distinct("offset"), F.max("offset")).first() == (after[p], after[p] - 1)
        ids = [r.id for r in own.orderBy("offset").limit(334 - (p > 0)).collect()]
        assert ids == list(range(p, 1000, 3))


def test_several_writers_share_a_topic(spark, tmp_path):
    """Four writers at once, three appends each: offsets of each partition are distinct and gapless."""
    from concurrent.futures import ThreadPoolExecutor

    rows = spark.range(150).select(F.col("id").cast("string").cast("binary").alias("key"), F.lit(b"v").alias("value"), (F.col("id") % 2).cast("int").alias("partition"), "id")

    def write(writer):
        log = FileLog(spark, str(tmp_path))
        for i in range(3):
            log.append(rows, DLQ_TOPIC, f"writer{writer}-{i}", ["id"])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    log = FileLog(spark, str(tmp_path))
    for p in range(2):
        own = log.read(DLQ_TOPIC).where(F.col("partition") == p).agg(F.count("*"), F.count_distinct("offset"), F.min("offset"), F.max("offset")).first()
        assert tuple(own) == (900, 900, 0, 899)
        assert log.read_range(DLQ_TOPIC, p, 0, 900).count() == 900


def test_a_writer_that_fails_keeps_its_claim(spark, tmp_path, monkeypatch):
    log = FileLog(spark, str(tmp_path), claim_wait_s=1.0)
    rows = spark.range(10).select(F.col("id").cast("string").cast("binary").alias("key"), F.lit(b"v").alias("value"), F.lit(0).alias("partition"))
    log.append(rows, RAW_TOPIC, "a", ["key"])
    assert log._claim(RAW_TOPIC, "b", {0: 10}) == {0: 10}  # and then the writer of "b" is gone
    with pytest.raises(TimeoutError, match="'b' has claimed"):
        log.append(rows, RAW_TOPIC, "c", ["key"])
    log.append(rows, RAW_TOPIC, "b", ["key"])  # it comes back
    log.append(rows, RAW_TOPIC, "c", ["key"])
    assert [(r.next_offset, r.records) for r in log.next_offsets(RAW_TOPIC).collect()] == [(30, 30)]
    log._claim(RAW_TOPIC, "d", {0: 10})
    log.release(RAW_TOPIC)  # it never does
    log.append(rows, RAW_TOPIC, "e", ["key"])
    log.release(RAW_TOPIC)  # what is published stays
    assert [(r.next_offset, r.records) for r in log.next_offsets(RAW_TOPIC).collect()] == [(40, 40)]


def stored(spark, rows):
    df = spark.createDataFrame(rows, "event_id string, service_name string, latency_us long, partition int, offset long")
    t = F.timestamp_seconds(F.lit(1_700_000_000))
    return df.select("event_id", t.alias("event_time"), "service_name", F.lit("/r").alias("route"), "latency_us", F.lit(200).alias("status_code"), F.lit("").alias("trace_id"), F.lit("{}").alias("attributes"), *(F.lit(0.0).alias(c) for c in ("ewma_mean_us", "ewma_stddev_us", "anomaly_score")), F.lit(False).alias("is_anomaly"), t.alias("processed_at"), "partition", "offset")


def test_first_payload_wins_and_replays_change_nothing(spark, tmp_path):
    store, a = EventStore(spark, str(tmp_path)), "550e8400-e29b-41d4-a716-446655440000"
    assert store.persist(stored(spark, [(a, "winner", 10, 0, 0), (a.upper(), "winner", 10, 0, 1), (a, "conflicting", 11, 0, 2)]), 0) == {"total": 3, "inserted": 1, "conflicts": 2}
    b = stored(spark, [(a, "replay-service", 999, 0, 3), ("550e8400-e29b-41d4-a716-446655440001", "new", 1, 0, 4)])

    def crash(number):
        raise RuntimeError("crash after commit")

    with pytest.raises(RuntimeError, match="crash"):
        store.persist(b, 1, failpoint=crash)
    assert store.persist(b, 1) == {"total": 2, "inserted": 1, "conflicts": 1}
    assert store.persist(b.limit(0), 2) == {"total": 0, "inserted": 0, "conflicts": 0}
    assert sorted((r.service_name, r.latency_us) for r in store.events().collect()) == [("new", 1), ("winner", 10)]
    assert store.receipts().count() == 2
    store.verify()


def test_manifests_are_folded_and_the_latest_rows_read(spark, tmp_path, monkeypatch):
    from driftwell.sources import store as module

    monkeypatch.setattr(module, "FOLD", 3)
    store = EventStore(spark, str(tmp_path))
    ids = [f"550e8400-e29b-41d4-a716-44665544000{i}" for i in range(8)]
    for i, key in enumerate(ids):
        rows = stored(spark, [(key, "s", i, 0, i), (ids[0], "s", 99, 0, 100 + i)]).withColumn("event_time", F.timestamp_seconds(F.lit(1_700_000_000 + i)))
        assert store.persist(rows, i) == {"total": 2, "inserted": 1, "conflicts": 1}
    files = [n for n in (tmp_path / "manifests").iterdir() if n.name.endswith(".json")]
    assert len(files) <= 3 and sorted(store.published()) == list(range(8)) and store.receipts().count() == 8
    assert [(r.event_id, r.rank) for r in store.latest(2).orderBy("rank").collect()] == [(ids[7], 1), (ids[6], 2)]
    assert store.persist(stored(spark, [(ids[3], "s", 5, 0, 7)]), 3) == {"total": 2, "inserted": 1, "conflicts": 1}  # published before


def test_late_rows_are_deferred_and_an_epoch_starts_afresh(spark, sf_dir, tmp_path):
    log = FileLog(spark, f"{tmp_path}/log")
    t = telemetry(read_events(spark, sf_dir), True).where("id < 40").withColumn("event_us", 1_700_000_000_000_000 + F.col("id") * 1_000_000)
    clock = F.col("event.event_time.seconds") * 1000
    run = lambda **more: score_query(log, f"{tmp_path}/check", clock=clock, detector=DetectorConfig(warmup=1), shards=1, **more).awaitTermination()
    log.append(_log_records(t.where("id >= 20")), RAW_TOPIC, "0", ["id"])
    run()
    log.append(_log_records(t.where("id < 10")), RAW_TOPIC, "1", ["id"])  # before what was scored
    log.append(_log_records(t.where("id >= 39")), RAW_TOPIC, "2", ["id"])
    run()
    assert log.read(ENRICHED_TOPIC).count() == 21 and log.read(DEFERRED_TOPIC).count() == 10
    log.append(_log_records(t.where("id >= 39")), RAW_TOPIC, "3", ["id"])
    run(epoch=1)
    scores = log.read(ENRICHED_TOPIC).select(codec.decode_enriched(F.col("value"))["enriched"].alias("e")).select("e.event.event_id", "e.ewma_mean_us").where(F.col("event_id").endswith("27")).collect()
    assert sorted(r.ewma_mean_us > 0 for r in scores) == [False, True, True]


def test_capacity_in_the_stream(spark, tmp_path):
    from driftwell.config import StateConfig

    log = FileLog(spark, f"{tmp_path}/log")
    rng = random.Random(6)
    rows = [(i, f"svc-{rng.randrange(6)}", rng.randrange(5000)) for i in range(300)]
    base = spark.createDataFrame(rows, "id long, service_name string, latency_us long").withColumn("event_us", F.col("id") * 1_000_000)
    t = base.select("id", F.format_string("550e8400-e29b-41d4-a716-%012x", "id").alias("event_id"), "event_us", "service_name", F.lit("/r").alias("route"), "latency_us", F.lit(200).cast("long").alias("status_code"), F.lit("").alias("trace_id"), F.create_map(F.lit("k"), F.lit("v")).alias("attributes"), F.lit(0).alias("partition"))
    for a in (0, 100, 200):  # the state lives on between runs
        log.append(_log_records(t.where(F.col("id").between(a, a + 99))), RAW_TOPIC, str(a), ["id"])
        score_query(log, f"{tmp_path}/check", clock=F.col("event.event_time.seconds") * 1000, detector=DetectorConfig(warmup=1), state=StateConfig(max_keys=3, ttl_ms=20_000), shards=1).awaitTermination()
    store = KeyStore(DetectorConfig(warmup=1), 20_000, 3)
    want = [(f"550e8400-e29b-41d4-a716-{i:012x}", store.observe((s, "/r"), float(x), i * 1000)[0][0] or 0.0) for i, s, x in rows]
    got = log.read(ENRICHED_TOPIC).select(codec.decode_enriched(F.col("value"))["enriched"].alias("e")).select("e.event.event_id", "e.ewma_mean_us").orderBy("event_id").collect()
    assert [tuple(r) for r in got] == want


def test_dead_letters_of_both_stages_and_their_lines(spark, tmp_path):
    from driftwell.operators.route import letter_lines

    log, store = FileLog(spark, f"{tmp_path}/log"), EventStore(spark, f"{tmp_path}/store")
    bad = spark.createDataFrame([(bytearray(b"k"), bytearray(b"\xff\x00"), 0), (bytearray(b"k"), bytearray(b""), 1)], "key binary, value binary, partition int")
    log.append(bad, RAW_TOPIC, "0", ["value"])
    log.append(bad, ENRICHED_TOPIC, "0", ["value"])
    both = [dead_letter_query(log, f"{tmp_path}/check"), persist_query(log, store, f"{tmp_path}/check")]  # at once, to one topic
    for q in both:
        q.awaitTermination()
    assert sorted(r.offset for r in log.read(DLQ_TOPIC).collect()) == [0, 1, 2, 3]
    letters = log.read(DLQ_TOPIC).select("partition", "offset", codec.decode_dead_letter(F.col("value"))["dead_letter"].alias("d")).select("partition", "offset", "d.*")
    assert sorted((r.stage, r.error_category) for r in letters.collect()) == [(1, "decode"), (1, "event_id"), (2, "decode"), (2, "validation")]
    lines = [json.loads(r.line) for r in letter_lines(letters).collect()]
    assert {x["original_payload_hex"] for x in lines} == {"ff00", ""} and all(x["kind"] == "dlq" and x["topic"] == DLQ_TOPIC for x in lines)


def test_reports_are_written_whole(spark, tmp_path):
    from driftwell.operators import reconcile

    one = spark.createDataFrame([(3, True, [1, 2])], "n long, passed boolean, ids array<long>")
    for _ in range(2):  # again in place of itself
        reconcile.write_report(one, f"{tmp_path}/report.json")
    assert json.loads((tmp_path / "report.json").read_text()) == {"n": 3, "passed": True, "ids": [1, 2]}
    for rows in (one.limit(0), one.unionAll(one)):
        with pytest.raises(ValueError, match="one row"):
            reconcile.write_report(rows, f"{tmp_path}/other.json")
    assert not (tmp_path / "other.json").exists()


def keyed(spark, rows):
    return spark.createDataFrame(rows, "id long, service_name string, route string, clock long, latency_us long")


def test_a_stream_goes_on_from_the_states_of_a_batch(spark, tmp_path):
    from driftwell.operators import detector
    from driftwell.streaming.keyed import run_to_end, score_by_key

    rng = random.Random(17)
    rows = [(i, rng.choice(["a", "b", None]), "/r", i * 10 + (i > 300) * 5000, rng.randrange(100_000)) for i in range(600)]
    config = DetectorConfig(warmup=5)
    for ttl in (None, 120):
        want = {r.id: tuple(r)[5:11] for r in detector.score(keyed(spark, rows), tie=("id",), config=config, ttl=ttl).drop("segment").collect()}
        at = tmp_path / str(ttl)
        states = detector.baselines(keyed(spark, rows[:250]), tie=("id",), config=config, ttl=ttl)
        for lo, hi in ((250, 400), (400, 600)):  # two runs of the job; later ones go on from its checkpoint
            keyed(spark, rows[lo:hi]).coalesce(1).write.mode("append").parquet(f"{at}/in")
            stream = spark.readStream.schema(keyed(spark, []).schema).parquet(f"{at}/in")
            run_to_end(score_by_key(stream, tie=("id",), config=config, ttl=ttl, initial=states), f"{at}/out", f"{at}/check")
        got = {r.id: tuple(r)[5:11] for r in spark.read.parquet(f"{at}/out").collect()}
        assert got == {i: v for i, v in want.items() if i >= 250}


def test_rows_that_cannot_be_scored_by_key_change_nothing(spark, tmp_path):
    from driftwell.streaming.keyed import run_to_end, score_by_key

    for n, rows in enumerate(([(0, "a", "/r", 50, 10)], [(1, "a", "/r", 40, 99), (2, "a", "/r", 60, None), (3, "a", "/r", 60, 20), (4, "b", "/r", 1, 5)])):
        keyed(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(keyed(spark, []).schema).parquet(f"{tmp_path}/in")
        run_to_end(score_by_key(stream, tie=("id",)), f"{tmp_path}/out", f"{tmp_path}/check")
    got = {r.id: (r.error, r.ewma_mean_us, r.observations) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {0: (None, 0.0, 1), 1: ("observation time must not move backwards", None, None), 2: ("latency must be finite", None, None), 3: (None, 10.0, 2), 4: (None, 0.0, 1)}


def test_latest_rows_read_the_dates_that_hold_them(spark, tmp_path):
    from driftwell.sources.dated import DatedTable

    # route "busy" every day, "rare" on the second day only, "twice" on the first and the last
    rows = [("busy", d, i) for d in range(20) for i in range(5)] + [("rare", 1, i) for i in range(2)] + [("twice", 0, 7), ("twice", 19, 7)] + [(None, 18, i) for i in range(4)]
    frame = spark.createDataFrame(rows, "route string, day int, i int").withColumn("t", F.col("day") * 86_400 + F.col("i"))
    table = DatedTable(spark, str(tmp_path), ["route"])
    for part in ("day < 10", "day >= 10"):
        table.append(frame.where(part), "timestamp_seconds(t)")
    out = table.latest(3, [F.desc("t")])
    want = {}
    for r in sorted(rows, key=lambda r: -(r[1] * 86_400 + r[2])):
        own = want.setdefault(r[0], [])
        if len(own) < 3:
            own.append(r[1] * 86_400 + r[2])
    got = {}
    for r in sorted(out.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.route, []).append(r.t)
    assert got == want
    dates = {f.split("_date=")[1][:10] for f in out.inputFiles() if "/rows/" in f}
    assert dates == {"1970-01-01", "1970-01-02", "1970-01-19", "1970-01-20"}
    table.recount()
    assert table.needed(3).count() == len({("busy", 19), ("rare", 1), ("twice", 0), ("twice", 19), (None, 18)})


def test_contracts_find_what_tables_lack(spark, tmp_path):
    from driftwell.operators.conformance import Contract, problems, ready

    spark.createDataFrame([(1, "a", 1), (2, None, 1), (2, "b", 2)], "id long, name string, part int").write.partitionBy("part").parquet(f"{tmp_path}/good")
    spark.createDataFrame([(1, "a")], "`odd id` long, v string").write.parquet(f"{tmp_path}/plain")
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    contracts = [
        Contract("good", {"id": ("bigint", True), "name": ("string", True), "part": ("string", True), "gone": ("int", False)}, ("id",), ("day",)),
        Contract("plain", {"odd id": ("bigint", True), "v": ("string", False)}, ("odd id", "v")),
        Contract("nowhere", {"x": ("int", False)}),
    ]
    got = {tuple(r) for r in problems(spark, contracts, read).collect()}
    assert got == {
        ("nowhere", "nowhere", "the table is missing", None), ("good", "gone", "the column is missing", None), ("good", "part", "the type is int instead of string", None),
        ("good", "name", "required values are null", 1), ("good", "id", "values of the key repeat", 1), ("good", "good", "partitioned by (part) instead of (day)", None),
    }
    assert {(r.table_name, r.ready) for r in ready(spark, contracts, read).collect()} == {("good", False), ("plain", True), ("nowhere", False)}


def test_active_requests_at_scrapes(spark):
    r = spark.createDataFrame([("j", 5, 25), ("j", 10, None), ("j", 12, 11), ("j", None, 3), ("k", 30, 60)], "job string, begin long, finish long")
    got = {(r.job, r.ts): r.value for r in metrics.active_requests(r, ["job"], 10).collect()}
    assert got == {("j", 10): 2, ("j", 20): 2, ("j", 30): 1, ("j", 40): 1, ("j", 50): 1, ("j", 60): 1, ("k", 10): 0, ("k", 20): 0, ("k", 30): 1, ("k", 40): 1, ("k", 50): 1, ("k", 60): 0}


def test_exposition_round_trip(spark):
    from driftwell.sources import exposition

    df = spark.createDataFrame([('a"b\\c\nd', 2.5)], "s string, v double").select(exposition.line(F.lit("m_total"), {"s": F.col("s"), "r": F.lit("z")}, F.col("v")).alias("line"))
    more = spark.createDataFrame([(x,) for x in ("plain 1", "stamped 2 1700000000000", "up NaN", "down -Inf", "# TYPE x counter", "x{", "9x 1", "")], "line string")
    got = {r.name: r for r in exposition.samples(df.unionAll(more)).collect()}
    assert got["m_total"].labels == {"s": 'a"b\\c\nd', "r": "z"} and got["m_total"].value == 2.5 and got["stamped"].ts == 1_700_000_000_000
    assert set(got) == {"m_total", "plain", "stamped", "up", "down"} and got["down"].value == float("-inf") and got["up"].value != got["up"].value


def test_manifest_of_files_and_hidden_settings(spark, tmp_path):
    import hashlib

    from driftwell.operators import reconcile

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_bytes(b"one")
    (tmp_path / "y.txt").write_bytes(b"two\n")
    (tmp_path / "a" / "empty.txt").write_bytes(b"")
    (tmp_path / "a" / "odd [x] *{y}?.txt").write_bytes(b"odd")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    whole = reconcile.file_manifest(spark, str(tmp_path))
    want = [("a/empty.txt", "file", 0, sha(b"")), ("a/odd [x] *{y}?.txt", "file", 3, sha(b"odd")), ("a/x.txt", "file", 3, sha(b"one")), ("y.txt", "file", 4, sha(b"two\n"))]
    assert [tuple(r) for r in whole.collect()] == want and reconcile.manifest_holds(whole)
    some = reconcile.file_manifest(spark, str(tmp_path), ["y.txt", "gone/z.txt", "a", "a/empty.txt"])
    assert [tuple(r) for r in some.collect()] == [("a", "unsupported", None, None), ("a/empty.txt", "file", 0, sha(b"")), ("gone/z.txt", "missing", None, None), ("y.txt", "file", 4, sha(b"two\n"))]
    assert not reconcile.manifest_holds(some) and reconcile.file_manifest(spark, str(tmp_path), ["gone"]).first().type == "missing"
    df = spark.createDataFrame([({"db_password": "p", "API_KEY": "k", "host": "h"},)], "config map<string,string>")
    assert df.select(reconcile.redact(F.col("config")).alias("c")).first().c == {"db_password": "<redacted>", "API_KEY": "<redacted>", "host": "h"}


def test_codec_columns_with_nulls_and_nested_lists(spark):
    from driftwell.schemas import BATCH

    from decimal import Decimal

    event = ("550e8400", (5, 7), "s", "/r", Decimal(3), 200, None, {"b": "2", "a": "1"})
    df = spark.createDataFrame([(("id", [event, (None,) * 8, event]),), (("none", []),), (None,)], f"b {BATCH.simpleString()}")
    out = df.select(codec.encode_batch(F.col("b")).alias("p")).select(codec.decode_batch(F.col("p")).alias("d")).select("d.*").collect()
    assert [r.ok for r in out] == [True] * 3 and [len(r.batch.events) for r in out] == [3, 0, 0] and out[2].batch.batch_id == ""
    e = out[0].batch.events[0]
    assert (e.event_id, tuple(e.event_time), int(e.latency_us), e.trace_id, e.attributes) == ("550e8400", (5, 7), 3, "", {"a": "1", "b": "2"}) and out[0].batch.events[1].event_time is None


def test_client_waits():
    bounds = backoff_bounds(0.1, 1.0)
    assert [round(next(bounds), 3) for _ in range(6)] == [0.1, 0.2, 0.4, 0.8, 1.0, 1.0]
    assert next(backoff_bounds(5.0, 1.0)) == 1.0 and jittered(0.8, lambda: 0.25) == 0.2 and jittered(0.8, lambda: 0.0) == 0.0


def test_schema_checks(spark):
    df = spark.createDataFrame([], EVENTS_TABLE)
    assert schema_gaps(df, EVENTS_TABLE).isEmpty()
    with pytest.raises(ValueError, match="route"):
        assert_schema(df.drop("route"), EVENTS_TABLE)


def test_jobs_conserve_records_and_survive_a_crash(spark, sf_dir, tmp_path):
    log, store = FileLog(spark, f"{tmp_path}/log"), EventStore(spark, f"{tmp_path}/store")
    t = telemetry(read_events(spark, sf_dir), True).where("id < 60")
    log.append(_log_records(t), RAW_TOPIC, "0", ["id"])
    bad = spark.createDataFrame([(bytearray(b"malformed-key"), bytearray(b"not-a-protobuf-record"), 0), (bytearray(b"wrong"), bytearray(b""), 1)], "key binary, value binary, partition int")
    log.append(bad, RAW_TOPIC, "1", ["key"])
    check = f"{tmp_path}/check"
    score_query(log, check, state=None).awaitTermination()
    dead_letter_query(log, check).awaitTermination()
    assert log.read(RAW_TOPIC).count() == 62 and log.read(ENRICHED_TOPIC).count() == 60 and log.read(DLQ_TOPIC).count() == 2
    letters = log.read(DLQ_TOPIC).select(codec.decode_dead_letter(F.col("value"))["dead_letter"].alias("d")).select("d.*").collect()
    assert {(r.error_category, r.stage, bytes(r.original_payload)) for r in letters} == {("decode", 1, b"not-a-protobuf-record"), ("event_id", 1, b"")}
    crashes = []

    def crash(number):
        if not crashes:
            crashes.append(number)
            raise RuntimeError("failpoint")

    with pytest.raises(Exception, match="failpoint"):
        persist_query(log, store, check, failpoint=crash).awaitTermination()
    assert crashes and store.events().count() == 60
    persist_query(log, store, check).awaitTermination()
    assert store.events().count() == 60 and store.events().select("event_id").distinct().count() == 60
    log.append(_log_records(t), RAW_TOPIC, "2", ["id"])  # the same events again
    score_query(log, check, state=None).awaitTermination()
    persist_query(log, store, check).awaitTermination()
    assert log.read(ENRICHED_TOPIC).count() == 120 and store.events().count() == 60


def test_retries():
    waits, left = [], [2]

    def flaky():
        if left[0]:
            left[0] -= 1
            raise Retryable("later", "40001")
        return "done"

    assert with_retry(flaky, sleep=waits.append) == "done" and waits == [0.05, 0.1]
    waits.clear()

    def never():
        raise Retryable("later", "53300")

    with pytest.raises(Retryable):
        with_retry(never, sleep=waits.append)
    assert waits == [0.05, 0.1, 0.2, 0.4]

    def fatal():
        raise Retryable("no", "42P01")

    waits.clear()
    with pytest.raises(Retryable):
        with_retry(fatal, sleep=waits.append)
    assert not waits and parse_failpoint("after_db_commit_before_offset_commit") and not parse_failpoint("")
    with pytest.raises(ValueError, match="unknown"):
        parse_failpoint("x")


def test_quantiles_and_rates(spark):
    b = spark.createDataFrame([(1.0, 10), (2.0, 20), (float("inf"), 20)], "le double, count long")
    assert metrics.histogram_quantile(0.75, b).first().value == 1.5
    b = spark.createDataFrame([(1.0, 10), (2.0, 10), (float("inf"), 20)], "le double, count long")
    assert metrics.histogram_quantile(0.99, b).first().value == 2.0
    s = spark.createDataFrame([(0, 5), (15, 20), (30, 3), (45, 9)], "ts long, value long")
    assert [r.rate for r in metrics.counter_rate(s, 30).orderBy("ts").collect()] == [None, 1.0, 18 / 30, 9 / 30]
    assert metrics.SINK_DURATION[-1] == 0.001 * 2**15 and metrics.SINK_BATCH_SIZE[-1] == 512
    o = spark.createDataFrame([(0, "bad", None), (2, "bad", None), (1, None, "buffer_full"), (1, None, "empty_batch"), (1, None, None)], "n_events long, reason string, error string")
    r = metrics.gateway_counters(o).first()
    assert (r.received, r.accepted, r.rejected, r.publish_errors, r.batch_sizes, r.publish_durations) == (5, 1, 2, 2, 4, 3)


def test_every_sql_twin_gives_the_same_rows(spark, sf_dir):
    import duckdb

    from driftwell import queries

    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, sf_dir)
        r = con.execute(sql)
        at = [c[0] for c in r.description]
        assert sorted(at) == sorted(df.columns), name
        want = sorted((tuple(x[at.index(c)] for c in df.columns) for x in r.fetchall()), key=repr)
        assert sorted((tuple(x) for x in df.collect()), key=repr) == want, name


def test_entry_without_the_training_operators():
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'ewma_scores' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    import driftwell

    root = driftwell.__file__.rsplit("/", 2)[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1000


def shuffled_events(spark, path, n):
    """An events table whose identifiers are in another order than its times, some of which are equal."""
    i = F.col("id")
    kinds = F.element_at(F.array(*map(F.lit, ("view", "click", "signup", "error", "purchase"))), (i % 5 + 1).cast("int"))
    rows = spark.range(n).select(i.alias("event_id"), F.timestamp_seconds(1_700_000_000 + i * 37 % n * 300).cast("timestamp_ntz").alias("ts"), i.alias("user_id"), kinds.alias("event_type"), (i * 7919 % 1000 / 10).alias("value"), F.lit('{"k": 1}').alias("props"))
    rows.coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.mark.parametrize("stream, batch", [("stream_score_parity", "ewma_scores"), ("stream_score_ttl", "ewma_scores_ttl")])
def test_many_triggers_score_like_one(spark, tmp_path, monkeypatch, stream, batch):
    """Several micro-batches over several log partitions, in order of time, score every row as the batch scan does."""
    from driftwell.functions.expr import uuid_from_index
    from driftwell.queries import QUERIES
    from driftwell.sources import filelog

    monkeypatch.setattr(filelog, "FILE_RECORDS", 60)
    monkeypatch.setattr(filelog, "TRIGGER_FILES", 1)
    events = shuffled_events(spark, tmp_path, 90)
    want = QUERIES[batch](spark, events).select(uuid_from_index("id"), "ewma_mean_us", "ewma_stddev_us", "anomaly_score", "is_anomaly")
    assert sorted(map(tuple, QUERIES[stream](spark, events).collect())) == sorted(map(tuple, want.collect()))


def test_a_log_is_read_in_the_order_of_its_appends(spark, tmp_path, monkeypatch):
    from driftwell.sources import filelog

    monkeypatch.setattr(filelog, "FILE_RECORDS", 50)
    monkeypatch.setattr(filelog, "TRIGGER_FILES", 2)
    log, seen = FileLog(spark, f"{tmp_path}/log"), []
    for a in (0, 300):
        rows = spark.range(a, a + 300, numPartitions=7).select(F.col("id").cast("string").cast("binary").alias("key"), F.lit(b"v").alias("value"), (F.col("id") % 3).cast("int").alias("partition"), (299 - F.col("id") % 300).alias("at"))
        log.append(rows, RAW_TOPIC, f"b{9 - a}", ["at"])
    take = lambda batch, number: seen.append({(int(bytes(r.key)), r.partition, r.offset) for r in batch.collect()})
    log.read_stream(RAW_TOPIC).writeStream.foreachBatch(take).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    at = [[(k // 300, 299 - k % 300) for k, _, _ in b] for b in seen]
    assert len(seen) >= 6 and all(max(p) < min(q) for p, q in zip(at, at[1:])) and max(map(len, at)) <= 100
    for p in range(3):
        own = sorted((o, (k // 300, 299 - k % 300)) for b in seen for k, q, o in b if q == p)
        assert [o for o, _ in own] == list(range(200)) and [x for _, x in own] == sorted(x for _, x in own)


def test_large_requests_are_decoded_and_encoded_a_slice_at_a_time():
    import pyarrow as pa

    events = [dict(event_id=f"e{i}", event_time=dict(seconds=i, nanos=1), service_name="s", route="/r", latency_us=i, status_code=200, trace_id="t" * 40, attributes={"k": "v"}) for i in range(100)]
    payload = codec.serialise({"batch_id": "b", "events": events}, codec._BATCH)
    sizes = [1, 0, 400, *[1] * 300]  # in requests of 100 events
    payloads = pa.array([payload * n if n else None for n in sizes], pa.binary())
    encode = codec._encoder(codec._BATCH).func
    parts = list(codec._decoder(codec._BATCH, codec.BATCH, "batch").func(iter([payloads])))
    assert [len(e) for p in parts for e in p.field("batch").field("events").to_pylist()] == [100 * n for n in sizes]
    at = 0
    for p in parts:
        own = payloads.slice(at, len(p))
        assert len(p) == 1 or sum(len(x) for x in own.to_pylist() if x) <= codec.SLICE_BYTES
        at += len(p)
    assert at == len(sizes) and len(parts) > 3
    batch = pa.concat_arrays([p.field("batch") for p in parts])
    encoded = list(encode(iter([batch])))
    assert len(encoded) > 3 and [len(x) for e in encoded for x in e.to_pylist()] == [len(codec.serialise({"batch_id": "b" if n else "", "events": events * n}, codec._BATCH)) for n in sizes]


def test_a_resumed_stream_takes_its_rows_in_order_and_in_bounded_batches(spark, tmp_path, monkeypatch):
    from driftwell.queries import QUERIES
    from driftwell.sources import filelog
    from driftwell.streaming import keyed as module

    monkeypatch.setattr(filelog, "FILE_RECORDS", 30)
    monkeypatch.setattr(filelog, "TRIGGER_FILES", 1)
    events, checkpoints, run = shuffled_events(spark, tmp_path, 150), [], module.run_to_end
    monkeypatch.setattr(module, "run_to_end", lambda scored, path, checkpoint: (checkpoints.append(checkpoint), run(scored, path, checkpoint)))
    got = QUERIES["stream_score_resumed"](spark, events)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, QUERIES["ewma_scores"](spark, events).collect()))
    assert spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(f"{checkpoints[0]}/commits").count() >= 3  # micro-batches


def test_plain_messages_are_coded_by_columns_and_others_as_before(monkeypatch):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    texts = ["", "a", "é" * 70, "x" * 127, "x" * 128, "日本"]
    events = [dict(event_id=texts[i % 6], event_time=None if i % 5 == 0 else dict(seconds=i - 300, nanos=i % 3 - 1), service_name=texts[i % 4], route=None if i % 7 == 0 else "/r", latency_us=(0, 127, 128, 2**64 - 1)[i % 4], status_code=(0, 200, 2**32 - 1)[i % 3], trace_id="t" * (i % 3 * 100), attributes={"kéz"[j % 3] * (j + 1): texts[(i + j) % 6] for j in reversed(range(i % 4))}) for i in range(600)]
    rows = [None if i % 11 == 0 else dict(event=None if i % 13 == 0 else e, ewma_mean_us=(0.0, -0.0, 1.5)[i % 3], ewma_stddev_us=None, anomaly_score=float(i), is_anomaly=i % 2 == 0, processed_at=dict(seconds=i, nanos=0)) for i, e in enumerate(events)]
    array = pa.array(rows, to_arrow_type(codec.ENRICHED)).slice(7, 580)
    want = [None if r is None else codec.serialise(r, codec._ENRICHED) for r in rows[7:587]]
    parse, parsed = codec.parse, []
    monkeypatch.setattr(codec, "serialise", None)
    payloads = pa.concat_arrays(list(codec._encoder(codec._ENRICHED).func(iter([array]))))
    assert payloads.to_pylist() == want
    read = codec._decoder(codec._ENRICHED, codec.ENRICHED, "e").func
    monkeypatch.setattr(codec, "parse", None)  # no row is walked alone
    plain = pa.concat_arrays(list(read(iter([payloads]))))
    monkeypatch.setattr(codec, "parse", lambda data, *more: parsed.append(data) or parse(data, *more))
    assert plain.equals(pa.concat_arrays([codec._parsed(payloads, codec._ENRICHED, codec.ENRICHED, "e")]))
    odd = [d + tail if d and i % 10 == 0 else d[: i % 50] if d and i % 10 == 5 else d for i, d in enumerate(want) for tail in [(b"\x0a\x02\x08", b"\xff", b"\x78\x05", b"\x28\x00", b"\x0a\x03\x0a\x01\xff", b"\x0a\x08\x42\x02\x0a\x00\x42\x02\x0a\x00")[i // 10 % 6]]]
    odd = pa.array(odd, pa.binary())
    mixed = pa.concat_arrays(list(read(iter([odd]))))
    assert mixed.to_pylist() == codec._parsed(odd, codec._ENRICHED, codec.ENRICHED, "e").to_pylist()
    assert not all(mixed.field("ok").to_pylist()) and any(mixed.field("ok").to_pylist())


def test_an_append_makes_each_record_once_and_orders_it_by_one_shuffle(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def value(i):
        made.add(1)
        return str(i).encode()

    log = FileLog(spark, f"{tmp_path}/log")
    log.append(spark.range(200, numPartitions=3).select(F.lit(b"k").alias("key"), value("id").alias("value"), (F.col("id") % 3).cast("int").alias("partition"), "id"), RAW_TOPIC, "0", ["id"])
    assert made.value == 200
    assert sorted((r.partition, r.offset, int(r.value)) for r in log.read(RAW_TOPIC).collect()) == sorted((i % 3, i // 3, i) for i in range(200))


def test_a_sink_batch_without_failures_appends_no_letters_and_knows_its_history(spark, sf_dir, tmp_path, monkeypatch):
    from driftwell.sources import store as module

    log, store = FileLog(spark, f"{tmp_path}/log"), EventStore(spark, f"{tmp_path}/store")
    records = _log_records(telemetry(read_events(spark, sf_dir), True)).where("id < 60")
    log.append(records, RAW_TOPIC, "0", ["clock", "id"])
    score_query(log, f"{tmp_path}/check").awaitTermination()
    calls, first = [], module.first_per_id
    monkeypatch.setattr(module, "first_per_id", lambda *a: calls.append(a) or first(*a))
    persist_query(log, store, f"{tmp_path}/check").awaitTermination()
    assert log.batches(DLQ_TOPIC) == [] and store.events().count() == 60 and len(calls) == 1
    log.append(records, RAW_TOPIC, "1", ["clock", "id"])
    score_query(log, f"{tmp_path}/check").awaitTermination()
    persist_query(log, store, f"{tmp_path}/check").awaitTermination()
    assert store.events().count() == 60 and sum(m["conflicts"] for m in store.published().values()) == log.read(ENRICHED_TOPIC).count() - 60
