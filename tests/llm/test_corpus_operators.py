"""Operators over whole tables, against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.llm import neardup, packing, topk
from driftwell.llm.queries import OP10_SQL, SQL, op4_packing, op10_topk, tokenizer_files


def shingles(text, n):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if x]
    return {tuple(w)} if w and len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute_components(rows, n, percent):
    sets = {k: shingles(t, n) for k, t in rows}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            p, q = sets[a], sets[b]
            if p and q and 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                both = len(p & q)
                if 100 * both >= percent * (len(p) + len(q) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def check(spark, rows, n, percent):
    got = {r.doc_id: r for r in neardup.link(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()}
    want = brute_components(rows, n, percent)
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_are_those_of_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(spark, rows, 3, 85)
    check(spark, rows, 5, 80)


def test_no_link_is_lost_on_a_larger_table(spark):
    """Recall against brute force at 10 times the smallest scale: every component is the same."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check(spark, rows, 3, 85)


def test_signatures_keep_pairs_at_the_threshold():
    """Pairs as far apart as links may be, of all sizes: none is screened out, and from 16 shingles on the margin is six standard deviations."""
    rng = np.random.default_rng(11)
    for percent in (80, 85):
        for n in (1, 2, 4, 5, 6, 7, 10, 13, 15, 16, 20, 40, 100, 127, 128, 160, 400):
            both = -(-percent * n // 100)
            agree = []
            for _ in range(4000 if n <= 20 else 500):
                a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
                b = np.sort(rng.permutation(a)[:both])
                agree.append(int((neardup._mix(neardup.signature(a)).astype(np.uint8) == neardup._mix(neardup.signature(b)).astype(np.uint8)).sum()))
            least = neardup.least_agreement(np.array([both]), percent)[0]
            assert min(agree) >= least
            assert both < 16 or np.mean(agree) - least > 5.8 * np.std(agree)
            assert both >= 16 or least == 0


def near_copies(seed, groups, size, words, changes):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(changes + 1)):
                text[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
            rows.append((len(rows) * 7 % 10_007, " ".join(text)))
    return rows


def test_near_copies_around_the_threshold(spark):
    rows = near_copies(1, 6, 40, 60, 4) + near_copies(2, 4, 12, 9, 1)
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + [(5000, "one"), (5001, "ONE"), (5002, "two words"), (5003, ""), (5004, None), (5005, "two words"), (5006, " \t")]
    random.Random(3).shuffle(rows)
    check(spark, rows, 3, 85)


def test_wide_clusters_and_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "BUCKET", 24)
    rows = [(i, t) for i, (_, t) in enumerate(near_copies(4, 2, 90, 50, 3))]
    check(spark, rows, 3, 85)


def test_blocks_by_bytes_and_stars_beyond_hubs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 8 * 50 * 10)
    monkeypatch.setattr(neardup, "HUBS", 3)
    monkeypatch.setattr(neardup, "BUCKET", 24)
    rows = [(i, t) for i, (_, t) in enumerate(near_copies(6, 3, 60, 50, 3))]
    check(spark, rows, 3, 85)


def test_near_duplicates_over_odd_rows(spark):
    rows = [(None, "a b c d", "x"), (None, None, "x"), (7, "a b c d", "x"), (7, "a b c d", "x"), (8, "a b c d", "x"), (9, None, "x"), (9, "q r s t", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = neardup.link(docs, 3, 85).collect()
    assert len(got) == 7 and {r.component_id for r in got if r.doc_id in (7, 8)} == {7}
    one = neardup.keep_one(docs, 3, 85)
    clash = neardup.keep_one(docs.selectExpr("*", "doc_id AS _lost", "false AS kept"), 3, 85)
    assert sorted(r.doc_id or 0 for r in clash.collect()) == sorted(r.doc_id or 0 for r in one.collect())
    assert one.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in one.collect()) == [(0, ""), (0, "a b c d"), (7, "a b c d"), (9, ""), (9, "q r s t")]
    # rows that share an id are decided one by one: 5's second text is a copy of 4's, 6's two texts are nobody's
    mixed = spark.createDataFrame([(4, "m n o p q"), (5, "s t u v w"), (5, "m n o p q"), (6, "one two three four"), (6, "five six seven eight"), (6, "five six seven eight")], "doc_id long, text string")
    assert sorted(map(tuple, neardup.keep_one(mixed, 3, 85).collect())) == [(4, "m n o p q"), (5, "s t u v w"), (6, "five six seven eight"), (6, "one two three four")]
    assert neardup.link(docs.limit(0), 3, 85).count() == 0 and neardup.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"{i:03}".encode(), f"{i + 1:03}".encode()) for i in range(60)] + [(b"900", b"901")], "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in neardup.components(edges).collect()}
    assert len(got) == 63 and {got[f"{i:03}".encode()] for i in range(61)} == {b"000"} and got[b"901"] == b"900"


def encode(text):
    from tokenizers import Tokenizer

    encode.t = getattr(encode, "t", None) or Tokenizer.from_file(tokenizer_files()["tokenizer"])
    return [*(encode.t.encode(text, add_special_tokens=False).ids if text else []), 1]


def check_packing(rows, texts, total=2048):
    per_doc, per_seq = {}, {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append(r)
        per_seq.setdefault(r.sequence_id, []).append(r)
    assert per_doc.keys() == texts.keys()
    for key, pieces in per_doc.items():
        ids, at = encode(texts[key]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    padding = tokens = 0
    for pieces in per_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= total
        tokens += at
        padding += 0 if at & (at - 1) == 0 else total - at
    assert padding <= 0.01 * tokens


def test_packing_covers_every_id_once(spark, sf_dir):
    rows = op4_packing(spark, sf_dir).collect()
    check_packing(rows, {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()})
    assert {r.tier for r in rows} >= {256, 512, 1024, 2048}
    sizes = {}
    for r in rows:
        sizes.setdefault((r.step_group, r.tier), set()).add(r.sequence_id)
    assert max(len(own) * tier for (_, tier), own in sizes.items()) <= packing.GROUP * 2048
    assert any(len(own) * tier == packing.GROUP * 2048 for (_, tier), own in sizes.items())


def test_both_libraries_give_the_same_ids(spark):
    ids = packing.Ids(**dict(zip(("path", "ranks_path", "pattern"), tokenizer_files().values(), strict=True)))
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text]
    rng = random.Random(1)
    pool = "ab Z\t\n0129.,'’sé日本😀\u0301\u200d\u00a0\u2028ſ"
    texts += ["".join(rng.choices(pool, k=rng.randrange(1, 60))) for _ in range(2000)] + [" " * 100_000, "a" * 100_000, "\n" * 100_000, "1" * 100_000, "é" * 50_000]
    for text in texts:
        assert ids(text).tolist() == encode(text)[:-1]


@pytest.mark.parametrize("block", [1, 3000, 10**9])
def test_packing_of_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    texts = {1: None, 2: "", 3: "short", 4: "<|endoftext|> inside", 5: "lorem ipsum " * 5000, 6: "é" * 3000, 7: " " * 5000, 8: "a" * 4000, **{i: f"row {i} " * (i % 90) for i in range(10, 200)}}
    docs = spark.createDataFrame([(k, t, 5) for k, t in texts.items()], "doc_id long, text string, offset long").repartition(3)
    out = packing.pack(docs, **tokenizer_files()).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(out.collect(), texts)
    assert packing.pack(docs.limit(0), **tokenizer_files()).count() == 0
    nulls = packing.pack(spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string"), **tokenizer_files())
    assert nulls.agg(F.sum("length")).first()[0] == 4


def brute_topk(rows, k):
    """By id: an id's score is the best over its rows; saturated to a long."""
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    q = sorted({(i, tuple((lambda x: int(x) * 64 if abs(x) > 2**50 else int(np.floor(64 * x)))(float(np.float32(c))) for c in v)) for i, v in ok})
    out = {}
    for i in sorted({i for i, _ in q if i % 20 == 0}):
        best = {}
        for v in [v for j, v in q if j == i]:
            for j, w in q:
                if j != i:
                    s = min(max(sum(a * b for a, b in zip(v, w)), -(2**63)), 2**63 - 1)
                    best[j] = max(s, best.get(j, s))
        out[i] = [(j, -s) for s, j in sorted((-s, j) for j, s in best.items())[:k]]
    return {i: x for i, x in out.items() if x}


def found_topk(df, k):
    got = {}
    for r in topk.search(df, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
        assert len(got.setdefault(r.query_id, [])) == r.rank - 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def small_shards(monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 150)
    monkeypatch.setattr(topk, "SHARD_BYTES", 1)
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)


def test_topk_with_ties_and_odd_vectors(spark, monkeypatch):
    small_shards(monkeypatch)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=16).astype(np.float32)]) for i in range(600)]
    rows += [(600 + i, rows[3][1]) for i in range(80)] + [(700, None), (720, [1.0, None]), (740, [float("nan")] * 16), (760, [float("inf")] * 16), (780, []), (781, [1.0, 2.0]), (None, rows[0][1]), (800, [100.0] * 20)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    assert found_topk(df, 20) == brute_topk(rows, 20)
    assert topk.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_topk_of_repeated_rows_lists_each_id_once(spark, monkeypatch):
    small_shards(monkeypatch)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(400)]
    rows += [rows[20]] * 39 + [rows[41]] * 500 + rows[100:200]  # whole repeats: of a query, of a candidate very often, of a range
    rows += [(60, rows[5][1]), (60, rows[6][1]), (77, rows[20][1]), (20, rows[77][1])]  # ids with differing vectors
    rng.shuffle(rows)
    rows = [(int(i), list(v)) for i, v in rows]
    got = found_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 20)
    assert got == brute_topk(rows, 20) and all(len({j for j, _ in x}) == 20 for x in got.values())


def test_topk_by_norm_and_posting_lists(spark, monkeypatch):
    small_shards(monkeypatch)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=24) * (rng.random(24) < 0.2) * (1 + 30 * (i % 50 == 0)))]) for i in range(900)]
    assert found_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 5) == brute_topk(rows, 5)


def test_topk_of_large_components_is_exact(spark):
    rows = [(i, [float(2.0 ** (i % 40)), 1.0, -3.0]) for i in range(120)] + [(200, [float(2.0**57), 1.0, 1.0]), (201, [-(2.0**100), 3.0, 1.0]), (202, [0.0, 2.0**120, 1.0])]
    for some in (rows[:60], rows):
        assert found_topk(spark.createDataFrame(some, "vec_id long, embedding array<float>"), 5) == brute_topk(some, 5)


def test_sql_twins(spark, sf_dir):
    import duckdb

    from driftwell.llm.queries import QUERIES

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name, sql in SQL.items():
        df = QUERIES[name](spark, sf_dir)
        r = con.execute(sql)
        at = [c[0] for c in r.description]
        want = sorted((tuple(x[at.index(c)] for c in df.columns) for x in r.fetchall()), key=repr)
        assert sorted((tuple(x) for x in df.collect()), key=repr) == want, name
    assert OP10_SQL and op10_topk


def test_pipeline_stages_take_effect(spark, sf_dir):
    import corpus_pipeline as pipeline
    from driftwell.llm import decontaminate, pii, toxicity
    from driftwell.llm.common import table

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    expect = [None] * 5
    seen = docs
    for i, (name, stage) in enumerate(pipeline.STAGES):
        out = table(stage(spark, seen, sf_dir), f"test-{name}")
        if i < 4:
            assert out.columns == docs.columns and 0 < out.count() <= seen.count()
        expect[i] = out
        seen = out
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in (docs, *expect)]
    bad = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    assert ids[1] == ids[0] - bad
    rows = [(r.doc_id, r.text) for r in expect[0].collect()]
    assert ids[2] == {k for k, (_, c) in brute_components(rows, 5, 80).items() if k == c}
    leaks = {r.doc_id for r in decontaminate.scan(expect[1], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").collect()}
    assert ids[3] == ids[2] - leaks and ids[4] == ids[3] and ids[5] == ids[4]
    before = {r.doc_id: r.text for r in expect[2].collect()}
    assert all(r.text == pii.mask(before[r.doc_id]) and r.n_chars == len(r.text) for r in expect[3].collect())
    assert sum(r.length for r in expect[4].collect()) == sum(len(encode(r.text)) for r in expect[3].collect())


def test_pipeline_over_odd_column_names(spark, tmp_path):
    """Ids that repeat with differing rows, and names that need quoting, through all stages."""
    import corpus_pipeline as pipeline

    kind = "doc_id long, text string, `a.b` string, `a:b` string, `my col` struct<`x y`: int, `p.q`: string>, `Zoë` int, `tick``s` string, n_chars long"
    rng = random.Random(6)
    words = [" ".join("".join(rng.choices("aeioulnrst", k=6)) for _ in range(30)) for _ in range(60)]
    texts = [(i, ("gruzzlepit " if i % 4 == 0 else "") + w) for i, w in enumerate(words)] + [(5, words[5]), (5, "another text under the same id " + words[1][:20]), (7, None), (70, words[9])]
    spark.createDataFrame([(i, t, "x", "y", (1, "z"), 2, "t", len(t or "")) for i, t in texts], kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "quite other words stand here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names, before = docs.columns, docs
    for i, (name, stage) in enumerate(pipeline.STAGES):
        after = stage(spark, before, str(tmp_path))
        after.write.parquet(f"{tmp_path}/stage-{i}")
        before = spark.read.parquet(f"{tmp_path}/stage-{i}")
        if i < 4:
            assert before.columns == names
            assert before.where("`my col`.`p.q` = 'z' AND `a.b` = 'x' AND `Zoë` = 2").count() == before.count()
        if name == "near_duplicates":
            assert sorted(r.doc_id for r in before.select("doc_id").collect()) == sorted([i for i in range(60) if i % 4] + [5, 7])


def test_pipeline_over_odd_rows(spark, tmp_path):
    import corpus_pipeline as pipeline
    from driftwell.llm import toxicity

    kind = "doc_id long, text string, lang string, source string, n_chars long, part int, mark long, kept boolean, _row string, _again long, set_id string, named long, y int"
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("aeioulnrst", k=6))
    leak = " ".join(f"leak{i}" for i in range(20))
    texts = [(i, " ".join(["gruzzlepit"] * (i % 4 == 0) + [word() for _ in range(30)])) for i in range(160)]
    clean = [(i, t) for i, t in texts if i % 4]
    long = " ".join(word() for _ in range(30_000))
    odd = [(None, None), (None, "no id here at all"), (500, None), (501, ""), (502, " \n"), (503, f"so {leak} so"), (504, "write to bob@example.com or not " + word()), (505, long), (1, texts[1][1]), (1, texts[1][1]), (2, "another text under the id of two " + word()), (506, texts[3][1] + " x")]
    rows = [(i, t, "en", None, len(t or ""), 1, 2, True, "r", 3, "s", 4, 5) for i, t in texts + odd]
    rng.shuffle(rows)
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0), "x") for i in range(160)] + [(None, 0, 0, "x"), (501, None, None, "x")], "doc_id long, quality int, toxic int, text string").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak, 0), (2, None, 0), (None, "", 0)], "item_id long, text string, doc_id long").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = pipeline.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()} == {i for i, _ in texts if i % 4 == 0}
    ends = sorted(r.doc_id if r.doc_id is not None else -1 for r in out if r.start + r.length == r.doc_tokens)
    want = sorted([i for i, _ in clean if i != 506] + [2, -1, -1, 500, 501, 502, 504, 505])
    assert ends == want
    assert sum(r.length for r in out if r.doc_id == 505) == len(encode(long))
    assert sum(r.length for r in out if r.doc_id == 504) == len(encode(dict(odd)[504].replace("bob@example.com", "<email>")))
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0
