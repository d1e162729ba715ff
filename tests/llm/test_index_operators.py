"""Fill-in-middle, SimHash and periodic runs against brute force, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from driftwell.llm import fim, periodic, simhash
from driftwell.llm.queries import op11_fim, op12_simhash, op13_runs

WIDE = "doc_id long, text string, n long, key string, part string, fp string, `members` int, `a.b` string"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# fill-in-middle


def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    head, middle, tail = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    return len(units), "spm" if h4 % 100 < 20 else "psm", len(head), len(middle), f"<S>{tail}<P>{head}<M>{middle}" if h4 % 100 < 20 else f"<P>{head}<S>{tail}<M>{middle}"


def check_fim(frame, rows):
    got = sorted((r.doc_id, r.n, r.form, r.prefix_chars or -1, r.middle_chars or -1, r.output, r.back) for r in fim.examples(frame).withColumn("back", fim.restored(F.col("form"), F.col("output"))).collect())
    want = []
    for i, t in rows:
        n, form, p, m, out = brute_fim(i, t)
        want.append((i, n, form, p or -1, m or -1, out, t or ""))
    assert got == sorted(want)


def test_boundary_lists_select_what_was_encoded():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        for most in (1, 3, 1000):
            values = np.cumsum(rng.integers(1, most + 1, n))
            got = fim.BoundaryList(fim.encode(values))
            assert got.n == n
            assert n == 0 or (got.select(np.arange(n)) == values).all()
    assert len(fim.encode(np.cumsum(rng.integers(1, 9, 10_000)))) < 10_000 * 5 / 8 + 64  # a few bits a unit


def test_examples_are_those_of_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op11_fim(spark, sf_dir).collect()}
    for i, t in rows:
        n, form, p, m, out = brute_fim(i, t)
        r = got.pop(i)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, sha(out), sha(t or ""))
    assert not got


def test_odd_texts_make_examples(spark):
    texts = [None, "", " ", "a", "\0", "x<P>y", "a<S", "<", "S><M", "<P", "Zoë 😀😀 ab\ncd\r\n", "İıſK", "é" * 40, "word " * 30_000, "😀" * 5000]
    rows = [(i, t) for i, t in enumerate(texts * 8)] + [(3, "a"), (3, "other text")]
    wide = [(i, t, 1, "k", "p", "f", 2, "z") for i, t in rows]
    check_fim(spark.createDataFrame(wide, WIDE), rows)
    assert fim.examples(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    (r,) = fim.examples(spark.createDataFrame([(None, "some text here")], "doc_id long, text string")).collect()
    assert r.doc_id is None and r.n == 5


def test_a_text_that_most_rows_share_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(fim, "MEMBERS", 40)
    rows = [(i, "the same words" if i % 3 else f"text {i % 50}") for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    check_fim(frame, rows)
    parts = [r for r in fim.index(frame).select("text", F.size("members").alias("k")).collect() if r.text == "the same words"]
    assert len(parts) > 5 and sum(r.k for r in parts) == 1000


def test_texts_with_one_hash_stay_apart(spark, monkeypatch):
    """Texts are compared whole: with a hash that is the same for all, the groups are the same."""
    monkeypatch.setattr(fim.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    rows = [(i, f"text {i % 9}") for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert fim.index(frame).count() == 9
    check_fim(frame, rows)


# SimHash


def brute_print(text, size=3):
    w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_parts(prints):
    """Smallest id of each id's component, for {id: fingerprint}."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def linked(spark, values, blocks):
    """Components of given fingerprints, as sets."""
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    out = {}
    for r in simhash._linked(frame, *simhash.choose_keys(len(values), blocks)).collect():
        out.setdefault(r.root, set()).add(int(np.int64(r.node).view(np.uint64)))
    return {frozenset(x) for x in out.values()}


def balls(rng, centres, n, most):
    seen = set()
    centres = [rng.getrandbits(64) for _ in range(centres)]
    while len(seen) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, most)):
            x ^= 1 << rng.randrange(64)
        seen.add(x)
    return sorted(seen, key=lambda x: x * 0x9E3779B97F4A7C15 % 2**64)


def wanted(values):
    out = {}
    for i, root in brute_parts(dict(enumerate(values))).items():
        out.setdefault(root, set()).add(values[i])
    return {frozenset(x) for x in out.values() if len(x) > 1}


def test_simhash_is_that_of_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    prints = {i: brute_print(t) for i, t in rows}
    parts = brute_parts(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op12_simhash(spark, sf_dir).collect()} == {i: (f"{p:016x}", parts[i]) for i, p in prints.items()}


@pytest.mark.parametrize("blocks", [4, 5, 6])
@pytest.mark.parametrize("shard", [8, 100_000])
def test_no_link_is_lost_with_any_number_of_pieces(spark, monkeypatch, blocks, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    values = balls(random.Random(blocks), 25, 400, 6) + [0, 7, 15, 2**64 - 1, 2**63]
    assert linked(spark, values, blocks) == wanted(values)


@pytest.mark.parametrize("tree_bytes", [simhash.TREE_BYTES, 0])
def test_keys_of_several_shards_lose_nothing(spark, monkeypatch, tree_bytes):
    monkeypatch.setattr(simhash, "SHARD", 16)
    monkeypatch.setattr(simhash, "TREE_BYTES", tree_bytes)
    rng = random.Random(5)
    low = [v & 0xFFFFFF for v in balls(rng, 40, 500, 5)]  # 40 high bits in common: two tables of one key
    values = sorted(set(low) | set(balls(rng, 3, 300, 7)))
    assert linked(spark, values, 4) == wanted(values)


def test_forests_of_trees_search_whole(monkeypatch):
    rng = random.Random(3)
    for trial in range(30):
        monkeypatch.setattr(simhash, "FRONTIER", rng.choice([50, 1000, 1 << 20]))
        lists = [balls(rng, max(1, n // 10), n, 6) for n in (rng.choice([1, 2, 3, 40, 150]) for _ in range(rng.randint(1, 6)))]
        values, sizes = np.array([x for own in lists for x in own], np.uint64), np.array([len(x) for x in lists])
        tree, roots = simhash.Forest.build(values, sizes), len(sizes)
        place = np.empty(len(values), np.int64)
        place[tree.origin] = np.arange(len(values))
        trees = np.repeat(np.arange(roots), sizes)
        parts = tree.search(values, trees, sizes[trees], place, np.arange(len(values)), np.arange(len(values)), roots)[place]
        at = 0
        for own in lists:
            got = {}
            for x, p in zip(own, parts[at : at + len(own)].tolist()):
                got.setdefault(p, set()).add(x)
            assert {frozenset(x) for x in got.values() if len(x) > 1} == wanted(own)
            at += len(own)
        # an edge is the distance to the parent
        assert (np.bitwise_count(tree.values[roots:] ^ tree.values[tree.parents()]) == tree.edge[roots:]).all()


def test_keys_follow_the_number_of_fingerprints():
    assert [simhash.choose_keys(n) for n in (0, 2048, 2049, 10**6, 10**8, 10**9, 10**11, 10**13)] == [(4, 0), (4, 0), (4, 1), (4, 9), (4, 16), (5, 19), (6, 26), (6, 31)]
    for blocks in (4, 5, 6):  # whatever RADIUS bits differ, some choice of pieces has none of them
        for at in itertools.combinations(range(0, 64, 3), 3):
            assert any(all(not first <= bit < first + n for first, n in pieces for bit in at) for pieces, _ in simhash._widths(blocks))


def test_odd_rows_have_fingerprints(spark):
    texts = [None, "", " \n", "One", "one", "one two", "ONE  two", "a b c d e f", "x" * 100_000, "w " * 60_000, "é É", "\x0b\x0c"]
    rows = [(i, t, 1, "k", "p", "f", 2, "z") for i, t in enumerate(texts)] + [(3, "another text of five words", 1, "k", "p", "f", 2, "z"), (None, "one", 1, "k", "p", "f", 2, "z")]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fp % 2**64, r.component_id) for r in simhash.link(spark.createDataFrame(rows, WIDE)).collect()), key=str)
    parts = brute_parts({i: brute_print(t) for i, t in enumerate([*texts, rows[-2][1]])})
    want = [(False, i, brute_print(t), parts[i]) for i, t in enumerate(texts)] + [(False, 3, brute_print(rows[-2][1]), 3), (True, 0, brute_print("one"), None)]
    assert got == sorted(want, key=str)
    assert simhash.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# periodic runs


def brute_runs(w):
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(12, 2 * p):
                out.setdefault((i, j + p), p)
            i = j + 1
    return sorted((a, b - a, p) for (a, b), p in out.items())


def altered(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def collapsed(w, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_are_those_of_brute_force(spark, sf_dir):
    rows = {r.doc_id: words_of(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op13_runs(spark, sf_dir).collect()}
    assert set(got) == set(rows)
    planted = 0
    for i, w in rows.items():
        if len(w) > 1500:
            continue
        w = altered(i, w)
        runs, r = sorted(brute_runs(w), key=lambda x: (x[0], x[2])), got[i]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{a},{n},{p}\n" for a, n, p in runs))
        assert r.collapsed_sha256 == sha(collapsed(w, runs))
        planted += bool(runs)
    assert planted > 5


def test_runs_of_made_up_texts(spark):
    rng = random.Random(8)
    texts = [None, "", "\t", "a", "a " * 11, "a " * 12, "b " + "a b " * 6, "a b c " * 4 + "a b d", "x" * 50_000, "😀 é " * 10, "one\x0btwo\x0c" * 9]
    for _ in range(300):
        w = [str(rng.randrange(rng.choice([1, 2, 3, 40]))) for _ in range(rng.choice([13, 40, 150]))]
        if rng.random() < 0.7:
            a = rng.randrange(len(w))
            p = 1 + rng.randrange((len(w) - a) // 3 + 1)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        texts.append(" ".join(w))
    rows = [(i, t, 1, "k", "p", "f", 2, "z") for i, t in enumerate(texts)] + [(4, "again", 1, "k", "p", "f", 2, "z"), (None, "c " * 20, 1, "k", "p", "f", 2, "z")]
    found = periodic.find(spark.createDataFrame(rows, WIDE)).collect()
    assert len(found) == len(rows)
    for r, (i, t, *_) in zip(sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words == 1 and r.doc_id == 4)), sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] == "again"))):
        w = words_of(t)
        runs = sorted(brute_runs(w), key=lambda x: (x[0], x[2]))
        assert (r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) == (i, len(w), runs, collapsed(w, runs))
    assert periodic.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_repetitive_texts_take_seconds():
    for text, period in (("a " * 60_000, 1), ("v w x y z " * 12_000, 5), (" ".join(map(str, range(20_000))) + " " + " ".join(map(str, range(20_000))), 20_000)):
        _, ids, starts = periodic._words([None, text, "tail"])
        (_, found, _) = periodic.runs_of(ids, starts)
        assert found == {(0, len(text.split())): period}
