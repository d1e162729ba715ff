"""Near duplicates by one-permutation MinHash, exact on the links it reports.

1. One pass over the texts hashes words and shingles, and keeps per document: the set's fingerprint and size, a signature of
   one permutation split into BINS bins (empty bins take the value of a filled bin that a per-bin random probe sequence meets
   first: optimal densification), and one hash per band of ROWS bins.
2. Documents with equal sets form classes; from here on a class stands for all its copies, however many.
3. Classes that share a band bucket are candidates. Each bucket gives a forest of edges, fewer than its members: in a bucket of up
   to BUCKET members the pairs whose signatures and sizes may belong to linked sets, in a larger one a star around its smallest
   member. The forests' components are the candidate clusters; every linked pair that shares a bucket is inside one.
4. Clusters are confirmed on full sets in blocks of about BLOCK members or BLOCK_BYTES, each with a few hubs of the whole cluster. What
   blocks and hubs leave apart (outsiders of the cluster's largest component) then meets all of the cluster, blockwise, first by
   signatures alone; full sets are shipped only for members that signatures can't tell apart. Every pair is
   tested unless it is connected already; a group emits links, never its pairs. Nothing is capped.
5. Components come from alternating large-star / small-star steps; nodes with more than 1/HUBS of all edges (HUBS of them at most)
   are joined by broadcast, so that no star's edges meet in one task. Each class gets its component's smallest doc_id.

A pair at the threshold shares no band with probability (1 - t^ROWS)^BANDS: 5e-11 at 0.85, 7e-8 at 0.8 (ROWS 4, BANDS 32).

Defined results: documents without words (or null) have an empty set and are linked with nothing; equal rows are linked
like any others; rows without doc_id are linked with nothing; an empty table gives an empty result; other columns are ignored. Where rows share a doc_id, `link` names the
component by the smallest doc_id of its rows, and `keep_one` decides by row: of a component's rows the one with the smallest doc_id
(then set) stays, whatever happens to the id's other rows; rows with empty sets or without doc_id stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import checked_broadcast, drop_tables, map_batches, release, slices, table

ROWS, BANDS = 4, 32
BINS = ROWS * BANDS
#: Signatures of linked sets agree in more than a share of the threshold less this, by size of the smaller set (from so many shingles on), but
#: for odds below 1e-8: six standard deviations, as bins of small sets depend on each other. Sets of fewer shingles aren't screened by signatures.
SLACK = {16: 0.35, BINS: 0.2}
#: Members of a bucket, and of a cluster's block, that a task holds at a time.
BUCKET, BLOCK = 2048, 1024
#: Bytes of full sets in a block, on average.
BLOCK_BYTES = 32_000_000
#: A node with more than this part of all edges is a hub.
HUBS = 1000

_U = np.uint64
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        done = 1
        while done < n:
            more = min(done, n - done)
            out[done : done + more] = out[:more] * _U(pow(base, done, 1 << 64))
            done += more
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


class Shingler:
    """Texts to sorted sets of 64-bit shingle hashes, by array operations on the text's bytes."""

    def __init__(self, size: int):
        self.size, self.up, self.down = size, _powers(_BASE, 1 << 15), _powers(_INVERSE, 1 << 15)

    def words(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        gap = np.flatnonzero(_SPACE[raw])
        edges = np.empty(len(gap) + 2, np.int64)
        edges[0], edges[-1], edges[1:-1] = -1, len(raw), gap
        start, end = edges[:-1] + 1, edges[1:]
        full = end > start
        start, end = start[full], end[full]
        if not len(start):
            return np.zeros(0, np.uint64)
        if len(raw) > len(self.up):
            n = 1 << len(raw).bit_length()
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)
        total = np.zeros(len(raw) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[raw] * self.up[: len(raw)], out=total[1:])
            return _mix((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))

    def __call__(self, text: str | None) -> np.ndarray:
        w = self.words(text) if text else np.zeros(0, np.uint64)
        if not len(w):
            return w
        n = max(1, len(w) - self.size + 1)
        with np.errstate(over="ignore"):
            h = np.zeros(n, np.uint64)
            for k in range(min(self.size, len(w))):
                h = _mix(h * _U(0x9FB21C651E98DF25) + w[k : k + n])
        return np.unique(h)


def _probes() -> np.ndarray:
    """For each bin the order in which it looks for a filled bin: a random permutation per bin."""
    rng = np.random.default_rng(7)
    return np.stack([rng.permutation(BINS) for _ in range(BINS)])


_PROBES = _probes()
_BAND_SALT = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _U(_BASE))


def signature(hashes: np.ndarray) -> np.ndarray:
    """BINS minima of one permutation, densified. The set must not be empty."""
    shift = 64 - (BINS - 1).bit_length()
    bins = (hashes >> _U(shift)).astype(np.int64)  # sorted, as the hashes are
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    sig = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    sig[bins[first]] = hashes[first]
    filled[bins[first]] = True
    if len(first) < BINS:
        empty = np.flatnonzero(~filled)
        order = _PROBES[empty]
        sig[empty] = sig[order[np.arange(len(empty)), filled[order].argmax(1)]]
    return sig


def bands(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = _BAND_SALT.copy()
        for k in range(ROWS):
            h = _mix(h * _U(0x9FB21C651E98DF25) + sig.reshape(BANDS, ROWS)[:, k])
    return h.view(np.int64)


def sketches(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, set_id (null for empty sets and where doc_id is null), n_shingles, sig (one byte a bin), band hashes."""

    def make():
        sets = Shingler(shingle)

        def step(cols: dict) -> dict:
            out: dict[str, list] = {"doc_id": cols["id"], "set_id": [], "n_shingles": [], "sig": [], "bands": []}
            for key, text in zip(cols["id"], cols["text"], strict=True):
                s = sets(text)
                out["n_shingles"].append(len(s))
                if len(s) and key is not None:
                    sig = signature(s)
                    out["set_id"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    out["sig"].append(_mix(sig).astype(np.uint8).tobytes())
                    out["bands"].append(bands(sig))
                else:
                    for k in ("set_id", "sig", "bands"):
                        out[k].append(None)
            return out

        return step

    src = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    return map_batches(src, "doc_id long, set_id binary, n_shingles long, sig binary, bands array<long>", make)


def _full_sets(docs: DataFrame, shingle: int, ids: DataFrame) -> DataFrame:
    """set_id and the whole set, for the classes in ids (set_id, key: a member's doc_id and text digest)."""

    def make():
        sets = Shingler(shingle)

        def step(cols: dict) -> dict:
            packed = [sets(t) for t in cols["text"]]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in packed]
            keep = [k == want for k, want in zip(keys, cols["set_id"], strict=True)]
            return {"set_id": [k for k, y in zip(keys, keep, strict=True) if y], "members": [s.tobytes() for s, y in zip(packed, keep, strict=True) if y]}

        return step

    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).join(checked_broadcast(ids), "doc_id")
    return map_batches(src.select("set_id", "text"), "set_id binary, members binary", make)


def least_agreement(n: np.ndarray, percent: int) -> np.ndarray:
    """Bins that must agree for sets of n shingles (of a pair, the smaller one) to be looked at."""
    slack = np.select([n >= k for k in sorted(SLACK, reverse=True)], [SLACK[k] for k in sorted(SLACK, reverse=True)], 1.0)
    return np.maximum(0.0, percent / 100 - slack) * BINS


class _Group:
    """Members of one group: pairs that may be linked are tested in order, unless they are connected already."""

    def __init__(self, rows: list[tuple], percent: int, exact: bool):
        """rows: (side, set_id, n, sig, root, members)."""
        self.rows, self.percent, self.exact = rows, percent, exact
        self.side = np.array([r[0] for r in rows])
        self.n = np.array([r[2] for r in rows])
        self.least = least_agreement(self.n, percent)
        self.sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1)
        seen: dict = {}
        self.part = np.array([seen.setdefault(r[4], len(seen)) for r in rows])

    def linked(self, i: int, j: int) -> bool:
        if not self.exact:
            return True
        p, q = np.frombuffer(self.rows[i][5], np.uint64), np.frombuffer(self.rows[j][5], np.uint64)
        if len(p) > len(q):
            p, q = q, p
        at = np.searchsorted(q, p)
        at[at == len(q)] = 0
        both = int(np.count_nonzero(q[at] == p))
        return 100 * both >= self.percent * (len(p) + len(q) - both)

    def forest(self) -> list[tuple[bytes, bytes]]:
        """Edges that connect what is connected, as stars around the least set of each part, for parts that grew; fewer than members.

        Rows of side 0 are tested against all, others only against those. Members of a part before (by their root) stand for it.
        """
        links, part, n = [], self.part, self.n
        for i in range(len(self.rows)):
            if self.side[i] != 0:
                continue
            other = np.flatnonzero((part != part[i]) & (100 * np.minimum(n, n[i]) >= self.percent * np.maximum(n, n[i])))
            if not len(other):
                continue
            agree = (self.sig[other] == self.sig[i]).sum(1)
            enough = agree >= np.minimum(self.least[other], self.least[i])
            near = other[enough]
            for j in near[np.argsort(-agree[enough], kind="stable")].tolist():
                if part[j] != part[i] and self.linked(i, j):
                    links.append((i, j))
                    part[part == part[j]] = part[i]
        stars: dict[int, set[bytes]] = {}
        for i in {x for link in links for x in link}:
            stars.setdefault(int(part[i]), set()).add(self.rows[i][1])
        return [(least, x) for own in stars.values() for least in [min(own)] for x in own if x != least]

    def doubtful(self) -> np.ndarray:
        """Members that signature and size can't tell apart from one of another root; side 0 against all."""
        out = np.zeros(len(self.rows), bool)
        for i in np.flatnonzero(self.side == 0).tolist():
            other = np.flatnonzero((self.part != self.part[i]) & (100 * np.minimum(self.n, self.n[i]) >= self.percent * np.maximum(self.n, self.n[i])))
            if len(other):
                near = other[(self.sig[other] == self.sig[i]).sum(1) >= np.minimum(self.least[other], self.least[i])]
                out[near] = True
                out[i] |= len(near) > 0
        return out


def _groups(batches, n: int):
    """Lists of the rows (without their first column) that share the first column, which the batches are sorted by."""
    held: list[tuple] = []
    now = None
    for batch in slices(batches):
        for row in zip(*(batch.column(i).to_pylist() for i in range(n)), strict=True):
            if row[0] != now and held:
                yield now, held
                held = []
            now = row[0]
            held.append(row[1:])
    if held:
        yield now, held
    held = []
    release()


def _scouts(rows: DataFrame, percent: int) -> DataFrame:
    """(part, side, set_id) of the members of each group of rows (part, side, set_id, n, sig, root) whose full sets have to be compared."""

    def run(batches):
        kind = pa.schema([("part", pa.int64()), ("side", pa.int32()), ("set_id", pa.binary())])
        for part, held in _groups(batches, 6):
            keep = [held[i] for i in np.flatnonzero(_Group([(*r, None) for r in held], percent, exact=False).doubtful()).tolist()]
            if keep:
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(keep), pa.int64()), pa.array([r[0] for r in keep], pa.int32()), pa.array([r[1] for r in keep], pa.binary())], schema=kind)

    return rows.select("part", "side", "set_id", "n", "sig", "root").repartition("part").sortWithinPartitions("part", "side").mapInArrow(run, "part long, side int, set_id binary")


def _forests(rows: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Links (a, b) inside each group of rows (part, side, set_id, n, sig, root, members); a task holds one group at a time."""

    def run(batches):
        kind = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        for _, held in _groups(batches, 7):
            out = _Group(held, percent, exact).forest() if len(held) > 1 else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())], schema=kind)

    return rows.select("part", "side", "set_id", "n", "sig", "root", "members").repartition("part").sortWithinPartitions("part", "side").mapInArrow(run, "a binary, b binary")


def _with_least(edges: DataFrame, key: str, other: str, most: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The edges, each with m: the least of `key` itself and its values of `other` (and the table that holds m by node).

    There are at most `most` edges. A hub's edges stay where they are: hubs are at most HUBS nodes, as each has more than 1/HUBS of
    that number of edges, and are broadcast.
    """
    low = table(edges.groupBy(key).agg(F.min(other).alias("m"), F.count("*").alias("degree")).select(F.col(key).alias("node"), F.least(key, "m").alias("m"), "degree"), name)
    hubs = F.broadcast(low.where(F.col("degree") * HUBS > most).select(F.col("node").alias("hub"), F.col("m").alias("hub_m")))
    at_hubs = edges.join(hubs, F.col(key) == F.col("hub")).select("a", "b", F.col("hub_m").alias("m"))
    others = edges.join(hubs, F.col(key) == F.col("hub"), "left_anti").join(low, F.col(key) == F.col("node")).select("a", "b", "m")
    return at_hubs.unionAll(others), low


def _unsettled(edges: DataFrame) -> tuple[int, int]:
    """(distinct edges, nodes that keep them from being stars around their least nodes: smaller ends that are larger ones elsewhere, too, and
    nodes that are the larger end of several edges)."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("above")).unionAll(edges.select(F.col("b").alias("node"), F.lit(1).alias("above")))
    nodes = ends.groupBy("node").agg(F.count("*").alias("n"), F.sum("above").alias("above"))
    n, bad = nodes.agg(F.sum("above"), F.count_if((F.col("above") > 1) | ((F.col("above") > 0) & (F.col("above") < F.col("n"))))).first()
    return n or 0, bad


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, root (its component's smallest node) for all nodes of the edges (a, b), by alternating star steps."""
    now = table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), name)
    while (left := _unsettled(now))[1]:
        # large star: every larger neighbour of a node moves to the node's smallest neighbour
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near, low = _with_least(both, "a", "b", 2 * left[0], name)
        large = table(near.where("b > a").select(F.col("m").alias("a"), "b").where("a < b"), name)
        # small star: a node and its smaller neighbours move to the smallest of them
        near, down = _with_least(large, "b", "a", left[0], name)
        small = near.select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        new = table(small.where("a < b").distinct(), name)
        drop_tables(now, low, large, down)
        now = new
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _linked(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, set_id, root (its component's smallest set) and named (its smallest doc_id; both null for sets without links or copies)."""
    rows = table(sketches(docs, shingle), "sketches")
    classes = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = table(classes, "classes")

    # candidate clusters: what band buckets connect
    keys = classes.select(F.explode("bands").alias("band"), "set_id")
    buckets = keys.groupBy("band").agg(F.min("set_id").alias("centre"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("set_id")).alias("x"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("y")).where("size > 1")
    buckets = buckets.groupBy("size", "x", "y").agg(F.min(F.struct("band", "centre")).alias("one")).select("one.band", "one.centre", "size")
    entries = table(keys.join(buckets, "band"), "entries")
    facts = classes.select("set_id", "first_id", "n", "sig")
    small = entries.where(F.col("size") <= BUCKET).join(facts, "set_id").select(F.col("band").alias("part"), F.lit(0).alias("side"), "set_id", "n", "sig", F.col("set_id").alias("root"), F.lit(None).cast("binary").alias("members"))
    large = entries.where((F.col("size") > BUCKET) & (F.col("set_id") != F.col("centre"))).select(F.col("centre").alias("a"), F.col("set_id").alias("b"))
    clusters = table(components(_forests(small, percent, exact=False).unionAll(large)).select(F.col("node").alias("set_id"), F.col("root").alias("cluster")), "clusters")
    drop_tables(entries)

    # links inside the clusters' blocks, on full sets
    members = table(clusters.join(facts, "set_id"), "members")
    sets = table(_full_sets(docs, shingle, members.select(F.col("first_id").alias("doc_id"), "set_id")), "sets")
    if sets.count() > members.count():  # rows that repeat whole
        sets = table(sets.dropDuplicates(["set_id"]), "sets")
    sizes = members.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    shape = [F.lit(0).alias("side"), "set_id", "n", "sig", F.col("set_id").alias("root")]
    plain = dealt.select(F.xxhash64("cluster", "block").alias("part"), *shape)
    wide = table(dealt.where("blocks > 1"), "wide")
    hubs = wide.groupBy("cluster", "blocks").agg(F.min("set_id").alias("h1"), F.max("set_id").alias("h2"), F.min_by("set_id", F.xxhash64("set_id", F.lit(2))).alias("h3"), F.min_by("set_id", F.xxhash64("set_id", F.lit(3))).alias("h4"), F.max_by("set_id", "n").alias("h5"))
    hubs = hubs.select("cluster", F.explode(F.array_distinct(F.array("h1", "h2", "h3", "h4", "h5"))).alias("set_id"))
    hubs = wide.join(hubs, ["cluster", "set_id"]).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("to != block")
    blocks = plain.unionAll(hubs.select(F.xxhash64("cluster", "to").alias("part"), *shape)).join(sets, "set_id")
    links = table(_forests(blocks, percent, exact=True), "links")
    roots = table(components(links), "roots")

    if not wide.isEmpty():  # what blocks and hubs left apart in wide clusters meets all of its cluster
        known = table(wide.select("cluster", "block", "blocks", "set_id", "n", "sig").join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id")), "known")
        counted = known.groupBy("cluster", "root").count()
        main = counted.groupBy("cluster").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count("*").alias("of")).where("of > 1")
        known = known.join(main, "cluster").withColumn("out", F.col("root") != F.col("main"))
        strays = known.where("out").groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("groups"))
        known = table(known.join(strays, "cluster"), "known")
        shape = ["set_id", "n", "sig", "root"]
        group = F.pmod(F.xxhash64("set_id", F.lit(4)), F.col("groups")).cast("int")
        tests = known.where("out").withColumn("group", group).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tests = tests.select(F.xxhash64("cluster", "group", "to", F.lit(5)).alias("part"), F.lit(0).alias("side"), *shape)
        every = known.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        every = every.select(F.xxhash64("cluster", "group", "block", F.lit(5)).alias("part"), F.lit(1).alias("side"), *shape)
        doubtful = table(_scouts(tests.unionAll(every), percent), "doubtful").join(known.select(*shape), "set_id").join(sets, "set_id")
        more = table(_forests(doubtful, percent, exact=True), "more")
        if not more.isEmpty():
            roots = table(components(links.unionAll(more)), "roots")
        drop_tables(known, more)
    drop_tables(clusters, members, sets, wide, links)

    named = classes.select("set_id", "first_id", "copies").join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = named.where("root IS NOT NULL OR copies > 1").withColumn("root", F.coalesce("root", "set_id"))
    names = named.groupBy("root").agg(F.min("first_id").alias("named"))
    return rows.select("doc_id", "n_shingles", "set_id").join(named.join(names, "root").select("set_id", "root", "named"), "set_id", "left")


def link(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (its component's smallest doc_id), kept."""
    out = _linked(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), shingle, percent)
    return out.select("doc_id", "n_shingles", F.coalesce("named", "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of one document of each group: the one with the smallest doc_id (documents without doc_id stay)."""
    found = table(_linked(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), shingle, percent), "found")
    ids = docs[id_col].cast("long")
    losers = found.where("doc_id != named").select(F.col("doc_id").alias("_lost")).distinct()
    repeated = table(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again")), "repeated")
    if repeated.isEmpty():
        return docs.join(checked_broadcast(losers), ids == losers["_lost"], "left_anti")

    # ids of several rows: decide by (doc_id, set)
    again = checked_broadcast(repeated)
    single = docs.join(again, ids == repeated["_again"], "left_anti")
    single = single.join(checked_broadcast(losers), ids == losers["_lost"], "left_anti")
    best = found.where("set_id IS NOT NULL").groupBy(F.coalesce("root", "set_id").alias("root")).agg(F.min(F.struct("doc_id", "set_id")).alias("w")).select(F.col("w.doc_id").alias("_id"), F.col("w.set_id").alias("_set"))
    named = docs.join(again, ids == repeated["_again"], "left_semi").select(F.struct("*").alias("_row"))
    marked = _with_set(named, shingle, id_col, text_col)
    empty = marked.where("_set IS NULL").select("_row")
    kept = marked.where("_set IS NOT NULL").join(best, ["_id", "_set"], "left_semi").groupBy("_id", "_set").agg(F.first("_row").alias("_row")).select("_row")
    return single.unionByName(kept.unionAll(empty).select("_row.*"))


def _with_set(rows: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """_row, _id and _set (the fingerprint of the row's shingle set; null if that is empty) for rows packed as _row."""

    def run(batches):
        sets = Shingler(shingle)
        for batch in batches:
            found = [sets(t) for t in batch.column(2).to_pylist()]
            marks = pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), marks], names=["_row", "_id", "_set"])

    src = rows.select("_row", F.col("_row").getField(id_col).cast("long").alias("_id"), F.col("_row").getField(text_col).alias("_text"))
    return src.mapInArrow(run, StructType([rows.schema["_row"], StructField("_id", LongType()), StructField("_set", BinaryType())]))
