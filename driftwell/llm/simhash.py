"""Near duplicates by SimHash fingerprints and BK-trees.

1. A text's shingles (repeats included) vote on the 64 bits of its fingerprint; equal fingerprints form a class.
2. The bits are cut into `blocks` pieces; fingerprints that differ in at most RADIUS bits agree in `blocks` - RADIUS pieces at least. Each choice of
   so many pieces is a table, the leading bits of their value a key: linked fingerprints share a key in some table. As many bits are taken as
   leave about SHARD fingerprints a key at the table's size, and as few pieces as have so many bits (4 up to some 130 million fingerprints, then
   5, then 6), so shards don't grow with the input.
3. The fingerprints of a key form a shard, those of a key with more than twice SHARD several, by hash. Each shard becomes a BK-tree:
   children hang at their integer Hamming distance to the parent; trees are built level by level by array operations.
4. The shards' trees are broadcast to the blocks of queries, one block a shard, if they are under TREE_BYTES together (measured), else both meet in a
   shuffled join: trees of all the corpus may not be broadcast. From a node at distance d of the query only the edges from d - RADIUS to
   d + RADIUS are followed. What is connected already is not searched again: a subtree whose nodes all are in the query's component is left out.
   So a dense shard costs few comparisons and gives a forest of links, never its pairs.
5. Where a key has several shards, what these left outside the key's largest component is sent in blocks to all the key's trees in the same way, again
   with components to leave out. Nothing is capped; every pair at most RADIUS apart ends in one component.
6. Components come from the alternating star steps of the other near-duplicate operator.

Defined results: a text without words (or null) has fingerprint zero, which links like any other; rows without doc_id get their fingerprint, no
component, and link nothing; rows that share a doc_id are decided one by one, named by the smallest doc_id reachable; repeated rows repeat;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, drop_tables, map_batches, release, slices, table
from .neardup import components

BITS, RADIUS, SEED = 64, 3, 42
#: Fingerprints of a shard, about.
SHARD = 2048
#: Trees that are broadcast in a join, in bytes together.
TREE_BYTES = 32_000_000
#: Pairs of a query and a node that are compared at a time.
FRONTIER = 1 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_U = np.uint64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """A bit is set if over half of the shingles' hashes have it set; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []  # bytes split at the six blanks
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    size = min(shingle, len(words))
    ends = (starts + lengths)[size - 1 :]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=False)), _U, len(ends))
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = len(bits) // 255 * 255
        votes += bits[:full].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[full:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view(_U)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long)."""

    def make():
        return lambda cols: {"doc_id": cols["id"], "fp": np.array([fingerprint(t, shingle) for t in cols["text"]], _U).view(np.int64)}

    return map_batches(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")), "doc_id long, fp long", make)


class Forest:
    """BK-trees of several shards in arrays: a shard's nodes stand level by level, each node's children together and by distance."""

    def __init__(self, values: np.ndarray, edge: np.ndarray, first: np.ndarray, count: np.ndarray, origin: np.ndarray):
        """values: fingerprints; edge: a node's distance to its parent; first, count: its children; origin: where the value stood in build's."""
        self.values, self.edge, self.first, self.count, self.origin = values, edge, first, count, origin

    @classmethod
    def build(cls, values: np.ndarray, sizes: np.ndarray) -> Forest:
        """Trees over consecutive pieces of values, of the given sizes (1 at least); roots come first, in order."""
        root = np.cumsum(sizes) - sizes
        node = root  # of the level at hand, as places in values
        rest = np.delete(np.arange(len(values)), root)
        parent = np.repeat(np.arange(len(sizes)), sizes - 1)  # as places in the level
        levels, edges, firsts, counts, done = [node], [np.zeros(len(node), np.uint8)], [], [], len(node)
        while len(rest):
            d = np.bitwise_count(values[rest] ^ values[node[parent]]).astype(np.int64)
            key = parent * (BITS + 1) + d
            order = np.argsort(key, kind="stable")
            key, rest = key[order], rest[order]
            head = np.flatnonzero(np.diff(key, prepend=-1))
            count = np.bincount(key[head] // (BITS + 1), minlength=len(node))
            firsts.append(done + np.cumsum(count) - count)
            counts.append(count)
            node = rest[head]
            parent = np.cumsum(np.diff(key, prepend=-1) != 0) - 1
            keep = np.ones(len(rest), bool)
            keep[head] = False
            levels.append(node)
            edges.append((key[head] % (BITS + 1)).astype(np.uint8))
            done += len(node)
            rest, parent = rest[keep], parent[keep]
        firsts.append(np.full(len(node), done))
        counts.append(np.zeros(len(node), np.int64))
        origin = np.concatenate(levels)
        return cls(values[origin], np.concatenate(edges), np.concatenate(firsts), np.concatenate(counts), origin)

    def to_bytes(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.values.astype(_U), self.first.astype(np.int32), self.count.astype(np.uint8), self.edge))

    @classmethod
    def from_bytes(cls, data: bytes) -> Forest:
        n = len(data) // 14
        part = lambda kind, at: np.frombuffer(data, kind, n, at * n)
        return cls(part(_U, 0), part(np.uint8, 13), part(np.int32, 8).astype(np.int64), part(np.uint8, 12).astype(np.int64), np.arange(n))

    def levels(self, roots: int) -> list[tuple[int, int]]:
        """(start, end) of the levels' nodes, roots first."""
        out = [(0, roots)]
        while out[-1][1] < len(self.values):
            low, high = out[-1]
            out.append((high, high + int(self.count[low:high].sum())))
        return out

    def common(self, labels: np.ndarray, roots: int) -> np.ndarray:
        """For each node the label that all nodes of its subtree have, or -1."""
        out, parent = labels.copy(), self.parents()
        for low, high in self.levels(roots)[:0:-1]:
            p = parent[low - roots : high - roots]
            out[p[out[low:high] != labels[p]]] = -1
        return out

    def parents(self) -> np.ndarray:
        """The parents of all nodes but the roots."""
        return np.repeat(np.arange(len(self.values)), self.count)

    def search(self, queries: np.ndarray, starts: np.ndarray, sizes: np.ndarray, own: np.ndarray, nodes: np.ndarray, parts: np.ndarray, roots: int) -> np.ndarray:
        """Join the parts of queries and nodes at most RADIUS apart; returns the parts' representatives.

        starts, sizes: each query's root, and its tree's nodes; own, nodes: the parts of queries and nodes, as places in parts.
        """
        keys = self.parents() * (BITS + 1) + self.edge[roots:]  # ascending
        ends = np.cumsum(sizes)
        at = 0
        while at < len(queries):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + FRONTIER, "right")))
            common = self.common(parts[nodes], roots)
            q, node = np.arange(at, to), starts[at:to]
            while len(q):
                open_ = common[node] != parts[own[q]]
                q, node = q[open_], node[open_]
                d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
                near = d <= RADIUS
                hits = own[q[near]], nodes[node[near]]
                low = np.searchsorted(keys, node * (BITS + 1) + np.maximum(d - RADIUS, 0))
                n = np.searchsorted(keys, node * (BITS + 1) + np.minimum(d + RADIUS, BITS), "right") - low
                q = np.repeat(q, n)
                node = roots + np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(q))
                if len(hits[0]):
                    parts = join(parts, *hits)
                    common = self.common(parts[nodes], roots) if len(q) > FRONTIER // 16 else common
            at = to
        return parts


def join(parts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """parts (each element's representative, itself one of its own) after joining those of a and b pairwise."""
    parts = parts.copy()
    while True:
        p, q = parts[a], parts[b]
        apart = p != q
        if not apart.any():
            return parts
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        np.minimum.at(parts, np.maximum(p, q), np.minimum(p, q))
        while (shorter := parts[parts]).tobytes() != parts.tobytes():
            parts = shorter


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _trees(shards: DataFrame) -> DataFrame:
    """key, shard, of, tree (its arrays) and nodes (its fingerprints in the tree's order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            trees = [Forest.build(np.array(x, np.int64).view(_U), np.array([len(x)])) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array([t.to_bytes() for t in trees], pa.binary()), pa.array([t.values.view(np.int64).tolist() for t in trees], pa.list_(pa.int64()))], names=["key", "shard", "of", "tree", "nodes"])

    return shards.select("key", "shard", "fps", "of").mapInArrow(run, "key bigint, shard int, of int, tree binary, nodes array<bigint>")


def _searched(tests: DataFrame) -> DataFrame:
    """Links between the components (a, b) of queries and nodes, for rows of fps, own (the queries' components), tree and labels (the nodes')."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for fps, own, data, labels in zip(*(batch.column(i) for i in range(4)), strict=True):
                queries, tree = np.array(fps.as_py(), np.int64).view(_U), Forest.from_bytes(data.as_py())
                names, at = np.unique(np.array(own.as_py() + labels.as_py(), np.int64), return_inverse=True)
                mine, nodes = at[: len(queries)], at[len(queries) :]
                close = np.flatnonzero(tree.edge[1:] <= RADIUS)  # nodes linked with their parents
                parts = join(np.arange(len(names)), nodes[tree.parents()[close]], nodes[1 + close])
                parts = tree.search(queries, np.zeros(len(queries), np.int64), np.full(len(queries), len(tree.values)), mine, nodes, parts, 1)
                other = np.flatnonzero(parts != np.arange(len(names)))
                if len(other):
                    yield pa.RecordBatch.from_arrays([pa.array(names[parts[other]]), pa.array(names[other])], schema=_EDGES)
        release()

    return tests.select("fps", "own", "tree", "labels").mapInArrow(run, "a bigint, b bigint")


def _widths(blocks: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each choice of blocks - RADIUS pieces: their (first bit, bits), and all their bits."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    pieces = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return [(list(c), sum(w for _, w in c)) for c in combinations(pieces, blocks - RADIUS)]


def choose_keys(n: int, blocks: int | None = None) -> tuple[int, int]:
    """(pieces, bits of a key) that leave about SHARD of n fingerprints a key, were they spread evenly."""
    bits = max(0, math.ceil(math.log2(max(1, n) / SHARD)))
    room = {k: min(w for _, w in _widths(k)) for k in (4, 5, 6)}
    blocks = blocks or next((k for k, w in room.items() if w >= bits), 6)
    return blocks, min(bits, room[blocks])


def keys_of(fp: str, blocks: int, bits: int) -> Column:
    """The keys of a fingerprint: which pieces were chosen, and their first bits. Without bits there is one key for all."""
    out = []
    for t, (pieces, width) in enumerate(_widths(blocks)):
        value = F.lit(0).cast("long")
        for first, n in pieces:
            value = F.shiftleft(value, n).bitwiseOR(F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << n) - 1).cast("long")))
        out.append(F.shiftleft(F.lit(t).cast("long"), 40).bitwiseOR(F.shiftrightunsigned(value, width - bits)))
    return F.array(*out) if bits else F.array(F.lit(0).cast("long"))


def _sent(trees: DataFrame) -> DataFrame:
    """The trees (with their nodes' labels), to be broadcast if they are under TREE_BYTES together."""
    size = trees.agg(F.sum(F.octet_length("tree") + 8 * F.size("labels"))).first()[0] or 0
    return F.broadcast(trees) if size <= TREE_BYTES else trees


def _linked(classes: DataFrame, blocks: int, bits: int) -> DataFrame:
    """node, root (its component's smallest) for the fingerprints (fp, distinct) that link with others."""
    keyed = classes.select(F.explode(keys_of("fp", blocks, bits)).alias("key"), "fp")
    hot = keyed.groupBy("key").count().where(F.col("count") > 2 * SHARD).select("key", F.ceil(F.col("count") / SHARD).cast("int").alias("of"))
    hot = table(hot, "hot-keys")
    many = not hot.isEmpty()
    dealt = keyed.join(checked_broadcast(hot), "key", "left") if many else keyed.withColumn("of", F.lit(None).cast("int"))
    dealt = dealt.withColumn("shard", F.when(F.col("of").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), "of")).cast("int"))
    shards = dealt.groupBy("key", "shard").agg(F.collect_list("fp").alias("fps"), F.max("of").alias("of")).where("size(fps) > 1 OR of > 1")
    trees = table(_trees(shards), "trees")
    whole = trees.select("key", "shard", F.col("nodes").alias("fps"), F.col("nodes").alias("own"))
    links = table(_searched(whole.join(_sent(trees.select("key", "shard", "tree", F.col("nodes").alias("labels"))), ["key", "shard"])), "links")
    roots = table(components(links), "roots")
    if many:
        nodes = trees.where("of > 1").select("key", "shard", F.posexplode("nodes").alias("pos", "fp")).join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("key", "shard", "pos", "fp", F.coalesce("root", "fp").alias("label"))
        nodes = table(nodes, "nodes")
        main = nodes.groupBy("key", "label").count().groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
        labelled = trees.select("key", "shard", "tree").join(nodes.groupBy("key", "shard").agg(F.array_sort(F.collect_list(F.struct("pos", "label"))).alias("at")), ["key", "shard"]).select("key", "tree", F.col("at.label").alias("labels"))
        labelled = table(labelled, "labelled")
        queries = nodes.join(main, "key").where("label != main").groupBy("key", "shard").agg(F.collect_list(F.struct("fp", "label")).alias("q"))
        queries = table(queries.select("key", F.col("q.fp").alias("fps"), F.col("q.label").alias("own")), "queries")
        more = table(_searched(queries.join(_sent(labelled), "key")), "more")
        if not more.isEmpty():
            roots = table(components(links.unionAll(more)), "roots")
        drop_tables(nodes, labelled, queries, more)
    drop_tables(trees, links, hot)
    return roots


def link(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """One row per document: doc_id, fp (its fingerprint), component_id (the smallest doc_id of its component)."""
    rows = table(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = table(rows.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "classes")
    roots = _linked(classes.select("fp"), *choose_keys(classes.count(), blocks))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").where("root IS NOT NULL OR copies > 1").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("first_id").alias("named"))
    return rows.join(named.join(names, "root").select("fp", "named"), "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.coalesce("named", "doc_id")).alias("component_id"))
