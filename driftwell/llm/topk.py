"""Exact top-k inner-product search over an impact-ordered, score-at-a-time index.

Components are quantised to integers (floor of SCALE times the value), so scores are exact integers. Candidates are dealt to shards by a
hash. A shard keeps its members in blocks by descending norm, a block its postings in segments: a segment holds the
members of one dimension whose quantised magnitude falls into one impact level (halves of the block's largest). Query
blocks stream past a shard. For each block of members the segments are processed by descending impact, score at a time,
for all queries of the block; sparse levels are posting lists, dense ones a packed matrix. A query's k best so far give a
score that a further member has to reach; after every level Cauchy-Schwarz on the norms of the postings that are left tells who still
can. Processing stops when that proves all but a few members out (or the levels are used up); the members that are
left are rescored exactly. A block whose largest norm can't reach any query's bound is skipped, and so are those after it.

Rows shuffled are packed chunks of a shard and query blocks, one copy per shard; every (query, shard) returns its k best, and a last
aggregation ranks them. Memory per task: one shard (SHARD_BYTES) and the scores of one query block with one block of members.

Defined results: vectors that are null, or hold null or non-finite components, take no part, nor do rows without vec_id; shorter vectors
count as padded with zeros; ties go to the smaller vec_id; empty tables give no rows. Rows of one vec_id are one query and one
candidate: whole repeats count once, and differing vectors of an id score the best of their products, so that a query
gets k different other ids. Components of any finite size are exact; scores outside a long's range count as its ends.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

SCALE = 64
#: Members of a block, queries of a block.
BLOCK, BLOCK_QUERIES = 1024, 512
#: Least members of a shard, and the bytes that bound it.
SHARD, SHARD_BYTES = 4096, 128_000_000
#: Impact levels; a level with a smaller share of a block's components than SPARSE is kept as posting lists.
LEVELS, SPARSE = 4, 0.08
_LOW, _HIGH = -(2**63), 2**63 - 1


def quantise(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * value) as the smallest of int16, int64 and Python integers that holds all."""
    with np.errstate(over="ignore"):
        x = np.floor(values * SCALE)
    top = np.abs(x).max(initial=0)
    if top < 2**62:
        return x.astype(np.int16 if top < 2**15 else np.int64)
    return np.array([int(v) if np.isfinite(v) else int(w) * SCALE for v, w in zip(x.tolist(), values.tolist(), strict=True)], object)


class Block:
    """Members of similar norm with their posting segments by impact level."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, norm: np.ndarray):
        self.ids, self.matrix, self.norm = ids, matrix, float(norm.max(initial=0))
        self.repeats = len(np.unique(ids)) < len(ids)
        self.top = int(np.abs(matrix).max(initial=0))
        self.levels: list[tuple] = []
        if not fits(self.top, self.top, matrix.shape[1], 2**53):
            return
        kind = np.float32 if fits(self.top, self.top, matrix.shape[1], 2**24) else np.float64
        size, done = np.abs(matrix.astype(np.int64)), np.zeros(matrix.shape, bool)
        for level in range(LEVELS):
            now = ~done if level == LEVELS - 1 else (size << level + 1 > self.top) & ~done
            done |= now
            rest = np.where(done, 0, matrix).astype(np.float64)
            if np.count_nonzero(now) < SPARSE * now.size:
                member, dim = np.nonzero(now)
                order = np.argsort(dim, kind="stable")
                member, dim = member[order], dim[order]
                value, cut = matrix[member, dim].astype(kind), np.searchsorted(dim, np.arange(matrix.shape[1] + 1))
                postings = [(d, member[a:b], value[a:b, None]) for d, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            else:
                postings = np.where(now, matrix, 0).astype(kind)
            self.levels.append((postings, np.sqrt((rest * rest).sum(1))))

    def reach(self, q: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(member, query, score) of every member that may be among a query's k best."""
        width = self.matrix.shape[1]
        if not self.levels or not fits(q.top, self.top, width, 2**53):
            return self.whole(q)
        kind = np.float32 if fits(max(q.top, self.top), self.top, width, 2**24) else np.float64
        by_dim = np.ascontiguousarray(q.at(width).T).astype(kind)
        score = np.zeros((len(self.ids), len(q.ids)), kind)
        bound, enough = q.bound[None, :], 4 * q.k * len(q.ids)
        for n, (postings, left) in enumerate(self.levels):
            if isinstance(postings, list):
                for d, member, value in postings:
                    score[member] += value * by_dim[d]
            else:
                score += postings.astype(kind, copy=False) @ by_dim
            if n == LEVELS - 1:
                break  # scores are exact
            if q.full:
                alive = score + np.outer(left * (1 + 1e-5) + 1e-3, q.norm).astype(kind) >= bound
                if np.count_nonzero(alive) <= enough:
                    return self.rescore(q, *np.nonzero(alive))
        if not q.full and not self.repeats and len(self.ids) > q.k + 1:  # no bound yet: the block's own k-th best other
            other = np.where(self.ids[:, None] == q.ids[None, :], -np.inf, score)
            bound = np.maximum(bound, np.partition(other, len(self.ids) - q.k, axis=0)[len(self.ids) - q.k])
        member, query = np.nonzero(score >= bound)
        return member, query, score[member, query].astype(np.int64)

    def rescore(self, q: Queries, member: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out, rows = np.empty(len(member), np.int64), q.at(self.matrix.shape[1])
        for at in range(0, len(member), 50_000):
            part = slice(at, at + 50_000)
            out[part] = np.einsum("ij,ij->i", rows[query[part]].astype(np.int64), self.matrix[member[part]].astype(np.int64))
        return member, query, out

    def whole(self, q: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All scores, for components beyond the floating types' exact range."""
        rows = q.at(self.matrix.shape[1])
        kind = np.int64 if fits(q.top, self.top, self.matrix.shape[1], 2**63) else object
        score = self.matrix.astype(kind) @ rows.astype(kind).T
        if kind is object:
            score = np.vectorize(lambda s: min(max(s, _LOW), _HIGH), otypes=[np.int64])(score)
        member, query = np.indices(score.shape).reshape(2, -1)
        return member, query, score.ravel()


def fits(a: int, b: int, width: int, limit: int) -> bool:
    return int(a) * int(b) * max(width, 1) < limit


class Queries:
    """A block of queries and each one's k best so far."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.matrix, self.k = ids, matrix, k
        self.top = int(np.abs(matrix).max(initial=0))
        wide = matrix.astype(np.float64)
        self.norm = np.sqrt((wide * wide).sum(1))
        self.query, self.vec, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bound, self.full = np.full(len(ids), -np.inf), False

    def at(self, width: int) -> np.ndarray:
        have = self.matrix.shape[1]
        return self.matrix[:, :width] if have >= width else np.pad(self.matrix, ((0, 0), (0, width - have)))

    def take(self, vec: np.ndarray, query: np.ndarray, score: np.ndarray, repeats: bool) -> None:
        """Merge further candidates: other ids than the query's own, each id once."""
        other = self.ids[query] != vec
        query, vec, score = (np.concatenate(x) for x in ((self.query, query[other]), (self.vec, vec[other]), (self.score, score[other])))
        if repeats:
            order = np.lexsort((-score.astype(object) if _LOW in score else -score, vec, query))
            query, vec, score = query[order], vec[order], score[order]
            first = np.append(True, (query[1:] != query[:-1]) | (vec[1:] != vec[:-1]))[: len(query)]
            query, vec, score = query[first], vec[first], score[first]
        order = np.lexsort((vec, ~score, query))  # ~s orders like -s, without overflow
        query, vec, score = query[order], vec[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        best = rank < self.k
        self.query, self.vec, self.score = query[best], vec[best], score[best]
        last = rank[best] == self.k - 1
        self.bound[self.query[last]] = self.score[last].astype(np.float64)
        self.full = bool(last.sum() == len(self.ids))


class Shard:
    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        wide = matrix.astype(np.float64)
        norm = np.sqrt((wide * wide).sum(1))
        order = np.argsort(-norm, kind="stable")
        self.blocks = [Block(ids[at], matrix[at], norm[at]) for at in (order[i : i + BLOCK] for i in range(0, len(order), BLOCK))]
        self.repeats = len(np.unique(ids)) < len(ids)

    def search(self, q: Queries) -> Queries:
        for block in self.blocks:
            if q.full and not (block.norm * (1 + 1e-9) * q.norm >= q.bound * (1 - 1e-9 * np.sign(q.bound))).any():
                break  # norms descend: no later member reaches a bound
            member, query, score = block.reach(q)
            q.take(block.ids[member], query, score, self.repeats)
        return q


def _rows(ids: list, chunks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and one matrix of packed chunks of differing width and type."""
    width = max(m.shape[1] for m in chunks)
    kind = object if any(m.dtype == object for m in chunks) else np.int64 if any(m.dtype == np.int64 for m in chunks) else np.int16
    return np.concatenate(ids), np.concatenate([np.pad(m.astype(kind), ((0, 0), (0, width - m.shape[1]))) for m in chunks])


_CHUNK = "part int, ids binary, data binary"
_KIND = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())])


def _chunks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(part, ids, data): rows (vec_id, v, part) quantised and packed, at most `size` of a part together, where they lie."""

    def run(batches):
        held: dict[int, list] = {}

        def pack(part: int) -> pa.RecordBatch:
            own = held.pop(part)
            width = max(len(v) for _, v in own)
            data = np.zeros((len(own), width))
            for i, (_, v) in enumerate(own):
                data[i, : len(v)] = v
            packed = pickle.dumps(quantise(data.ravel()).reshape(data.shape), 5)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.array([i for i, _ in own], np.int64).tobytes()], pa.binary()), pa.array([packed], pa.binary())], schema=_KIND)

        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            for i, (key, part) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                own = held.setdefault(part, [])
                own.append((key, flat[ends[i - 1] if i else 0 : ends[i]]))
                if len(own) >= size:
                    yield pack(part)
        for part in list(held):
            yield pack(part)

    return table(rows.select("vec_id", "v", "part").mapInArrow(run, _CHUNK), name)


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row where is_query (a Column) holds its k best other rows."""
    x = F.col("v")
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), is_query.alias("is_query"))
    usable = usable.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    # ids in one narrow pass: how many rows there are, how many queries, and whether an id repeats
    found = usable.groupBy("vec_id").agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.count_if("is_query").alias("queries"))
    found = found.agg(F.sum("n"), F.count("*"), F.max("width"), F.sum("queries")).first()
    n, ids, width, asked = (int(c or 0) for c in found)
    if n > ids:
        usable = usable.dropDuplicates(["vec_id", "v"])  # combined before its shuffle: copies of one row never meet in one task

    most = max(SHARD, SHARD_BYTES // (16 * max(width, 1)))
    each = min(max(SHARD, n // (4 * vectors.sparkSession.sparkContext.defaultParallelism)), most)
    shards, blocks = max(1, -(-n // each)), max(1, -(-asked // BLOCK_QUERIES))
    deal = lambda parts: F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int").alias("part")
    candidates = _chunks(usable.select("vec_id", "v", deal(shards)), BLOCK, "candidates").withColumn("side", F.lit(0))
    queries = usable.where("is_query").select("vec_id", "v", deal(blocks)).repartition(blocks, "part")
    queries = _chunks(queries, BLOCK_QUERIES, "queries").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("side", F.lit(1))

    def meet(batches):
        kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        now, chunks, shard = None, ([], []), None
        for batch in batches:
            for part, side, own, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if part != now:
                    now, chunks, shard = part, ([], []), None
                own, data = np.frombuffer(own, np.int64), pickle.loads(data)  # noqa: S301  written by _chunks
                if side == 0:
                    chunks[0].append(own)
                    chunks[1].append(data)
                elif chunks[0]:
                    shard = shard or Shard(*_rows(*chunks))
                    q = shard.search(Queries(own, data, k))
                    yield pa.RecordBatch.from_arrays([pa.array(own[q.query]), pa.array(q.vec), pa.array(q.score)], schema=kind)

    dealt = candidates.unionByName(queries).select("part", "side", "ids", "data").repartition(shards, "part").sortWithinPartitions("part", "side")
    got = dealt.mapInArrow(meet, "query_id long, vec_id long, score long")
    if n > ids:
        got = got.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = got.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
