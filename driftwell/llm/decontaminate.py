"""Benchmark decontamination by spaced-seed hashing.

Words of benchmark items and training documents are numbered. A spaced seed is a fixed mask over consecutive words that
looks at some positions and ignores the others, so a hit survives substitutions at ignored positions. The masks are chosen so that every
overlap of MIN_WORDS words or more with a share of AGREE agreeing, wherever its substitutions are, keeps a seed (the tests enumerate
it). Hashes of all masks at all positions of the benchmark form a small lookup; every document's hashes are looked up in it, and each hit is verified: the two
texts are aligned at the hit and the longest stretch of the whole alignment is taken that runs from an agreeing word to an agreeing
word with a share of AGREE agreeing. Alignments of one item are searched from the longest on, until none that is left can hold a longer stretch;
in repetitive texts they are found by correlation instead of pair by pair. A document is contaminated when such an overlap has MIN_WORDS words, or covers a benchmark item
that is shorter whole. Items of fewer than MIN_ITEM words are everyday phrases; texts that hold one are counted (n_short), not contaminated.

A benchmark of at most MAX_BENCHMARK_CHARS characters (its size is measured) goes to every task once. A larger one is dealt into slices
within that bound (an item that is longer alone is a slice of its own): its index is built by array operations, once, on the driver, and one pass over the documents for each slice writes its hits, and
the next slice is only sent when the last one is gone, so that no driver, executor or task holds two. Documents are
never shuffled but for hits joined back after the last slice. A document reports each item once, however many hits it has.

Defined results: null or empty texts are clean; items without words match nothing; items with equal words are one in memory and all are
reported; an empty benchmark leaves all texts clean, an empty table gives an empty result; texts are read whole; an alignment is searched once, however many hits it has; repeated rows are judged alike; other
columns are ignored or passed through (`drop`).
"""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, filter_batches, map_batches, table

#: Masks; 1 looks at a position, 0 ignores it. No 2 substitutions in 13 words, 3 in 15, 4 in 20 or 5 in 25 hit them all at
#: every offset, nor 2 inside 12 words; longer overlaps can be cut into pieces of 13 to 25 words, one of which has its share.
MASKS = ("1110111", "11010001011", "110101101")
#: Items of fewer words are looked for whole.
SPAN = 12
#: Items of fewer words never contaminate a text.
MIN_ITEM = 5
#: Shortest verified overlap in words, and the share of its words that have to agree.
MIN_WORDS, AGREE = 13, 0.8
_NUM, _DEN = Fraction(str(AGREE)).as_integer_ratio()
MAX_BENCHMARK_CHARS = 16_000_000
#: Pairs of equal seeds in a text and an item are listed up to so many for each word; beyond, alignments are found by correlation.
PAIRS_A_WORD = 32

_WORD = re.compile(r"[^\W_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def mixed(words: np.ndarray) -> np.ndarray:
    """A random-looking number for each word."""
    with np.errstate(over="ignore"):
        return _mix(_mix((words.astype(np.uint64) + np.uint64(1)) * _MULT) * _MULT)


#: Odd factors, one for each place of a mask.
_FACTORS = mixed(np.arange(100, 100 + max(map(len, MASKS)))) | np.uint64(1)


def seeds(words: np.ndarray, mask: str, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions where all words that the mask looks at are known, the mask's hashes there); words are numbers, 0 stands for a word
    that the benchmark doesn't have; numbers: the same words, mixed."""
    n = max(len(words) - len(mask) + 1, 0)
    looked = [k for k, bit in enumerate(mask) if bit == "1"]
    known = words > 0
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in looked:
            h += numbers[k : k + n] * _FACTORS[k]
    if known.all():
        return np.arange(n), h
    where = np.flatnonzero(np.logical_and.reduce([known[k : k + n] for k in looked]))
    return where, h[where]


def stretches(words: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each place on."""
    h = np.full(len(places), n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = _mix(h * _MULT + words[places + k].astype(np.uint64) + np.uint64(1))
    return h


def _shifts(p: np.ndarray, q: np.ndarray, n: int, m: int) -> np.ndarray:
    """The distinct differences of places p below n and q below m: pair by pair, or by a correlation where pairs are many."""
    if len(p) * len(q) <= PAIRS_A_WORD * (n + m):
        return np.unique(p[:, None] - q[None, :])
    size = 1 << (n + m).bit_length()
    a, b = np.zeros(size), np.zeros(size)
    a[p], b[m - 1 - q] = 1, 1
    return np.flatnonzero(np.fft.irfft(np.fft.rfft(a) * np.fft.rfft(b), size) > 0.5) - (m - 1)


class Index:
    """The benchmark's words, seeds and items, in arrays; items with equal words are kept once. Built on the driver, once, and sent to the tasks."""

    def __init__(self, items: list[tuple[int, str]]):
        self.number: dict[str, int] = {}
        number, own = self.number, {}
        for key, text in items:
            w = np.array([number.setdefault(x, len(number) + 1) for x in _WORD.findall((text or "").lower())], np.int32)
            if len(w):
                own.setdefault(w.tobytes(), ([], w))[0].append(key)
        self.keys = [k for k, _ in own.values()]
        self.length = np.array([len(w) for _, w in own.values()], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.words = np.concatenate([w for _, w in own.values()]) if own else np.zeros(0, np.int32)
        item = np.repeat(np.arange(len(self.keys)), self.length)
        self.tables = []
        numbers = mixed(self.words)
        for mask in MASKS:
            where, h = seeds(self.words, mask, numbers)
            inside = (item[where] == item[where + len(mask) - 1]) & (self.length[item[where]] >= SPAN)
            where, h = where[inside].astype(np.int32), h[inside]
            order = np.argsort(h, kind="stable")
            self.tables.append((h[order], where[order]))
        self.short = {}  # items of fewer than SPAN words are looked for whole, by their length, first word and a hash of their words
        for n in range(1, SPAN):
            own_items = np.flatnonzero(self.length == n)
            if len(own_items):
                h = stretches(self.words, self.start[own_items], n)
                order = np.argsort(h, kind="stable")
                first = np.zeros(len(number) + 1, bool)
                first[self.words[self.start[own_items]]] = True
                self.short[n] = first, h[order], own_items[order]

    def item(self, i: int) -> np.ndarray:
        return self.words[self.start[i] : self.start[i] + self.length[i]]

    def _alignments(self, words: np.ndarray) -> dict[int, np.ndarray]:
        """For each item with a hit, the distinct shifts of the item against the text at which they share a seed."""
        found: dict[int, list] = {}
        numbers = mixed(words)
        for mask, (table, at) in zip(MASKS, self.tables, strict=True):
            where, h = seeds(words, mask, numbers)
            low = np.searchsorted(table, h)
            ok = low < len(table)
            ok[ok] = table[low[ok]] == h[ok]
            where, low = where[ok], low[ok]
            if not len(where):
                continue
            high = np.searchsorted(table, h[ok], "right")
            if int((high - low).sum()) <= PAIRS_A_WORD * len(words):  # all pairs of places
                n = high - low
                q = at[np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))].astype(np.int64)
                i = np.searchsorted(self.start, q, "right") - 1
                pairs = np.unique(np.stack([i, np.repeat(where, n) - (q - self.start[i])], 1), axis=0)
                heads = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
                for k, own in zip(heads.tolist(), np.split(pairs[:, 1], heads[1:]), strict=False):
                    found.setdefault(int(pairs[k, 0]), []).append(own)
                continue
            for a, b in sorted(set(zip(low.tolist(), high.tolist(), strict=True))):  # repetitive: each seed once, shifts by item
                p, q = where[low == a], at[a:b].astype(np.int64)
                i = np.searchsorted(self.start, q, "right") - 1
                for k in np.unique(i).tolist():
                    found.setdefault(k, []).append(_shifts(p, q[i == k] - self.start[k], len(words), int(self.length[k])))
        return {i: np.unique(np.concatenate(x)) for i, x in found.items()}

    def overlaps(self, text: str | None, first_only: bool = False) -> list[tuple[list, int, int, int, int]]:
        """Verified overlaps (keys of the item, first word in the document, first word in the item, words, words that agree), a longest one per
        item; items of fewer than MIN_ITEM words among them. `first_only`: stop at the first that contaminates."""
        if not text or not self.keys:
            return []
        get = self.number.get
        words = np.fromiter((get(x, 0) for x in _WORD.findall(text.lower())), np.int32)
        found: dict[int, tuple] = {}
        for i, shifts in sorted(self._alignments(words).items()):
            item = self.item(i)
            room = np.minimum(len(words), shifts + len(item)) - np.maximum(0, shifts)
            best = min(MIN_WORDS, len(item)) - 1
            for k in np.argsort(-room, kind="stable").tolist():
                if room[k] <= best:  # nor can any that follows be longer
                    break
                shift = int(shifts[k])
                a, n, same = self._longest(words, item, shift)
                if n > best:
                    best, found[i] = n, (self.keys[i], a, a - shift, n, same)
                    if first_only:
                        return [found[i]]
        for n, (first, table, items) in self.short.items():
            if n > len(words) or first_only and n < MIN_ITEM:
                continue
            places = np.flatnonzero(first[words[: len(words) - n + 1]])
            h = stretches(words, places, n)
            low = np.searchsorted(table, h)
            ok = low < len(table)
            ok[ok] = table[low[ok]] == h[ok]
            for k in np.unique(low[ok]).tolist():
                for i in items[k : np.searchsorted(table, table[k], "right")].tolist():
                    p = next((p for p in places[ok & (low == k)].tolist() if np.array_equal(words[p : p + n], self.item(i))), None)
                    if p is not None:
                        found[i] = (self.keys[i], p, 0, n, n)
                        if first_only:
                            return [found[i]]
        return [found[i] for i in sorted(found)]

    @staticmethod
    def _longest(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
        """The alignment's longest stretch between agreeing words with a share of AGREE agreeing: (first word, words, words that agree)."""
        lo, hi = max(0, shift), min(len(doc), shift + len(item))
        at = lo + np.flatnonzero(doc[lo:hi] == item[lo - shift : hi - shift])
        if not len(at):
            return lo, 0, 0
        # from the x-th to the y-th agreeing word the share is enough when level[x] <= level[y] + _DEN - _NUM
        level = _DEN * np.arange(len(at)) - _NUM * at
        first = np.searchsorted(-np.minimum.accumulate(level), -(level + _DEN - _NUM))
        words = at - at[first] + 1
        y = int(np.argmax(words))
        return int(at[first[y]]), int(words[y]), y - int(first[y]) + 1


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(key, text, part) and the number of parts: as many as keep each within MAX_BENCHMARK_CHARS, or down to one item."""
    items = benchmark.select(F.col(item_col).cast("long").alias("key"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
    parts = 1
    while True:
        dealt = items.withColumn("part", F.pmod(F.xxhash64("key", "text"), F.lit(parts)))
        worst = dealt.groupBy("part").agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("items")).where("items > 1").agg(F.max("n")).first()[0] or 0
        if worst <= MAX_BENCHMARK_CHARS or parts > 1 << 20:
            return dealt, parts
        parts *= 2


def _slice(items: DataFrame, part: int) -> list[tuple[int, str]]:
    return sorted(((r.key, r.text) for r in items.where(F.col("part") == part).select("key", "text").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


SCHEMA = "doc_id long, contaminated boolean, n_items long, items string, longest long, n_short long"


def _judge(overlaps: list) -> tuple[list, int, int]:
    """(keys of the items that contaminate, longest overlap, short items)."""
    real = [o for o in overlaps if o[3] >= MIN_ITEM]
    return sorted({k for o in real for k in o[0] if k is not None}), max((o[3] for o in real), default=0), sum(len(o[0]) for o in overlaps if o[3] < MIN_ITEM)


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: whether it overlaps the benchmark, the items (sorted, comma-joined), the longest overlap in words, and how many
    items of fewer than MIN_ITEM words it holds."""
    items, parts = _items(benchmark, item_col, item_text)
    src = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    if parts == 1:
        return _scan_slice(src, _slice(items, 0))[0]
    marks = ["doc_id", "mark"]
    hits = None
    for part in range(parts):
        found, held = _scan_slice(src, _slice(items, part), hits_only=True)
        found = table(found.withColumn("part", F.lit(part)), "slice")
        held.destroy()
        hits = found if hits is None else hits.unionAll(found)
    # a text's hits of all slices; repeated rows of a document give the same hits, so the text's mark is part of the key
    hits = hits.distinct().groupBy(*marks).agg(F.max("longest").alias("longest"), F.sum("n_short").alias("n_short"), F.max("contaminated").alias("contaminated"), F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.transform(F.filter(F.split("items", ","), lambda x: x != ""), lambda x: x.cast("long")))))).alias("items"))
    rows = src.select(F.col("id").alias("doc_id"), F.xxhash64("text").alias("mark"))
    out = rows.join(checked_broadcast(hits).withColumnsRenamed({"doc_id": "_id", "mark": "_mark"}), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    return out.select("doc_id", F.coalesce("contaminated", F.lit(False)).alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"), F.coalesce("longest", F.lit(0)).alias("longest"), F.coalesce("n_short", F.lit(0)).alias("n_short"))


def _scan_slice(src: DataFrame, items: list, hits_only: bool = False) -> tuple[DataFrame, object]:
    held = src.sparkSession.sparkContext.broadcast(Index(items))

    def make():
        index = held.value

        def step(cols: dict) -> dict:
            found = [index.overlaps(t) for t in cols["text"]]
            judged = [_judge(f) for f in found]
            real = [any(o[3] >= MIN_ITEM for o in f) for f in found]
            return {"doc_id": cols["id"], "mark": cols["mark"], "contaminated": real, "n_items": [len(j[0]) for j in judged], "items": [",".join(map(str, j[0])) for j in judged], "longest": [j[1] for j in judged], "n_short": [j[2] for j in judged]}

        return step

    if not hits_only:
        return map_batches(src.withColumn("mark", F.lit(0)), SCHEMA, lambda: (lambda step: lambda cols: {k: v for k, v in step(cols).items() if k != "mark"})(make())), held
    out = map_batches(src.withColumn("mark", F.xxhash64("text")), SCHEMA + ", mark long", make)
    return out.where("contaminated OR n_short > 0"), held


def drop(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """All columns of the documents without a verified overlap. Of a large benchmark each slice drops its own before the next one is read."""
    items, parts = _items(benchmark, item_col, item_text)
    for part in range(parts):
        held = docs.sparkSession.sparkContext.broadcast(Index(_slice(items, part)))

        def make(held=held):
            index = held.value
            return lambda texts: [not any(o[3] >= MIN_ITEM for o in index.overlaps(t, first_only=True)) for t in texts]

        docs = filter_batches(docs, [text_col], make)
        if part < parts - 1:
            docs = table(docs, "clean")
            held.destroy()
    return docs
