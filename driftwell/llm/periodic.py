"""Periodic runs of words by Main-Lorentz divide and conquer.

1. Words are interned to numbers. The texts of a slice stand in one array, kept apart by numbers that equal nothing.
2. Halves meet at odd multiples of 2^j, level by level from 8 words up (a run of 12 words has a multiple of 8 inside). Of a run the
   midpoint with the largest power of two inside is the one that finds it: the run can't reach past that midpoint's segment, or a larger power
   would be inside. So each run is found whole, at one midpoint, with its period at most half a segment. (At the top level all multiples are midpoints.)
3. A run of period p around midpoint m repeats the word at m a distance of p away. Array operations collect these distances for all midpoints of
   a level and drop those for which sampled places p words apart differ on either side; what is left has Z-functions computed for its segment:
   four sets of common extensions (right and left period, forwards and backwards) out of two Z-functions, linear in the segment.
4. Extensions give intervals that no neighbouring word extends; of equal intervals the smallest period stays. (A maximal interval of a
   multiple of the smallest period is the interval of that period itself, so nothing else has to be compared.)

Runs have at least MIN_LENGTH words and twice their period. Work is words times levels, at most, plus Z-functions where repeats are; a text is one
task's work. No shuffle.

Defined results: a null, empty or blank text has no words, no runs and an empty collapsed text; repeated rows each give a row; an empty table gives an
empty result; doc_id may be null; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, slices

MIN_LENGTH = 12
#: Distances of a level are collected for so many words at a time.
STRIP = 1 << 20


def z_function(s: list[int]) -> np.ndarray:
    """z[i]: how many elements from i on equal those from the start."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if k:
            left, right = i, i + k
    if n:
        z[0] = n
    return np.array(z, np.int64)


def crossing(ids: np.ndarray, low: int, mid: int, high: int, first: int, last: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of the intervals around mid that repeat with a period and can't be extended, within [low, high) and one word
    beyond on each side; the text stands in [first, last)."""
    low, high = max(low - 1, first), min(high + 1, last)
    u, v = ids[low:mid].tolist(), ids[mid:high].tolist()
    forwards = z_function([*v, -1, *u, *v])[len(v) + 1 :]
    backwards = z_function([*u[::-1], -1, *v[::-1], *u[::-1]])[len(u) + 1 :]
    p = np.arange(1, len(v) + 1)  # the word at mid and the one p after it
    right = (mid - backwards[len(v) - p], mid + np.append(forwards[len(u) + p[:-1]], 0) + p, p)
    p = np.arange(1, len(u) + 1)  # the word p before mid and the one at mid
    left = (mid - p - np.append(backwards[len(v) + p[:-1]], 0), mid + forwards[len(u) - p], p)
    for a, b, period in (right, left):
        good = (b - a >= np.maximum(MIN_LENGTH, 2 * period)) & ((a > low) | (low == first)) & ((b < high) | (high == last))
        yield from zip(a[good].tolist(), b[good].tolist(), period[good].tolist(), strict=True)


def _repeats(ids: np.ndarray, text: np.ndarray, i: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, i + p), equal already, may lie in a stretch of enough such pairs: places on one side of it are sampled."""
    need = np.maximum(MIN_LENGTH - p, p)
    alive = np.flatnonzero(text[i] == text[i + p])
    ahead = behind = np.ones(len(alive), bool)
    for part in (-1, 8, 16, 4, 12, 2, 6, 10, 14):  # the next place, then sixteenths of the side
        at, step, side = i[alive], p[alive], need[alive] // 2
        x = np.minimum(1, side) if part == -1 else side * part // 16
        y = np.minimum(x, np.maximum(side - 1, 0))
        ahead = ahead & (ids[np.minimum(at + y, len(ids) - 1)] == ids[np.minimum(at + y + step, len(ids) - 1)])
        behind = behind & (ids[np.maximum(at - x, 0)] == ids[np.maximum(at - x, 0) + step])
        keep = ahead | behind
        alive, ahead, behind = alive[keep], ahead[keep], behind[keep]
        if not len(alive):
            break
    return alive


def runs_of(ids: np.ndarray, starts: np.ndarray) -> list[dict[tuple[int, int], int]]:
    """For each text, (start, end) to smallest period. ids: the texts' numbers from 0, a negative number of its own after each text;
    starts: where texts start, and the end of the last."""
    out: list[dict] = [{} for _ in range(len(starts) - 1)]
    lengths = np.diff(starts)
    text = np.repeat(np.arange(len(out), dtype=np.int32), lengths)
    widest = max(8, 1 << max(0, int(lengths.max(initial=1)) - 2).bit_length())  # no text is longer
    levels = [(1 << j, 0) for j in range(3, widest.bit_length())]
    for half, offset in [*levels, (widest, widest)]:  # the last: the midpoints at even multiples of the widest half
        strip = max(1, STRIP // (2 * half)) * 2 * half
        for base in range(offset, len(ids), strip):
            part = ids[base : base + strip]
            if len(part) % (2 * half):
                part = np.append(part, np.full(-len(part) % (2 * half), -1 << 30, part.dtype))
            part = part.reshape(-1, 2 * half)
            same = (part == part[:, half : half + 1]) & (part[:, half : half + 1] >= 0)
            same[:, half] = False
            at = np.flatnonzero(same)
            column = at % (2 * half)
            place = at + base
            p = np.abs(column - half)
            hit = _repeats(ids, text, place - np.maximum(column - half, 0), p)
            for mid in np.unique(place[hit] - column[hit] + half).tolist():
                k = int(text[mid])
                first, last = int(starts[k]), int(starts[k + 1]) - 1
                for a, b, period in crossing(ids, mid - half, mid, mid + half, first, last):
                    key = (a - first, b - first)
                    if period < out[k].get(key, period + 1):
                        out[k][key] = period
    return out


def _words(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, and the array of all their numbers with where each text starts."""
    words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]  # bytes split at the six blanks
    known: dict[bytes, int] = {}
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).astype(np.int64)
    ids = np.empty(int(starts[-1]), np.int32)
    for k, own in enumerate(words):
        ids[starts[k] : starts[k + 1] - 1] = [known.setdefault(w, len(known)) for w in own]
        ids[starts[k + 1] - 1] = -2 - k
    return words, ids, starts


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period; in words) and collapsed: the words that no run holds beyond
    its first period, joined by single blanks."""
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = None
        for batch in slices(batches):
            words, ids, starts = _words(batch.column(1).to_pylist())
            listed, collapsed = [], []
            for own, runs in zip(words, runs_of(ids, starts), strict=True):
                own_runs = sorted((a, p, b - a) for (a, b), p in runs.items())
                listed.append([{"start": a, "length": n, "period": p} for a, p, n in own_runs])
                if own_runs:
                    edge = np.zeros(len(own) + 1, np.int64)
                    for a, p, n in own_runs:
                        edge[a + p] += 1
                        edge[a + n] -= 1
                    own = [own[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                collapsed.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(starts) - 1, pa.int64()), pa.array(listed, run_type), pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
        batch = words = ids = collapsed = None
        release()

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def longest(runs: str = "runs"):
    """The run of greatest length; of several the one of smallest start, then period. Null if there is none."""
    ordered = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(ordered)
