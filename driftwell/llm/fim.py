"""Fill-in-middle examples over a distinct-text index.

1. Identical texts meet in one aggregation by (64-bit hash, text): the hash orders and deals out, the comparison of whole texts decides, so
   no two texts are ever taken for one. Copies in a map task are combined before the shuffle; the documents of a text ride along as a list.
   This is the only shuffle of texts.
2. Each distinct text gets the start positions of its units (runs of letters, other code points singly) once, as an Elias-Fano list: low bits
   packed, high bits in unary, about 2 + log2(length / units) bits a unit.
3. The list is joined back to the documents where they ride along: a document's two cuts, drawn from a digest of its id, are selected from
   the list of its text, so a copy costs two selections and no scan.

Texts that more than 1/HOT of all rows share (and more than MEMBERS rows) are dealt out by map partitions into parts of about MEMBERS
rows; such a text's list is built once a part. At most HOT hashes are hot, which bounds their broadcast.

Defined results: a null text is an empty one, and plain; a null doc_id draws from the digest of "1:"; repeated rows and ids each give a row, the
same for the same id and text; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, SLICE_ROWS, release, slices

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of documents that become examples, and of these that put the suffix first.
EXAMPLES, SUFFIX_FIRST = 90, 20
#: Texts of more than 1/HOT of all rows are dealt out in parts of MEMBERS rows.
HOT, MEMBERS = 10_000, 1024

_HEAD = struct.Struct("<qqB")


def boundaries(text: str) -> np.ndarray:
    """Where units end, in code points, ascending; the last is the text's length."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((points | 32) - np.uint32(97)) < 26
    inside = letter[1:] & letter[:-1]
    return np.append(np.flatnonzero(~inside) + 1, len(points)) if len(points) else np.zeros(0, np.int64)


def encode(values: np.ndarray) -> bytes:
    """Elias-Fano list of ascending non-negative integers."""
    n = len(values)
    most = int(values[-1]) if n else 0
    low = max(0, (most // n).bit_length() - 1) if n else 0
    values = values.astype(np.uint64)
    high = np.zeros(((most >> low) + n + 63) // 64 * 64, np.uint8)
    high[(values >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    rest = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return _HEAD.pack(n, len(high) // 64, low) + np.packbits(high, bitorder="little").tobytes() + np.packbits(rest.ravel(), bitorder="little").tobytes()


class BoundaryList:
    """Selection on an encoded list."""

    def __init__(self, data: bytes):
        self.n, words, self.low = _HEAD.unpack_from(data)
        self.words = np.frombuffer(data, np.uint64, words, _HEAD.size)
        self.rest = np.frombuffer(data, np.uint8, -1, _HEAD.size + 8 * words)
        self.ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, at: np.ndarray) -> np.ndarray:
        """The values of the given ranks (from 0)."""
        word = np.searchsorted(self.ones, at, "right")
        before = np.where(word > 0, self.ones[word - 1], 0)
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        within = (bits.cumsum(axis=1, dtype=np.uint8) > (at - before)[:, None]).argmax(1)
        value = (word * 64 + within - at) << self.low
        for k in range(self.low):
            bit = at * self.low + k
            value |= ((self.rest[bit >> 3] >> (bit & 7)) & 1).astype(np.int64) << k
        return value

    def ends(self, units: np.ndarray) -> np.ndarray:
        """Code points that the first so many units take."""
        out = np.zeros(len(units), np.int64)
        some = units > 0
        if some.any():
            out[some] = self.select(units[some] - 1)
        return out


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text, members (array of structs of doc_id), n (units), boundaries (encoded): one row for each distinct text, for hot ones one a part."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    counts = rows.groupBy("key").agg(F.count("*").alias("copies"))
    hot = counts.where(F.col("copies") > max(MEMBERS, rows.count() // HOT)).select("key", F.ceil(F.col("copies") / MEMBERS).cast("int").alias("parts"))
    dealt = rows.join(F.broadcast(hot), "key", "left").withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.spark_partition_id(), "parts")))
    grouped = dealt.groupBy("key", "part", "text").agg(F.collect_list(F.struct("doc_id")).alias("members")).select("text", "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = None
        for batch in slices(batches):
            ends = [boundaries(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(e) for e in ends], pa.int64()), pa.array([encode(e) for e in ends], pa.binary())], names=["text", "members", "n", "boundaries"])
        batch = None
        release()

    return grouped.mapInArrow(run, "text string, members array<struct<doc_id: bigint>>, n bigint, boundaries binary")


def draws(doc_id: int | None) -> tuple[int, ...]:
    """Four 32-bit numbers from the digest of the id."""
    return struct.unpack(">4I", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()[:16])


def arrange(text: str, form: str, a: int, b: int) -> str:
    if form == "plain":
        return text
    head, middle, tail = text[:a], text[a:b], text[b:]
    return f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{middle}" if form == "psm" else f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{middle}"


def examples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n (units of its text), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, held, size = None, [], 0
        for batch in slices(batches):
            members, at = batch.column(1).flatten().field(0).to_pylist(), 0
            for text, count, n, data in zip(batch.column(0).to_pylist(), pc.list_value_length(batch.column(1)).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                ids, at = members[at : at + count], at + count
                never = not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
                for k in range(0, count, SLICE_ROWS):
                    some = ids[k : k + SLICE_ROWS]
                    drawn = np.array([draws(i) for i in some], np.int64)
                    cuts = np.sort(drawn[:, :2] % (n + 1), axis=1)
                    ends = BoundaryList(data).ends(cuts.ravel()).reshape(-1, 2).tolist()
                    for doc_id, (_, _, h3, h4), (a, b) in zip(some, drawn.tolist(), ends, strict=True):
                        form = "plain" if never or h3 % 100 >= EXAMPLES else "spm" if h4 % 100 < SUFFIX_FIRST else "psm"
                        held.append((doc_id, n, form, *((None, None) if form == "plain" else (a, b - a)), arrange(text, form, a, b)))
                        size += len(text)
                        if size >= SLICE_BYTES or len(held) >= SLICE_ROWS:
                            yield made(held)
                            held, size = [], 0
        if held:
            yield made(held)
        batch = held = None
        release()

    return index(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(form: Column, output: Column) -> Column:
    """The text again, from what was made of it alone: examples hold each mark once, as texts with marks stay plain."""
    after = lambda mark: F.element_at(F.split(output, mark, 2), 2)
    between = lambda first, second: F.element_at(F.split(after(first), second, 2), 1)
    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
