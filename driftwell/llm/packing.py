"""Hierarchical multi-length packing.

Documents are tokenised and routed to context-size tiers by their length (256, 512, 1024 or 2048 ids with the closing
id). Each tier packs windows of its own size first-fit by remaining room; the gaps that are left in long windows are
filled from shorter tiers, longest piece first, cutting the last piece freely; what remains of a block at the end is cut into
windows at powers of two, down to a single id: no id is padded and none is lost, at the price of a few windows shorter than any tier a
block (a trainer may leave those out). Windows of one size are dealt to step groups; every full group holds the same number
of ids (GROUP windows of the largest tier, or as many more of a shorter one).

Every partition packs its own rows, so there is no shuffle and a lost task repeats exactly; sequence ids carry the
partition's number. Memory is bounded by BLOCK ids per task: a block of documents is packed when it is full.

Defined results: null and empty texts are documents of the closing id alone; a document longer than the largest window is
cut into full windows and a remainder; repeated rows are packed repeatedly; an empty table gives no sequence; other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TIERS = (256, 512, 1024, 2048)
#: Ids and documents that a task gathers before it packs them.
BLOCK, BLOCK_DOCS = 2_000_000, 50_000
#: Windows of the largest size that form a step group.
GROUP = 16

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class Ids:
    """Text to ids with a byte-level BPE file. Texts without special tokens go through a faster library with the same merges, which gives
    the same ids (the tests compare whole tables); a text that its pattern engine refuses (ValueError) is read by the file's own."""

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path and pattern:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return np.asarray(self.fast.encode_ordinary(text), "<u4")
            except ValueError:
                pass
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, "<u4")


class Packer:
    """Packs one block of tokenised documents; yields pieces as (document, start, length, sequence, offset, size)."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tiers

    def pack(self, lengths: list[int], first_seq: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
        top, pieces, seq = self.tiers[-1], [], first_seq
        pools: list[list[tuple[int, int, int]]] = [[] for _ in self.tiers]  # (length, document, start)
        for d, n in enumerate(lengths):
            full = n // top * top
            for start in range(0, full, top):
                pieces.append((d, start, top, seq, 0, top))
                seq += 1
            if n > full:
                tier = next(i for i, size in enumerate(self.tiers) if n - full <= size)
                pools[tier].append((n - full, d, full))
        for pool in pools:
            pool.sort()  # pop() takes the longest
        for tier in range(len(self.tiers) - 1, -1, -1):
            size, pool = self.tiers[tier], pools[tier]
            while pool:
                room, at, mine = size, 0, []
                n, d, start = pool.pop()
                mine.append((d, start, n, at))
                room, at = room - n, at + n
                while room:
                    fill = next((pools[t] for t in range(tier, -1, -1) if pools[t]), None)
                    if fill is None:
                        break
                    i = self._largest_fit(fill, room)
                    for t in range(tier - 1, -1, -1):  # a shorter tier may fit better than cutting a long piece
                        if i < 0 and pools[t]:
                            fill, i = pools[t], self._largest_fit(pools[t], room)
                    if i >= 0:
                        n, d, start = fill.pop(i)
                        mine.append((d, start, n, at))
                    else:  # nothing fits whole: cut the shortest piece there is
                        fill = next(p for p in pools[: tier + 1] if p)
                        n, d, start = fill.pop(0)
                        mine.append((d, start, room, at))
                        left = (n - room, d, start + room)
                        home = next(i for i, s in enumerate(self.tiers) if left[0] <= s)
                        self._insert(pools[home], left)
                        n = room
                    room, at = room - n, at + n
                if room:
                    seq = self._close(mine, at, seq, pieces)
                else:
                    pieces += [(d, start, n, seq, o, size) for d, start, n, o in mine]
                    seq += 1
        return pieces, seq

    @staticmethod
    def _largest_fit(pool: list, room: int) -> int:
        lo, hi = 0, len(pool)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if pool[mid][0] <= room else (lo, mid)
        return lo - 1

    @staticmethod
    def _insert(pool: list, item: tuple[int, int, int]) -> None:
        from bisect import insort

        insort(pool, item)

    def _close(self, mine: list, total: int, seq: int, pieces: list) -> int:
        """The last, unfilled window: cut it into windows whose sizes are powers of two, so that none is padded."""
        flat = [(d, start, n) for d, start, n, _ in mine]
        while total:
            size = 1 << (total.bit_length() - 1)
            room, at = size, 0
            while room:
                d, start, n = flat.pop(0)
                take = min(n, room)
                pieces.append((d, start, take, seq, at, size))
                if take < n:
                    flat.insert(0, (d, start + take, n - take))
                room, at = room - take, at + take
            total -= size
            seq += 1
        return seq


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, closing_id: int = 1, tiers: tuple[int, ...] = TIERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit numbers. `tiers` are powers of two, ascending."""
    block, group = BLOCK, GROUP

    def run(batches):
        encode, packer = Ids(tokenizer, ranks, pattern), Packer(tiers)
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 36
        seq, groups = 0, {}
        keys: list = []
        ids: list = []
        held = 0

        def flush():
            nonlocal seq, keys, ids, held
            pieces, seq = packer.pack([len(x) for x in ids], seq)
            for at in range(0, len(pieces), 4096):
                some = pieces[at : at + 4096]
                step = []
                for _, _, _, s, o, size in some:
                    if o == 0:
                        n = groups.get(size, 0)
                        groups[size] = n + 1
                        groups["now"] = (n // (group * tiers[-1] // size) << 12) | size
                    step.append(first + groups["now"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[p[0]] for p in some], pa.int64()),
                        pa.array([p[1] for p in some], pa.int64()),
                        pa.array([p[2] for p in some], pa.int64()),
                        pa.array([ids[p[0]][p[1] : p[1] + p[2]].tobytes() for p in some], pa.binary()),
                        pa.array([len(ids[p[0]]) for p in some], pa.int64()),
                        pa.array([first + p[3] for p in some], pa.int64()),
                        pa.array([p[4] for p in some], pa.int64()),
                        pa.array([p[5] for p in some], pa.int32()),
                        pa.array(step, pa.int64()),
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"],
                )
            keys, ids, held = [], [], 0

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                x = np.append(encode(text), np.uint32(closing_id)).astype("<u4") if text else np.array([closing_id], "<u4")
                keys.append(key)
                ids.append(x)
                held += len(x)
                if held >= block or len(keys) >= BLOCK_DOCS:
                    yield from flush()
        if ids:
            yield from flush()

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(run, SCHEMA)
