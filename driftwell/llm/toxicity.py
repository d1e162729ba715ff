"""Toxicity by a gap-weighted subsequence string kernel with Nystroem landmarks and a linear SVM.

The kernel compares two strings by their common subsequences of 3 and 4 symbols; each occurrence counts DECAY to the power
of the stretch it spans, so "id-iot", "idxiot" and "i.d.i.o.t" stay close to "idiot". Labels are per document, insults are
not: a document is toxic if some sentence is, a sentence if some word (a run of single letters counts as one word) is. A word of
more than WINDOW characters counts as its overlapping windows, in training as in scoring. So training
learns from witnesses (multi-instance SVM): start from the words whose character n-grams tell labelled documents apart, fit,
choose the witnesses anew by the fitted decision, and fit again; negatives are all words of clean documents: the SVM works on a set of
them that takes in every word inside the margin until there is none left outside the set, which gives the solution over all of them.
A document's decision is the soft maximum of its TOPS largest word decisions, over all its sentences (that is the model, at every
length of text); Platt scaling turns it into a probability, fitted on labelled documents that the SVM was not fitted on.

The fitted function is a combination of kernels with the landmarks. It is folded into one weight per subsequence, a table of
fixed size that goes to the tasks, so that scoring a word costs one table look-up per subsequence, and a word is scored once per task.

Documented bounds of fitting, on labelled rows alone: at most `sample` labelled documents per class, in the order of a hash of doc_id, and of
these as many as hold `sample_bytes` bytes of distinct words a class (the executors reduce texts to words, so no text reaches the driver). Of
labelled documents whose smallest word hashes agree with an earlier one's (near copies) only the first is learnt from, as
a copied document's words aren't further evidence. Everything else covers all rows.

Defined results: null and empty texts get the score of a text without any word; without labelled rows of both classes
every score is the share of label 1 (0 without any); an empty table gives an empty result; texts are read whole, whatever their length; repeated rows are scored alike, to the
last bit: a word's decision depends on the model alone, and the model on no order of sets.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass
from heapq import nlargest
from sys import intern

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_batches, map_batches, table

DECAY = 0.6
#: Longest stretch of a subsequence of 3 and of 4 symbols.
SPANS = {3: 6, 4: 7}
SYMBOLS = 28  # a-z, any other letter or digit, any other character
LANDMARKS = 256
#: A document's largest word decisions count, by a soft maximum of this sharpness; EMPTY stands for a missing word.
TOPS, SHARP, EMPTY = 8, 4.0, -3.0
#: Labelled documents per class that fitting reads, and bytes of their distinct words.
SAMPLE, SAMPLE_BYTES = 2000, 16_000_000
#: Words of clean documents that the SVM's working set starts from; words inside the margin join it.
START = 9000
#: Variants with an inserted letter that a common witness adds to the training set.
VARIANTS = 3
#: Decided words that a task remembers.
CACHE = 250_000
#: Weight of a toxic document with disguised insults when the threshold is set.
DISGUISED = 0.1
#: Least log odds of a word's n-grams for it to be a first witness.
EVIDENCE = 1.5
#: Longer words are scored in windows of this many characters that overlap by half.
WINDOW = 24

_WORD = re.compile(r"\S+")
_INNER = re.compile(r"[\W_]+")
_SINGLES = re.compile(r"(?<!\S)(?:\w[ ]){2,}\w(?!\S)")
# Characters that are written for letters.
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"}


def _patterns() -> list[tuple[tuple[int, ...], float]]:
    """Offsets of the subsequences' symbols from the first, with their weight."""
    from itertools import combinations

    return [((0, *rest), DECAY ** (rest[-1] + 1)) for p, span in SPANS.items() for rest in combinations(range(1, span), p - 1)]


PATTERNS = _patterns()
_SIZE = {3: SYMBOLS**3, 4: SYMBOLS**4}
_TABLE = _SIZE[3] + _SIZE[4]


def _symbol(ch: str) -> int:
    base = unicodedata.normalize("NFKD", ch)[0]
    if "a" <= base <= "z":
        return ord(base) - 97
    return 26 if ch.isalnum() else 27


class _Symbols(dict):
    def __missing__(self, ch):
        self[ch] = value = _symbol(ch)
        return value


def words_of(text: str) -> set[str]:
    """The text's distinct words, lower-cased, outer punctuation stripped; also without inner punctuation, and spelled-out runs of single letters joined."""
    low = text.lower()
    out = {w.strip(".,;:!?()[]{}\"'*&%$#|<>-_/\\") for w in low.split()}
    out.update([_INNER.sub("", w) for w in out if not w.isalnum()])
    if _SINGLES.search(low):
        out.update(m[0].replace(" ", "") for m in _SINGLES.finditer(low))
    out.discard("")
    return out


class Kernel:
    """Words as sparse features: codes of subsequences with weights, normalised by the number of subsequences a word of its length has."""

    def __init__(self):
        self.symbols = _Symbols()

    def pieces(self, word: str) -> list[str]:
        if any(ch in _LEET for ch in word) and not word.isdigit():
            word = "".join(_LEET.get(ch, ch) for ch in word)
        if len(word) <= WINDOW:
            return [word]
        return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]

    def matrix(self, words: list[str], width: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Symbols by word, padded with -1 to `width` (or the longest; length classes keep the padding small), and lengths. Boundaries are a symbol each."""
        n = np.array([len(w) + 2 for w in words])
        m = np.full((len(words), width or int(n.max())), -1, np.int64)
        sym = self.symbols
        for i, w in enumerate(words):
            m[i, : len(w) + 2] = [27, *map(sym.__getitem__, w), 27]
        return m, n

    @staticmethod
    def codes(m: np.ndarray):
        """For each pattern: codes (rows by positions), validity and weight."""
        width = m.shape[1]
        for offs, weight in PATTERNS:
            take = width - offs[-1]
            if take <= 0:
                continue
            code = m[:, :take].copy()
            for o in offs[1:]:
                code = code * SYMBOLS + m[:, o : o + take]
            yield code + (_SIZE[3] if len(offs) == 4 else 0), m[:, offs[-1] :] >= 0, weight

    @staticmethod
    def norms(n: np.ndarray) -> np.ndarray:
        total = np.zeros(len(n))
        for offs, weight in PATTERNS:
            total += np.maximum(n - offs[-1], 0) * weight * weight
        return np.sqrt(np.maximum(total, 1e-12))


@dataclass
class Model:
    table: np.ndarray | None  # weight of each subsequence, folded over the landmarks
    bias: float
    scale: float  # Platt: score = 1 / (1 + exp(-(scale * a document's decision + shift)))
    shift: float

    def decide_all(self, words: list[str], kernel: Kernel) -> np.ndarray:
        return np.concatenate([self.decide(words[at : at + 20000], kernel) for at in range(0, len(words), 20000)]) if words else np.zeros(0)

    def decide(self, words: list[str], kernel: Kernel) -> np.ndarray:
        """The SVM's decision for each word (its largest window)."""
        flat, owner = [], []
        for i, w in enumerate(words):
            for p in kernel.pieces(w):
                flat.append(p)
                owner.append(i)
        out = np.full(len(words), -np.inf)
        size = np.array([len(p) for p in flat])
        owner = np.array(owner)
        for lo, hi in ((0, 5), (5, 8), (8, 11), (11, 15), (15, WINDOW + 1)):
            pick = np.flatnonzero((size >= lo) & (size < hi))
            if len(pick):
                m, n = kernel.matrix([flat[i] for i in pick], hi + 1)  # sums over one width a class: no word's bits depend on others
                f = np.zeros(len(pick))
                for code, ok, weight in kernel.codes(m):
                    f += weight * (self.table[np.where(ok, code, _TABLE)]).sum(1)
                np.maximum.at(out, owner[pick], f / kernel.norms(n) + self.bias)
        return out


class Landmarks:
    """Nystroem features by kernel values with the landmarks, and their folding into one weight per subsequence."""

    def __init__(self, marks: list[str], kernel: Kernel):
        self.kernel = kernel
        feats = self._features(marks)
        self.codes = sorted({c for f in feats for c in f})
        self.compact = np.zeros(_TABLE + 1, np.int32)  # code to row of weights; row 0 is no landmark's
        self.compact[self.codes] = np.arange(1, len(self.codes) + 1)
        self.weights = np.zeros((len(self.codes) + 1, len(marks)), np.float32)
        for j, f in enumerate(feats):
            for c, v in f.items():
                self.weights[self.compact[c], j] = v
        gram = self.gram(marks).astype(np.float64)
        value, vector = np.linalg.eigh((gram + gram.T) / 2)
        good = value > 1e-6 * value.max()
        self.whiten = vector[:, good] / np.sqrt(value[good])

    def _features(self, words: list[str]) -> list[dict[int, float]]:
        out = []
        for w in words:
            m, n = self.kernel.matrix([w])
            f: Counter = Counter()
            for code, ok, weight in self.kernel.codes(m):
                for c in code[0][ok[0]].tolist():
                    f[c] += weight
            norm = float(self.kernel.norms(n)[0])
            out.append({c: v / norm for c, v in f.items()})
        return out

    def gram(self, words: list[str]) -> np.ndarray:
        """Kernel values of the words with the landmarks."""
        out = np.zeros((len(words), self.weights.shape[1]), np.float32)
        for at in range(0, len(words), 512):
            m, n = self.kernel.matrix(words[at : at + 512])
            part = np.zeros((len(m), self.weights.shape[1]), np.float32)
            for code, ok, weight in self.kernel.codes(m):
                rows = self.compact[np.where(ok, code, _TABLE)]
                for k in range(rows.shape[1]):
                    part += weight * self.weights[rows[:, k]]
            out[at : at + 512] = part / self.kernel.norms(n)[:, None]
        return out

    def features(self, words: list[str]) -> np.ndarray:
        return self.gram(words) @ self.whiten.astype(np.float32) if words else np.zeros((0, self.whiten.shape[1]), np.float32)

    def folded(self, w: np.ndarray) -> np.ndarray:
        """One weight per subsequence code for the linear function w of the features; the last entry stands for no code."""
        out = np.zeros(_TABLE + 1)
        out[self.codes] = self.weights[1:].astype(np.float64) @ (self.whiten @ w)
        return out.astype(np.float32)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 3.0, steps: int = 15) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by Newton steps on the active set."""
    size = x.shape[1] + 1
    w = np.zeros(size)
    ridge = np.eye(size)
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        left, right = ridge.copy(), np.zeros(size)
        for at in range(0, len(x), 2048):
            part = slice(at, at + 2048)
            x1 = np.hstack([x[part], np.ones((len(x[part]), 1))])
            on = y[part] * (x1 @ w) < 1
            a = x1[on].T * (c * weight[part][on])
            left += a @ x1[on]
            right += a @ y[part][on]
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w[:-1], float(w[-1])


def _platt(d: np.ndarray, y: np.ndarray, own: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the decisions, rows weighing `own`; classes weigh alike, as the sample's balance isn't the corpus's."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = own * np.where(y > 0, len(y) / (2 * max(n1, 1)), len(y) / (2 * max(n0, 1)))
    x1 = np.stack([d, np.ones(len(d))], 1)
    ridge = np.diag([0.05, 1e-6])
    b = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x1 @ b, -30, 30)))
        step = np.linalg.solve((x1 * (w * p * (1 - p) + 1e-9)[:, None]).T @ x1 + ridge, x1.T @ (w * (p - t)) + ridge @ b)
        b = b - step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def _once(bags: list[set[str]]) -> list[int]:
    """Indexes of the bags without near copies of earlier ones, so that a copied document's words don't count as evidence often."""
    seen: set = set()
    out = []
    for i, bag in enumerate(bags):
        keys = [(salt, *sorted(zlib.crc32(w.encode("utf-8", "surrogatepass"), salt) for w in bag)[:4]) for salt in (1, 2, 3)]
        if not bag or not any(k in seen for k in keys):
            out.append(i)
        seen.update(keys)
    return out


def bag_of(text: str | None, kernel: Kernel) -> set[str]:
    """The text's distinct words as the kernel sees them."""
    return {p for w in words_of(text or "") for p in kernel.pieces(w)}


def fit_texts(texts: list[str | None], labels: list[int], rounds: int = 3, seed: int = 11) -> Model:
    """Fit on labelled texts (sentences or documents; a text is toxic if one of its words is)."""
    kernel = Kernel()
    return fit_bags([bag_of(t, kernel) for t in texts], labels, rounds, seed)


def fit_bags(bags: list[set[str]], labels: list[int], rounds: int = 3, seed: int = 11) -> Model:
    y = np.array(labels, int)
    share = float(y.mean()) if len(y) else 0.0
    prior = Model(None, 0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    once = _once(bags)
    bags, y = [set(map(intern, bags[i])) for i in once], y[once]
    held = np.arange(len(y)) % 4 == 3  # for Platt scaling
    if not (y[~held] == 1).any() or not (y[~held] == 0).any():
        return prior
    kernel, rng = Kernel(), np.random.default_rng(seed)
    toxic = [bags[i] for i in np.flatnonzero(~held & (y == 1)) if bags[i]]
    clean = Counter(w for i in np.flatnonzero(~held & (y == 0)) for w in bags[i])
    vocabulary = sorted(clean)
    frequent = sorted(vocabulary, key=lambda w: -clean[w])[:LANDMARKS]
    every = sorted(set(vocabulary).union(*toxic))
    if not toxic:
        return prior
    seeded = _evidence(toxic, [bags[i] for i in np.flatnonzero(~held & (y == 0))], (int((y[~held] == 1).sum()), int((y[~held] == 0).sum())), every)
    score, model = seeded, prior
    for r in range(rounds):
        witness: Counter = Counter()
        for bag in toxic:
            # later rounds trust the decision; a document without any evidence (a wrong label, say) gives no witness then
            ranked = [(score(w), w) for w in bag if clean.get(w, 0) <= 1]
            if ranked:
                top, best = max(ranked)
                least = max(EVIDENCE, 0.6 * top) if r == 0 else min(top, 0.0) if seeded(best) >= EVIDENCE else 0.0
                witness.update(w for s, w in ranked if s >= least)
        positive = sorted(witness, key=lambda w: (-witness[w], w))
        negative = [w for w in vocabulary if w not in witness]
        if not positive or not negative:
            return prior
        # the commoner witnesses once more with a letter put in, which is how they are disguised
        disguised = [_disguise(w, rng) for w in positive if witness[w] >= 3 and len(w) > 3 for _ in range(VARIANTS)]
        first = [negative[i] for i in rng.permutation(len(negative))[:START]]
        common = [w for w in frequent if w not in witness]
        marks = Landmarks(list(dict.fromkeys(positive[: LANDMARKS // 2] + common[: LANDMARKS // 4] + first[:LANDMARKS]))[:LANDMARKS], kernel)
        x, weight = [marks.features(positive + disguised)], [min(witness[w], 20) ** 0.5 for w in positive] + [1.0] * len(disguised)
        n1, used, new = len(weight), set(), list(dict.fromkeys(common + first))
        while new:
            used.update(new)
            x.append(marks.features(new))
            x = [np.concatenate(x)]
            n = len(x[0])
            w, bias = _svm(x[0], np.where(np.arange(n) < n1, 1.0, -1.0), np.append(weight, np.ones(n - n1)))
            model = Model(marks.folded(w), bias, 1.0, 0.0)
            decided = dict(zip(every, model.decide_all(every, kernel).tolist(), strict=True))
            new = [w for w in negative if decided[w] > -1 + 1e-3 and w not in used]
        score = decided.__getitem__
    bags, y = [bags[i] for i in np.flatnonzero(held)], y[held]
    if y.any() and not y.all():
        # toxic documents count a second time with their insults disguised, so that the threshold leaves room for those
        cache: dict[str, float] = {}
        top = _tops(bags, model, kernel, cache)
        again = [{_disguise(w, rng) if len(w) > 3 and cache[w] > 0 else w for w in sorted(b)} for b, label in zip(bags, y, strict=True) if label]
        model.scale, model.shift = _platt(np.append(top, _tops(again, model, kernel)), np.append(y, np.ones(len(again), int)), np.append(np.ones(len(y)), np.full(len(again), DISGUISED)))
    return model if model.scale > 0 else prior


def _disguise(w: str, rng: np.random.Generator) -> str:
    at = int(rng.integers(1, len(w)))
    return w[:at] + "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)] + w[at:]


def _gram_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words' character n-grams of 4 to 6, word by word; how many each word has). A word of one character is its own."""
    size = np.array([len(w) + 2 for w in words])
    chars = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner, ends = np.repeat(np.arange(len(words)), size), np.cumsum(size)
    hashes, owners = [], []
    for k in (3, 4, 5, 6):
        at = np.arange(max(len(chars) - k + 1, 0))
        at = at[(at + k <= ends[owner[at]]) & ((k > 3) | (size[owner[at]] == 3))]
        h = np.full(len(at), k, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + chars[at + j]
        hashes.append(h)
        owners.append(owner[at])
    owner = np.concatenate(owners)
    return np.concatenate(hashes)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the words' n-grams, word by word; where each word's begin, and the end), by blocks of words."""
    parts = [_gram_hashes(words[at : at + 10_000]) for at in range(0, len(words), 10_000)]
    start = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in parts]))])
    known = np.unique(np.concatenate([h for h, _ in parts]))
    return np.concatenate([np.searchsorted(known, h).astype(np.int32) for h, _ in parts]), start


def _evidence(toxic: list[set[str]], clean: list[set[str]], sizes: tuple[int, int], words: list[str]):
    """The log odds of a word's most telling character n-gram, as a function of the word (one of `words`); n-grams of fewer than 3 toxic
    documents tell nothing."""
    number, start = _grams(words)
    place = {w: i for i, w in enumerate(words)}

    def documents(bags: list[set[str]]) -> np.ndarray:
        out = np.zeros(int(number.max(initial=-1)) + 1)
        for bag in filter(None, bags):
            own = np.array([place[w] for w in bag])
            n = start[own + 1] - start[own]
            out[np.unique(number[np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())])] += 1
        return out

    c1, c0 = documents(toxic), documents(clean)
    odds = (np.log((c1 + 0.1) / (sizes[0] + 0.2)) - np.log((c0 + 0.5) / (sizes[1] + 1))) * np.minimum(1.0, c1 / 8)
    best = np.maximum.reduceat(np.where(c1 >= 3, odds, -9.0)[number], start[:-1])
    return dict(zip(words, best.tolist(), strict=True)).__getitem__


def _tops(bags: list[set[str]], model: Model, kernel: Kernel, cache: dict | None = None) -> np.ndarray:
    cache = {} if cache is None else cache
    if len(cache) > CACHE:
        cache.clear()
    new = list(set().union(*bags) - cache.keys()) if bags else []
    cache.update(zip(new, model.decide_all(new, kernel).tolist(), strict=True))
    pad = [EMPTY] * TOPS
    d = np.array([(nlargest(TOPS, map(cache.__getitem__, b)) + pad)[:TOPS] for b in bags]).reshape(-1, TOPS).clip(EMPTY, -EMPTY)
    return d[:, 0] + np.log(np.exp(SHARP * (d - d[:, :1])).sum(1)) / SHARP


class Scorer:
    """Scores texts in one task; remembers the words it has decided, a bounded number of them."""

    def __init__(self, model: Model):
        self.model, self.kernel, self.cache = model, Kernel(), {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        m = self.model
        if m.table is None:
            return np.full(len(texts), 1 / (1 + np.exp(-m.shift)))
        out = []
        for at in range(0, len(texts), 200):
            out.append(_tops([words_of(t) if t else set() for t in texts[at : at + 200]], m, self.kernel, self.cache))
        d = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-(m.scale * d + m.shift)))


def fold(id_col="doc_id"):
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled documents outside fold 0, bounded as the module says: at most `sample` of each class by a hash of the id, and of these
    the first whose distinct words take `sample_bytes` bytes together (one that takes more alone is passed over)."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y")).where(fold("id") != 0)
    chosen = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample).collect()]
    if not chosen:
        return fit_bags([], [])

    def make():
        kernel = Kernel()
        return lambda cols: {"id": cols["id"], "y": cols["y"], "words": ["\n".join(sorted(bag_of(t, kernel))) for t in cols["text"]]}

    picked = docs.sparkSession.createDataFrame([(r.id, r.y) for r in chosen], "_id long, _y int")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL").join(F.broadcast(picked), F.col("id") == F.col("_id"))
    bags = map_batches(rows.select("id", F.col("_y").alias("y"), "text"), "id long, y int, words string", make)
    bags = table(bags.groupBy("id", "y").agg(F.min("words").alias("words")), "bags")
    room, taken = {0: sample_bytes, 1: sample_bytes}, []
    for r in sorted(bags.select("id", "y", F.octet_length("words").alias("size"), F.xxhash64("id").alias("at")).collect(), key=lambda r: (r["at"], r.id)):
        if r.size <= room[r.y]:
            room[r.y] -= r.size
            taken.append(r.id)
    found = {r.id: r for r in bags.where(F.col("id").isin(taken)).collect()} if len(taken) < len(chosen) else {r.id: r for r in bags.collect()}
    return fit_bags([set(filter(None, found[i].words.split("\n"))) for i in taken], [found[i].y for i in taken])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every document. No shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(held.value)

        def step(cols: dict) -> dict:
            return {"doc_id": cols["id"], "score": scorer(cols["text"])}

        return step

    out = map_batches(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")), "doc_id long, score double", make)
    return out.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of the documents that the model does not predict to be toxic."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(held.value)
        return lambda texts: (scorer(texts) < 0.5).tolist()

    return filter_batches(docs, [text_col], make)
