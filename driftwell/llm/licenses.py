"""License scans: ordered signature rules over the words of a text.

Base phrases are found word by word in every text. The rules (license_rules.py) are hand-written regexes over the lower-cased words joined
by single spaces. A keyword prefilter (one multi-string automaton) decides which rules can match a text at all; the
keywords are read off the rules themselves: literal parts one of which every match holds. Detections are intervals of words with the rule's
priority, its place in the order; an interval that lies inside one of a higher priority is suppressed, so of two rules that claim
equal intervals the earlier one wins.

Defined results: null and empty texts have no words; texts are read whole; repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import re._constants as code
import re._parser as parser
from bisect import bisect_right
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from . import license_rules
from .common import map_batches

#: The contract's phrases and labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

_KEEP = bytes(c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def keywords(regex: str) -> tuple[str, ...]:
    """Literals one of which every match of the regex holds: of all parts that each match must pass, the one with the longest literals."""

    def best(parts) -> tuple[str, ...]:
        found: list[tuple[str, ...]] = []
        run = ""
        for op, value in [*parts, (None, None)]:
            if op is code.LITERAL:
                run += chr(value)
                continue
            if run:
                found.append((run,))
            run = ""
            if op is code.SUBPATTERN:
                found.append(best(value[3]))
            elif op is code.BRANCH:
                each = [best(p) for p in value[1]]
                found.append(tuple(dict.fromkeys(w for e in each for w in e)) if all(each) else ())
            elif op in (code.MAX_REPEAT, code.MIN_REPEAT) and value[0]:
                found.append(best(value[2]))
        return max(filter(None, found), key=lambda ws: min(map(len, ws)), default=())

    return best(parser.parse(regex))


@lru_cache(1)
def rules() -> list[tuple[str, tuple[str, ...], re.Pattern, float]]:
    """(label, keywords, regex, confidence) in order of priority."""
    return [(label, keywords(regex), re.compile(rf"(?<!\S)(?:{regex})(?!\S)"), license_rules.WEAK.get(label, sure)) for group, sure in license_rules.KINDS for label, regex in group]


class Scanner:
    def __init__(self):
        self.rules = rules()
        self.phrases = [(tuple(p.encode().split()), label) for p, label in PHRASES]
        by: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            for word in r[1]:
                by.setdefault(word, []).append(i)
        self.hints = ahocorasick.Automaton()
        for word, ids in by.items():
            self.hints.add_word(word, (word, ids))
        self.hints.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[int], list[str], list[tuple[str, int, int, float]]]:
        """(words, base places, base labels, rule detections as (label, first word, words, confidence))."""
        if not text:
            return 0, [], [], []
        words = text.encode("utf-8", "surrogatepass").translate(_KEEP).split()
        joined = b" ".join(words) + b" "
        places, labels = [], set()
        for phrase, label in self.phrases:
            needle = b" ".join(phrase) + b" "
            at, word, seen = joined.find(needle), 0, 0
            while at >= 0:
                if at == 0 or joined[at - 1] == 32:
                    word, seen = word + joined.count(b" ", seen, at), at
                    places.append(word)
                    labels.add(label)
                at = joined.find(needle, at + 1)
        return len(words), places, sorted(labels), self._rules(joined.decode("utf-8", "surrogatepass"))

    def possible(self, joined: str) -> list[int]:
        return sorted({i for _, (_, ids) in self.hints.iter(joined) for i in ids})

    def _rules(self, joined: str) -> list[tuple[str, int, int, float]]:
        spans = [(-i, m.end() - m.start(), m.start(), m.end(), self.rules[i][0], self.rules[i][3]) for i in self.possible(joined) for m in self.rules[i][2].finditer(joined)]
        spans.sort(key=lambda s: (-s[0], -s[1], s[2], s[4]))
        kept: list[tuple[int, int, str, float]] = []
        starts: list[int] = []
        reach: list[int] = []  # largest end among kept spans that start at or before the same index
        for _, _, a, b, label, sure in spans:
            i = bisect_right(starts, a)
            if i and reach[i - 1] >= b:
                continue
            starts.insert(i, a)
            kept.insert(i, (a, b, label, sure))
            reach.insert(i, 0)
            for j in range(i, len(reach)):
                new = max(kept[j][1], reach[j - 1] if j else 0)
                if j > i and reach[j] == new:
                    break
                reach[j] = new
        out, word, at = [], 0, 0
        for a, b, label, sure in kept:
            word, at = word + joined.count(" ", at, a), a
            out.append((label, word, joined.count(" ", a, b) + 1, sure))
        return out


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_detections long"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, base places and labels, all labels, and the strongest detection's confidence. No shuffle."""

    def make():
        scanner = Scanner()

        def step(cols: dict) -> dict:
            out: dict[str, list] = {k.split()[0]: [] for k in SCHEMA.split(", ")}
            for key, text in zip(cols["id"], cols["text"], strict=True):
                n, places, base, found = scanner.scan(text)
                every = {f[0] for f in found} | set(base)
                named = every - {"unspecified"} or every
                values = (key, n, len(places), min(places, default=None), max(places, default=None), ",".join(base), ",".join(sorted(named)), max([f[3] for f in found] + [0.9] * bool(base), default=0.0), len(found))
                for k, v in zip(out, values, strict=True):
                    out[k].append(v)
            return out

        return step

    return map_batches(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")), SCHEMA, make)
