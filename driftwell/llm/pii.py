"""Personal data: base patterns plus offset-preserving deobfuscation.

A text is read twice. The base patterns run on the text as it is. The deobfuscation runs a chain of transducers
(invisible characters, homoglyphs and full-width forms, spelled digits, disguised "at" and "dot") that rewrite the
text while carrying, for every produced character, the source interval it stands for; identifiers found in the rewritten
text are mapped back to source intervals, so they can be cut out of the original. A plain " at " counts as a disguise only where a dot
of the address is disguised too: the word " dot " in the domain, or a bracketed dot on either side; before a written domain
("meet at example.com") it is left alone. The bounds of the disguise patterns stand beside them.

Defined results: null and empty texts have no spans; texts of any length are read whole, in time linear in their length;
repeated rows give repeated results; an empty table gives an empty result; columns other than the named ones are ignored (or passed through by `redact`).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

from pyspark.sql import DataFrame

from .common import map_batches, map_rows, slices, span_digest

KINDS = ("email", "ip", "card", "phone")
_ORDER = {k: i for i, k in enumerate(KINDS)}

# Possessive forms of the contract's patterns: same matches, no quadratic retries inside one run of characters.
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost non-overlapping matches per kind that pass their check, sorted by start, then kind."""
    found = []
    if "@" in text:
        floor = 0
        for m in _AT_DOMAIN.finditer(text):
            at = start = m.start()
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append((start, m.end(), "email"))
                floor = m.end()
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(ch.isdigit() for ch in m[0]) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], _ORDER[s[2]]))


# Look-alike characters and their plain forms.
_HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "ı": "i", "ɡ": "g", "ℓ": "l", "․": ".", "·": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-", "﹫": "@",
}
# Spelled digits in the corpus languages.
_DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_INVISIBLE = "­​‌‍⁠﻿"
_FULLWIDTH = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
_PLAIN = {**_HOMOGLYPHS, **_FULLWIDTH, " ": " ", " ": " ", " ": " "}
_ODD = re.compile("[" + re.escape("".join(_PLAIN)) + _INVISIBLE + "]")
_DIGIT_WORD = "|".join(sorted(map(re.escape, _DIGITS), key=len, reverse=True))
#: Spelled digits in a row, mixed with groups of up to 4 written ones and apart by up to 2 separators; every item ends at a word's end, so
#: that a row stops before a longer word ("until" is not "un"). Rows of fewer than 4 digits are left as they are.
_SPELLED = re.compile(rf"(?<!\w)(?:{_DIGIT_WORD})(?!\w)(?:[ ,.-]{{1,2}}(?:{_DIGIT_WORD}|[0-9]{{1,4}}|dot|plus|point|punkt|punto)(?!\w))++", re.I)
_SPELLED_PART = re.compile(rf"(?P<d>{_DIGIT_WORD})(?!\w)|(?P<n>[0-9]+)|(?P<dot>dot|point|punkt|punto)|(?P<plus>plus)", re.I)
_BRACKET_AT = re.compile(r" {0,3}[(\[{<] {0,3}(?:at|arroba|arobase|klammeraffe|@) {0,3}[)\]}>] {0,3}", re.I)
_BRACKET_DOT = re.compile(r" {0,3}[(\[{<] {0,3}(?:dot|punto|punkt|point|\.) {0,3}[)\]}>] {0,3}", re.I)
# Bounds of the disguises, so that no scan is quadratic: up to 3 blanks about a bracket, 64 and 63 characters a part (the limits of local
# parts and host labels in addresses), 5 parts before and 7 after the "at"; longer ones are left to the base patterns.
_WORDS = re.compile(r"(?<![\w.%+-])([A-Za-z0-9_%+-]{1,64}(?:(?:\.| dot )[A-Za-z0-9_%+-]{1,64}){0,4}) (?:at|@) ([A-Za-z0-9-]{1,63}(?:(?:\.| dot )[A-Za-z0-9-]{1,63}){1,6})(?![\w-])", re.I)
_AFTER_AT = re.compile(r"@ ?[A-Za-z0-9-]{1,63}(?:(?:\.| dot )[A-Za-z0-9-]{1,63}){1,6}", re.I)
_SPACED_AT = re.compile(r" ?@ ?")
_PHONE_WORD = re.compile(r"(?<!\w)plus (?=[0-9])", re.I)


class Tape:
    """A rewritten text and, for each of its characters, the source interval it came from."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, None, None

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply sorted, disjoint edits (from, to, replacement) to the current text."""
        if not edits:
            return
        start = self.start if self.start is not None else list(range(len(self.text)))
        end = self.end if self.end is not None else list(range(1, len(self.text) + 1))
        out, new_start, new_end, at = [], [], [], 0
        for a, b, put in edits:
            out.append(self.text[at:a])
            new_start += start[at:a]
            new_end += end[at:a]
            out.append(put)
            new_start += [start[a]] * len(put)
            new_end += [end[b - 1]] * len(put)
            at = b
        out.append(self.text[at:])
        self.text, self.start, self.end = "".join(out), new_start + start[at:], new_end + end[at:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (self.start[a], self.end[b - 1])


def _spelled(m: re.Match) -> str | None:
    out = []
    for p in _SPELLED_PART.finditer(m[0]):
        out.append(_DIGITS[p["d"].lower()] if p["d"] else p["n"] or ("." if p["dot"] else "+"))
    digits = "".join(out)
    return digits if sum(ch.isdigit() for ch in digits) >= 4 else None


def normalise(text: str) -> Tape:
    """Run the transducers in order; each is skipped when nothing in the text triggers it."""
    tape = Tape(text)
    if not text.isascii():
        tape.rewrite([(m.start(), m.end(), _PLAIN.get(m[0], "")) for m in _ODD.finditer(text)])
    low = tape.text.lower() if len(tape.text.lower()) == len(tape.text) else tape.text
    if _SPELLED.search(low):
        tape.rewrite([(m.start(), m.end(), put) for m in _SPELLED.finditer(tape.text) if (put := _spelled(m)) is not None])
    if "plus " in low:
        tape.rewrite([(m.start(), m.end(), "+") for m in _PHONE_WORD.finditer(tape.text)])
    dots: list[int] = []  # where the bracket step puts dots
    if any(ch in tape.text for ch in "([{<"):
        tape.rewrite([(m.start(), m.end(), "@") for m in _BRACKET_AT.finditer(tape.text)])
        brackets = [m.span() for m in _BRACKET_DOT.finditer(tape.text)]
        tape.rewrite([(a, b, ".") for a, b in brackets])
        cut = 0
        for a, b in brackets:
            dots.append(a - cut)
            cut += b - a - 1
    if " dot " in low or dots:
        edits = []
        for m in _WORDS.finditer(tape.text):
            if " dot " in m[2].lower() or bisect_left(dots, m.end(2)) > bisect_left(dots, m.start(1)):
                at = m.end(1)
                edits += [(at, m.start(2), "@")]
                for g in (1, 2):
                    edits += [(m.start(g) + d.start(), m.start(g) + d.end(), ".") for d in re.finditer(" dot ", m[g], re.I)]
        tape.rewrite(sorted(edits))
        tape.rewrite([(m.start() + d.start(), m.start() + d.end(), ".") for m in _AFTER_AT.finditer(tape.text) for d in re.finditer(" dot ", m[0], re.I)])
    if " @" in tape.text or "@ " in tape.text:
        tape.rewrite([(m.start(), m.end(), "@") for m in _SPACED_AT.finditer(tape.text) if m[0] != "@"])
    return tape


def find_spans(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, spans that only the deobfuscated text shows). An added span never lies inside a base span of its kind."""
    if not text:
        return [], []
    base = base_spans(text)
    tape = normalise(text)
    if tape.start is None:
        return base, []
    taken: dict[str, list[tuple[int, int]]] = {}
    for a, b, kind in base:
        taken.setdefault(kind, []).append((a, b))
    added = []
    for a, b, kind in base_spans(tape.text):
        a, b = tape.source(a, b)
        own = taken.get(kind, ())
        lo, hi = 0, len(own)
        while lo < hi:  # first base span of the kind that ends after a
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if own[mid][1] <= a else (lo, mid)
        if lo == len(own) or not (own[lo][0] <= a and b <= own[lo][1]):
            added.append((a, b, kind))
    return base, added


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as kind:start:end. No shuffle."""

    def make():
        def step(cols: dict) -> dict:
            out: dict[str, list] = {k: [] for k in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")}
            for key, text in zip(cols["id"], cols["text"], strict=True):
                base, added = find_spans(text)
                kinds = [s[2] for s in base]
                out["doc_id"].append(key)
                for kind in KINDS:
                    out[f"n_{kind}"].append(kinds.count(kind))
                out["base_sha256"].append(hashlib.sha256(span_digest(base).encode()).hexdigest())
                out["spans"].append(span_digest(sorted(base + added, key=lambda s: (s[0], _ORDER[s[2]]))))
                out["n_added"].append(len(added))
            return out

        return step

    return map_batches(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")), SCHEMA, make)


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are merged under the first's kind."""
    if not text:
        return text
    base, added = find_spans(text)
    if not base and not added:
        return text
    out, at = [], 0
    for a, b, kind in sorted(base + added, key=lambda s: (s[0], -s[1], _ORDER[s[2]])):
        if a >= at:
            out.append(text[at:a] + f"<{kind}>")
        at = max(at, b)
    out.append(text[at:])
    return "".join(out)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns, with personal data in text_col masked and length_col (where present) set to the new length."""
    import pyarrow as pa

    at = docs.columns.index(text_col)
    n = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches):
        for batch in slices(batches):
            texts = [mask(t) for t in batch.column(at).to_pylist()]
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            if n is not None:
                old = cols[n].to_pylist()
                cols[n] = pa.array([o if t is None else len(t) for o, t in zip(old, texts, strict=True)], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return map_rows(docs, run)
