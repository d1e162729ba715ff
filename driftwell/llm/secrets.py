"""Secret scans: base patterns plus multipart credential linking.

A credential often comes in parts: an access identifier, the secret that belongs to it and the endpoint it opens. Each part
alone is a weak candidate. Parts become intervals of the text; an interval join inside each scope (a run of lines without a
blank line, cut where two parts are more than WINDOW characters apart) links complementary parts, and a weak candidate is
reported only when its complements co-occur: every identifier with a secret near it, every secret with an identifier near it, and every
endpoint near one of either. A part is taken whole, however long, with or without blanks around its "=" or ":"; a value assigned to a
secret access key is a secret, not an identifier. Schemes of endpoints have at most 21 characters.

Defined results: null and empty texts have no spans; texts are read whole in near-linear time; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable

from pyspark.sql import DataFrame

from .common import map_batches, span_digest

KINDS = ("assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint")
_ORDER = {k: i for i, k in enumerate(KINDS)}
#: Parts further apart than this many characters are never linked.
WINDOW = 400

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINT = re.compile(r"(?:password|passwd|secret|token|api_?key)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

# Weak parts, of any length. Identifiers and endpoints are named or shaped; secrets are named or opaque strings of high entropy.
_ASSIGNED = r"""["']?[ ]*+[:=][ ]*+["']?"""
_WEAK_ID = re.compile(rf"(?:(?:user(?:name)?|login|client_?id|account|(?<!secret)(?<!secret_)access_?key(?:_?id)?|key_?id){_ASSIGNED}([A-Za-z0-9@._+-]{{3,}}+))|\b((?:AKIA|ASIA|AGPA|AROA)[A-Z0-9]{{8,}}+)|\b([a-z]{{2,6}}_(?:live|test|pub)_[A-Za-z0-9]{{8,}}+)", re.I | re.A)
_NAMED_SECRET = re.compile(rf"""(?<![A-Za-z])(?:pass|pwd|passphrase|private_?key|auth_?key|secret_?(?:access_?)?key){_ASSIGNED}([^\s"'<>,;]{{6,}}+)""", re.I | re.A)
_WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(rf"(?:\b[a-z][a-z0-9+.-]{{1,20}}://[^\s\"'<>]{{3,}}+|(?<![A-Za-z])(?:host|endpoint|server|region|bucket){_ASSIGNED}[A-Za-z0-9.-]{{3,}}+)", re.I | re.A)
_BLANK = re.compile(r"\n[ \t\r]*\n")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    if _ASSIGN_HINT.search(text):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], _ORDER[s[2]]))


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in map(s.count, set(s)))


def _opaque(s: str) -> bool:
    """Looks drawn at random: several character classes and high entropy for its length."""
    kinds = any(ch.isdigit() for ch in s) + any(ch.islower() for ch in s) + any(ch.isupper() for ch in s)
    return kinds >= 2 and any(ch.isdigit() for ch in s) and entropy(s) >= 0.7 * math.log2(min(len(s), 64))


def _parts(text: str, base: list[tuple[int, int, str]]) -> tuple[list, list, list]:
    ids = [(m.start(i), m.end(i)) for m in _WEAK_ID.finditer(text) if (i := m.lastindex)]
    ends = [m.span() for m in _ENDPOINT.finditer(text)]
    secrets = [m.span() for m in _WEAK_SECRET.finditer(text) if _opaque(m[0])]
    secrets += [m.span(1) for m in _NAMED_SECRET.finditer(text)]
    secrets += [(a, b) for a, b, kind in base if kind in ("assign", "hex")]
    own = set(ids)
    return sorted(ids), sorted(set(secrets) - own), sorted(ends)


class _Places:
    """Disjoint or overlapping intervals, none of which holds a line break, for the question whether one of them is near a part."""

    def __init__(self, parts: Iterable[tuple[int, int]], scopes: list[int]):
        self.starts, self.ends, self.scopes = sorted(a for a, _ in parts), sorted(b for _, b in parts), scopes

    def near(self, part: tuple[int, int]) -> bool:
        """Whether an interval that doesn't overlap part lies within WINDOW characters in its scope: the next one on either side decides."""
        scope = bisect_left(self.scopes, part[0])
        i, j = bisect_left(self.starts, part[1]), bisect_right(self.ends, part[0]) - 1
        after = i < len(self.starts) and self.starts[i] - part[1] <= WINDOW and bisect_left(self.scopes, self.starts[i]) == scope
        return after or (j >= 0 and part[0] - self.ends[j] <= WINDOW and bisect_left(self.scopes, self.ends[j]) == scope)


def link(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Weak candidates whose complementary parts co-occur in their scope, without those that a base span covers."""
    ids, secrets, ends = _parts(text, base)
    if not ids or not secrets:
        return []
    scopes = [m.start() for m in _BLANK.finditer(text)]
    by_id, by_secret = _Places(ids, scopes), _Places(secrets, scopes)
    linked_secrets, linked_ids = [s for s in secrets if by_id.near(s)], [i for i in ids if by_secret.near(i)]
    found = {(*s, "linked_secret") for s in linked_secrets} | {(*i, "linked_id") for i in linked_ids}
    by_secret, by_id = _Places(linked_secrets, scopes), _Places(linked_ids, scopes)
    found |= {(*e, "linked_endpoint") for e in ends if by_secret.near(e) or by_id.near(e)}
    starts = [s[0] for s in base]
    tops: list[int] = []
    for s in base:
        tops.append(max(s[1], tops[-1] if tops else 0))

    def covered(a: int, b: int) -> bool:
        i = bisect_left(starts, a + 1) - 1
        return i >= 0 and tops[i] >= b

    return [s for s in found if not covered(s[0], s[1])]


def find_spans(text: str | None) -> tuple[list, list]:
    if not text:
        return [], []
    base = base_spans(text)
    added = link(text, base) if _ASSIGN_HINT.search(text) or _WEAK_ID.search(text) else []
    return base, sorted(added, key=lambda s: (s[0], _ORDER[s[2]]))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as kind:start:end. No shuffle."""

    def make():
        def step(cols: dict) -> dict:
            out: dict[str, list] = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked")}
            for key, text in zip(cols["id"], cols["text"], strict=True):
                base, added = find_spans(text)
                kinds = [s[2] for s in base]
                out["doc_id"].append(key)
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(kinds.count(kind))
                out["base_sha256"].append(hashlib.sha256(span_digest(base).encode()).hexdigest())
                out["spans"].append(span_digest(sorted(base + added, key=lambda s: (s[0], _ORDER[s[2]]))))
                out["n_linked"].append(len(added))
            return out

        return step

    return map_batches(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")), SCHEMA, make)
