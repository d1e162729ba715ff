"""Chat formatting by schema fingerprint.

Records of many layouts (message lists, prompt and response, instruction and output, a row per turn) become canonical turns:
the hash of a record's nested field paths selects a declarative mapping. Turns are then written in a template that marks
each turn by control strings; control strings inside roles and texts are escaped reversibly, so that reading the output
back gives every text unchanged. Formatting streams over turns sorted by conversation: a conversation of any length is
never held whole.

Defined results: null texts and roles are empty; turns with equal numbers are ordered by role, then text; repeated rows are turns
of their own; records of an unknown layout, records that are no JSON or nested too deeply to read, and message lists with an element
that is no object give one row with layout "unmapped", which formatting leaves out; ids and turn numbers that are no 64-bit integers
are null; an empty table gives no conversation; lone surrogates become U+FFFD; other columns are ignored; rows without conversation id form a conversation whose id is null.
A conversation's digest reads its turns in order, so one conversation is one task's work, streamed after a sort that spills.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns. `needs` and `may` are field paths ([] marks a list's elements)."""

    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...] = ()
    id: str = "id"
    #: (role, field paths joined by a blank line) for layouts with one field per turn.
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    #: (list field, role field, text field) for layouts with a list of messages.
    messages: tuple[str, str, str] = ()
    #: (turn field, role field, text field) for layouts with a row per turn.
    row: tuple[str, str, str] = ()
    roles: dict = field(default_factory=dict, hash=False)


_SHARED = {"human": "user", "gpt": "assistant", "bot": "assistant", "chatgpt": "assistant", "prompter": "user"}
# The layouts in use.
MAPPINGS = (
    Mapping("turn-row", ("conv_id", "turn", "role", "text"), id="conv_id", row=("turn", "role", "text")),
    Mapping("turn-row-content", ("conversation_id", "turn", "role", "content"), id="conversation_id", row=("turn", "role", "content")),
    Mapping("messages", ("messages[].role", "messages[].content"), ("id", "system", "messages[].name"), messages=("messages", "role", "content"), turns=(("system", ("system",)),)),
    Mapping("dialog", ("dialog[].role", "dialog[].content"), ("id",), messages=("dialog", "role", "content")),
    Mapping("shared", ("conversations[].from", "conversations[].value"), ("id", "system"), messages=("conversations", "from", "value"), turns=(("system", ("system",)),), roles=_SHARED),
    Mapping("instruction", ("instruction", "output"), ("id", "input", "system"), turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("instruction-context", ("instruction", "response"), ("id", "context", "category"), turns=(("user", ("instruction", "context")), ("assistant", ("response",)))),
    Mapping("prompt-response", ("prompt", "response"), ("id", "system"), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt-completion", ("prompt", "completion"), ("id", "system"), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("question-answer", ("question", "answer"), ("id", "context"), turns=(("user", ("context", "question")), ("assistant", ("answer",)))),
    Mapping("question-response", ("question", "response"), ("id", "system_prompt"), turns=(("system", ("system_prompt",)), ("user", ("question",)), ("assistant", ("response",)))),
    Mapping("preference", ("prompt", "chosen"), ("id", "rejected"), turns=(("user", ("prompt",)), ("assistant", ("chosen",)))),
)


def paths(value) -> set[str]:
    """Paths of the leaves; an empty list or object is a leaf."""
    out, left = set(), [("", value)]
    while left:
        at, value = left.pop()
        if isinstance(value, dict) and value:
            left += [(f"{at}.{k}" if at else k, v) for k, v in value.items()]
        elif isinstance(value, list) and value:
            left += [(f"{at}[]", v) for v in value]
        else:
            out.add(at)
    return out


def fingerprint(found: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(found)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


@lru_cache(1)
def registry() -> dict[str, Mapping]:
    """Fingerprints of every mapping's fields with any of its optional ones."""
    out: dict[str, Mapping] = {}
    for m in MAPPINGS:
        for n in range(len(m.may) + 1):
            for extra in combinations(m.may, n):
                out.setdefault(fingerprint({*m.needs, *extra}), m)
    return out


class Selector:
    """Record to mapping by fingerprint; an unregistered one goes to the mapping with the most needed fields, all of them present."""

    def __init__(self):
        self.known: dict[str, Mapping | None] = dict(registry())

    def __call__(self, record) -> tuple[str, Mapping | None]:
        found = paths(record)
        mark = fingerprint(found)
        if mark not in self.known:
            if len(self.known) > 100_000:
                self.known = dict(registry())
            fits = [m for m in MAPPINGS if set(m.needs) <= found]
            self.known[mark] = max(fits, key=lambda m: len(m.needs), default=None)
        return mark, self.known[mark]


def _text(value) -> str:
    if value is None:
        return ""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _whole(value) -> int | None:
    """A 64-bit integer, else null."""
    return value if isinstance(value, int) and not isinstance(value, bool) and -(2**63) <= value < 2**63 else None


def turns_of(record, m: Mapping) -> list[tuple[int | None, str, str]]:
    """(turn, role, text) of a record; ValueError if a message is no object."""
    if m.row:
        number, role, text = (record.get(k) for k in m.row)
        return [(_whole(number), _text(role), _text(text))]
    out = []
    for role, fields in m.turns:
        parts = [_text(record.get(k)) for k in fields]
        if any(k in record for k in fields) and (role != "system" or any(parts)):
            out.append((role, "\n\n".join(p for p in parts if p)))
    if m.messages:
        key, role, text = m.messages
        for x in record.get(key) or []:
            if not isinstance(x, dict):
                raise ValueError("a message is no object")
            said = _text(x.get(role))
            out.append((m.roles.get(said, said), _text(x.get(text))))
    return [(i, role, text) for i, (role, text) in enumerate(out)]


def turn_reader():
    """The step that turns a batch of JSON records into rows of turns."""
    select = Selector()

    def step(cols: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("conv_id", "turn", "role", "text", "layout", "fingerprint")}
        for key, text in zip(cols["id"], cols["record"], strict=True):
            try:
                record = json.loads(text) if text else None
                mark, m = select(record) if isinstance(record, dict) else ("", None)
                found = turns_of(record, m) if m else []
            except (ValueError, RecursionError):
                mark, m, record, found = "", None, None, []
            own = key if key is not None or m is None else _whole(record.get(m.id))
            for number, role, said in found if m else [(None, None, None)]:
                for k, v in zip(out, (own, number, role, said, m.name if m else "unmapped", mark), strict=True):
                    out[k].append(v)
        return out

    return step


def canonical_turns(records: DataFrame, record_col: str = "record", id_col: str | None = None) -> DataFrame:
    """conv_id, turn, role, text, layout, fingerprint: the turns of JSON records. The id is id_col or the record's own."""
    from pyspark.sql import functions as F

    key = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    return map_batches(records.select(key.alias("id"), F.col(record_col).cast("string").alias("record")), "conv_id long, turn long, role string, text string, layout string, fingerprint string", turn_reader)


# The template's marks, and control strings of other templates that texts must not carry into training either.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>", "<|eot_id|>", "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<pad>", "<unk>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>")
_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.S)


def escape(text: str) -> str:
    """Backslashes are doubled, and a backslash splits every control string behind its first character."""
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n!")


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(n!|.)", lambda m: "\n" if m[1] == "n!" else m[1], role, flags=re.S)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template, and the interval of its text under the loss mask (empty unless the assistant speaks)."""
    head, body = f"{START}{_escape_role(role)}\n", escape(text)
    a = len(head)
    return f"{head}{body}{END}\n", a, a + len(body) if role == "assistant" else a


def _rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(n)), strict=True)


def format_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, part (0, 1, ...), formatted, loss_start, loss_end: a row per turn, in order within its partition.

    A conversation's training text is its parts' concatenation. One shuffle, by conversation.
    """
    from pyspark.sql import functions as F

    if "layout" in turns.columns:
        turns = turns.where("layout IS NULL OR layout != 'unmapped'")
    src = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        now, part, first = None, 0, True
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("conv_id", "part", "formatted", "loss_start", "loss_end")}
            for key, _, role, text in _rows([batch], 4):
                part = 0 if first or key != now else part + 1
                now, first = key, False
                done, a, b = format_turn(role, text)
                for k, v in zip(out, (key, part, done, a, b), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())]))

    return src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, "conv_id long, part long, formatted string, loss_start long, loss_end long")


def read_back(formatted: DataFrame, ordered: bool = False) -> DataFrame:
    """Per conversation, parsed from the formatted text alone: turns, their digest, characters and digest under the loss mask.

    `ordered`: the rows come straight from format_turns and need no shuffle.
    """
    src = formatted.select("conv_id", "part", "formatted", "loss_start", "loss_end")
    if not ordered:
        src = src.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    kind = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        now, state = None, None
        out: list[tuple] = []

        def close():
            out.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def batch_of():
            cols = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind, strict=True)], schema=kind)

        for key, _, text, a, b in _rows(batches, 5):
            if state is None or key != now:
                if state is not None:
                    close()
                now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if len(out) >= 5000:
                    yield batch_of()
            for m in _TURN.finditer(text):
                state[0] += 1
                state[1].update(f"{_unescape_role(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
            said = unescape(text[a:b])
            state[2] += len(said)
            state[3].update(said.encode("utf-8", "surrogatepass"))
            state[4] += len(text)
        if state is not None:
            close()
        if out:
            yield batch_of()

    return src.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
