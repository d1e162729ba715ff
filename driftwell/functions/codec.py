"""Protobuf wire codec for the pipeline's messages, as Arrow-batched Spark functions.

The decoder is strict: a known field with another wire type, truncated input, field number 0 and invalid UTF-8 are errors;
unknown fields are skipped and so never re-encoded; scalar fields and map keys that occur twice keep the last value;
an embedded message that occurs twice is merged.

Messages without repeated messages are encoded and decoded a slice of rows at a time, field by field, by array operations. `parse` and `serialise` say what
the bytes mean: rows that are anything but plain (unknown or repeated fields, errors, text that isn't UTF-8, very many entries) are given to `parse` one by one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BATCH, DEAD_LETTER, ENRICHED, EVENT

# Field numbers and kinds of the messages.
_INSTANT = {1: ("seconds", "int64"), 2: ("nanos", "int32")}
_EVENT = {1: ("event_id", "string"), 2: ("event_time", _INSTANT), 3: ("service_name", "string"), 4: ("route", "string"), 5: ("latency_us", "uint64"), 6: ("status_code", "uint32"), 7: ("trace_id", "string"), 8: ("attributes", "map")}
_ENRICHED = {1: ("event", _EVENT), 2: ("ewma_mean_us", "double"), 3: ("ewma_stddev_us", "double"), 4: ("anomaly_score", "double"), 5: ("is_anomaly", "bool"), 6: ("processed_at", _INSTANT)}
_DEAD = {1: ("original_payload", "bytes"), 2: ("stage", "int32"), 3: ("source_topic", "string"), 4: ("source_partition", "int32"), 5: ("source_offset", "int64"), 6: ("error_category", "string"), 7: ("reason", "string"), 8: ("failed_at", _INSTANT), 9: ("event_id", "string")}
_BATCH = {1: ("batch_id", "string"), 2: ("events", [_EVENT])}
#: An enriched record around an event that is encoded already.
_AROUND = {**_ENRICHED, 1: ("event", "bytes")}
_ENTRY = {1: ("key", "string"), 2: ("value", "string")}
_ZERO = {"string": "", "bytes": b"", "double": 0.0, "bool": False}
_WIRE = {"string": 2, "bytes": 2, "double": 1, "map": 2}


#: Bytes of an Arrow batch that are taken as Python objects at a time (they are some ten times as large then), or one row.
SLICE_BYTES = 1 << 20


class WireError(ValueError):
    pass


def _slices(array: pa.Array) -> Iterator[pa.Array]:
    """The array's rows, in order, in pieces of at most SLICE_BYTES, or of one row: a batch of requests may hold a million events."""
    if len(array) > 1 and array.nbytes > SLICE_BYTES:
        half = len(array) // 2
        yield from _slices(array.slice(0, half))
        yield from _slices(array.slice(half))
    else:
        yield array


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data):
            raise WireError("truncated varint")
        byte = data[at]
        at += 1
        if shift == 63 and byte > 1:
            raise WireError("varint exceeds 64 bits")
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _signed(v: int, bits: int) -> int:
    v &= (1 << bits) - 1
    return v - (1 << bits) if v >> (bits - 1) else v


def _empty(spec: dict) -> dict:
    out = {}
    for name, kind in spec.values():
        out[name] = None if isinstance(kind, dict) else [] if isinstance(kind, list) else {} if kind == "map" else _ZERO.get(kind, 0)
    return out


def _string(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError as e:
        raise WireError("invalid UTF-8") from e


def parse(data: bytes, spec: dict, into: dict | None = None, depth: int = 0) -> dict:
    out = _empty(spec) if into is None else into
    at, n = 0, len(data)
    if depth > 100:
        raise WireError("nested too deeply")
    while at < n:
        tag, at = _varint(data, at)
        number, wire = tag >> 3, tag & 7
        if number == 0 or tag >= 1 << 32:
            raise WireError("invalid field number")
        raw: bytes = b""
        value = 0
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 1 or wire == 5:
            size = 8 if wire == 1 else 4
            raw, at = data[at : at + size], at + size
        elif wire == 2:
            size, at = _varint(data, at)
            raw, at = data[at : at + size], at + size
        elif wire == 3:
            at = _skip_group(data, at, number, depth + 1)
        else:
            raise WireError("invalid wire type")
        if at > n:
            raise WireError("truncated field")
        if number not in spec:
            continue
        name, kind = spec[number]
        want = 2 if isinstance(kind, (dict, list)) else _WIRE.get(kind, 0)
        if wire != want:
            raise WireError(f"wire type {wire} for {name}")
        if isinstance(kind, dict):
            out[name] = parse(raw, kind, out[name], depth + 1)
        elif isinstance(kind, list):
            out[name].append(parse(raw, kind[0], None, depth + 1))
        elif kind == "map":
            entry = parse(raw, _ENTRY, None, depth + 1)
            out[name][entry["key"]] = entry["value"]
        elif kind == "string":
            out[name] = _string(raw)
        elif kind == "bytes":
            out[name] = raw
        elif kind == "double":
            out[name] = struct.unpack("<d", raw)[0]
        elif kind == "bool":
            out[name] = value != 0
        elif kind == "uint32":
            out[name] = value & 0xFFFFFFFF
        elif kind == "uint64":
            out[name] = value
        else:
            out[name] = _signed(value, 32 if kind == "int32" else 64)
    return out


def _skip_group(data: bytes, at: int, number: int, depth: int) -> int:
    if depth > 100:
        raise WireError("nested too deeply")
    while True:
        tag, at = _varint(data, at)
        wire = tag & 7
        if wire == 4:
            if tag >> 3 != number:
                raise WireError("group ends under another number")
            return at
        if wire == 0:
            _, at = _varint(data, at)
        elif wire == 1:
            at += 8
        elif wire == 5:
            at += 4
        elif wire == 2:
            size, at = _varint(data, at)
            at += size
        elif wire == 3:
            at = _skip_group(data, at, tag >> 3, depth + 1)
        else:
            raise WireError("invalid wire type")


def _put_varint(out: bytearray, v: int) -> None:
    v &= 0xFFFFFFFFFFFFFFFF
    while v > 0x7F:
        out.append(v & 0x7F | 0x80)
        v >>= 7
    out.append(v)


def serialise(row: dict, spec: dict) -> bytes:
    """Fields in order of their numbers; default values are left out, as proto3 has it."""
    out = bytearray()
    for number, (name, kind) in spec.items():
        v = row.get(name)
        if v is None:
            continue
        if isinstance(kind, (dict, list)) or kind == "map":
            if isinstance(kind, dict):
                parts = [serialise(v, kind)]
            elif isinstance(kind, list):
                parts = [serialise(x, kind[0]) for x in v]
            else:
                parts = [serialise({"key": k, "value": x}, _ENTRY) for k, x in sorted(v.items() if isinstance(v, dict) else v)]
            for p in parts:
                _put_varint(out, number << 3 | 2)
                _put_varint(out, len(p))
                out += p
        elif kind in ("string", "bytes"):
            p = v.encode() if isinstance(v, str) else bytes(v)
            if p:
                _put_varint(out, number << 3 | 2)
                _put_varint(out, len(p))
                out += p
        elif kind == "double":
            if v != 0 or str(v) == "-0.0":
                _put_varint(out, number << 3 | 1)
                out += struct.pack("<d", v)
        elif v:
            _put_varint(out, number << 3)
            _put_varint(out, int(v))
    return bytes(out)


def _result(kind: T.StructType, field: str) -> T.StructType:
    return T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType()), T.StructField(field, kind)])


def _column(values: list, kind: T.DataType) -> pa.Array:
    """Parsed values as an Arrow array, field by field, without a dictionary walk a row."""
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)
    if isinstance(kind, T.StructType):
        rows = [{} if v is None else v for v in values]
        return pa.StructArray.from_arrays([_column([r.get(f.name) for r in rows], f.dataType) for f in kind], fields=list(arrow), mask=pa.array([v is None for v in values], pa.bool_()))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        ends = [0]
        for v in values:
            ends.append(ends[-1] + len(v or ()))
        flat = _column([x for v in values for x in v or ()], kind.elementType)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, type=arrow, mask=pa.array([v is None for v in values], pa.bool_()))
    if isinstance(kind, T.MapType):
        values = [None if v is None else list(v.items()) for v in values]
    return pa.array(values, arrow)


#: Fields of a message, map entries counted one by one, that are read by array operations.
ROUNDS = 64


def _by_columns(spec: dict) -> bool:
    return all(number < 16 and not isinstance(kind, list) and (not isinstance(kind, dict) or _by_columns(kind)) for number, (_, kind) in spec.items())


def _binary(sizes: np.ndarray, data: np.ndarray, kind: pa.DataType = pa.binary()) -> pa.Array:
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _places(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of so many items from each place on."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(at - before, sizes) + np.arange(int(sizes.sum()))


def _gather(data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of data from each place on, one after the other."""
    return data[_places(at, sizes)]


def _varints_at(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, place behind it, bad) of the varint at each place."""
    value, to, bad, open_ = np.zeros(len(at), np.uint64), at.copy(), np.zeros(len(at), bool), np.arange(len(at))
    for shift in range(0, 70, 7):
        bad[open_[to[open_] >= end[open_]]] = True
        open_ = open_[to[open_] < end[open_]]
        byte = data[to[open_]]
        if shift == 63:
            bad[open_[byte > 1]] = True
        value[open_] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
        to[open_] += 1
        open_ = open_[byte >= 0x80]
        if not len(open_):
            break
    return value, to, bad


class _Fields:
    """What a scan of messages found: per field its place and size, or its number, and whether it is there; entries of maps with their rows."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, spec: dict):
        n = len(start)
        self.data, self.spec, self.bad = data, spec, np.zeros(n, bool)
        self.there = {name: np.zeros(n, bool) for name, _ in spec.values()}
        self.at = {name: np.zeros(n, np.int64) for name, _ in spec.values()}
        self.size = {name: np.zeros(n, np.int64) for name, _ in spec.values()}
        self.number = {name: np.zeros(n, np.uint64) for name, kind in spec.values() if kind in ("double", "bool", "int32", "int64", "uint32", "uint64")}
        self.entries: dict[str, list] = {name: [] for name, kind in spec.values() if kind == "map"}
        tags = {number << 3 | (2 if isinstance(kind, dict) else _WIRE.get(kind, 0)): (name, kind) for number, (name, kind) in spec.items()}
        at, rows = start.astype(np.int64), np.flatnonzero(start < end)
        for _ in range(ROUNDS):
            if not len(rows):
                break
            tag = data[at[rows]]
            for t in np.unique(tag):
                own = rows[tag == t]
                if int(t) not in tags:
                    self.bad[own] = True
                    continue
                self._take(*tags[int(t)], int(t) & 7, own, at, end)
            rows = rows[~self.bad[rows]]
            rows = rows[at[rows] < end[rows]]
        self.bad[rows] = True
        self.inner = {}
        for name, kind in spec.values():
            if isinstance(kind, dict):
                self._inner(name, np.flatnonzero(self.there[name] & ~self.bad), self.at[name], self.size[name], kind)
            elif kind == "map":
                found = self.entries[name]
                own, a, size = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
                keep = np.argsort(own, kind="stable")
                keep = keep[~self.bad[own[keep]]]
                self.entries[name] = (own[keep], _Fields(data, a[keep], a[keep] + size[keep], _ENTRY))
                self.bad[own[keep][self.entries[name][1].bad]] = True

    def _take(self, name: str, kind, wire: int, own: np.ndarray, at: np.ndarray, end: np.ndarray) -> None:
        if kind != "map":
            self.bad[own[self.there[name][own]]] = True
        self.there[name][own] = True
        a = at[own] + 1
        if wire == 1:
            bad = a + 8 > end[own]
            good = a[~bad]
            self.number[name][own[~bad]] = np.ascontiguousarray(self.data[good[:, None] + np.arange(8)]).view("<u8").ravel()
            a = a + 8
        else:
            value, a, bad = _varints_at(self.data, a, end[own])
            if wire == 0:
                self.number[name][own] = value
            else:
                bad |= value > (end[own] - np.minimum(a, end[own])).astype(np.uint64)
                size = np.where(bad, 0, value.astype(np.int64))
                if kind == "map":
                    self.entries[name].append((own[~bad], a[~bad], size[~bad]))
                else:
                    self.at[name][own], self.size[name][own] = a, size
                a = a + size
        self.bad[own[bad]] = True
        at[own] = a

    def _inner(self, name: str, own: np.ndarray, at: np.ndarray, size: np.ndarray, spec: dict) -> None:
        n = len(self.bad)
        start, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
        start[own], end[own] = at[own], at[own] + size[own]
        self.inner[name] = _Fields(self.data, start, end, spec)
        self.bad |= self.inner[name].bad

    def texts(self) -> None:
        """Marks the rows as bad whose strings aren't UTF-8 beyond doubt, and those whose map has a key twice."""
        for name, kind in self.spec.values():
            if kind == "string":
                raw = _gather(self.data, self.at[name], self.size[name])
                try:
                    _binary(self.size[name], raw).cast(pa.string())
                except pa.ArrowInvalid:
                    self.bad[np.repeat(np.arange(len(self.bad)), self.size[name])[raw >= 0x80]] = True
            elif isinstance(kind, dict):
                self.inner[name].texts()
                self.bad |= self.inner[name].bad
            elif kind == "map":
                own, entry = self.entries[name]
                entry.texts()
                self.bad[own[entry.bad]] = True
                if len(own) and (own[1:] == own[:-1]).any():
                    key = _binary(entry.size["key"], _gather(self.data, entry.at["key"], entry.size["key"])).dictionary_encode().indices.to_numpy().astype(np.int64)
                    both = own * (int(key.max()) + 1) + key
                    _, first, count = np.unique(both, return_index=True, return_counts=True)
                    self.bad[own[first[count > 1]]] = True

    def array(self, kind: T.StructType, rows: np.ndarray, mask: np.ndarray | None = None) -> pa.StructArray:
        """The given rows, none of which is bad, as an array of Spark's type."""
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = dict(self.spec.values())
        out = [self._values(f.name, kinds[f.name], f.dataType, to_arrow_type(f.dataType), rows) for f in kind]
        return pa.StructArray.from_arrays(out, fields=list(to_arrow_type(kind)), mask=None if mask is None else pa.array(mask))

    def _values(self, name: str, kind, spark: T.DataType, arrow: pa.DataType, rows: np.ndarray) -> pa.Array:
        if isinstance(kind, dict):
            return self.inner[name].array(spark, rows, ~self.there[name][rows])
        if kind in ("string", "bytes"):
            return _binary(self.size[name][rows], _gather(self.data, self.at[name][rows], self.size[name][rows]), arrow)
        if kind == "map":
            own, entry = self.entries[name]
            size = np.bincount(own, minlength=len(self.bad))
            held = np.flatnonzero(np.isin(own, rows)) if len(rows) < len(self.bad) else np.arange(len(own))
            ends = np.concatenate([[0], np.cumsum(size[rows])]).astype(np.int32)
            key, value = (entry._values(x, "string", T.StringType(), pa.string(), held) for x in ("key", "value"))
            return pa.MapArray.from_arrays(pa.array(ends), key, value).cast(arrow)
        number = self.number[name][rows]
        if kind == "double":
            return pa.array(number.view("<f8"), arrow, from_pandas=False)
        if kind == "bool":
            return pa.array(number != 0)
        if pa.types.is_decimal(arrow):
            wide = np.zeros((len(number), 2), np.uint64)
            wide[:, 0] = number
            return pa.Array.from_buffers(arrow, len(number), [None, pa.py_buffer(wide)])
        narrow = {"int32": np.int32, "int64": np.int64, "uint32": np.uint32, "uint64": np.uint64}[kind]
        return pa.array(number.astype(narrow)).cast(arrow)


def _parsed(payloads: pa.Array, spec: dict, kind: T.StructType, field: str) -> pa.StructArray:
    """ok, error, message of each payload, one by one."""
    found, errors = [], []
    for data in payloads.to_pylist():
        try:
            found.append(parse(data or b"", spec))
            errors.append(None)
        except WireError as e:
            found.append(None)
            errors.append(str(e))
    return pa.StructArray.from_arrays([pa.array([e is None for e in errors], pa.bool_()), pa.array(errors, pa.string()), _column(found, kind)], names=["ok", "error", field])


def _scanned(payloads: pa.Array, spec: dict, kind: T.StructType, field: str) -> pa.StructArray:
    """The same by array operations, but for the rows that aren't plain."""
    payloads = payloads.cast(pa.binary())
    ends = np.frombuffer(payloads.buffers()[1], np.int32)[payloads.offset : payloads.offset + len(payloads) + 1].astype(np.int64)
    held = payloads.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    there = payloads.is_valid().to_numpy(zero_copy_only=False)
    fields = _Fields(data, ends[:-1], np.where(there, ends[1:], ends[:-1]), spec)
    fields.texts()
    good, bad = np.flatnonzero(~fields.bad), np.flatnonzero(fields.bad)
    out = pa.StructArray.from_arrays([pa.array(np.ones(len(good), bool)), pa.nulls(len(good), pa.string()), fields.array(kind, good)], names=["ok", "error", field])
    if len(bad):
        out = pa.concat_arrays([out, _parsed(payloads.take(pa.array(bad)), spec, kind, field)]).take(pa.array(np.argsort(np.concatenate([good, bad]))))
    return out


def _decoder(spec: dict, kind: T.StructType, field: str):
    by_columns = _by_columns(spec)

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for payloads in (p for batch in batches for p in _slices(batch)):
            yield (_scanned if by_columns and len(payloads) else _parsed)(payloads, spec, kind, field)

    return F.arrow_udf(decode, _result(kind, field))


def _pythons(array: pa.Array, spec: dict) -> list:
    """The array's rows as dictionaries of what the spec names, read field by field."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    kinds = dict(spec.values())
    names = [f.name for f in array.type if f.name in kinds]
    cols = [_pythons(array.field(n), kinds[n]) if isinstance(kinds[n], dict) else array.field(n).to_pylist() for n in names]
    rows = [dict(zip(names, values, strict=True)) for values in zip(*cols, strict=True)]
    return rows if not array.null_count else [r if ok else None for r, ok in zip(rows, array.is_valid().to_pylist(), strict=True)]


def _varints(value: np.ndarray, number: int, wire: int, there: np.ndarray) -> pa.Array:
    """A field's tag and a varint for each row that has the field, no bytes for the others."""
    v = value[there].astype(np.uint64)
    more = [v >= np.uint64(1 << 7 * k) for k in range(1, 10) if len(v) and int(v.max()) >> 7 * k]
    sizes = np.zeros(len(there), np.int64)
    sizes[there] = 2 + sum((m.astype(np.int64) for m in more), np.zeros(len(v), np.int64))
    at, data = (np.cumsum(sizes) - sizes)[there], np.zeros(int(sizes.sum()), np.uint8)
    data[at] = number << 3 | wire
    for k in range(len(more) + 1):
        own = more[k - 1] if k else np.ones(len(v), bool)
        byte = (v >> np.uint64(7 * k) & np.uint64(0x7F)).astype(np.uint8)
        if k < len(more):
            byte |= more[k].astype(np.uint8) << 7
        data[at[own] + 1 + k] = byte[own]
    return _binary(sizes, data)


def _sized(content: pa.Array, number: int, there: np.ndarray) -> list[pa.Array]:
    """A field's tag and length, and its content, where it is there."""
    size = pc.binary_length(content).fill_null(0).to_numpy(zero_copy_only=False)
    return [_varints(size, number, 2, there), content]


def _fixed(value: np.ndarray, number: int, there: np.ndarray) -> pa.Array:
    rows = np.zeros((int(there.sum()), 9), np.uint8)
    rows[:, 0], rows[:, 1:] = number << 3 | 1, np.ascontiguousarray(value[there]).astype("<f8").view(np.uint8).reshape(-1, 8)
    return _binary(there * 9, rows)


def _entries(array: pa.Array, number: int) -> pa.Array:
    """The entries of each row's map in order of their keys, as bytes."""
    ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    there = array.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(there, np.diff(ends), 0)
    own, at = np.repeat(np.arange(len(array)), sizes), _places(ends[:-1], sizes)
    keys, values = (x.take(pa.array(at)) for x in (array.keys, array.items))
    if len(own) and (own[1:] == own[:-1]).any():
        sorted_ = pc.sort_indices(pa.table({"own": own, "key": keys.cast(pa.binary())}), sort_keys=[("own", "ascending"), ("key", "ascending")])
        keys, values = keys.take(sorted_), values.take(sorted_)
    entry = _serialised(pa.StructArray.from_arrays([keys, values], names=["key", "value"]), _ENTRY)
    entry = pc.binary_join_element_wise(*_sized(entry, number, np.ones(len(entry), bool)), b"")
    places = np.frombuffer(entry.buffers()[1], np.int32)[entry.offset : entry.offset + len(entry) + 1] if len(entry) else np.zeros(1, np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return pa.Array.from_buffers(pa.binary(), len(array), [None, pa.py_buffer(np.ascontiguousarray(places[starts])), entry.buffers()[2] if len(entry) else pa.py_buffer(b"")])


def _serialised(array: pa.Array, spec: dict) -> pa.Array:
    """The bytes of each row's message, by array operations; those of rows that are null are to be ignored."""
    parts, names = [], {f.name for f in array.type}
    for number, (name, kind) in spec.items():
        if name not in names:
            continue
        own = array.field(name)
        there = own.is_valid().to_numpy(zero_copy_only=False)
        if isinstance(kind, dict):
            content = _serialised(own, kind)
            parts += _sized(pc.if_else(pa.array(there), content, pa.scalar(b"")), number, there)
        elif kind == "map":
            parts.append(_entries(own, number))
        elif kind in ("string", "bytes"):
            own = own.cast(pa.binary()).fill_null(b"")
            parts += _sized(own, number, pc.binary_length(own).to_numpy() > 0)
        elif kind == "double":
            value = own.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64)
            parts.append(_fixed(value, number, there & ((value != 0) | np.signbit(value))))
        else:
            if pa.types.is_decimal(own.type):
                if own.type.scale:
                    own = pc.trunc(own).cast(pa.decimal128(38, 0))
                low = np.frombuffer(own.buffers()[1], np.uint64)[2 * own.offset : 2 * (own.offset + len(own)) : 2] if len(own) else np.zeros(0, np.uint64)
            else:
                low = own.fill_null(False if pa.types.is_boolean(own.type) else 0).cast(pa.uint64() if pa.types.is_uint64(own.type) else pa.int64()).to_numpy(zero_copy_only=False).astype(np.uint64)
            parts.append(_varints(low, number, 0, there & (low != 0)))
    return pc.binary_join_element_wise(*parts, b"") if parts else pa.array([b""] * len(array), pa.binary())


def _encoder(spec: dict):
    by_columns = _by_columns(spec)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in (r for batch in batches for r in _slices(batch)):
            if by_columns and len(rows):
                rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
                yield pc.if_else(rows.is_valid(), _serialised(rows, spec), pa.scalar(None, pa.binary()))
            else:
                yield pa.array([None if r is None else serialise(r, spec) for r in _pythons(rows, spec)], pa.binary())

    return F.arrow_udf(encode, T.BinaryType())


def decode_event(payload: Column) -> Column:
    """struct(ok, error, event) from an event's bytes; null bytes are empty bytes, which decode to an event of defaults."""
    return _decoder(_EVENT, EVENT, "event")(payload)


def decode_enriched(payload: Column) -> Column:
    return _decoder(_ENRICHED, ENRICHED, "enriched")(payload)


def decode_dead_letter(payload: Column) -> Column:
    return _decoder(_DEAD, DEAD_LETTER, "dead_letter")(payload)


def encode_event(event: Column) -> Column:
    return _encoder(_EVENT)(event)


def encode_enriched(enriched: Column) -> Column:
    return _encoder(_ENRICHED)(enriched)


def encode_around(enriched: Column) -> Column:
    """An enriched record whose `event` is the event's own bytes."""
    return _encoder(_AROUND)(enriched)


def decode_batch(payload: Column) -> Column:
    """struct(ok, error, batch) of an export request's bytes: batch_id and events."""
    return _decoder(_BATCH, BATCH, "batch")(payload)


def encode_batch(batch: Column) -> Column:
    return _encoder(_BATCH)(batch)


def encode_dead_letter(letter: Column) -> Column:
    return _encoder(_DEAD)(letter)


def hex_dump(data: Column) -> Column:
    return F.lower(F.hex(F.coalesce(data, F.lit(b""))))
