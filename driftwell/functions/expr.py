"""Scalar building blocks as columns: identifiers, instants, byte limits, keys. All of them stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MAX_SECONDS, MIN_SECONDS

NUL = "\0"
_UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_uuid(x: Column | str) -> Column:
    """8-4-4-4-12 hexadecimal digits in any case; false for null. The length rules out a trailing line break."""
    return F.coalesce(_c(x).rlike(_UUID) & (F.octet_length(_c(x)) == 36), F.lit(False))


def valid_instant(x: Column | str) -> Column:
    """seconds within years 1 to 9999 and nanos within a second; false for null."""
    x = _c(x)
    return F.coalesce(x["seconds"].between(MIN_SECONDS, MAX_SECONDS) & x["nanos"].between(0, 999_999_999), F.lit(False))


def has_nul(x: Column | str) -> Column:
    return F.contains(_c(x), F.char(F.lit(0)))


def finite_nonneg(x: Column | str) -> Column:
    x = _c(x)
    return F.coalesce(~F.isnan(x) & (x >= 0) & (x < float("inf")), F.lit(False))


def partition_key(service: Column | str, route: Column | str) -> Column:
    return F.concat(_c(service), F.char(F.lit(0)), _c(route))


def hex_id(prefix: str, n: Column | str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.lower(F.hex(_c(n))), width, "0"))


def uuid_from_index(n: Column | str) -> Column:
    return hex_id("00000000-0000-4000-8000-", n, 12)


def index_of_uuid(event_id: Column | str) -> Column:
    """The number that uuid_from_index made an identifier of, in any case; null for others."""
    e = F.lower(_c(event_id))
    return F.when(e.rlike("^00000000-0000-4000-8000-[0-9a-f]{12}$"), F.conv(F.right(e, F.lit(12)), 16, 10).cast("long"))


def instant_from_micros(us: Column | str) -> Column:
    """Floor to whole seconds; nanos are never negative, before 1970 either."""
    us = _c(us)
    return F.struct(((us - F.pmod(us, F.lit(1_000_000))) / 1_000_000).cast("long").alias("seconds"), (F.pmod(us, F.lit(1_000_000)) * 1000).cast("int").alias("nanos"))


def instant_from_timestamp(ts: Column | str) -> Column:
    us = F.unix_micros(_c(ts).cast("timestamp"))
    return instant_from_micros(us)


def timestamp_from_instant(x: Column | str) -> Column:
    """Microseconds, floored."""
    x = _c(x)
    return F.timestamp_micros(x["seconds"] * 1_000_000 + F.floor(x["nanos"] / 1000))


def sorted_entries(m: Column | str) -> Column:
    return F.array_sort(F.map_entries(_c(m)))


def map_json(m: Column | str) -> Column:
    """A map as a JSON object with sorted keys, so that equal maps give equal text."""
    return F.coalesce(F.to_json(F.map_from_entries(sorted_entries(m))), F.lit("{}"))


def positive_integer(text: Column | str) -> Column:
    """ASCII digits without leading zeros, above zero and within 64 bits; null otherwise."""
    t = F.regexp_replace(_c(text), "^0+(?=[0-9])", "")
    ok = _c(text).rlike("^[0-9]+$") & (t != "0") & (F.length(t) <= 19)
    return F.when(ok, t.try_cast("bigint"))


def checked_product(a: Column | str, b: Column | str) -> Column:
    """Null on overflow of 64 bits."""
    return F.try_multiply(_c(a).cast("long"), _c(b).cast("long"))
