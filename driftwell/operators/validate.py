"""Ordered validation: the first rule that fails names the category and the reason.

Each rule set is one CASE expression, so a row is judged in one pass of generated code and later rules are not evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import finite_nonneg, has_nul, is_uuid, partition_key, sorted_entries, valid_instant
from ..schemas import MAX_ATTRIBUTES, MAX_BATCH_EVENTS, MAX_KEY_BYTES, MAX_ROUTE_BYTES, MAX_VALUE_BYTES


def first_failure(rules: list[tuple[Column, str, str]]) -> Column:
    """struct(category, reason) of the first condition that holds, null if none does."""
    out = None
    for bad, category, reason in rules:
        verdict = F.struct(F.lit(category).alias("category"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"))
        out = F.when(bad, verdict) if out is None else out.when(bad, verdict)
    return out


def _too_many(attributes: Column) -> Column:
    return F.coalesce(F.size(attributes) > MAX_ATTRIBUTES, F.lit(False))


def _oversize(attributes: Column) -> Column:
    return F.coalesce(F.exists(F.map_entries(attributes), lambda e: (F.octet_length(e["key"]) > MAX_KEY_BYTES) | (F.octet_length(e["value"]) > MAX_VALUE_BYTES)), F.lit(False))


def _empty(x: Column) -> Column:
    return F.coalesce(x, F.lit("")) == ""


# The categories, messages and limits in the three rule sets below are fixed values: clients, dashboards and stored dead letters compare them.


def raw_failure(event: Column, key: Column) -> Column:
    """The processor's rules for a decoded event and its record key (binary or string)."""
    service, route, attributes = event["service_name"], event["route"], event["attributes"]
    return first_failure(
        [
            (~is_uuid(event["event_id"]), "event_id", "event_id must be a UUID"),
            (~valid_instant(event["event_time"]), "event_time", "event_time is missing or invalid"),
            (_empty(service), "service_name", "service_name must not be empty"),
            (has_nul(service), "service_name", "service_name must not contain NUL"),
            (_empty(route), "route", "route must not be empty"),
            (has_nul(route), "route", "route must not contain NUL"),
            (F.octet_length(route) > MAX_ROUTE_BYTES, "route", "route exceeds 256 bytes"),
            (_too_many(attributes), "attributes", "attributes exceed 16 entries"),
            (_oversize(attributes), "attributes", "attribute key or value exceeds its byte limit"),
            (~key.cast("binary").eqNullSafe(partition_key(service, route).cast("binary")), "key", "source key does not match service_name and route"),
        ]
    )


def enriched_failure(enriched: Column) -> Column:
    """The sink's rules for a decoded enriched record. Timestamps are judged before the identifier."""
    event = enriched["event"]
    service, route, attributes = event["service_name"], event["route"], event["attributes"]
    nul_entry = F.coalesce(F.exists(F.map_entries(attributes), lambda e: has_nul(e["key"]) | has_nul(e["value"])), F.lit(False))
    return first_failure(
        [
            (event.isNull(), "validation", "enriched event is missing"),
            (~valid_instant(event["event_time"]), "timestamp", "event_time is missing or outside the supported UTC range"),
            (~valid_instant(enriched["processed_at"]), "timestamp", "processed_at is missing or outside the supported UTC range"),
            (~is_uuid(event["event_id"]), "validation", "event_id must be a canonical UUID"),
            (_empty(service) | has_nul(service), "validation", "service_name must be nonempty and contain no NUL bytes"),
            (_empty(route) | has_nul(route), "validation", "route must be nonempty and contain no NUL bytes"),
            (F.octet_length(route) > MAX_ROUTE_BYTES, "validation", "route exceeds 256 UTF-8 bytes"),
            (F.coalesce(has_nul(event["trace_id"]), F.lit(False)), "validation", "trace_id must not contain NUL bytes"),
            (_too_many(attributes), "validation", "attributes exceed 16 entries"),
            (nul_entry, "validation", "attribute keys and values must not contain NUL bytes"),
            (_oversize(attributes), "validation", "attribute key or value exceeds the processor contract byte limit"),
            (event["latency_us"] > F.lit(2**63 - 1).cast("decimal(20,0)"), "validation", "latency_us exceeds PostgreSQL BIGINT range"),
            (event["status_code"] > 2**31 - 1, "validation", "status_code exceeds PostgreSQL INTEGER range"),
            (~finite_nonneg(enriched["ewma_mean_us"]) | ~finite_nonneg(enriched["ewma_stddev_us"]) | ~finite_nonneg(enriched["anomaly_score"]), "validation", "detector values must be finite and nonnegative"),
        ]
    )


def event_failure(event: Column, index: Column, now: Column) -> Column:
    """The gateway's reason for rejecting a batch because of its event number `index`, null if the event is fine. now: microseconds."""
    at = F.concat(F.lit("events["), index.cast("string"), F.lit("]"))
    say = lambda text: F.concat(at, F.lit(text))
    service, route, attributes = event["service_name"], event["route"], event["attributes"]
    micros = event["event_time"]["seconds"] * 1_000_000
    nanos = event["event_time"]["nanos"]
    # exact limits are valid: compare whole microseconds, then the nanoseconds below
    us = micros + F.floor(nanos / 1000)
    older = us < now - 24 * 3600 * 1_000_000
    newer = (us > now + 300 * 1_000_000) | ((us == now + 300 * 1_000_000) & (nanos % 1000 > 0))
    bad = F.filter(sorted_entries(attributes), lambda e: (F.octet_length(e["key"]) > MAX_KEY_BYTES) | (F.octet_length(e["value"]) > MAX_VALUE_BYTES))
    first = F.try_element_at(bad, F.lit(1))
    quoted = first["key"]
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        quoted = F.replace(quoted, F.lit(plain), F.lit(escaped))
    quoted = F.concat(F.lit('"'), quoted, F.lit('"'))
    oversize = F.when(F.octet_length(first["key"]) > MAX_KEY_BYTES, F.concat(at, F.lit(".attributes["), quoted, F.lit(f"] key must be at most {MAX_KEY_BYTES} bytes"))).otherwise(F.concat(at, F.lit(".attributes value for key "), quoted, F.lit(f" must be at most {MAX_VALUE_BYTES} bytes")))
    return (
        F.when(event.isNull(), say(" is required"))
        .when(~is_uuid(event["event_id"]), say(".event_id must be a valid UUID"))
        .when(event["event_time"].isNull(), say(".event_time is required"))
        .when(~valid_instant(event["event_time"]), say(".event_time is invalid"))
        .when(older, say(".event_time must not be older than 24 hours"))
        .when(newer, say(".event_time must not be more than 5 minutes in the future"))
        .when(_empty(service), say(".service_name is required"))
        .when(has_nul(service), say(".service_name must not contain NUL"))
        .when(_empty(route), say(".route is required"))
        .when(has_nul(route), say(".route must not contain NUL"))
        .when(F.octet_length(route) > MAX_ROUTE_BYTES, say(f".route must be at most {MAX_ROUTE_BYTES} bytes"))
        .when(_too_many(attributes), say(f".attributes must contain at most {MAX_ATTRIBUTES} attributes"))
        .when(first.isNotNull(), oversize)
    )


def batch_verdicts(requests: DataFrame, now_us: Column, keep: list[str] | None = None) -> DataFrame:
    """batch_id, n_events, reason (null: accepted), and the columns in keep, for requests (batch_id, events array; a null row stands for no request).

    A batch is one row, so all its events are judged in one expression: no shuffle.
    """
    events = F.col("events")
    reasons = F.filter(F.transform(events, lambda e, i: event_failure(e, i, now_us)), lambda r: r.isNotNull())
    n = F.coalesce(F.size(events), F.lit(0))
    reason = (
        F.when(F.col("batch_id").isNull() & events.isNull(), "request is required")
        .when(~is_uuid("batch_id"), "batch_id must be a valid UUID")
        .when(n <= 0, "events must contain at least 1 event")
        .when(n > MAX_BATCH_EVENTS, f"events must contain at most {MAX_BATCH_EVENTS} events")
        .otherwise(F.try_element_at(reasons, F.lit(1)))
    )
    return requests.select(*(keep or []), "batch_id", F.greatest(n, F.lit(0)).cast("long").alias("n_events"), reason.alias("reason"))
