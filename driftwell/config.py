"""Typed settings with the limits they have to keep."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, fields

I64_MAX = 2**63 - 1


@dataclass(frozen=True)
class DetectorConfig:
    alpha: float = 0.1
    warmup: int = 100
    threshold: float = 3.0
    floor_us: float = 1000.0

    def __post_init__(self):
        if not math.isfinite(self.alpha) or not 0 < self.alpha < 1:
            raise ValueError("alpha must be finite and strictly between 0 and 1")
        if self.warmup <= 0:
            raise ValueError("warm-up observations must be greater than zero")
        if not math.isfinite(self.threshold) or self.threshold <= 0:
            raise ValueError("threshold must be finite and greater than zero")
        if not math.isfinite(self.floor_us) or self.floor_us <= 0:
            raise ValueError("standard-deviation floor must be finite and greater than zero")


@dataclass(frozen=True)
class StateConfig:
    max_keys: int = 10_000
    ttl_ms: int = 15 * 60 * 1000

    def __post_init__(self):
        if self.max_keys <= 0:
            raise ValueError("maximum key count must be greater than zero")
        if self.ttl_ms <= 0:
            raise ValueError("inactivity limit must be greater than zero")


@dataclass(frozen=True)
class BatchConfig:
    max_records: int = 500
    max_wait_ms: int = 10
    #: The sink's batches have an upper bound of 500 records and 10 ms; the processor's have none.
    bounded: bool = False

    def __post_init__(self):
        if self.max_records <= 0 or self.bounded and self.max_records > 500:
            raise ValueError("batch max_records must be between 1 and 500" if self.bounded else "batch maximum record count must be greater than zero")
        if self.max_wait_ms <= 0 or self.bounded and self.max_wait_ms > 10:
            raise ValueError("batch max_wait must be between 1ns and 10ms" if self.bounded else "batch maximum wait must be greater than zero")


@dataclass(frozen=True)
class RetryConfig:
    max_attempts: int = 5
    initial_backoff_s: float = 0.05
    max_backoff_s: float = 5.0
    budget_s: float = 30.0

    def __post_init__(self):
        if self.max_attempts <= 0:
            raise ValueError("database retry max_attempts must be greater than zero")
        if not self.initial_backoff_s <= self.max_backoff_s <= 5.0:
            raise ValueError("database max_backoff must be between 50ms and 5s")
        if self.budget_s <= 0:
            raise ValueError("database retry backoff budget must be greater than zero")


@dataclass(frozen=True)
class ClientConfig:
    max_batch: int = 500
    flush_ms: int = 5
    queue_capacity: int = 65_536

    def __post_init__(self):
        if not 1 <= self.max_batch <= 500:
            raise ValueError("batch size must be between 1 and 500")
        if self.flush_ms <= 0 or self.queue_capacity <= 0:
            raise ValueError("flush interval and queue capacity must be greater than zero")


@dataclass(frozen=True)
class LoadConfig:
    events_per_second: int = 1000
    duration_seconds: int = 60
    route_count: int = 8
    random_seed: int = 42

    def __post_init__(self):
        for name in ("events_per_second", "duration_seconds", "route_count"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be greater than zero")
        if self.events_per_second * self.duration_seconds > 2**64 - 1:
            raise ValueError("configured event count overflows u64")

    @property
    def expected(self) -> int:
        return self.events_per_second * self.duration_seconds


def from_values(kind: type, values: Mapping[str, str], prefix: str = ""):
    """A settings object from text values (an environment, say): names in upper case behind the prefix, defaults elsewhere."""
    found = {}
    for f in fields(kind):
        if (text := values.get(prefix + f.name.upper())) is not None:
            try:
                found[f.name] = {"int": int, "float": float, "bool": lambda v: v == "true"}[str(f.type)](text)
            except ValueError as e:
                raise ValueError(f"{prefix + f.name.upper()} is not a valid {f.type}: {text!r}") from e
    return kind(**found)
