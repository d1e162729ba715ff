"""Bounded retries with exponential backoff, and crash points for tests."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import TypeVar

from ..config import RetryConfig
from .route import RETRYABLE_SQLSTATES

Out = TypeVar("Out")
AFTER_COMMIT = "after_db_commit_before_offset_commit"


class Retryable(Exception):
    """An error that may pass, with the database's state code if there is one."""

    def __init__(self, message: str, sqlstate: str | None = None):
        super().__init__(message)
        self.sqlstate = sqlstate


def is_retryable(error: BaseException) -> bool:
    code = getattr(error, "sqlstate", None)
    if code is None:
        return isinstance(error, (Retryable, ConnectionError, TimeoutError))
    return code.startswith(("08", "53")) or code in RETRYABLE_SQLSTATES


def with_retry(action: Callable[[], Out], config: RetryConfig = RetryConfig(), sleep: Callable[[float], None] = time.sleep, on_retry: Callable[[int], None] | None = None) -> Out:
    """At most max_attempts attempts; waits double up to their limit, and their sum stays within the budget."""
    wait, slept = config.initial_backoff_s, 0.0
    for attempt in range(1, config.max_attempts + 1):
        try:
            return action()
        except Exception as e:
            if not is_retryable(e) or attempt == config.max_attempts or slept + wait > config.budget_s:
                raise
            if on_retry:
                on_retry(attempt)
            sleep(wait)
            slept += wait
            wait = min(2 * wait, config.max_backoff_s)
    raise AssertionError("unreachable")


def jittered(bound: float, draw: Callable[[], float]) -> float:
    """Full jitter: a wait between nothing and the bound, by a draw from [0, 1)."""
    return bound * draw()


def backoff_bounds(initial_s: float, most_s: float) -> Iterator[float]:
    """Upper bounds of the client's waits: doubling up to the limit, and staying there."""
    bound = min(initial_s, most_s)
    while True:
        yield bound
        bound = min(2 * bound, most_s)


def parse_failpoint(value: str | None) -> bool:
    if value in (None, ""):
        return False
    if value == AFTER_COMMIT:
        return True
    raise ValueError(f"unknown failpoint {value!r}")
