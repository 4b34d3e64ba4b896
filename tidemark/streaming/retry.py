"""Retry of a failed sink call. Only deadlocks are worth another attempt."""

from __future__ import annotations

import time
from collections.abc import Callable

from tidemark.operators.rejects import DEADLOCK_EXHAUSTED, SINK_ERROR

# How the target databases report a deadlock.
DEADLOCK_TEXTS = {
    "mysql": ("Error 1213", "Deadlock found"),
    "postgres": ("40P01", "deadlock detected"),
}
# Attempts after the first, and the first pause, which doubles each time.
MAX_RETRIES = 3
BACKOFF_MS = 1000


class SinkFailure(Exception):
    """A batch the sink would not take; ``reason`` is its reject reason, ``named`` whether the sink gave it."""

    def __init__(self, reason: str, cause: BaseException, deadlocks: int, named: bool = True) -> None:
        super().__init__(f"{reason}: {cause}")
        self.reason = reason
        self.deadlocks = deadlocks
        self.named = named


def is_deadlock(error: BaseException, dialect: str) -> bool:
    return any(text in str(error) for text in DEADLOCK_TEXTS[dialect])


def with_retry(
    call: Callable[[], None],
    dialect: str,
    max_retries: int = MAX_RETRIES,
    backoff_ms: int = BACKOFF_MS,
    pause: Callable[[float], None] = time.sleep,
) -> int:
    """Run the call; returns how many deadlocks it took, raises SinkFailure if it failed."""
    deadlocks = 0
    while True:
        try:
            call()
            return deadlocks
        except Exception as error:
            if not is_deadlock(error, dialect):
                raise SinkFailure(SINK_ERROR, error, deadlocks) from error
            deadlocks += 1
            if deadlocks > max_retries:
                raise SinkFailure(DEADLOCK_EXHAUSTED, error, deadlocks) from error
            pause(backoff_ms * 2 ** (deadlocks - 1) / 1000)
