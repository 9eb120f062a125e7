"""Pace and retry of provider calls inside tasks.

Retries happen here, not by Spark tasks: a task that runs again would pay for every call again.
"""

from __future__ import annotations

import random
import re
import threading
import time
from collections import deque
from collections.abc import Callable
from dataclasses import replace

from turnloom.inference.provider import Outcome, Provider, Request, Result
from turnloom.logs import get_logger

# Budget, back-off and retry limits.
CALLS_PER_MINUTE = 150
RATE_LIMIT_FLOOR_S, RATE_LIMIT_TRIES = 60.0, 8
TRANSIENT_CAP_S, TRANSIENT_TRIES = 60.0, 5
CALL_TIMEOUT_S = 180.0
# Reasons for which a service ends an answer.
BLOCKED_ENDINGS, CUT_ENDINGS = ("SAFETY", "PROHIBITED_CONTENT", "RECITATION"), ("MAX_TOKENS",)
_DELAY = re.compile(r"retry(?:Delay)?[^0-9]{0,20}(\d+(?:\.\d+)?)\s*s", re.I)
log = get_logger(__name__)


def retry_delay(message: str) -> float | None:
    """Seconds a server asked to wait, read from its message."""
    m = _DELAY.search(message or "")
    return float(m[1]) if m else None


def is_rate_limit(message: str) -> bool:
    low = (message or "").lower()
    return "429" in low or "resource_exhausted" in low or "rate limit" in low


class Limiter:
    """At most ``limit`` calls in any 60 seconds; a cluster-wide budget is divided by the number of tasks. Below one
    call a minute the span is longer instead."""

    def __init__(self, limit: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.limit, self.clock, self.sleep, self.past = max(1, int(limit)), clock, sleep, deque()
        self.span = 60.0 if limit >= 1 else 60.0 / limit

    def wait(self) -> None:
        while True:
            now = self.clock()
            while self.past and now - self.past[0] >= self.span:
                self.past.popleft()
            if len(self.past) < self.limit:
                self.past.append(now)
                return
            self.sleep(max(0.01, self.span - (now - self.past[0])))


def validate(r: Result) -> Result:
    """An answer by the reasons given: refused prompts and answers and empty texts are blocked, cut ones truncated."""
    ended = (r.finish or "").upper()
    if r.block or any(x in ended for x in BLOCKED_ENDINGS):
        return replace(r, text=None, outcome=Outcome.BLOCKED)
    if any(x in ended for x in CUT_ENDINGS):
        return replace(r, text=None, outcome=Outcome.TRUNCATED)
    if r.outcome is Outcome.OK and not (r.text or "").strip():
        return replace(r, text=None, outcome=Outcome.BLOCKED)
    return r


def within(seconds: float | None, ask: Callable[[], Result]) -> Result:
    """``ask()``, given up after ``seconds``: the call is left to its thread and counts as an error."""
    if not seconds:
        return ask()
    got: list = []

    def run() -> None:
        try:
            got.append((ask(), None))
        except BaseException as e:  # noqa: BLE001 - handed to the caller
            got.append((None, e))

    t = threading.Thread(target=run, daemon=True)
    t.start()
    t.join(seconds)
    if not got:
        raise TimeoutError(f"no answer in {seconds:g} s")
    answer, error = got[0]
    if error is not None:
        raise error
    return answer


def call(
    provider: Provider, request: Request, limiter: Limiter, sleep: Callable[[float], None] = time.sleep, rand: Callable[[], float] = random.random, timeout: float | None = CALL_TIMEOUT_S
) -> Result:
    """One answered request. Rate limits wait a minute or what the server asks, plus up to a minute; other errors and
    calls over ``timeout`` back off by powers of two; blocked and truncated answers are final."""
    limited = failed = 0
    while True:
        limiter.wait()
        try:
            r, why = validate(within(timeout, lambda: provider.answer(request))), ""
        except Exception as e:  # noqa: BLE001 - any failure of a provider is an outcome
            late = isinstance(e, TimeoutError)
            why = str(e)
            r = Result(None, Outcome.RATE_LIMITED if not late and is_rate_limit(why) else Outcome.ERROR, retry_after=retry_delay(why))
        if r.outcome is Outcome.RATE_LIMITED:
            limited += 1
            if limited >= RATE_LIMIT_TRIES:
                return r
            pause = max(RATE_LIMIT_FLOOR_S, r.retry_after or 0.0) + rand() * 60
        elif r.outcome is Outcome.ERROR:
            failed += 1
            if failed >= TRANSIENT_TRIES:
                return r
            pause = min(2.0**failed, TRANSIENT_CAP_S) + rand()
        else:
            return r
        log.info("%s: %s %s; again in %.1f s", request.stage, r.outcome.value, why, pause)
        sleep(pause)
