"""Schedules with a fixed step, as interval text for ``window`` and ``sequence``."""

from __future__ import annotations

import re
from datetime import timedelta

# Schedules that stand for one step.
STEPS = {
    "@hourly": "1 hour",
    "@daily": "1 day",
    "0 * * * *": "1 hour",
    "0 0 * * *": "1 day",
}

_EVERY_MINUTES = re.compile(r"\*/(\d+) \* \* \* \*")
_HOUR_DIVISORS = {n for n in range(1, 31) if 60 % n == 0}
_INTERVAL = re.compile(r"\d+ (second|minute|hour|day)s?")


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(step: str) -> int:
    """Length of an interval text, as :func:`step_of` returns it."""
    number, unit = step.split()
    return int(number) * _UNITS[unit.removesuffix("s")]


def step_of(schedule: str | timedelta) -> str:
    """Interval text of a timedelta, a preset, a minute pattern or an interval text.

    Steps that vary, such as months, and schedules without a step are errors.
    """
    if isinstance(schedule, timedelta):
        seconds = schedule.total_seconds()
        if seconds <= 0 or seconds != int(seconds):
            raise ValueError(f"not a whole number of seconds: {schedule}")
        return f"{int(seconds)} seconds"
    minutes = _EVERY_MINUTES.fullmatch(schedule)
    if minutes and int(minutes[1]) in _HOUR_DIVISORS:
        return f"{int(minutes[1])} minutes"
    if _INTERVAL.fullmatch(schedule):
        return schedule
    if schedule in STEPS:
        return STEPS[schedule]
    raise ValueError(f"no fixed step: {schedule}")
