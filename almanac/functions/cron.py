"""Calendar schedules of five fields: minute, hour, day of the month, month, day of the week."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

# Presets and names.
PRESETS = {
    "@hourly": "0 * * * *", "@daily": "0 0 * * *", "@midnight": "0 0 * * *", "@weekly": "0 0 * * 0",
    "@monthly": "0 0 1 * *", "@yearly": "0 0 1 1 *", "@annually": "0 0 1 1 *",
}
ONCE = "@once"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
WEEKDAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")

# Days after which a schedule that has had no slot never has one: leap days meet each weekday within 40 years.
NEVER = 41 * 366


@dataclass(frozen=True)
class Cron:
    """The minutes of a day and the days on which they are slots.  Weekdays count from Sunday, 0."""

    minutes: tuple[int, ...]
    days: frozenset[int]
    months: frozenset[int]
    weekdays: frozenset[int]
    any_day: bool
    any_weekday: bool

    def has_day(self, day: date) -> bool:
        """If both kinds of days are restricted, either will do."""
        in_month, in_week = day.day in self.days, day.isoweekday() % 7 in self.weekdays
        right = in_month and in_week if self.any_day or self.any_weekday else in_month or in_week
        return right and day.month in self.months

    def last_slot(self, at: datetime) -> datetime | None:
        """The latest slot up to ``at``; None if there is none."""
        minute = at.hour * 60 + at.minute
        for back in range(NEVER):
            if back > at.date().toordinal() - 1:
                return None
            day = at.date() - timedelta(days=back)
            if self.has_day(day):
                fitting = [m for m in self.minutes if back or m <= minute]
                if fitting:
                    return datetime(day.year, day.month, day.day) + timedelta(minutes=fitting[-1])
        return None


def _field(text: str, least: int, most: int, names: tuple[str, ...] = (), first: int = 0) -> frozenset[int]:
    """Values of a field: lists of values, ranges and steps, with names for numbers."""

    def value(word: str) -> int:
        if word.lower() in names:
            return first + names.index(word.lower())
        if not word.isdigit() or not least <= int(word) <= most:
            raise ValueError(f"not from {least} to {most}: {word!r}")
        return int(word)

    found: set[int] = set()
    for part in text.split(","):
        span, _, step = part.partition("/")
        if step and (not step.isdigit() or int(step) == 0):
            raise ValueError(f"not a step: {part!r}")
        low, dash, high = span.partition("-")
        if span == "*":
            ends = least, most
        elif dash:
            ends = value(low), value(high)
        else:
            ends = value(low), most if step else value(low)
        if ends[0] > ends[1]:
            raise ValueError(f"a range that ends before it begins: {part!r}")
        found |= set(range(ends[0], ends[1] + 1, int(step or 1)))
    return frozenset(found)


def parse_cron(schedule: str) -> Cron:
    """Presets but ``@once`` and expressions of five fields; anything else is an error."""
    fields = PRESETS.get(schedule, schedule).split()
    if len(fields) != 5:
        raise ValueError(f"not five fields: {schedule!r}")
    minute, hour, day, month, weekday = fields
    minutes = tuple(sorted(60 * h + m for h in _field(hour, 0, 23) for m in _field(minute, 0, 59)))
    weekdays = frozenset(d % 7 for d in _field(weekday, 0, 7, WEEKDAYS))
    return Cron(
        minutes, _field(day, 1, 31), _field(month, 1, 12, MONTHS, 1), weekdays, day.startswith("*"), weekday.startswith("*")
    )
