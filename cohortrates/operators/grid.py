"""The study grid: the dates at which prevalence is taken, or between which incidence is counted.

The grid itself is a short list on the driver. It enters a plan as SQL text, which costs one call to
build however long the grid is.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

INCIDENCE = "Incidence"
PREVALENCE = "Prevalence"


def step_date(day: date, years: int = 0, months: int = 0, days: int = 0) -> date:
    """``day`` plus a calendar step; a day the target month lacks becomes its last one."""
    month = day.year * 12 + day.month - 1 + years * 12 + months
    year, month = divmod(month, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last)) + timedelta(days=days)


#: Corrections of a guessed position that are written out.
CORRECTIONS = 3


@dataclass(frozen=True)
class StudyGrid:
    """Ascending dates, held on the driver; one entry per study period."""

    dates: tuple[date, ...]

    @classmethod
    def between(cls, start: date, end: date, years: int = 0, months: int = 12, days: int = 0) -> StudyGrid:
        """Every step from ``start`` up to the day after ``end``.

        Each date is the one before plus the step, so a clipped month end stays clipped.
        """
        if step_date(start, years, months, days) <= start:
            raise ValueError("the study step must move forward")
        dates = []
        current = start
        while current <= end + timedelta(days=1):
            dates.append(current)
            current = step_date(current, years, months, days)
        if not dates:
            raise ValueError("the study ends before it starts")
        return cls(tuple(dates))

    @property
    def offsets(self) -> list[int]:
        return [(d - self.dates[0]).days for d in self.dates]

    def day(self, dated: str) -> str:
        """SQL for the days from the start of the study to a date."""
        return f"datediff({dated}, date'{self.dates[0]}')"

    def offset_of(self, position: str) -> str:
        """SQL for the day of the grid date at ``position``; null outside the grid."""
        return f"get(array({','.join(map(str, self.offsets))}), {position})"

    def date_of(self, position: str) -> str:
        return f"date_add(date'{self.dates[0]}', {self.offset_of(position)})"

    def _halved(self, day: str, low: int, high: int) -> str:
        """SQL for the position of a day that lies from one grid date up to before another."""
        if high - low <= 1:
            return str(low)
        middle = (low + high) // 2
        return (
            f"CASE WHEN {day} < {self.offsets[middle]} THEN {self._halved(day, low, middle)} "
            f"ELSE {self._halved(day, middle, high)} END"
        )

    def position(self, day: str) -> str:
        """SQL for the position of the last grid date not after ``day``: -1 before the first.

        Grid dates are nearly evenly spaced, so a proportional guess is corrected by comparing it
        with its neighbours. The number of corrections is the largest error of the guess, found
        here on the driver, so the cost per row does not grow with the length of the grid. Each
        correction repeats the guess three times in the SQL, so a grid that would need more than
        ``CORRECTIONS`` is searched by halves.
        """
        offsets = self.offsets
        last = len(offsets) - 1
        if last == 0:
            return f"CASE WHEN {day} < 0 THEN -1 WHEN {day} >= 0 THEN 0 END"
        span = offsets[-1]
        errors = [
            abs(d * last // span - at)
            for at in range(last)
            for d in (offsets[at], offsets[at + 1] - 1)
        ]
        if max(errors) > CORRECTIONS:
            return f"CASE WHEN {day} < 0 THEN -1 WHEN {day} >= {span} THEN {last} ELSE {self._halved(day, 0, last)} END"
        guess = f"int({day} * {last}L div {span}L)"
        for _ in range(max(errors)):
            guess = (
                f"({guess} + CASE WHEN {day} < {self.offset_of(guess)} THEN -1 "
                f"WHEN {day} >= {self.offset_of(f'{guess} + 1')} THEN 1 ELSE 0 END)"
            )
        return f"CASE WHEN {day} < 0 THEN -1 WHEN {day} >= {span} THEN {last} ELSE {guess} END"


@dataclass(frozen=True)
class Study:
    """One measure on one grid."""

    measure: str
    grid: StudyGrid

    def __post_init__(self):
        if self.measure not in (INCIDENCE, PREVALENCE):
            raise ValueError(f"unknown measure {self.measure}")
        if self.measure == INCIDENCE and len(self.grid.dates) < 2:
            raise ValueError("an incidence study needs one complete period")

    @property
    def n_periods(self) -> int:
        return len(self.grid.dates) - (self.measure == INCIDENCE)
