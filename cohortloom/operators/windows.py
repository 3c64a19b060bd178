"""Sliding day windows: which days are read, and where they land after the shift."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.sources.schemas import HORIZON


@dataclass(frozen=True)
class DayWindow:
    """Registrants of [start, end], log rows of [start, end + extra_days], all days shifted.

    ``weeks_ahead`` is how far ahead the forecast looks; 0 means the final
    features, read up to the horizon. ``start=None`` with ``pinned=True`` is the
    plain snapshot "everything up to ``end``", without a shift.
    """

    start: int | None = 1
    end: int = 23
    weeks_ahead: int = 1
    pinned: bool = False

    @classmethod
    def snapshot(cls, day: int) -> "DayWindow":
        return cls(start=None, end=day, weeks_ahead=0, pinned=True)

    @property
    def shift(self) -> int:
        if self.pinned or self.weeks_ahead == 0:
            return 0
        return HORIZON + 7 - 7 * self.weeks_ahead - self.end

    @property
    def extra_days(self) -> int:
        if self.pinned:
            return 0
        if self.weeks_ahead == 0:
            return HORIZON - self.end
        return 7 * (self.weeks_ahead - 1)

    @property
    def last_log_day(self) -> int:
        return self.end + self.extra_days

    @property
    def closing_day(self) -> int:
        """Last log day after the shift: the horizon for every unpinned window."""
        return self.last_log_day + self.shift

    def reads(self, day: str) -> str:
        """SQL condition on a day column: rows of the logs that belong to the window."""
        until = f"{day} <= {self.last_log_day}"
        return until if self.start is None else f"{day} >= {self.start} AND {until}"

    @property
    def name(self) -> str:
        return f"{self.start or 0}-{self.end}+{self.weeks_ahead}"


def _day_rows(windows: Sequence[DayWindow], whole: bool) -> list[tuple[str, int, int, int]]:
    rows = []
    for w in windows:
        last = w.last_log_day if whole else w.end
        for day in range(w.start if w.start is not None else 1, last + 1):
            rows.append((w.name, day, day + w.shift, w.closing_day))
    return rows


def in_window(df: DataFrame, day: str, window: DayWindow, whole: bool = True) -> DataFrame:
    """Rows of one window with the day shifted; a plain filter, so it reaches the scan.

    ``whole=False`` stops at ``end`` (registrations), else the extra days are read too.
    """
    last = window.last_log_day if whole else window.end
    kept = F.col(day) <= last
    if window.start is not None:
        kept = kept & (F.col(day) >= window.start)
    return df.filter(kept).withColumn(day, F.col(day) + F.lit(window.shift))


def in_windows(
    spark: SparkSession,
    df: DataFrame,
    day: str,
    windows: Sequence[DayWindow],
    whole: bool = True,
) -> DataFrame:
    """Rows of many windows at once, tagged with ``window``.

    One equality join with a table of (window, day) pairs, whose size is the number
    of windows times the days of one window, whatever the data.
    """
    days = _day_rows(windows, whole)
    table = spark.createDataFrame(days, f"window string, {day} long, _shifted long, _closing long")
    first, last = min(r[1] for r in days), max(r[1] for r in days)
    return (
        df.filter(F.col(day).between(first, last))
        .join(F.broadcast(table), day)
        .drop(day, "_closing")
        .withColumnRenamed("_shifted", day)
    )
