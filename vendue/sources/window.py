"""Run time of a job and the days and hours it looks at."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunWindow:
    """Run time of an hourly or daily job. Partition columns are ``dt`` (date) and ``hh`` (hour)."""

    as_of: datetime

    @classmethod
    def parse(cls, text: str | None = None, now: datetime | None = None) -> RunWindow:
        """``yy-MM-dd-HH`` or ``yy-MM-dd``; without text the hour before ``now``."""
        if text:
            pattern = "%y-%m-%d-%H" if text.count("-") == 3 else "%y-%m-%d"
            return cls(datetime.strptime(text, pattern))
        moment = (now or datetime.now()) - timedelta(hours=1)
        return cls(moment.replace(minute=0, second=0, microsecond=0))

    @property
    def day(self) -> date:
        return self.as_of.date()

    def before(self, n: int) -> date:
        return self.day - timedelta(days=n)

    def last_days(self, n: int) -> Column:
        """Partitions of the ``n`` days before the run day."""
        return F.col("dt").between(F.lit(self.before(n)), F.lit(self.before(1)))

    def listed_days(self, offsets: Sequence[int]) -> Column:
        """Partitions of some days before the run day."""
        return F.col("dt").isin([self.before(n) for n in offsets])

    def last_hours(self, n: int) -> Column:
        """Partitions of the run hour and the ``n - 1`` hours before it."""
        spans: dict[date, list[int]] = {}
        for back in range(n):
            at = self.as_of - timedelta(hours=back)
            spans.setdefault(at.date(), []).append(at.hour)
        cond = F.lit(False)
        for day, hours in spans.items():
            whole = len(hours) == 24
            here = F.col("dt") == F.lit(day)
            cond = cond | (here if whole else here & F.col("hh").between(min(hours), max(hours)))
        return cond
