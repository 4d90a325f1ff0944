"""Column expressions for time stamps held as text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the format of the extract time; up to nine digits of a second may follow.
EXTRACT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]"


def parse_ts(c: Column | str, fmt: str = EXTRACT_FORMAT) -> Column:
    """Text to TIMESTAMP; text of another shape becomes NULL instead of failing the job."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(fmt))


def newest(c: str) -> list[Column]:
    """What a pick of the newest row orders by: the time, then its text, so that a bad text never comes first."""
    return [parse_ts(c), F.col(c)]


def default_today(c: Column | str, today: dt.date | None = None) -> Column:
    """The date text, or today's date where it is NULL. ``today`` pins the clock."""
    col = F.col(c) if isinstance(c, str) else c
    clock = F.current_date() if today is None else F.lit(today)
    return F.coalesce(col, clock.cast("string"))
