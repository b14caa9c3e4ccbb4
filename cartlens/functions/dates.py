"""Date parsing and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_FIRST = "d/M/yyyy"

# Display names, Sunday = 1 as Spark's dayofweek counts.
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def parse_day_first(c, fmt: str = DAY_FIRST) -> Column:
    """Text date to ``timestamp_ntz``; unparsable or impossible dates give null
    (plain ``to_timestamp`` raises under ANSI mode)."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def _lookup(names, c) -> Column:
    pairs = []
    for i, name in enumerate(names, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def weekday_name(c) -> Column:
    return _lookup(WEEKDAY_NAMES, c)


def month_name(c) -> Column:
    return _lookup(MONTH_NAMES, c)
