"""Date parsing and arithmetic. No function reads the clock: ``as_of`` is always an argument.

Texts are wall-clock times and become ``timestamp_ntz`` without passing through the time zone
of the session, so no hour is lost or shifted where that zone changes its clocks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"
_VISIT_TS = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_CALL_TS = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{1,2}:\d{1,2})$"


def parse_day(c: Column) -> Column:
    """``yyyy-MM-dd``; anything else is null."""
    return F.when(c.rlike(_DAY), c.try_cast("date"))


def parse_visit_ts(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; anything else is null."""
    return F.when(c.rlike(_VISIT_TS), c.try_cast("timestamp_ntz"))


def parse_call_ts(c: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss``; anything else is null."""
    return F.when(c.rlike(_CALL_TS), F.regexp_replace(c, _CALL_TS, "$3-$2-$1 $4").try_cast("timestamp_ntz"))


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyyMM")


def age_days(as_of: Column, last: Column) -> Column:
    return F.datediff(as_of, last)
