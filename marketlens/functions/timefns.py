"""Calendar and elapsed-time helpers on TIMESTAMP_NTZ columns.

PostgreSQL spellings mapped to Spark built-ins:
``DATE_TRUNC('month', ts)::DATE`` -> ``month_of``; ``EXTRACT(ISODOW)`` ->
``iso_dow``; ``TO_CHAR(ts, 'FMDay')`` -> ``day_name``; ``date - date`` ->
``calendar_days``; ``EXTRACT(EPOCH FROM t2 - t1)`` -> ``elapsed_micros``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.functions.money import _c

SECONDS = {"hour": 3600, "day": 86400}


def month_of(ts) -> Column:
    return F.date_trunc("month", _c(ts)).cast("date")


def year_of(ts) -> Column:
    return F.year(_c(ts)).cast("long")


def month_num(ts) -> Column:
    return F.month(_c(ts)).cast("long")


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("long")


def iso_dow(ts) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(ts)) + 1).cast("long")


def day_name(ts) -> Column:
    """Full English day name ('Monday')."""
    return F.date_format(_c(ts), "EEEE")


def calendar_days(start, end) -> Column:
    """Whole calendar days between the dates of two timestamps (end - start)."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date")).cast("long")


def elapsed_micros(start, end) -> Column:
    """Exact elapsed time end - start in microseconds (NULL if either is NULL)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def avg_elapsed(start, end, unit: str = "day") -> Column:
    """``ROUND(AVG(EXTRACT(EPOCH FROM end - start) / unit_seconds), 2)`` as an aggregate.

    Sums whole microseconds, then rounds total / (count x unit) half away from
    zero with integer arithmetic, so nothing is rounded twice: with
    n = 100 x |total| and d = count x unit, the hundredths are (2n + d) div 2d.
    Sums up to 10^33 microseconds (10^19 years) fit.
    """
    us = elapsed_micros(start, end)
    total = F.sum(us.cast("decimal(25,0)")).cast("decimal(33,0)")
    unit_us = F.lit(SECONDS[unit] * 1_000_000).cast("decimal(12,0)")
    d = (F.count(us).cast("decimal(14,0)") * unit_us).cast("decimal(27,0)")
    doubled = (F.abs(total) * F.lit(200).cast("decimal(3,0)") + d).cast("decimal(38,0)")
    hundredths = F.call_function("div", doubled, F.nullif(d * F.lit(2).cast("decimal(1,0)"), F.lit(0).cast("decimal(1,0)")))
    return hundredths.cast("decimal(20,0)") * F.when(total < 0, F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)") * F.lit("0.01").cast("decimal(3,2)")
