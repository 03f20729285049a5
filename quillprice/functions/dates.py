"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def load_stamp(ts: str | None = None) -> Column:
    """{fn NOW()}: a fixed wall-clock stamp when given, else the current local time."""
    if ts is None:
        return F.localtimestamp()
    return F.expr(f"TIMESTAMP_NTZ '{ts}'")


def yyyymmdd_int(c: Column) -> Column:
    """CAST(CONVERT(varchar(8), d, 112) AS INT)."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def parse_us_date(c: Column) -> Column:
    """CONVERT(date, s, 101): month/day/year, padded or not."""
    return F.to_date(c, "M/d/yyyy")


def day_of(c: Column) -> Column:
    """CONVERT(DATE, ts)."""
    return F.to_date(c)
