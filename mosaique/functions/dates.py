"""Periods are days since 1970-01-01."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime.date(1970, 1, 1)


def date_to_period(d: Column) -> Column:
    return F.datediff(d.cast("date"), F.lit(EPOCH))


def period_to_date(p: Column) -> Column:
    return F.date_add(F.lit(EPOCH), p.cast("int"))


def is_date(text: Column) -> Column:
    """Strictly YYYY-MM-DD, a real date, not before the epoch."""
    d = F.try_to_date(text, "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.expr("null")
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & (d >= F.lit(EPOCH)), F.lit(False))


def period_of(date: str) -> int:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", date):
        raise ValueError(f"not a date: {date}")
    n = (datetime.date.fromisoformat(date) - EPOCH).days
    if n < 0:
        raise ValueError(f"before the epoch: {date}")
    return n


def date_of(period: int) -> str:
    return (EPOCH + datetime.timedelta(days=period)).isoformat()
