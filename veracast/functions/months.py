"""Month arithmetic on dates that stand for a whole month (day 1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Anchor = Column | dt.date
# Accepted shapes of a month as text; a cast alone would take more.
_ISO, _SLASH = r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?\z", r"^[0-9]{2}/[0-9]{4}\z"


def as_column(anchor: Anchor) -> Column:
    return anchor if isinstance(anchor, Column) else F.lit(anchor)


def month_index(month: Column) -> Column:
    """Running month number, so that differences are whole months."""
    return F.year(month) * 12 + F.month(month)


def months_ago(month: Column, anchor: Anchor) -> Column:
    """0 for the anchor month, 1 for the month before; negative for the future."""
    return month_index(as_column(anchor)) - month_index(month)


def parse_month(text: Column) -> Column:
    """First day of the month from ``yyyy-MM-dd``, ``yyyy-MM`` or ``MM/yyyy``; else null.

    The shape is tested first; a cast then reads the value, many times faster than a pattern does.
    """
    t = F.trim(text)
    swapped = F.concat(F.substring(t, 4, 4), F.lit("-"), F.substring(t, 1, 2))
    month = F.when(t.rlike(_ISO), t.try_cast("date")).when(t.rlike(_SLASH), swapped.try_cast("date"))
    return F.trunc(month, "month")
