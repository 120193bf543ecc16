"""Calendar bucket labels and the resample rule of the time-series view.

Labels follow pandas ``resample`` with right-closed, right-labelled bins:
D = the day, W = the Sunday ending the week, M = last day of the month,
Q = last day of the quarter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

RULES = ("D", "W", "M", "Q")

# Fixed values of the model: span thresholds (days) that pick the rule.
QUARTER_ABOVE_DAYS = 730
MONTH_ABOVE_DAYS = 180
WEEK_ABOVE_DAYS = 60


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def resample_rule_for_span(days: int) -> str:
    if days > QUARTER_ABOVE_DAYS:
        return "Q"
    if days > MONTH_ABOVE_DAYS:
        return "M"
    if days > WEEK_ABOVE_DAYS:
        return "W"
    return "D"


def resample_rule(start, end) -> str | Column:
    """Rule for a date range: a plain string for Python dates, a Column for columns."""
    if isinstance(start, dt.date) and isinstance(end, dt.date):
        return resample_rule_for_span((end - start).days)
    days = F.datediff(_col(end), _col(start))
    return (F.when(days > QUARTER_ABOVE_DAYS, "Q").when(days > MONTH_ABOVE_DAYS, "M")
            .when(days > WEEK_ABOVE_DAYS, "W").otherwise("D"))


def bucket_label(d, rule: str) -> Column:
    d = _col(d)
    if rule == "D":
        return d
    if rule == "W":
        return F.next_day(F.date_sub(d, 1), "SU")
    if rule == "M":
        return F.last_day(d)
    if rule == "Q":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    raise ValueError(f"unknown resample rule {rule!r}")


def calendar_labels(lo_label, hi_label, rule: str) -> Column:
    """Array of every bucket label from ``lo_label`` to ``hi_label`` inclusive.

    Month and quarter steps run over period starts (stepping from a 31st
    would drift), then map to period ends.
    """
    lo, hi = _col(lo_label), _col(hi_label)
    if rule == "D":
        return F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))
    if rule == "W":
        return F.sequence(lo, hi, F.expr("INTERVAL 7 DAYS"))
    if rule == "M":
        starts = F.sequence(F.trunc(lo, "month"), F.trunc(hi, "month"), F.expr("INTERVAL 1 MONTH"))
        return F.transform(starts, lambda s: F.last_day(s))
    if rule == "Q":
        starts = F.sequence(F.trunc(lo, "quarter"), F.trunc(hi, "quarter"), F.expr("INTERVAL 3 MONTHS"))
        return F.transform(starts, lambda s: F.last_day(F.add_months(s, 2)))
    raise ValueError(f"unknown resample rule {rule!r}")
