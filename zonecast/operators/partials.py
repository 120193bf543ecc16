"""Sums and counts a day, from which every mean of a page is answered.

A daily layer has the columns of the rows it stands for, with S_<v> (sum) and
N_<v> (count) in the place of a measure v. Means over any further grouping are
sums of sums over sums of counts, so filters on dates, stations, zones and
pollutants, joins with the zones and all means work on it as on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily(rows: DataFrame, measures) -> DataFrame:
    """One row for each combination of the other columns (a station position and day, say)."""
    keys = [c for c in rows.columns if c not in measures]
    return rows.groupBy(*keys).agg(*[agg for v in measures for agg in (F.sum(v).alias(f"S_{v}"), F.count(v).alias(f"N_{v}"))])


def totals(df: DataFrame, v: str, where: Column | None = None) -> tuple[Column, Column]:
    """Aggregates: sum and count of a measure, whether ``df`` has its rows or a daily layer of them."""
    pick = (lambda c: c) if where is None else (lambda c: F.when(where, c))
    if f"S_{v}" in df.columns:
        return F.sum(pick(F.col(f"S_{v}"))), F.coalesce(F.sum(pick(F.col(f"N_{v}"))), F.lit(0))
    return F.sum(pick(F.col(v))), F.count(pick(F.col(v)))


def mean(df: DataFrame, v: str) -> Column:
    s, n = totals(df, v)
    return F.when(n > 0, s / n)


def present(df: DataFrame, v: str) -> Column:
    """Whether a row stands for at least one value of the measure."""
    return F.col(f"N_{v}") > 0 if f"S_{v}" in df.columns else F.col(v).isNotNull()
