"""Numeric helpers with the rounding and missing-value rules of the model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to even (numpy ``round``).

    Spark's ``round`` rounds ties away from zero (0.25 -> 0.3); the model
    rounds 0.25 -> 0.2, so scale, ``rint`` and scale back.
    """
    scale = float(10 ** digits)
    return F.rint(_col(c) * scale) / scale


def nan_to_null(c) -> Column:
    """NaN and NULL both mean "missing" in the model; Spark's avg treats
    NaN as a value, so scrub it to NULL at ingest."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))
