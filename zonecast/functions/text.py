"""Text presentation of numbers, matching Python's ``f"{x:.Nf}"``.

``format_string('%.2f')`` rounds the shortest decimal text half-up
(0.125 -> 0.13, 2.675 -> 2.68); Python rounds the exact binary value, ties
to even (0.12, 2.67). Scaling by 10^N can itself land on an exact .5 that
the true product is not, so the rounding error of the scaling is recovered
exactly (Dekker's product with a Veltkamp split) to break such ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0   # 2^27 + 1


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_correctly(c, digits: int) -> Column:
    """x rounded to ``digits`` decimals as Python's formatting does."""
    x = _col(c)
    b = float(10 ** digits)
    y = x * b
    t = x * _SPLIT
    hi = t - (t - x)
    lo = x - hi
    err = (hi * b - y) + lo * b          # exact: x*b == y + err
    f = F.floor(y)
    at_tie = (y - f) == 0.5
    tie_up = F.when(err > 0, True).when(err < 0, False).otherwise(F.pmod(f, F.lit(2)) == 1)
    k = F.when(at_tie, F.when(tie_up, f + 1).otherwise(f)).otherwise(F.rint(y))
    return k / b


def format_fixed(c, digits: int) -> Column:
    """``f"{x:.{digits}f}"`` as a Column. NULL stays NULL (Java's formatter
    would print a truncated "null")."""
    x = _col(c)
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", round_correctly(x, digits)))
