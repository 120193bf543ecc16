"""Column expressions on texts; words are runs of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text."""
    return F.array_remove(F.split(whole(text), SPACES), "")


def one_spaced(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(whole(text), SPACES, " ")
