"""Text expressions with the meaning of the annotation data: Unicode white space, code points, truncating percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space at either end, for every white-space character of Unicode.
EDGE_SPACE = r"^[\s\p{Z}\x{1c}-\x{1f}\x{0b}\x{85}]+|[\s\p{Z}\x{1c}-\x{1f}\x{0b}\x{85}]+$"


def strip(text: Column) -> Column:
    """``text`` without white space at its ends, any Unicode white space included."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def is_blank(text: Column) -> Column:
    """Whether ``text`` is null or only white space."""
    return F.coalesce(strip(text) == "", F.lit(True))


def shortened(text: Column, limit: int = 100) -> Column:
    """``text`` cut to ``limit`` code points with three dots after it where something was cut."""
    return F.when(F.char_length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def token_estimate(text: Column) -> Column:
    """A quarter of the code points, at least one."""
    return F.greatest(F.lit(1), (F.char_length(text) / 4).cast("int"))


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent, cut toward zero: divided first, then scaled, as doubles."""
    return ((part / whole.cast("double")) * F.lit(100.0)).cast("int")
