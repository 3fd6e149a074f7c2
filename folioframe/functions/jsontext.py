"""JSON held in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_json(text: Column) -> Column:
    """The VARIANT of ``text`` if all of it is one JSON value, else null.

    The parser stops after the first value and ignores what follows it, so the text is read as the first of two list items: text after
    the value then makes the list unreadable or of another length.
    """
    pair = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit(",0]"))), "$", "array<variant>")
    return F.when(F.size(pair) == 2, F.get(pair, F.lit(0)))


def is_json(text: Column) -> Column:
    """Whether all of ``text`` is one JSON value; false for null."""
    return whole_json(text).isNotNull()
