"""Joins that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy when it holds more than 1/HEAVY of the counted rows, so there are fewer than HEAVY of them.
HEAVY = 1000


def heavy_join(rows: DataFrame, lookup: DataFrame, on: list[str], count: str, total: int) -> DataFrame:
    """``rows`` inner-joined to ``lookup``, which has one row per key and in ``count`` the number of rows of that key.

    Keys above ``total / HEAVY`` rows are joined by broadcast: by counting, fewer than ``HEAVY`` keys can be that frequent,
    whatever the data. All others are joined by a shuffle in which no key is large. ``count`` is not part of the result.
    """
    frequent = F.col(count) * HEAVY > F.lit(total)
    heavy = lookup.where(frequent).drop(count)
    light = lookup.where(~frequent).drop(count)
    hot = rows.join(F.broadcast(heavy), on, "inner")
    cold = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light, on, "inner")
    return hot.unionByName(cold)
