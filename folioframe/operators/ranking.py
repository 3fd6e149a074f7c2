"""Positions within groups that may be of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.session import stored


def positions(rows: DataFrame, by: list[str], order: list[Column | str], name: str = "position") -> DataFrame:
    """``rows`` with their 0-based place within the group ``by`` in ``order``, which should have no ties.

    A window over a group would bring a hot group into one task. Here the rows are range-partitioned by group and order, numbered inside
    each partition, and shifted by the group's rows in the partitions before: only counts per partition and group are summed.
    """
    keys = [F.col(c) for c in by]
    spread = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    spread = stored(spread.select("*", F.spark_partition_id().alias("part_"), F.monotonically_increasing_id().alias("seq_")), "ranked")
    local = F.row_number().over(Window.partitionBy("part_", *by).orderBy("seq_"))
    counts = spread.groupBy(*by, "part_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(*by).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*by, "part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("shift_"))
    shifts = shifts.select(*[F.col(c).alias(f"{c}_k") for c in by], F.col("part_").alias("part_k"), "shift_")
    same = F.col("part_") == F.col("part_k")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_k"))
    numbered = spread.withColumn("local_", local)
    return numbered.join(shifts, same).select(*rows.columns, (F.col("local_") - 1 + F.col("shift_")).cast("bigint").alias(name))
