"""Events in run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# How a log names a step with its page, a page's outcome, the head of the timing table, and a line of it.
STEP = r"\[(\d+)/(\d+)\]\s*([^:]+):?\s*(.*)$"
OUTCOME = r"([^\s:]+)\.json: (PASS|FAIL)"
TIMING_HEAD = "Timing summary:"
TIMING = r"^\s+(\w+):\s+([0-9]+(?:\.[0-9]+)?)s\s*$"


def step_events(lines: DataFrame) -> DataFrame:
    """(file_name, line_no, step, steps, name, page): the lines that report a step; other lines give no row."""
    part = lambda k: F.regexp_extract("line", STEP, k)
    return lines.where(F.col("line").rlike(STEP)).select(
        "file_name", "line_no", part(1).cast("int").alias("step"), part(2).cast("int").alias("steps"), F.trim(part(3)).alias("name"), F.trim(part(4)).alias("page")
    )


def outcomes(lines: DataFrame) -> DataFrame:
    """(file_name, passed, failed): pages by their outcome per log."""
    found = lines.select("file_name", F.regexp_extract("line", OUTCOME, 2).alias("o"))
    return found.groupBy("file_name").agg(F.count_if(F.col("o") == "PASS").alias("passed"), F.count_if(F.col("o") == "FAIL").alias("failed"))


def timings(lines: DataFrame) -> DataFrame:
    """(file_name, stage, seconds): the timing lines after the head of the timing table; the window spans one log."""
    w = Window.partitionBy("file_name").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    after = lines.withColumn("after_", F.max(F.col("line").contains(TIMING_HEAD)).over(w))
    return after.where(F.col("after_") & F.col("line").rlike(TIMING)).select(
        "file_name", F.regexp_extract("line", TIMING, 1).alias("stage"), F.regexp_extract("line", TIMING, 2).cast("double").alias("seconds")
    )
