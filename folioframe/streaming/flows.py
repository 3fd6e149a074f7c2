"""Streams: new annotation files validated as they come, and usage summed in windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioframe.operators import logs, validation
from folioframe.sources.documents import annotations_of

USAGE = (
    "request_id bigint, ts timestamp, file string, provider string, model string, ok boolean, latency_ms double, retries int, error string, "
    "pages int, images int, input_tokens int, output_tokens int, loaded_at timestamp"
)


def annotation_stream(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, payload) of JSON files as they appear in ``path``."""
    rows = spark.readStream.option("wholetext", True).option("pathGlobFilter", "*.json").format("text").schema("value string").load(path)
    return rows.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("payload"))


def validated(files: DataFrame) -> DataFrame:
    """Checks of every file, computed row by row, so the same for a stream and a table."""
    return validation.validate(annotations_of(files), key="file_name")


def usage_windows(events: DataFrame, width: str = "1 hour", late: str = "2 days") -> DataFrame:
    """(start, provider, requests, success, pages): usage per window of event time; events later than ``late`` are dropped, and requests
    delivered twice within that time count once."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    once = timed.dropDuplicatesWithinWatermark(["request_id"])
    return (
        once.groupBy(F.window("ts", width), "provider")
        .agg(F.count(F.lit(1)).alias("requests"), F.count_if("ok").alias("success"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"))
        .select(F.col("window.start").alias("start"), "provider", "requests", "success", "pages")
    )


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, line_no, line) of run logs as they appear in ``path``; a log is read once, when it is whole."""
    rows = spark.readStream.option("wholetext", True).format("text").schema("value string").load(path)
    return rows.select(F.col("_metadata.file_name").alias("file_name"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def running_stages(lines: DataFrame) -> DataFrame:
    """(file_name, step, name, passed, failed): the step that each log is at and its pages by outcome, kept up to date over the lines that come; to
    be written in update or complete mode. The state is one row per log."""
    step = F.regexp_extract("line", logs.STEP, 1).try_cast("int")
    outcome = F.regexp_extract("line", logs.OUTCOME, 2)
    at = F.when(step.isNotNull(), F.struct("line_no", step.alias("step"), F.trim(F.regexp_extract("line", logs.STEP, 3)).alias("name")))
    state = lines.groupBy("file_name").agg(F.max(at).alias("at"), F.count_if(outcome == "PASS").alias("passed"), F.count_if(outcome == "FAIL").alias("failed"))
    return state.select("file_name", "at.step", "at.name", "passed", "failed")


def run_available(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes what is there to Parquet and stops; run again, it takes up only what is new."""
    return rows.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
