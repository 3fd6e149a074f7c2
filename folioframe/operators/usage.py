"""Usage of recognition and labelling services by calendar periods of one zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The zone whose calendar the periods follow.
ZONE = "America/Los_Angeles"
# The known providers, in the order in which they are tried.
PROVIDERS = ("vision", "gemini", "glm", "iamhc", "openrouter", "groq")


def local(ts: Column, zone: str = ZONE) -> Column:
    """A zone-less UTC time as wall-clock time of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def day(ts: Column) -> Column:
    return F.date_format(local(ts), "yyyy-MM-dd")


def week(ts: Column) -> Column:
    """The ISO week, with the year it belongs to."""
    at = local(ts)
    return F.concat(F.extract(F.lit("YEAROFWEEK"), at).cast("string"), F.lit("-W"), F.lpad(F.extract(F.lit("WEEK"), at).cast("string"), 2, "0"))


def month(ts: Column) -> Column:
    return F.date_format(local(ts), "yyyy-MM")


def delivered_once(log: DataFrame) -> DataFrame:
    """``log`` with each request once: rows delivered again are exact copies, so the first load stands for all."""
    return log.dropDuplicates(["request_id"])


def _measures() -> list[Column]:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return [
        F.count(F.lit(1)).cast("bigint").alias("requests"),
        F.count_if("ok").cast("bigint").alias("success"),
        F.count_if(~F.coalesce("ok", F.lit(False))).cast("bigint").alias("failures"),
        total("retries").alias("retries"),
        F.round(F.coalesce(F.sum("latency_ms"), F.lit(0.0)), 1).alias("latency_ms"),
        total("pages").alias("pages"),
        total("images").alias("images"),
        total("input_tokens").alias("input_tokens"),
        total("output_tokens").alias("output_tokens"),
    ]


def periods(log: DataFrame) -> DataFrame:
    """(grain, period, provider, measures) for days, weeks, months and all time, in one aggregation.

    Null providers are a provider of their own; null latencies and tokens add nothing. Rows are first summed per day, week and month on
    the map side, so a busy provider costs no more than a quiet one.
    """
    rows = delivered_once(log).withColumns({"day": day(F.col("ts")), "week": week(F.col("ts")), "month": month(F.col("ts"))})
    sets = [["provider", "day"], ["provider", "week"], ["provider", "month"], ["provider"]]
    cubed = rows.groupingSets([[F.col(c) for c in s] for s in sets], "provider", "day", "week", "month")
    level = F.grouping_id("provider", "day", "week", "month")
    out = cubed.agg(level.alias("level_"), *_measures())
    grain, period = (
        F.when(F.col("level_") == 3, "day").when(F.col("level_") == 5, "week").when(F.col("level_") == 6, "month").otherwise("lifetime"),
        F.when(F.col("level_") == 3, F.col("day")).when(F.col("level_") == 5, F.col("week")).when(F.col("level_") == 6, F.col("month")).otherwise("all"),
    )
    names = ["requests", "success", "failures", "retries", "latency_ms", "pages", "images", "input_tokens", "output_tokens"]
    return out.select(grain.alias("grain"), period.alias("period"), "provider", *names)


def retained(rollup: DataFrame, days: int = 90, weeks: int = 52, months: int = 24) -> DataFrame:
    """``rollup`` without the periods older than the newest ``days``, ``weeks`` and ``months`` that occur; all time stays.

    Periods are ranked among themselves: one row per period, not per event.
    """
    keep = F.create_map(F.lit("day"), F.lit(days), F.lit("week"), F.lit(weeks), F.lit("month"), F.lit(months), F.lit("lifetime"), F.lit(1))
    ids = rollup.select("grain", "period").distinct()
    rank = F.row_number().over(Window.partitionBy("grain").orderBy(F.desc("period")))
    newest = ids.withColumn("rank_", rank).where(F.col("rank_") <= keep[F.col("grain")]).select("grain", "period")
    return rollup.join(F.broadcast(newest), ["grain", "period"])


def recent(log: DataFrame, n: int = 50) -> DataFrame:
    """The last ``n`` requests, newest first; ties by the higher id first."""
    return delivered_once(log).orderBy(F.desc_nulls_last("ts"), F.desc("request_id")).limit(n).select("request_id", "ts", "provider", "ok", "latency_ms")


def dashboard(log: DataFrame) -> DataFrame:
    """One row per known provider, zero-filled: requests and pages of the last day in the log, the day before, its week, its month and
    all time, and the mean latency of that day. An empty log gives zeros. Unknown providers are left out."""
    spark = log.sparkSession
    rows = delivered_once(log)
    at = F.lit(log.agg(F.max("ts")).first()[0]).cast("timestamp_ntz")
    today, yesterday = day(at), F.date_format(F.date_sub(local(at).cast("date"), 1), "yyyy-MM-dd")
    grains = {
        "today": day(F.col("ts")) == today,
        "yesterday": day(F.col("ts")) == yesterday,
        "week": week(F.col("ts")) == week(at),
        "month": month(F.col("ts")) == month(at),
        "lifetime": F.lit(True),
    }
    sums = [
        x
        for name, inside in grains.items()
        for x in (F.count_if(inside).cast("bigint").alias(f"{name}_requests"), F.sum(F.when(inside, F.col("pages"))).cast("bigint").alias(f"{name}_pages"))
    ]
    latency = F.sum(F.when(grains["today"], F.col("latency_ms")))
    per = rows.groupBy("provider").agg(*sums, latency.alias("latency"))
    known = spark.createDataFrame([(i, p) for i, p in enumerate(PROVIDERS)], "place int, provider string")
    names = [f"{g}_{m}" for g in grains for m in ("requests", "pages")]
    zero = F.lit(0).cast("bigint")
    return known.join(per, "provider", "left").select(
        "place",
        "provider",
        *[F.coalesce(n, zero).alias(n) for n in names],
        F.coalesce(F.round(F.try_divide(F.coalesce("latency", F.lit(0.0)), F.col("today_requests")), 1), F.lit(0.0)).alias("avg_latency"),
    )


def stage_times(log: DataFrame, stage: str, seconds: str, order: str) -> DataFrame:
    """(stage, runs, last_seconds, total_seconds): the last and the summed time of every stage; rows without a time are left out."""
    return (
        log.where(F.col(stage).isNotNull() & F.col(seconds).isNotNull())
        .groupBy(F.col(stage).alias("stage"))
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("runs"),
            F.max_by(seconds, order).alias("last_seconds"),
            F.round(F.sum(seconds), 3).alias("total_seconds"),
        )
    )
