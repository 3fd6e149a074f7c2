"""Queries of the llm subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm import duplicates, languages, leakage, lookalikes, packing, rankcompactors, reading, scannoise, truncation
from folioframe.sources.tables import table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncated(table(spark, folder, "provider_results")).withColumnRenamed("id", "result_id")


def p2_rates(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.rates(table(spark, folder, "provider_results"), "result_id", "raw_text", ["provider", "model"])


def p2_rules(spark: SparkSession, folder: str) -> DataFrame:
    """How many replies each kind of evidence decides."""
    found = truncation.rules(table(spark, folder, "provider_results"))
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("n_replies"))


DAILY = ["metric", "provider", "file", "day"]


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    values = rankcompactors.measurements(
        table(spark, folder, "page_scores"), table(spark, folder, "usage_log"), table(spark, folder, "provider_results")
    )
    return rankcompactors.sketches(values, DAILY, "value")


def _answers(merged: DataFrame, keys: list[str]) -> DataFrame:
    bounds = [F.lit(rankcompactors.error_bound(q)).alias(f"rank_error_p{round(100 * q)}") for q in rankcompactors.PERCENTILES]
    return merged.select(*keys, "n", "p50", "p90", "p95", "p99", *bounds)


def _days(spark: SparkSession, folder: str) -> DataFrame:
    # The measurements come out of a shuffle, so a key has one sketch per partition of it at most.
    return rankcompactors.merge(_daily(spark, folder), DAILY, parts=int(spark.conf.get("spark.sql.shuffle.partitions")))


def p3_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles per metric, provider, file and day."""
    return _answers(_days(spark, folder), DAILY)


def p3_providers(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles per metric and provider, merged from the sketches of files and days."""
    return _answers(rankcompactors.merge(_days(spark, folder), ["metric", "provider"]), ["metric", "provider"])


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return languages.mislabelled(table(spark, folder, "vision_results"), table(spark, folder, "page_annotations"))


def p6_languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.languages(table(spark, folder, "vision_results"), table(spark, folder, "page_annotations"))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks, page annotations and raw annotations as records."""
    return (
        duplicates.block_records(table(spark, folder, "blocks"))
        .unionByName(duplicates.page_records(table(spark, folder, "page_annotations")))
        .unionByName(duplicates.json_records(table(spark, folder, "annotation_records")))
    )


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.collapse(_records(spark, folder))


def p7_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The number of copies of every kept block, page annotation and readable raw annotation."""
    return duplicates.copies(_records(spark, folder))


def p7_block_copies(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.copies(duplicates.block_records(table(spark, folder, "blocks")))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(src, id, text) of all blocks and pages."""
    blocks = table(spark, folder, "blocks").select(F.lit("block").alias("src"), F.col("block_id").alias("id"), "text")
    pages = table(spark, folder, "vision_results").select(
        F.lit("page").alias("src"), F.col("page_id").alias("id"), F.col("full_text").alias("text")
    )
    return blocks.unionByName(pages)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return scannoise.noise(table(spark, folder, "vision_results"), table(spark, folder, "blocks"))


def p4_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return scannoise.paragraphs(table(spark, folder, "vision_results"), table(spark, folder, "blocks"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.lookalike_pairs(texts(spark, folder))


def p5_groups(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.groups(texts(spark, folder))


def p5_forms(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.forms(texts(spark, folder))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.token_counts(table(spark, folder, "documents")))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill(p8_containers(spark, folder))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p9_reports(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.reports(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return reading.reading_bands(table(spark, folder, "documents"), table(spark, folder, "reading_labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_rates": p2_rates,
    "p2_rules": p2_rules,
    "p3_percentiles": p3_percentiles,
    "p3_providers": p3_providers,
    "p4_found": p4_found,
    "p4_paragraphs": p4_paragraphs,
    "p5_found": p5_found,
    "p5_groups": p5_groups,
    "p5_forms": p5_forms,
    "p6_found": p6_found,
    "p6_languages": p6_languages,
    "p7_found": p7_found,
    "p7_copies": p7_copies,
    "p7_block_copies": p7_block_copies,
    "p8_containers": p8_containers,
    "p8_fill": p8_fill,
    "p9_found": p9_found,
    "p9_reports": p9_reports,
    "p10_found": p10_found,
}

_FOLD = "lower(regexp_replace({0}, '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g'))"

_TEXTS = """t AS (
  SELECT 'block' AS src, block_id AS id, text FROM blocks UNION ALL SELECT 'page', page_id, full_text FROM vision_results
)"""

ORACLES: dict[str, str] = {
    "p5_forms": f"WITH {_TEXTS} SELECT src, id, {lookalikes.form_sql('text')} AS form FROM t",
    "p5_found": f"""WITH {_TEXTS}, f AS (SELECT src, id, text, {lookalikes.form_sql('text')} AS form FROM t WHERE text IS NOT NULL)
SELECT DISTINCT a.src, least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b
FROM f a JOIN f b ON a.src = b.src AND a.form = b.form AND a.text < b.text AND a.id <> b.id""",
    "p7_block_copies": f"""SELECT 'block' AS src, MIN(block_id) AS kept_id, COUNT(DISTINCT block_id) AS n_copies FROM blocks
GROUP BY page_id, idx, CAST(box AS VARCHAR), class_label, is_picture, reading_order_index, {_FOLD.format("text")}""",
}
