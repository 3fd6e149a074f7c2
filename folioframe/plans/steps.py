"""Queries over the steps of a run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.operators import files, logs, replies, stages, usage, validation
from folioframe.plans import quality, runs
from folioframe.sources.tables import table

CHUNK = 5


def _infos(blocks: DataFrame) -> DataFrame:
    """Pictures among blocks as a page description gives them; the page is the box around all its blocks."""
    at = lambda k: F.get("box", F.lit(k))
    extent = blocks.where("size(box) = 4").groupBy("page_id").agg(F.max(at(2)).cast("double").alias("page_w"), F.max(at(3)).cast("double").alias("page_h"))
    return blocks.where("is_picture").select("page_id", F.col("box").alias("bbox")).distinct().join(extent, "page_id")


def picture_sources(spark: SparkSession, folder: str) -> DataFrame:
    blocks = table(spark, folder, "blocks")
    regions = blocks.where("class_label = 'Picture'").select("page_id", "box").distinct()
    found = stages.first_found(table(spark, folder, "vision_results"), stages.picture_boxes(_infos(blocks), dpi=72), regions)
    return found.select("page_id", "source", F.array_join(F.transform("box", lambda v: v.cast("string")), ",").alias("box"))


def level2_pages(spark: SparkSession, folder: str) -> DataFrame:
    own = replies.originals(table(spark, folder, "blocks"))
    out = stages.fallback_pages(replies.pages(table(spark, folder, "provider_results"), own, expected=1), own)
    return out.select(F.col("id").alias("result_id"), F.array_join("classes", "|").alias("classes"), F.array_join("texts", "|").alias("texts"))


def prompt_batches(spark: SparkSession, folder: str) -> DataFrame:
    own = replies.originals(table(spark, folder, "blocks"))
    return stages.prompts(own.withColumn("batch_no", F.floor(F.col("id") / CHUNK).cast("bigint")), "batch_no", "id")


def block_annotations(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of pages by block and by annotation, side by side."""
    own = replies.originals(table(spark, folder, "blocks")).select(F.col("id").alias("page_id"), F.posexplode("texts").alias("pos", "recognised"))
    first = table(spark, folder, "page_annotations").where("block_text is not null").groupBy("page_id").agg(F.min_by("block_text", "ann_id").alias("ts"))
    return stages.zipped_rows(own, first.select("page_id", F.posexplode("ts").alias("pos", "annotated")), ["page_id"])


def _shown(rollup: DataFrame) -> DataFrame:
    return rollup.select("provider", "today_requests", "today_pages", "month_pages")


def language_stats(spark: SparkSession, folder: str) -> DataFrame:
    notes = table(spark, folder, "page_annotations")
    verdicts = validation.judged(notes, "ann_id", "page_id")
    return stages.language_stats(table(spark, folder, "vision_results"), verdicts, table(spark, folder, "usage_log"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "picture_sources": picture_sources,
    "level2_pages": level2_pages,
    "prompt_batches": prompt_batches,
    "block_annotations": block_annotations,
    "provider_text": lambda s, d: table(s, d, "provider_results").select(
        "result_id",
        replies.provider_text(
            F.when(F.col("provider") == "gemini", F.to_json(F.struct(F.array(F.struct(F.struct(F.array(F.struct(F.col("raw_text").alias("text"))).alias("parts")).alias("content"))).alias("candidates")))).otherwise(
                F.to_json(F.struct(F.array(F.struct(F.struct(F.col("raw_text").alias("content")).alias("message"))).alias("choices")))
            ),
            F.col("provider"),
        ).alias("text"),
    ),
    "usage_totals": lambda s, d: stages.with_total(_shown(usage.dashboard(table(s, d, "usage_log"))), "provider"),
    "active_providers": lambda s, d: stages.active(_shown(usage.dashboard(table(s, d, "usage_log"))), ["today_requests", "month_pages"]).select("provider"),
    "estimated_pages": lambda s, d: stages.estimated_pages(table(s, d, "source_files"), 10),
    "language_menu": lambda s, d: stages.language_menu(files.language_groups(table(s, d, "source_files"))),
    "language_hints": lambda s, d: stages.accepted(table(s, d, "source_files")).select("file", F.get(stages.language_hint(files.name_language(F.col("file"))), F.lit(0)).alias("hint")).distinct(),
    "clean_names": lambda s, d: table(s, d, "source_files").select("file", stages.without_markup(F.concat(F.lit("[bold]"), "file", F.lit("[/bold]"))).alias("plain")).distinct(),
    "clipped_boxes": lambda s, d: table(s, d, "blocks").where("size(box) = 4").select("block_id", F.array_join(F.transform(stages.clipped(F.col("box"), F.lit(500), F.lit(700)), lambda v: v.cast("string")), ",").alias("box")).distinct(),
    "language_stats": language_stats,
    "run_totals": lambda s, d: stages.run_totals(language_stats(s, d)),
    "stage_states": lambda s, d: stages.stage_states(logs.step_events(runs.log_lines(table(s, d, "usage_log"))), 5),
}

_EXTENT = """x AS (SELECT page_id, CAST(MAX(box[3]) AS DOUBLE) AS w, CAST(MAX(box[4]) AS DOUBLE) AS h FROM blocks WHERE len(box) = 4 GROUP BY page_id),
e AS (
  SELECT DISTINCT b.page_id, b.box FROM blocks b JOIN x ON x.page_id = b.page_id WHERE is_picture AND len(box) = 4 AND len(list_filter(box, lambda v: v IS NULL)) = 0
    AND box[3] - box[1] >= 40 AND box[4] - box[2] >= 40 AND CAST(box[3] - box[1] AS DOUBLE) * (box[4] - box[2]) <= 0.5 * (w * h)
)"""
_DASHBOARD = f"SELECT provider, today_requests, today_pages, month_pages FROM ({runs.ORACLES['usage_dashboard']})"
_STATS = f"""{quality._VALIDATE},
pg AS (SELECT DISTINCT page_id, file FROM vision_results),
ok AS (SELECT DISTINCT a.page_id FROM val JOIN page_annotations a ON a.ann_id = val.ann_id WHERE val.valid),
pl AS (SELECT {runs._NAME} AS language, COUNT(DISTINCT file) AS files, COUNT(*) AS pages, COUNT(ok.page_id) AS passed FROM pg LEFT JOIN ok ON ok.page_id = pg.page_id GROUP BY 1),
sp AS (SELECT {runs._NAME} AS language, SUM(latency_ms) AS spent FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id) AS rn FROM usage_log) WHERE rn = 1) GROUP BY 1),
st AS (
  SELECT pl.language, files, pages, passed, pages - passed AS failed, ROUND(passed / CAST(pages AS DOUBLE) * 100, 4) AS pass_rate, ROUND(COALESCE(spent, 0) / pages, 4) AS mean_latency
  FROM pl LEFT JOIN sp ON sp.language = pl.language
)"""
_HINT = "CASE {0} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in stages.LANGUAGE_HINTS.items()) + " END"

ORACLES: dict[str, str] = {
    "picture_sources": f"""WITH {_EXTENT},
r AS (SELECT DISTINCT page_id, box FROM blocks WHERE class_label = 'Picture' AND page_id NOT IN (SELECT page_id FROM e)),
a AS (SELECT page_id, 'embedded' AS source, box FROM e UNION ALL SELECT page_id, 'region', box FROM r)
SELECT p.page_id, source, array_to_string(box, ',') AS box FROM (SELECT DISTINCT page_id FROM vision_results) p LEFT JOIN a ON a.page_id = p.page_id""",
    "level2_pages": f"""WITH f AS (SELECT DISTINCT result_id FROM ({runs._PARSE}) WHERE error IS NOT NULL), {runs._ORIGINALS}
SELECT result_id, array_to_string(list_transform(ot, lambda t: 'Text'), '|') AS classes, array_to_string(ot, '|') AS texts FROM f JOIN o ON o.page_id = f.result_id""",
    "prompt_batches": f"""WITH {runs._ORIGINALS},
b AS (SELECT page_id // {CHUNK} AS batch_no, page_id, list_transform(range(1, len(ob) + 1), lambda i: {{'box': ob[i], 'text': CASE WHEN length(ot[i]) > 100 THEN substring(ot[i], 1, 100) || '...' ELSE ot[i] END}}) AS bl FROM o),
g AS (SELECT batch_no, COUNT(*) AS n, list(bl ORDER BY page_id) AS ls FROM b GROUP BY batch_no)
SELECT batch_no, CAST(n AS INTEGER) AS n_pages, '{stages.PROMPT_HEAD}' || n || '{stages.PROMPT_RULES}' || CAST(to_json(list_transform(range(1, n + 1), lambda i: {{'page_index': i - 1, 'raw_blocks': ls[i]}})) AS VARCHAR) || '{stages.PROMPT_SHAPE}' AS prompt FROM g""",
    "block_annotations": f"""WITH {runs._ORIGINALS},
a AS (SELECT page_id, arg_min(block_text, ann_id) AS ts FROM page_annotations WHERE block_text IS NOT NULL GROUP BY page_id),
j AS (SELECT o.page_id, ot, ts, unnest(range(1, least(len(ot), len(ts)) + 1)) AS i FROM o JOIN a ON a.page_id = o.page_id)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, ot[i] AS recognised, ts[i] AS annotated FROM j""",
    "provider_text": "SELECT result_id, raw_text AS text FROM provider_results",
    "usage_totals": f"WITH d AS ({_DASHBOARD}) SELECT * FROM d UNION ALL SELECT 'total', SUM(today_requests), SUM(today_pages), SUM(month_pages) FROM d",
    "active_providers": f"SELECT provider FROM ({_DASHBOARD}) WHERE today_requests > 0 OR month_pages > 0",
    "estimated_pages": "SELECT COALESCE(SUM(least(COALESCE(pages, 10), 10)), 0) AS n_pages FROM (SELECT file, MAX(pages) AS pages FROM source_files GROUP BY file)",
    "language_menu": f"WITH g AS ({runs.ORACLES['language_groups']}) SELECT CAST(ROW_NUMBER() OVER (ORDER BY n_files DESC, first_file) AS INTEGER) AS place, language, n_files FROM g",
    "language_hints": f"SELECT DISTINCT file, {_HINT.format(runs._NAME)} AS hint FROM source_files WHERE lower(file) LIKE '%.pdf'",
    "clean_names": "SELECT DISTINCT file, file AS plain FROM source_files",
    "clipped_boxes": """SELECT DISTINCT block_id, greatest(0, least(box[1], 500)) || ',' || greatest(0, least(box[2], 700)) || ',' || greatest(0, least(box[3], 500)) || ',' || greatest(0, least(box[4], 700)) AS box
FROM blocks WHERE len(box) = 4""",
    "language_stats": f"WITH {_STATS} SELECT * FROM st",
    "run_totals": f"""WITH {_STATS} SELECT CAST(SUM(files) AS BIGINT) AS files, CAST(SUM(pages) AS BIGINT) AS pages, CAST(SUM(passed) AS BIGINT) AS passed, CAST(SUM(failed) AS BIGINT) AS failed,
  ROUND(SUM(passed) / CAST(SUM(pages) AS DOUBLE) * 100, 4) AS pass_rate FROM st""",
    "stage_states": f"""WITH {runs._LOG}, n AS (SELECT COALESCE(provider, 'none') AS file_name, arg_max(CAST(length(COALESCE(file, '')) % 5 + 1 AS INTEGER), request_id) AS now FROM l GROUP BY 1)
SELECT file_name, CAST(step AS INTEGER) AS step, CASE WHEN step < n.now THEN 'done' WHEN step = n.now THEN 'active' ELSE 'pending' END AS state FROM n, (SELECT unnest(range(1, 6)) AS step)""",
}
