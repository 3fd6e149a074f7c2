"""Queries over replies, usage and files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions import text
from folioframe.functions.jsontext import is_json
from folioframe.operators import files, logs, replies, usage
from folioframe.operators.layout import CLASSES
from folioframe.plans.pages import stripped
from folioframe.sources.tables import table


def _on(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(table(spark, folder, name))


def _two(a: str, b: str, operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(table(spark, folder, a), table(spark, folder, b))


def _json_repair(rows: DataFrame) -> DataFrame:
    fixed = replies.repaired(F.col("raw_text"))
    return rows.where("raw_text is not null").select(
        "result_id", is_json(F.col("raw_text")).alias("was_json"), is_json(fixed).alias("is_json")
    )


def _joined(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), "|").alias(c)


def _parsed(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Replies read against the blocks of the page whose id they have."""
    boxes = F.array_join(F.transform("boxes", lambda b: F.array_join(F.transform(b, lambda v: v.cast("string")), ",")), "|").alias("boxes")
    out = replies.pages(rows, replies.originals(blocks), expected=1)
    return out.select(
        F.col("id").alias("result_id"), "error", "n_blocks", boxes, _joined("classes"), _joined("texts"), _joined("order"), "order_source", F.size("relations").alias("n_relations"), "quality"
    )


def _responses(rows: DataFrame) -> DataFrame:
    """Recognition responses made of the blocks of pages, one per block: a word per piece of text, its corners as the box has them, without zeros."""
    at = lambda k: F.nullif(F.get("box", F.lit(k)), F.lit(0))
    corners = F.array(*[F.struct(at(x).alias("x"), at(y).alias("y")) for x, y in ((0, 1), (2, 1), (2, 3), (0, 3))])
    gap = F.struct(F.struct(F.lit("SPACE").alias("type")).alias("detectedBreak"))
    words = F.transform(F.split("text", " "), lambda w: F.struct(F.array(F.struct(w.alias("text"), gap.alias("property"))).alias("symbols")))
    paragraph = F.struct(F.struct(corners.alias("vertices")).alias("boundingBox"), words.alias("words"))
    page = F.struct(F.array(F.struct(F.array(paragraph).alias("paragraphs"))).alias("blocks"))
    tree = F.struct(F.array(F.struct(F.struct(F.array(page).alias("pages")).alias("fullTextAnnotation"))).alias("responses"))
    return rows.where("text is not null").select("block_id", "box", "text").distinct().select("block_id", F.to_json(tree).alias("payload"))


def log_lines(log: DataFrame) -> DataFrame:
    """The usage log as the lines of a run log per provider: a step, an outcome, the head of the timing table and a time for each request."""
    once = usage.delivered_once(log).select("request_id", F.coalesce("provider", F.lit("none")).alias("file_name"), F.coalesce("file", F.lit("")).alias("file"), F.coalesce("ok", F.lit(False)).alias("ok"), "latency_ms")
    seconds = F.format_string("  request_%d: %.1fs", "request_id", F.floor(F.col("latency_ms") / 100) / 10)
    texts = F.array(
        F.concat(F.lit("["), (F.length("file") % 5 + 1).cast("string"), F.lit("/5] Recognising: "), F.col("file")),
        F.concat(F.lit("request.json: "), F.when(F.col("ok"), "PASS").otherwise("FAIL")),
        F.when(F.col("request_id") >= 100, "Timing summary:"),
        seconds,
    )
    rows = once.select("file_name", "request_id", F.posexplode(texts).alias("k", "line")).where("line is not null")
    return rows.select("file_name", (F.col("request_id") * 4 + F.col("k")).alias("line_no"), "line")


def _order_normal(rows: DataFrame) -> DataFrame:
    order, source = replies.order_of(F.col("reading_order"), F.size("block_boxes"))
    return rows.where("block_boxes is not null").select(
        "ann_id", F.array_join(F.transform(order, lambda x: x.cast("string")), ",").alias("order_text"), source.alias("source")
    )


def _labels(rows: DataFrame) -> DataFrame:
    at = lambda k: F.get("box", F.lit(k)).cast("double")
    area = (at(2) - at(0)) * (at(3) - at(1))
    now = replies.label(F.col("class_label"), F.col("text"), area, F.col("is_picture"))
    return rows.select("block_id", now.alias("label"), F.coalesce(now.isin(*CLASSES), F.lit(False)).alias("known")).distinct()


def _prompt_texts(rows: DataFrame) -> DataFrame:
    return rows.select("block_id", text.shortened(F.col("text")).alias("short"), text.token_estimate(F.col("text")).alias("tokens")).distinct()


def _first_success(rows: DataFrame) -> DataFrame:
    place = F.array_position(F.array(*map(F.lit, usage.PROVIDERS)), F.col("provider"))
    attempts = rows.select("batch_id", (place * 1_000_000_000 + F.col("result_id")).alias("rank"), "result_id", (is_json(F.col("raw_text")) & F.get_json_object("raw_text", "$.pages").isNotNull()).alias("ok"))
    return replies.first_success(attempts, "batch_id", "rank", F.col("ok"), "result_id").select("batch_id", "result_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_repair": _on("provider_results", _json_repair),
    "extract_json": _on("provider_results", lambda r: replies.extracted(r).select(F.col("id").alias("result_id"), F.col("json").isNotNull().alias("found"), "error")),
    "parse_reply": _two("provider_results", "blocks", _parsed),
    "ocr_flatten": _on("blocks", lambda b: replies.ocr_blocks(_responses(b), "block_id", "payload").drop("page", "block", "paragraph")),
    "quality_tags": _on("provider_results", lambda r: r.select("result_id", replies.quality(F.col("provider")).alias("quality"))),
    "log_steps": _on("usage_log", lambda u: logs.step_events(log_lines(u))),
    "log_outcomes": _on("usage_log", lambda u: logs.outcomes(log_lines(u))),
    "log_timings": _on("usage_log", lambda u: logs.timings(log_lines(u))),
    "failover_first_success": _on("provider_results", _first_success),
    "order_normalise": _on("page_annotations", _order_normal),
    "label_rules": _on("blocks", _labels),
    "prompt_texts": _on("blocks", _prompt_texts),
    "picture_merge": _on("blocks", files.merged_blocks),
    "picture_filter": _on("blocks", files.embedded_pictures),
    "usage_all_grains": _on("usage_log", usage.periods),
    "usage_retention": _on("usage_log", lambda u: usage.retained(usage.periods(u), 30, 10, 3)),
    "usage_recent": _on("usage_log", usage.recent),
    "usage_dashboard": _on("usage_log", usage.dashboard),
    "stage_timing": _on("usage_log", lambda u: usage.stage_times(usage.delivered_once(u), "provider", "latency_ms", "request_id")),
    "detect_language": _on("source_files", lambda f: f.select("file", files.name_language(F.col("file")).alias("language")).distinct()),
    "language_groups": _on("source_files", files.language_groups),
    "resume_pending": _two("vision_results", "page_annotations", files.pending),
    "first_n_pages": _on("vision_results", lambda p: files.first_pages(p, 5)),
    "batch_chunks": _on("vision_results", lambda p: files.batches(p, 5)),
    "run_summary": _two("vision_results", "page_annotations", files.run_summary),
}

_LIST = lambda names: ", ".join(f"'{x}'" for x in names)
# json_valid takes a comma before a closing bracket; strict JSON does not.
_STRICT = lambda t: f"(json_valid({t}) AND NOT regexp_matches({t}, ',\\s*[\\]}}]'))"
_PT = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')"
_NAME = "CASE " + " ".join(f"WHEN regexp_matches(lower(file), '{w}') THEN '{n}'" for n, w in files.NAME_WORDS) + " ELSE 'unknown' END"
_MEASURES = """COUNT(*) AS requests, COUNT(*) FILTER (ok) AS success, COUNT(*) FILTER (NOT COALESCE(ok, FALSE)) AS failures,
  CAST(COALESCE(SUM(retries), 0) AS BIGINT) AS retries, ROUND(COALESCE(SUM(latency_ms), 0), 1) AS latency_ms,
  CAST(COALESCE(SUM(pages), 0) AS BIGINT) AS pages, CAST(COALESCE(SUM(images), 0) AS BIGINT) AS images,
  CAST(COALESCE(SUM(input_tokens), 0) AS BIGINT) AS input_tokens, CAST(COALESCE(SUM(output_tokens), 0) AS BIGINT) AS output_tokens"""
_LOG = f"""once AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id) AS rn FROM usage_log) WHERE rn = 1),
l AS (SELECT *, strftime({_PT}, '%Y-%m-%d') AS d, strftime({_PT}, '%G-W%V') AS w, strftime({_PT}, '%Y-%m') AS m FROM once)"""
_GRAINS = f"""{_LOG}, grains AS (
  SELECT 'day' AS grain, d AS period, provider, {_MEASURES} FROM l GROUP BY d, provider
  UNION ALL SELECT 'week', w, provider, {_MEASURES} FROM l GROUP BY w, provider
  UNION ALL SELECT 'month', m, provider, {_MEASURES} FROM l GROUP BY m, provider
  UNION ALL SELECT 'lifetime', 'all', provider, {_MEASURES} FROM l GROUP BY provider
)"""
_SPANS = {"today": "d = td", "yesterday": "d = yd", "week": "w = tw", "month": "m = tm", "lifetime": "TRUE"}

_TOKENS = r"""(?s)"[^"\\]*(?:\\.[^"\\]*)*"|[{}]|[^"{}]+|\""""
_EXTRACT = rf"""x0 AS (SELECT *, ROW_NUMBER() OVER () AS rn, trim(regexp_replace(raw_text, '(?s)\x{{1f4ad}}.*?\x{{2728}}', '', 'g')) AS t FROM provider_results),
x1 AS (SELECT *, split_part(t, '```', 1) AS before, regexp_extract(t, '(?s)```(?:json)?(.*?)(?:```|$)', 1) AS inside FROM x0),
x2 AS (SELECT *, CASE WHEN contains(t, '```') THEN CASE WHEN contains(before, '{{') THEN before WHEN contains(inside, '{{') THEN inside ELSE t END ELSE t END AS b FROM x1),
x3 AS (SELECT *, strpos(b, '{{') AS st, CASE WHEN strpos(b, '{{') > 0 THEN regexp_extract_all(substr(b, strpos(b, '{{')), '{_TOKENS}') END AS toks FROM x2),
x4 AS (SELECT rn, i, SUM(CASE toks[i] WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER (PARTITION BY rn ORDER BY i) AS d FROM (SELECT rn, toks, unnest(range(1, len(toks) + 1)) AS i FROM x3)),
x5 AS (SELECT x3.*, array_to_string(toks[1:k], '') AS f FROM x3 LEFT JOIN (SELECT rn, MIN(i) AS k FROM x4 WHERE d = 0 GROUP BY rn) e ON e.rn = x3.rn),
x6 AS (SELECT *, regexp_replace(f, ',\n?([\]}}])', '\1', 'g') AS u FROM x5),
x7 AS (SELECT *, regexp_replace(u, '"\s+"', '", "', 'g') AS v FROM x6),
x AS (SELECT *, CASE WHEN f = '' THEN NULL WHEN {_STRICT("f")} THEN f WHEN {_STRICT("u")} THEN u WHEN {_STRICT("v")} THEN v END AS js,
  CASE WHEN raw_text IS NULL THEN 'null reply' WHEN st = 0 THEN 'no object' WHEN f IS NULL OR f = '' THEN 'unmatched brace'
    WHEN NOT ({_STRICT("f")} OR {_STRICT("u")} OR {_STRICT("v")}) THEN 'not JSON' END AS why FROM x7)"""
_BLANK = lambda t: f"COALESCE({stripped(t)} = '', TRUE)"
_ORIGINALS = """o1 AS (SELECT page_id, idx, arg_min({'box': box, 't': text, 'p': is_picture}, block_id) AS b FROM blocks GROUP BY page_id, idx),
o AS (SELECT page_id, list(COALESCE(b.box, [0, 0, 0, 0]) ORDER BY idx) AS ob, list(COALESCE(b.t, '') ORDER BY idx) AS ot, list(COALESCE(b.p, FALSE) ORDER BY idx) AS op FROM o1 GROUP BY page_id),
og AS (
  SELECT page_id, i - 1 AS idx, CAST(ob[i][1] AS DOUBLE) AS x1, CAST(ob[i][2] AS DOUBLE) AS y1, CAST(ob[i][3] AS DOUBLE) AS x2, CAST(ob[i][4] AS DOUBLE) AS y2
  FROM (SELECT *, unnest(range(1, len(ob) + 1)) AS i FROM o) WHERE len(ob[i]) >= 4 AND len(list_filter(ob[i][1:4], lambda v: v IS NULL)) = 0
),
ogap AS (SELECT page_id, (x1 + x2) / 2 - LAG((x1 + x2) / 2) OVER (PARTITION BY page_id ORDER BY (x1 + x2) / 2, idx) AS d FROM og),
olay AS (SELECT page_id, COUNT(*) >= 3 AND EXISTS (SELECT 1 FROM ogap WHERE ogap.page_id = og.page_id AND d > 50) AS wide, MAX(x2) / 2 AS mid FROM og GROUP BY page_id),
geo AS (
  SELECT og.page_id, list(idx ORDER BY y1, CASE WHEN NOT wide THEN x1 WHEN (x1 + x2) / 2 < mid THEN 0 ELSE 1 END, idx) AS g FROM og JOIN olay ON olay.page_id = og.page_id GROUP BY og.page_id
)"""
_PERM = lambda o: f"COALESCE(len({o}) = n AND len(list_distinct({o})) = n AND len(list_filter({o}, lambda x: x >= 0 AND x < n)) = n, FALSE)"
_PARSE = f"""WITH {_EXTRACT}, {_ORIGINALS},
a1 AS (
  SELECT *, CASE WHEN js IS NULL THEN [] WHEN list_contains(json_keys(js), 'pages') THEN COALESCE(TRY_CAST(json_extract(js, '$.pages') AS JSON[]), [])
    WHEN json_type(js, '$.block_classes') = 'ARRAY' THEN [CAST(js AS JSON)] ELSE [] END AS ps FROM x
),
a2 AS (SELECT result_id, provider, COALESCE(why, CASE WHEN len(ps) <> 1 THEN 'page count' END) AS why, ps[1] AS p FROM a1),
a3 AS (
  SELECT *, TRY_CAST(json_extract(p, '$.block_classes') AS VARCHAR[]) AS cls, TRY_CAST(json_extract(p, '$.block_text') AS VARCHAR[]) AS txt,
    TRY_CAST(json_extract(p, '$.page_order') AS INTEGER[]) AS po, TRY_CAST(json_extract(p, '$.reading_order') AS INTEGER[]) AS ro,
    TRY_CAST(json_extract(p, '$.block_boxes') AS INTEGER[][]) AS bb, COALESCE(json_array_length(p, '$.block_relations'), 0) AS n_relations
  FROM a2 WHERE why IS NULL
),
a4 AS (
  SELECT a3.*, ob, ot, op, g, CASE WHEN len(ot) > 0 THEN len(ot) ELSE COALESCE(len(cls), 0) END AS n, CASE WHEN len(po) > 0 THEN po ELSE ro END AS given
  FROM a3 LEFT JOIN o ON o.page_id = result_id LEFT JOIN geo ON geo.page_id = result_id
),
a5 AS (SELECT *, CASE WHEN given[1:n][1] >= 1 AND list_max(given[1:n]) >= n THEN list_transform(given[1:n], lambda x: x - 1) ELSE given[1:n] END AS sh FROM a4),
a6 AS (
  SELECT *, CASE WHEN {_PERM("sh")} THEN sh WHEN given IS NOT NULL AND {_PERM("g")} THEN g ELSE range(n) END AS ord,
    CASE WHEN {_PERM("sh")} THEN 'given' WHEN given IS NOT NULL AND {_PERM("g")} THEN 'geometry' ELSE 'default' END AS order_source,
    list_concat(COALESCE(cls, []), list_transform(range(n), lambda x: 'Text'))[1:n] AS cs,
    list_transform(range(1, n + 1), lambda i: CASE WHEN NOT {_BLANK("txt[i]")} THEN txt[i] ELSE COALESCE(ot[i], '') END) AS ts,
    CASE WHEN txt IS NOT NULL AND len(bb) = n THEN bb WHEN len(ot) > 0 THEN ob ELSE list_transform(range(n), lambda x: [0, 0, 0, 0]) END AS bs FROM a5
),
a7 AS (
  SELECT *, list_transform(ord, lambda i: CASE WHEN ts[i + 1] = '{replies.PICTURE_MARK}' THEN 'Picture'
      WHEN cs[i + 1] = 'Picture' AND ot IS NOT NULL AND NOT op[i + 1] AND NOT {_BLANK("ts[i + 1]")} AND (CAST(bs[i + 1][3] AS DOUBLE) - bs[i + 1][1]) * (CAST(bs[i + 1][4] AS DOUBLE) - bs[i + 1][2]) < 1000 THEN 'Text'
      WHEN cs[i + 1] = 'Page-number' THEN 'Page-header' ELSE cs[i + 1] END) AS c FROM a6
),
a8 AS (SELECT *, len(list_filter(c, lambda x: x IS NULL OR x NOT IN ({_LIST(CLASSES)}))) > 0 AS bad FROM a7)
SELECT result_id, CASE WHEN bad THEN 'unknown label' END AS error, CASE WHEN NOT bad THEN CAST(n AS INTEGER) END AS n_blocks,
  CASE WHEN NOT bad THEN array_to_string(list_transform(ord, lambda i: array_to_string(bs[i + 1], ',')), '|') END AS boxes, CASE WHEN NOT bad THEN array_to_string(c, '|') END AS classes,
  CASE WHEN NOT bad THEN array_to_string(list_transform(ord, lambda i: ts[i + 1]), '|') END AS texts, CASE WHEN NOT bad THEN array_to_string(ord, '|') END AS "order",
  CASE WHEN NOT bad THEN order_source END AS order_source, CASE WHEN NOT bad THEN CAST(n_relations AS INTEGER) END AS n_relations,
  CASE WHEN NOT bad THEN CASE WHEN provider IN ({_LIST(replies.VISION)}) THEN 'full_level4' ELSE 'degraded_text_only_fallback' END END AS quality FROM a8
UNION ALL SELECT result_id, why, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM a2 WHERE why IS NOT NULL"""

ORACLES: dict[str, str] = {
    "json_repair": f"""WITH a AS (SELECT result_id, raw_text AS t, regexp_replace(raw_text, ',\\n?([\\]}}])', '\\1', 'g') AS u FROM provider_results WHERE raw_text IS NOT NULL),
b AS (SELECT *, regexp_replace(u, '"\\s+"', '", "', 'g') AS v FROM a)
SELECT result_id, {_STRICT("t")} AS was_json, {_STRICT("t")} OR {_STRICT("u")} OR {_STRICT("v")} AS is_json FROM b""",
    "extract_json": f"WITH {_EXTRACT} SELECT result_id, js IS NOT NULL AS found, why AS error FROM x",
    "parse_reply": _PARSE,
    "ocr_flatten": f"""WITH b AS (SELECT DISTINCT block_id, box, text FROM blocks WHERE text IS NOT NULL), c AS (SELECT *, COALESCE(box[1], 0) AS a, COALESCE(box[2], 0) AS b, COALESCE(box[3], 0) AS c, COALESCE(box[4], 0) AS d FROM b)
SELECT block_id, least(a, c) AS x1, least(b, d) AS y1, greatest(a, c) AS x2, greatest(b, d) AS y2, {stripped("text")} AS text FROM c WHERE {stripped("text")} <> ''""",
    "quality_tags": f"SELECT result_id, CASE WHEN provider IN ({_LIST(replies.VISION)}) THEN 'full_level4' ELSE 'degraded_text_only_fallback' END AS quality FROM provider_results",
    "log_steps": f"""WITH {_LOG} SELECT COALESCE(provider, 'none') AS file_name, request_id * 4 AS line_no, CAST(length(COALESCE(file, '')) % 5 + 1 AS INTEGER) AS step, 5 AS steps, 'Recognising' AS name, COALESCE(file, '') AS page FROM l""",
    "log_outcomes": f"WITH {_LOG} SELECT COALESCE(provider, 'none') AS file_name, COUNT(*) FILTER (ok) AS passed, COUNT(*) FILTER (NOT COALESCE(ok, FALSE)) AS failed FROM l GROUP BY ALL",
    "log_timings": f"""WITH {_LOG} SELECT COALESCE(provider, 'none') AS file_name, 'request_' || request_id AS stage, floor(latency_ms / 100) / 10 AS seconds FROM l
WHERE latency_ms IS NOT NULL AND request_id >= 100""",
    "failover_first_success": f"""WITH a AS (
  SELECT batch_id, result_id, COALESCE(list_position([{_LIST(usage.PROVIDERS)}], provider), 0) AS place FROM provider_results
  WHERE {_STRICT("raw_text")} AND json_extract(raw_text, '$.pages') IS NOT NULL AND json_type(raw_text, '$.pages') <> 'NULL'
) SELECT batch_id, result_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY batch_id ORDER BY place, result_id) AS rn FROM a) WHERE rn = 1""",
    "order_normalise": """WITH a AS (SELECT ann_id, len(block_boxes) AS n, reading_order[1:len(block_boxes)] AS c FROM page_annotations WHERE block_boxes IS NOT NULL),
s AS (SELECT ann_id, n, CASE WHEN c[1] >= 1 AND list_max(c) >= n THEN list_transform(c, lambda x: x - 1) ELSE c END AS o FROM a),
g AS (SELECT *, COALESCE(len(o) = n AND len(list_distinct(o)) = n AND list_min(o) >= 0 AND list_max(o) < n, FALSE) AS ok FROM s)
SELECT ann_id, array_to_string(CASE WHEN ok THEN list_transform(o, lambda x: CAST(x AS VARCHAR)) ELSE list_transform(range(n), lambda x: CAST(x AS VARCHAR)) END, ',') AS order_text,
  CASE WHEN ok THEN 'given' ELSE 'default' END AS source FROM g""",
    "label_rules": f"""WITH a AS (
  SELECT block_id, text, is_picture, (CAST(box[3] AS DOUBLE) - box[1]) * (CAST(box[4] AS DOUBLE) - box[2]) AS area,
    CASE WHEN text = '{replies.PICTURE_MARK}' THEN 'Picture' WHEN class_label = 'Page-number' THEN 'Page-header' ELSE class_label END AS l FROM blocks
), b AS (
  SELECT block_id, CASE WHEN l = 'Picture' AND NOT COALESCE(regexp_replace(text, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') = '', TRUE) AND text <> '{replies.PICTURE_MARK}'
    AND NOT COALESCE(is_picture, FALSE) AND area < 1000 THEN 'Text' ELSE l END AS label FROM a
) SELECT DISTINCT block_id, label, COALESCE(label IN ({_LIST(CLASSES)}), FALSE) AS known FROM b""",
    "prompt_texts": """SELECT DISTINCT block_id, CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END AS short,
  CASE WHEN text IS NULL THEN 1 ELSE greatest(1, length(text) // 4) END AS tokens FROM blocks""",
    "picture_merge": """SELECT page_id, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY is_picture, idx, block_id) - 1 AS INTEGER) AS pos, block_id, is_picture
FROM (SELECT DISTINCT page_id, block_id, idx, COALESCE(is_picture, FALSE) AS is_picture FROM blocks)""",
    "picture_filter": """WITH b AS (SELECT page_id, block_id, is_picture, box[3] - box[1] AS width, box[4] - box[2] AS height, box[3] AS x2, box[4] AS y2 FROM blocks WHERE len(box) = 4),
e AS (SELECT page_id, MAX(x2) AS w, MAX(y2) AS h FROM b GROUP BY page_id)
SELECT DISTINCT b.page_id, block_id, width, height FROM b JOIN e ON e.page_id = b.page_id
WHERE is_picture AND width >= 40 AND height >= 40 AND CAST(width AS DOUBLE) * height <= 0.5 * w * h""",
    "usage_all_grains": f"WITH {_GRAINS} SELECT * FROM grains",
    "usage_retention": f"""WITH {_GRAINS},
r AS (SELECT grain, period, ROW_NUMBER() OVER (PARTITION BY grain ORDER BY period DESC) AS rn FROM (SELECT DISTINCT grain, period FROM grains))
SELECT g.* FROM grains g JOIN r ON r.grain = g.grain AND r.period = g.period
WHERE rn <= CASE g.grain WHEN 'day' THEN 30 WHEN 'week' THEN 10 WHEN 'month' THEN 3 ELSE 1 END""",
    "usage_recent": f"WITH {_LOG} SELECT request_id, ts, provider, ok, latency_ms FROM l ORDER BY ts DESC NULLS LAST, request_id DESC LIMIT 50",
    "usage_dashboard": f"""WITH {_LOG},
n AS (SELECT MAX({_PT}) AS now FROM usage_log),
t AS (SELECT strftime(now, '%Y-%m-%d') AS td, strftime(now - INTERVAL 1 DAY, '%Y-%m-%d') AS yd, strftime(now, '%G-W%V') AS tw, strftime(now, '%Y-%m') AS tm FROM n),
s AS (
  SELECT provider, {", ".join(f"COUNT(*) FILTER ({c}) AS {k}_requests, CAST(COALESCE(SUM(pages) FILTER ({c}), 0) AS BIGINT) AS {k}_pages" for k, c in _SPANS.items())},
    SUM(latency_ms) FILTER (d = td) AS latency FROM l, t GROUP BY provider
),
k(place, provider) AS (VALUES {", ".join(f"({i}, '{p}')" for i, p in enumerate(usage.PROVIDERS))})
SELECT k.place, k.provider, {", ".join(f"COALESCE({g}_{m}, 0) AS {g}_{m}" for g in _SPANS for m in ("requests", "pages"))},
  CASE WHEN COALESCE(today_requests, 0) = 0 THEN 0 ELSE ROUND(COALESCE(latency, 0) / today_requests, 1) END AS avg_latency
FROM k LEFT JOIN s ON s.provider = k.provider""",
    "stage_timing": f"""WITH {_LOG} SELECT provider AS stage, COUNT(*) AS runs, arg_max(latency_ms, request_id) AS last_seconds, ROUND(SUM(latency_ms), 3) AS total_seconds
FROM l WHERE provider IS NOT NULL AND latency_ms IS NOT NULL GROUP BY provider""",
    "detect_language": f"SELECT DISTINCT file, {_NAME} AS language FROM source_files",
    "language_groups": f"""WITH o AS (SELECT file, MAX(pages) AS pages FROM source_files GROUP BY file), n AS (SELECT {_NAME} AS language, file, pages FROM o)
SELECT language, COUNT(*) AS n_files, CAST(COALESCE(SUM(pages), 0) AS BIGINT) AS n_pages, MIN(file) AS first_file FROM n WHERE language <> 'unknown' GROUP BY language""",
    "resume_pending": r"""SELECT DISTINCT page_id, file, page_no FROM vision_results v
WHERE full_text IS NOT NULL AND regexp_matches(full_text, '\S') AND NOT EXISTS (SELECT 1 FROM page_annotations a WHERE a.page_id = v.page_id)""",
    "first_n_pages": "SELECT DISTINCT page_id, file, page_no FROM vision_results WHERE page_no <= 5",
    "batch_chunks": """SELECT page_id, file, page_no, (ROW_NUMBER() OVER (PARTITION BY file ORDER BY page_no, page_id) - 1) // 5 AS batch_no
FROM (SELECT DISTINCT page_id, file, page_no FROM vision_results)""",
    "run_summary": f"""WITH p AS (SELECT DISTINCT page_id, file FROM vision_results), j AS (
  SELECT {_NAME} AS language, EXISTS (SELECT 1 FROM page_annotations a WHERE a.page_id = p.page_id) AS done FROM p
) SELECT language, COUNT(*) AS pages, COUNT(*) FILTER (done) AS annotated, ROUND(COUNT(*) FILTER (done) / CAST(COUNT(*) AS DOUBLE), 6) AS share FROM j GROUP BY language""",
}
