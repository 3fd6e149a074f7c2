"""Queries over checks and scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioframe.operators import validation
from folioframe.operators.layout import CLASSES, RELATIONS
from folioframe.plans.pages import BLOCKS, doubled, on_doubled, stripped
from folioframe.sources.tables import table


def _on(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(table(spark, folder, "page_annotations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "page_findings": _on(lambda a: validation.page_findings(a).drop("pos")),
    "doubled_findings": lambda s, d: validation.page_findings(doubled(s, d)).drop("pos"),
    "validate_pages": _on(validation.validate),
    "score_pages": _on(validation.score),
    "report_summary": _on(validation.report),
    "check_totals": _on(validation.check_totals),
    "best_n_sample": _on(lambda a: validation.best_pages(a, 50)),
    "missing_fields": lambda s, d: validation.missing_fields(table(s, d, "annotation_records"), "rec_id", "payload"),
}

_LIST = lambda names: ", ".join(f"'{x}'" for x in names)
_BLANK = lambda x: f"COALESCE({stripped(x)} = '', TRUE)"
_FINDINGS = f"""{BLOCKS},
p AS (
  SELECT *, image IS NOT NULL AND block_boxes IS NOT NULL AND block_classes IS NOT NULL AND block_text IS NOT NULL AS parts,
    len(block_boxes) AS n, reading_order IS NOT NULL AND block_relations IS NOT NULL AS l4,
    len(list_filter(block_text, lambda t: {_BLANK("t")})) AS n_empty
  FROM page_annotations
),
q AS (SELECT * FROM p WHERE parts AND n > 0),
bx AS (
  SELECT q.ann_id, idx, box,
    CASE WHEN box IS NULL OR len(box) <> 4 OR len(list_filter(box, lambda v: v IS NOT NULL)) <> 4 THEN 'length'
      WHEN NOT (box[3] > box[1] AND box[4] > box[2]) THEN 'degenerate' WHEN list_max(box) <= 1 THEN 'normalized'
      WHEN (CAST(box[3] AS DOUBLE) - box[1]) * (CAST(box[4] AS DOUBLE) - box[2]) < 500 THEN 'small' ELSE 'valid' END AS st
  FROM q JOIN blk ON blk.ann_id = q.ann_id
),
cl AS (SELECT ann_id, CAST(i AS INTEGER) AS idx, block_classes[i + 1] AS c FROM (SELECT *, unnest(range(len(block_classes))) AS i FROM q)),
tx AS (SELECT ann_id, CAST(i AS INTEGER) AS idx, lower({stripped("block_text[i + 1]")}) AS k FROM (SELECT *, unnest(range(len(block_text))) AS i FROM q)),
ro AS (
  SELECT ann_id, n, CAST(i AS INTEGER) AS idx, reading_order[i + 1] AS v, list_position(reading_order, reading_order[i + 1]) - 1 < i AS again
  FROM (SELECT *, unnest(range(len(reading_order))) AS i FROM q WHERE l4 AND len(reading_order) = n)
),
rl AS (
  SELECT ann_id, idx, CASE WHEN r.source IS NULL OR r.target IS NULL OR r.relation IS NULL THEN 'missing'
      WHEN r.source < 0 OR r.source >= n OR r.target < 0 OR r.target >= n THEN 'range' WHEN r.source = r.target THEN 'self'
      WHEN r.relation NOT IN ({_LIST(RELATIONS)}) THEN 'type' ELSE 'valid' END AS st, r
  FROM (SELECT ann_id, n, CAST(i AS INTEGER) AS idx, block_relations[i + 1] AS r
        FROM (SELECT *, unnest(range(len(block_relations))) AS i FROM q WHERE l4 AND len(reading_order) = n))
),
ov AS (
  SELECT a.ann_id, a.idx FROM g a JOIN g b ON a.ann_id = b.ann_id AND a.idx < b.idx JOIN q ON q.ann_id = a.ann_id
  WHERE least(a.x2, b.x2) > greatest(a.x1, b.x1) AND least(a.y2, b.y2) > greatest(a.y1, b.y1)
    AND (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1))
      > 0.5 * least((a.x2 - a.x1) * (a.y2 - a.y1), (b.x2 - b.x1) * (b.y2 - b.y1))
),
f AS (
  SELECT ann_id, 'required_fields' AS "check", 'error' AS severity, -1 AS idx FROM p WHERE NOT parts
  UNION ALL SELECT ann_id, 'array_lengths', 'error', -1 FROM p WHERE parts AND len(block_classes) <> n
  UNION ALL SELECT ann_id, 'array_lengths', 'error', -1 FROM p WHERE parts AND len(block_text) <> n
  UNION ALL SELECT ann_id, 'non_empty', 'error', -1 FROM p WHERE parts AND n = 0
  UNION ALL SELECT ann_id, 'boxes', CASE WHEN st = 'small' THEN 'warning' ELSE 'error' END, idx FROM bx WHERE st <> 'valid'
  UNION ALL SELECT ann_id, 'classes', 'error', idx FROM cl WHERE c IS NULL OR c NOT IN ({_LIST(CLASSES)})
  UNION ALL SELECT ann_id, 'duplicate_boxes', 'warning', idx FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ann_id, CAST(box AS VARCHAR) ORDER BY idx) AS rn FROM bx) WHERE rn > 1
  UNION ALL SELECT ann_id, 'overlapping_boxes', 'warning', idx FROM ov
  UNION ALL SELECT ann_id, 'duplicate_text', 'warning', idx FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ann_id, k ORDER BY idx) AS rn FROM tx WHERE k IS NOT NULL) WHERE rn > 1 AND length(k) > 10
  UNION ALL SELECT ann_id, 'empty_text', CASE WHEN n_empty = n THEN 'error' ELSE 'warning' END, -1 FROM q WHERE n_empty = n OR n_empty > n * 0.5
  UNION ALL SELECT ann_id, 'reading_order_length', 'error', -1 FROM q WHERE l4 AND len(reading_order) <> n
  UNION ALL SELECT ann_id, 'reading_order', CASE WHEN v IS NULL OR v < 0 OR v >= n THEN 'error' ELSE 'warning' END, idx FROM ro WHERE v IS NULL OR v < 0 OR v >= n OR again
  UNION ALL SELECT ann_id, 'relations', CASE WHEN st = 'type' THEN 'warning' ELSE 'error' END, idx FROM rl WHERE st <> 'valid'
  UNION ALL SELECT cl.ann_id, CASE WHEN c = 'Table' THEN 'table_captions' ELSE 'figure_captions' END, 'warning', cl.idx
    FROM cl JOIN q ON q.ann_id = cl.ann_id AND l4 AND len(reading_order) = n
    WHERE c IN ('Table', 'Picture') AND NOT EXISTS (SELECT 1 FROM rl WHERE rl.ann_id = cl.ann_id AND (rl.r.source = cl.idx OR rl.r.target = cl.idx))
)"""
_SCORE = f"""s AS (
  SELECT ann_id, parts, n, l4, greatest(n, 1) AS m, n_empty, len(list_distinct(block_classes)) AS d, reading_order AS o,
    len(COALESCE(block_relations, [])) AS nr,
    len(list_filter(o, lambda v: v < 0 OR v >= n)) AS outside, len(o) - len(list_distinct(o)) AS again,
    len(list_filter(COALESCE(block_relations, []), lambda r: r.source >= 0 AND r.source < n AND r.target >= 0 AND r.target < n AND r.relation IN ({_LIST(RELATIONS)}))) AS good,
    len(list_filter(block_boxes, lambda b: b IS NULL OR len(b) <> 4 OR NOT (b[3] > b[1] AND b[4] > b[2]) OR list_max(b) <= 1)) AS bad
  FROM p
),
sc AS (
  SELECT ann_id,
    CASE WHEN parts THEN greatest(0, 100 - CAST(trunc(n_empty / CAST(m AS DOUBLE) * 100) AS INTEGER)) END AS ocr,
    CASE WHEN parts THEN least(100, CAST(trunc(d / CAST(13 AS DOUBLE) * 100) AS INTEGER) + 50) END AS layout,
    CASE WHEN parts THEN CASE WHEN l4 THEN greatest(0, 100 - 10 * (CASE WHEN len(o) <> n THEN 5 ELSE 0 END + 2 * outside + again)) ELSE 0 END END AS reading_order,
    CASE WHEN parts THEN greatest(0, 100 - CAST(trunc(bad / CAST(m AS DOUBLE) * 100) AS INTEGER)) END AS boxes,
    CASE WHEN parts THEN CASE WHEN n > 0 AND nr > 0 THEN CAST(trunc(good / CAST(nr AS DOUBLE) * 100) AS INTEGER) WHEN n > 0 AND l4 THEN 100 ELSE 0 END END AS relations
  FROM s
),
score AS (SELECT *, CAST(trunc((ocr + layout + reading_order + boxes + relations) / CAST(5 AS DOUBLE)) AS INTEGER) AS overall FROM sc)"""
_COUNT = lambda check, total: (
    f"CASE WHEN {total[1]} THEN {total[0]} - COALESCE(k.{check}, 0) END AS {check}_valid, CASE WHEN {total[1]} THEN COALESCE(k.{check}, 0) END AS {check}_invalid"
)
_STATUS = lambda check, seen: (
    f"CASE WHEN {seen} THEN CASE WHEN COALESCE(k.e_{check}, 0) > 0 THEN 'FAIL' WHEN COALESCE(k.w_{check}, 0) > 0 THEN 'WARN' ELSE 'PASS' END END AS {check}"
)
_NAMED = ("array_lengths", "non_empty", "duplicate_boxes", "overlapping_boxes", "duplicate_text", "empty_text", "table_captions", "figure_captions")
_LOOKED, _INNER = "p.parts AND p.n > 0", "p.parts AND p.n > 0 AND p.l4 AND len(p.reading_order) = p.n"
_VALIDATE = f"""{_FINDINGS},
k AS (
  SELECT ann_id, COUNT(*) FILTER (severity = 'error') AS errors, COUNT(*) FILTER (severity = 'warning') AS warnings,
    {", ".join(f"COUNT(*) FILTER (\"check\" = '{c}') AS {c}" for c in ("boxes", "classes", "relations"))},
    {", ".join(f"COUNT(*) FILTER (\"check\" = '{c}' AND severity = 'error') AS e_{c}, COUNT(*) FILTER (\"check\" = '{c}' AND severity = 'warning') AS w_{c}" for c in _NAMED)},
    COUNT(*) FILTER ("check" = 'reading_order_length') AS wrong_length, arg_max(severity, idx) FILTER ("check" = 'reading_order') AS last_order
  FROM f GROUP BY ann_id
),
val AS (
  SELECT p.ann_id, COALESCE(k.errors, 0) = 0 AS valid, COALESCE(k.errors, 0) AS n_errors, COALESCE(k.warnings, 0) AS n_warnings,
    CASE WHEN {_LOOKED} THEN CASE WHEN p.l4 THEN 4 ELSE 3 END ELSE 0 END AS level,
    CASE WHEN {_LOOKED} THEN CAST(p.n AS INTEGER) ELSE 0 END AS class_count,
    CASE WHEN {_LOOKED} THEN len(list_distinct(block_classes)) > 1 END AS diverse,
    CASE WHEN p.parts THEN 'PASS' ELSE 'FAIL' END AS required_fields,
    {_STATUS("array_lengths", "p.parts")}, {_STATUS("non_empty", "p.parts")},
    {_COUNT("boxes", ("len(p.block_boxes)", _LOOKED))}, {_COUNT("classes", ("len(p.block_classes)", _LOOKED))},
    {", ".join(_STATUS(c, _LOOKED) for c in _NAMED[2:6])},
    CASE WHEN {_LOOKED} THEN CASE WHEN NOT p.l4 THEN 'N/A' WHEN COALESCE(k.wrong_length, 0) > 0 THEN 'FAIL' WHEN k.last_order IS NULL THEN 'PASS'
      WHEN k.last_order = 'error' THEN 'FAIL' ELSE 'WARN' END END AS reading_order,
    {_COUNT("relations", ("len(p.block_relations)", _INNER))},
    {", ".join(_STATUS(c, _INNER) for c in _NAMED[6:])}
  FROM p LEFT JOIN k ON k.ann_id = p.ann_id
)"""
_TOTAL_STATUS = ("required_fields", *_NAMED[:6], "reading_order", *_NAMED[6:])

ORACLES: dict[str, str] = {
    "page_findings": f"WITH {_FINDINGS} SELECT * FROM f",
    "doubled_findings": on_doubled(f"WITH {_FINDINGS} SELECT * FROM f"),
    "validate_pages": f"WITH {_VALIDATE} SELECT * FROM val",
    "score_pages": f"WITH {_FINDINGS}, {_SCORE} SELECT * FROM score",
    "report_summary": f"""WITH {_VALIDATE}, {_SCORE}
SELECT COUNT(*) AS pages, COUNT(*) FILTER (valid) AS passed, {", ".join(f"COALESCE(CAST(trunc(AVG(score.{c})) AS INTEGER), 0) AS avg_{c}" for c in (*validation.SCORES, "overall"))}
FROM val JOIN score ON score.ann_id = val.ann_id""",
    "check_totals": f"WITH {_VALIDATE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", CAST(COALESCE(SUM({c}_valid), 0) AS BIGINT) AS n_valid, CAST(COALESCE(SUM({c}_valid + {c}_invalid), 0) AS BIGINT) AS n_total FROM val"
        for c in ("boxes", "classes", "relations")
    )
    + "".join(
        f" UNION ALL SELECT '{c}', COUNT(*) FILTER ({c} = 'PASS'), COUNT(*) FILTER ({c} IN ('PASS', 'WARN', 'FAIL')) FROM val" for c in _TOTAL_STATUS
    ),
    "best_n_sample": f"""WITH {_VALIDATE}
SELECT val.ann_id, COALESCE(diverse, FALSE) AS diverse, class_count, image FROM val JOIN page_annotations a ON a.ann_id = val.ann_id
ORDER BY COALESCE(diverse, FALSE) DESC, class_count DESC, image, val.ann_id LIMIT 50""",
    "missing_fields": f"""WITH v AS (SELECT rec_id, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM annotation_records),
r AS (SELECT rec_id, j, COALESCE(json_type(j) = 'OBJECT', FALSE) AS whole, COALESCE(json_type(j, '$.pages') = 'ARRAY', FALSE) AS several FROM v),
p AS (
  SELECT rec_id, whole, 0 AS page_pos, j AS page FROM r WHERE NOT (whole AND several)
  UNION ALL SELECT rec_id, whole, CAST(i AS INTEGER), json_extract(j, '$.pages[' || i || ']')
  FROM (SELECT *, unnest(range(CAST(json_array_length(j, '$.pages') AS BIGINT))) AS i FROM r WHERE whole AND several)
)
SELECT rec_id, page_pos, CASE WHEN NOT whole THEN 'unreadable' ELSE
  array_to_string(list_filter([{_LIST(validation.REQUIRED)}], lambda x: NOT list_contains(CASE WHEN json_type(page) = 'OBJECT' THEN json_keys(page) ELSE [] END, x)), ',') END AS missing FROM p""",
}
