"""Queries over annotated pages: geometry, relations and overlays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.operators import layout
from folioframe.sources.tables import table


def _annotations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "page_annotations")


def doubled(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as a merge that went wrong leaves them: all boxes twice, the first half moved by a pixel and the last box as it is, with all texts
    twice. Every page has overlaps, a repeated box and repeated texts."""
    moved = F.transform("block_boxes", lambda b, i: F.when(i < F.size("block_boxes") - 1, F.transform(b, lambda v: v + 1)).otherwise(b))
    again = {"block_boxes": F.concat("block_boxes", moved), **{c: F.concat(c, c) for c in ("block_classes", "block_text")}}
    return _annotations(spark, folder).withColumns(again)


def _edges(edges: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: layout.relations(_annotations(spark, folder), edges(F.col("bs_")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "geometry_order": lambda s, d: layout.reading_orders(_annotations(s, d)),
    "column_layout": lambda s, d: layout.layouts(_annotations(s, d)),
    "order_arbitration": lambda s, d: layout.order_choice(_annotations(s, d)),
    "caption_relations": _edges(lambda b: F.concat(layout.caption_edges(b, "Table"), layout.caption_edges(b, "Picture"))),
    "footnote_relations": _edges(layout.footnote_edges),
    "auto_relations": lambda s, d: layout.filled_relations(_annotations(s, d)),
    "overlap_pairs": lambda s, d: layout.overlapping(doubled(s, d)),
    "duplicate_text": lambda s, d: layout.repeated_texts(doubled(s, d)),
    "duplicate_boxes": lambda s, d: layout.repeated_boxes(doubled(s, d)),
    "overlay_boxes": lambda s, d: layout.overlay_boxes(_annotations(s, d)),
    "overlay_legend": lambda s, d: layout.legend(_annotations(s, d)),
    "overlay_order_arrows": lambda s, d: layout.order_arrows(_annotations(s, d)),
    "overlay_relation_arrows": lambda s, d: layout.relation_arrows(_annotations(s, d)),
}

BLOCKS = """blk AS (
  SELECT ann_id, CAST(i AS INTEGER) AS idx, block_boxes[i + 1] AS box, block_classes[i + 1] AS cls, block_text[i + 1] AS txt
  FROM (SELECT *, unnest(range(len(block_boxes))) AS i FROM page_annotations WHERE block_boxes IS NOT NULL)
),
g AS (
  SELECT ann_id, idx, cls, txt, CAST(box[1] AS DOUBLE) AS x1, CAST(box[2] AS DOUBLE) AS y1, CAST(box[3] AS DOUBLE) AS x2, CAST(box[4] AS DOUBLE) AS y2
  FROM blk WHERE len(box) >= 4 AND box[1] IS NOT NULL AND box[2] IS NOT NULL AND box[3] IS NOT NULL AND box[4] IS NOT NULL
)"""
_LAYOUT = """gap AS (
  SELECT ann_id, (x1 + x2) / 2 - LAG((x1 + x2) / 2) OVER (PARTITION BY ann_id ORDER BY (x1 + x2) / 2, idx) AS d FROM g
),
lay AS (
  SELECT p.ann_id, CAST(COALESCE(n, 0) AS INTEGER) AS n_blocks,
    CASE WHEN COALESCE(n, 0) < 3 OR COALESCE(w, 0) = 0 THEN 'single' WHEN w = 1 THEN 'double' ELSE 'multi' END AS layout
  FROM (SELECT ann_id FROM page_annotations WHERE block_boxes IS NOT NULL) p
  LEFT JOIN (SELECT ann_id, COUNT(*) AS n FROM g GROUP BY ann_id) c ON c.ann_id = p.ann_id
  LEFT JOIN (SELECT ann_id, COUNT(*) AS w FROM gap WHERE d > 50 GROUP BY ann_id) w ON w.ann_id = p.ann_id
)"""
_ORDER = f"""{BLOCKS}, {_LAYOUT},
side AS (
  SELECT g.*, layout, CASE WHEN layout = 'single' THEN x1 WHEN (x1 + x2) / 2 < MAX(x2) OVER (PARTITION BY g.ann_id) / 2 THEN 0 ELSE 1 END AS tie
  FROM g JOIN lay ON lay.ann_id = g.ann_id
),
ord AS (SELECT ann_id, idx, CAST(ROW_NUMBER() OVER (PARTITION BY ann_id ORDER BY y1, tie, idx) - 1 AS INTEGER) AS rank FROM side)"""


def _captions(label: str, has: str, of: str, first: int) -> str:
    return f"""
  SELECT ann_id, {first} AS kind, t AS obj, CASE WHEN below THEN p ELSE 1 - p END AS p,
    CASE WHEN p = 0 THEN t ELSE c END AS source, CASE WHEN p = 0 THEN c ELSE t END AS target,
    CASE WHEN p = 0 THEN '{has}' ELSE '{of}' END AS relation
  FROM (
    SELECT t.ann_id, t.idx AS t, c.idx AS c, c.y1 > t.y1 AS below,
      ROW_NUMBER() OVER (PARTITION BY t.ann_id, t.idx ORDER BY ABS((c.y1 + c.y2) / 2 - (t.y1 + t.y2) / 2), c.idx) AS rn
    FROM g t JOIN g c ON c.ann_id = t.ann_id AND c.cls = 'Caption' AND least(t.x2, c.x2) - greatest(t.x1, c.x1) > 0
    WHERE t.cls = '{label}'
  ), (VALUES (0), (1)) v(p) WHERE rn = 1"""


_CAPTION_EDGES = _captions("Table", "table_has_caption", "caption_of_table", 0) + " UNION ALL " + _captions("Picture", "figure_has_caption", "caption_of_figure", 1)
_FOOT_EDGES = """
  SELECT f.ann_id, 2 AS kind, f.idx AS obj, 0 AS p, MIN(t.idx) AS source, f.idx AS target, 'footnote_refers_to' AS relation
  FROM g f JOIN g t ON t.ann_id = f.ann_id AND t.cls IS DISTINCT FROM 'Footnote' AND t.y1 < f.y1
    AND ABS((t.y1 + t.y2) / 2 - (f.y1 - t.y2)) < 200 AND least(t.x2, f.x2) - greatest(t.x1, f.x1) > 0
  WHERE f.cls = 'Footnote' GROUP BY f.ann_id, f.idx"""
_NUMBERED = "SELECT ann_id, CAST(ROW_NUMBER() OVER (PARTITION BY ann_id ORDER BY kind, obj, p) - 1 AS INTEGER) AS pos, source, target, relation"

_ARROW = """CAST(trunc((a.x1 + a.x2) / 2) AS INTEGER) AS x1, CAST(trunc((a.y1 + a.y2) / 2) AS INTEGER) AS y1,
  CAST(trunc((b.x1 + b.x2) / 2) AS INTEGER) AS x2, CAST(trunc((b.y1 + b.y2) / 2) AS INTEGER) AS y2"""
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}\x{{1c}}-\x{{1f}}\x{{0b}}\x{{85}}]+|[\s\p{{Z}}\x{{1c}}-\x{{1f}}\x{{0b}}\x{{85}}]+$', '', 'g')"


# Pages doubled as in ``doubled``.
DOUBLED = """doubled AS (
  SELECT * REPLACE (
    list_concat(block_boxes, list_transform(range(1, len(block_boxes) + 1), lambda i: CASE WHEN i < len(block_boxes) THEN list_transform(block_boxes[i], lambda v: v + 1) ELSE block_boxes[i] END)) AS block_boxes,
    list_concat(block_classes, block_classes) AS block_classes, list_concat(block_text, block_text) AS block_text
  ) FROM page_annotations
)"""


def on_doubled(sql: str) -> str:
    """``sql`` over the doubled pages."""
    return f"WITH {DOUBLED}, " + sql.removeprefix("WITH ").replace("page_annotations", "doubled")


def stripped(column: str) -> str:
    """SQL that strips Unicode white space at both ends."""
    return _STRIP.format(column)


ORACLES: dict[str, str] = {
    "geometry_order": f"WITH {_ORDER} SELECT ann_id, idx, rank FROM ord",
    "column_layout": f"WITH {BLOCKS}, {_LAYOUT} SELECT ann_id, n_blocks, layout FROM lay",
    "order_arbitration": f"""WITH {_ORDER},
geo AS (SELECT ann_id, list(idx ORDER BY rank) AS o FROM ord GROUP BY ann_id),
j AS (SELECT p.ann_id, reading_order AS r, o FROM page_annotations p LEFT JOIN geo ON geo.ann_id = p.ann_id WHERE block_boxes IS NOT NULL),
s AS (
  SELECT ann_id, CASE WHEN len(o) > 0 AND len(r) = len(o)
    THEN ROUND(len(list_filter(range(1, len(o) + 1), lambda k: r[k] = o[k])) / CAST(len(o) AS DOUBLE), 6) ELSE 0 END AS agree FROM j
)
SELECT ann_id, CAST(agree AS DOUBLE) AS agree, CASE WHEN agree >= 0.8 THEN 'stored' ELSE 'geometry' END AS source FROM s""",
    "caption_relations": f"WITH {BLOCKS} {_NUMBERED} FROM ({_CAPTION_EDGES})",
    "footnote_relations": f"WITH {BLOCKS} {_NUMBERED} FROM ({_FOOT_EDGES})",
    "auto_relations": f"""WITH {BLOCKS}, auto AS ({_NUMBERED} FROM ({_CAPTION_EDGES} UNION ALL {_FOOT_EDGES})),
held AS (SELECT ann_id, COALESCE(len(block_relations), 0) AS n, block_relations AS r FROM page_annotations WHERE block_boxes IS NOT NULL)
SELECT ann_id, CAST(i AS INTEGER) AS pos, r[i + 1].source AS source, r[i + 1].target AS target, r[i + 1].relation AS relation
FROM (SELECT *, unnest(range(n)) AS i FROM held)
UNION ALL SELECT a.* FROM auto a JOIN held h ON h.ann_id = a.ann_id WHERE h.n = 0""",
    "overlap_pairs": on_doubled(f"""WITH {BLOCKS}, o AS (
  SELECT a.ann_id, a.idx AS a, b.idx AS b,
    greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS area,
    least((a.x2 - a.x1) * (a.y2 - a.y1), (b.x2 - b.x1) * (b.y2 - b.y1)) AS small
  FROM g a JOIN g b ON a.ann_id = b.ann_id AND a.idx < b.idx
) SELECT ann_id, a, b, CAST(area AS DOUBLE) AS area FROM o WHERE area > 0.5 * small AND area > 0"""),
    "duplicate_text": on_doubled(f"""WITH t AS (
  SELECT ann_id, CAST(i AS INTEGER) AS idx, lower({stripped("block_text[i + 1]")}) AS k
  FROM (SELECT *, unnest(range(len(block_text))) AS i FROM page_annotations WHERE block_text IS NOT NULL)
), l AS (SELECT ann_id, idx, LAG(idx) OVER (PARTITION BY ann_id, k ORDER BY idx) AS earlier, k FROM t WHERE k IS NOT NULL)
SELECT ann_id, idx, earlier FROM l WHERE earlier IS NOT NULL AND length(k) > 10"""),
    "duplicate_boxes": on_doubled(f"""WITH {BLOCKS}
SELECT ann_id, idx FROM (SELECT ann_id, idx, ROW_NUMBER() OVER (PARTITION BY ann_id, CAST(box AS VARCHAR) ORDER BY idx) AS rn FROM blk) WHERE rn > 1"""),
    "overlay_boxes": f"""WITH {BLOCKS}, c(cls, color) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in layout.COLORS.items())})
SELECT g.ann_id, g.idx, x1, y1, x2, y2, COALESCE(c.color, '200,200,200') AS color,
  '[' || g.idx || '] ' || COALESCE(g.cls, 'Text') || CASE WHEN g.idx < len(p.reading_order) THEN ' RO:' || COALESCE(CAST(p.reading_order[g.idx + 1] AS VARCHAR), 'None') ELSE '' END AS label
FROM g JOIN page_annotations p ON p.ann_id = g.ann_id LEFT JOIN c ON c.cls = COALESCE(g.cls, 'Text')""",
    "overlay_legend": f"""WITH c(cls, color) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in layout.COLORS.items())}),
u AS (SELECT DISTINCT ann_id, cls FROM (SELECT ann_id, unnest(block_classes) AS cls FROM page_annotations) WHERE cls IS NOT NULL)
SELECT ann_id, CAST(ROW_NUMBER() OVER (PARTITION BY ann_id ORDER BY u.cls) - 1 AS INTEGER) AS pos, u.cls AS class, COALESCE(color, '200,200,200') AS color
FROM u LEFT JOIN c ON c.cls = u.cls""",
    "overlay_order_arrows": f"""WITH {BLOCKS}, s AS (
  SELECT ann_id, CAST(i AS INTEGER) AS pos, reading_order[i + 1] AS f, reading_order[i + 2] AS t
  FROM (SELECT *, unnest(range(greatest(len(reading_order) - 1, 0))) AS i FROM page_annotations WHERE reading_order IS NOT NULL)
) SELECT s.ann_id, pos, a.idx AS from_idx, b.idx AS to_idx, {_ARROW}
FROM s JOIN g a ON a.ann_id = s.ann_id AND a.idx = s.f JOIN g b ON b.ann_id = s.ann_id AND b.idx = s.t""",
    "overlay_relation_arrows": f"""WITH {BLOCKS}, s AS (
  SELECT ann_id, CAST(i AS INTEGER) AS pos, block_relations[i + 1] AS r
  FROM (SELECT *, unnest(range(len(block_relations))) AS i FROM page_annotations WHERE block_relations IS NOT NULL)
) SELECT s.ann_id, pos, a.idx AS from_idx, b.idx AS to_idx, s.r.relation AS relation, {_ARROW}
FROM s JOIN g a ON a.ann_id = s.ann_id AND a.idx = s.r.source JOIN g b ON b.ann_id = s.ann_id AND b.idx = s.r.target""",
}
