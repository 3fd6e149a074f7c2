"""Queries of problem 1: nested annotation records as flat tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.operators import shredding
from folioframe.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return shredding.annotation_children(table(spark, folder, "annotation_records"))


def p1_relations(spark: SparkSession, folder: str) -> DataFrame:
    return shredding.relation_blocks(table(spark, folder, "annotation_records"))


def p1_linked(spark: SparkSession, folder: str) -> DataFrame:
    """Relations with the image of the page they lie on, found through the foreign key of the relation table."""
    tables = shredding.annotation_tables(table(spark, folder, "annotation_records"))
    links = tables["block_relations"].select(F.col("rec").alias("rec_id"), "parent_table", "parent_path", "pos", F.col("relation").cast("string").alias("relation"))
    parents = [tables[t].select(F.col("rec").alias("rec_id"), F.lit(t).alias("parent_table"), F.col("path").alias("parent_path"), F.col("image").cast("string").alias("image")) for t in ("record", "pages") if "image" in tables.get(t, links).columns]
    pages = parents[0]
    for more in parents[1:]:
        pages = pages.unionByName(more)
    joined = links.join(pages, ["rec_id", "parent_table", "parent_path"], "left")
    return joined.select("rec_id", F.coalesce(F.get("parent_path", F.lit(0)), F.lit(0)).alias("page_pos"), F.col("pos").cast("int").alias("relation_pos"), "relation", "image")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p1_relations": p1_relations, "p1_linked": p1_linked}

_PAGES = """
rec AS (SELECT rec_id, CAST(payload AS JSON) AS j FROM annotation_records WHERE payload IS NOT NULL AND json_valid(payload)),
page AS (
  SELECT rec_id, 0 AS page_pos, j FROM rec WHERE json_type(j, '$.pages') IS DISTINCT FROM 'ARRAY'
  UNION ALL
  SELECT rec_id, CAST(i AS INTEGER), json_extract(j, '$.pages[' || i || ']')
  FROM (SELECT rec_id, j, unnest(range(CAST(json_array_length(j, '$.pages') AS BIGINT))) AS i FROM rec WHERE json_type(j, '$.pages') = 'ARRAY')
),
rel_list AS (
  SELECT rec_id, page_pos,
    CASE WHEN json_type(j, '$.block_relations') = 'VARCHAR' THEN CAST(json_extract_string(j, '$.block_relations') AS JSON)
         ELSE json_extract(j, '$.block_relations') END AS r
  FROM page
),
rel AS (
  SELECT rec_id, page_pos, i AS pos, json_extract(r, '$[' || i || ']') AS e
  FROM (SELECT *, unnest(range(CAST(json_array_length(r) AS BIGINT))) AS i FROM rel_list WHERE json_type(r) = 'ARRAY')
),
box AS (
  SELECT rec_id, page_pos, unnest(range(CAST(json_array_length(j, '$.block_boxes') AS BIGINT))) AS pos FROM page
  WHERE json_type(j, '$.block_boxes') = 'ARRAY'
)"""

_ENDS = """COALESCE(TRY_CAST(json_extract_string(e, '$.source') AS INTEGER), -1) AS source_idx,
  COALESCE(TRY_CAST(json_extract_string(e, '$.target') AS INTEGER), -1) AS target_idx"""

ORACLES: dict[str, str] = {
    "p1_found": f"""WITH {_PAGES},
chk AS (
  SELECT rec_id, page_pos, COALESCE(json_extract(j, '$.validation_results.checks'), json_extract(j, '$.validation.checks')) AS c FROM page
),
one AS (
  SELECT rec_id, page_pos, k, json_extract(c, '$."' || k || '"') AS x
  FROM (SELECT *, unnest(json_keys(c)) AS k FROM chk WHERE json_type(c) = 'OBJECT')
),
leaf AS (
  SELECT rec_id, page_pos, k AS item_key, CAST(x AS VARCHAR) AS s FROM one WHERE json_type(x) <> 'OBJECT'
  UNION ALL
  SELECT rec_id, page_pos, k || '.' || k2, CAST(json_extract(x, '$."' || k2 || '"') AS VARCHAR)
  FROM (SELECT *, unnest(json_keys(x)) AS k2 FROM one WHERE json_type(x) = 'OBJECT')
)
SELECT rec_id, page_pos, 'box' AS child, CAST(pos AS VARCHAR) AS item_key, -1 AS source_idx, -1 AS target_idx FROM box
UNION ALL SELECT rec_id, page_pos, 'relation', CAST(pos AS VARCHAR), {_ENDS} FROM rel
UNION ALL SELECT rec_id, page_pos, 'check', item_key, -1, -1 FROM leaf WHERE s NOT IN ('null', '""', '[]', '{{}}')""",
    "p1_linked": f"""WITH {_PAGES} SELECT rel.rec_id, rel.page_pos, CAST(pos AS INTEGER) AS relation_pos, json_extract_string(e, '$.relation') AS relation,
  json_extract_string(j, '$.image') AS image FROM rel JOIN page ON page.rec_id = rel.rec_id AND page.page_pos = rel.page_pos""",
    "p1_relations": f"""WITH {_PAGES},
n AS (SELECT rec_id, page_pos, COUNT(*) AS n_boxes FROM box GROUP BY ALL),
r AS (SELECT rec_id, page_pos, CAST(pos AS INTEGER) AS relation_pos, {_ENDS} FROM rel)
SELECT r.rec_id, r.page_pos, relation_pos, source_idx, target_idx,
  source_idx >= 0 AND source_idx < COALESCE(n_boxes, 0) AS source_found,
  target_idx >= 0 AND target_idx < COALESCE(n_boxes, 0) AS target_found
FROM r LEFT JOIN n ON n.rec_id = r.rec_id AND n.page_pos = r.page_pos""",
}
