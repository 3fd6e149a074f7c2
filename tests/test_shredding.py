import json

from folioframe.operators import shredding

SCHEMA = "rec_id long, payload string, v string, path string"


def frame(spark, payloads):
    return spark.createDataFrame([(i, p, "x", "y") for i, p in enumerate(payloads, 1)], SCHEMA)


def children(spark, payloads):
    return {tuple(r) for r in shredding.annotation_children(frame(spark, payloads)).collect()}


def test_layouts_of_one_page_and_of_several(spark):
    page = {"block_boxes": [[1, 2, 3, 4], {"x1": 1}], "block_relations": [{"source": 0, "target": None}, {"target": 1, "evidence": [{"from": "a"}]}]}
    checks = {"boxes": {"valid": 1, "invalid": None}, "order": "PASS", "none": None, "empty": "", "hollow": {}}
    out = children(
        spark,
        [
            json.dumps(page),
            json.dumps({"version": 2, "pages": [{"block_boxes": []}, {**page, "block_relations": json.dumps(page["block_relations"])}]}),
            json.dumps({"block_boxes": [[0, 0, 1, 1]], "validation": {"checks": checks}}),
            json.dumps({"pages": [{"validation_results": {"checks": checks}}]}),
        ],
    )
    both = {("box", "0", -1, -1), ("box", "1", -1, -1), ("relation", "0", 0, -1), ("relation", "1", -1, 1)}
    marks = {("check", "boxes.valid", -1, -1), ("check", "order", -1, -1)}
    assert {r[2:] for r in out if r[:2] == (1, 0)} == both
    assert {r[2:] for r in out if r[:2] == (2, 1)} == both and not {r for r in out if r[:2] == (2, 0)}
    assert {r[2:] for r in out if r[0] == 3} == marks | {("box", "0", -1, -1)}
    assert {r[2:] for r in out if r[0] == 4} == marks


def test_unreadable_null_and_empty(spark):
    assert children(spark, [None, "", "{bad", '{"block_boxes": [[1]]} and more', "[1", "7"]) == set()
    assert shredding.annotation_children(frame(spark, [None]).limit(0)).columns[0] == "rec_id"


def test_repeated_records_keep_their_keys(spark):
    text = '{"block_boxes": [[1, 2, 3, 4]]}'
    assert children(spark, [text, text]) == {(1, 0, "box", "0", -1, -1), (2, 0, "box", "0", -1, -1)}


def test_tables_and_foreign_keys(spark):
    rows = frame(spark, [json.dumps({"a": {"b": 1, "c": "x"}, "kids": [{"name": "k", "toys": [1, 2]}], "other": {"toys": [3]}})])
    tables = shredding.shred(rows, "rec_id", "payload")
    assert set(tables) >= {"record", "kids", "toys"}
    assert tables["record"].select("`a.b`", "`a.c`").first() == (1, "x")
    toys = {(r.parent_table, tuple(r.parent_path), r.pos, r.value) for r in tables["toys"].collect()}
    assert toys == {("kids", (0,), 0, 1), ("kids", (0,), 1, 2), ("record", (), 0, 3)}


def test_recursive_elements_share_one_table(spark):
    rows = frame(spark, [json.dumps({"node": {"id": 1, "node": {"id": 2, "node": {"id": 3}}}})])
    out = shredding.shred(rows, "rec_id", "payload")
    assert {r.id for r in out["node"].collect()} == {1, 2, 3}


def test_relations_find_their_blocks(spark):
    text = json.dumps({"block_boxes": [[1], [2]], "block_relations": [{"source": 0, "target": 5}, {"source": 1, "target": 0}]})
    rows = shredding.relation_blocks(frame(spark, [text])).orderBy("relation_pos").collect()
    assert [(r.source_found, r.target_found) for r in rows] == [(True, False), (True, True)]
