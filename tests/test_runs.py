import datetime as dt
import json

from folioframe.operators import files, logs, replies, usage
from folioframe.operators.ranking import positions


def test_objects_in_replies():
    good = '{"pages": [{"block_classes": ["Text"], "block_text": ["a } b"]}]}'
    assert json.loads(replies.object_in(good)[0])
    for text in (f"```json\n{good}\n```", f"Sure.\n{good}\nDone {{", "\U0001f4ad { hm ✨" + good, good + "```"):
        assert replies.object_in(text) == (good, None)
    assert replies.object_in('{"a": [1,\n]}') == ('{"a": [1]}', None)
    assert replies.object_in('{"a": ["x" "y"]}') == ('{"a": ["x", "y"]}', None)
    assert [replies.object_in(t)[1] for t in (None, "", "none", "{", '{"a" 1}')] == ["null reply", "no object", "no object", "unmatched brace", "not JSON"]


REPLY = "result_id long, raw_text string, provider string, classes string"


def parsed(spark, replies_, blocks=None, **options):
    rows = spark.createDataFrame([(i, t if t is None or isinstance(t, str) else json.dumps(t), p, "x") for i, t, p in replies_], REPLY)
    own = None
    if blocks is not None:
        own = spark.createDataFrame(blocks, "id long, page_pos int, boxes array<array<int>>, texts array<string>, pictures array<boolean>, classes string")
    return {(r.id, r.page_pos): r for r in replies.pages(rows, own, **options).collect()}


def test_reply_pages(spark):
    page = {"block_classes": ["Page-number", "Text", "Text"], "block_text": ["1", "[NO_TEXT_IN_PICTURE]", None], "page_order": [3, 1, 2], "block_relations": [{"source": 0, "target": 1, "relation": "x"}]}
    out = parsed(
        spark,
        [
            (1, {"pages": [page, {"block_classes": ["Text"], "block_text": []}]}, "gemini"),
            (2, {"block_classes": ["Text"], "reading_order": [5]}, "groq"),
            (3, None, "groq"),
            (4, "no json", None),
            (5, {"pages": []}, "glm"),
            (6, {"pages": [page, {"block_classes": ["Bad"]}]}, "glm"),
            (7, {"pages": [{"block_classes": []}]}, "glm"),
        ],
    )
    first = out[1, 0]
    assert (first.order, first.order_source, first.classes, first.texts) == ([2, 0, 1], "given", ["Text", "Page-header", "Picture"], ["", "1", "[NO_TEXT_IN_PICTURE]"])
    assert first.quality == "full_level4" and out[1, 1].texts == [""] and first.boxes == [[0] * 4] * 3
    assert (out[2, 0].order, out[2, 0].order_source, out[2, 0].quality) == ([0], "default", "degraded_text_only_fallback")
    errors = {i: r.error for (i, pos), r in out.items() if pos is None}
    assert errors == {3: "null reply", 4: "no object", 5: "page count", 6: "unknown label"} and out[7, 0].n_blocks == 0


def test_replies_against_recognised_blocks(spark):
    boxes = [[0, 200, 100, 300], [0, 0, 20, 20], [0, 100, 100, 150]]
    own = [(i, 0, boxes, ["low", "top", "middle"], [False, False, True], "x") for i in range(1, 7)] + [(7, 0, None, None, None, "x")]
    three = ["Text"] * 3
    out = parsed(
        spark,
        [
            (1, {"pages": [{"block_classes": ["Title"], "block_text": [" ", "new"], "page_order": [0, 0, 0]}]}, "glm"),
            (2, {"pages": [{"block_classes": [*three, "Bad"], "block_text": ["a"], "block_boxes": [[1, 1, 9, 9]] * 3, "page_order": [1, 2, 3]}]}, "glm"),
            (3, {"pages": [{"block_classes": ["Picture"] * 3, "block_text": ["t"] * 3}]}, "glm"),
            (4, {"pages": [{"block_classes": three, "page_order": [], "reading_order": []}]}, "glm"),
            (5, {"pages": [{"block_classes": three}, {"block_classes": three}]}, "glm"),
            (6, {"block_classes": three, "block_boxes": [[1, 1, 9, 9]] * 3}, "glm"),
            (7, {"block_classes": ["Text"], "block_text": ["x"]}, "glm"),
        ],
        own,
        expected=1,
    )
    # labels and texts fitted, blank texts from the blocks, a bad order replaced by the geometric one
    assert (out[1, 0].order, out[1, 0].order_source, out[1, 0].texts, out[1, 0].classes) == ([1, 2, 0], "geometry", ["new", "middle", "low"], ["Text", "Text", "Title"])
    assert (out[2, 0].order, out[2, 0].texts, out[2, 0].boxes[0]) == ([0, 1, 2], ["a", "top", "middle"], [1, 1, 9, 9])
    assert out[3, 0].classes == ["Picture", "Text", "Picture"] and out[3, 0].order_source == "default"
    assert out[4, 0].order_source == "geometry" and out[5, None].error == "page count"
    assert out[6, 0].boxes == boxes and out[7, 0].boxes == [[0] * 4]
    low = parsed(spark, [(1, {"block_classes": three}, "glm")], own, level=3)[1, 0]
    assert low.order is None and low.relations is None and low.quality is None


def test_provider_text(spark):
    gem, other = json.dumps({"candidates": [{"content": {"parts": [{"text": "a"}]}}]}), json.dumps({"choices": [{"message": {"content": "b"}}]})
    rows = spark.createDataFrame([(gem, "gemini"), (other, "glm"), ("{}", "glm"), (None, None)], "response string, provider string")
    assert [r[0] for r in rows.select(replies.provider_text(rows.response, rows.provider)).collect()] == ["a", "b", None, None]


def test_recognition_tree(spark):
    symbol = lambda t, b=None: {"text": t, **({"property": {"detectedBreak": {"type": b}}} if b else {})}
    words = [{"symbols": [symbol("a"), symbol("b", "SPACE")]}, {"symbols": [symbol("c", "LINE_BREAK")]}, {"symbols": []}]
    para = {"boundingBox": {"vertices": [{"x": 5, "y": 7}, {"y": 9}, {"x": 8}]}, "words": words}
    tree = {"responses": [{"fullTextAnnotation": {"pages": [{"blocks": [{"paragraphs": [para, {"words": [{"symbols": [symbol(" ")]}]}]}]}]}}]}
    rows = spark.createDataFrame([(1, json.dumps(tree)), (2, json.dumps({"responses": [{"error": "x"}]})), (3, None), (4, "{")], "id long, payload string")
    assert [tuple(r) for r in replies.ocr_blocks(rows, "id", "payload").collect()] == [(1, 0, 0, 0, 0, 0, 8, 9, "ab c")]


LOG = "request_id long, ts timestamp_ntz, provider string, ok boolean, latency_ms double, retries int, pages int, images int, input_tokens int, output_tokens int, day string"


def log(spark, *rows):
    return spark.createDataFrame([(i, *r, 0, 1, 1, None, None, "x") for i, r in enumerate(rows, 1)], LOG)


def test_periods_follow_the_zone(spark):
    at = dt.datetime
    rows = log(
        spark,
        (at(2021, 1, 4, 7, 59), "vision", True, 10.0),  # still Sunday 3 January, ISO week 53 of 2020
        (at(2021, 1, 4, 8, 0), "vision", False, None),
        (at(2021, 7, 1, 6, 59), None, None, 0.0),
    )
    out = {(r.grain, r.period, r.provider): r for r in usage.periods(rows.union(rows)).collect()}
    assert out["day", "2021-01-03", "vision"].requests == 1
    assert out["week", "2020-W53", "vision"].success == 1 and out["week", "2021-W01", "vision"].failures == 1
    assert out["month", "2021-06", None].failures == 1
    assert (out["lifetime", "all", "vision"].requests, out["lifetime", "all", "vision"].latency_ms) == (2, 10.0)
    kept = {r.period for r in usage.retained(usage.periods(rows), 1, 1, 1).where("grain = 'day'").collect()}
    assert kept == {"2021-06-30"}


def test_dashboard_of_an_empty_log(spark):
    rows = usage.dashboard(log(spark, (dt.datetime(2021, 1, 1), "vision", True, 1.0)).limit(0)).collect()
    assert len(rows) == len(usage.PROVIDERS) and all(r.lifetime_requests == 0 and r.avg_latency == 0 for r in rows)


def test_positions_in_a_hot_group(spark):
    rows = spark.createDataFrame([("a" if i % 3 else None, i, "z") for i in range(300)], "g string, v int, part_x string").repartition(7)
    out = positions(rows, ["g"], ["v"]).collect()
    for g in ("a", None):
        mine = sorted((r.v, r.position) for r in out if r.g == g)
        assert [p for _, p in mine] == list(range(len(mine)))


def test_files(spark):
    names = [("Bhougalika_1.pdf", 3), ("a_hindi.pdf", None), ("a_hindi.pdf", 4), ("x.pdf", 1), (None, 2)]
    rows = spark.createDataFrame(names, "file string, pages int")
    out = {r.language: (r.n_files, r.n_pages) for r in files.language_groups(rows).collect()}
    assert out == {"odia": (1, 3), "hindi": (1, 4)}
    pages = spark.createDataFrame([(i, "f", i, "t" if i % 2 else " ") for i in range(1, 8)], "page_id long, file string, page_no int, full_text string")
    done = spark.createDataFrame([(1,), (1,)], "page_id long")
    assert {r.page_id for r in files.pending(pages, done).collect()} == {3, 5, 7}
    assert [r.batch_no for r in files.batches(pages, 3).orderBy("page_no").collect()] == [0, 0, 0, 1, 1, 1, 2]
    assert files.first_pages(pages, 2).count() == 2 and files.first_pages(pages, 0).count() == 7


def test_log_events(spark):
    text = ["[1/5] Rendering", "[2/5] OCR: page_0001", "p1.json: PASS", "p2.json: FAIL", "  total: 9s", "Timing summary:", "  vision_ocr: 1.5s", "  total: 4s"]
    rows = spark.createDataFrame([("run", i, t) for i, t in enumerate(text)], "file_name string, line_no int, line string")
    assert [(r.step, r.page) for r in logs.step_events(rows).orderBy("line_no").collect()] == [(1, ""), (2, "page_0001")]
    assert tuple(logs.outcomes(rows).first()) == ("run", 1, 1)
    assert {(r.stage, r.seconds) for r in logs.timings(rows).collect()} == {("vision_ocr", 1.5), ("total", 4.0)}
