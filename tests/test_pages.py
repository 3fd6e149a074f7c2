from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.operators import layout, validation

SCHEMA = (
    "ann_id long, image string, block_boxes array<array<int>>, block_classes array<string>, block_text array<string>, reading_order array<int>, "
    "block_relations array<struct<source:int,target:int,relation:string>>, annotation_quality string, bs_ string, f_ string"
)


def page(spark, *rows):
    full = [(i, *(r + (None,) * (9 - len(r)))) for i, r in enumerate(rows, 1)]
    return spark.createDataFrame(full, SCHEMA)


def boxes(spark, *lists):
    return page(spark, *[("p.jpg", b, ["Text"] * len(b), ["t"] * len(b)) for b in lists])


def orders(spark, *lists):
    out = {}
    for r in layout.reading_orders(boxes(spark, *lists)).orderBy("ann_id", "rank").collect():
        out.setdefault(r.ann_id, []).append(r.idx)
    return [out.get(i, []) for i in range(1, len(lists) + 1)]


SAMPLE = (
    "page_0001.jpg",
    [[100, 100, 500, 150], [100, 160, 500, 400], [100, 410, 500, 600], [600, 100, 900, 300], [600, 310, 900, 350]],
    ["Title", "Text", "Text", "Picture", "Caption"],
    ["A title", "Some text here", "More text here", "[NO_TEXT_IN_PICTURE]", "Figure 1"],
    [0, 1, 2, 3, 4],
    [(3, 4, "figure_has_caption"), (4, 3, "caption_of_figure")],
    "full_level4",
)


def test_known_orders(spark):
    cases = [
        [[100, 100, 500, 150], [100, 200, 500, 400], [100, 450, 500, 600]],
        [[100, 100, 400, 200], [100, 250, 400, 500], [450, 100, 800, 300], [450, 350, 800, 500]],
        [],
        [[0, 0, 100, 50], [200, 0, 300, 50], [0, 100, 100, 150]],
    ]
    assert orders(spark, *cases) == [[0, 1, 2], [0, 2, 1, 3], [], [0, 1, 2]]
    kinds = [r.layout for r in layout.layouts(boxes(spark, *cases)).orderBy("ann_id").collect()]
    assert kinds == ["single", "double", "single", "double"]


def plain_order(bs):
    if len(bs) < 3:
        layout_ = "single"
    else:
        c = sorted((b[0] + b[2]) / 2 for b in bs)
        layout_ = "single" if not any(y - x > 50 for x, y in zip(c, c[1:])) else "columns"
    if layout_ == "single":
        return sorted(range(len(bs)), key=lambda i: (bs[i][1], bs[i][0]))
    middle = max(b[2] for b in bs) / 2
    left = sorted([i for i in range(len(bs)) if (bs[i][0] + bs[i][2]) / 2 < middle], key=lambda i: bs[i][1])
    right = sorted([i for i in range(len(bs)) if i not in left], key=lambda i: bs[i][1])
    out = []
    while left or right:
        if left and (not right or bs[left[0]][1] <= bs[right[0]][1]):
            out.append(left.pop(0))
        else:
            out.append(right.pop(0))
    return out


point = st.integers(0, 300)
box = st.tuples(point, point, point, point).map(list)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(box, max_size=8), min_size=20, max_size=40))
def test_order_equals_two_pointer_merge(spark, pages):
    assert orders(spark, *pages) == [plain_order(p) for p in pages]


def edges(spark, bs, classes):
    rows = page(spark, ("p", bs, classes, [""] * len(bs)))
    return [(r.source, r.target, r.relation) for r in layout.relations(rows, layout.auto_edges(F.col("bs_"))).orderBy("pos").collect()]


def test_captions(spark):
    two = [[100, 100, 500, 300], [100, 310, 500, 350]]
    assert edges(spark, two, ["Picture", "Caption"]) == [(0, 1, "figure_has_caption"), (1, 0, "caption_of_figure")]
    assert edges(spark, two, ["Table", "Caption"]) == [(0, 1, "table_has_caption"), (1, 0, "caption_of_table")]
    assert edges(spark, two, ["Picture", "Text"]) == [] and edges(spark, [], []) == []
    # two captions as far away: the first; one caption for two tables; a caption above comes first in its own edge
    assert edges(spark, [[0, 100, 10, 110], [0, 80, 10, 90], [0, 120, 10, 130]], ["Table", "Caption", "Caption"])[0] == (1, 0, "caption_of_table")
    assert len(edges(spark, [[0, 0, 10, 10], [0, 20, 10, 30], [0, 40, 10, 50]], ["Table", "Table", "Caption"])) == 4


def test_footnote_goes_to_first_block_in_reach(spark):
    assert edges(spark, [[0, 0, 10, 10], [0, 12, 10, 20], [0, 100, 10, 110]], ["Text", "Text", "Footnote"]) == [(0, 2, "footnote_refers_to")]


def test_sample_page(spark):
    v = validation.validate(page(spark, SAMPLE)).first()
    assert (v.valid, v.level, v.class_count, v.diverse, v.n_warnings) == (True, 4, 5, True, 0)
    s = validation.score(page(spark, SAMPLE)).first()
    assert (s.ocr, s.layout, s.reading_order, s.boxes, s.relations, s.overall) == (100, 80, 100, 100, 100, 96)


def test_minimal_and_degenerate_pages(spark):
    rows = page(
        spark,
        ("a", [[0, 0, 100, 100]], ["Text"], ["Hello"]),
        ("b", [[100, 100, 200, 200]] * 2, ["Text"] * 2, ["A", "B"]),
        ("c", [], [], []),
        (None, [[0, 0, 100, 100]], ["Text"], ["x"]),
        ("e", [[100, 100, 500, 300], [200, 150, 400, 250], [100, 400, 500, 600]], ["Text"] * 3, ["a", "b", "c"]),
        ("f", [[1, 2, 3], None, [0, 0, 1, 1], [0, 0, 20, 25], [0, 30, 20, 54]], [None, "Nope", "Text", "Text", "Text"], [None, " ", "", " ", "x"]),
    )
    v = {r.ann_id: r for r in validation.validate(rows).collect()}
    assert v[2].duplicate_boxes == v[2].overlapping_boxes == "WARN" and v[2].valid and v[2].level == 3
    assert (v[3].valid, v[3].level, v[3].array_lengths, v[3].non_empty) == (False, 0, "PASS", "FAIL")
    assert (v[4].valid, v[4].required_fields, v[4].array_lengths) == (False, "FAIL", None)
    assert (v[6].boxes_valid, v[6].boxes_invalid, v[6].classes_invalid, v[6].empty_text) == (1, 4, 2, "WARN")
    s = {r.ann_id: r for r in validation.score(rows).collect()}
    assert tuple(s[1])[1:] == (100, 57, 0, 100, 0, 51)
    assert s[4].overall is None and s[6].ocr == 20
    over = [tuple(r) for r in layout.overlapping(rows).where("ann_id = 5").collect()]
    assert over == [(5, 0, 1, 20000.0)]


def test_order_status_is_the_last_fault(spark):
    four = [[0, 0, 50, 50]] * 4
    rows = page(spark, *[("p", four, ["Text"] * 4, ["a"] * 4, o, []) for o in ([0, 9, 1, 1], [1, 1, 0, 9], [0, 1], [0, 1, 2, None])])
    v = [r.reading_order for r in validation.validate(rows).orderBy("ann_id").collect()]
    assert v == ["WARN", "FAIL", "FAIL", "FAIL"]
    assert [r.reading_order for r in validation.score(rows).orderBy("ann_id").collect()] == [70, 70, 50, 80]


def test_percentages_are_cut_toward_zero(spark):
    rows = page(spark, ("p", [[0, 0, 50, 50]] * 50, ["Text"] * 50, [""] * 29 + ["x"] * 21))
    assert validation.score(rows).first().ocr == 43


def test_one_row_per_page_where_keys_repeat(spark):
    rows = page(spark, SAMPLE, SAMPLE).withColumn("ann_id", F.lit(7).cast("long"))
    assert validation.report(rows).first().pages == 2
    assert validation.best_pages(rows, 5).count() == 2


def test_overlay_labels_and_legend(spark):
    rows = page(spark, ("p", [[0, 0, 9, 9]] * 3, ["Title", None, "Odd"], ["a"] * 3, [2, 0]))
    out = [(r.color, r.label) for r in layout.overlay_boxes(rows).orderBy("idx").collect()]
    assert out == [("255,0,0", "[0] Title RO:2"), ("0,255,0", "[1] Text RO:0"), ("200,200,200", "[2] Odd")]
    assert [tuple(r)[1:] for r in layout.legend(rows).orderBy("pos").collect()] == [(0, "Odd", "200,200,200"), (1, "Title", "255,0,0")]


def test_missing_fields_of_one_page_and_of_several(spark):
    good = '{"image": 1, "block_boxes": [], "block_classes": [], "block_text": null}'
    texts = [good, '{"image": 1}', f'{{"pages": [{good}, {{}}, 3]}}', "[1]", "{", None, '{"pages": 1}']
    df = spark.createDataFrame(list(enumerate(texts)), "rec_id long, payload string")
    out = {(r.rec_id, r.page_pos): r.missing for r in validation.missing_fields(df, "rec_id", "payload").collect()}
    every = ",".join(validation.REQUIRED)
    assert out == {(0, 0): "", (1, 0): every[6:], (2, 0): "", (2, 1): every, (2, 2): every, (3, 0): "unreadable", (4, 0): "unreadable", (5, 0): "unreadable", (6, 0): every}


def test_empty_tables(spark):
    none = page(spark, SAMPLE).limit(0)
    for rows in (layout.reading_orders(none), layout.overlapping(none), validation.validate(none), validation.score(none), validation.page_findings(none)):
        assert rows.count() == 0
    assert validation.report(none).first().pages == 0
