from pyspark.sql import functions as F

from folioframe.operators import stages


def test_pictures_of_pages(spark):
    infos = spark.createDataFrame(
        [(1, 100.0, 100.0, [0.25, 0.0, 50.25, 50.0], "x"), (1, 100.0, 100.0, [0.0, 0.0, 100.0, 51.0], "x"), (2, 100.0, 100.0, [0.0, 0.0, 19.0, 50.0], "x"), (3, 100.0, 100.0, None, "x"), (3, None, None, [0.0, None, 1.0, 1.0], "x")],
        "page_id long, page_w double, page_h double, bbox array<double>, box string",
    )
    boxes = stages.picture_boxes(infos, dpi=144)
    assert [tuple(r) for r in boxes.collect()] == [(1, [0, 0, 100, 100])]  # 0.5 and 100.5 go to the even neighbour
    pages = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "a")], "page_id long, source string")
    regions = spark.createDataFrame([(1, [9]), (2, [1, 2, 3, 4])], "page_id long, box array<int>")
    out = {(r.page_id, r.source) for r in stages.first_found(pages, boxes, regions).collect()}
    assert out == {(1, "embedded"), (2, "region"), (3, None)}


def test_small_expressions(spark):
    one = spark.createDataFrame([("[b]x[/b] [ok", [-5, 3, 900, 10])], "t string, box array<int>")
    assert one.select(stages.without_markup(F.col("t")), stages.clipped(F.col("box"), F.lit(100), F.lit(50))).first()[:] == ("x [ok", [0, 3, 100, 10])
    hints = spark.createDataFrame([("odia",), ("klingon",), (None,)], "l string").select(stages.language_hint(F.col("l"))).collect()
    assert [r[0] for r in hints] == [["or"], None, None]
    files = spark.createDataFrame([("a.PDF", None), ("b.txt", 3), ("a.PDF", 7), (None, 2)], "file string, pages int")
    assert [r.file for r in stages.accepted(files).select("file").distinct().collect()] == ["a.PDF"] and stages.accepted(files, level=5).count() == 0
    assert stages.estimated_pages(files, 5).first()[0] == 5 + 3 + 2 and stages.estimated_pages(files, 0).first()[0] == 12 and stages.estimated_pages(files.limit(0), 3).first()[0] == 0


def test_prompts_and_fallback(spark):
    own = spark.createDataFrame([(2, 0, [[0, 0, 1, 1]], ["b" * 200], 7), (1, 0, [[0, 0, 1, 1]], ['say "a"'], 7)], "id long, page_pos int, boxes array<array<int>>, texts array<string>, batch long")
    out = stages.prompts(own, "batch", "id", 10).first()
    assert out.n_pages == 2 and out.prompt.index('say \\"a\\"') < out.prompt.index("b" * 10 + "...") and "Footnote" in out.prompt
    pages = spark.createDataFrame([(1, "not JSON"), (2, None)], "id long, error string")
    assert [(r.id, r.classes) for r in stages.fallback_pages(pages, own).collect()] == [(1, ["Text"])]


def test_totals_and_states(spark):
    use = spark.createDataFrame([("a", 2, 0), ("b", 0, 0)], "provider string, n long, pages long")
    assert {tuple(r) for r in stages.with_total(use, "provider").collect()} == {("a", 2, 0), ("b", 0, 0), ("total", 2, 0)}
    assert [r.provider for r in stages.active(use, ["n", "pages"]).collect()] == ["a"]
    events = spark.createDataFrame([("r", 1, 1), ("r", 9, 2), ("r", 4, 3)], "file_name string, line_no int, step int")
    assert {(r.step, r.state) for r in stages.stage_states(events, 3).collect()} == {(1, "done"), (2, "active"), (3, "pending")}
    pages = spark.createDataFrame([(1, "x_hindi.pdf"), (2, "x_hindi.pdf"), (1, "x_hindi.pdf"), (3, None)], "page_id long, file string")
    verdicts = spark.createDataFrame([(1, True), (1, False), (2, False)], "page_id long, valid boolean")
    log = spark.createDataFrame([(1, "x_hindi.pdf", 4.0), (1, "x_hindi.pdf", 4.0), (2, "y_hindi.pdf", None)], "request_id long, file string, latency_ms double")
    stats = stages.language_stats(pages, verdicts, log)
    assert {tuple(r) for r in stats.collect()} == {("hindi", 1, 2, 1, 1, 50.0, 2.0), ("unknown", 0, 1, 0, 1, 0.0, 0.0)}
    assert tuple(stages.run_totals(stats).first()) == (1, 3, 1, 2, 33.3333) and tuple(stages.run_totals(stats.limit(0)).first()) == (0, 0, 0, 0, 0.0)
