import importlib.util
import json
import types
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioframe import session
from folioframe.operators import images
from folioframe.sources import documents
from folioframe.streaming import flows

PAGE = {"image": "p1.jpg", "block_boxes": [[0, 0, 100, 100]], "block_classes": ["Text"], "block_text": ["नमस्ते"]}


def test_annotation_files_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps(PAGE), encoding="utf-8")
    (tmp_path / "in/b.json").write_text("{bad", encoding="utf-8")
    files = documents.annotation_files(spark, str(tmp_path / "in"))
    rows = documents.annotations_of(files)
    assert {r.file_name: r.image for r in rows.collect()} == {"a.json": "p1.jpg", "b.json": None}
    good = rows.where("image is not null").drop("file_name")
    documents.write_annotations(good.withColumn("lang", F.lit("hi")), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.first().block_text == ["नमस्ते"] and back.first().lang == "hi"
    path = documents.write_zip(good, str(tmp_path / "x.zip"), "hindi")
    assert zipfile.ZipFile(path).namelist() == ["hindi/p1.json"]
    report = documents.write_html(good.agg(F.count(F.lit(1)).alias("<n>")), good.select("image"), str(tmp_path / "r.html"))
    assert "&lt;n&gt;" in report.read_text()


def test_metrics_and_images(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"stage":"a","seconds":1.5}\nbad\n{"event":"x"}\n')
    assert [(r.stage, r.seconds) for r in documents.metrics(spark, str(tmp_path / "m.jsonl")).collect()] == [("a", 1.5)]
    (tmp_path / "i.jpg").write_bytes(bytes(range(200)))
    data = documents.base64_images(documents.images(spark, str(tmp_path))).first().data
    assert "\n" not in data and len(data) == 268
    called = documents.called(spark.range(7), lambda f: f.assign(n=len(f)), "id long, n long", batch=3)
    assert sorted(r.n for r in called.collect())[-1] <= 3 and called.count() == 7


def test_stored_tables_are_dropped(spark):
    rows = session.stored(spark.range(5), "numbers")
    assert rows.count() == 5 and session.drop_stored(spark) >= 1 and session.drop_stored(spark) == 0
    fresh = types.SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(types.SimpleNamespace(sparkContext=fresh, conf={}))


def test_kernels():
    page = np.full((200, 300), 255, np.uint8)
    page[50:120, 60:160] = 30
    assert len(images.picture_regions(page, [])) == 1 and images.picture_regions(page, [(60, 50, 160, 120)]) == []
    out = images.prepared(page, ("denoise", "nothing", "enhance", "threshold"))
    assert out.shape == page.shape and set(np.unique(out)) <= {0, 255}
    assert images.deskew(np.full((20, 20), 255, np.uint8)).shape == (20, 20)


def test_images_as_rows(spark):
    page = np.full((200, 300), 255, np.uint8)
    page[50:120, 60:160] = 30
    grey = b"P5\n# scan\n300 200\n255\n" + page.tobytes()
    colour = b"P6 2 1 255\n" + bytes([255, 0, 0, 0, 0, 255])
    rows = spark.createDataFrame([("a", grey, [[60, 50, 160, 120]]), ("b", grey, None), ("c", colour, []), ("d", b"no image", []), ("e", None, None)], "path string, content binary, text_boxes array<array<int>>")
    read = images.decoded(rows).join(rows.select("path", "text_boxes"), "path")
    out = {r.path: r for r in read.collect()}
    assert bytes(out["a"].pixels) == page.tobytes() and list(out["c"].pixels) == [76, 29] and out["d"].pixels is None and out["e"].height is None
    ready = {r.path: r.pixels for r in images.prepared_images(read, steps=("threshold",)).collect()}
    assert set(ready["b"]) <= {0, 255} and ready["d"] is None
    found = {(r.path, r.pos) for r in images.regions(read).collect()}
    assert found == {("b", 0)}


def test_page_counts_and_answers(spark, tmp_path):
    pdf = b"%PDF-1.4 1 0 obj <</Type /Pages /Kids [2 0 R 3 0 R]>> <</Type /Page>> <</Type/Page >>"
    rows = spark.createDataFrame([("a", pdf), ("b", b"x"), ("c", None)], "path string, content binary")
    assert {tuple(r) for r in documents.page_counts(rows.where("path <> 'a'")).collect()} == {("b", None), ("c", None)}
    assert {r.pages for r in documents.page_counts(rows.where("path <> 'a'"), 0).collect()} == {0}
    if importlib.util.find_spec("fitz") is None:
        assert documents.page_counts(rows.where("path = 'a'")).first().pages == 2
    files = spark.createDataFrame([("b.json", '{"x": 1}'), ("a.json", '{"_file": 0, "y": null}'), ("c.json", "{"), ("d.json", None)], "file_name string, payload string")
    assert [json.loads(r.json) for r in documents.responses(files).collect()] == [{"_file": "a.json", "y": None}, {"_file": "b.json", "x": 1}]
    assert documents.usage_state(spark, str(tmp_path / "none"), "n int").count() == 0
    (tmp_path / "u.jsonl").write_text('{"n": 1}\n{bad\n')
    assert [r.n for r in documents.usage_state(spark, str(tmp_path / "u.jsonl"), "n int").collect()] == [1]
    documents.zip_folder(str(tmp_path), str(tmp_path / "all.zip"))
    assert zipfile.ZipFile(tmp_path / "all.zip").namelist() == ["u.jsonl"]


def test_streams(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(PAGE))
    for n in (1, 2):
        rows = flows.validated(flows.annotation_stream(spark, str(folder)))
        flows.run_available(rows, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n
        (folder / "b.json").write_text("{bad")
    events = spark.range(10).select(F.col("id").alias("request_id"), F.lit("2025-01-01 00:10:00").cast("timestamp").alias("ts"), F.lit("vision").alias("provider"), F.lit(True).alias("ok"), F.lit(1).alias("pages"))
    events.union(events).write.parquet(str(tmp_path / "u"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "u"))
    query = flows.usage_windows(stream).writeStream.format("memory").queryName("usage_w").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("usage_w").first().requests == 10


def test_stages_of_streamed_logs(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs/a.log").write_text("[1/5] Rendering\n[2/5] OCR: page_1\np1.json: PASS\np2.json: FAIL")
    states = flows.running_stages(flows.log_stream(spark, str(tmp_path / "logs")))
    for n in (1, 2):
        query = states.writeStream.format("memory").queryName(f"states_{n}").outputMode("complete").option("checkpointLocation", str(tmp_path / f"c{n}")).trigger(availableNow=True).start()
        query.awaitTermination()
        (tmp_path / "logs/b.log").write_text("nothing yet")
    assert [tuple(r) for r in spark.table("states_1").collect()] == [("a.log", 2, "OCR", 1, 1)]
    assert {r.file_name: r.step for r in spark.table("states_2").collect()} == {"a.log": 2, "b.log": None}
