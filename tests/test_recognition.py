"""Detection maps, crops, batches, engines without weights, the visual model's store, formula regions, the roll-up."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill import cli
from leafmill.operators import detection, geometry, ocr, reading_order, report, visual
from leafmill.sources import parsers


def test_boxes_of_a_probability_map():
    chances = np.zeros((64, 128), np.float32)
    chances[10:20, 20:60], chances[30:42, 70:120], chances[50:52, 5:7], chances[55:62, 10:40] = 0.9, 0.8, 0.9, 0.4
    boxes = detection.in_rows(detection.text_boxes(chances, (640, 1280)))
    assert len(boxes) == 2  # the speck is too small, the pale one too unsure
    first = boxes[0]
    grow = 39 * 9 * 1.5 / (2 * (39 + 9))
    assert np.allclose(first, np.array([(20 - grow, 10 - grow), (59 + grow, 10 - grow), (59 + grow, 19 + grow), (20 - grow, 19 + grow)]) * 10, atol=0.5)
    tilted = np.zeros((100, 100), np.float32)
    for x in range(20, 80):
        tilted[x // 2 + 10 : x // 2 + 22, x] = 1.0
    (box,) = detection.text_boxes(tilted, (100, 100))
    assert box[1, 1] > box[0, 1] + 10 and len(detection.regions(np.array([[1, 0, 1], [0, 1, 0]]))) == 1
    assert detection.text_boxes(np.zeros((8, 8)), (8, 8)) == []


def test_crops():
    image = np.zeros((40, 100, 3), np.uint8)
    image[10:20, 30:70] = (200, 100, 50)
    piece = detection.crop(image, np.array([(30, 10), (70, 10), (70, 20), (30, 20)], float))
    assert piece.shape == (10, 40, 3) and np.allclose(piece[2:8, 2:38], (200, 100, 50))
    assert detection.crop(image, np.array([(30, 0), (35, 0), (35, 39), (30, 39)], float)).shape == (5, 39, 3)


def fake_engine():
    """Boxes around bright pixels, each read as the same two letters."""

    def read(image):
        boxes = detection.in_rows(detection.text_boxes((image[:, :, 0] > 0).astype(np.float32), image.shape[:2]))
        return [detection.Line(" ab ", 0.8, (*map(float, b.min(0)), *map(float, b.max(0)))) for b in boxes] + [detection.Line("unsure", 0.1, (0.0,) * 4), detection.Line(" ", 0.9, (0.0,) * 4)]

    return read


def no_engine():
    raise detection.Unavailable("no engine here")


def test_pictures_become_lines_or_reasons(spark):
    picture = np.zeros((96, 320, 3), np.uint8)
    picture[20:40, 20:120], picture[20:40, 180:300], picture[60:80, 20:300] = 255, 255, 255
    rows = [("d", 1, 0, 96, 320, picture.tobytes()), ("d", 1, 1, 96, 320, b"short"), ("d", 2, 0, 32, 32, bytes(3072))]
    frame = spark.createDataFrame([(*r[:5], bytearray(r[5])) for r in rows], "doc_id string, page int, image_no int, height int, width int, pixels binary")
    got = sorted(map(tuple, detection.recognize(frame, fake_engine).collect()), key=str)
    assert [(r[2], r[3], r[4]) for r in got if r[4]] == [(0, 0, "ab"), (0, 1, "ab"), (0, 2, "ab")] and got[0][5] == pytest.approx(0.8)
    assert len(got) == 4 and got[3][11] and got[0][6] < got[1][6] and got[2][7] > got[0][7]
    outcome = ocr.page_results(ocr.readable(detection.recognize(frame, fake_engine).where("error is null"))).first()
    assert outcome.text == "ab\nab\nab" and outcome.code == "OCR_APPLIED"
    assert [r.error for r in detection.recognize(frame, no_engine).collect()] == ["no engine here"] * 3


def test_visual_answers_are_kept(spark, tmp_path):
    pages = spark.createDataFrame([("d", 1, bytearray(b"p")), ("d", 2, bytearray(b"p")), ("d", 3, bytearray(b"q")), ("d", 4, None)], "doc_id string, page int, png binary")

    def engine():
        return lambda png, tokens, penalty: (f"read {png.decode()}", len(png) >= tokens)

    store = str(tmp_path / "store")
    first = visual.infer(pages.where("page < 3"), engine, store, "m", "go").collect()
    assert sorted((r.page, r.raw, r.capped, r.cached) for r in first) == [(1, "read p", False, False), (2, "read p", False, False)]
    again = visual.infer(pages, engine, store, "m", "go").collect()
    assert sorted((r.page, r.raw, r.cached) for r in again) == [(1, "read p", True), (2, "read p", True), (3, "read q", False)]
    assert spark.read.parquet(store).count() == 2 and not any(r.cached for r in visual.infer(pages, engine, store, "m", "other").collect())
    assert visual.host_failure(system="Linux", machine="x86_64") == "unsupported-platform (Linux/x86_64)" and visual.host_failure(False) == "disabled"
    assert visual.host_failure(system="Darwin", machine="arm64") is None and visual.host_failure(installed=False, system="Darwin", machine="arm64") == "missing-deps"
    every = spark.createDataFrame([("d", 1), ("d", 2)], "doc_id string, page int")
    assert visual.route(every.limit(1), every, False).count() == 0 and visual.route(every.where("page = 2"), every, True).first().page == 2 and visual.route(every, every, True, "all").count() == 2
    said = every.select(visual.trusted_text(F.lit("t"), F.col("page") == 1, F.lit(False)).alias("t")).collect()
    assert [r.t for r in said] == [None, "t"]


def test_the_store_is_read_by_prefix_written_only_for_new_answers_and_outlives_damage(spark, tmp_path):
    store = tmp_path / "store"
    pages = spark.createDataFrame([("d", k, bytearray(b"%d" % k)) for k in range(40)], "doc_id string, page int, png binary")

    def engine():
        return lambda png, tokens, penalty: (png.decode(), False)

    visual.infer(pages, engine, str(store), "m", "go").collect()
    files = {p: p.stat().st_mtime_ns for p in store.rglob("*.parquet")}
    folders = {p.name for p in store.iterdir() if p.is_dir()}
    assert len(files) == len(folders) > 20 and all(len(n) == len("prefix=") + visual.PREFIX for n in folders)
    assert all(r.cached for r in visual.infer(pages, engine, str(store), "m", "go").collect())
    assert {p: p.stat().st_mtime_ns for p in store.rglob("*.parquet")} == files
    ten = sorted(n.removeprefix("prefix=") for n in folders)[:10]
    plan = visual.kept_answers(spark, str(store), ten)._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "prefix" in plan.toString().split("PartitionFilters: [")[1]
    scan = next(leaf for leaf in (plan.collectLeaves().apply(k) for k in range(plan.collectLeaves().size())))
    assert scan.selectedPartitions().partitionCount() == 10
    next(iter(files)).write_bytes(b"damaged")
    got = visual.infer(pages, engine, str(store), "m", "go").collect()
    assert len(got) == 40 and all(r.raw == str(r.page) for r in got) and 0 < sum(not r.cached for r in got) < 10


def test_formula_regions_stamps_and_scores(spark):
    lines = [("d", 1, 0, 0, "x", "Arial", 0, 0, 10, 10), ("d", 1, 1, 0, "words of prose", "Arial", 0, 50, 90, 60), ("d", 1, 2, 0, "alpha beta", "Euclid Math", 14, 0, 30, 10), ("d", 1, 3, 0, "  ", "Symbol", 0, 90, 9, 99)]
    frame = spark.createDataFrame([(*r[:6], ["NKO"] if r[2] == 9 else [], *map(float, r[6:])) for r in lines], "doc_id string, page int, block_no int, line_no int, text string, font string, scripts array<string>, x0 double, y0 double, x1 double, y1 double")
    found = reading_order.formula_regions(frame)
    assert [tuple(r)[2:] for r in found.collect()] == [(0, 0.0, 0.0, 30.0, 10.0)]
    expected = spark.createDataFrame([("d", 1, 7, 0.0, 0.0, 15.0, 10.0), ("d", 2, 8, 0.0, 0.0, 1.0, 1.0)], "doc_id string, page int, formula_no int, x0 double, y0 double, x1 double, y1 double")
    assert {r.formula_no: (r.iou, r.covered) for r in reading_order.region_scores(expected, found).collect()} == {7: (0.5, 1.0), 8: (0.0, 0.0)}
    chars = frame.select("doc_id", "page", "text", "x0", "y0", "x1", "y1")
    boxes = spark.createDataFrame([("d", 1, 5.0, 5.0, 6.0, 6.0)], "doc_id string, page int, x0 double, y0 double, x1 double, y1 double")
    assert geometry.drop_inside(chars, boxes).count() == 3
    skew = spark.createDataFrame([(0.7, 0.7), (1.0, 0.0)], "a double, b double").select(geometry.is_skewed(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.s for r in skew] == [True, False]


def test_rollup_and_encoding(spark, tmp_path):
    rows = [("a.png", "OCR_UNAVAILABLE", None, "x", "no text"), ("a.png", "OCR_UNAVAILABLE", None, "x", "no text"), ("b.pdf", "VLM_APPLIED", 3, None, "read"), ("b.pdf", "VLM_UNAVAILABLE", None, "why", "n"), ("c.pdf", "OCR_APPLIED", None, None, "ok")]
    frame = spark.createDataFrame(rows, "filename string, code string, formulas int, detail string, note string")
    lines = [r.line for r in report.rollup_lines(frame).orderBy("ord", "line").collect()]
    assert lines[:5] == ["Recognition recovered text on 1 page(s).", "The visual model read 1 page(s), recovering 3 formula(s).", "The visual model is unavailable: why", "2 page(s) could not be extracted:", "  - a.png: no text"]
    assert len(lines) == 6 and report.rollup_lines(frame.limit(0)).count() == 0
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "j.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0" * 4 + b"IHDR" + (10).to_bytes(4, "big") * 2)
    assert cli.main(["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--log-file", str(tmp_path / "log")], spark) == 0
    assert "1 page(s) could not be extracted:" in (tmp_path / "log").read_text() and "  - j.png: no text extracted" in (tmp_path / "log").read_text()
    text, encoding, sure, warnings = parsers.load_text("straße über äöü, naïve façade".encode("cp1252"))
    assert len(text) == 29 and (encoding in ("ascii", "utf_8")) == (not warnings) and 0 <= sure <= 1
