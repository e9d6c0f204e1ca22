"""Operators on small tables: repairs, trees, page order, awkward rows."""

import pytest
from pyspark.sql import functions as F

from leafmill import runtime
from leafmill.functions import text
from leafmill.operators import chrome, metrics, reading_order
from leafmill.sources import parsers


def test_repair_of_every_kind_of_misread_text(spark):
    rows = ["naïve café — “quoted” • 😀 ok", "plain ascii", "a\r\nb\rc\x07", "", None, "Preț: 5 € – ½", "déjà vu", "Â", "â€"]
    bad = [r.encode().decode("cp1252", "replace") if r and all(b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) for b in r.encode()) and not r.isascii() else r for r in rows]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate([*rows, "cafÃ© â€œsoâ€™ naÃ¯ve", "ï»¿begin", "Ã\x89tude", "ðŸ˜€", *bad[:1]])], "i int, t string")
    got = [r.t for r in frame.select("i", text.repair(F.col("t")).alias("t")).orderBy("i").collect()]
    assert got[:2] == rows[:2] and got[2] == "a\nb\nc" and got[3] == "" and got[4] is None and got[6:9] == rows[6:9]
    assert got[9:13] == ["café “so’ naïve", "begin", "Étude", "😀"]


def test_xml_leaves_and_mixed_text():
    shown = parsers.xml_lines(parsers.safe_tree(b'<r xmlns:n="u"><e/><f n:k="2"/><m k="1">txt<c>x</c> tail </m></r>'))
    assert shown == ["r:", "  e", '  f {u}k="2"', '  m k="1":', "    txt", "    c: x", "    tail"]


def test_page_order_of_banners_ties_and_gaps(spark):
    boxes = [("d", 1, 1, 0.0, 0.0, 100.0, 5.0), ("d", 1, 2, 0.0, 9.0, 100.0, 14.0), ("d", 2, 1, 0.0, 0.0, 40.0, 5.0), ("d", 2, 2, 60.0, 0.0, 100.0, 5.0), ("d", 2, 3, 0.0, 9.0, 40.0, 14.0), ("d", 2, 4, None, 9.0, 40.0, 14.0)]
    frame = spark.createDataFrame(boxes, "doc_id string, page int, block_no int, x0 double, y0 double, x1 double, y1 double")
    got = {(r.page, r.block_no): (r.ord, r.columns, r.concurrent) for r in reading_order.reading_order(frame).collect()}
    assert got == {(1, 1): (1, 1, False), (1, 2): (2, 1, False), (2, 1): (1, 2, True), (2, 3): (2, 2, True), (2, 2): (3, 2, True)}
    many = spark.range(30_000).selectExpr("cast(id div 3 as string) doc_id", "1 page", "cast(id % 3 as int) block_no", "0.0D x0", "cast(id % 3 as double) * 20 y0", "9.0D x1", "cast(id % 3 as double) * 20 + 9 y1")
    assert reading_order.reading_order(many).where("ord = block_no + 1 and columns = 1").count() == 30_000
    assert reading_order.group_figures(many).count() == 30_000 and reading_order.group_figures(many.withColumn("y0", F.lit(0.0))).count() == 10_000
    assert reading_order.reading_order(frame.limit(0)).count() == 0


def test_leaks_phrases_and_rotated_pages(spark):
    blocks = spark.createDataFrame([("a", "Page One of x"), ("a", "nothing"), ("b", "page")], "doc_id string, text string")
    patterns = spark.createDataFrame([("a", "page"), ("a", "PAGE"), ("a", "one"), ("c", "x")], "doc_id string, pattern string")
    assert {r.doc_id: r.leaks for r in metrics.leakage(blocks, patterns).collect()} == {"a": 3, "b": 0}
    texts = spark.createDataFrame([(1, "alpha beta"), (2, "gamma")], "doc_id int, text string")
    phrases = spark.createDataFrame([(1, "beta"), (1, "delta")], "doc_id int, phrase string")
    assert {r.doc_id: r.retention for r in metrics.phrase_retention(texts, phrases).collect()} == {1: 0.5, 2: 1.0}
    rotated = spark.createDataFrame([("d", 2, "zz"), ("d", 1, "b"), ("d", 1, "a"), ("e", 1, "")], "doc_id string, page int, text string")
    assert [tuple(r) for r in chrome.rotated_text_report(rotated).collect()] == [("d", 2, 4, "a")]


def test_shared_folder_is_demanded_off_this_machine():
    class Context:
        master = "spark://elsewhere:7077"
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda key: None)}))
        getCheckpointDir = staticmethod(lambda: None)

    session = type("S", (), {"sparkContext": Context, "conf": type("C", (), {"get": staticmethod(lambda key, default=None: default)})})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(session)
