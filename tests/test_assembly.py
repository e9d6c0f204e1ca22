"""Pages are put together where they are: what is shuffled are marks and digests, not words."""

from pyspark.sql import functions as F

from leafmill.operators import assembly, geometry, reading_order
from leafmill.plans import catalog, layout_queries

BOX = "x0 double, y0 double, x1 double, y1 double"
WORDS = f"doc_id string, page int, block_no int, line_no int, word_no int, text string, {BOX}, a double, b double"


def a_document(spark):
    """Six pages with a running head and foot, a note at the side, an upright stamp, a line that recurs, a grid, and what is odd."""
    words, drawings = [], []
    for page in range(1, 7):
        say = lambda block, line, said, x, y, turn=(1.0, 0.0): words.extend(("d", page, block, line, k, t, x + 30.0 * k, y, x + 30.0 * k + 8, y + 10, *turn) for k, t in enumerate(said))  # noqa: B023, E731
        say(0, 0, ["Head", str(page)], 100.0, 20.0)
        say(1, 0, ["Head", str(page)], 100.0, 300.0)
        say(2, 0, ["aside"], 5.0, 400.0)
        say(3, 0, ["Stamp"], 560.0, 300.0, (0.0, 1.0))
        say(4, 0, ["left", None], 100.0, 200.0), say(5, 0, ["right"], 330.0, 200.0), say(5, 1, ["below"], 330.0, 210.0)
        say(9, 0, ["Foot", "x"], 100.0, 770.0)
        if page == 2:
            words.append(("d", page, None, 0, 0, "no block", 60.0, 350.0, 90.0, 360.0, 1.0, 0.0))
            words.append(("d", page, 8, 0, 0, "no place", None, 350.0, 90.0, 360.0, 1.0, 0.0))
            drawings += [("d", page, "l", 100.0, 500.0 + 20 * k, 180.0, 500.0 + 20 * k) for k in range(3)] + [("d", page, "l", 100.0 + 40 * k, 500.0, 100.0 + 40 * k, 540.0) for k in range(3)]
            for k in range(4):
                say(20 + k, 0, [f"c{k}"], 105.0 + 40 * (k % 2), 505.0 + 20 * (k // 2))
    pages = spark.createDataFrame([("d", page, 612.0, 792.0) for page in range(1, 7)], "doc_id string, page int, width double, height double")
    return assembly.Scanned(pages, spark.createDataFrame(words, WORDS), None, spark.createDataFrame(drawings, f"doc_id string, page int, item string, {BOX}"))


def test_pages_with_their_words_are_put_together_like_rows(spark):
    scan = a_document(spark)
    held = assembly.Scanned(assembly.packed(scan))
    shown = lambda made: [sorted(map(str, frame.collect())) for frame in (made.units, made.blocks, made.warnings)]
    assert shown(assembly.assemble(held)) == shown(assembly.assemble(scan))
    blocks = assembly.assemble(held).blocks.where("page = 2").select("stage", "text", "rows").collect()
    by_stage = {b.stage: b for b in blocks}
    assert len(blocks) == 4 and by_stage["header"].text == "Head 2" and by_stage["footer"].text == "Foot x"
    assert by_stage["native_table"].rows == [["c0", "c1"], ["c2", "c3"]]
    # The second head is no running line; the stamp, the side note and what has no block or place are gone.
    assert sorted(filter(None, by_stage["text"].text.split("\n"))) == ["Head 2", "below", "left", "right"]


def test_words_are_not_shuffled(spark, monkeypatch):
    plans = []
    keep = assembly.cut

    def cut(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(frame)

    monkeypatch.setattr(assembly, "cut", cut)
    made = catalog.queries()["assembled_pages"](spark, "/root/testdata/sf0.001")
    plans.append(made._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 1 and not any("word_no" in line for plan in plans for line in plan.split("\n") if "Aggregate" in line or "Exchange" in line or "Sort " in line)


def test_pages_are_numbered_without_their_texts(spark):
    docs = spark.createDataFrame([("a", 5, "t5"), ("a", 3, "t3"), ("b", 4, "t4"), ("a", 9, "t9"), ("a", 5, "again")], "source string, doc_id long, text string")
    rows = layout_queries._numbered(docs)
    assert sorted((r.source, r.doc_id, r.page) for r in rows.collect()) == [("a", 3, 1), ("a", 5, 2), ("a", 5, 3), ("a", 9, 4), ("b", 4, 1)]
    windows = [line for line in rows.select(F.length("text"), "page")._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window" in line and "text" in line]
    assert all("source" in line and "[source" in line for line in windows)


def test_orders_are_pages_once(spark, monkeypatch):
    """No step reads the orders more than twice: pages come with their words and drawings, and markup is parsed once."""
    plans = []
    keep = assembly.cut

    def cut(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(frame)

    monkeypatch.setattr(assembly, "cut", cut)
    catalog.queries()["read_pages"](spark, "/root/testdata/sf0.001")
    assert len(plans) > 3 and max(plan.count("FileScan parquet") for plan in plans) <= 2


def test_words_become_texts_like_their_blocks(spark):
    words = a_document(spark).words
    blocks = geometry.blocks_of(words)
    want = reading_order.page_text(blocks, reading_order.reading_order(blocks))
    got = reading_order.word_texts(words)
    assert got.dtypes == want.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 6
    plan = catalog.queries()["page_texts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
