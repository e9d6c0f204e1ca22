"""Queries against their SQL on small tables of the cases that the driver's smallest lack."""

import duckdb
import pandas as pd

from leafmill.operators import diacritics
from leafmill.plans import catalog
from tests.test_queries import shown


def same_as_sql(spark, folder, name, **tables):
    connection = duckdb.connect()
    for table, frame in tables.items():
        frame.to_parquet(folder / f"{table}.parquet", index=False)
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder / table}.parquet'")
    got, want = catalog.queries()[name](spark, str(folder)).toPandas(), connection.execute(catalog.oracle_sql()[name]).df()
    assert len(want) and shown(got).equals(shown(want))


def test_headings_of_odd_pages(spark, tmp_path):
    heads = ["<h1>a&amp;&amp;&amp</h1>", "<p>no heading</p>", "<h1>one</h1><h1>two</h1>", "<h1>&lt;b&gt; &quot;&amp;lt; &nbsp;&copy &#39;</h1>", ""]
    pages = pd.DataFrame({"page_id": range(len(heads)), "url": "u", "html": [f"<html><head><title>t</title></head><body>{h}</body></html>" for h in heads]})
    same_as_sql(spark, tmp_path, "html_headings", pages=pages)


def test_stamps_on_the_threshold(spark, tmp_path):
    """An overlap of just 0.8 is decided by the last bit of a stamp's corner."""
    pairs = [((38, 219, 9.0, 0.03), (38, 219, 7.0, 0.03)), ((5, 20, 29.0, 0.02), (6, 20, 23.0, 0.02)), ((130, 230, 39.0, 0.05), (131, 230, 31.0, 0.05)), ((150, 141, 34.0, 0.04), (158, 141, 27.0, 0.04))]
    rows = [(k, n, *line) for k, pair in enumerate(pairs) for n, line in enumerate(pair, 1)]
    same_as_sql(spark, tmp_path, "stamp_iou_anti", lineitem=pd.DataFrame(rows, columns=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax"]))


def test_pages_are_parsed_one_by_one(spark):
    """Blocks leave a worker in batches by their size, not with all rows of an Arrow batch."""
    plan = catalog.queries()["html_blocks"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_only_words_with_letters_that_part_are_looked_up(spark):
    native = spark.createDataFrame([(1, "fără casa Şi " + "x" * 50_000), (2, None)], "doc_id long, text string")
    assert sorted(r.word for r in diacritics.vocabulary(native).collect()) == ["fără", "și"]
    texts = spark.createDataFrame([(1, 1, "f ă ră x " + "y" * 50_000 + " ş i" + " ă"), (1, 2, None), (2, 1, "a ă b ă c ă")], "doc_id long, text_no int, text string")
    got = {(r.doc_id, r.text_no): r.text for r in diacritics.rejoin(texts, native).collect()}
    assert got == {(1, 1): "fără x " + "y" * 50_000 + " şiă", (1, 2): None, (2, 1): "aă bă că"}


def test_clusters_are_chosen_once(spark):
    """The clusters that may be figures are worked out once, not for each of their three uses."""
    plan = catalog.queries()["vector_figures"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2
