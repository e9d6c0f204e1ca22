from leafmill.operators import chrome


def test_pages_with_several_rotated_texts(spark):
    rows = [(1, 2, "late"), (1, 1, "b side"), (1, 1, "a side"), (1, 3, ""), (2, 5, "same"), (2, 5, "same"), (3, 1, "")]
    got = sorted(map(tuple, chrome.rotated_text_report(spark.createDataFrame(rows, "doc_id long, page int, text string")).collect()))
    assert got == [(1, 2, 16, "a side"), (2, 1, 8, "same")]
