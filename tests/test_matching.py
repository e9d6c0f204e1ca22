"""Many patterns at once, against looking for each of them in each text."""

import random

import pytest
from pyspark.sql import functions as F

from leafmill.operators import matching, metrics


@pytest.mark.parametrize("pattern_chars,text_chars", [(2_000_000, 64_000_000), (40, 300)])
def test_found_patterns_equal_a_search_for_each(spark, pattern_chars, text_chars):
    rng = random.Random(2)
    said = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    texts = [(rng.choice([1, 1, 1, 2, 3, 4]), i, said(rng.randrange(40))) for i in range(200)] + [(1, 900, None), (None, 901, "ab"), (1, 902, ""), (1, 903, "ab" * 5000)]
    patterns = [(rng.choice([1, 1, 2, 3, 9]), said(rng.randrange(1, 5))) for _ in range(120)] + [(1, ""), (1, ""), (2, None), (None, "a"), (1, "ab"), (1, "ab")]
    known = matching.numbered(spark.createDataFrame(patterns, "key long, pattern string"))
    rows = matching.contained(spark.createDataFrame(texts, "key long, text_id long, text string"), known, True, pattern_chars, text_chars)
    names = {r.number: (r.key, r.pattern) for r in known.collect()}
    got, weight = {}, {}
    for r in rows.collect():
        got.setdefault(r.text_id, set()).update(names[n][1] for n in r.found)
        weight[r.text_id] = weight.get(r.text_id, 0) + r.weight
        assert all(names[n][0] == r.key for n in r.found) and len(set(r.found)) == len(r.found)
    keys = {k for k, p in patterns if k is not None and p is not None}
    want = {i: {p for k2, p in patterns if k2 == k and p is not None and p in t} for k, i, t in texts if k in keys and t is not None}
    assert got == want
    assert weight == {i: sum(p in t for k2, p in patterns if k2 == k and p is not None) for k, i, t in texts if k in keys and t is not None}


def test_no_patterns_no_texts(spark):
    none = spark.createDataFrame([], "key string, pattern string")
    texts = spark.createDataFrame([("a", 1, "x")], "key string, text_id long, text string")
    assert matching.contained(texts, matching.numbered(none)).count() == 0
    some = matching.numbered(spark.createDataFrame([("a", "x")], "key string, pattern string"))
    assert matching.contained(texts.where("text_id > 9"), some).count() == 0
    assert matching.contained(texts, some, listed=False).select("weight", F.col("found").isNull()).collect()[0][:] == (1, True)


def test_formula_scores_tell_unbalanced_from_wrong(spark):
    expected = spark.createDataFrame([(1, 1, "a+b"), (1, 2, "a + b"), (1, 3, "{ }"), (2, 4, "q"), (2, 5, "zz")], "page int, formula_id int, latex string")
    found = spark.createDataFrame([(1, 1, "x = a+b"), (1, 2, "y {"), (1, 3, "y"), (2, 4, "\\left( z"), (3, 5, "q")], "page int, candidate_id int, latex string")
    got = {r.page: tuple(r)[1:] for r in metrics.formula_score(expected, found).collect()}
    assert got == {1: (3, 2, 2, 1, 1), 2: (2, 0, 1, 0, 1)}
