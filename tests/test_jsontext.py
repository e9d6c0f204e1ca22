"""JSON in the JVM against Python's own reading of it."""

import json
import random

from pyspark.sql import functions as F

from leafmill.functions import jsontext
from leafmill.sources import parsers


def value(rng, deep):
    kind = rng.randrange(9 if deep else 7)
    if kind == 7:
        return [value(rng, deep - 1) for _ in range(rng.randrange(4))]
    if kind == 8:
        return {rng.choice(["b", "a", "ă", 'q"', "z y", "k:,"]) + str(i): value(rng, deep - 1) for i in range(rng.randrange(4))}
    return [None, True, False, rng.randrange(-(10**12), 10**12), rng.choice([1.5, 0.0001, 12345678.9, 1e22, 1.25e-7, -3.0, 0.1, 1e16, 123456789012345.6]), rng.choice(["", "true", "1.50", 'a "b" \\ c', "é, x: {y}", "null", "[1]"]), rng.randrange(9)][kind]


def test_records_lines_and_budgets_of_random_texts(spark):
    rng = random.Random(6)
    data = [value(rng, 4) for _ in range(150)] + [[], {}, [{}], [[]], {"a": []}, "x", 3, None]
    for _ in range(60):
        keys = rng.sample(["b", "a", "ă", "k 1", 'q"'], rng.randrange(1, 5))
        rows = [{k: value(rng, 2) for k in rng.sample(keys, len(keys))} for _ in range(rng.randrange(1, 4))]
        data.append(rows + ([{"other": 1}] if rng.random() < 0.2 else [3] if rng.random() < 0.1 else []))
    texts = [(i, json.dumps(d, ensure_ascii=False, indent=rng.choice([None, 2]))) for i, d in enumerate(data)] + [(900, "{"), (901, None), (902, '[{"a": 1.50, "b": "x"}, {"b": null, "a": true}]')]
    frame = spark.createDataFrame(texts, "key int, json string")
    j = F.col("json")
    got = {r.key: r for r in frame.select("key", jsontext.records_table(j).alias("t"), jsontext.containers(j).alias("n"), jsontext.depth(j).alias("d")).collect()}
    lines = {r.key: r.text for r in jsontext.nested_lines(frame).collect()}
    assert got[902].t == [["a", "b"], ["1.5", "x"], ["True", "None"]] and got[900].t is None and got[901].t is None
    assert 900 not in lines and 901 not in lines

    def levels(v):
        return 1 + max([0, *map(levels, v.values() if isinstance(v, dict) else v)]) if isinstance(v, (dict, list)) else 0

    for i, d in enumerate(data):
        flat = parsers.flat_records(d)
        want = [list(d[0]), *([parsers.json_cell(r[k]) for k in d[0]] for r in d)] if flat else None
        assert got[i].t == want, d
        assert got[i].n == parsers.count_containers(d) and got[i].d == levels(d)
        assert lines[i] == "\n".join(parsers.json_lines(d)), d
    assert sum(r.t is not None for r in got.values()) > 30


def test_budgets(spark):
    rows = [("[" * 101 + "]" * 101, "nested deeper than 100"), ("[" * 100 + "]" * 100, None), ('["[[[[{{{"]', None), ("[" + "[]," * 20 + "[]]", "more than 15 containers")]
    frame = spark.createDataFrame(rows, "json string, why string")
    got = [r.x for r in frame.select(jsontext.over_budget(F.col("json"), 100, 1000).alias("x")).collect()]
    assert got == [rows[0][1], None, None, None]
    assert [r.x for r in frame.select(jsontext.over_budget(F.col("json"), 1000, 15).alias("x")).collect()] == ["more than 15 containers", "more than 15 containers", None, "more than 15 containers"]
