"""JSON texts as columns, without a schema: budgets, flat records as tables, nested values as lines.

A value is read twice by built-in functions: as text, which keeps the order of keys and
nested JSON as it stands, and as VARIANT, which knows whether "true" was a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.runtime import cut

# The budgets of a text.
MAX_DEPTH, MAX_CONTAINERS = 100, 1_000_000
STRING = r'"(?:[^"\\]++|\\.)*+"'
NUMBER = r"-?\d[\d.eE+-]*"


def _once(value: Column, use) -> Column:
    """``use`` of a value that it needs several times: as an array's element the value has a name."""
    return F.transform(F.array(value), use)[0]


def containers(text: Column) -> Column:
    """How many objects and arrays a JSON text opens."""
    return F.length(F.regexp_replace(F.regexp_replace(text, STRING, ""), r"[^\[{]+", ""))


def depth(text: Column) -> Column:
    """How deep a JSON text nests; a scalar has no depth."""
    braces = F.split(F.regexp_replace(F.regexp_replace(text, STRING, ""), r"[^\[\]{}]+", ""), "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, brace: Column) -> Column:
        now = acc["now"] + F.when(brace.isin("[", "{"), 1).when(brace.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(braces, start, step, lambda acc: acc["most"])


def over_budget(text: Column, max_depth: int = MAX_DEPTH, most: int = MAX_CONTAINERS) -> Column:
    """Why a text is refused before it is parsed, or null. The depth of one with too many containers is not looked at."""
    return F.when(containers(text) > most, F.lit(f"more than {most} containers")).when(depth(text) > max_depth, F.lit(f"nested deeper than {max_depth}"))


def number_text(raw: Column) -> Column:
    """A number as Python shows it: whole ones as they stand, others as the shortest decimal of their double."""
    d = raw.cast("double")
    short = d.cast("string")
    mantissa, power = F.regexp_replace(F.regexp_extract(short, r"^(-?[0-9.]+)E", 1), r"\.0$", ""), F.regexp_extract(short, r"E(-?\d+)$", 1).cast("int")
    scientific = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    plain = F.regexp_replace(F.regexp_replace(short.cast("decimal(38,21)").cast("string"), "0+$", ""), r"\.$", ".0")
    large = (F.abs(d) >= 1e16) | ((F.abs(d) < 1e-4) & (d != 0))
    return F.when(raw.rlike(r"^-?\d+$"), raw).when(large, scientific).when(F.contains(short, F.lit("E")), plain).otherwise(short)


def _rebuilt(text: Column, pattern: str, gap, match) -> Column:
    """The text with ``match`` of what the pattern finds, and ``gap`` of what lies between."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), match)
    gaps = F.transform(F.split(text, pattern, -1), gap)
    return F.array_join(F.zip_with(gaps, found, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")


def spaced(raw: Column) -> Column:
    """Compact JSON with a blank after commas and colons, and numbers as Python shows them; strings stay."""
    blanks = lambda g: F.regexp_replace(g, "([,:])", "$1 ")
    return _rebuilt(raw, STRING, lambda g: _rebuilt(g, NUMBER, blanks, lambda n: number_text(n)), lambda s: s)


def is_container(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit(False))


def scalar_text(raw: Column, value: Column) -> Column:
    """A scalar as Python shows it."""
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    return F.when((kind == "VOID") | raw.isNull(), "None").when(kind == "STRING", raw).when(kind == "BOOLEAN", F.initcap(raw)).otherwise(number_text(raw))


def cell_text(raw: Column, value: Column) -> Column:
    return F.when(is_container(value), spaced(raw)).otherwise(scalar_text(raw, value))


def records_table(text: Column) -> Column:
    """array<array<string>>: header and rows of a list of objects with the same keys; null for any other text.

    Keys stand in the order of the first object. Defined cases: an empty list, objects of
    different keys, scalars among them and malformed texts are no records; a null reads
    ``None``; nested values are JSON; of a key that an object repeats the first value is taken.
    """
    listed = text.rlike(r"^\s*\[")
    raws, values = F.from_json(text, "array<map<string,string>>"), F.from_json(text, "array<map<string,variant>>")
    pairs = F.when(listed, F.arrays_zip(raws.alias("raw"), values.alias("value")))

    def table(records: Column) -> Column:
        head = F.array_distinct(F.map_keys(records[0]["raw"]))
        keys = F.array_sort(head)
        same = F.forall(records, lambda r: F.coalesce(F.array_sort(F.array_distinct(F.map_keys(r["raw"]))) == keys, F.lit(False)))
        rows = F.transform(records, lambda r: F.transform(head, lambda k: cell_text(F.try_element_at(r["raw"], k), F.try_element_at(r["value"], k))))
        return F.when((F.size(records) > 0) & same, F.concat(F.array(head), rows))

    return _once(pairs, table)


def nested_lines(rows: DataFrame) -> DataFrame:
    """(key, text): each JSON text of ``rows`` (key, json) as ``name: value`` lines, indented by level, list items named by position.

    Containers are opened level by level, for all texts at once; there are as many rounds
    as the deepest text has levels. Defined cases: a scalar is its own line; an empty
    container is its name alone, and a text of nothing else is empty; a null or malformed
    text has no row; rows that repeat a key are told apart and have a row each.
    """
    read = F.try_parse_json("json")
    top = rows.select(F.monotonically_increasing_id().alias("row"), "key", "json", read.alias("value")).where("value is not null")
    lone = F.from_json(F.concat(F.lit("["), "json", F.lit("]")), "array<string>")[0]  # a scalar without its quotes
    top = cut(top.select("row", "key", F.array().cast("array<int>").alias("path"), "value", F.when(is_container(F.col("value")), F.col("json")).otherwise(lone).alias("raw")))
    lines = top.where(~is_container(F.col("value"))).select("row", "path", scalar_text(F.col("raw"), F.col("value")).alias("line"))
    open_ = top.where(is_container(F.col("value"))).select("row", "path", "raw", F.schema_of_variant("value").startswith("OBJECT").alias("named"))
    level = 0
    while not open_.isEmpty():
        names, raws, values = F.map_keys(F.from_json("raw", "map<string,string>")), F.map_values(F.from_json("raw", "map<string,string>")), F.map_values(F.from_json("raw", "map<string,variant>"))
        listed = F.from_json("raw", "array<string>")
        pairs = F.arrays_zip(names.alias("name"), raws.alias("raw"), values.alias("value"))
        items = F.arrays_zip(F.transform(listed, lambda _, i: F.concat(F.lit("["), i.cast("string"), F.lit("]"))).alias("name"), listed.alias("raw"), F.from_json("raw", "array<variant>").alias("value"))
        each = open_.where("named").select("row", "path", F.posexplode(pairs).alias("at", "x")).unionByName(open_.where("not named").select("row", "path", F.posexplode(items).alias("at", "x")))
        each = cut(each.select("row", F.concat("path", F.array("at")).alias("path"), "x.*"))
        holds = is_container(F.col("value"))
        said = F.concat(F.lit("  " * level), "name", F.lit(":"), F.when(holds, "").otherwise(F.concat(F.lit(" "), scalar_text(F.col("raw"), F.col("value")))))
        lines = lines.unionByName(each.select("row", "path", said.alias("line")))
        open_ = each.where(holds).select("row", "path", "raw", F.schema_of_variant("value").startswith("OBJECT").alias("named"))
        level += 1
    whole = lines.groupBy("row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "line"))), lambda x: x["line"]), "\n").alias("text"))
    return top.select("row", "key").join(whole, "row", "left").select("key", F.coalesce("text", F.lit("")).alias("text"))
