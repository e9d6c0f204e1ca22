"""Queries over text functions. The driver's texts are clean, so damage is put in on both sides alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import markup, text
from leafmill.operators import diacritics, metrics, tables
from leafmill.plans.catalog import query
from leafmill.runtime import cut, table

NBSP, ZWSP, PUA, WIDE_PUA, FFFD = " ", "​", "", "\U000f0001", "�"
SPACES = "\\t\\x0B\\f    -     　\u0085"
LETTERS = "[\\p{L}\\p{Nl}\\p{No}]"
SQL_LINES = "string_split({0}, chr(10))"


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source and a text with every kind of damage that cleaning undoes."""
    out = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    t = F.col("text")
    for old, new in DAMAGE:
        t = F.replace(t, F.lit(old), F.lit(new))
    return out.withColumn("text", F.concat(t, F.lit(f"{PUA}{ZWSP}\n\n\n\n"), F.repeat(F.lit("end\n"), (F.col("doc_id") % 3).cast("int"))))


DAMAGE = (("tion ", "ti-\non "), (". ", ".  \t"), ("s ", "ş "), (" the ", f"{NBSP}the{ZWSP} "), (".\n", ".\n \n\t\n\n"))


def _sql_damaged() -> str:
    out = "text"
    for old, new in DAMAGE:
        out = f"replace({out}, {_q(old)}, {_q(new)})"
    return f"(SELECT doc_id, source, concat({out}, {_q(PUA + ZWSP + chr(10) * 4)}, repeat({_q('end' + chr(10))}, CAST(doc_id % 3 AS BIGINT))) AS text FROM documents)"


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SQL_DAMAGED = _sql_damaged()


def sql_fold(t: str) -> str:
    out = f"translate({t}, 'ŞşŢţ', 'ȘșȚț')"
    out = f"regexp_replace({out}, '[\\x{{E000}}-\\x{{F8FF}}\\x{{F0000}}-\\x{{FFFFD}}\\x{{100000}}-\\x{{10FFFD}}]', '', 'g')"
    out = f"regexp_replace({out}, '[\\x{{200B}}-\\x{{200D}}\\x{{FEFF}}]', '', 'g')"
    out = f"regexp_replace({out}, '[{SPACES}]', ' ', 'g')"
    return f"regexp_replace({out}, '({LETTERS})-[ \\t]*\\r?\\n[ \\t]*({LETTERS})', '\\1\\2', 'g')"


def sql_normalize(t: str, layout: bool = False) -> str:
    out = sql_fold(t)
    if not layout:
        out = f"regexp_replace({out}, '[ \\t]{{2,}}', ' ', 'g')"
    trim = "\\s+$" if layout else "^\\s+|\\s+$"
    out = f"array_to_string(list_transform(string_split({out}, chr(10)), lambda x: regexp_replace(x, '{trim}', '', 'g')), chr(10))"
    return f"regexp_replace(regexp_replace({out}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT doc_id, {sql_normalize('text')} AS text FROM {SQL_DAMAGED}")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged(spark, sf_dir).select("doc_id", text.normalize(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {sql_normalize('text', True)} AS text FROM {SQL_DAMAGED}")
def normalize_preserve_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged(spark, sf_dir).select("doc_id", text.normalize(F.col("text"), preserve_layout=True).alias("text"))


@query("SELECT doc_id, replace(replace(text, 'sh', 'ș'), 'ti', 'ț') AS text FROM documents")
def cedilla_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = F.replace(F.replace("text", F.lit("sh"), F.lit("ş")), F.lit("ti"), F.lit("ţ"))
    return table(spark, sf_dir, "documents").select("doc_id", text.fold_cedilla(hurt).alias("text"))


@query("SELECT doc_id, replace(text, ' ', '') AS text FROM documents")
def private_use_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = F.replace("text", F.lit(" "), F.lit(PUA + WIDE_PUA))
    return table(spark, sf_dir, "documents").select("doc_id", text.drop_private_use(hurt).alias("text"))


@query("SELECT doc_id, replace(text, 'e', ' ') AS text FROM documents")
def space_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = F.replace("text", F.lit("e"), F.lit(ZWSP + NBSP))
    return table(spark, sf_dir, "documents").select("doc_id", text.fold_spaces(hurt).alias("text"))


@query(f"SELECT doc_id, regexp_replace(replace(text, 'th', 't- ' || chr(13) || chr(10) || ' h'), '({LETTERS})-[ \\t]*\\r?\\n[ \\t]*({LETTERS})', '\\1\\2', 'g') AS text FROM documents")
def hyphen_rejoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = F.replace("text", F.lit("th"), F.lit("t- \r\n h"))
    return table(spark, sf_dir, "documents").select("doc_id", text.rejoin_hyphens(hurt).alias("text"))


@query("SELECT doc_id, regexp_replace(replace(text, '. ', chr(10) || chr(10) || chr(10) || chr(10)), '\\n{3,}', chr(10) || chr(10), 'g') AS text FROM documents")
def blank_run_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = F.replace("text", F.lit(". "), F.lit("\n\n\n\n"))
    return table(spark, sf_dir, "documents").select("doc_id", text.collapse_blank_runs(hurt).alias("text"))


@query("SELECT doc_id, replace(text, 'e', 'é') AS text, contains(text, 'e') OR contains(text, 'e') AS unicode_repaired FROM documents")
def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage that repair alone undoes, so no other step of the chain is in the way."""
    hurt = F.replace("text", F.lit("e"), F.lit("Ã©"))
    return table(spark, sf_dir, "documents").select("doc_id", text.repair(hurt).alias("text"), (text.repair(hurt) != hurt).alias("unicode_repaired"))


SIGNED = "lower(trim(regexp_replace({0}, '\\s+', ' ', 'g')))"


@query(
    f"""WITH l AS (SELECT unnest(string_split(concat('Page  ', doc_id, ' of 9', chr(10), text), chr(10))) AS line FROM documents),
    s AS (SELECT {SIGNED.format("regexp_replace(line, '[0-9]+', '#', 'g')")} AS signature, {SIGNED.format('line')} AS exact FROM l)
    SELECT signature, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT exact) AS BIGINT) AS n_exact FROM s GROUP BY signature"""
)
def line_signature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("Page  "), "doc_id", F.lit(" of 9\n"), "text").alias("t"))
    lines = docs.select(F.explode(F.split("t", "\n")).alias("line"))
    signed = lines.select(text.line_signature(F.col("line")).alias("signature"), text.line_signature(F.col("line"), exact=True).alias("exact"))
    return signed.groupBy("signature").agg(F.count("*").alias("n"), F.countDistinct("exact").alias("n_exact"))


SQL_RATIO = """SELECT doc_id, CASE WHEN len(l) = 0 THEN 0.0 ELSE round(1 - len(list_distinct(l)) / len(l), 9) END AS ratio
  FROM (SELECT doc_id, list_filter(list_transform(string_split({0}, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM {1})"""


@query("SELECT doc_id, CAST(ratio AS DOUBLE) AS ratio FROM (" + SQL_RATIO.format("text", "documents") + ")")
def duplicate_line_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.duplicate_line_ratio(table(spark, sf_dir, "documents")).select("doc_id", F.round("ratio", 9).alias("ratio"))


@query(
    f"""WITH c AS (SELECT doc_id, {sql_normalize('text')} AS text FROM {SQL_DAMAGED}),
    r AS ({SQL_RATIO.format('text', 'c')})
    SELECT c.doc_id, CAST(length(c.text) AS BIGINT) AS n_chars, CAST(len(string_split(c.text, chr(10))) AS BIGINT) AS n_lines, CAST(r.ratio AS DOUBLE) AS duplicate_ratio
    FROM c JOIN r USING (doc_id)"""
)
def cleaned_document_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = damaged(spark, sf_dir).select("doc_id", text.normalize(F.col("text")).alias("text"))
    own = F.filter(F.transform(F.split("text", "\n"), text.strip), lambda x: x != "")
    rows = clean.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"), own.alias("own"))
    ratio = F.when(F.size("own") == 0, 0.0).otherwise(F.round(1 - F.size(F.array_distinct("own")) / F.size("own"), 9))
    return rows.select("doc_id", "n_chars", "n_lines", ratio.alias("duplicate_ratio"))


@query(
    f"""SELECT source AS doc_id, round(CAST(sum(doc_id % 40) AS DOUBLE) / sum(length(text) + doc_id % 40), 9) AS rate FROM documents GROUP BY source"""
)
def unicode_corruption_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = F.concat("text", F.repeat(F.lit(FFFD), (F.col("doc_id") % 40).cast("int")))
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), hurt.alias("text"))
    return metrics.corruption_rate(docs).select("doc_id", F.round("rate", 9).alias("rate"))


@query(
    """WITH p AS (SELECT doc_id, substr(text, 3, 9) AS phrase FROM documents UNION ALL SELECT doc_id, 'zz' || doc_id FROM documents WHERE doc_id % 3 = 0),
    h AS (SELECT p.doc_id, CASE WHEN contains(lower(d.text), lower(p.phrase)) THEN 1.0 ELSE 0.0 END AS hit FROM p JOIN documents d ON p.doc_id = d.doc_id)
    SELECT d.doc_id, CAST(coalesce(avg(h.hit), 1.0) AS DOUBLE) AS retention FROM documents d LEFT JOIN h USING (doc_id) GROUP BY d.doc_id"""
)
def phrase_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    some = docs.select("doc_id", F.substring("text", 3, 9).alias("phrase"))
    none = docs.where("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("zz"), "doc_id").alias("phrase"))
    return metrics.phrase_retention(docs, some.unionAll(none))


SQL_CELLS = """c AS (SELECT n_regionkey AS doc_id, ' ' || n_name AS cell FROM nation UNION ALL SELECT n_regionkey, ' ' FROM nation),
  e AS (SELECT n_regionkey AS doc_id, upper(n_name) AS cell FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT r_regionkey, 'nowhere' FROM region)"""


def _cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    cells = nation.select(F.col("n_regionkey").alias("doc_id"), F.concat(F.lit(" "), "n_name").alias("cell")).unionAll(nation.select("n_regionkey", F.lit(" ")))
    expected = nation.where("n_nationkey % 2 = 0").select(F.col("n_regionkey").alias("doc_id"), F.upper("n_name").alias("cell")).unionAll(region.select("r_regionkey", F.lit("nowhere")))
    return cells, expected


@query(
    f"""WITH {SQL_CELLS} SELECT doc_id, CAST(avg(CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.doc_id = e.doc_id AND lower(trim(c.cell)) = lower(trim(e.cell))) THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS recall FROM e GROUP BY doc_id"""
)
def cell_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cell_recall(*_cells(spark, sf_dir))


@query(
    f"""WITH {SQL_CELLS} SELECT doc_id, CAST(avg(CASE WHEN EXISTS (SELECT 1 FROM e WHERE c.doc_id = e.doc_id AND lower(trim(c.cell)) = lower(trim(e.cell))) THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS precision
    FROM c WHERE trim(cell) <> '' GROUP BY doc_id"""
)
def cell_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cell_precision(*_cells(spark, sf_dir))


@query(
    """WITH m AS (SELECT doc_id, 0 AS column_no, substr(text, 1, 8) AS marker FROM documents UNION ALL SELECT doc_id, 0, substr(text, 60, 8) FROM documents
      UNION ALL SELECT doc_id, 1, substr(text, 40, 8) FROM documents UNION ALL SELECT doc_id, 2, substr(text, 90, 8) FROM documents),
    a AS (SELECT m.doc_id, column_no, strpos(d.text, marker) AS pos FROM m JOIN documents d USING (doc_id) WHERE strpos(d.text, marker) > 0),
    s AS (SELECT doc_id, column_no, min(pos) AS f, max(pos) AS l FROM a GROUP BY ALL)
    SELECT x.doc_id, CAST(count(*) FILTER (y.f < x.l) AS BIGINT) AS errors FROM s x JOIN s y ON x.doc_id = y.doc_id AND y.column_no = x.column_no + 1 GROUP BY x.doc_id"""
)
def reading_order_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    places = F.array(*[F.struct(F.lit(c).alias("column_no"), F.substring("text", at, 8).alias("marker")) for c, at in ((0, 1), (0, 60), (1, 40), (2, 90))])
    markers = docs.select("doc_id", F.explode(places).alias("m")).select("doc_id", "m.*")
    return metrics.reading_order_errors(docs, markers)


@query(
    """WITH p AS (SELECT source, substr(text, 1, 5) AS pattern, count(*) AS times FROM documents GROUP BY ALL),
    k AS (SELECT d.source AS doc_id, sum(times) AS n FROM documents d JOIN p ON d.source = p.source AND contains(lower(d.text), lower(p.pattern)) GROUP BY 1)
    SELECT s.doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS leaks FROM (SELECT DISTINCT source AS doc_id FROM documents) s LEFT JOIN k USING (doc_id)"""
)
def header_footer_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    patterns = docs.select(F.col("source").alias("doc_id"), F.substring("text", 1, 5).alias("pattern"))
    return metrics.leakage(docs.select(F.col("source").alias("doc_id"), "text"), patterns)


@query("SELECT source AS doc_id, CAST(avg(CASE WHEN length(text) < 700 THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS empty_rate FROM documents GROUP BY source")
def empty_unit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("unit"), "text")
    return metrics.empty_unit_rate(docs.select("doc_id", "unit"), docs.where("length(text) >= 700").select("doc_id", "unit"))


SQL_WORDS = "list_distinct(list_filter(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\p{{Pc}}]+'), lambda w: length(w) > 3))"


@query(
    f"""WITH w AS (SELECT d.doc_id, {SQL_WORDS.format('d.text')} AS p, {SQL_WORDS.format("coalesce(b.text, '')")} AS n FROM documents d LEFT JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id)
    SELECT doc_id, CASE WHEN len(p) = 0 THEN 0.0 ELSE round(len(list_filter(p, lambda x: NOT list_contains(n, x))) / len(p), 9) END AS novelty FROM w"""
)
def prose_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    # The words of an item are taken once, not for each document that is compared with it.
    known = cut(items.select("item_id", text.significant_words(F.col("text")).alias("known")))
    joined = docs.select("doc_id", text.significant_words(F.col("text")).alias("own")).join(known, F.col("doc_id") % known.count() == F.col("item_id"), "left")
    nothing = F.array().cast("array<string>")
    return joined.select("doc_id", F.round(text.novel_share(F.col("own"), F.coalesce("known", nothing)), 9).alias("novelty"))


@query(
    """WITH t AS (SELECT doc_id, concat('see https://x.y/z) ', text, ' www.a.b.c  end') AS text FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, text FROM documents WHERE doc_id % 2 = 1)
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN trim(regexp_replace(regexp_replace(text, '(https?://[^\\s")\\]>,]+|www\\.[^\\s")\\]>,]+)', '', 'g'), ' {2,}', ' ', 'g')) ELSE text END AS text,
      CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 0 END AS dropped FROM t"""
)
def url_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hurt = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("see https://x.y/z) "), "text", F.lit(" www.a.b.c  end"))).otherwise(F.col("text"))
    rows = docs.select("doc_id", hurt.alias("t"))
    return rows.select("doc_id", text.drop_urls(F.col("t")).alias("text"), text.count_urls(F.col("t")).alias("dropped"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '[icon]' ELSE substr(text, 1, 1) END AS text FROM documents"""
)
def icon_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    glyph = F.when(F.col("doc_id") % 3 == 0, F.lit("口")).otherwise(F.substring("text", 1, 1))
    return table(spark, sf_dir, "documents").select("doc_id", text.icon_noise(glyph).alias("text"))


@query(
    """SELECT source AS doc_id, CAST(count(DISTINCT w) AS BIGINT) AS vocabulary FROM
      (SELECT source, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}]+')) AS w FROM documents) GROUP BY source"""
)
def vocabulary_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.explode(text.words(F.col("text"))).alias("w"))
    return words.groupBy("doc_id").agg(F.countDistinct("w").alias("vocabulary"))


# --- the visual model's markup --------------------------------------------------------------------------------------

MARKUP = "concat('<doctag><text><loc_1><loc_22>', o_orderpriority, '</text><formula>\\left( x_', o_orderkey, ' \\right', CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ')' END, CASE WHEN o_orderkey % 5 = 0 THEN ' }' ELSE ' { y }' END, '</formula>', CASE WHEN o_orderkey % 4 = 0 THEN '<text>' ELSE '' END, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '</doctag>' END)"
SPARK_MARKUP = MARKUP.replace("\\", "\\\\")


def _markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(SPARK_MARKUP).alias("raw"))


@query("SELECT o_orderkey, o_orderkey % 7 = 0 OR o_orderkey % 4 = 0 AS truncated FROM orders")
def doctag_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _markup(spark, sf_dir).select("o_orderkey", markup.is_truncated(F.col("raw")).alias("truncated"))


@query("SELECT o_orderkey, o_orderkey % 5 > 0 AS balanced FROM orders")
def formula_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``\\right`` is written in every formula, so the braces decide."""
    return _markup(spark, sf_dir).select("o_orderkey", markup.formula_balanced(F.expr("regexp_extract(raw, '<formula>(.*)</formula>', 1)")).alias("balanced"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority ELSE concat(o_orderpriority, chr(10) || chr(10) || '$$' || chr(10) || '\\left( x_', o_orderkey, ' \\right',
      CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ')' END, ' { y }', chr(10) || '$$') END AS prose FROM orders"""
)
def doctag_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _markup(spark, sf_dir).select("o_orderkey", markup.prose(F.col("raw")).alias("prose"))


@query(
    """SELECT p_partkey, concat('x', p_size, ';', CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END, '|', p_type) AS cells FROM part"""
)
def otsl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit("<ched>x"), "p_size", F.when(F.col("p_size") % 2 == 0, F.lit("<lcel>")).otherwise(F.concat(F.lit("<fcel> "), "p_brand")), F.lit("<nl>junk<nl><fcel>"), "p_type", F.lit("<nl>"))
    rows = table(spark, sf_dir, "part").select("p_partkey", markup.otsl_rows(body).alias("rows"))
    return rows.select("p_partkey", F.array_join(F.transform("rows", lambda r: F.array_join(r, ";")), "|").alias("cells"))


@query(
    """WITH n AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS a, CAST(o_custkey AS VARCHAR) AS b FROM orders)
    SELECT o_orderkey, CASE WHEN length(b) >= 2 AND NOT contains(a || '7', b) THEN b ELSE '' END AS missing FROM n"""
)
def unsupported_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    latex = F.concat(F.lit("x = "), F.col("o_custkey").cast("string"), F.lit(" + 7"))
    page = F.concat(F.lit("no. "), F.col("o_orderkey").cast("string"), F.lit(" of 7"))
    return orders.select("o_orderkey", F.array_join(markup.unsupported_numbers(latex, page), ",").alias("missing"))


@query(
    """SELECT p_size AS page, CAST(count(*) AS BIGINT) AS expected, CAST(count(*) FILTER (p_partkey % 2 = 0) AS BIGINT) AS recovered,
      CAST(count(*) FILTER (p_partkey % 2 = 1) AS BIGINT) AS wrong FROM part GROUP BY p_size"""
)
def formula_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    expected = part.select(F.col("p_size").alias("page"), F.col("p_partkey").alias("formula_id"), F.concat(F.lit("\\mathrm{F} _ {p} = <"), "p_partkey", F.lit(">")).alias("latex"))
    sign = F.when(F.col("p_partkey") % 2 == 0, F.lit("<")).otherwise(F.lit("["))
    candidates = part.select(F.col("p_size").alias("page"), F.col("p_partkey").alias("candidate_id"), F.concat(F.lit("a \\, {F} _p ="), sign, "p_partkey", F.lit("> b")).alias("latex"))
    return metrics.formula_score(expected, candidates).select("page", "expected", "recovered", "wrong")


@query(
    """SELECT p_size AS page, CAST(count(*) FILTER (p_partkey % 2 = 0) AS BIGINT) AS recovered, CAST(count(*) FILTER (p_partkey % 2 = 1 AND p_partkey % 3 > 0) AS BIGINT) AS wrong_balanced,
      CAST(count(*) FILTER (p_partkey % 2 = 1 AND p_partkey % 3 = 0) AS BIGINT) AS unbalanced FROM part GROUP BY p_size"""
)
def formula_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrong formulas that close and that do not; every third candidate leaves a brace open."""
    part = table(spark, sf_dir, "part")
    expected = part.select(F.col("p_size").alias("page"), F.col("p_partkey").alias("formula_id"), F.concat(F.lit("E = <"), "p_partkey", F.lit(">")).alias("latex"))
    said = F.concat(F.lit("a E ="), F.when(F.col("p_partkey") % 2 == 0, F.lit("<")).otherwise(F.lit("[")), "p_partkey", F.lit("> b"), F.when(F.col("p_partkey") % 3 == 0, " {").otherwise(" {c}"))
    candidates = part.select(F.col("p_size").alias("page"), F.col("p_partkey").alias("candidate_id"), said.alias("latex"))
    return metrics.formula_score(expected, candidates).select("page", "recovered", "wrong_balanced", "unbalanced")


@query(
    """WITH p AS (SELECT p_size, concat(min(p_partkey), max(p_partkey)) AS known FROM part GROUP BY p_size),
    f AS (SELECT p_size % 2 AS reason, p_partkey % 2 = 0 AS held, length(CAST(p_partkey AS VARCHAR)) >= 2 AND NOT contains(known, CAST(p_partkey AS VARCHAR)) AS flagged FROM part JOIN p USING (p_size))
    SELECT CAST(reason AS INTEGER) AS reason, CAST(count(*) FILTER (NOT held) AS BIGINT) AS wrong, CAST(count(*) FILTER (NOT held AND flagged) AS BIGINT) AS caught,
      CAST(count(*) FILTER (held) AS BIGINT) AS recovered, CAST(count(*) FILTER (held AND flagged) AS BIGINT) AS cost FROM f GROUP BY reason"""
)
def numeric_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    pages = part.groupBy(F.col("p_size").alias("page")).agg((F.first("p_size") % 2).cast("int").alias("reason"), F.concat(F.min("p_partkey").cast("string"), F.lit(" "), F.max("p_partkey").cast("string")).alias("text"))
    expected = part.select(F.col("p_size").alias("page"), F.col("p_partkey").alias("formula_id"), F.concat(F.lit("E = <"), "p_partkey", F.lit(">")).alias("latex"))
    sign = F.when(F.col("p_partkey") % 2 == 0, F.lit("<")).otherwise(F.lit("["))
    candidates = part.select(F.col("p_size").alias("page"), F.col("p_partkey").alias("candidate_id"), F.concat(F.lit("{a} E ="), sign, "p_partkey", F.lit("> b")).alias("latex"))
    return metrics.numeric_gate(expected, candidates, pages)


# --- letters set apart, damage rates ---------------------------------------------------------------------------------

SQL_CANONICAL = "translate(lower({0}), 'şţŞŢ', 'șțȘȚ')"
SQL_BETWEEN = "'([\\p{L}\\p{N}_]+) ([ăâîșțşţĂÂÎȘȚŞŢ]) ([\\p{L}\\p{N}_]+)'"


@query(
    f"""WITH t AS (SELECT doc_id, replace(text, 'a ', ' ă ') AS text, CASE doc_id % 4 WHEN 0 THEN replace(text, 'a ', 'ă ') WHEN 1 THEN replace(text, 'a ', 'ă') WHEN 2 THEN replace(text, 'a ', ' ă') ELSE text END AS native FROM documents),
    v AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all({SQL_CANONICAL.format('native')}, '[\\p{{L}}\\p{{N}}_]+')) AS word FROM t),
    p AS (SELECT doc_id, text, regexp_split_to_array(text, {SQL_BETWEEN}) AS gaps, regexp_extract_all(text, {SQL_BETWEEN}, 1) AS l, regexp_extract_all(text, {SQL_BETWEEN}, 2) AS m, regexp_extract_all(text, {SQL_BETWEEN}, 3) AS r FROM t),
    e AS (SELECT doc_id, generate_subscripts(gaps, 1) AS i, unnest(gaps) AS gap, l, m, r FROM p),
    x AS (SELECT doc_id, i, gap, l[i] AS l, m[i] AS m, r[i] AS r FROM e),
    d AS (SELECT x.doc_id, i, concat(gap, CASE WHEN m IS NULL THEN '' WHEN a.word IS NOT NULL THEN concat(l, m, r) WHEN b.word IS NULL AND c.word IS NOT NULL THEN concat(l, ' ', m, r) ELSE concat(l, m, ' ', r) END) AS part
      FROM x LEFT JOIN v a ON a.doc_id = x.doc_id AND a.word = {SQL_CANONICAL.format('concat(l, m, r)')} LEFT JOIN v b ON b.doc_id = x.doc_id AND b.word = {SQL_CANONICAL.format('concat(l, m)')}
      LEFT JOIN v c ON c.doc_id = x.doc_id AND c.word = {SQL_CANONICAL.format('concat(m, r)')})
    SELECT doc_id, 1 AS text_no, regexp_replace(string_agg(part, '' ORDER BY i), '([\\p{{L}}\\p{{N}}_]+) ([ăâîșțşţĂÂÎȘȚŞŢ])([^\\p{{L}}\\p{{N}}_]|$)', '\\1\\2\\3', 'g') AS text FROM d GROUP BY doc_id"""
)
def split_diacritics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with every final a set apart, against native texts that tell where it belongs."""
    docs, t, kind = table(spark, sf_dir, "documents"), F.col("text"), F.col("doc_id") % 4
    put = lambda new: F.replace(t, F.lit("a "), F.lit(new))
    native = F.when(kind == 0, put("ă ")).when(kind == 1, put("ă")).when(kind == 2, put(" ă")).otherwise(t)
    return diacritics.rejoin(docs.select("doc_id", F.lit(1).alias("text_no"), put(" ă ").alias("text")), docs.select("doc_id", native.alias("text")))


@query(
    """WITH w AS (SELECT source, regexp_extract_all(replace(text, 'as', 'a6s'), '\\S*[a-z]{3}\\S*') AS w FROM documents)
    SELECT source AS doc_id, CAST(sum(len(w)) AS BIGINT) AS words, CAST(sum(len(list_filter(w, lambda x: NOT contains(x, '@') AND NOT regexp_matches(x, '^\\p{Lu}') AND regexp_matches(x, '[a-z][0-9A-Z:.,;][a-z]')))) AS BIGINT) AS corrupted
    FROM w GROUP BY source"""
)
def corrupted_word_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = text.intruded_words(F.replace("text", F.lit("as"), F.lit("a6s")))
    return table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), rate.alias("r")).groupBy("doc_id").agg(F.sum("r.words").alias("words"), F.sum("r.corrupted").alias("corrupted"))


@query(
    """WITH c AS (SELECT doc_id, unnest(string_split(concat(text, chr(10), doc_id % 120, chr(10), ' x ', chr(10), chr(10)), chr(10))) AS line FROM documents)
    SELECT doc_id, CAST(count(*) AS INTEGER) AS lines, CAST(count(*) FILTER (WHERE length(trim(line)) <= 2) AS INTEGER) AS fragments FROM c WHERE trim(line) <> '' GROUP BY doc_id"""
)
def table_debris(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array(F.array("text", F.lit(None).cast("string")), F.array(F.concat((F.col("doc_id") % 120).cast("string"), F.lit("\n x \n\n"))))
    return table(spark, sf_dir, "documents").select("doc_id", tables.debris(rows).alias("d")).select("doc_id", "d.*")
