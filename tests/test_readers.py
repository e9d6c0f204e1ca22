"""Readers over files made here, the text functions' literal cases, sinks and streaming."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from leafmill import cli
from leafmill.functions import markup, render, text
from leafmill.operators import diacritics, reading_order
from leafmill.sources import committed, documents, parsers, sinks
from leafmill.streaming import ingest


def package(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


def types(main):
    return f'<Types xmlns="t"><Override PartName="/x" ContentType="{main}"/></Types>'


def docx():
    w = 'xmlns:w="w"'
    p = lambda t, s="": f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>'
    body = p("Titlu", "H1") + p("unu", "LB") + p("doi", "LB") + p("text") + "<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val=\"2\"/></w:tcPr><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc></w:tr></w:tbl>" + p("după")
    return package({
        "[Content_Types].xml": types(parsers.MAIN_TYPES[".docx"][0]), "word/document.xml": f"<w:document {w}><w:body>{body}</w:body></w:document>",
        "word/styles.xml": f'<w:styles {w}><w:style w:styleId="H1"><w:name w:val="heading 2"/></w:style><w:style w:styleId="LB"><w:name w:val="List Bullet"/></w:style></w:styles>',
        "docProps/core.xml": '<c xmlns:d="d"><d:creator>Ana</d:creator><d:title>T</d:title></c>',
    })


def xlsx():
    sheet = '<worksheet><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>1500.5</v></c></row><row r="2"><c r="A2" s="1"><v>46037</v></c><c r="B2"><v>890</v></c></row></sheetData></worksheet>'
    return package({
        "[Content_Types].xml": types(parsers.MAIN_TYPES[".xlsx"][0]), "xl/workbook.xml": '<workbook xmlns:r="r"><sheets><sheet name="Date" r:id="r1"/><sheet name="Goala" r:id="r2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<R><X Id="r1" Target="worksheets/s1.xml"/><X Id="r2" Target="worksheets/s2.xml"/></R>', "xl/worksheets/s1.xml": sheet, "xl/worksheets/s2.xml": "<worksheet><sheetData/></worksheet>",
        "xl/sharedStrings.xml": "<sst><si><t>cap</t></si></sst>", "xl/styles.xml": '<styleSheet><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
    })


@pytest.fixture
def folder(tmp_path):
    files = {
        "a.txt": b"procedu-\nra  noua", "b.md": b"# t\n\n  - x", "c.csv": b'k,v\r\n"a\nb",2\r\n', "d.json": b'[{"b": 1.50, "a": true}, {"b": null, "a": {"x": 1}}]', "e.json": b'{"k": {"z": [1]}}', "bad.json": b"{",
        "f.xml": b"<r a='1'><c>t</c>tail</r>", "evil.xml": b"<!DOCTYPE r><r/>", "g.html": b"<body><p>one<p>two <b>x</b><ul><li>i</ul><table><tr><td>1<td>2</table><script>no</script></body>",
        "h.docx": docx(), "i.xlsx": xlsx(), "broken.docx": b"PK\x03\x04junk", "j.png": b"\x89PNG\r\n\x1a\n" + b"\0" * 4 + b"IHDR" + (10).to_bytes(4, "big") * 2, "k.pdf": b"%PDF-1.4", "l.xyz": b"?",
    }
    for name, body in files.items():
        (tmp_path / name).write_bytes(body)
    return tmp_path


def test_folder(spark, folder):
    files = documents.scan_files(spark, str(folder))
    got = {r.path.rpartition("/")[2]: r for r in documents.extract(files).collect()}
    assert "l.xyz" not in got and len(got) == 14
    assert {n: r.error_category for n, r in got.items() if r.error_category} == {"bad.json": "malformed", "evil.xml": "malformed", "broken.docx": "malformed", "k.pdf": "unsupported"}
    assert got["h.docx"].author == "Ana" and got["j.png"].warnings[0].code == "OCR_UNAVAILABLE"
    blocks = {}
    for r in documents.blocks(documents.extract(files)).orderBy("path", "unit", "ord").collect():
        blocks.setdefault(r.path.rpartition("/")[2], []).append(r)
    said = lambda n: [b.rows if b.type == "table" else b.content for b in blocks[n]]
    assert said("a.txt") == ["procedura noua"] and said("b.md") == ["# t\n\n  - x"]
    assert said("c.csv") == [[["k", "v"], ["a\nb", "2"]]]
    assert said("d.json") == [[["b", "a"], ["1.5", "True"], ["None", '{"x": 1}']]] and said("e.json") == ["k:\nz:\n[0]: 1"]
    assert said("f.xml") == ['r a="1":\nc: t\ntail'] and said("g.html") == ["one", "two x", "i", [["1", "2"]]]
    assert said("h.docx") == ["Titlu", "- unu\n- doi\n\ntext", [["a", ""]], "după"] and blocks["h.docx"][0].level == 2
    assert said("i.xlsx") == [[["cap", "", "1500.5"], ["2026-01-15 00:00:00", "890", ""]]]
    small = {r.path.rpartition("/")[2]: r.error_category for r in documents.extract(files, max_bytes=20).collect()}
    assert small["h.docx"] == "resource_limit" and small["a.txt"] is None


def test_limits():
    deep = "[" * 101 + "]" * 101
    with pytest.raises(parsers.Refused, match="deeper"):
        parsers.parse_json(deep.encode())
    with pytest.raises(parsers.Refused):
        parsers.parse_json(b"[[],[]]", most=2)
    with pytest.raises(parsers.Refused):
        parsers.parse_xml(b"<a><b><c/></b></a>", max_depth=2)


def one(spark, column, value):
    return spark.range(1).select(column(F.lit(value)).alias("x")).first().x


@pytest.mark.parametrize("raw,clean", [
    ("procedu-\nra", "procedura"), ("procedu-  \n   ra", "procedura"), ("well- known", "well- known"), ("0-\n[LOG] entry", "0-\n[LOG] entry"), ("Ţinţa e Ştiinţa", "Țința e Știința"), ("Bullet\uf0b7point", "Bulletpoint"),
    ("a\n   \n\t\nb", "a\n\nb"), ("na\u00c3\u00afve", "na\u00efve"), ("a\u00a0\u00a0b\u200bc\x00", "a bc"), ("", ""), (None, None),
])
def test_normalize(spark, raw, clean):
    assert one(spark, text.normalize, raw) == clean


def test_split_diacritics(spark):
    cases = [("p ă mânt", "pământ"), ("rezisten ţ a", "rezistenţa"), ("fizic ă a fost", "fizică a fost"), ("Terzaghi ș i", "Terzaghi și"), ("cauz ă cu", "cauză cu"), ("de ap ă .", "de apă ."), ("", ""), (None, None), ("fizic ă", "fizică")]
    texts = spark.createDataFrame([(1, n, broken) for n, (broken, _) in enumerate(cases)], "doc_id int, text_no int, text string")
    native = spark.createDataFrame([(1, "pământ rezistența fizică"), (1, "și apă"), (2, "cauzăcu"), (None, None)], "doc_id int, text string")
    assert {r.text_no: r.text for r in diacritics.rejoin(texts, native).collect()} == {n: whole for n, (_, whole) in enumerate(cases)}
    assert diacritics.rejoin(texts.limit(0), native).count() == 0 and diacritics.rejoin(texts, native.limit(0)).where("text_no = 3").first().text == "Terzaghiș i"


def test_damage_rates(spark):
    got = one(spark, text.intruded_words, "pas6sengers cKonditions Passage a.b@c.de exception(s): or")
    assert (got.words, got.corrupted) == (4, 2)


def test_markup(spark):
    assert one(spark, markup.formula_balanced, r"\left( x \right)") and not one(spark, markup.formula_balanced, r"\left( x") and one(spark, markup.formula_balanced, r"a \leftarrow b \{")
    assert not one(spark, markup.formula_balanced, "a } b {")
    assert one(spark, markup.display_math, "a & b \\\\ ") == "$$\n\\begin{aligned}\na & b\n\\end{aligned}\n$$"


def test_a_table_of_too_many_cells_is_refused_with_its_file(spark, folder):
    files = documents.scan_files(spark, str(folder))
    got = {r.path.rpartition("/")[2]: r for r in documents.extract(files, max_cells=3).collect()}
    assert {n for n, r in got.items() if r.error_category == "resource_limit"} == {"c.csv", "d.json", "i.xlsx"}
    assert got["c.csv"].units == [] and got["c.csv"].error == "a table of 4 cells" and got["h.docx"].error_category is None


def test_reading_order():
    two = [(72, 72, 250, 90, 0), (350, 72, 500, 90, 1), (72, 100, 250, 118, 2), (350, 100, 500, 118, 3)]
    assert reading_order.order_page(two) == ([0, 2, 1, 3], 2, True)
    assert reading_order.order_page([(72, 10, 500, 30, 9), *two])[0] == [9, 0, 2, 1, 3]
    assert reading_order.order_page([]) == ([], 0, False)


def test_table_rendering(spark):
    grid = F.array(F.array(F.lit("a|b")), F.array(F.lit("x\ny"), F.lit("z")))
    assert spark.range(1).select(render.gfm_table(grid).alias("x")).first().x == "| a\\|b |  |\n| --- | --- |\n| x<br>y | z |"


def test_sinks_and_stream(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    rows = spark.createDataFrame([("a.json", '{"b":1,"ă":[1]}')], "name string, body string")
    committed.write_files(rows.select("name", sinks.indented_json("body").alias("body")), str(out))
    assert json.loads((out / "a.json").read_text()) == {"b": 1, "ă": [1]}
    stream = ingest.extract_to(spark, str(folder), str(out / "blocks"), str(out / "state"))
    stream.awaitTermination(120)
    assert spark.read.parquet(str(out / "blocks")).where("path like '%a.txt'").first().content == "procedura noua"


def test_command_line(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("run")
    (out / "markdown").mkdir()
    (out / "markdown" / "a.notes.md").write_text("stale")
    options = ["--input", str(folder), "--output", str(out), "--log-file", str(out / "log")]
    assert cli.main(options, spark) == 1
    written = {p.name for p in (out / "json").iterdir() if p.suffix == ".json"}
    assert written == {"a.json", "b.json", "c.json", "d.json", "e.json", "f.json", "g.json", "h.json", "i.json", "j.json"}
    model = json.loads((out / "json" / "i.json").read_text())
    assert model["document"] == {"filename": "i.xlsx", "source_type": "xlsx", "pages": 1, "author": "", "title": "", "has_images": False, "image_count": 0, "schema_version": "2.0"}
    assert model["pages"] == [{"unit": 1, "unit_type": "sheet", "has_images": False, "image_count": 0, "title": "Date", "content": [{"type": "table", "content": [["cap", "", "1500.5"], ["2026-01-15 00:00:00", "890", ""]]}]}]
    assert (out / "markdown" / "h.md").read_text() == "# h.docx\n\n## Section 1\n\n#### Titlu\n\n- unu\n- doi\n\ntext\n\n### Table\n\n| a |  |\n| --- | --- |\n\ndup\u0103\n"
    assert not (out / "markdown" / "a.notes.md").exists() and (out / "markdown" / "j.notes.md").read_text().startswith("# Extraction Notes\n\n- ")
    assert "14 file(s): 10 succeeded, 4 failed" in (out / "log").read_text()
    empty = tmp_path_factory.mktemp("none")
    assert cli.main(["--input", str(empty), *options[2:]], spark) == 0 and cli.main(["--input", str(empty / "no"), *options[2:]], spark) == 2


def test_block_markdown(spark):
    rows = [("text", "x", "ocr", 0.815, None), ("text", "x", "vlm", None, None), ("header", "h", None, None, None), ("image", None, None, None, "i.png"), ("text", "", None, None, None)]
    frame = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, type string, content string, source string, confidence double, image_path string")
    drawn = sinks.block_markdown(frame.withColumns({"rows": F.lit(None).cast("array<array<string>>"), "level": F.lit(None).cast("int")})).orderBy("n")
    assert [r.md for r in drawn.collect()] == ["> Text recovered by OCR (confidence 82%)\n\nx", "> Read from the page image by the visual model\n\nx", None, "![](i.png)", None]
