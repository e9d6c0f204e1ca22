"""PDF files built by hand: scan, tables, damage, and whole files through the extraction."""

import zlib

import pytest

from leafmill.sources import documents, pdf
from leafmill.sources.parsers import Refused

FONT = b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding /FirstChar 32 /Widths [" + b" ".join([b"500"] * 224) + b"] >>"


def build(contents, extra=None, page=b"", compress=True):
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: FONT, 4: b"<< /Title (A \\(t\\)) /Author <FEFF0041006E0061> >>"} | (extra or {})
    kids = []
    for k, content in enumerate(contents):
        body = zlib.compress(content) if compress else content
        objects[100 + 2 * k] = b"<< /Length %d %s>>\nstream\n" % (len(body), b"/Filter /FlateDecode " if compress else b"") + body + b"\nendstream"
        objects[101 + 2 * k] = b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 612 792] %s /Resources << /Font << /F1 3 0 R /F2 5 0 R >> /XObject << /X 6 0 R /P 7 0 R >> >> /Contents %d 0 R >>" % (page, 100 + 2 * k)
        kids.append(b"%d 0 R" % (101 + 2 * k))
    objects[2] = b"<< /Type /Pages /Count %d /Kids [%s] >>" % (len(kids), b" ".join(kids))
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, objects[n]) for n in sorted(objects)) + b"trailer << /Root 1 0 R /Info 4 0 R >>\n%%EOF"


def say(text, x, y, size=12, font=b"F1"):
    return b"BT /%s %d Tf %d %d Td (%s) Tj ET\n" % (font, size, x, y, text)


GRID = b"100 300 200 60 re S 100 330 m 300 330 l S 200 300 m 200 360 l S " + say(b"a1", 110, 340, 8) + say(b"b1", 210, 340, 8) + say(b"a2", 110, 310, 8) + say(b"b2", 210, 310, 8)


def test_words_places_and_text_operators():
    body = b"BT /F1 12 Tf 72 700 Td (Hello w\\366rld) Tj 0 -14 Td (second \\(line\\)) Tj 14 TL T* [(Ker) -20 (ned) -600 (gap)] TJ (next) ' ET"
    info, (page,) = pdf.scan(build([body]))
    assert info == {"title": "A (t)", "author": "Ana"} and (page.width, page.height) == (612, 792) and page.fonts == {"Helvetica"}
    found = pdf.words(page)
    assert [(w[0], w[1], w[3]) for w in found] == [(0, 0, "Hello"), (0, 0, "wörld"), (0, 1, "second"), (0, 1, "(line)"), (0, 2, "Kerned"), (0, 2, "gap"), (0, 3, "next")]
    assert [round(x, 1) for x in found[0][4:]] == [72.0, 82.4, 102.0, 94.4, 1.0, 0.0]
    ((turned),) = pdf.scan(build([body], page=b"/Rotate 90"))[1]
    assert (turned.width, turned.height) == (792, 612) and [w[3] for w in pdf.words(turned)][:2] == ["Hello", "wörld"] and pdf.words(turned)[0][8:] == (0.0, 1.0)


def test_fonts_forms_pictures_and_grids():
    cmap = zlib.compress(b"1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <0041> <0002> <00660069> endbfchar 1 beginbfrange <0010> <0012> <0061> endbfrange")
    extra = {
        5: b"<< /Type /Font /Subtype /Type0 /BaseFont /Wide /Encoding /Identity-H /DescendantFonts [<< /DW 600 /W [1 [700 800] 16 18 400] >>] /ToUnicode 8 0 R >>",
        6: b"<< /Subtype /Form /Matrix [1 0 0 1 10 0] /Length 60 /Resources << /Font << /F1 3 0 R >> >> >>\nstream\n" + say(b"inside", 60, 600) + b"endstream",
        7: b"<< /Subtype /Image /Width 1 /Height 1 /Length 1 >>\nstream\nx\nendstream",
        8: b"<< /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (len(cmap), cmap),
    }
    body = b"BT /F2 10 Tf 50 700 Td <000100020010001100120099> Tj ET /X Do q 100 0 0 50 200 500 cm /P Do Q " + GRID
    _, (page,) = pdf.scan(build([body], extra))
    found = pdf.words(page)
    assert [w[3] for w in found] == ["Afiabc�", "inside", "a1", "b1", "a2", "b2"] and round(found[1][4]) == 70
    assert page.images == [(7, 200.0, 242.0, 300.0, 292.0, 1, 1)]
    assert [d[0] for d in page.drawings] == ["re", "l", "l"]
    assert pdf.glyph_text("aacute") == "á" and pdf.glyph_text("scommaaccent") == "ș" and pdf.glyph_text("uni0103") == "ă" and pdf.glyph_text("g17") == "�" and pdf.glyph_text("equal.x") == "="


def test_object_streams_predictors_and_damage():
    inner = [(3, FONT), (1, b"<< /Type /Catalog /Pages 2 0 R >>")]
    heads, bodies = b"", b""
    for n, b in inner:
        heads += b"%d %d " % (n, len(bodies))
        bodies += b + b" "
    packed = zlib.compress(heads + bodies)
    whole = build([say(b"packed", 72, 700)])
    start = whole.index(b"2 0 obj")
    without = b"%PDF-1.5\n" + whole[start:].replace(b"3 0 obj\n" + FONT + b"\nendobj\n", b"")
    stream = b"50 0 obj\n<< /Type /ObjStm /N 2 /First %d /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream\nendobj\n" % (len(heads), len(packed), packed)
    assert [w[3] for w in pdf.words(pdf.scan(stream.join((without[:9], without[9:])))[1][0])] == ["packed"]
    rows = b"\x00abc" + b"\x02\x01\x01\x01" + b"\x01\x05\x01\x01"
    assert pdf._predict(rows, {"Predictor": 12, "Columns": 3}) == b"abcbcd\x05\x06\x07"
    cut_off = whole[: whole.index(b"trailer")]
    assert [w[3] for w in pdf.words(pdf.scan(cut_off)[1][0])] == ["packed"]
    for data, kind in ((b"%PDF-1.4", "unsupported"), (whole.replace(b"trailer <<", b"trailer << /Encrypt 9 0 R"), "encrypted")):
        with pytest.raises(Refused) as refused:
            pdf.scan(data)
        assert refused.value.category == kind


def test_files_are_put_together(spark, tmp_path):
    pages = []
    for k in range(4):
        body = say(b"Annual report %d" % (k + 1), 250, 770) + say(b"page %d" % (k + 1), 280, 20)
        for n in range(3):
            body += say(b"left %d on %d" % (n, k), 150, 600 - 40 * n) + say(b"right %d" % n, 350, 600 - 40 * n)
        if k == 1:
            body += GRID
        if k == 2:
            body += b"BT /F1 30 Tf 0.7 0.7 -0.7 0.7 200 200 Tm (DRAFT) Tj ET "
        pages.append(body)
    (tmp_path / "a.pdf").write_bytes(build(pages))
    (tmp_path / "b.pdf").write_bytes(build([b""]))
    (tmp_path / "c.pdf").write_bytes(b"junk")
    (tmp_path / "d.txt").write_bytes(b"plain")
    extracted = documents.extract(documents.scan_files(spark, str(tmp_path)))
    rows = {r.path.rpartition("/")[2]: r for r in extracted.collect()}
    assert rows["c.pdf"].error_category == "malformed" and rows["d.txt"].units[0].blocks[0].text == "plain"
    assert rows["a.pdf"].title == "A (t)" and [u.unit for u in rows["a.pdf"].units] == [1, 2, 3, 4] and rows["b.pdf"].units[0].blocks == []
    blocks = documents.blocks(extracted).where("path like '%a.pdf'").orderBy("unit", "ord").collect()
    second = [(b.type, b.rows if b.type == "table" else b.content) for b in blocks if b.unit == 2]
    left, right = "\n\n".join(f"left {n} on 1" for n in range(3)), "\n\n".join(f"right {n}" for n in range(3))
    assert second == [("header", "Annual report 2"), ("text", f"{left}\n\n{right}"), ("table", [["a1", "b1"], ["a2", "b2"]]), ("footer", "page 2")]
    codes = [(w.code, w.detail) for w in rows["a.pdf"].warnings]
    assert ("HEADER_FOOTER_DETECTED", "") in codes and ("ROTATED_TEXT_FILTERED", "DRAFT") in codes and ("POSSIBLE_TWO_COLUMN_ORDER", "page 1") in codes
    assert "DRAFT" not in " ".join(b.content or "" for b in blocks)


def test_a_damaged_page_loses_its_own_text_alone(spark, tmp_path):
    whole = build([say(b"first", 72, 700), say(b"second", 72, 700), say(b"third", 72, 700)], compress=False)
    at = whole.index(b"102 0 obj")
    damaged = whole[:at] + whole[at:].replace(b"<< /Length", b"<< /Filter /ASCII85Decode /Length", 1).replace(b"(second)", b"(s\xff{nd)", 1)
    (tmp_path / "a.pdf").write_bytes(damaged)
    (row,) = documents.extract(documents.scan_files(spark, str(tmp_path))).collect()
    assert row.error_category is None and [[b.text for b in u.blocks] for u in row.units] == [["first"], [], ["third"]]
    assert [(w.code, w.detail.split(";")[0]) for w in row.warnings] == [("PAGE_UNREADABLE", "page 2")]
