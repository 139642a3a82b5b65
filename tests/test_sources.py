import base64
import io
import json
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from lodestrata.sources import adapters, capture, html, images, mail, office, sinks, tabular

PAGE = """<html><head><title>T &amp; x</title><style>.a{}</style><script>var a;</script></head><body><h1>Head</h1>
<p>Some <code>inline</code> text<br>second <a href="https://x.org/a">link</a></p><pre>  keep
  this</pre><ul><li>one<li>two</ul><img src="i.png" alt="a picture">
<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr><tr><td colspan=2>w</td></tr><tr><td>5</td><td>6</td></tr></table></body></html>"""


def test_html_blocks():
    rows = html.read_html(PAGE)
    kinds = [(k, t) for _, k, t in rows]
    for want in [("title", "T & x"), ("heading", "Head"), ("paragraph", "Some inline text\nsecond link"), ("code", "  keep\n  this"), ("list_item", "one"), ("list_item", "two"), ("resource_reference", "https://x.org/a"), ("image_alt", "a picture"), ("table_header", "A | B"), ("table_row", "A: 1 | B: 2"), ("warning", "width_differs_from_headers"), ("table_row", "5 | 6")]:
        assert want in kinds, want
    assert not any("var a" in t or ".a{}" in t for _, t in kinds)
    assert all(loc.startswith("/html=1") for loc, _, _ in rows)
    html.read_html("<p" + "<" * 1000 + "</div></p><table><td>x")


def test_csv():
    raw = 'id;text\r\n007;"two\r\nlines"\r\n8;=1+1\r\n'.encode()
    assert [r[0] for r in tabular.csv_rows(raw, ";")] == ["/line=1", "/lines=2-3", "/line=4"]
    assert tabular.csv_rows(raw, ";")[1][2] == '["007","two\\r\\nlines"]'
    named = tabular.csv_rows(raw, ";", "first-row")
    assert named[0] == ("/line=1", "table_header", '["id","text"]')
    assert json.loads(named[1][2]) == [{"column": 1, "header": "id", "value": "007"}, {"column": 2, "header": "text", "value": "two\r\nlines"}]
    assert ("/", "warning", "ragged_rows") in tabular.csv_rows(b"a,b\n1\n") and ("/", "warning", "single_column") in tabular.csv_rows(b"a\nb\n")
    assert ("/line=1", "warning", "duplicate_header") in tabular.csv_rows(b"a,a\n1,2\n", headers="first-row")
    with pytest.raises(ValueError):
        tabular.csv_rows(b"\na,b\n", headers="first-row")


def test_json_faults():
    for text, want in [('{"a":1,"a":2}', "duplicate_key"), ('{"a":NaN}', "not_a_number"), ("{", "syntax"), ('﻿{"a":1}', None), (None, "missing")]:
        assert tabular.json_fault(text) == want


def test_json_files_and_history(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":"x","n":1}')
    (tmp_path / "b.json").write_text('{"id":"x","id":"y"}')
    assert [(r.id, r.n) for r in tabular.read_json(spark, [str(tmp_path / "a.json")], "id string, n long").collect()] == [("x", 1)]
    with pytest.raises(ValueError, match="duplicate_key"):
        tabular.read_json(spark, [str(tmp_path / "b.json")], "id string").collect()
    (tmp_path / "log").write_text('{"run_id":"1"}\n\n{"run_id":"2"}\n')
    assert tabular.history(spark, str(tmp_path / "log"), "run_id string").count() == 2
    (tmp_path / "log2").write_text('{"run_id":"1"}\n{"run_id":"1"}\n')
    with pytest.raises(ValueError):
        tabular.history(spark, str(tmp_path / "log2"), "run_id string")


def test_mail():
    raw = b"From: a@x\r\nSubject: =?utf-8?q?H=C3=A9?=\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=B\r\n\r\n--B\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nhello\r\n> old\r\n> older\r\nbye\r\n--B\r\nContent-Type: text/html\r\n\r\n<p>hi <img src=\"cid:gone\"></p>\r\n--B\r\nContent-Type: application/pdf\r\nContent-Disposition: attachment; filename=x.pdf\r\nContent-Transfer-Encoding: base64\r\n\r\n" + base64.b64encode(b"data") + b"\r\n--B--\r\n"
    got = [(k, t) for _, k, t in mail.read_eml(raw)]
    for want in [("header", "a@x"), ("header", "Hé"), ("body", "hello"), ("quoted_reply", "> old\n> older"), ("body", "bye"), ("paragraph", "hi"), ("attachment", "x.pdf (application/pdf, 4 bytes)"), ("warning", "missing_cid gone")]:
        assert want in got, (want, got)


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k, v in members.items():
            z.writestr(k, v)
    return out.getvalue()


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:w14="http://schemas.microsoft.com/office/word/2010/wordml" xmlns:w15="http://schemas.microsoft.com/office/word/2012/wordml"'
P = "<w:p><w:r><w:t>{}</w:t></w:r></w:p>"


def docx(body, **more):
    return zipped(**{"word/document.xml": f"<w:document {W}><w:body>{body}</w:body></w:document>", **more})


def comment(i, para, text):
    return f'<w:comment w:id="{i}" w:author="Me"><w:p w14:paraId="{para}"><w:r><w:t>{text}</w:t></w:r></w:p></w:comment>'


def test_documents_and_comments():
    table = f"<w:tbl><w:tr><w:tc>{P.format('cell')}</w:tc></w:tr></w:tbl>"
    more = {"word/comments.xml": f"<w:comments {W}>{comment(0, 'A', 'first')}{comment(1, 'B', 'reply')}</w:comments>", "word/commentsExtended.xml": f'<w15:commentsEx {W}><w15:commentEx w15:paraId="A" w15:done="1"/><w15:commentEx w15:paraId="B" w15:paraIdParent="A" w15:done="0"/></w15:commentsEx>'}
    got = office.read_docx(docx(P.format("para") + table, **more))
    assert ("/body/p=1", "paragraph", "para") in got and ("/body/tbl=1/row=1/cell=1/p=1", "table_cell", "cell") in got
    assert ("/comment=1", "comment", "Me: reply [reply to 0] [open]") in got and ("/comment=0", "comment", "Me: first [resolved]") in got
    loop = dict(more) | {"word/commentsExtended.xml": f'<w15:commentsEx {W}><w15:commentEx w15:paraId="A" w15:paraIdParent="B"/><w15:commentEx w15:paraId="B" w15:paraIdParent="A"/></w15:commentsEx>'}
    for bad, code in [(docx("<w:p><w:ins/></w:p>"), "tracked_changes"), (docx("", **loop), "reply_cycle"), (docx("", **{"../x": "y"}), "unsafe_member"), (docx("", **{"word/vbaProject.bin": "y"}), "macros"), (b"PK", "not_a_container"), (zipped(**{"word/document.xml": '<!DOCTYPE x [<!ENTITY a "b">]><x/>'}), "dtd")]:
        assert adapters.extract(bad, "x.docx") == [("/", "error", code)]


def test_workbooks_and_slides():
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    rel = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="{}"/></Relationships>'
    cells = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><f>1+1</f><v>2</v></c></row><row r="2" hidden="1"><c r="A2" t="inlineStr"><is><t>in</t></is></c></row>'
    book = {"xl/workbook.xml": f'<workbook {s}><workbookPr date1904="1"/><sheets><sheet name="S" r:id="r1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": rel.format("sheet1.xml"), "xl/sharedStrings.xml": f"<sst {s}><si><t>shared</t></si></sst>", "xl/sheet1.xml": f"<worksheet {s}><sheetData>{cells}</sheetData></worksheet>"}
    got = office.read_xlsx(zipped(**book))
    assert [(k, t) for _, k, t in got] == [("warning", "dates_from_1904"), ("cell", "shared"), ("formula", "=1+1"), ("cached_value", "2"), ("hidden_cell", "in")]
    twice = book | {"xl/sheet1.xml": f'<worksheet {s}><sheetData><row><c r="A1"><v>1</v></c><c r="A1"><v>2</v></c></row></sheetData></worksheet>'}
    assert adapters.extract(zipped(**twice), "x.xlsx") == [("/", "error", "duplicate_cell")]
    p = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    deck = {"ppt/presentation.xml": f'<p:presentation {p}><p:sldIdLst><p:sldId r:id="r1"/></p:sldIdLst></p:presentation>', "ppt/_rels/presentation.xml.rels": rel.format("slides/s1.xml"), "ppt/slides/s1.xml": f'<p:sld {p} show="0"><p:sp><a:p><a:r><a:t>Hi</a:t></a:r></a:p></p:sp><a:tbl><a:tr><a:tc><a:t>c1</a:t></a:tc><a:tc><a:t>c2</a:t></a:tc></a:tr></a:tbl></p:sld>'}
    assert [(k, t) for _, k, t in office.read_pptx(zipped(**deck))] == [("warning", "hidden_slide"), ("shape_text", "Hi"), ("table_row", "c1 | c2")]


def png(w=2, h=2, depth=8, colour=0, data=None, **k):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    data = b"".join(b"\0" * (1 + w) for _ in range(h)) if data is None else data
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, k.get("interlace", 0))) + chunk(b"tEXt", b"k\0v") + chunk(b"IDAT", zlib.compress(data)) + chunk(b"IEND", b"")


def test_images():
    assert images.read_png(png()) == [("/", "image", "2x2, depth 8, colour type 0"), ("/tEXt=k", "image_text", "v")]
    for raw, code in [(png(data=b"\0" * 5), "too_little_image_data"), (png(data=b"\0" * 7), "too_much_image_data"), (png(data=b"\x09\0\0" * 2), "bad_filter"), (png(colour=3), "no_palette"), (png()[:-3], "truncated"), (png().replace(b"k\0v", b"k\0w"), "bad_crc"), (png(w=9000, h=9000, data=b""), "too_many_pixels"), (b"x", "not_png")]:
        assert adapters.extract(raw, "x.png") == [("/", "error", code)], code
    assert images.read_png(png(interlace=1, data=b"\0\0" + b"\0\0" + b"\0\0\0"))
    svg = b'<svg xmlns="http://www.w3.org/2000/svg"><g><text x="1">A <tspan>b</tspan></text><rect id="r" width="2"/></g><script>x</script></svg>'
    assert images.read_svg(svg) == [("/svg=1/g=1/text=1", "label", "A b"), ("/svg=1/g=1/rect=1", "shape", "rect id=r width=2")]


def test_dispatch_and_segments(spark):
    files = spark.createDataFrame([(1, "a.html", PAGE.encode()), (2, "b.csv", b"x,y\n1,2\n"), (3, "c.exe", b""), (4, "d.html", b"\xff")], "id long, relative_path string, content binary")
    got = adapters.extracted(files)
    by = {}
    for r in got.collect():
        by.setdefault(r.id, []).append(r)
    assert [r.text for r in by[3]] == ["unsupported_format"] and [r.content_type for r in by[4]] == ["error"] and len(by[2]) == 2
    placed = adapters.segments(got)
    texts = {r.id: r.text.split("\n") for r in adapters.derived_text(placed).collect()}
    for r in placed.collect():
        assert texts[r.id][r.label_line - 1] == f"## Location: {r.locator}" and "\n".join(texts[r.id][r.start - 1 : r.end]) == r.text


def test_capture(spark, tmp_path):
    for name, raw in [("a.md", b"\xef\xbb\xbfone\ntwo\n"), ("sub/b.md", "é".encode()), ("sub/bad.md", b"\xff"), ("node_modules/c.md", b"x"), (".env", b"k"), ("nul.txt", b"a\0b"), ("empty.md", b" \n")]:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    files = capture.scanned(spark, str(tmp_path), "req", ["**/*.md", "**/*.txt", "**/.env"], ["sub/none/**"])
    t = {r.relative_path: r for r in capture.texts(files, "p", "requirements").collect()}
    assert sorted(t) == ["a.md", "empty.md", "nul.txt", "sub/b.md", "sub/bad.md"]
    assert t["a.md"].text == "one\ntwo\n" and t["a.md"].lines == ["one", "two"] and t["sub/bad.md"].issue == "not_utf8" and t["nul.txt"].issue == "holds_nul" and t["empty.md"].warning == "blank_file"
    assert t["a.md"].logical_id.startswith("F-") and t["a.md"].evidence_id != t["a.md"].logical_id
    assert capture.lines(capture.texts(files, "p", "x")).where("text = 'two'").first().line_no == 2
    assert {r.path: r.code for r in capture.left_out(spark, str(tmp_path), "req", ["**/*.md"], largest=3).collect()}["a.md"] == "file_too_large"
    assert [r.relative_path for r in capture.members(spark, str(tmp_path), "req", ["sub/b.md"]).collect()] == ["sub/b.md"]
    prov = spark.createDataFrame([("req", "a.md", {"tabs": "unknown"}, [], None), ("req", "zzz", {}, [], None)], "source_id string, relative_path string, features map<string,string>, limitations array<string>, authorship string")
    f = capture.texts(files, "p", "requirements")
    assert {r.relative_path for r in capture.unused_provenance(f, prov).collect()} == {"zzz"}
    assert capture.provenance_warnings(f, prov).groupBy("code").count().where("code = 'provenance_incomplete'").first()["count"] == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i long, s string")
    root = str(tmp_path / "kb")
    assert sinks.digest(df) == sinks.digest(df.orderBy(F.desc("i")).repartition(3)) != sinks.digest(df.limit(1))
    sinks.create(df, root + "/t")
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.create(df, root + "/t")
    sinks.publish(df, root, "run1", "2026-01-01")
    sinks.publish(df, root, "run2", "2026-01-02")
    assert sinks.pointed(spark, root + "/CURRENT")["run_id"] == "run2" and spark.read.json(root + "/publications").count() == 2
    with pytest.raises(FileExistsError):
        sinks.publish(df, root, "run1", "2026-01-03")
    assert sinks.rebuilt(df, root + "/idx") and not sinks.rebuilt(df.repartition(2), root + "/idx") and sinks.rebuilt(df.limit(1), root + "/idx")
    with pytest.raises(Exception):
        sinks.commit({"a": df, "b": df.select(F.raise_error(F.lit("no")))}, root, "broken")
    assert not sinks.exists(spark, root + "/broken") and not list((tmp_path / "kb").glob(".tmp-*"))


def test_images_and_markup_that_would_grow_are_refused():
    import struct
    import zlib

    from lodestrata.sources import images, office

    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = lambda w, h: b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0))
    good = zlib.compress(b"\0" + b"x" * 4)
    assert images.read_png(head(4, 1) + chunk(b"IDAT", good) + chunk(b"IEND", b""))
    for bad in (head(4, 1) + chunk(b"IDAT", zlib.compress(b"\0" * 50_000_000)), head(4, 1) + chunk(b"IDAT", good + b"more"), head(4, 1) + chunk(b"ABCD", b"") + chunk(b"IDAT", good)):
        with pytest.raises(images.Refused):
            images.read_png(bad + chunk(b"IEND", b""))
    for raw in (b"<!DOCTYPE a><a/>", '<?xml version="1.0" encoding="utf-16"?><!DOCTYPE a [<!ENTITY x "y">]><a>&x;</a>'.encode("utf-16"), b" " * 70_000 + b"<!DOCTYPE a><a/>"):
        with pytest.raises(office.Refused):
            office.xml(raw)
    assert office.xml(b"<a><b/></a>").tag == "a"


def test_charsets_and_budgets():
    from lodestrata.sources import adapters, charset
    from lodestrata.sources.office import Refused

    assert charset.decoded("é".encode(), None) == charset.decoded("é".encode("cp1252"), " Windows-1252 ") == charset.decoded(b"\xef\xbb\xbf" + "é".encode(), "utf8") == "é"
    for raw, declared, code in ((b"x", "utf-7", "unsupported_charset"), (b"\xef\xbb\xbfx", "latin-1", "charset_conflict"), (b"\xe9", "us-ascii", "charset_decode_error"), (b"\xe9", None, "charset_decode_error")):
        with pytest.raises(Refused, match=code):
            charset.decoded(raw, declared)
    assert ("/p=1", "paragraph", "é") in adapters.extract(b"<meta charset=iso-8859-1><p>\xe9</p>", "a.html")
    assert adapters.extract(b"<meta charset=x-odd><p>a</p>", "a.html") == [("/", "error", "unsupported_charset")]
    assert adapters.extract(b"<div>" * 600, "a.html") == [("/", "error", "too_deep")]
    assert adapters.extract(b"<br>" * 200_001, "a.html") == [("/", "error", "too_many_nodes")]
    rows = adapters.extract(b"<video poster='p.png'></video><table><caption>Sums</caption><tr><td>1</td></tr></table>", "a.html")
    assert ("/video=1/@poster", "resource_reference", "p.png") in rows and any(k == "caption" and t == "Sums" for _, k, t in rows)


def test_contracts(spark):
    from lodestrata.sources import contracts

    schema = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"anyOf": [{"type": "null"}, {"type": "integer", "minimum": 1}]}, "b": {"type": "array", "minItems": 1, "maxItems": 2, "uniqueItems": True, "items": {"enum": ["x", 1]}}, "c": {"type": "string", "minLength": 2, "maxLength": 3, "pattern": "^q"}, "d": {"const": True}, "e": {"type": ["number", "boolean"]}}}
    for text, want in [('{"a": null}', None), ('{"a": 1, "b": ["x", 1], "c": "qq", "d": true, "e": 1.5}', None), ("[]", "$: type"), ("{}", "$.a: required"), ('{"a": true}', "$.a: anyOf"), ('{"a": 0}', "$.a: anyOf"), ('{"a": 1, "z": 1}', "$.z: additionalProperties"), ('{"a": 1, "b": []}', "$.b: minItems"), ('{"a": 1, "b": [1, 1]}', "$.b: uniqueItems"), ('{"a": 1, "b": [1, true]}', "$.b[1]: enum"), ('{"a": 1, "b": [1, 2, 3]}', "$.b: maxItems"), ('{"a": 1, "c": "q"}', "$.c: minLength"), ('{"a": 1, "c": "qqqq"}', "$.c: maxLength"), ('{"a": 1, "c": "xx"}', "$.c: pattern"), ('{"a": 1, "d": 1}', "$.d: const"), ('{"a": 1, "e": "1"}', "$.e: type")]:
        assert contracts.text_fault(text, schema) == want, text
    assert contracts.text_fault('{"a": 1, "a": 2}', schema).startswith("$: ")
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 0}',)], "t string")
    assert contracts.valid(df.limit(1), "t", schema).count() == 1
    with pytest.raises(ValueError, match="anyOf"):
        contracts.valid(df, "t", schema)
