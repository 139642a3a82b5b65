"""Office containers: workbooks, documents with comments, and slides, read from their XML parts."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from xml.etree import ElementTree as X

MEMBERS, UNPACKED, RATIO, CELLS = 5_000, 200_000_000, 200, 100_000
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_W14 = "{http://schemas.microsoft.com/office/word/2010/wordml}"
_W15 = "{http://schemas.microsoft.com/office/word/2012/wordml}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"

Row = tuple[str, str, str]


class Refused(ValueError):
    """A document that is not read, with a code."""

    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


def parts(raw: bytes) -> dict[str, bytes]:
    """The members of a container that passes the guard: sizes, names, links, encryption, macros."""
    try:
        z = zipfile.ZipFile(io.BytesIO(raw))
    except zipfile.BadZipFile:
        raise Refused("not_a_container") from None
    infos = z.infolist()
    if len(infos) > MEMBERS or sum(i.file_size for i in infos) > UNPACKED:
        raise Refused("container_too_large")
    if len({i.filename for i in infos}) < len(infos):
        raise Refused("duplicate_member")
    for i in infos:
        if i.filename.startswith(("/", "\\")) or ".." in i.filename.replace("\\", "/").split("/") or ":" in i.filename:
            raise Refused("unsafe_member")
        if (i.external_attr >> 16) & 0o170000 == 0o120000:
            raise Refused("linked_member")
        if i.flag_bits & 1:
            raise Refused("encrypted")
        if i.compress_size and i.file_size / i.compress_size > RATIO:
            raise Refused("compression_ratio")
        if i.filename.lower().endswith("vbaproject.bin"):
            raise Refused("macros")
    return {i.filename: z.read(i) for i in infos if not i.is_dir()}


class _NoTypes(X.TreeBuilder):
    """Refuses a document type, which is where entities are declared, whatever encoding it comes in."""

    def doctype(self, name, pubid, system):
        raise Refused("dtd")


def xml(raw: bytes) -> X.Element:
    if re.search(rb"<!(?:DOCTYPE|ENTITY)", raw[:65536]):
        raise Refused("dtd")
    try:
        return X.fromstring(raw, parser=X.XMLParser(target=_NoTypes()))
    except X.ParseError:
        raise Refused("malformed_xml") from None


def _relations(p: dict[str, bytes], part: str) -> dict[str, str]:
    folder, name = posixpath.split(part)
    raw = p.get(f"{folder}/_rels/{name}.rels")
    if raw is None:
        return {}
    return {r.get("Id"): posixpath.normpath(posixpath.join("/" if r.get("Target").startswith("/") else folder, r.get("Target"))).lstrip("/") for r in xml(raw) if r.get("TargetMode") != "External"}


def _media(p: dict[str, bytes], folder: str) -> list[Row]:
    return [(f"/{n}", "media", f"{posixpath.basename(n)} ({len(p[n])} bytes)") for n in sorted(p) if n.startswith(folder)]


def column(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n


def read_xlsx(raw: bytes) -> list[Row]:
    """Cells by sheet and address: values, and formulas with their cached values; hidden rows, columns and sheets are marked."""
    p = parts(raw)
    book, rel = xml(p["xl/workbook.xml"]), _relations(p, "xl/workbook.xml")
    shared = []
    if "xl/sharedStrings.xml" in p:
        shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in xml(p["xl/sharedStrings.xml"]).iter(f"{_S}si")]
    rows: list[Row] = []
    if (pr := book.find(f"{_S}workbookPr")) is not None and pr.get("date1904") in ("1", "true"):
        rows.append(("/workbook", "warning", "dates_from_1904"))
    n = 0
    for sheet in book.iter(f"{_S}sheet"):
        name = sheet.get("name")
        hidden = sheet.get("state", "visible") != "visible"
        root = xml(p[rel[sheet.get(f"{_R}id")]])
        gone = [(int(c.get("min")), int(c.get("max"))) for c in root.iter(f"{_S}col") if c.get("hidden") in ("1", "true")]
        seen = set()
        for r in root.iter(f"{_S}row"):
            for c in r.iter(f"{_S}c"):
                at = c.get("r")
                n += 1
                if n > CELLS:
                    raise Refused("too_many_cells")
                if at in seen:
                    raise Refused("duplicate_cell")
                seen.add(at)
                v, f, kind = c.find(f"{_S}v"), c.find(f"{_S}f"), c.get("t", "n")
                value = "".join(t.text or "" for t in c.iter(f"{_S}t")) if kind == "inlineStr" else v.text if v is not None else None
                if kind == "s" and value is not None:
                    value = shared[int(value)]
                if kind == "b" and value is not None:
                    value = "TRUE" if value == "1" else "FALSE"
                col = column(re.match(r"[A-Z]+", at)[0])
                out = hidden or r.get("hidden") in ("1", "true") or any(a <= col <= b for a, b in gone)
                where = f"/sheet={name}/cell={at}"
                if f is not None:
                    rows.append((where, "formula", f"={f.text or ''}"))
                    if value is not None:
                        rows.append((where, "cached_value", value))
                elif value not in (None, ""):
                    rows.append((where, "hidden_cell" if out else "cell", value))
    return rows


def _paragraph(p: X.Element) -> str:
    out = []
    for x in p.iter():
        if x.tag == f"{_W}t":
            out.append(x.text or "")
        elif x.tag == f"{_W}tab":
            out.append("\t")
        elif x.tag in (f"{_W}br", f"{_W}cr"):
            out.append("\n")
    return "".join(out).strip()


def _body(parent: X.Element, at: str) -> list[Row]:
    rows, n = [], {"p": 0, "tbl": 0}
    for x in parent:
        if x.tag == f"{_W}p":
            n["p"] += 1
            if text := _paragraph(x):
                style = x.find(f"{_W}pPr/{_W}pStyle")
                rows.append((f"{at}/p={n['p']}", "heading" if style is not None and (style.get(f"{_W}val") or "").lower().startswith(("heading", "title")) else "paragraph", text))
        elif x.tag == f"{_W}tbl":
            n["tbl"] += 1
            for i, r in enumerate(x.findall(f"{_W}tr"), 1):
                for j, c in enumerate(r.findall(f"{_W}tc"), 1):
                    rows += [(loc, "table_cell" if kind == "paragraph" else kind, t) for loc, kind, t in _body(c, f"{at}/tbl={n['tbl']}/row={i}/cell={j}")]
        elif x.tag == f"{_W}sdt":
            rows += [r for c in x.findall(f"{_W}sdtContent") for r in _body(c, f"{at}/sdt")]
    return rows


def read_docx(raw: bytes) -> list[Row]:
    """Paragraphs and nested tables in order, headers and footers, comments and media; tracked changes are refused."""
    p = parts(raw)
    root = xml(p["word/document.xml"])
    if any(x.tag in (f"{_W}ins", f"{_W}del", f"{_W}moveFrom", f"{_W}moveTo") for x in root.iter()):
        raise Refused("tracked_changes")
    rows = _body(root.find(f"{_W}body"), "/body")
    for name in sorted(n for n in p if re.fullmatch(r"word/(?:header|footer)\d*\.xml", n)):
        rows += _body(xml(p[name]), f"/{name[5:-4]}")
    rows += [(f"/comment={c['id']}", "comment", f"{c['author']}: {c['text']}" + (f" [reply to {c['parent']}]" if c["parent"] else "") + {True: " [resolved]", False: " [open]", None: ""}[c["resolved"]]) for c in comments(p, root)]
    return rows + _media(p, "word/media/")


def comments(p: dict[str, bytes], root: X.Element) -> list[dict]:
    """Comments joined with their extended data on paragraph ids: id, author, text, anchored, parent (id) and resolved (None where unknown)."""
    if "word/comments.xml" not in p:
        return []
    more = {}
    if "word/commentsExtended.xml" in p:
        for x in xml(p["word/commentsExtended.xml"]):
            para = x.get(f"{_W15}paraId")
            if para in more:
                raise Refused("duplicate_comment_paragraph")
            more[para] = x
    found, by_para = [], {}
    for c in xml(p["word/comments.xml"]).iter(f"{_W}comment"):
        paras = c.findall(f"{_W}p")
        last = paras[-1].get(f"{_W14}paraId") if paras else None
        row = {"id": c.get(f"{_W}id"), "author": c.get(f"{_W}author", ""), "text": "\n".join(t for t in map(_paragraph, paras) if t), "para": last}
        if any(r["id"] == row["id"] for r in found):
            raise Refused("duplicate_comment")
        found.append(row)
        if last:
            by_para[last] = row["id"]
    anchors = {x.get(f"{_W}id") for x in root.iter(f"{_W}commentRangeStart")} | {x.get(f"{_W}id") for x in root.iter(f"{_W}commentReference")}
    for row in found:
        x = more.get(row.pop("para"))
        parent = x.get(f"{_W15}paraIdParent") if x is not None else None
        if parent and parent not in by_para:
            raise Refused("dangling_reply")
        done = x.get(f"{_W15}done") if x is not None else None
        row |= {"parent": by_para.get(parent), "resolved": None if done is None else done in ("1", "true"), "anchored": row["id"] in anchors}
    up = {r["id"]: r["parent"] for r in found}
    for start in up:
        at, steps = up[start], 0
        while at is not None:
            at, steps = up.get(at), steps + 1
            if steps > len(up):
                raise Refused("reply_cycle")
    return found


def read_pptx(raw: bytes) -> list[Row]:
    """Shapes, groups and tables by slide, notes, and what images and charts there are; hidden slides are marked."""
    p = parts(raw)
    rel = _relations(p, "ppt/presentation.xml")
    rows: list[Row] = []
    for n, s in enumerate(xml(p["ppt/presentation.xml"]).iter(f"{_P}sldId"), 1):
        part = rel[s.get(f"{_R}id")]
        root = xml(p[part])
        at = f"/slide={n}"
        if root.get("show") in ("0", "false"):
            rows.append((at, "warning", "hidden_slide"))
        for i, sp in enumerate(root.iter(f"{_P}sp"), 1):
            text = "\n".join(t for t in ("".join(x.text or "" for x in para.iter(f"{_A}t")) for para in sp.iter(f"{_A}p")) if t)
            if text.strip():
                rows.append((f"{at}/shape={i}", "shape_text", text))
        for i, tbl in enumerate(root.iter(f"{_A}tbl"), 1):
            for j, tr in enumerate(tbl.iter(f"{_A}tr"), 1):
                rows.append((f"{at}/table={i}/row={j}", "table_row", " | ".join("".join(x.text or "" for x in tc.iter(f"{_A}t")) for tc in tr.iter(f"{_A}tc"))))
        for target in sorted(_relations(p, part).values()):
            if target.startswith("ppt/notesSlides/") and target in p:
                text = "\n".join(t for t in ("".join(x.text or "" for x in para.iter(f"{_A}t")) for para in xml(p[target]).iter(f"{_A}p")) if t)
                if text.strip():
                    rows.append((f"{at}/notes", "notes", text))
            elif target.startswith(("ppt/media/", "ppt/charts/")):
                rows.append((f"{at}/{posixpath.basename(target)}", "chart" if "/charts/" in target else "media", posixpath.basename(target)))
    return rows
