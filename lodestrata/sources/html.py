"""HTML as inert, located blocks: nothing is fetched, run or guessed."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from lodestrata.sources.frames import per_document
from lodestrata.sources.office import Refused

# Subtrees that hold no text, elements without an end, and elements that open a block.
SILENT = frozenset(("script", "style", "template", "noscript", "iframe", "object", "embed"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
BLOCKS = HEADINGS | frozenset(("p", "li", "pre", "blockquote", "td", "th", "caption", "figcaption", "dt", "dd", "title", "div", "section", "article", "header", "footer", "nav", "aside", "main", "body", "ul", "ol", "table", "tr", "thead", "tbody", "tfoot"))


#: What a page may hold: elements, elements within each other, table cells. Beyond it is refused, never cut.
NODES, DEPTH, CELLS = 200_000, 512, 100_000


class Located(HTMLParser):
    """Collects (locator, content_type, text); a locator is the path of tag=n from the root."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, str, str]] = []
        self.path: list[tuple[str, int]] = []
        self.counts: list[dict[str, int]] = [{}]
        self.text: list[str] = []
        self.silent = self.nodes = self.cells = 0
        self.tables: list[dict] = []

    def _locator(self) -> str:
        return "/" + "/".join(f"{t}={n}" for t, n in self.path)

    def _flush(self) -> None:
        raw = "".join(self.text)
        self.text = []
        inside = [t for t, _ in self.path]
        text = raw.strip("\n") if "pre" in inside else "\n".join(" ".join(x.split()) for x in raw.split("\n")).strip()
        if not text:
            return
        if self.tables and self.tables[-1]["cell"] is not None:
            self.tables[-1]["cell"].append(text)
            return
        tag = next((t for t in reversed(inside) if t in BLOCKS), "body")
        kind = "heading" if tag in HEADINGS else "code" if tag == "pre" else "list_item" if tag == "li" else "title" if tag == "title" else "caption" if tag == "caption" else "paragraph"
        self.rows.append((self._locator(), kind, text))

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._flush()
        if tag == "br":
            self.text.append("\n")
        self.nodes += 1
        if self.nodes > NODES:
            raise Refused("too_many_nodes")
        if len(self.path) >= DEPTH:
            raise Refused("too_deep")
        seen = self.counts[-1]
        seen[tag] = seen.get(tag, 0) + 1
        at = f"{self._locator().rstrip('/')}/{tag}={seen[tag]}"
        if not self.silent:
            for name, value in attrs:
                if name in ("href", "src", "data", "poster") and value:
                    self.rows.append((f"{at}/@{name}", "resource_reference", value.strip()))
                elif name == "alt" and value and value.strip():
                    self.rows.append((f"{at}/@alt", "image_alt", value.strip()))
        if tag in VOID:
            return
        self.path.append((tag, seen[tag]))
        self.counts.append({})
        if tag in SILENT:
            self.silent += 1
        if tag == "table":
            self.tables.append({"headers": None, "row": None, "cell": None, "all_th": True, "spanned": False, "n": 0, "at": self._locator()})
        elif self.tables and tag == "tr":
            self.tables[-1].update(row=[], all_th=True)
        elif self.tables and tag in ("td", "th") and self.tables[-1]["row"] is not None:
            self.cells += 1
            if self.cells > CELLS:
                raise Refused("too_many_cells")
            t = self.tables[-1]
            t["cell"] = []
            t["all_th"] = t["all_th"] and tag == "th"
            if any(k in ("rowspan", "colspan") and (v or "1").strip() not in ("", "1") for k, v in attrs):
                t["spanned"] = True

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID or all(t != tag for t, _ in self.path):
            return
        while self.path:
            top = self.path[-1][0]
            if top in BLOCKS:
                self._flush()
            if top in SILENT:
                self.silent -= 1
            if self.tables and top in ("td", "th") and self.tables[-1]["cell"] is not None:
                self.tables[-1]["row"].append("\n".join(self.tables[-1]["cell"]))
                self.tables[-1]["cell"] = None
            elif self.tables and top == "tr" and self.tables[-1]["row"] is not None:
                self._row(self.tables[-1])
            elif self.tables and top == "table":
                self.tables.pop()
            self.path.pop()
            self.counts.pop()
            if top == tag:
                break

    def _row(self, t: dict) -> None:
        """A row of headers names the columns of rows as wide as it; a span ends that for the rest of the table."""
        cells, t["row"] = t["row"], None
        t["n"] += 1
        if not any(cells):
            return
        at = f"{t['at']}/row={t['n']}"
        if t["all_th"]:
            if t["headers"] is None and not t["spanned"]:
                t["headers"] = cells
            elif t["headers"] is not None:
                self.rows.append((at, "warning", "further_header_row"))
            self.rows.append((at, "table_header", " | ".join(cells)))
        elif t["headers"] and not t["spanned"] and len(cells) == len(t["headers"]):
            self.rows.append((at, "table_row", " | ".join(f"{h}: {c}" for h, c in zip(t["headers"], cells, strict=True))))
        else:
            if t["headers"] and not t["spanned"]:
                self.rows.append((at, "warning", "width_differs_from_headers"))
            self.rows.append((at, "table_row", " | ".join(cells)))

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)


def read_html(text: str) -> list[tuple[str, str, str]]:
    p = Located()
    p.feed(re.sub(r"\r\n?", "\n", text))
    p.close()
    while p.path:
        p.handle_endtag(p.path[-1][0])
    p._flush()
    return p.rows


def blocks(df: DataFrame, key: str, html: str) -> DataFrame:
    """id, ordinal, locator, content_type and text of each block of each page; null pages have none."""


    def read(text: str) -> list[tuple[str, str, str]]:
        try:
            return read_html(text)
        except Refused as x:
            return [("/", "error", x.code)]

    return per_document(df, key, html, read, pa.string())
