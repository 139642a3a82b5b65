"""Vector and raster images: labels, and checks of structure; nothing is drawn."""

from __future__ import annotations

import struct
import zlib

from lodestrata.sources.office import Refused, Row, xml

NODES, DEPTH, PIXELS = 50_000, 200, 16_000_000
_SVG_TEXT = ("text", "title", "desc")
_SHAPES = ("rect", "circle", "ellipse", "line", "polyline", "polygon", "path", "image", "use")


def _name(tag: object) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def read_svg(raw: bytes) -> list[Row]:
    """Labels and shapes in document order, by an explicit stack with limits on nodes and depth."""
    root = xml(raw)
    if _name(root.tag) != "svg":
        raise Refused("not_svg")
    rows: list[Row] = []
    stack, n = [(root, "/svg=1", 1)], 0
    while stack:
        node, at, depth = stack.pop()
        n += 1
        if n > NODES:
            raise Refused("too_many_nodes")
        if depth > DEPTH:
            raise Refused("too_deep")
        name = _name(node.tag)
        if name in ("script", "foreignObject", "style"):
            continue
        if name in _SVG_TEXT:
            if text := " ".join("".join(node.itertext()).split()):
                rows.append((at, "label" if name == "text" else name, text))
            continue
        if name in _SHAPES:
            keep = {_name(k): v for k, v in node.attrib.items() if _name(k) in ("id", "x", "y", "width", "height", "cx", "cy", "r", "d", "points", "href")}
            rows.append((at, "shape", name + "".join(f" {k}={v}" for k, v in sorted(keep.items()))))
        counts: dict[str, int] = {}
        below = []
        for c in node:
            k = _name(c.tag)
            counts[k] = counts.get(k, 0) + 1
            below.append((c, f"{at}/{k}={counts[k]}", depth + 1))
        stack += reversed(below)
    return rows


def _chunks(raw: bytes):
    if raw[:8] != b"\x89PNG\r\n\x1a\n":
        raise Refused("not_png")
    at = 8
    while at < len(raw):
        if at + 12 > len(raw):
            raise Refused("truncated")
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + n]
        if len(body) < n or at + 12 + n > len(raw):
            raise Refused("truncated")
        if zlib.crc32(kind + body) != struct.unpack(">I", raw[at + 8 + n : at + 12 + n])[0]:
            raise Refused("bad_crc")
        yield kind.decode("latin-1"), body
        at += 12 + n


#: Bytes of image data inflated at a time.
INFLATED = 1 << 20
# Bits a pixel by colour type, and the passes of interlaced images (x0, y0, dx, dy).
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
_PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))


def read_png(raw: bytes) -> list[Row]:
    """Size, colour and texts of an image whose chunks, order, palette and scanlines hold together."""
    rows: list[Row] = []
    seen: list[str] = []
    data = zlib.decompressobj()
    head, line, lines = None, b"", []
    for kind, body in _chunks(raw):
        if not seen and kind != "IHDR":
            raise Refused("header_not_first")
        if seen and seen[-1] == "IEND":
            raise Refused("data_after_end")
        if kind == "IHDR":
            if seen or len(body) != 13:
                raise Refused("bad_header")
            w, h, depth, colour, method, filtering, interlace = head = struct.unpack(">IIBBBBB", body)
            if not w or not h or depth not in _DEPTHS.get(colour, ()) or method or filtering or interlace > 1:
                raise Refused("bad_header")
            if w * h > PIXELS:
                raise Refused("too_many_pixels")
            for x0, y0, dx, dy in _PASSES if interlace else ((0, 0, 1, 1),):
                pw, ph = -(-(w - x0) // dx) if w > x0 else 0, -(-(h - y0) // dy) if h > y0 else 0
                if pw and ph:
                    lines.append((1 + (pw * depth * _CHANNELS[colour] + 7) // 8, ph))
            rows.append(("/", "image", f"{w}x{h}, depth {depth}, colour type {colour}" + ", interlaced" * bool(interlace)))
        elif kind == "PLTE":
            if "IDAT" in seen or "PLTE" in seen or len(body) % 3 or not 3 <= len(body) <= 768 or head[3] in (0, 4) or (head[3] == 3 and len(body) // 3 > 1 << head[2]):
                raise Refused("bad_palette")
        elif kind == "IDAT":
            if "IDAT" in seen and seen[-1] != "IDAT":
                raise Refused("image_data_not_together")
            if head[3] == 3 and "PLTE" not in seen:
                raise Refused("no_palette")
            while body:  # a piece at a time: what it inflates to is known beforehand, and no more is made
                try:
                    out, at = line + data.decompress(body, INFLATED), 0
                except zlib.error:
                    raise Refused("bad_image_data") from None
                body = data.unconsumed_tail
                while lines and len(out) - at >= lines[0][0]:
                    size, left = lines[0]
                    if out[at] > 4:
                        raise Refused("bad_filter")
                    at += size
                    lines[0] = (size, left - 1)
                    if left == 1:
                        lines.pop(0)
                line = out[at:]
                if not lines and line:
                    raise Refused("too_much_image_data")
            if data.unused_data:
                raise Refused("data_after_image")
        elif kind == "tEXt":
            key, _, value = body.partition(b"\0")
            rows.append((f"/tEXt={key.decode('latin-1')}", "image_text", value.decode("latin-1")))
        elif kind[0].isupper() and kind != "IEND":
            raise Refused("unknown_critical_chunk")
        seen.append(kind)
    if seen[-1:] != ["IEND"] or "IDAT" not in seen:
        raise Refused("incomplete")
    if lines or not data.eof:
        raise Refused("too_little_image_data")
    return rows
