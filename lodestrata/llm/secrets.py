r"""Secret scans through nested encodings.

A worklist starts from the text. Each layer is scanned for secrets, and for
parts that decode: percent escapes (also escaped again), \u, \U, \x and &#n;
escapes, base64 (both alphabets, also wrapped in lines, or behind or before a
`/`, `-`, `_` or `+` that is none of its own) and, inside base64, raw text, or
zlib, gzip, bzip2, xz and zstandard to any depth. A layer has at most two successors: itself with
all escapes decoded, and itself with all base64 decoded, so that the work grows
with the text and not with the ways to choose parts. What surrounds a decoded
part is in the successor, so names and values that only partly are encoded
count. Layers are known by their digest, so a cycle ends; the work is done when
no layer is left. A layer knows in runs which span of the text it came from,
and so do the secrets found there.

Bytes that are no UTF-8 stay as they are written, and so do escapes that are no
character; surrogates join. Base64 counts if it gives text, or bytes in which a
secret is found; a truncated compressed part counts as far as it goes.

Cases: null texts count as empty; ties of spans go by start, then kind; a part
that does not decode to text is left; a compressed part of more than LARGEST
bytes, or one with which a text's layers would hold more than EXPANDED
characters beyond eight times its own, is not unpacked but its span is given as
kind `bomb`; repeated rows give equal rows; a null doc_id stays null; an empty
table gives no rows; further columns are ignored, and carried by `redacted`.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import arrow_schema, in_batches, table

KINDS = ("assign", "access", "hex")
#: Bytes that a compressed part may unpack to.
LARGEST = 16_000_000
#: Characters that the layers of one text may hold, beyond eight times its own.
EXPANDED = 64_000_000

_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs of fewer fail, and no start within a run is a match of its own

# %2541 is %41 is A: percent signs that are escaped again are decoded at once.
_ESCAPES = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+|\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_PERCENT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Lines of base64, of which the first may begin within a line and the last may be short.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]++\x20*\r?\n[\x20\t]*)?[A-Za-z0-9+/_-]{16,}+(?:\x20*\r?\n[\x20\t]*[A-Za-z0-9+/_-]{16,}+)*+(?:\x20*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)?={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_BORDER = re.compile(r"[/_+-]")
_STANDARD = str.maketrans("-_", "+/")
#: What every secret has, as bytes; other bytes that are no text are not looked into.
_NAMES = re.compile(rb"AKIA|passw|secret|token|api_?key|[0-9a-f]{24}", re.IGNORECASE)
_PACKED = (b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"\x1f\x8b", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")
#: Ends before which base64 is tried again, and characters by which a start is judged.
_ENDS, _JUDGED = 8, 64


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find in one layer."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    out.sort()
    return out


def _percent(run: str) -> list[tuple[str, int, int, str]]:
    """The characters that a run of percent escapes stands for, each with the part of the run; bytes that are no UTF-8 are left out."""
    found = [(m.start(), m.end(), int(m[1], 16)) for m in _PERCENT.finditer(run)]
    raw, out, at = bytes(x for _, _, x in found), [], 0
    while at < len(raw):
        try:
            good, bad = raw[at:].decode(), len(raw)
        except UnicodeDecodeError as e:
            good, bad = raw[at : at + e.start].decode(), at + e.end
        for c in good:
            n = len(c.encode())
            out.append((c, found[at][0], found[at + n - 1][1], "url"))
            at += n
        at = bad
    return out


def _character(escape: str) -> str | None:
    codes = [int(x, 10 if escape.startswith("&#") and escape[2] not in "xX" else 16) for x in re.findall(r"(?:\\[uUx]\{?|&#[xX]?)([0-9A-Fa-f]+)", escape)]
    code = codes[0] if len(codes) == 1 else 0x10000 + ((codes[0] & 0x3FF) << 10) + (codes[1] & 0x3FF)
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _escapes(text: str) -> list[tuple[str, int, int, str]]:
    """(what it stands for, start, end, how) of all escapes."""
    if "%" not in text and "\\" not in text and "&#" not in text:
        return []
    out: list[tuple[str, int, int, str]] = []
    for m in _ESCAPES.finditer(text):
        if m[0][0] == "%":
            out += [(c, m.start() + a, m.start() + b, how) for c, a, b, how in _percent(m[0])]
        elif c := _character(m[0]):
            out.append((c, m.start(), m.end(), "unicode"))
    return out


def _text(raw: bytes) -> str | None:
    """Bytes as text, if they are, or if a secret shows in them."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text = ""
    if text and sum(c.isprintable() or c in "\t\r\n" for c in text) >= 0.95 * len(text):
        return text
    if _NAMES.search(raw) and scan(other := raw.decode("latin-1")):
        return text or other
    return None


def _inflated(raw: bytes) -> tuple[bytes, bool]:
    """What compressed bytes unpack to, as far as they go, and whether that is more than LARGEST."""
    if raw.startswith(b"BZh"):
        unpack, wrong = bz2.BZ2Decompressor(), (OSError, ValueError, EOFError)
    elif raw.startswith(b"\xfd7z"):
        unpack, wrong = lzma.LZMADecompressor(memlimit=256 << 20), (lzma.LZMAError, EOFError)
    elif raw.startswith(b"\x28\xb5"):
        import zstandard

        out = bytearray()
        try:
            with zstandard.ZstdDecompressor(max_window_size=64 << 20).stream_reader(raw) as reader:
                while len(out) <= LARGEST and (part := reader.read(1 << 16)):
                    out += part
        except zstandard.ZstdError:
            pass
        return bytes(out[:LARGEST]), len(out) > LARGEST
    else:
        unpack, wrong = zlib.decompressobj(47), (zlib.error,)
    out = bytearray()
    for i in range(0, len(raw), 4096):
        part = raw[i : i + 4096]
        while part or (isinstance(unpack, lzma.LZMADecompressor | bz2.BZ2Decompressor) and not unpack.needs_input and not unpack.eof):
            if unpack.eof:
                return bytes(out), False
            try:
                got = unpack.decompress(part, 1 << 16)
            except wrong:
                return bytes(out), False
            out += got
            if len(out) > LARGEST:
                return b"", True
            part = getattr(unpack, "unconsumed_tail", b"")
    return bytes(out), False


def _bytes(part: str) -> bytes | None:
    body = part.rstrip("=").translate(_STANDARD)
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _unpacked(part: str) -> tuple[str | None, str]:
    """The text in a base64 part and how it was packed."""
    raw = _bytes(part)
    if raw is None:
        return None, ""
    seen, kind = set(), "base64"
    while raw.startswith(_PACKED):
        digest = hashlib.sha256(raw).digest()
        if digest in seen:
            return None, ""
        seen.add(digest)
        got, bomb = _inflated(raw)
        if bomb:
            return None, "bomb"
        if not got:
            break  # text may begin like a header
        raw, kind = got, "packed"
    return _text(raw), kind


def _plausible(head: str) -> bool:
    """Whether base64 may begin so: with a compressed part's first bytes, or with text."""
    raw = _bytes(head[: len(head) // 4 * 4])
    if raw is None:
        return False
    if raw.startswith(_PACKED):
        return True
    try:
        text = raw.decode()
    except UnicodeDecodeError as e:
        if e.end < len(raw) - 3:
            return False
        text = raw[: e.start].decode()
    return bool(text) and sum(c.isprintable() or c in "\t\r\n" for c in text) >= 0.9 * len(text)


def _one(run: str) -> tuple[str | None, int, int, str] | None:
    """The text of base64 in a run of its characters, where it is, and how it was packed."""
    if not _plausible(run[:_JUDGED]):
        raw = _bytes(run)
        if raw and _NAMES.search(raw):
            text, kind = _unpacked(run)
            if text:
                return text, 0, len(run), kind
    starts = [0] + [m.end() for m in _BORDER.finditer(run)]
    for start in starts:
        if len(run) - start < 16:
            break
        if not _plausible(run[start : start + _JUDGED].rstrip("=")):
            continue
        ends = [m.start() for m in _BORDER.finditer(run, start + 16)][-_ENDS:]
        for end in [len(run), *reversed(ends)]:
            text, kind = _unpacked(run[start:end])
            if text or kind == "bomb":
                return text, start, end, kind
    return None


def _wrapped(part: str) -> tuple[str | None, int, int, str] | None:
    """The same of base64 wrapped in lines.

    A word before or after may look like one more line. Plain text is taken
    from as many lines as can be read, and what is packed from no more lines
    than it needs.
    """
    lines = [(m.start(), m.end()) for m in _LINE.finditer(part)]
    best = None
    for first, last in ((0, 0), (0, 1), (1, 0), (1, 1)):
        rows = lines[first : len(lines) - last]
        if len(rows) < 2:
            continue
        joined = "".join(part[a:b] for a, b in rows)
        if not _plausible(joined[:_JUDGED].rstrip("=")):
            continue
        text, kind = _unpacked(joined)
        if (text or kind == "bomb") and (best is None or (kind != "base64" and (best[3] == "base64" or len(text or "") >= len(best[0] or "")))):
            best = text, rows[0][0], rows[-1][1], kind
    return best


def _packed(text: str) -> list[tuple[str | None, int, int, str]]:
    """(text, start, end, how) of all base64; no text where it unpacks to too much."""
    out: list[tuple[str | None, int, int, str]] = []
    taken = 0
    if "\n" in text:
        whole = [(m.start() + got[1], m.start() + got[2], got) for m in _WRAPPED.finditer(text) if "\n" in m[0] and (got := _wrapped(m[0]))]
    else:
        whole = []
    whole.append((len(text), len(text), None))
    for start, end, got in whole:
        for m in _BASE64.finditer(text, taken, start):
            if one := _one(m[0]):
                out.append((one[0], m.start() + one[1], m.start() + one[2], one[3]))
        if got:
            out.append((got[0], start, end, got[3]))
        taken = end
    return out


class _Layer:
    """A text in runs, each with its start, the span of the scanned text it came from, how (empty: character by character) and in which layer."""

    def __init__(self, text: str, starts: list[int], runs: list[tuple[int, int, str, int]], depth: int = 0):
        self.text, self.starts, self.runs, self.depth = text, starts, runs, depth

    def span(self, a: int, b: int) -> tuple[int, int]:
        i, j = bisect_right(self.starts, a) - 1, bisect_right(self.starts, b - 1) - 1
        first, last = self.runs[i], self.runs[j]
        return first[0] + (0 if first[2] else a - self.starts[i]), last[1] if last[2] else last[0] + b - self.starts[j]

    def how(self, a: int, b: int) -> str:
        """How the part that was decoded last came about; empty if no part was decoded."""
        i, j = bisect_right(self.starts, a) - 1, bisect_right(self.starts, b - 1)
        return max(self.runs[i:j], key=lambda r: (bool(r[2]), r[3]))[2]

    def rewritten(self, parts: list[tuple[str, int, int, str]]) -> _Layer:
        """This layer with parts replaced by what they stand for."""
        text, starts, runs, at, size = [], [], [], 0, 0
        for new, a, b, how in [*parts, ("", len(self.text), len(self.text), "")]:
            if at < a:  # what is between
                for i in range(bisect_right(self.starts, at) - 1, bisect_right(self.starts, a - 1)):
                    lo, run = max(at, self.starts[i]), self.runs[i]
                    starts.append(size + lo - at)
                    runs.append(run if run[2] else (run[0] + lo - self.starts[i], run[1], "", run[3]))
                text.append(self.text[at:a])
                size += a - at
            if new:
                starts.append(size)
                runs.append((*self.span(a, b), how, self.depth + 1))
                text.append(new)
                size += len(new)
            at = b
        return _Layer("".join(text), starts, runs, self.depth + 1)


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, str, int]]]:
    """The base spans, and further spans (start, kind, end) from decoded layers."""
    base = scan(text)
    more: set[tuple[int, str, int]] = set()
    seen, left = {hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()}, EXPANDED + 8 * len(text)
    layers = deque([_Layer(text, [0], [(0, len(text), "", 0)])])
    while layers:
        layer = layers.popleft()
        for parts in (_escapes(layer.text), _packed(layer.text)):
            fit = []
            for part in parts:
                if part[0] and (left := left - len(part[0])) > 0:
                    fit.append(part)
                else:
                    a, b = layer.span(part[1], part[2])
                    more.add((a, "bomb", b))
            if not fit:
                continue
            new = layer.rewritten(fit)
            digest = hashlib.sha256(new.text.encode("utf-8", "surrogatepass")).digest()
            if digest in seen:
                continue
            seen.add(digest)
            left -= len(new.text)
            for s, k, e in scan(new.text):
                if how := new.how(s, e):
                    a, b = new.span(s, e)
                    more.add((a, f"{KINDS[k]}+{how}", b))
            layers.append(new)
    return base, sorted(more)


SECRETS, SECRETS_ARROW = arrow_schema(doc_id="long", n_assign="long", n_access="long", n_hex="long", base="string", spans="string")


def _row(text: str) -> tuple:
    base, more = find(text)
    own = [(s, k, KINDS[k], e) for s, k, e in base]
    every = sorted(own + [(s, len(KINDS), k, e) for s, k, e in more])
    line = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
    return (*(sum(x[1] == k for x in base) for k in range(3)), line(own), line(every))


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base and spans (kind:start:end joined by commas) for each row."""

    def make():
        def step(batch: pa.RecordBatch):
            rows = [_row(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SECRETS_ARROW.types[1:], strict=True))], schema=SECRETS_ARROW)

        return step

    return in_batches(docs.select("doc_id", "text"), make, SECRETS)


def masked(text: str) -> str:
    """The text with every secret replaced by its kind."""
    base, more = find(text)
    out, at = [], 0
    for s, k, e in sorted([(s, KINDS[k], e) for s, k, e in base] + more):
        if e > at:
            if s >= at:
                out += [text[at:s], f"[{k.partition('+')[0].upper()}]"]
            at = e
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every secret in column text replaced by its kind; null texts stay null."""
    schema, at = docs.schema, docs.columns.index("text")

    def make():
        def step(batch: pa.RecordBatch):
            texts = pa.array([t if t is None else masked(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

        return step

    return in_batches(docs, make, schema)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    n = F.when(F.col("spans") == "", 0).otherwise(F.size(F.split("spans", ","))).cast("long")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", n.alias("n_found"))
