"""Mail messages: headers, bodies, quoted replies and attachments, all inert."""

from __future__ import annotations

import re
from email import policy
from email.parser import BytesParser

from lodestrata.sources.html import read_html

# The headers that are kept, in this order.
HEADERS = ("From", "To", "Cc", "Date", "Subject", "Message-ID", "In-Reply-To", "References")


def _runs(text: str, at: str) -> list[tuple[str, str, str]]:
    """Body and quoted-reply lines as they alternate."""
    rows, part, quoted, n = [], [], None, 0
    for line in [*text.split("\n"), None]:
        q = None if line is None else line.startswith(">")
        if q != quoted and part:
            if "".join(part).strip():
                n += 1
                rows.append((f"{at}/run={n}", "quoted_reply" if quoted else "body", "\n".join(part).strip("\n")))
            part = []
        quoted = q
        if line is not None:
            part.append(line)
    return rows


def read_eml(raw: bytes) -> list[tuple[str, str, str]]:
    """Located rows; attachments are listed and not opened, links to parts that are not there are told."""
    m = BytesParser(policy=policy.default).parsebytes(raw)
    rows = [(f"/header={h}", "header", " ".join(str(m[h]).split())) for h in HEADERS if m[h] is not None]
    have, asked = set(), []
    for n, part in enumerate(m.walk(), 1):
        at = f"/part={n}"
        if cid := part.get("Content-ID"):
            have.add(str(cid).strip().strip("<>"))
        if part.is_multipart():
            continue
        kind, name = part.get_content_type(), part.get_filename()
        if name or part.get_content_disposition() == "attachment" or kind not in ("text/plain", "text/html"):
            size = len(part.get_payload(decode=True) or b"")
            rows.append((at, "attachment", f"{name or ''} ({kind}, {size} bytes)".strip()))
            continue
        try:
            text = part.get_content().replace("\r\n", "\n")
        except (LookupError, UnicodeDecodeError):
            rows.append((at, "warning", "undecodable_part"))
            continue
        if kind == "text/html":
            rows += [(at + loc, what, x) for loc, what, x in read_html(text)]
            asked += re.findall(r"""cid:([^"'\s>)]+)""", text)
        else:
            rows += _runs(text, at)
    rows += [("/", "warning", f"missing_cid {c}") for c in dict.fromkeys(asked) if c not in have]
    return rows
