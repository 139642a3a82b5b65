"""Strict decoding of bytes by a declared charset."""

from __future__ import annotations

import re

from lodestrata.sources.office import Refused

# The charsets that are known, and how they are decoded.
CHARSETS = {"utf-8": "utf-8", "utf8": "utf-8", "us-ascii": "ascii", "ascii": "ascii", "windows-1252": "cp1252", "cp1252": "cp1252", "iso-8859-1": "iso-8859-1", "latin-1": "iso-8859-1"}
_META = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.IGNORECASE)
_MARK = b"\xef\xbb\xbf"


def decoded(raw: bytes, declared: str | None = None) -> str:
    """The text, UTF-8 where nothing is declared. An unknown charset, a byte order mark against it and bytes that are none of it are refused."""
    encoding = CHARSETS.get((declared or "utf-8").strip().lower())
    if encoding is None:
        raise Refused("unsupported_charset")
    if raw.startswith(_MARK):
        if encoding != "utf-8":
            raise Refused("charset_conflict")
        raw = raw[len(_MARK) :]
    try:
        return raw.decode(encoding)
    except UnicodeDecodeError:
        raise Refused("charset_decode_error") from None


def html_text(raw: bytes) -> str:
    """A page's text by the charset that it declares in its first 4,096 bytes."""
    found = _META.search(raw[:4096])
    return decoded(raw, found[1].decode() if found else None)
