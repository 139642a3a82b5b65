"""Anchored, case-sensitive globs over relative paths, compiled once on the driver to regular expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is never captured.
SENSITIVE = ("**/.env*", "**/*.pem", "**/*.key", "**/id_rsa*", "**/id_ed25519*", "**/credentials*.json", "**/token*.json", "**/.ssh/**", "**/.aws/**", "**/.azure/**")
# Folders that are never entered.
FOLDERS = (".git", "node_modules", ".venv", "venv", "build", "dist", "__pycache__", ".pytest_cache", ".mypy_cache", ".idea", ".vscode")
# Extensions of plain text sources.
TEXT_EXTENSIONS = (".md", ".txt", ".sql", ".py", ".rs", ".kt", ".kts", ".java", ".js", ".ts", ".tsx", ".jsx", ".json", ".yaml", ".yml", ".toml", ".xml", ".csv", ".mmd", ".graphql", ".proto", ".sh", ".conf", ".ini", ".properties", ".html", ".css", ".go", ".rb", ".scala", ".c", ".h", ".cpp", ".hpp", ".cs", ".rst")
# Extensions that a document adapter reads.
DOCUMENT_EXTENSIONS = (".docx", ".pdf", ".xlsx", ".pptx", ".ppt", ".html", ".eml", ".svg", ".png")


def check_pattern(pattern: str) -> str:
    """The pattern, if it is one: relative, normalised, `**` only as a whole segment, neither classes nor negation."""
    parts = pattern.split("/")
    if not pattern or pattern.startswith(("/", "!")) or "\\" in pattern or ":" in pattern or re.search(r"[\[\]{}]", pattern) or any(p in ("", ".", "..") for p in parts) or any("**" in p and p != "**" for p in parts):
        raise ValueError(f"not a supported glob: {pattern!r}")
    return pattern


def regex_of(pattern: str) -> str:
    """`*` and `?` stay within a segment; a segment `**` stands for any number of segments, none included."""
    segments = check_pattern(pattern).split("/")
    one = lambda s: "".join("[^/]*" if c == "*" else "[^/]" if c == "?" else re.escape(c) for c in s)
    if all(s == "**" for s in segments):
        return r"\A(?s:.*)\z"
    out, sep = "", ""
    for s in segments:
        if s == "**":
            if out == "" and sep == "":
                out, sep = "(?:[^/]+/)*", ""
            elif sep:
                out, sep = out + "(?:/[^/]+)*", "/"
        else:
            out, sep = out + sep + one(s), "/"
    return rf"\A{out}\z"


def matches(path: Column, *patterns: str) -> Column:
    """Whether any pattern matches the path; none matches without patterns."""
    out = F.lit(False)
    for p in patterns:
        out = out | path.rlike(regex_of(p))
    return out


def excluded(path: Column, *patterns: str) -> Column:
    """`X/**` also excludes the folder X; what is excluded stays so whatever else matches."""
    return matches(path, *patterns)


def selected(path: Column, include: list[str], exclude: list[str]) -> Column:
    return matches(path, *include) & ~excluded(path, *exclude) & ~matches(path, *SENSITIVE)


def safe_path(path: Column) -> Column:
    """A relative, normalised path without backslashes, colons or steps up."""
    return path.rlike(r"\A(?!/)(?!.*(?:^|/)\.{1,2}(?:/|\z))(?!.*//)[^\\:\x00]+(?<!/)\z")


def identifier(name: Column) -> Column:
    return name.rlike(r"\A[a-z0-9][a-z0-9_-]{0,63}\z")
