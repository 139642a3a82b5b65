import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import dates, globs, identity, text

# path, pattern, whether it matches
GLOBS = [
    ("README.md", "**/*.md", True), ("a/README.md", "**/*.md", True), ("a/b/c.md", "**/*.md", True), ("a/src/a.py", "src/**", False), ("src/a.py", "src/**", True), ("src", "src/**", True),
    ("one/two.py", "*.py", False), ("two.py", "*.py", True), ("README.MD", "**/*.md", False), ("x/build/y", "**/build/**", True), ("build", "**/build/**", True), ("a/b/z", "a/**/z", True), ("a/z", "a/**/z", True), ("a/bz", "a/**/z", False), ("ab", "a?", True), ("a/b", "a?b", False),
]


def test_globs(spark):
    for path, pattern, want in GLOBS:
        df = spark.createDataFrame([(path,)], "p string")
        assert df.select(globs.matches(F.col("p"), pattern)).first()[0] is want, (path, pattern)


@pytest.mark.parametrize("pattern", ["../**", "!src/**", "a/**.py", "a/[ab].py", "/src/**", "", "a//b", "c:/x"])
def test_no_globs(pattern):
    with pytest.raises(ValueError):
        globs.check_pattern(pattern)


def test_scope_and_paths(spark):
    df = spark.createDataFrame([("a/x.md",), ("node_modules/x.md",), (".env.local",), ("../x",), ("a/./b",), ("a\\b",), ("a b/c.md",)], "p string")
    p = F.col("p")
    got = [tuple(r) for r in df.select(globs.selected(p, ["**/*.md", "**/.env*"], ["**/node_modules/**"]), globs.safe_path(p)).collect()]
    assert got == [(True, True), (False, True), (False, True), (False, False), (False, False), (False, False), (True, True)]


STRINGS = ["", "a", "a\n", "a\r\nb\rc", "\n\n", "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g\u2028h\u2029", "\ufeffx\ny", "tail\n\n"]


def test_lines_are_pythons(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(STRINGS)], "i int, s string")
    for r in df.select("s", text.split_lines(F.col("s")).alias("l")).collect():
        assert r.l == r.s.removeprefix("\ufeff").splitlines(), r.s


def test_identities_are_canonical_json(spark):
    rows = [("p", "s\u0001\u001f\"\\é\n", "path/ü", None), ("p", "\t\x0b\x7f/", "x", "y")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    for r in df.select("*", identity.short_id("F", F.col("a"), F.col("b"), F.col("c"), F.col("d"), ("int", F.lit(7))).alias("id")).collect():
        raw = json.dumps([r.a, r.b, r.c, r.d, 7], separators=(",", ":"), ensure_ascii=False)
        assert r.id == "F-" + hashlib.sha256(raw.encode()).hexdigest()[:24]
        assert identity.digest_of([r.a, r.b, r.c, r.d, 7])[:24] == r.id[2:]


def test_folding_and_tokens(spark):
    df = spark.createDataFrame([("Módulo Straße, _x9 ﬁn",), (None,), ("",)], "s string")
    got = df.select(text.fold("s"), text.casefold("s"), text.tokens("s")).collect()
    assert got[0][0] == "modulo strasse, _x9 fin" and got[0][1] == "módulo strasse, _x9 fin" and got[1][0] is None
    assert [(t.token, t.start, t.end) for t in got[0][2]] == [("modulo", 0, 6), ("strasse", 7, 13), ("x9", 16, 18), ("fin", 19, 21)] and got[2][2] == []


def test_escapes_and_small_functions(spark):
    df = spark.createDataFrame([('a<b>&"c" [x]*_|`\\ #\n',)], "s string")
    s = F.col("s")
    r = df.select(text.escaped_html(s), text.escaped_markdown(F.lit("a_b*[c]|`\\<")), text.mermaid_label(s), text.column_number(F.lit("AB")), text.extension(F.lit("x/Y.Tar.GZ")), text.basename(F.lit("x/y.md")), text.collapsed(F.lit(" a \n\t b ")), text.pending_words(F.lit("Propuesta TBD pending")), text.machine_written(F.lit("d/Notes by Gemini.md")), text.machine_written(F.lit("notes by gemini/x.md"))).first()
    assert r[0] == 'a&lt;b&gt;&amp;"c" [x]*_|`\\ #\n'
    assert r[1] == "a\\_b\\*\\[c\\]\\|\\`\\\\&lt;"
    assert r[2] == "a#60;b#62;#38;#quot;c#quot; [x]*_|#96;#92; #35; "
    assert tuple(r)[3:] == (28, ".gz", "y.md", "a b", ["pending", "propuesta", "tbd"], True, False)


def test_dates(spark):
    names = [("call 2026_09_25 12_00 GMT-05_00 x", "2026-09-25T12:00:00-05:00", "minute"), ("2026-08-30-kickoff", "2026-08-30", "day"), ("2026-13-45", None, None), ("2026-13-45 2026_07_01", "2026-07-01", "day"), ("none", None, None)]
    for n, value, precision in names:
        r = spark.createDataFrame([(n,)], "n string").select(dates.in_name(F.col("n")).alias("d")).first().d
        assert (r and (r.value, r.precision)) == ((value, precision) if value else None), n
    values = [("2026", "year"), ("2026-09", "month"), ("2026-09-25", "day"), ("2026-09-25T12:00-05:00", "minute"), ("2026-09-25T12:00:01Z", "second"), ("2026-02-30", None), ("2026-09-25T12:00", None), ("x", None)]
    for v, precision in values:
        r = spark.createDataFrame([(v,)], "v string").select(dates.partial(F.col("v")).alias("d")).first().d
        assert (r and r.precision) == precision, v
    r = spark.range(1).select(dates.instant(F.lit("2026-09-25T12:00-05:00")) == dates.instant(F.lit("2026-09-25T17:00:00Z")), dates.anchor_precision(F.lit("2026-09-25T12:00-05:00")), dates.ahead_of_clock(F.lit("2026-01-01 00:11:00").cast("timestamp"), F.lit("2026-01-01 00:00:00").cast("timestamp"))).first()
    assert tuple(r) == (True, "minute", True)


def test_labels(spark):
    kind = "struct<status:string,basis:string,value:string,end:string,precision:string,anchor_ref:int,anchor_value:string,note:string,alternatives:array<struct<value:string,precision:string,evidence_refs:array<int>>>>"
    rows = [(("known", "stated", "2026", "2027", "year", None, None, None, None),), (("approximate", "relative_to_anchor", "2026-01", None, "month", 1, "2026", "n", None),), (("unknown", None, None, None, None, None, None, "why", None),), (("conflicting", None, None, None, None, None, None, "two", [("2026", "year", [0, 2])]),)]
    got = [r[0] for r in spark.createDataFrame(rows, f"d {kind}").select(dates.label(F.col("d"))).collect()]
    assert got == ["known: 2026\u20132027 (year; stated)", "approximate: 2026-01 (month; relative_to_anchor); anchor 2026 (citation 2) \u2014 n", "unknown \u2014 why", "conflicting: 2026 (year; citations 1, 3) \u2014 two"]
