"""Python workers get batches of bounded rows and bytes; mentions are found row by row."""

import random

from lodestrata import batches
from lodestrata.functions.text import fold_text, tokens_of
from lodestrata.operators import mentions
from lodestrata.plans.catalogue import QUERIES

SMALLEST = "/root/testdata/sf0.001"


def test_queries_with_python_ask_for_small_batches(spark):
    for name in ("q_html_links", "q_html_blocks", "q_folded"):
        for k in ("maxRecordsPerBatch", "maxBytesPerBatch"):
            spark.conf.unset(f"spark.sql.execution.arrow.{k}")
        QUERIES[name](spark, SMALLEST)
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(batches.BATCH_ROWS)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(batches.BATCH_BYTES)


def test_mentions_equal_brute_force(spark):
    r = random.Random(8)
    known = {"a": [(["a"], "a", "p"), (["a", "b"], "a b", "q")], "b": [(["b"], "b", "p"), (["b", "a", "b"], "b a b", "r")], "e": [(["e"], "é", "s")]}
    lines = [" ".join(r.choice(["a", "B", "É", "c", "ab"]) for _ in range(r.randrange(12))) for _ in range(300)]
    want = set()
    for i, line in enumerate(lines):
        t = tokens_of(line)
        got = [(t[k]["start"], t[k + len(w) - 1]["end"], a, p) for k in range(len(t)) for w, a, p in sum(known.values(), []) if [x["token"] for x in t[k : k + len(w)]] == w]
        want |= {(i, *m, "ambiguous_alias_overlap" if any(o[0] < m[1] and m[0] < o[1] and o[3] != m[3] for o in got) else "explicit_alias_candidate") for m in got}
    al = spark.createDataFrame([(a, p, w) for w, a, p in sum(known.values(), [])], "alias string, target string, words array<string>")
    df = spark.createDataFrame([*enumerate(lines), (900, None), (901, "")], "n int, text string")
    for found in (mentions.mentions_in(df, al, ["n"]), mentions.mentions(mentions.line_tokens(df), al, ["n"])):
        assert {tuple(x) for x in found.collect()} == want
        assert "Exchange" not in found._jdf.queryExecution().toString()
    assert fold_text("ÉLE Ciónes ﬁ") == "ele ciones fi"
