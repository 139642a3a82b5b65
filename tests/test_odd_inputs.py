"""Queries on odd tables equal their SQL."""

import duckdb
import pytest

from lodestrata.plans.catalogue import ORACLE_SQL, QUERIES


def same_as_sql(spark, folder, name):
    df = QUERIES[name](spark, str(folder))
    cols = sorted(df.columns)
    con = duckdb.connect()
    for p in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(ORACLE_SQL[name])
    at = [want.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Texts of more than 1,000 lines, so that ids of quotes recur in other files; empty and null texts, some of them cited."""
    folder = tmp_path_factory.mktemp("odd")
    long = "(SELECT string_agg(CASE WHEN x % 7 = 0 THEN 'same' ELSE 'l' || x % 300 END, chr(10) ORDER BY x) FROM range(1200 + i * 500) t(x))"
    short = "(VALUES (58, NULL), (60, ''), (61, chr(10)), (62, NULL), (93, ''), (124, 'a')) v(i, text)"
    duckdb.connect().execute(f"COPY (SELECT 40 + i AS doc_id, {long} AS text, 'en' AS lang, 's' AS source, 1 AS n_chars FROM range(3) r(i) UNION ALL SELECT i, text, 'en', 's', 0 FROM {short}) TO '{folder}/documents.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", ["q_violations_all"])
def test_null_and_empty_texts_are_cited(spark, odd, name):
    same_as_sql(spark, odd, name)


@pytest.mark.parametrize("name", ["q_quote_places", "q_reanchor_histogram", "q_reanchor_nearest", "q_citation_exact"])
def test_ids_of_quotes_recur_in_other_files(spark, odd, name):
    same_as_sql(spark, odd, name)


def test_a_null_range_text_or_quote_is_never_ok(spark):
    from lodestrata.operators import quotes

    files = spark.createDataFrame([("a", ["x"]), ("b", None)], "evidence_id string, lines array<string>")
    cites = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 1, None), ("a", None, 1, "x"), ("b", 1, 1, "x")], "evidence_id string, start int, end int, quote string")
    assert sorted(r.verdict for r in quotes.checked(cites, files).collect()) == ["bad_range", "bad_range", "ok", "wrong_quote"]
