"""Queries against their SQL over small tables of nulls, ties, repeated rows and clashing columns."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import awkward_texts
from tideline.llm import queries, sql

TABLES = ("documents", "benchmark", "conversations", "pages")


def rows_of_documents():
    """Ids that are missing or stand twice, beside texts that do; a source may be missing too."""
    texts = awkward_texts()
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, 5) for i, t in enumerate(texts)]
    return rows + [rows[20], rows[20], (None, texts[21], "s1", 5), (None, texts[21], None, 5), (None, None, None, None), (22, texts[22], "s0", 5), (-3, texts[23], "s0", 5)]


def rows_of_benchmark():
    texts = awkward_texts()
    return [("a", texts[12], 1), ("b", texts[12], 2), ("c", "one two", 3), ("d", None, 4), ("e", "", 5), ("f", " ".join((texts[7] or "").split()[40:60]), 6), ("c", "one two", 7)]


def rows_of_conversations():
    """Turns of one number, null turns, roles and texts, a conversation without its partner, and one without answers."""
    said = [(c, t, ("system", "user", "assistant")[t and 1 + t % 2], f"say {c} {t}." if t % 5 else f"stop {c // 2}") for c in range(2, 12) for t in range(0, 4 + c % 3)]
    ties = [(20, 1, "assistant", "b"), (20, 1, "assistant", "a"), (20, 1, "user", "c."), (20, 2, "assistant", "z."), (20, 2, "assistant", "y."), (21, 5, "assistant", "m.")]
    nulls = [(30, None, "user", "x"), (30, 1, None, "y."), (30, 2, "assistant", None), (30, None, "assistant", "w"), (31, None, "assistant", None), (40, 1, "user", "alone?"), (None, 1, "user", "nobody"), (None, None, None, None)]
    return said + said[:3] + ties + nulls


def rows_of_pages():
    return [(1, "http://a", "<p>é</p>"), (3, "http://a", "<p>é</p>"), (2, None, "<p>é</p>"), (4, "u", None), (5, "u", ""), (None, "v", "<p>é</p>"), (7, "w", "x" * 5000)]


@pytest.fixture(scope="module", params=["awkward", "empty"])
def folder(spark, tmp_path_factory, request):
    kinds = {
        "documents": "doc_id long, text string, source string, copy_ long",
        "benchmark": "item_id string, text string, doc_id long",
        "conversations": "conv_id long, turn int, role string, text string",
        "pages": "page_id long, url string, html string",
    }
    path = tmp_path_factory.mktemp(request.param)
    for name in TABLES:
        rows = globals()[f"rows_of_{name}"]() if request.param == "awkward" else []
        spark.createDataFrame(rows, kinds[name]).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_against_sql(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    want = con.sql(sql.ORACLES[name])
    got = queries.queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    assert key(got.select([F.col(f"`{c}`") for c in want.columns]).collect()) == key(want.fetchall())
