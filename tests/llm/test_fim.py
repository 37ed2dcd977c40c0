import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starpipe.llm import fim, oracles
from starpipe.llm.registry import op12_fill_in_middle

SCHEMA = "doc_id long, text string, given int, n int, form string, output string, restored string"


def draws(doc_id):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def plain_python(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(tokens), draws(doc_id)
    one, two = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:one]), "".join(tokens[one:two]), "".join(tokens[two:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture
def small_strides(monkeypatch):
    monkeypatch.setattr(fim, "STRIDE", 7)
    monkeypatch.setattr(fim, "BLOCK", 4)


TEXTS = st.lists(st.text(st.sampled_from("ab Zé\n<>PSM漢😀."), max_size=40), max_size=12)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_arrays_equal_plain_python(texts):
    before = fim.STRIDE, fim.BLOCK
    fim.STRIDE, fim.BLOCK = 7, 4
    try:
        expected = [plain_python(i, text) for i, text in enumerate(texts)]
        form = [row[1] for row in expected]
        drawn = [np.array([draws(i)[j] for i in range(len(texts))], np.int64) for j in (0, 1)]
        n, prefix, middle, output = fim.arrange(pa.array(texts, pa.string()), drawn, form)
        assert list(zip(n, form, prefix, middle, output.to_pylist())) == expected
        assert fim.gather(output, form).to_pylist() == texts
    finally:
        fim.STRIDE, fim.BLOCK = before


def test_slices_of_arrow_columns():
    texts = pa.array(["no", "ab cd", "é x", "no"]).slice(1, 2)
    n, *_, output = fim.arrange(texts, [np.array([1, 1]), np.array([2, 2])], ["psm", "spm"])
    assert n == [3, 3]
    assert output.to_pylist() == ["<P>ab<S>cd<M> ", "<S>x<P>é<M> "]
    assert fim.gather(output, ["psm", "spm"]).to_pylist() == ["ab cd", "é x"]


def test_edge_cases(spark, make):
    long = "word é " * 60_000
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "a b c d"), (5, "has <S> in it"), (6, "ab" * 50_000),
            (7, "<P"), (8, "S>"), (9, "x<"), (10, "\n"), (11, "<"), (12, "1>2<3")]
    table = make([(i, t, 1, 2, "f", "o", "r") for i, t in rows], SCHEMA)
    restored = fim.restore(fim.fill_in_middle(table)).collect()
    key = str
    got = [(r["given"]["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in restored]
    assert sorted(got, key=key) == sorted([(i, *plain_python(i, t)) for i, t in rows], key=key)
    assert all(r["restored"] == (r["given"]["text"] or "") for r in restored)
    assert {tuple(r["given"])[2:] for r in restored} == {(1, 2, "f", "o", "r")}


def test_empty_table(spark, make):
    assert fim.restore(fim.fill_in_middle(make([], SCHEMA))).collect() == []


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    mine = op12_fill_in_middle(spark, sf_dir)
    theirs = con.execute(f"SELECT {', '.join(mine.columns)} FROM ({oracles.fill_in_middle()})").fetchall()
    rows = [tuple(r) for r in mine.collect()]
    assert sorted(rows) == sorted(theirs)
    assert {row[2] for row in rows} == {"plain", "psm", "spm"}
