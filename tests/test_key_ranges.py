"""Ranges of a database read, against counts; the histogram's SQL runs in DuckDB, in this process."""

import bisect

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starpipe.sources.readers import BUCKETS, histogram_query, key_predicates, key_starts

TOP = 2**62


def counted(keys):
    """The histogram in plain Python, and how often it was asked."""
    keys, asked = sorted(keys), []

    def histogram(low, high):
        asked.append((low, high))
        width, found = -(-(high - low + 1) // BUCKETS), {}
        for key in keys[bisect.bisect_left(keys, low) : bisect.bisect_right(keys, high)]:
            found.setdefault((key - low) // width, []).append(key)
        return [(min(x), max(x), len(x)) for x in found.values()]

    return histogram, asked


def sizes(keys, starts):
    found = [0] * len(starts)
    for key in keys:
        found[max(0, bisect.bisect_right(starts, key) - 1)] += 1
    return found


@pytest.mark.parametrize("keys", [
    list(range(100_000)), list(range(0, TOP, TOP // 100_000))[:100_000],
    [*range(50_000), *range(TOP - 50_000, TOP)], [*range(0, 70_000), *range(10**12, 10**12 + 30_000 * 1000, 1000)],
    [*range(-TOP // 2, -TOP // 2 + 50_000), *range(50_000)],
], ids=["dense", "sparse", "two ends", "two densities", "negative"])
def test_ranges_have_equal_rows(keys):
    histogram, asked = counted(keys)
    starts = key_starts(histogram, min(keys), max(keys), 1000)
    found = sizes(keys, starts)
    assert 90 <= len(starts) <= 210 and max(found) <= 2100 and len(asked) <= 200
    assert starts == sorted(set(starts)) and starts[0] == min(keys)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**40), 2**40), min_size=1, max_size=300), st.integers(1, 50))
def test_starts_are_in_order_and_cover_all_keys(keys, rows):
    starts = key_starts(counted(keys)[0], min(keys), max(keys), rows)
    assert starts[0] == min(keys) and starts == sorted(set(starts))
    assert sum(sizes(keys, starts)) == len(keys)


def test_each_row_meets_one_predicate(spark, make):
    rows = [(k,) for k in (None, -5, 0, 9, 10, 11, 99, 100, 2**62)]
    for starts in ([], [0], [0, 10], [0, 10, 11, 100]):
        hits = [F.expr(p).eqNullSafe(True).cast("int") for p in key_predicates("k", starts)]
        frame = make(rows, "k long").select(sum(hits[1:], hits[0]).alias("n"))
        assert {r["n"] for r in frame.collect()} == {1}


def test_histogram_query_counts_every_row():
    con = duckdb.connect()
    con.execute("CREATE TABLE gastos AS SELECT range * 37 + 5 AS ID_Gasto FROM range(50000)")
    found = con.sql(histogram_query("gastos", 5, 49_999 * 37 + 5)).fetchall()
    assert len(found) <= BUCKETS and sum(n for *_, n in found) == 50_000
    ordered = sorted(found)
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))
