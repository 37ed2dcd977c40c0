from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starpipe.functions import keys
from starpipe.functions.keys import dense_id, first_seen_id
from starpipe.functions.lookups import lookup, semi_if_any
from tests.world import rows


@pytest.mark.parametrize("hot", [False, True])
def test_dense_id_equals_position_in_sorted_order(make, hot):
    random.seed(3)
    # With hot=True one leading key owns a third of all rows.
    data = [
        (7 if hot and i % 3 == 0 else random.randrange(50), random.choice([None, 1, 2]), i)
        for i in range(3000)
    ]
    df = make(data, "k int, day int, id bigint").repartition(7)
    keyed = dense_id(df, ["k", "day", "id"], "n")
    expected = sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    got = [tuple(r)[1:] for r in sorted(keyed.collect())]
    assert got == expected
    assert [r.n for r in sorted(keyed.collect())] == list(range(1, 3001))


def test_dense_id_spreads_a_hot_key_over_tasks(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.col("id"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        keyed = dense_id(df, ["k", "id"], "n")
    finally:
        spark.conf.set(setting, "true")
    written = keyed.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(written) > 1
    assert max(r["count"] for r in written) < 100_000
    assert keyed.where(F.col("n") != F.col("id") + 1).count() == 0


@pytest.mark.parametrize("span", [40, 3000, 10**15])
def test_dense_id_by_counted_ranges(make, monkeypatch, span):
    # Negative, repeated and missing keys, some outside of what was counted; the ranges are small.
    monkeypatch.setattr(keys, "_RANGE_ROWS", 200)
    random.seed(span)
    data = [(None if i % 50 == 0 else random.randrange(-span, span), i) for i in range(3000)]
    df = make(data, "k bigint, id bigint").repartition(7)
    counted = df.select("k").where(f"k is null or abs(k) < {span * 0.9}")
    keyed = dense_id(df, ["k", "id"], "n", counted=counted)
    expected = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = [tuple(r) for r in sorted(keyed.collect(), key=lambda r: r.n)]
    assert got == [(n, *row) for n, row in enumerate(expected, 1)]
    assert len([f for f in keyed.inputFiles() if "/n-offsets" not in f]) > 8


def test_dense_id_counts_instead_of_computing_its_rows_twice(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(50_000).write.parquet(path)
    stored = spark.read.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def noted(i):
        seen.add(1)
        return i

    rows_ = stored.select("id", F.udf(noted, "bigint")("id").alias("v"))
    keyed = dense_id(rows_, ["id"], "n", counted=stored)
    assert seen.value == 50_000
    assert keyed.where("n <> id + 1 or v <> id").count() == 0 and keyed.count() == 50_000


@pytest.mark.parametrize("kept", [0, 1])
def test_dense_id_where_few_keys_own_the_counted_rows(spark, kept):
    # All rows but one share a key, or a single far key makes all bins but two empty.
    far = spark.range(1).select(F.lit(10**17).alias("k"), F.col("id"))
    near = spark.range(100_000).select((F.col("id") * kept).alias("k"), F.col("id"))
    df = near.unionByName(far)
    keyed = dense_id(df, ["k", "id"], "n", counted=df)
    assert keyed.where(F.col("n") != F.col("id") + 1).count() == 1
    assert keyed.agg(F.max("n")).first()[0] == 100_001
    written = keyed.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in written) == 100_001


def test_dense_id_of_nothing_counted(make):
    nothing = make([], "a int, b string")
    assert dense_id(nothing, ["a"], "n", counted=nothing).count() == 0


def test_dense_id_of_nothing(make):

    assert dense_id(make([], "a int, b string"), ["a"], "n").columns == ["n", "a", "b"]
    assert dense_id(make([], "a int, b string"), ["a"], "n").count() == 0


def test_dense_id_writes_only_the_columns_it_keeps(make):
    keyed = dense_id(make([(3, "c"), (1, "a"), (2, "b")], "k int, v string"), ["k"], "n", ["v"])
    assert rows(keyed) == [(1, "a"), (2, "b"), (3, "c")]
    assert "k:int" not in keyed._jdf.queryExecution().executedPlan().toString()


def test_first_seen_skips_null_and_keeps_raw_values(make):
    data = [(2, "b"), (1, None), (5, "c"), (4, "b"), (3, " b")]
    keyed = first_seen_id(make(data, "o int, v string").repartition(3), "v", ["o"], "n")
    assert rows(keyed, "n") == [(1, "b"), (2, " b"), (3, "c")]


def test_semi_if_any(make):
    left = make([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k int, v string")
    right = make([(1,), (1,), (3,)], "k int")
    assert rows(semi_if_any(left, right, "k")) == [(1, "a"), (1, "d")]
    assert semi_if_any(left, right.where("k > 9"), "k").count() == 4


def test_lookup_defaults_to_zero(make):
    left = make([(1,), (2,), (3,), (None,)], "k int")
    right = make([(1, 10), (2, None)], "id int, v int")
    found = lookup(left, right, "k", "id", "v", "out")
    assert rows(found) == [(None, 0), (1, 10), (2, 0), (3, 0)]
