import hashlib

import duckdb
from pyspark.sql import functions as F

from starpipe.llm import oracles
from starpipe.llm.digest_index import DigestIndex, keep_last
from starpipe.llm.registry import op11_exact_dedup
from starpipe.workspace import new_path

SCHEMA = "doc_id long, text string, digest int, holder int, hot int, id string"


def rows_of(resolved):
    return sorted(
        ((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in resolved.collect()), key=str
    )


def docs(make, pairs):
    """Documents whose other columns have the names the operator uses itself."""
    return make([(i, text, 1, 2, 3, "x") for i, text in pairs], SCHEMA)


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    mine = sorted(tuple(r) for r in op11_exact_dedup(spark, sf_dir).select(*names).collect())
    assert mine == sorted(con.execute(f"SELECT {', '.join(names)} FROM ({oracles.duplicates()})").fetchall())
    assert any(not row[3] for row in mine)


def test_edge_cases_in_one_batch(spark, make):
    given = [(1, "a"), (5, "a"), (3, "a"), (2, None), (4, ""), (None, "b"), (None, "b"), (7, "c"), (7, "c"), (8, "A"),
             (9, "a "), (10, "x" * 300_000), (11, "x" * 300_000), (None, "a")]
    resolved = keep_last(docs(make, given), new_path(spark, "digests"))
    assert rows_of(resolved) == sorted(
        [(1, 5, 4, False), (5, 5, 4, True), (3, 5, 4, False), (None, 5, 4, False), (2, 4, 2, False), (4, 4, 2, True),
         (None, None, 2, False), (None, None, 2, True), (7, 7, 2, False), (7, 7, 2, True), (8, 8, 1, True),
         (9, 9, 1, True), (10, 11, 2, False), (11, 11, 2, True)], key=str
    )
    first = resolved.where("id = 5").first()
    assert bytes(first["digest"]).hex() == hashlib.sha256(b"a").hexdigest()
    assert first["given"].asDict() == {"doc_id": 5, "text": "a", "digest": 1, "holder": 2, "hot": 3, "id": "x"}


def test_empty_table(spark, make):
    assert keep_last(docs(make, []), new_path(spark, "digests")).count() == 0


def test_later_batches_meet_the_index(spark, make):
    path = new_path(spark, "digests")
    index = DigestIndex(spark, path, buckets=3)
    one = index.add(docs(make, [(1, "a"), (2, "b"), (3, "b")]), "monday")
    held = index.rows().count()
    # Opened again, as another job would; the number of buckets is found, not the one asked for.
    index = DigestIndex(spark, path, buckets=5)
    assert index.buckets == 3
    two = index.add(docs(make, [(9, "b"), (10, "c"), (11, "c")]), "tuesday")
    assert index.rows().where("batch = 'monday'").count() == held == 2
    assert {(r["copies"], r["holds"]) for r in index.rows().where("batch = 'tuesday'").collect()} == {(1, False), (2, True)}
    assert rows_of(index.resolve(one.union(two))) == sorted(
        [(1, 1, 1, True), (2, 3, 3, False), (3, 3, 3, True), (9, 3, 3, False), (10, 11, 2, False), (11, 11, 2, True)],
        key=str,
    )


def test_a_batch_entered_twice_counts_once(spark, make):
    index = DigestIndex(spark, new_path(spark, "digests"))
    given = docs(make, [(1, "a"), (2, "a")])
    before = rows_of(index.resolve(index.add(given, "monday")))
    assert rows_of(index.resolve(index.add(given, "monday"))) == before == [(1, 2, 2, False), (2, 2, 2, True)]


def test_the_index_is_read_by_bucket_without_an_exchange(spark, make):
    index = DigestIndex(spark, new_path(spark, "digests"), buckets=3)
    index.add(docs(make, [(i, str(i % 7)) for i in range(50)]), "monday")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = make([(b"x",)], "digest binary")
        joined = found.join(index.rows().hint("merge"), "digest", "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        groups = index.groups()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning(digest") == 1
    assert "Exchange" not in groups


def test_a_hot_text_is_not_dealt_to_one_task(spark, make):
    given = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    resolved = keep_last(given, new_path(spark, "digests"))
    assert "BroadcastHashJoin" in resolved._jdf.queryExecution().executedPlan().toString()
    assert resolved.where("kept").count() == 2001
    assert {r["group_size"] for r in resolved.where("keep_id = 2997").collect()} == {1000}
