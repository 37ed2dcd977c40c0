"""Exact duplicates across batches, through a persistent index of digests.

The index is a Parquet table bucketed and sorted by the SHA-256 of the texts. A batch is reduced to
one row per digest (a partial aggregate, so a text that fills a third of the rows shrinks inside the
map tasks); a sort-merge anti-join with the index, which needs no exchange on the index's side, tells
the digests never seen, and these are appended with the row that stays. Digests that are known are
appended as sightings, with their number of copies only. Nothing in the index is ever rewritten.

Built-in functions only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.llm.common import cut

#: Spark's own limit of buckets per table.
MOST_BUCKETS = 100_000
#: A digest with more than one in so many of all rows is a hot one, so there are fewer than that.
HOT = 1000

_COLUMNS = "digest binary, keep_id bigint, keep_row bigint, copies bigint, batch string, holds boolean"


def digest_of(text: Column) -> Column:
    """32 bytes of the whole text in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


class DigestIndex:
    """``path/of-<buckets>`` holds the bucketed table, ``path/rows/<batch>`` each batch's rows.

    The number of buckets is fixed when the index is made (the session's shuffle partitions, if not
    given) and found again by the next one that opens ``path``, in this session or a later one.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        asked = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = self._buckets() or min(asked, MOST_BUCKETS)
        self._table = f"digests_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"
        where = f"{self.path}/of-{self.buckets}".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._table} ({_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{where}'"
        )

    def _buckets(self) -> int | None:
        jvm = self.spark.sparkContext._jvm
        found = jvm.org.apache.hadoop.fs.Path(f"{self.path}/of-*")
        store = found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [status.getPath().getName() for status in store.globStatus(found) or ()]
        return int(names[0].removeprefix("of-")) if names else None

    def rows(self) -> DataFrame:
        """The index as it is now, appends of other sessions included."""
        self.spark.catalog.refreshTable(self._table)
        return self.spark.table(self._table)

    def add(
        self,
        docs: DataFrame,
        batch: str,
        text: str = "text",
        key: str = "doc_id",
        carry: Sequence[str] | None = None,
    ) -> DataFrame:
        """Enter a batch; its rows as (``given`` struct of the ``carry`` columns, ``id``, ``digest``,
        ``row``, ``batch``), for ``resolve``.

        Of equal texts in the batch the row with the largest integer ``key`` stays, of repeated rows any
        one; null keys come last, null and empty texts are equal. A text that the index holds stays
        with the row it has. A batch name that is in the index already changes nothing and gives the
        rows entered then, so a job can be started again. Carried columns may have any names.
        """
        where = f"{self.path}/rows/{hashlib.sha256(batch.encode()).hexdigest()}"
        if not self.rows().where(F.col("batch") == batch).isEmpty():
            return self.spark.read.parquet(where)
        carry = docs.columns if carry is None else list(carry)
        given = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
        docs.select(
            given.alias("given"),
            F.col(f"`{key}`").cast("long").alias("id"),
            digest_of(F.col(f"`{text}`")).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
            F.lit(batch).alias("batch"),
        ).write.mode("overwrite").parquet(where)
        rows = self.spark.read.parquet(where)
        found = cut(
            rows.groupBy("digest").agg(
                F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("copies")
            ),
            "digests-of-batch",
        )
        seen = self.rows()
        fresh = found.join(seen.hint("merge"), "digest", "left_anti").select(
            "digest", "last.id", "last.row", "copies", F.lit(batch), F.lit(True)
        )
        again = found.join(seen.hint("merge"), "digest", "left_semi").select(
            "digest", F.lit(None), F.lit(None), "copies", F.lit(batch), F.lit(False)
        )
        new = cut(fresh.union(again).toDF(*seen.columns), "digests-to-append")
        # One file a bucket; all of the batch appears with the job's commit.
        new.repartition(self.buckets, "digest").write.insertInto(self._table)
        return rows

    def groups(self) -> DataFrame:
        """(digest, holder, group_size) of every text; no exchange, since the buckets are groups."""
        holder = F.when(F.col("holds"), F.struct("keep_id", "keep_row", "batch"))
        return self.rows().groupBy("digest").agg(
            F.max(holder).alias("holder"), F.sum("copies").alias("group_size")
        )

    def resolve(self, rows: DataFrame) -> DataFrame:
        """``rows`` of one or more batches with ``keep_id``, ``group_size`` and ``kept``.

        Fewer than ``HOT`` texts can have more than one in ``HOT`` of all rows; their groups, so bounded,
        are broadcast, and only rows of other texts are dealt out by digest. A group whose keys are
        all null keeps one row, with a null ``keep_id``. No rows give none.
        """
        total = self.rows().agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
        groups = self.groups()
        is_hot = F.col("group_size") * HOT > total
        hot = F.broadcast(cut(groups.where(is_hot), "hot-digests"))
        common = rows.join(hot, "digest")
        rest = rows.join(hot, "digest", "left_anti").join(groups.where(~is_hot), "digest")
        holder = F.col("holder")
        return common.unionByName(rest).select(
            *rows.columns,
            holder["keep_id"].alias("keep_id"),
            "group_size",
            ((holder["batch"] == F.col("batch")) & (holder["keep_row"] == F.col("row"))).alias("kept"),
        )


def keep_last(docs: DataFrame, path: str, carry: Sequence[str] | None = None) -> DataFrame:
    """All rows resolved, over an index at ``path`` that is fed with the larger half of the ids first.

    So a text's holder is its row with the largest ``doc_id``, though later batches never replace it.
    """
    spark = docs.sparkSession
    ends = docs.agg(F.min("doc_id").cast("long"), F.max("doc_id").cast("long")).first()
    middle = (ends[0] + ends[1]) // 2 if ends[0] is not None else 0
    index = DigestIndex(spark, path)
    larger = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    first = index.add(docs.where(larger), "larger ids", carry=carry)
    second = index.add(docs.where(~larger), "smaller ids", carry=carry)
    return index.resolve(first.unionByName(second))
