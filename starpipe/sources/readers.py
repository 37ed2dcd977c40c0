"""Readers for a source system held as Parquet files, catalog tables or a JDBC database.

A relation that cannot be read raises; it never turns into an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from starpipe.schemas import SOURCE, ddl, primary_key
from starpipe.sources.tables import Tables


def typed(df: DataFrame, name: str) -> DataFrame:
    """The relation's columns, cast to its contract."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in SOURCE[name].items()])


def _each(read: Callable[[str], DataFrame]) -> Tables:
    return Tables({name: (lambda n=name: read(n)) for name in SOURCE})


def parquet_source(spark: SparkSession, root: str) -> Tables:
    """``root/<relation>`` directories, read with the contract's schema (no inference)."""
    return _each(
        lambda name: spark.read.schema(ddl(SOURCE[name])).parquet(f"{root.rstrip('/')}/{name}")
    )


def folder_bytes(spark: SparkSession, root: str) -> int:
    """Size of all files below a folder, as its store reports it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.getContentSummary(path).getLength()


def catalog_source(spark: SparkSession, database: str) -> Tables:
    return _each(lambda name: typed(spark.table(f"{database}.{name}"), name))


def frame_source(frames: dict[str, DataFrame]) -> Tables:
    """Relations given as DataFrames; missing ones are empty."""
    spark = next(iter(frames.values())).sparkSession

    def read(name: str) -> DataFrame:
        if name in frames:
            return typed(frames[name], name)
        return spark.createDataFrame([], ddl(SOURCE[name]))

    return _each(read)


def partition_options(name: str, low: int, high: int, partitions: int) -> dict[str, str]:
    """Options that split a JDBC read into ranges of the relation's primary key."""
    return {
        "partitionColumn": primary_key(name),
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(partitions),
    }


#: A bucket of a key histogram: first key, last key, rows.
Bucket = tuple[int, int, int]

#: Buckets that the database counts in one query, which is also what comes to the driver.
BUCKETS = 10_000


def histogram_query(name: str, low: int, high: int) -> str:
    """SQL for the rows of a relation by at most ``BUCKETS`` equal ranges of its key.

    First and last key of a bucket are the database's own, so that empty stretches belong to none.
    """
    key, width = primary_key(name), -(-(high - low + 1) // BUCKETS)
    return (
        f"SELECT MIN({key}) lo, MAX({key}) hi, COUNT(*) n FROM {name} "
        f"WHERE {key} BETWEEN {low} AND {high} GROUP BY FLOOR(({key} - {low}) / {width})"
    )


def key_starts(
    histogram: Callable[[int, int], list[Bucket]], low: int, high: int, rows_per_task: int
) -> list[int]:
    """First keys of ranges with about ``rows_per_task`` rows each, in order.

    Small buckets are put together, large ones are cut into equal stretches of keys. A bucket with
    over a hundredth of the rows is counted again in finer buckets first, which is at most a hundred
    queries for a level, and each level is ``BUCKETS`` times finer.
    """

    def pieces(low: int, high: int) -> list[Bucket]:
        buckets = sorted(histogram(low, high))
        total = sum(rows for *_, rows in buckets)
        found = []
        for first, last, rows in buckets:
            narrower = last - first < high - low
            if rows > rows_per_task and rows * 100 > total and narrower and last - first >= rows:
                found += pieces(first, last)
            else:
                found.append((first, last, rows))
        return found

    starts: list[int] = []
    room = 0
    for first, last, rows in pieces(low, high):
        if rows > room:
            parts = max(1, round(rows / rows_per_task))
            starts += sorted({first + (last - first + 1) * part // parts for part in range(parts)})
            # What is left of the last part's share is the next buckets' to fill.
            room = max(0, rows_per_task - -(-rows // parts))
        else:
            room -= rows
    return starts


def key_predicates(key: str, starts: list[int]) -> list[str]:
    """Conditions of which each row meets exactly one, whatever keys came in after the count."""
    inner = starts[1:]
    if not inner:
        return ["1 = 1"]
    first = f"{key} < {inner[0]} OR {key} IS NULL"
    middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(inner, inner[1:])]
    return [first, *middle, f"{key} >= {inner[-1]}"]


def jdbc_source(
    spark: SparkSession,
    options: dict[str, str],
    bounds: dict[str, tuple[int, int]] | None = None,
    keys_per_task: int = 1_000_000,
    rows_per_task: int = 1_000_000,
    readers: int | None = None,
) -> Tables:
    """A database as source; ``options`` as for Spark's JDBC format (url, user, fetchsize...).

    A relation whose key range ``bounds`` names is read by ranges of ``keys_per_task`` primary keys.
    For others the database counts a histogram of the key, and each range has about
    ``rows_per_task`` rows, so sparse keys don't make empty tasks. At most ``readers`` tasks read a
    relation at a time, one range after the other; by default as many as there are cores. Column
    lists and single-table filters are pushed into the database by Spark.
    """

    def reader() -> DataFrameReader:
        return spark.read.format("jdbc").options(**options)

    def asked(query: str) -> list[tuple]:
        return [tuple(row) for row in reader().option("query", query).load().collect()]

    def histogram(name: str) -> Callable[[int, int], list[Bucket]]:
        return lambda low, high: [
            (int(a), int(b), int(n)) for a, b, n in asked(histogram_query(name, low, high))
        ]

    def ranged(name: str) -> DataFrame:
        key = primary_key(name)
        ((low, high),) = asked(f"SELECT MIN({key}) lo, MAX({key}) hi FROM {name}")
        starts = [] if low is None else key_starts(histogram(name), int(low), int(high), rows_per_task)
        properties = {n: v for n, v in options.items() if n != "url"}
        return spark.read.jdbc(
            options["url"], name, predicates=key_predicates(key, starts), properties=properties
        )

    def bounded(name: str, low: int, high: int) -> DataFrame:
        split = partition_options(name, low, high, -(-(high - low + 1) // keys_per_task))
        return reader().options(**split).option("dbtable", name).load()

    def read(name: str) -> DataFrame:
        df = bounded(name, *bounds[name]) if name in (bounds or {}) else ranged(name)
        return typed(df if readers is None else df.coalesce(readers), name)

    return _each(read)
