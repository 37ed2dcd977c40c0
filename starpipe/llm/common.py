"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.workspace import materialise

#: The white space between words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    """Only A-Z are lower-cased, whatever the locale."""
    return F.translate(column, UPPER, UPPER.lower())


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, for a column that is added on the way."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read again: survives lost executors."""
    return materialise(df, f"llm-{label}")


def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, ...]]:
    """The columns of each non-empty batch as Python lists."""
    for batch in batches:
        if batch.num_rows:
            yield tuple(column.to_pylist() for column in batch.columns)
