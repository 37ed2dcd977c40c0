"""From raw documents to packed training sequences.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's docs; all but the last return the columns of
``documents``. ``run`` applies them to the table ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.llm.common import read_table
from starpipe.llm.mixing import copies_of, domain_of_labels, mix
from starpipe.llm.packing import pack
from starpipe.llm.pii import pseudonymise
from starpipe.llm.quality import judge
from starpipe.llm.registry import SECRET, tokenizer_files
from starpipe.llm.setjoin import one_of_each
from starpipe.workspace import new_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the label model accepts."""
    return judge(docs).where(F.col("__quality.kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    return one_of_each(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in place of personal data; lengths don't change."""
    return pseudonymise(docs, SECRET)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its rate says."""
    return copies_of(mix(docs, domain_of_labels(read_table(spark, sf_dir, "labels"))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all token sequences."""
    return pack(docs, *tokenizer_files())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", pii),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: The label model and the rates are fitted step by step, which SQL can't express; the pipeline is
#: tested against a version in plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
