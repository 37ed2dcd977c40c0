"""Row counts, key uniqueness and referential integrity as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpipe.schemas import FOREIGN_KEYS, primary_key


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """(tabla, filas) for each named table."""
    return _union(
        tables[name]
        .agg(F.count("*").alias("filas"))
        .select(F.lit(name).alias("tabla"), "filas")
        for name in names
    )


def duplicate_keys(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """(tabla, clave, duplicadas): how many primary-key values occur more than once."""

    def audit(name: str) -> DataFrame:
        key = primary_key(name)
        repeated = tables[name].groupBy(key).count().where(F.col("count") > 1)
        return repeated.agg(F.count("*").alias("duplicadas")).select(
            F.lit(name).alias("tabla"), F.lit(key).alias("clave"), "duplicadas"
        )

    return _union(audit(name) for name in names)


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """(valor, filas): child key values missing in the parent and their rows; null is no orphan.

    The child is counted per key first, so the anti join sees a hot key once.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("bigint").alias("valor"))
        .agg(F.count("*").alias("filas"))
    )
    known = parent.select(F.col(parent_column).cast("bigint").alias("valor"))
    return used.join(known, "valor", "left_anti")


def foreign_key_audit(
    tables: Mapping[str, DataFrame], keys: Iterable[tuple[str, str, str, str]] = FOREIGN_KEYS
) -> DataFrame:
    """(tabla, columna, referencia, valores, filas): orphan values and rows per foreign key."""
    return _union(
        orphans(tables[child], column, tables[parent], parent_column)
        .agg(F.count("*").alias("valores"), F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"))
        .select(
            F.lit(child).alias("tabla"),
            F.lit(column).alias("columna"),
            F.lit(parent).alias("referencia"),
            "valores",
            "filas",
        )
        for child, column, parent, parent_column in keys
    )


def dropped_by(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """(tabla, antes, despues, filtradas): rows a filter removed."""
    counted = before.agg(F.count("*").alias("antes")).select(
        F.lit(name).alias("tabla"), "antes", F.lit(0).cast("bigint").alias("despues")
    )
    left = after.agg(F.count("*").alias("despues")).select(
        F.lit(name).alias("tabla"), F.lit(0).cast("bigint").alias("antes"), "despues"
    )
    return (
        counted.unionByName(left)
        .groupBy("tabla")
        .agg(F.sum("antes").alias("antes"), F.sum("despues").alias("despues"))
        .withColumn("filtradas", F.col("antes") - F.col("despues"))
    )


def dropped_unless(marked: DataFrame, kept: str, name: str) -> DataFrame:
    """``dropped_by`` in one pass: column ``kept`` says which rows the filter leaves."""
    counted = marked.agg(F.count("*").alias("antes"), F.count_if(kept).alias("despues"))
    return counted.select(
        F.lit(name).alias("tabla"), "antes", "despues", (F.col("antes") - F.col("despues")).alias("filtradas")
    )


def unstorable(star_table: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """(columna, valores): numbers that the stored column could not hold and has as null."""
    filled = [
        df.agg(F.count(column).alias("n")).select("n", F.lit(sign).alias("sign"))
        for df, sign in ((star_table, 1), (stored, -1))
    ]
    return _union(filled).agg(F.sum(F.col("n") * F.col("sign")).alias("valores")).select(
        F.lit(column).alias("columna"), "valores"
    )


def unmatched_dates(facts: DataFrame) -> DataFrame:
    """(sin_fecha): assignments whose day is not in the calendar."""
    return facts.agg(F.count_if(F.col("ID_FechaAsignacion") == 0).alias("sin_fecha"))
