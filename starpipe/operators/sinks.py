"""Typed replace and append loads of the star.

A Parquet warehouse is loaded by writing every table once into a new version folder and then creating
the next numbered list of what makes up each table: readers see the old star until all of the new one
is there, a failure at any point leaves the old one as it was, and of two loads at once the second
builds on the first. Other targets have no such switch;
there every table is computed and written to the shared folder before the first target is replaced,
parents before children. An empty table leaves its target as it was.
"""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from starpipe.control.versions import Conflict, Part, Version, Versions
from starpipe.operators.gate import Gate, pass_gate
from starpipe.schemas import LOAD_TIERS, STAR, ddl
from starpipe.sources.tables import each
from starpipe.workspace import CODEC, materialise

# Foreign keys the target declares nullable, where key 0 ("unknown") may be stored as null.
NULLABLE_KEYS = {
    "hechos_proyectos": ("ID_TiempoInicio", "ID_TiempoFinalizacion", "ID_Riesgo", "ID_Finanza"),
    "dim_riesgos": ("ID_TipoRiesgo", "ID_Severidad"),
}

_SAVE_MODE = {"replace": "overwrite", "append": "append"}


class Sink(ABC):
    @abstractmethod
    def write(self, df: DataFrame, table: str, mode: str) -> None: ...

    @abstractmethod
    def read(self, spark: SparkSession, table: str) -> DataFrame: ...

    def load(
        self,
        tables: Mapping[str, DataFrame],
        tiers: Iterable[Iterable[str]],
        mode: str,
        batch: str | None = None,
    ) -> dict[str, int]:
        """Rows loaded by table; a tier starts when the one before it is loaded."""
        if batch is not None:
            raise ValueError("this target keeps no ledger of batches")
        staged = each(lambda name: materialise(tables[name], f"load-{name}"), tables)

        def publish(name: str) -> int:
            # Counting the written copy only reads Parquet footers.
            rows = staged[name].count()
            if rows:
                self.write(staged[name], name, mode)
            return rows

        loaded: dict[str, int] = {}
        for tier in tiers:
            loaded.update(each(publish, [name for name in tier if name in tables]))
        return loaded


class ParquetSink(Sink):
    """``root/_versions/<load>/<table>`` folders, and in ``root/_log`` which of them count.

    With a ``gate`` a load is audited between writing and publishing: a repeated key stops it, rows
    without their parent go to ``root/_quarantine/<load>/<table>`` and into ``quarantined``.
    """

    def __init__(self, root: str, gate: Gate | None = None):
        self.root = root.rstrip("/")
        self.gate = gate
        #: Rows that the last load held back, by table.
        self.quarantined: dict[str, int] = {}

    def write(self, df: DataFrame, table: str, mode: str) -> None:
        self.load({table: df}, ((table,),), mode)

    def load(
        self,
        tables: Mapping[str, DataFrame],
        tiers: Iterable[Iterable[str]],
        mode: str,
        batch: str | None = None,
    ) -> dict[str, int]:
        """A batch that was loaded before, by this job or another, loads nothing."""
        if not tables:
            return {}
        spark = next(iter(tables.values())).sparkSession
        versions = Versions(spark, self.root)
        if batch is not None and batch in versions.newest().lotes:
            return dict.fromkeys(tables, 0)
        load = uuid.uuid4().hex
        folders = {name: f"{self.root}/_versions/{load}/{name}" for name in tables}

        def put(name: str) -> int:
            return stored(tables[name], folders[name]).count()

        loaded = each(put, tables)
        self.quarantined = {}
        audited = self._audit(spark, load, folders, loaded, mode) if self.gate else None
        filled = [name for name, rows in loaded.items() if rows]

        def change(base: Version) -> Version:
            if batch is not None and batch in base.lotes:
                return base
            if audited is not None and base.number != audited:
                raise Conflict("another load was published after the audit")
            made = base
            for name in filled:
                parts = [Part(name, folders[name])]
                made = made.replaced(name, parts) if mode == "replace" else made.appended(parts)
            return made if batch is None else made.with_batch(batch)

        done = versions.publish(change)
        if batch is not None and filled and not any(p.carpeta == folders[filled[0]] for p in done.parts):
            return dict.fromkeys(tables, 0)
        return loaded

    def _audit(self, spark, load: str, folders: dict, loaded: dict, mode: str) -> int:
        """Put the cleaned tables in the place of those with orphans, and correct the counts; the
        number of the version that they were audited against."""
        base = Versions(spark, self.root).newest()
        filled = [name for name, rows in loaded.items() if rows]
        stay = {part.tabla for part in base.parts if mode == "append" or part.tabla not in filled}

        def store(name: str, df: DataFrame, held: bool) -> DataFrame:
            if held:
                return stored(df, f"{self.root}/_quarantine/{load}/{name}")
            folders[name] = f"{self.root}/_versions/{load}/{name}-passed"
            return stored(df, folders[name])

        passed, self.quarantined = pass_gate(
            self.gate,
            {name: spark.read.schema(ddl(STAR[name])).parquet(folders[name]) for name in filled},
            {name: self.read(spark, name, base) for name in stay if name in STAR},
            store,
        )
        for name in self.quarantined:
            loaded[name] = passed[name].count()
        return base.number

    def read(self, spark: SparkSession, table: str, version: Version | None = None) -> DataFrame:
        """The table as of a version (the newest): what was replaced last and appended since."""
        parts = (version or Versions(spark, self.root).newest()).of(table)
        if not parts:
            raise ValueError(f"{table} was never loaded to {self.root}")
        return spark.read.schema(ddl(STAR[table])).parquet(*[part.carpeta for part in parts])

    def clean(self, spark: SparkSession, grace_seconds: float) -> list[str]:
        """Remove superseded versions and what failed loads left; see ``Versions.clean``."""
        return Versions(spark, self.root).clean(grace_seconds)


def stored(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class CatalogSink(Sink):
    """Tables of a catalog database."""

    def __init__(self, database: str):
        self.database = database

    def write(self, df: DataFrame, table: str, mode: str) -> None:
        df.write.mode(_SAVE_MODE[mode]).format("parquet").saveAsTable(f"{self.database}.{table}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(f"{self.database}.{table}")


class JdbcSink(Sink):
    """Tables of a database; a replace empties the table and keeps its definition.

    At most ``connections`` tasks write at a time, which is the database's limit to name, each in
    batches of ``batch`` rows.
    """

    def __init__(self, options: dict[str, str], connections: int, batch: int = 1000):
        self.options = {
            **options,
            "batchsize": str(batch),
            "truncate": "true",
            "numPartitions": str(connections),
        }

    def write(self, df: DataFrame, table: str, mode: str) -> None:
        writer = df.write.format("jdbc").options(**self.options).option("dbtable", table)
        writer.mode(_SAVE_MODE[mode]).save()

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options).option("dbtable", table).load()


def conformed(
    df: DataFrame, table: str, zero_to_null: bool = False, extra: Iterable[str] = ()
) -> DataFrame:
    """The target's columns and types, and ``extra`` columns as they are.

    Ratios that the target's type cannot hold, NaN, infinities and others too large for it, become
    null; ``audits.unstorable`` counts them.
    """
    nullable = NULLABLE_KEYS.get(table, ()) if zero_to_null else ()

    def column(name: str, kind: str) -> Column:
        value = F.col(name)
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            value = value.try_cast(kind)
        if name in nullable:
            value = F.nullif(value, F.lit(0))
        return value.cast(kind).alias(name)

    return df.select(*[column(name, kind) for name, kind in STAR[table].items()], *extra)


def load_table(
    df: DataFrame, table: str, sink: Sink, mode: str = "replace", batch: str | None = None
) -> int:
    """Replace or extend one table; returns the rows loaded, 0 if there were none."""
    return load_all({table: df}, sink, tiers=((table,),), mode=mode, batch=batch)[table]


def load_all(
    tables: Mapping[str, DataFrame],
    sink: Sink,
    tiers: Iterable[Iterable[str]] = LOAD_TIERS,
    mode: str = "replace",
    zero_to_null: bool = False,
    batch: str | None = None,
) -> dict[str, int]:
    """Load the tables tier by tier; a table that is not given counts 0 rows.

    ``batch`` names the load in the target's ledger: started again, it loads nothing.
    """
    tiers = [tuple(tier) for tier in tiers]
    names = [name for tier in tiers for name in tier]
    ready = {name: conformed(tables[name], name, zero_to_null) for name in names if name in tables}
    ledger = {} if batch is None else {"batch": batch}
    return dict.fromkeys(names, 0) | sink.load(ready, tiers, mode, **ledger)
