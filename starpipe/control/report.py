"""What a run read, wrote and lost, counted by the jobs that write its tables.

Counts ride on a write (``DataFrame.observe``), so none is a job of its own. They stand on top of the
written plan, in its last stage, where a partition that is computed again after an executor was lost
counts once; below an exchange it might count twice. So what a step loses is the difference of two
written tables, never a count below the step's filter.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starpipe.schemas import STAR
from starpipe.sources.tables import Tables
from starpipe.workspace import materialise

EXTRACT, LOAD, LOSS = "extraccion", "carga", "perdida"
ROWS = "filas"

#: Star tables with one row for each row of some extracts, but for those that a step leaves out.
ORIGINS = {
    "dim_clientes": ("clientes",),
    "dim_empleados": ("empleados",),
    "dim_proyectos": ("proyectos",),
    "dim_hitos": ("hitos",),
    "dim_tareas": ("tareas",),
    "dim_pruebas": ("pruebas",),
    "dim_finanzas": ("gastos", "penalizaciones"),
    "dim_riesgos": ("riesgos",),
    "hechos_proyectos": ("proyectos",),
    "hechos_asignaciones": ("asignaciones",),
}


def losses(table: str) -> dict[str, Column]:
    """What to count of a star table beside its rows."""
    if table == "hechos_asignaciones":
        return {"sin_fecha": F.count_if(F.col("ID_FechaAsignacion") == 0)}
    if table == "hechos_proyectos":
        ratio = F.col("ProporcionCAPEX_OPEX")
        kept = ratio.try_cast(STAR[table]["ProporcionCAPEX_OPEX"])
        return {"no_almacenables": F.count_if(ratio.isNotNull() & kept.isNull())}
    return {}


class RunReport:
    """Counts by stage, table and measure; empty until tables are written."""

    def __init__(self):
        self._pending: dict[tuple[str, str], Observation] = {}
        self._counts: dict[tuple[str, str], dict[str, int]] = {}

    def observed(self, df: DataFrame, stage: str, table: str, **measures: Column) -> DataFrame:
        """``df``, whose next job counts its rows and takes the aggregates ``measures``."""
        observation = Observation(f"{stage}-{table}-{uuid.uuid4().hex}")
        self._pending[stage, table] = observation
        named = [measure.alias(name) for name, measure in measures.items()]
        return df.observe(observation, F.count(F.lit(1)).alias(ROWS), *named)

    def written(self, stage: str, table: str) -> None:
        """To be called when the observed frame was written; before, its counts would be waited for."""
        observation = self._pending.pop((stage, table), None)
        if observation is not None:
            self._counts[stage, table] = {name: int(n or 0) for name, n in observation.get.items()}

    def keep(
        self, stage: str, write: Callable[[DataFrame, str], DataFrame] = materialise
    ) -> Callable[[DataFrame, str], DataFrame]:
        """``write`` with a count, for ``extract_all`` and ``build_star``."""

        def counted(df: DataFrame, table: str) -> DataFrame:
            stored = write(self.observed(df, stage, table), table)
            self.written(stage, table)
            return stored

        return counted

    def star(self, star: Mapping[str, DataFrame]) -> Tables:
        """The same tables, counted when they are loaded."""
        return Tables(
            {name: (lambda n=name: self.observed(star[n], LOAD, n, **losses(n))) for name in star}
        )

    def rows(self, stage: str, tables: Iterable[str]) -> dict[str, int]:
        """Rows by table; 0 for what was not written."""
        return {name: self._counts.get((stage, name), {}).get(ROWS, 0) for name in tables}

    def entries(self) -> list[tuple[str, str, str, int]]:
        """(stage, table, measure, number): all counts, and what star tables lack of their extracts."""
        found = [
            (stage, table, measure, number)
            for (stage, table), counts in self._counts.items()
            for measure, number in counts.items()
        ]
        for table, origins in ORIGINS.items():
            ends = [(EXTRACT, origin) for origin in origins]
            if (LOAD, table) in self._counts and all(end in self._counts for end in ends):
                lost = sum(self._counts[end][ROWS] for end in ends) - self._counts[LOAD, table][ROWS]
                found.append((LOSS, table, ROWS, lost))
        return sorted(found)

    def frame(self, spark: SparkSession) -> DataFrame:
        """(etapa, tabla, medida, valor); a few rows for each table, whatever their sizes."""
        return spark.createDataFrame(
            self.entries(), "etapa string, tabla string, medida string, valor long"
        )
