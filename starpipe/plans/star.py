"""The whole star over one set of extracts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame

from starpipe.functions.columns import UNSPECIFIED
from starpipe.operators import dims, facts
from starpipe.sources.tables import Tables
from starpipe.workspace import materialise

# What the star, whole or kept up to date by changes, reads of each extract.
INPUTS = {
    "clientes": ("ID_Cliente",),
    "empleados": ("ID_Empleado", "Rol", "Seniority"),
    "contratos": ("ID_Contrato",),
    "proyectos": (
        "ID_Proyecto", "ID_Contrato", "Version", "FechaInicio", "FechaFin", "EstadoProyecto",
        "ID_Cliente", "ValorTotalContrato",
    ),
    "hitos": ("ID_Hito", "ID_Proyecto", "FechaInicio", "FechaFinPlanificada", "FechaFinReal"),
    "tareas": ("ID_Tarea", "ID_Hito", "ID_Proyecto", "DuracionPlanificada", "DuracionReal"),
    "asignaciones": (
        "ID_Asignacion", "ID_Proyecto", "ID_Empleado", "HorasPlanificadas", "HorasReales",
        "FechaAsignacion", "CostoPorHora",
    ),
    "pruebas": ("ID_Prueba", "ID_Hito", "ID_Proyecto", "TipoPrueba", "Exitosa"),
    "errores": ("ID_Error", "ID_Proyecto"),
    "riesgos": ("ID_Riesgo", "ID_Proyecto", "TipoRiesgo", "Severidad", "FechaRegistro"),
    "gastos": ("ID_Gasto", "ID_Proyecto", "TipoGasto", "Categoria", "Monto", "Fecha"),
    "penalizaciones": ("ID_Penalizacion", "ID_Contrato", "ID_Cliente", "Monto", "Fecha"),
}


def keep_inputs(extract: DataFrame, name: str, more: Iterable[str] = ()) -> DataFrame:
    """A ``keep`` for extracts that only a star is built from: other columns are never moved, but
    for those in ``more`` that the extract has."""
    return materialise(extract.select(*INPUTS[name], *[c for c in more if c in extract.columns]), name)


def build_star(
    extracts: Mapping[str, DataFrame],
    fact_inputs: Mapping[str, DataFrame] | None = None,
    calendar_key_mode: str = "fixed_base",
    null_text: str = UNSPECIFIED,
    resolve_finanza: bool = False,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> Tables:
    """Eleven dimensions, three sub-dimensions and two facts, built on first use.

    ``fact_inputs``: tables for the calendar and the project fact where these should reduce the
    source's own children before the scope join (``unscoped_children``).
    ``calendar_key_mode``: "fixed_base" counts milestone dates from the fixed calendar start,
    "lookup" uses the calendar's own keys.
    ``null_text``: what a missing expense category becomes.
    ``keep``: for building the whole star: the calendar comes from the project rollup, which the
    project fact needs anyway, and is passed through ``keep`` (e.g. ``materialise``). Without it
    the calendar only reads date columns, which is cheaper for a single table.
    ``resolve_finanza``: let the project fact refer to ``dim_finanzas`` keys.
    """
    if calendar_key_mode not in ("fixed_base", "lookup"):
        raise ValueError(f"unknown calendar_key_mode {calendar_key_mode!r}")
    reduced = fact_inputs or extracts
    shared = Tables(
        {
            "types": lambda: dims.risk_types(extracts),
            "levels": lambda: dims.severities(extracts),
            "finances": lambda: dims.numbered_finances(
                extracts, null_text, None if resolve_finanza else dims.FINANCE_COLUMNS
            ),
            # Written because the rollup and the calendar both read them.
            "penalties": lambda: materialise(dims.penalties_by_contract(reduced), "penalties"),
            # Written because the calendar, the risk default and the fact itself all read it.
            "rollup": lambda: materialise(
                facts.project_rollup(
                    reduced, penalties=shared["penalties"], projects=facts.numbered_projects(reduced)
                ),
                "rollup",
            ),
            "rollup_calendar": lambda: dims.dim_tiempo(
                facts.rollup_span(shared["rollup"], reduced, shared["penalties"])
            ),
        }
    )
    star: Tables

    def calendar() -> DataFrame:
        return star["dim_tiempo"]

    def own_calendar() -> DataFrame:
        return keep(shared["rollup_calendar"], "dim_tiempo") if keep else dims.dim_tiempo(
            dims.calendar_span(reduced)
        )

    star = Tables(
        {
            "dim_clientes": lambda: dims.dim_clientes(extracts),
            "dim_empleados": lambda: dims.dim_empleados(extracts),
            "dim_proyectos": lambda: dims.dim_proyectos(extracts),
            "dim_tiempo": own_calendar,
            "dim_hitos": lambda: dims.dim_hitos(
                extracts, calendar() if calendar_key_mode == "lookup" else None
            ),
            "dim_tareas": lambda: dims.dim_tareas(extracts),
            # Extracted tests come through extracted milestones, so none can be unknown.
            "dim_pruebas": lambda: dims.dim_pruebas(extracts, check_milestones=False),
            "dim_finanzas": lambda: shared["finances"].select(
                "ID_Finanza", "TipoGasto", "Categoria", "Monto"
            ),
            "dim_tipo_riesgo": lambda: dims.dim_tipo_riesgo(shared["types"]),
            "dim_severidad": lambda: dims.dim_severidad(shared["levels"]),
            "dim_riesgos": lambda: dims.dim_riesgos(extracts, shared["types"], shared["levels"]),
            "hechos_asignaciones": lambda: facts.hechos_asignaciones(extracts, calendar()),
            "hechos_proyectos": lambda: facts.hechos_proyectos(
                reduced,
                shared["rollup"],
                calendar() if keep else shared["rollup_calendar"],
                shared["finances"] if resolve_finanza else None,
            ),
            "subdim_dia_semana": lambda: dims.subdim_dia_semana(calendar()),
            "subdim_mes": lambda: dims.subdim_mes(calendar()),
            "subdim_anio": lambda: dims.subdim_anio(calendar()),
        }
    )
    return star
