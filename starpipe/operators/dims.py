"""The eleven dimensions and the calendar's three sub-dimensions.

Each builder takes extracted tables (name -> DataFrame) and returns the dimension with exactly its
contract's columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.functions import columns as C
from starpipe.functions.keys import dense_id, first_seen_id
from starpipe.functions.lookups import marked_if_any, semi_if_any
from starpipe.operators.extract import EXTRACTION_ORDER

Extracts = Mapping[str, DataFrame]

# The columns that decide how far the calendar reaches, by table.
CALENDAR_COLUMNS = {
    "proyectos": ("FechaInicio", "FechaFin"),
    "hitos": ("FechaInicio", "FechaFinPlanificada", "FechaFinReal"),
    "asignaciones": ("FechaAsignacion",),
    "gastos": ("Fecha",),
    "penalizaciones": ("Fecha",),
}

# What dim_finanzas has beside its key.
FINANCE_COLUMNS = ("TipoGasto", "Categoria", "Monto")


def dim_clientes(t: Extracts) -> DataFrame:
    key = F.col("ID_Cliente")
    return t["clientes"].select(key, key.alias("CodigoClienteReal"))


def dim_empleados(t: Extracts) -> DataFrame:
    key = F.col("ID_Empleado")
    return t["empleados"].select(
        key,
        key.alias("CodigoEmpleado"),
        C.strip(F.col("Rol")).alias("Rol"),
        C.text_or(F.col("Seniority"), C.UNSPECIFIED).alias("Seniority"),
    )


def known_projects(projects: DataFrame, t: Extracts) -> DataFrame:
    """Projects of extracted clients; with no clients at all, every project."""
    return semi_if_any(projects, t["clientes"], "ID_Cliente")


def dim_proyectos(t: Extracts) -> DataFrame:
    key = F.col("ID_Proyecto")
    return known_projects(t["proyectos"], t).select(
        key,
        key.alias("CodigoProyecto"),
        C.text_or(F.col("Version"), C.DEFAULT_VERSION).alias("Version"),
        C.flag(C.equals_upper(F.col("EstadoProyecto"), C.CANCELLED)).alias("Cancelado"),
        "ID_Cliente",
    )


def date_span(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row: first and last day over several date columns (partial aggregate, no distinct)."""
    days = [F.col(c) for c in columns]
    return df.agg(F.min(C.min_of(days)).alias("first"), F.max(C.max_of(days)).alias("last"))


def days_by(df: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """(key, first, last): the first and last day of every row."""
    days = [F.col(c) for c in columns]
    return df.select(key, C.min_of(days).alias("first"), C.max_of(days).alias("last"))


def observed_dates(t: Extracts) -> DataFrame:
    """The distinct days over all calendar columns of all tables."""
    per_table = [
        t[name].select(F.explode(F.array(*columns)).alias("Fecha"))
        for name, columns in CALENDAR_COLUMNS.items()
    ]
    return reduce(DataFrame.unionByName, per_table).where(F.col("Fecha").isNotNull()).distinct()


def penalties_by_contract(t: Extracts) -> DataFrame:
    """Penalties of the closed contracts, one row each: their sum, first and last day.

    The extracted contracts carry the scope, under whatever collation they were chosen.
    """
    closed = t["contratos"].select("ID_Contrato")
    per_contract = t["penalizaciones"].groupBy("ID_Contrato").agg(
        F.sum("Monto").alias("contract_penalty"),
        F.min("Fecha").alias("penalty_first"),
        F.max("Fecha").alias("penalty_last"),
    )
    return per_contract.join(closed, "ID_Contrato", "left_semi")


def penalty_span(t: Extracts, penalties: DataFrame | None = None) -> DataFrame:
    """One row: first and last penalty day of the closed contracts (``penalties``, if at hand)."""
    return (penalties_by_contract(t) if penalties is None else penalties).agg(
        F.min("penalty_first").alias("first"), F.max("penalty_last").alias("last")
    )


def staff_days(t: Extracts) -> DataFrame:
    """(ID_Proyecto, ID_Empleado, first, last): the assignment days of known employees.

    Extracted assignments have the employee's rate and so a known employee; the source's own are
    reduced to one row per project and employee before they meet the employees.
    """
    rows = t["asignaciones"]
    pairs = rows.groupBy("ID_Proyecto", "ID_Empleado").agg(
        F.min("FechaAsignacion").alias("first"), F.max("FechaAsignacion").alias("last")
    )
    if "CostoPorHora" in rows.columns:
        return pairs
    return pairs.join(employee_keys(t), "ID_Empleado", "left_semi")


def employee_keys(t: Extracts) -> DataFrame:
    """The known employees. Distinct, since that lets the optimizer leave out what a source joins to
    its employees for other columns, and then see how small they are."""
    return t["empleados"].select("ID_Empleado").distinct()


def staffed(t: Extracts) -> DataFrame:
    """Assignments of known employees; extracted ones have the employee's rate and so are known."""
    rows = t["asignaciones"]
    if "CostoPorHora" in rows.columns:
        return rows
    return rows.join(employee_keys(t), "ID_Empleado", "left_semi")


def widened(spans: DataFrame) -> DataFrame:
    """One row (first, last) over several spans, widened to the fixed calendar limits."""
    low, high = (F.lit(d).cast("date") for d in (C.CALENDAR_START, C.CALENDAR_END))
    return spans.agg(F.min("first").alias("first"), F.max("last").alias("last")).select(
        F.least("first", low).alias("first"), F.greatest("last", high).alias("last")
    )


def calendar_span(t: Extracts) -> DataFrame:
    """One row (first, last): the observed days, widened to the fixed calendar limits.

    Children are reduced to one row per project before the scope join, all by one aggregate: map tasks
    reduce their own child, and a later task holds a single table of projects. So it makes no
    difference in cost whether ``t`` holds extracted children or the source's own.
    """
    in_scope = t["proyectos"].select("ID_Proyecto")
    rows = {"hitos": t["hitos"], "gastos": t["gastos"], "asignaciones": staffed(t)}
    days = [days_by(df, "ID_Proyecto", CALENDAR_COLUMNS[name]) for name, df in rows.items()]
    children = (
        reduce(DataFrame.unionByName, days)
        .groupBy("ID_Proyecto")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return widened(
        children.join(in_scope, "ID_Proyecto", "left_semi")
        .select("first", "last")
        .unionByName(date_span(t["proyectos"], CALENDAR_COLUMNS["proyectos"]))
        .unionByName(penalty_span(t))
    )


def dim_tiempo(span: DataFrame) -> DataFrame:
    """Dense calendar over a span (first, last).

    The key is a day's distance from the first day, so no window is needed. The date type spans
    years 1 to 9999, which bounds the calendar at 3.7 million rows.
    """
    day = F.col("Fecha")
    return span.select(
        "first", F.explode(F.sequence("first", "last")).alias("Fecha")
    ).select(
        (C.days_between(day, F.col("first")) + 1).alias("ID_Tiempo"),
        day,
        C.weekday_key(day).alias("ID_DiaSemana"),
        F.month(day).alias("ID_Mes"),
        C.year_key(day).alias("ID_Anio"),
    )


def subdim_dia_semana(calendar: DataFrame) -> DataFrame:
    key = F.col("ID_DiaSemana")
    return calendar.select(key.alias("ID_Dia_Semana"), key.alias("NumeroDia")).distinct()


def subdim_mes(calendar: DataFrame) -> DataFrame:
    key = F.col("ID_Mes")
    return calendar.select(key, key.alias("NumeroMes")).distinct()


def subdim_anio(calendar: DataFrame) -> DataFrame:
    """Year keys by the calendar's own rule, so that the two can be joined."""
    return calendar.select("ID_Anio", F.year("Fecha").alias("NumeroAnio")).distinct()


def calendar_key(day: Column, calendar: DataFrame) -> Column:
    """Key of ``day`` in a dense calendar, 0 when it is null or outside.

    The calendar's ends come in as one scalar subquery; a lookup join would send every row to the
    partition of its day unless the calendar were broadcast.
    """
    ends = calendar.agg(
        F.struct(F.min("Fecha").alias("first"), F.max("Fecha").alias("last")).alias("ends")
    ).scalar()
    first, last = ends.getField("first"), ends.getField("last")
    return F.when(day.between(first, last), C.days_between(day, first) + 1).otherwise(F.lit(0))


def dim_hitos(
    t: Extracts, calendar: DataFrame | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Milestones with date keys counted from the fixed calendar start.

    With ``calendar`` the keys are that calendar's own instead, which differs when it starts
    before the fixed day. ``extra``, here and below: columns of the extract to pass on.
    """

    def key_of(name: str) -> Column:
        day = F.col(name)
        if calendar is None:
            return C.fixed_base_key(day)
        return F.when(day.isNotNull(), calendar_key(day, calendar))

    key = F.col("ID_Hito")
    late = C.days_between(F.col("FechaFinReal"), F.col("FechaFinPlanificada"))
    return t["hitos"].select(
        key,
        key.alias("CodigoHito"),
        F.col("ID_Proyecto").alias("ID_proyectos"),
        key_of("FechaInicio").alias("ID_FechaInicio"),
        key_of("FechaFinReal").alias("ID_FechaFinalizacion"),
        F.coalesce(late, F.lit(0)).alias("Retraso_days"),
        *extra,
    )


def dim_tareas(t: Extracts, extra: Sequence[str] = ()) -> DataFrame:
    key = F.col("ID_Tarea")
    real = C.number_or_zero(F.col("DuracionReal"), "int")
    plan = C.number_or_zero(F.col("DuracionPlanificada"), "int")
    return t["tareas"].select(
        key,
        key.alias("CodigoTarea"),
        "ID_Hito",
        real.alias("DuracionDias"),
        (real - plan).alias("RetrasoDias"),
        *extra,
    )


def dim_pruebas(
    t: Extracts, check_milestones: bool = True, extra: Sequence[str] = ()
) -> DataFrame:
    """Tests of known milestones; with no milestones at all, every test.

    ``check_milestones=False`` spares the join where the tests were extracted through their
    milestones and so cannot miss one.
    """
    key = F.col("ID_Prueba")
    tests = t["pruebas"].select(
        key,
        key.alias("CodigoPrueba"),
        "ID_Hito",
        C.strip(F.col("TipoPrueba")).alias("TipoPrueba"),
        C.number_or_zero(F.col("Exitosa"), "int").alias("PruebaExitosa"),
        *extra,
    )
    return semi_if_any(tests, t["hitos"], "ID_Hito") if check_milestones else tests


def marked_tests(t: Extracts, name: str) -> DataFrame:
    """The tests with ``name``: whether ``dim_pruebas`` keeps them."""
    return marked_if_any(t["pruebas"].select("ID_Prueba", "ID_Hito"), t["hitos"], "ID_Hito", name)


def finance_rows(
    t: Extracts, null_text: str = C.UNSPECIFIED, owner: str | None = None
) -> DataFrame:
    """Expenses and penalties in one relation, with the columns that order them.

    ``owner``: a column of the extracted expenses with their client, to pass on.
    """
    spent, fined = ([], []) if owner is None else ([owner], [F.col("ID_Cliente").alias(owner)])
    expenses = t["gastos"].select(
        F.lit(0).alias("origin"),
        F.col("ID_Proyecto").alias("owner"),
        "Fecha",
        F.col("ID_Gasto").alias("entry"),
        C.strip(F.col("TipoGasto")).alias("TipoGasto"),
        C.text_or(F.col("Categoria"), null_text).alias("Categoria"),
        F.coalesce("Monto", F.lit(0).cast("decimal(15,2)")).alias("Monto"),
        *spent,
    )
    penalties = t["penalizaciones"].select(
        F.lit(1).alias("origin"),
        F.col("ID_Contrato").alias("owner"),
        "Fecha",
        F.col("ID_Penalizacion").alias("entry"),
        F.lit(C.PENALTY_TYPE).alias("TipoGasto"),
        F.lit(C.OPEX).alias("Categoria"),
        F.coalesce("Monto", F.lit(0).cast("decimal(15,2)")).alias("Monto"),
        *fined,
    )
    return expenses.unionByName(penalties)


def numbered_finances(
    t: Extracts, null_text: str = C.UNSPECIFIED, columns: Sequence[str] | None = None
) -> DataFrame:
    """``dim_finanzas`` with the origin and source key of every row still attached, or ``columns``."""
    order = ["origin", "owner", "Fecha", "entry"]
    return dense_id(finance_rows(t, null_text), order, "ID_Finanza", columns)


def dim_finanzas(t: Extracts, null_text: str = C.UNSPECIFIED) -> DataFrame:
    return numbered_finances(t, null_text, FINANCE_COLUMNS)


def risk_types(t: Extracts) -> DataFrame:
    """(ID_TipoRiesgo, TipoRiesgo): raw type names in order of first appearance."""
    return first_seen_id(
        t["riesgos"], "TipoRiesgo", EXTRACTION_ORDER["riesgos"], "ID_TipoRiesgo"
    )


def severities(t: Extracts) -> DataFrame:
    """(ID_Severidad, Severidad): raw levels in order of first appearance."""
    return first_seen_id(t["riesgos"], "Severidad", EXTRACTION_ORDER["riesgos"], "ID_Severidad")


def dim_tipo_riesgo(types: DataFrame) -> DataFrame:
    return types.select("ID_TipoRiesgo", C.strip(F.col("TipoRiesgo")).alias("NombreTipo"))


def dim_severidad(levels: DataFrame) -> DataFrame:
    return levels.select("ID_Severidad", C.strip(F.col("Severidad")).alias("Nivel"))


def dim_riesgos(
    t: Extracts, types: DataFrame, levels: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """Risks with their type and severity keys; 0 where the source names none."""
    return (
        t["riesgos"]
        .join(types, "TipoRiesgo", "left")
        .join(levels, "Severidad", "left")
        .select(
            "ID_Riesgo",
            F.coalesce("ID_TipoRiesgo", F.lit(0)).alias("ID_TipoRiesgo"),
            F.coalesce("ID_Severidad", F.lit(0)).alias("ID_Severidad"),
            *extra,
        )
    )
