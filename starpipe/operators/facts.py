"""The two fact tables.

Every child relation is reduced to one row per project (or contract) with partial aggregates
before it meets the projects, so a project that owns a third of a table shrinks inside the map
tasks, and all joins are between frames of one row per key. The builders give the same result on
extracted children and on the source's own (``unscoped_children``), because the projects they are
joined to carry the scope.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.functions import columns as C
from starpipe.functions.keys import dense_id
from starpipe.functions.lookups import lookup, marked_if_any
from starpipe.operators.dims import (
    calendar_key,
    known_projects,
    penalties_by_contract,
    penalty_span,
    staff_days,
    widened,
)
from starpipe.operators.extract import EXTRACTION_ORDER

Extracts = Mapping[str, DataFrame]

Money = "decimal(25,2)"
_KNOWN = "__known"


def _first(key: str, day: str) -> Column:
    """The key of the earliest row. A plain minimum, which repeated rows don't change: the optimizer
    then leaves out what a source joins to the rows for other columns."""
    return F.min(F.struct(day, key))[key]


def costs_by_project(expenses: DataFrame) -> DataFrame:
    # Read off the texts first, so that the rows to be reduced don't carry them.
    category = F.col("Categoria")
    rows = expenses.select(
        "ID_Proyecto",
        "ID_Gasto",
        "Fecha",
        "Monto",
        C.is_penalty(F.col("TipoGasto")).alias("penalty"),
        C.equals_upper(category, C.CAPEX).alias("capital"),
        C.equals_upper(category, C.OPEX).alias("operating"),
    )
    amount = F.col("Monto")
    return rows.groupBy("ID_Proyecto").agg(
        F.sum(amount).alias("cost"),
        F.sum(F.when(F.col("penalty"), amount)).alias("expense_penalty"),
        F.sum(F.when(F.col("capital"), amount)).alias("capex"),
        F.sum(F.when(F.col("operating"), amount)).alias("opex"),
        _first("ID_Gasto", "Fecha").alias("first_expense"),
        F.min("Fecha").alias("spent_first"),
        F.max("Fecha").alias("spent_last"),
    )


def first_risks(risks: DataFrame) -> DataFrame:
    return risks.groupBy("ID_Proyecto").agg(_first("ID_Riesgo", "FechaRegistro").alias("first_risk"))


def staff_by_project(t: Extracts) -> DataFrame:
    return staff_days(t).groupBy("ID_Proyecto").agg(
        F.count("ID_Empleado").alias("staff"),
        F.min("first").alias("assigned_first"),
        F.max("last").alias("assigned_last"),
    )


def _milestone_measures() -> list[Column]:
    start, planned, real = (
        F.col(c) for c in ("FechaInicio", "FechaFinPlanificada", "FechaFinReal")
    )
    return [
        F.count("*").alias("milestones"),
        F.sum(C.flag(real > planned)).alias("late_milestones"),
        F.max(planned).alias("last_planned"),
        F.bool_or(real.isNotNull()).alias("any_real"),
        F.min(F.least(start, planned, real)).alias("milestone_first"),
        F.max(F.greatest(start, planned, real)).alias("milestone_last"),
    ]


# A task with either duration missing is not late, so the raw columns are compared.
def _late_task() -> Column:
    return C.flag(F.col("DuracionReal") > F.col("DuracionPlanificada"))


def milestones_by_project(t: Extracts) -> DataFrame:
    return t["hitos"].groupBy("ID_Proyecto").agg(*_milestone_measures())


def tasks_by_project(t: Extracts) -> DataFrame:
    """Task counts; tasks that do not carry their project are counted per milestone first."""
    tasks = t["tareas"]
    key = "ID_Proyecto" if "ID_Proyecto" in tasks.columns else "ID_Hito"
    counted = tasks.groupBy(key).agg(
        F.count("*").alias("tasks"), F.sum(_late_task()).alias("late_tasks")
    )
    if key == "ID_Proyecto":
        return counted
    owners = t["hitos"].select("ID_Hito", "ID_Proyecto")
    return (
        counted.join(owners, "ID_Hito")
        .groupBy("ID_Proyecto")
        .agg(F.sum("tasks").alias("tasks"), F.sum("late_tasks").alias("late_tasks"))
    )


def defects_by_project(t: Extracts) -> DataFrame:
    """Defect counts; defects that do not carry their project climb by task and milestone."""
    if "ID_Proyecto" in t["errores"].columns:
        return t["errores"].groupBy("ID_Proyecto").agg(F.count("*").alias("defects"))
    total = F.sum("defects").alias("defects")
    return (
        t["errores"]
        .groupBy("ID_Tarea")
        .agg(F.count("*").alias("defects"))
        .join(t["tareas"].select("ID_Tarea", "ID_Hito"), "ID_Tarea")
        .groupBy("ID_Hito")
        .agg(total)
        .join(t["hitos"].select("ID_Hito", "ID_Proyecto"), "ID_Hito")
        .groupBy("ID_Proyecto")
        .agg(total)
    )


def schedule_by_project(t: Extracts) -> DataFrame:
    """Milestone, task and defect measures together.

    Where children do not carry their project, this climbs defect -> task -> milestone -> project
    once, with one scan of each relation and a reduction before every step.
    """
    if "ID_Proyecto" in t["tareas"].columns:
        return (
            milestones_by_project(t)
            .join(tasks_by_project(t), "ID_Proyecto", "left")
            .join(defects_by_project(t), "ID_Proyecto", "left")
        )
    defects = t["errores"].groupBy("ID_Tarea").agg(F.count("*").alias("defects"))
    per_milestone = (
        t["tareas"]
        .select("ID_Tarea", "ID_Hito", _late_task().alias("late"))
        .join(defects, "ID_Tarea", "left")
        .groupBy("ID_Hito")
        .agg(
            F.count("*").alias("tasks"),
            F.sum("late").alias("late_tasks"),
            F.sum("defects").alias("defects"),
        )
    )
    return (
        t["hitos"]
        .join(per_milestone, "ID_Hito", "left")
        .groupBy("ID_Proyecto")
        .agg(
            *_milestone_measures(),
            F.sum("tasks").alias("tasks"),
            F.sum("late_tasks").alias("late_tasks"),
            F.sum("defects").alias("defects"),
        )
    )


_PARTS: dict[str, Callable[[Extracts], DataFrame]] = {
    "costs": lambda t: costs_by_project(t["gastos"]),
    "risks": lambda t: first_risks(t["riesgos"]),
    "staff": staff_by_project,
    "milestones": milestones_by_project,
    "tasks": tasks_by_project,
    "defects": defects_by_project,
    "schedule": schedule_by_project,
}
ALL_PARTS = ("penalties", "costs", "risks", "staff", "schedule")


#: What the rollup reads of a project itself.
PROJECT_COLUMNS = (
    "ID_Proyecto", "ID_Contrato", "ID_Cliente", "FechaInicio", "FechaFin", "ValorTotalContrato",
)


def marked_projects(t: Extracts) -> DataFrame:
    """The projects' PROJECT_COLUMNS, and ``_KNOWN``: whether they are known."""
    return marked_if_any(t["proyectos"].select(*PROJECT_COLUMNS), t["clientes"], "ID_Cliente", _KNOWN)


def known(marked: DataFrame, are: bool = True) -> DataFrame:
    """The ``marked_projects`` that are known, or those that aren't."""
    return marked.where(F.col(_KNOWN) == are).drop(_KNOWN)


def numbered_projects(t: Extracts) -> DataFrame:
    """The projects' PROJECT_COLUMNS with the ID_Hecho of known ones, in project order.

    Numbering them before the rollup moves a few columns of a project; afterwards it would move all
    measures, once to the clients and once into order.
    """
    order = [~F.col(_KNOWN), F.col("ID_Proyecto")]
    numbered = dense_id(marked_projects(t), order, "ID_Hecho")
    key = F.when(F.col(_KNOWN), F.col("ID_Hecho"))
    return numbered.select(*PROJECT_COLUMNS, key.alias("ID_Hecho"))


def project_rollup(
    t: Extracts,
    parts: Iterable[str] = ALL_PARTS,
    penalties: DataFrame | None = None,
    projects: DataFrame | None = None,
) -> DataFrame:
    """One row per project in scope: its own columns and the reduced measures of its children.

    ``penalties``: ``penalties_by_contract(t)``, where it is written already.
    ``projects``: the extracted projects' PROJECT_COLUMNS with others that the rollup is to have.
    """
    rollup = t["proyectos"].select(*PROJECT_COLUMNS) if projects is None else projects
    if "penalties" in parts:
        # First, because the extracted projects are already spread by contract.
        penalties = penalties_by_contract(t) if penalties is None else penalties
        rollup = rollup.join(penalties.select("ID_Contrato", "contract_penalty"), "ID_Contrato", "left")
    for name in parts:
        if name != "penalties":
            rollup = rollup.join(_PARTS[name](t), "ID_Proyecto", "left")
    return rollup


def rollup_span(
    rollup: DataFrame, t: Extracts, penalties: DataFrame | None = None
) -> DataFrame:
    """One row (first, last): the calendar's reach, read off a complete rollup.

    ``penalties``: ``penalties_by_contract(t)``, where it is written already.
    """
    spans = ("milestone", "assigned", "spent")
    starts = [F.col(c) for c in ("FechaInicio", "FechaFin", *(f"{s}_first" for s in spans))]
    ends = [F.col(c) for c in ("FechaInicio", "FechaFin", *(f"{s}_last" for s in spans))]
    observed = rollup.agg(
        F.min(F.least(*starts)).alias("first"), F.max(F.greatest(*ends)).alias("last")
    )
    return widened(observed.unionByName(penalty_span(t, penalties)))


def _money(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast(Money))


def _duration() -> Column:
    return F.coalesce(C.days_between(F.col("FechaFin"), F.col("FechaInicio")), F.lit(0))


def _dated() -> Column:
    return F.col("FechaInicio").isNotNull() & F.col("FechaFin").isNotNull()


def _delay() -> Column:
    planned = C.days_between(F.col("last_planned"), F.col("FechaInicio"))
    known = _dated() & F.col("any_real") & F.col("last_planned").isNotNull()
    return F.when(known, F.greatest(_duration() - planned, F.lit(0))).otherwise(0)


def _budget() -> Column:
    return F.coalesce("ValorTotalContrato", F.lit(0).cast("decimal(15,2)"))


def _penalties() -> Column:
    return _money("expense_penalty") + _money("contract_penalty")


def _productivity() -> Column:
    quotient = C.ratio_or_zero(_duration(), F.col("staff"), "decimal(10,2)")
    return F.when(_duration() > 0, quotient).otherwise(F.lit(0).cast("decimal(10,2)"))


def _percentage(part: str, whole: str) -> Column:
    return C.ratio_or_zero(F.col(part), F.col(whole), "decimal(5,2)", 100)


# Measure -> (rollup parts it reads, expression). Keys into the calendar and the risk default
# need more than the row and are added in project_metrics().
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[], Column] | None]] = {
    "ID_TiempoInicio": ((), None),
    "ID_TiempoFinalizacion": ((), None),
    "ID_Riesgo": (("risks",), None),
    "ID_Finanza": (("costs",), lambda: F.coalesce("first_expense", F.lit(0))),
    "DuracionRealDias": ((), _duration),
    "RetrasoDias": (("milestones",), _delay),
    "PresupuestoCliente": ((), _budget),
    "CosteReal": (("costs",), lambda: _money("cost")),
    "DesviacionPresupuestal": (("costs",), lambda: _budget() - _money("cost")),
    "PenalizacionesMonto": (("penalties", "costs"), _penalties),
    "ProporcionCAPEX_OPEX": (
        ("costs",),
        lambda: C.capex_opex_ratio(_money("capex"), _money("opex")),
    ),
    "NumeroDefectosEncontrados": (("defects",), lambda: F.coalesce("defects", F.lit(0))),
    "ProductividadPromedio": (("staff",), _productivity),
    "PorcentajeTareasRetrasadas": (("tasks",), lambda: _percentage("late_tasks", "tasks")),
    "PorcentajeHitosRetrasados": (
        ("milestones",),
        lambda: _percentage("late_milestones", "milestones"),
    ),
}


def project_metrics(
    t: Extracts,
    rollup: DataFrame,
    calendar: DataFrame | None = None,
    measures: Iterable[str] = tuple(MEASURES),
    any_risk: Column | None = None,
) -> DataFrame:
    """ID_Proyecto and the named measures of every known project, without a surrogate key, but with
    ID_Hecho and ID_Cliente from a rollup of projects that are numbered.

    ``any_risk``: whether there is a risk at all, where the rollup doesn't show it.
    """

    def key_of(name: str) -> Column:
        return F.when(_dated(), calendar_key(F.col(name), calendar)).otherwise(0)

    def risk() -> Column:
        # A project without risks points at risk 1 as long as any project in scope has one.
        found = rollup.where(F.col("first_risk").isNotNull()).select("ID_Proyecto").exists()
        default = F.when(found if any_risk is None else any_risk, 1).otherwise(0)
        return F.coalesce("first_risk", default)

    wider = {
        "ID_TiempoInicio": lambda: key_of("FechaInicio"),
        "ID_TiempoFinalizacion": lambda: key_of("FechaFin"),
        "ID_Riesgo": risk,
    }
    numbered = "ID_Hecho" in rollup.columns
    rows = rollup.where("ID_Hecho IS NOT NULL") if numbered else known_projects(rollup, t)
    return rows.select(
        *(("ID_Hecho", "ID_Cliente") if numbered else ()),
        "ID_Proyecto",
        *[(wider.get(name) or MEASURES[name][1])().alias(name) for name in measures],
    )


def measured_projects(
    t: Extracts, measures: Iterable[str], calendar: DataFrame | None = None
) -> DataFrame:
    """Some measures only: reads just the child relations these need."""
    measures = tuple(measures)
    parts = dict.fromkeys(part for name in measures for part in MEASURES[name][0])
    return project_metrics(t, project_rollup(t, parts), calendar, measures)


def hechos_proyectos(
    t: Extracts, rollup: DataFrame, calendar: DataFrame, finances: DataFrame | None = None
) -> DataFrame:
    """One row per known project, keyed in project order; ``rollup`` should be written already, best of
    ``numbered_projects``, so that only the columns of a project itself are put in order.

    ``ID_Finanza`` is the project's first expense. With ``finances`` (``numbered_finances``) it
    becomes that expense's key in ``dim_finanzas`` instead, so that the reference holds.
    """
    metrics = project_metrics(t, rollup, calendar).drop("ID_Cliente")
    if finances is None and "ID_Hecho" in metrics.columns:
        return metrics
    metrics = metrics.drop("ID_Hecho")
    if finances is not None:
        expenses = finances.where(F.col("origin") == 0).select(
            F.col("entry").alias("__entry"), F.col("ID_Finanza").alias("__key")
        )
        columns = [
            F.coalesce("__key", F.lit(0)).alias(c) if c == "ID_Finanza" else F.col(c)
            for c in metrics.columns
        ]
        metrics = metrics.join(
            expenses, F.col("ID_Finanza") == F.col("__entry"), "left"
        ).select(*columns)
    return dense_id(
        metrics, ["ID_Proyecto"], "ID_Hecho", counted=rollup.select("ID_Proyecto")
    )


def assignment_values(
    t: Extracts, calendar: DataFrame, extra: Iterable[str] = ()
) -> DataFrame:
    """Measures of every assignment, without a surrogate key; ``extra``: columns to pass on."""
    rows = t["asignaciones"]
    if "CostoPorHora" not in rows.columns:
        rows = lookup(
            rows, t["empleados"], "ID_Empleado", "ID_Empleado", "CostoPorHora", "CostoPorHora"
        )
    hours = C.number_or_zero(F.col("HorasReales"), "decimal(10,2)")
    rate = C.number_or_zero(F.col("CostoPorHora"), "decimal(12,2)")
    return rows.select(
        "ID_Asignacion",
        "FechaAsignacion",
        "ID_Empleado",
        "ID_Proyecto",
        calendar_key(F.col("FechaAsignacion"), calendar).alias("ID_FechaAsignacion"),
        C.number_or_zero(F.col("HorasPlanificadas"), "decimal(10,2)").alias("HorasPlanificadas"),
        hours.alias("HorasReales"),
        (hours * rate).cast("decimal(15,2)").alias("ValorHoras"),
        *extra,
    )


def hechos_asignaciones(t: Extracts, calendar: DataFrame) -> DataFrame:
    """One row per assignment, keyed in extraction order."""
    values = assignment_values(t, calendar)
    kept = [c for c in values.columns if c not in ("ID_Asignacion", "FechaAsignacion")]
    return dense_id(values, EXTRACTION_ORDER["asignaciones"], "ID_HechoAsignacion", kept)
