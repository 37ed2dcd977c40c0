"""Extraction of the twelve relations under one business scope.

In scope is every project that is closed or cancelled itself or whose contract is. Parent keys are
unique, so membership is a left-semi join and can never multiply rows. No join carries a broadcast
hint: adaptive execution broadcasts a side once its measured size allows it and splits the
partitions of a hot project, contract or employee otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.functions.columns import days_between, is_closed
from starpipe.sources.tables import Tables

Source = Mapping[str, DataFrame]

# Sort keys of each extract, the primary key last so that every order is total.
EXTRACTION_ORDER = {
    "clientes": ("ID_Cliente",),
    "empleados": ("ID_Empleado",),
    "contratos": ("ID_Contrato",),
    "proyectos": ("ID_Proyecto",),
    "hitos": ("ID_Proyecto", "ID_Hito"),
    "tareas": ("ID_Proyecto", "ID_Hito", "ID_Tarea"),
    "asignaciones": ("ID_Proyecto", "FechaAsignacion", "ID_Asignacion"),
    "pruebas": ("ID_Proyecto", "ID_Hito", "Fecha", "ID_Prueba"),
    "errores": ("ID_Proyecto", "Fecha", "ID_Error"),
    "riesgos": ("ID_Proyecto", "FechaRegistro", "ID_Riesgo"),
    "gastos": ("ID_Proyecto", "Fecha", "ID_Gasto"),
    "penalizaciones": ("ID_Contrato", "Fecha", "ID_Penalizacion"),
}


def in_extraction_order(name: str, extract: DataFrame) -> DataFrame:
    """Total sort for output; nothing inside the pipeline depends on row order."""
    return extract.orderBy(*EXTRACTION_ORDER[name])


def stamped(extract: DataFrame) -> DataFrame:
    """Add the extraction time."""
    return extract.withColumn("fecha_extraccion", F.current_timestamp())


def changed_since(df: DataFrame, column: str, last: str) -> DataFrame:
    """Rows changed after the watermark; the comparison reaches the Parquet or JDBC scan."""
    return df.where(F.col(column) > F.to_timestamp(F.lit(last)).cast(df.schema[column].dataType))


def extract_contratos(source: Source, collation: str | None = None) -> DataFrame:
    return source["contratos"].where(is_closed(F.col("Estado"), collation))


def extract_clientes(source: Source, collation: str | None = None) -> DataFrame:
    # Distinct first: a client with very many contracts shrinks to one row per map task.
    buyers = extract_contratos(source, collation).select("ID_Cliente").distinct()
    return source["clientes"].join(buyers, "ID_Cliente", "left_semi")


def extract_proyectos(source: Source, collation: str | None = None) -> DataFrame:
    contracts = source["contratos"].select(
        "ID_Contrato",
        "ID_Cliente",
        "ValorTotalContrato",
        F.col("Estado").alias("EstadoContrato"),
    )
    by_project = is_closed(F.col("EstadoProyecto"), collation)
    by_contract = is_closed(F.col("EstadoContrato"), collation)
    return (
        source["proyectos"]
        .withColumnRenamed("Estado", "EstadoProyecto")
        .join(contracts, "ID_Contrato")
        .where(by_project | by_contract)
        .select(
            "ID_Proyecto",
            "ID_Contrato",
            "NombreProyecto",
            "Version",
            "FechaInicio",
            "FechaFin",
            "EstadoProyecto",
            "ID_Cliente",
            "ValorTotalContrato",
            "EstadoContrato",
            F.when(by_project, "Por proyecto")
            .when(by_contract, "Por contrato")
            .otherwise("No aplica")
            .alias("razon_inclusion"),
        )
    )


def scoped(child: DataFrame, projects: DataFrame, owner: str | None = None) -> DataFrame:
    """Rows of ``child`` that belong to a project in scope; ``owner``: with the project's client under
    that name, for project numbers that occur once."""
    if owner is None:
        return child.join(projects.select("ID_Proyecto"), "ID_Proyecto", "left_semi")
    clients = projects.select("ID_Proyecto", F.col("ID_Cliente").alias(owner))
    return child.join(clients, "ID_Proyecto")


def _named(owner: str | None) -> tuple[str, ...]:
    return () if owner is None else (owner,)


def extract_hitos(
    milestones: DataFrame, projects: DataFrame, as_of: Column, owner: str | None = None
) -> DataFrame:
    late = days_between(F.coalesce("FechaFinReal", as_of), F.col("FechaFinPlanificada"))
    return scoped(milestones, projects, owner).select(
        "ID_Hito",
        "ID_Proyecto",
        "Descripcion",
        "Estado",
        "FechaInicio",
        "FechaFinPlanificada",
        "FechaFinReal",
        late.alias("dias_retraso"),
        *_named(owner),
    )


def milestone_projects(
    milestones: DataFrame, projects: DataFrame, owner: str | None = None
) -> DataFrame:
    """(ID_Hito, ID_Proyecto) of the milestones in scope: the step from a task to its project."""
    found = scoped(milestones.select("ID_Hito", "ID_Proyecto"), projects, owner)
    return found.select("ID_Hito", "ID_Proyecto", *_named(owner))


def extract_tareas(tasks: DataFrame, owners: DataFrame, owner: str | None = None) -> DataFrame:
    """``owners``: (ID_Hito, ID_Proyecto), and ``owner`` if named, of the milestones in scope."""
    deviation = F.coalesce("DuracionReal", F.lit(0)) - F.coalesce("DuracionPlanificada", F.lit(0))
    return tasks.join(owners, "ID_Hito").select(
        "ID_Tarea",
        "ID_Hito",
        "ID_Proyecto",
        "NombreTarea",
        "Descripcion",
        "Estado",
        "DuracionPlanificada",
        "DuracionReal",
        deviation.alias("desviacion_duracion"),
        *_named(owner),
    )


def extract_empleados(source: Source, projects: DataFrame) -> DataFrame:
    staff = scoped(source["asignaciones"].select("ID_Proyecto", "ID_Empleado"), projects)
    return source["empleados"].join(
        staff.select("ID_Empleado").distinct(), "ID_Empleado", "left_semi"
    )


def staff_of(source: Source, assignments: DataFrame) -> DataFrame:
    """``extract_empleados``, from the extracted assignments."""
    staff = assignments.select("ID_Empleado").distinct()
    return source["empleados"].join(staff, "ID_Empleado", "left_semi")


def extract_asignaciones(
    source: Source, projects: DataFrame, owner: str | None = None
) -> DataFrame:
    rates = source["empleados"].select("ID_Empleado", "CostoPorHora")
    rate = F.col("CostoPorHora")
    return (
        scoped(source["asignaciones"], projects, owner)
        .join(rates, "ID_Empleado")
        .select(
            "ID_Asignacion",
            "ID_Proyecto",
            "ID_Empleado",
            "HorasPlanificadas",
            "HorasReales",
            "FechaAsignacion",
            "CostoPorHora",
            (F.col("HorasReales") * rate).cast("decimal(15,2)").alias("costo_real_horas"),
            (F.col("HorasPlanificadas") * rate)
            .cast("decimal(15,2)")
            .alias("costo_planificado_horas"),
            *_named(owner),
        )
    )


def extract_pruebas(tests: DataFrame, owners: DataFrame, owner: str | None = None) -> DataFrame:
    return tests.join(owners, "ID_Hito").select(
        "ID_Prueba", "ID_Hito", "ID_Proyecto", "TipoPrueba", "Fecha", "Exitosa", *_named(owner)
    )


def extract_errores(defects: DataFrame, owners: DataFrame) -> DataFrame:
    """``owners``: (ID_Tarea, ID_Hito, ID_Proyecto) of the tasks in scope."""
    return defects.join(owners, "ID_Tarea").select(
        "ID_Error", "ID_Tarea", "ID_Hito", "ID_Proyecto", "TipoError", "Descripcion", "Fecha"
    )


def extract_penalizaciones(source: Source, collation: str | None = None) -> DataFrame:
    closed = extract_contratos(source, collation).select("ID_Contrato", "ID_Cliente")
    return source["penalizaciones"].join(closed, "ID_Contrato").select(
        "ID_Penalizacion", "ID_Contrato", "ID_Cliente", "Monto", "Motivo", "Fecha"
    )


def extract_all(
    source: Source,
    as_of: Column | None = None,
    collation: str | None = None,
    since: tuple[str, str] | None = None,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    stamp: bool = False,
    scope: DataFrame | None = None,
    owner: str | None = None,
) -> Tables:
    """All twelve extracts, lazily.

    ``as_of`` is the day against which unfinished milestones are late (default: today).
    ``since`` = (column, watermark) restricts the project relation to rows changed after the
    watermark; by default nothing is restricted, as every run is a full extraction.
    ``keep`` (a function of frame and name, e.g. ``materialise``) is applied to every extract when
    it is first used, so that nine children share one written project scope, and tasks, tests and
    defects the written milestones and tasks.
    ``stamp`` adds the extraction time to every extract.
    ``scope``: the extracted projects, where they are at hand. ``owner``: a column for the client, which
    the projects' children but defects then carry from their scope join on; only for a ``scope`` in which
    project numbers occur once.
    """
    today = F.current_date() if as_of is None else as_of
    read = source
    if since:
        read = Tables({name: (lambda n=name: source[n]) for name in source}).but(
            proyectos=lambda: changed_since(source["proyectos"], *since)
        )

    extracts: Tables

    def projects() -> DataFrame:
        return extracts["proyectos"]

    def milestone_owners() -> DataFrame:
        if keep:
            return extracts["hitos"].select("ID_Hito", "ID_Proyecto", *_named(owner))
        return milestone_projects(read["hitos"], projects(), owner)

    def task_owners() -> DataFrame:
        if keep:
            return extracts["tareas"].select("ID_Tarea", "ID_Hito", "ID_Proyecto")
        owners = milestone_owners().select("ID_Hito", "ID_Proyecto")
        return read["tareas"].select("ID_Tarea", "ID_Hito").join(owners, "ID_Hito")

    def staff() -> DataFrame:
        if keep:
            return staff_of(read, extracts["asignaciones"])
        return extract_empleados(read, projects())

    builders = {
        "clientes": lambda: extract_clientes(read, collation),
        "empleados": staff,
        "contratos": lambda: extract_contratos(read, collation),
        "proyectos": lambda: extract_proyectos(read, collation),
        "hitos": lambda: extract_hitos(read["hitos"], projects(), today, owner),
        "tareas": lambda: extract_tareas(read["tareas"], milestone_owners(), owner),
        "asignaciones": lambda: extract_asignaciones(read, projects(), owner),
        "pruebas": lambda: extract_pruebas(read["pruebas"], milestone_owners(), owner),
        "errores": lambda: extract_errores(read["errores"], task_owners()),
        "riesgos": lambda: scoped(read["riesgos"], projects(), owner),
        "gastos": lambda: scoped(read["gastos"], projects(), owner),
        "penalizaciones": lambda: extract_penalizaciones(read, collation),
    }
    if stamp:
        builders = {name: (lambda b=build: stamped(b())) for name, build in builders.items()}
    if keep:
        builders = {
            name: (lambda n=name, b=build: keep(b(), n)) for name, build in builders.items()
        }
    if scope is not None:
        builders["proyectos"] = lambda: scope
    extracts = Tables(builders)
    return extracts


def unscoped_children(source: Source, extracts: Tables) -> Tables:
    """The extracts, with the large child relations replaced by the source's own.

    For consumers that reduce every child to one row per project or contract first and join the
    scope afterwards: the scope join then moves the reduced rows only.
    """
    children = (
        "empleados", "hitos", "tareas", "asignaciones", "errores", "riesgos", "gastos",
        "penalizaciones",
    )
    return extracts.but(**{name: (lambda n=name: source[n]) for name in children})
