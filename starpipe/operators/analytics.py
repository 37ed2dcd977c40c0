"""Analyses over the star: profitability, budget, schedule, resources and quality.

Facts are reduced by their key before a dimension is joined, so the joins see one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpipe.functions import columns as C


def profitability_by_client(facts: DataFrame, projects: DataFrame) -> DataFrame:
    """Budget, cost, penalties and margin of each client's projects."""
    margin = F.col("presupuesto") - F.col("coste") - F.col("penalizaciones")
    return (
        facts.join(projects.select("ID_Proyecto", "ID_Cliente"), "ID_Proyecto")
        .groupBy("ID_Cliente")
        .agg(
            F.count("*").alias("proyectos"),
            F.sum("PresupuestoCliente").alias("presupuesto"),
            F.sum("CosteReal").alias("coste"),
            F.sum("PenalizacionesMonto").alias("penalizaciones"),
        )
        .withColumn("margen", margin)
    )


def profitability_by_project(facts: DataFrame) -> DataFrame:
    """Budget, cost, penalties and margin of each project."""
    margin = F.col("PresupuestoCliente") - F.col("CosteReal") - F.col("PenalizacionesMonto")
    return facts.select(
        "ID_Proyecto",
        F.col("PresupuestoCliente").alias("presupuesto"),
        F.col("CosteReal").alias("coste"),
        F.col("PenalizacionesMonto").alias("penalizaciones"),
        margin.alias("margen"),
    )


def budget_control(facts: DataFrame) -> DataFrame:
    """Deviation of each project, absolute and relative, with an overrun flag."""
    deviation = F.col("DesviacionPresupuestal")
    return facts.select(
        "ID_Proyecto",
        "PresupuestoCliente",
        "CosteReal",
        deviation,
        C.ratio_or_zero(deviation, F.col("PresupuestoCliente"), "decimal(18,4)").alias(
            "desviacion_relativa"
        ),
        C.flag(deviation < 0).alias("sobrecosto"),
    )


def penalty_totals(finances: DataFrame) -> DataFrame:
    """Number and sum of the penalty entries of ``dim_finanzas``."""
    return (
        finances.where(F.col("TipoGasto") == C.PENALTY_TYPE)
        .groupBy("TipoGasto", "Categoria")
        .agg(F.count("*").alias("cargos"), F.sum("Monto").alias("monto"))
    )


def penalties_by_client(facts: DataFrame, projects: DataFrame) -> DataFrame:
    return (
        facts.join(projects.select("ID_Proyecto", "ID_Cliente"), "ID_Proyecto")
        .groupBy("ID_Cliente")
        .agg(
            F.count_if(F.col("PenalizacionesMonto") > 0).alias("proyectos_penalizados"),
            F.sum("PenalizacionesMonto").alias("penalizaciones"),
        )
    )


def schedule_compliance(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """By month of completion: share of projects without delay and the mean delay."""
    per_day = facts.groupBy(F.col("ID_TiempoFinalizacion").alias("ID_Tiempo")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("RetrasoDias") == 0).alias("on_time"),
        F.sum("RetrasoDias").alias("delay"),
    )
    return (
        per_day.join(calendar, "ID_Tiempo")
        .groupBy("ID_Anio", "ID_Mes")
        .agg(
            F.sum("n").alias("proyectos"),
            F.sum("on_time").alias("a_tiempo"),
            F.sum("delay").alias("delay"),
        )
        .select(
            "ID_Anio",
            "ID_Mes",
            "proyectos",
            C.ratio_or_zero(F.col("a_tiempo"), F.col("proyectos"), "decimal(5,2)", 100).alias(
                "porcentaje_a_tiempo"
            ),
            C.ratio_or_zero(F.col("delay"), F.col("proyectos"), "decimal(18,2)").alias(
                "retraso_medio"
            ),
        )
    )


def bottlenecks(tasks: DataFrame) -> DataFrame:
    """Milestones by the days their late tasks lost, largest first."""
    return (
        tasks.where(F.col("RetrasoDias") > 0)
        .groupBy("ID_Hito")
        .agg(F.count("*").alias("tareas_retrasadas"), F.sum("RetrasoDias").alias("dias_perdidos"))
        .orderBy(F.desc("dias_perdidos"), "ID_Hito")
    )


def productivity_trend(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """By month of start: how many projects began and their mean productivity."""
    per_day = facts.groupBy(F.col("ID_TiempoInicio").alias("ID_Tiempo")).agg(
        F.count("*").alias("n"), F.sum("ProductividadPromedio").alias("p")
    )
    return (
        per_day.join(calendar, "ID_Tiempo")
        .groupBy("ID_Anio", "ID_Mes")
        .agg(F.sum("n").alias("proyectos"), F.sum("p").alias("p"))
        .select(
            "ID_Anio",
            "ID_Mes",
            "proyectos",
            C.ratio_or_zero(F.col("p"), F.col("proyectos"), "decimal(18,2)").alias(
                "productividad_media"
            ),
        )
    )


def utilisation(assignments: DataFrame) -> DataFrame:
    """Planned and real hours of each employee and their quotient."""
    return (
        assignments.groupBy("ID_Empleado")
        .agg(
            F.count("*").alias("asignaciones"),
            F.sum("HorasPlanificadas").alias("horas_planificadas"),
            F.sum("HorasReales").alias("horas_reales"),
        )
        .withColumn(
            "utilizacion",
            C.ratio_or_zero(F.col("horas_reales"), F.col("horas_planificadas"), "decimal(18,4)"),
        )
    )


def cost_per_hour(assignments: DataFrame, employees: DataFrame) -> DataFrame:
    """Effective cost of an hour by role and seniority."""
    per_employee = assignments.groupBy("ID_Empleado").agg(
        F.sum("ValorHoras").alias("v"), F.sum("HorasReales").alias("h")
    )
    return (
        per_employee.join(employees, "ID_Empleado")
        .groupBy("Rol", "Seniority")
        .agg(
            F.count("*").alias("empleados"),
            F.sum("v").alias("valor_horas"),
            F.sum("h").alias("horas_reales"),
        )
        .withColumn(
            "coste_por_hora",
            C.ratio_or_zero(F.col("valor_horas"), F.col("horas_reales"), "decimal(18,4)"),
        )
    )


def defect_rate(facts: DataFrame, projects: DataFrame) -> DataFrame:
    """Defects per project of each client."""
    return (
        facts.join(projects.select("ID_Proyecto", "ID_Cliente"), "ID_Proyecto")
        .groupBy("ID_Cliente")
        .agg(
            F.count("*").alias("proyectos"),
            F.sum("NumeroDefectosEncontrados").alias("defectos"),
        )
        .withColumn(
            "defectos_por_proyecto",
            C.ratio_or_zero(F.col("defectos"), F.col("proyectos"), "decimal(18,4)"),
        )
    )


def effectiveness_by_type(tests: DataFrame) -> DataFrame:
    """Share of successful tests by type."""
    return (
        tests.groupBy("TipoPrueba")
        .agg(F.count("*").alias("pruebas"), F.sum("PruebaExitosa").alias("exitosas"))
        .withColumn(
            "efectividad",
            C.ratio_or_zero(F.col("exitosas"), F.col("pruebas"), "decimal(18,4)"),
        )
    )
