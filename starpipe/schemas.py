"""Column contracts of the source relations and of the star, as Spark SQL types."""

from __future__ import annotations

# Table names, column names, types, keys and load order of the data model.
SOURCE = {
    "clientes": {"ID_Cliente": "bigint", "NombreCliente": "string"},
    "empleados": {
        "ID_Empleado": "bigint",
        "NombreCompleto": "string",
        "Rol": "string",
        "Seniority": "string",
        "CostoPorHora": "decimal(12,2)",
    },
    "contratos": {
        "ID_Contrato": "bigint",
        "ID_Cliente": "bigint",
        "ValorTotalContrato": "decimal(15,2)",
        "Estado": "string",
    },
    "proyectos": {
        "ID_Proyecto": "bigint",
        "ID_Contrato": "bigint",
        "NombreProyecto": "string",
        "Version": "string",
        "FechaInicio": "date",
        "FechaFin": "date",
        "Estado": "string",
    },
    "hitos": {
        "ID_Hito": "bigint",
        "ID_Proyecto": "bigint",
        "Descripcion": "string",
        "Estado": "string",
        "FechaInicio": "date",
        "FechaFinPlanificada": "date",
        "FechaFinReal": "date",
    },
    "tareas": {
        "ID_Tarea": "bigint",
        "ID_Hito": "bigint",
        "NombreTarea": "string",
        "Descripcion": "string",
        "Estado": "string",
        "DuracionPlanificada": "int",
        "DuracionReal": "int",
    },
    "asignaciones": {
        "ID_Asignacion": "bigint",
        "ID_Proyecto": "bigint",
        "ID_Empleado": "bigint",
        "HorasPlanificadas": "decimal(10,2)",
        "HorasReales": "decimal(10,2)",
        "FechaAsignacion": "date",
    },
    "pruebas": {
        "ID_Prueba": "bigint",
        "ID_Hito": "bigint",
        "TipoPrueba": "string",
        "Fecha": "date",
        "Exitosa": "int",
    },
    "errores": {
        "ID_Error": "bigint",
        "ID_Tarea": "bigint",
        "TipoError": "string",
        "Descripcion": "string",
        "Fecha": "date",
    },
    "riesgos": {
        "ID_Riesgo": "bigint",
        "ID_Proyecto": "bigint",
        "TipoRiesgo": "string",
        "Severidad": "string",
        "Descripcion": "string",
        "FechaRegistro": "date",
    },
    "gastos": {
        "ID_Gasto": "bigint",
        "ID_Proyecto": "bigint",
        "TipoGasto": "string",
        "Categoria": "string",
        "Monto": "decimal(15,2)",
        "Fecha": "date",
    },
    "penalizaciones": {
        "ID_Penalizacion": "bigint",
        "ID_Contrato": "bigint",
        "Monto": "decimal(15,2)",
        "Motivo": "string",
        "Fecha": "date",
    },
}

STAR = {
    "dim_clientes": {"ID_Cliente": "bigint", "CodigoClienteReal": "bigint"},
    "dim_empleados": {
        "ID_Empleado": "bigint",
        "CodigoEmpleado": "bigint",
        "Rol": "string",
        "Seniority": "string",
    },
    "dim_proyectos": {
        "ID_Proyecto": "bigint",
        "CodigoProyecto": "bigint",
        "Version": "string",
        "Cancelado": "int",
        "ID_Cliente": "bigint",
    },
    "dim_tiempo": {
        "ID_Tiempo": "int",
        "Fecha": "date",
        "ID_DiaSemana": "int",
        "ID_Mes": "int",
        "ID_Anio": "int",
    },
    "dim_hitos": {
        "ID_Hito": "bigint",
        "CodigoHito": "bigint",
        "ID_proyectos": "bigint",
        "ID_FechaInicio": "int",
        "ID_FechaFinalizacion": "int",
        "Retraso_days": "int",
    },
    "dim_tareas": {
        "ID_Tarea": "bigint",
        "CodigoTarea": "bigint",
        "ID_Hito": "bigint",
        "DuracionDias": "int",
        "RetrasoDias": "int",
    },
    "dim_pruebas": {
        "ID_Prueba": "bigint",
        "CodigoPrueba": "bigint",
        "ID_Hito": "bigint",
        "TipoPrueba": "string",
        "PruebaExitosa": "int",
    },
    "dim_finanzas": {
        "ID_Finanza": "bigint",
        "TipoGasto": "string",
        "Categoria": "string",
        "Monto": "decimal(15,2)",
    },
    "dim_tipo_riesgo": {"ID_TipoRiesgo": "bigint", "NombreTipo": "string"},
    "dim_severidad": {"ID_Severidad": "bigint", "Nivel": "string"},
    "dim_riesgos": {"ID_Riesgo": "bigint", "ID_TipoRiesgo": "bigint", "ID_Severidad": "bigint"},
    "hechos_asignaciones": {
        "ID_HechoAsignacion": "bigint",
        "ID_Empleado": "bigint",
        "ID_Proyecto": "bigint",
        "ID_FechaAsignacion": "int",
        "HorasPlanificadas": "decimal(10,2)",
        "HorasReales": "decimal(10,2)",
        "ValorHoras": "decimal(15,2)",
    },
    "hechos_proyectos": {
        "ID_Hecho": "bigint",
        "ID_Proyecto": "bigint",
        "ID_TiempoInicio": "int",
        "ID_TiempoFinalizacion": "int",
        "ID_Riesgo": "bigint",
        "ID_Finanza": "bigint",
        "DuracionRealDias": "int",
        "RetrasoDias": "int",
        "PresupuestoCliente": "decimal(15,2)",
        # Totals and counts of a project keep room for one that owns a third of all rows.
        "CosteReal": "decimal(25,2)",
        "DesviacionPresupuestal": "decimal(26,2)",
        "PenalizacionesMonto": "decimal(26,2)",
        "ProporcionCAPEX_OPEX": "decimal(10,2)",
        "NumeroDefectosEncontrados": "bigint",
        "ProductividadPromedio": "decimal(10,2)",
        "PorcentajeTareasRetrasadas": "decimal(5,2)",
        "PorcentajeHitosRetrasados": "decimal(5,2)",
    },
    "subdim_dia_semana": {"ID_Dia_Semana": "int", "NumeroDia": "int"},
    "subdim_mes": {"ID_Mes": "int", "NumeroMes": "int"},
    "subdim_anio": {"ID_Anio": "int", "NumeroAnio": "int"},
}

# Tables of one tier do not refer to each other, only to earlier tiers.
LOAD_TIERS = (
    ("dim_clientes", "dim_empleados", "dim_tiempo", "dim_tipo_riesgo", "dim_severidad"),
    ("dim_proyectos", "dim_finanzas", "dim_riesgos", "dim_hitos", "dim_tareas", "dim_pruebas"),
    ("hechos_asignaciones", "hechos_proyectos"),
)
LOAD_ORDER = tuple(table for tier in LOAD_TIERS for table in tier)

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = (
    ("dim_proyectos", "ID_Cliente", "dim_clientes", "ID_Cliente"),
    ("dim_riesgos", "ID_TipoRiesgo", "dim_tipo_riesgo", "ID_TipoRiesgo"),
    ("dim_riesgos", "ID_Severidad", "dim_severidad", "ID_Severidad"),
    ("dim_hitos", "ID_proyectos", "dim_proyectos", "ID_Proyecto"),
    ("dim_hitos", "ID_FechaInicio", "dim_tiempo", "ID_Tiempo"),
    ("dim_hitos", "ID_FechaFinalizacion", "dim_tiempo", "ID_Tiempo"),
    ("dim_tareas", "ID_Hito", "dim_hitos", "ID_Hito"),
    ("dim_pruebas", "ID_Hito", "dim_hitos", "ID_Hito"),
    ("dim_tiempo", "ID_DiaSemana", "subdim_dia_semana", "ID_Dia_Semana"),
    ("dim_tiempo", "ID_Mes", "subdim_mes", "ID_Mes"),
    ("dim_tiempo", "ID_Anio", "subdim_anio", "ID_Anio"),
    ("hechos_asignaciones", "ID_Empleado", "dim_empleados", "ID_Empleado"),
    ("hechos_asignaciones", "ID_Proyecto", "dim_proyectos", "ID_Proyecto"),
    ("hechos_asignaciones", "ID_FechaAsignacion", "dim_tiempo", "ID_Tiempo"),
    ("hechos_proyectos", "ID_Proyecto", "dim_proyectos", "ID_Proyecto"),
    ("hechos_proyectos", "ID_TiempoInicio", "dim_tiempo", "ID_Tiempo"),
    ("hechos_proyectos", "ID_TiempoFinalizacion", "dim_tiempo", "ID_Tiempo"),
    ("hechos_proyectos", "ID_Riesgo", "dim_riesgos", "ID_Riesgo"),
    ("hechos_proyectos", "ID_Finanza", "dim_finanzas", "ID_Finanza"),
)


def primary_key(table: str) -> str:
    """Every table of the model is keyed by its first column."""
    return next(iter(STAR.get(table) or SOURCE[table]))


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
