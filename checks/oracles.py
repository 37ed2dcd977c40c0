"""Independent SQL for the registered queries, written against the given tables.

Every statement is a chain of common table expressions: the source relations (``s_*``), the
extracts (``x_*``) and the star (``dim_*``, ``hechos_*``), of which only those a query refers to
are included. Facts are computed from extracted children, quotients by integer arithmetic.
"""

from __future__ import annotations

import re

from checks.registry import AS_OF, QUERIES, RECENT

CLOSED = "('Cerrado', 'Cancelado')"


def ratio(part: str, whole: str, precision: int, scale: int, factor: int = 1) -> str:
    """part * factor / whole rounded half up, 0 for an empty whole; operands have 2 decimals."""

    def cents(value: str) -> str:
        return f"CAST(CAST({value} AS DECIMAL(25,2)) * 100 AS HUGEINT)"

    n = f"(abs({cents(part)}) * {2 * factor * 10**scale})"
    d = cents(whole)
    unit = "0." + "0" * (scale - 1) + "1"
    return (
        f"CASE WHEN coalesce({whole}, 0) = 0 THEN CAST(0 AS DECIMAL({precision},{scale})) ELSE "
        f"CAST(sign({cents(part)}) * CAST(({n} + {d}) // (2 * {d}) AS DECIMAL(24,0)) * {unit} "
        f"AS DECIMAL({precision},{scale})) END"
    )


def relations(shift: int) -> dict[str, str]:
    """Source relations; ``shift`` days are added to every date."""
    day = f"CAST(l_shipdate AS DATE) + {shift}"
    order_day = f"CAST(o_orderdate AS DATE) + {shift}"
    return {
        "lines": f"""
            SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
                     CAST(l_quantity AS DECIMAL(10,2)), CAST(l_extendedprice AS DECIMAL(15,2)),
                     CAST(l_discount AS DECIMAL(10,2)), CAST(l_tax AS DECIMAL(10,2)),
                     l_returnflag, l_linestatus, CAST(l_shipdate AS DATE)) AS rid,
                   l_orderkey, l_partkey, l_suppkey, l_linenumber,
                   l_orderkey * 10 + l_linenumber AS milestone,
                   CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
                   CAST(l_extendedprice AS DECIMAL(15,2)) AS price,
                   CAST(l_discount AS DECIMAL(10,2)) AS discount,
                   CAST(l_tax AS DECIMAL(10,2)) AS tax,
                   l_returnflag, l_linestatus, quarter(l_shipdate) AS q, {day} AS day
            FROM lineitem""",
        "s_clientes": "SELECT c_custkey AS ID_Cliente, c_name AS NombreCliente FROM customer",
        "s_empleados": """
            SELECT s_suppkey AS ID_Empleado, s_name AS NombreCompleto,
                   ' ' || coalesce(n_name, '?') || ' ' AS Rol,
                   CASE WHEN s_suppkey % 7 <> 0 THEN 'S' || (s_suppkey % 3) END AS Seniority,
                   CASE WHEN s_suppkey % 11 <> 0 THEN
                     CAST(abs(CAST(s_acctbal AS DECIMAL(15,2))) * CAST(0.01 AS DECIMAL(3,2))
                          AS DECIMAL(12,2)) END AS CostoPorHora
            FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
        "s_contratos": """
            SELECT o_orderkey // 2 AS ID_Contrato, arg_min(o_custkey, o_orderkey) AS ID_Cliente,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(15,2))
                     AS ValorTotalContrato,
                   arg_min(CASE o_orderstatus WHEN 'F' THEN 'Cerrado' WHEN 'P' THEN 'Cancelado'
                           ELSE 'Activo' END, o_orderkey) AS Estado
            FROM orders GROUP BY 1""",
        "s_proyectos": f"""
            SELECT o_orderkey AS ID_Proyecto, o_orderkey // 2 AS ID_Contrato,
                   'Proyecto ' || o_orderkey AS NombreProyecto,
                   CASE WHEN o_orderkey % 5 <> 0 THEN ' v' || (o_orderkey % 3) || ' ' END
                     AS Version,
                   CASE WHEN o_orderkey % 19 <> 0 THEN {order_day} END AS FechaInicio,
                   CASE WHEN o_orderkey % 17 <> 0
                     THEN {order_day} + CAST(o_orderkey % 400 AS INTEGER) END AS FechaFin,
                   CASE o_orderpriority WHEN '1-URGENT' THEN 'Cerrado'
                     WHEN '2-HIGH' THEN 'Cancelado' ELSE 'Activo' END AS Estado
            FROM orders""",
        "s_hitos": """
            SELECT milestone AS ID_Hito, l_orderkey AS ID_Proyecto,
                   'Hito ' || milestone AS Descripcion,
                   CASE WHEN milestone % 11 = 0 THEN 'Abierto' ELSE 'Completado' END AS Estado,
                   min(day) AS FechaInicio, min(day) + 30 AS FechaFinPlanificada,
                   CASE WHEN milestone % 11 <> 0 THEN min(day) + 30
                     + CAST((l_orderkey * 7 + l_linenumber) % 41 - 20 AS INTEGER) END
                     AS FechaFinReal
            FROM lines GROUP BY milestone, l_orderkey, l_linenumber""",
        "s_tareas": """
            SELECT rid AS ID_Tarea, milestone AS ID_Hito, 'Tarea ' || rid AS NombreTarea,
                   CAST(NULL AS VARCHAR) AS Descripcion, l_linestatus AS Estado,
                   CASE WHEN rid % 13 <> 0 THEN CAST(quantity AS INTEGER) END
                     AS DuracionPlanificada,
                   CASE WHEN rid % 10 <> 0 THEN CAST(CAST(quantity AS INTEGER) + rid % 9 - 4
                     AS INTEGER) END AS DuracionReal
            FROM lines""",
        "s_asignaciones": """
            SELECT rid AS ID_Asignacion, l_orderkey AS ID_Proyecto, l_suppkey AS ID_Empleado,
                   quantity AS HorasPlanificadas,
                   CAST(quantity * (1 + discount) AS DECIMAL(10,2)) AS HorasReales,
                   day AS FechaAsignacion
            FROM lines""",
        "s_pruebas": """
            SELECT rid AS ID_Prueba, milestone AS ID_Hito, ' Q' || q || ' ' AS TipoPrueba,
                   day AS Fecha, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 END AS Exitosa
            FROM lines""",
        "s_errores": """
            SELECT rid AS ID_Error, rid AS ID_Tarea, l_linestatus AS TipoError,
                   CAST(NULL AS VARCHAR) AS Descripcion, day AS Fecha
            FROM lines WHERE l_returnflag = 'R'""",
        "s_riesgos": """
            SELECT rid AS ID_Riesgo, l_orderkey AS ID_Proyecto,
                   CASE WHEN rid % 23 <> 0 THEN p_type END AS TipoRiesgo,
                   o_orderpriority AS Severidad, CAST(NULL AS VARCHAR) AS Descripcion,
                   day AS FechaRegistro
            FROM lines LEFT JOIN part ON l_partkey = p_partkey
                 LEFT JOIN orders ON l_orderkey = o_orderkey
            WHERE tax >= 0.07""",
        "s_gastos": """
            SELECT rid AS ID_Gasto, l_orderkey AS ID_Proyecto,
                   CASE l_returnflag WHEN 'A' THEN 'Penalizacion' WHEN 'R' THEN 'Materiales'
                     ELSE 'Salarios' END AS TipoGasto,
                   CASE WHEN rid % 29 <> 0 THEN
                     CASE l_linestatus WHEN 'F' THEN 'capex' ELSE 'OPEX' END END AS Categoria,
                   price AS Monto, day AS Fecha
            FROM lines""",
        "s_penalizaciones": """
            SELECT rid AS ID_Penalizacion, l_orderkey // 2 AS ID_Contrato,
                   CAST(price * discount AS DECIMAL(15,2)) AS Monto, l_linestatus AS Motivo,
                   day AS Fecha
            FROM lines WHERE discount >= 0.09""",
    }


EXTRACTS = {
    "x_clientes": f"""
        SELECT DISTINCT cl.ID_Cliente, cl.NombreCliente
        FROM s_clientes cl JOIN s_contratos c ON cl.ID_Cliente = c.ID_Cliente
        WHERE c.Estado IN {CLOSED}""",
    "x_contratos": f"SELECT * FROM s_contratos WHERE Estado IN {CLOSED}",
    "x_proyectos": f"""
        SELECT p.ID_Proyecto, p.ID_Contrato, p.NombreProyecto, p.Version, p.FechaInicio,
               p.FechaFin, p.Estado AS EstadoProyecto, c.ID_Cliente, c.ValorTotalContrato,
               c.Estado AS EstadoContrato,
               CASE WHEN p.Estado IN {CLOSED} THEN 'Por proyecto'
                    WHEN c.Estado IN {CLOSED} THEN 'Por contrato' ELSE 'No aplica' END
                 AS razon_inclusion
        FROM s_proyectos p JOIN s_contratos c ON p.ID_Contrato = c.ID_Contrato
        WHERE p.Estado IN {CLOSED} OR c.Estado IN {CLOSED}""",
    "x_empleados": """
        SELECT * FROM s_empleados WHERE ID_Empleado IN (
          SELECT a.ID_Empleado FROM s_asignaciones a JOIN x_proyectos p USING (ID_Proyecto))""",
    "x_hitos": f"""
        SELECT h.*, date_diff('day', FechaFinPlanificada,
                              coalesce(FechaFinReal, DATE '{AS_OF}')) AS dias_retraso
        FROM s_hitos h WHERE ID_Proyecto IN (SELECT ID_Proyecto FROM x_proyectos)""",
    "x_tareas": """
        SELECT t.ID_Tarea, t.ID_Hito, h.ID_Proyecto, t.NombreTarea, t.Descripcion, t.Estado,
               t.DuracionPlanificada, t.DuracionReal,
               coalesce(t.DuracionReal, 0) - coalesce(t.DuracionPlanificada, 0)
                 AS desviacion_duracion
        FROM s_tareas t JOIN x_hitos h ON t.ID_Hito = h.ID_Hito""",
    "x_asignaciones": """
        SELECT a.*, e.CostoPorHora,
               CAST(a.HorasReales * e.CostoPorHora AS DECIMAL(15,2)) AS costo_real_horas,
               CAST(a.HorasPlanificadas * e.CostoPorHora AS DECIMAL(15,2))
                 AS costo_planificado_horas
        FROM s_asignaciones a JOIN s_empleados e ON a.ID_Empleado = e.ID_Empleado
        WHERE a.ID_Proyecto IN (SELECT ID_Proyecto FROM x_proyectos)""",
    "x_pruebas": """
        SELECT t.ID_Prueba, t.ID_Hito, h.ID_Proyecto, t.TipoPrueba, t.Fecha, t.Exitosa
        FROM s_pruebas t JOIN x_hitos h ON t.ID_Hito = h.ID_Hito""",
    "x_errores": """
        SELECT e.ID_Error, e.ID_Tarea, t.ID_Hito, t.ID_Proyecto, e.TipoError, e.Descripcion,
               e.Fecha
        FROM s_errores e JOIN x_tareas t ON e.ID_Tarea = t.ID_Tarea""",
    "x_riesgos": """
        SELECT * FROM s_riesgos WHERE ID_Proyecto IN (SELECT ID_Proyecto FROM x_proyectos)""",
    "x_gastos": """
        SELECT * FROM s_gastos WHERE ID_Proyecto IN (SELECT ID_Proyecto FROM x_proyectos)""",
    "x_penalizaciones": """
        SELECT p.ID_Penalizacion, p.ID_Contrato, c.ID_Cliente, p.Monto, p.Motivo, p.Fecha
        FROM s_penalizaciones p JOIN x_contratos c ON p.ID_Contrato = c.ID_Contrato""",
}


def all_dates(prefix: str) -> str:
    columns = {
        "proyectos": ("FechaInicio", "FechaFin"),
        "hitos": ("FechaInicio", "FechaFinPlanificada", "FechaFinReal"),
        "asignaciones": ("FechaAsignacion",),
        "gastos": ("Fecha",),
        "penalizaciones": ("Fecha",),
    }
    return " UNION ".join(
        f"SELECT {column} AS Fecha FROM {prefix}{table} WHERE {column} IS NOT NULL"
        for table, names in columns.items()
        for column in names
    )


def first_seen(value: str, name: str) -> str:
    return f"""
        SELECT row_number() OVER (ORDER BY ID_Proyecto, FechaRegistro, ID_Riesgo) AS {name}, {value}
        FROM (SELECT *, row_number() OVER (PARTITION BY {value}
                ORDER BY ID_Proyecto, FechaRegistro, ID_Riesgo) AS nth
              FROM x_riesgos WHERE {value} IS NOT NULL) WHERE nth = 1"""


STAR = {
    "dates": all_dates("x_"),
    "dim_clientes": "SELECT ID_Cliente, ID_Cliente AS CodigoClienteReal FROM x_clientes",
    "dim_empleados": """
        SELECT ID_Empleado, ID_Empleado AS CodigoEmpleado, trim(Rol) AS Rol,
               coalesce(trim(Seniority), 'No especificado') AS Seniority FROM x_empleados""",
    "dim_proyectos": """
        SELECT ID_Proyecto, ID_Proyecto AS CodigoProyecto,
               coalesce(trim(Version), '1.0') AS Version,
               CASE WHEN EstadoProyecto = 'Cancelado' THEN 1 ELSE 0 END AS Cancelado, ID_Cliente
        FROM x_proyectos WHERE ID_Cliente IN (SELECT ID_Cliente FROM x_clientes)""",
    "dim_tiempo": """
        SELECT CAST(row_number() OVER (ORDER BY Fecha) AS INTEGER) AS ID_Tiempo, Fecha,
               CAST(isodow(Fecha) AS INTEGER) AS ID_DiaSemana,
               CAST(month(Fecha) AS INTEGER) AS ID_Mes,
               CAST(year(Fecha) - 2018 AS INTEGER) AS ID_Anio
        FROM (SELECT CAST(unnest(generate_series(
                CAST(least(min(Fecha), DATE '2019-01-01') AS TIMESTAMP),
                CAST(greatest(max(Fecha), DATE '2025-12-31') AS TIMESTAMP),
                INTERVAL 1 DAY)) AS DATE) AS Fecha FROM dates)""",
    "subdim_dia_semana": """
        SELECT DISTINCT ID_DiaSemana AS ID_Dia_Semana, ID_DiaSemana AS NumeroDia FROM dim_tiempo""",
    "subdim_mes": "SELECT DISTINCT ID_Mes, ID_Mes AS NumeroMes FROM dim_tiempo",
    "subdim_anio": "SELECT DISTINCT ID_Anio, year(Fecha) AS NumeroAnio FROM dim_tiempo",
    "dim_hitos": """
        SELECT ID_Hito, ID_Hito AS CodigoHito, ID_Proyecto AS ID_proyectos,
               CASE WHEN FechaInicio IS NOT NULL THEN
                 greatest(1, date_diff('day', DATE '2019-01-01', FechaInicio) + 1) END
                 AS ID_FechaInicio,
               CASE WHEN FechaFinReal IS NOT NULL THEN
                 greatest(1, date_diff('day', DATE '2019-01-01', FechaFinReal) + 1) END
                 AS ID_FechaFinalizacion,
               coalesce(date_diff('day', FechaFinPlanificada, FechaFinReal), 0) AS Retraso_days
        FROM x_hitos""",
    "dim_tareas": """
        SELECT ID_Tarea, ID_Tarea AS CodigoTarea, ID_Hito,
               coalesce(DuracionReal, 0) AS DuracionDias,
               coalesce(DuracionReal, 0) - coalesce(DuracionPlanificada, 0) AS RetrasoDias
        FROM x_tareas""",
    "dim_pruebas": """
        SELECT ID_Prueba, ID_Prueba AS CodigoPrueba, ID_Hito, trim(TipoPrueba) AS TipoPrueba,
               coalesce(Exitosa, 0) AS PruebaExitosa
        FROM x_pruebas WHERE ID_Hito IN (SELECT ID_Hito FROM x_hitos)""",
    "finance_rows": """
        SELECT 0 AS origin, ID_Proyecto AS owner, Fecha, ID_Gasto AS entry, TipoGasto,
               coalesce(Categoria, 'No especificado') AS Categoria, Monto FROM x_gastos
        UNION ALL
        SELECT 1, ID_Contrato, Fecha, ID_Penalizacion, 'Penalizaciones', 'OPEX', Monto
        FROM x_penalizaciones""",
    "numbered_finances": """
        SELECT row_number() OVER (ORDER BY origin, owner, Fecha, entry) AS ID_Finanza, *
        FROM finance_rows""",
    "dim_finanzas": "SELECT ID_Finanza, TipoGasto, Categoria, Monto FROM numbered_finances",
    "risk_types": first_seen("TipoRiesgo", "ID_TipoRiesgo"),
    "severities": first_seen("Severidad", "ID_Severidad"),
    "dim_tipo_riesgo": "SELECT ID_TipoRiesgo, trim(TipoRiesgo) AS NombreTipo FROM risk_types",
    "dim_severidad": "SELECT ID_Severidad, trim(Severidad) AS Nivel FROM severities",
    "dim_riesgos": """
        SELECT r.ID_Riesgo, coalesce(t.ID_TipoRiesgo, 0) AS ID_TipoRiesgo,
               coalesce(s.ID_Severidad, 0) AS ID_Severidad
        FROM x_riesgos r LEFT JOIN risk_types t ON r.TipoRiesgo = t.TipoRiesgo
             LEFT JOIN severities s ON r.Severidad = s.Severidad""",
    "costs": """
        SELECT ID_Proyecto, CAST(sum(Monto) AS DECIMAL(25,2)) AS cost,
               CAST(coalesce(sum(Monto) FILTER (lower(TipoGasto) LIKE '%penalizacion%'), 0)
                    AS DECIMAL(25,2)) AS penalty,
               CAST(coalesce(sum(Monto) FILTER (upper(Categoria) = 'CAPEX'), 0)
                    AS DECIMAL(25,2)) AS capex,
               CAST(coalesce(sum(Monto) FILTER (upper(Categoria) = 'OPEX'), 0)
                    AS DECIMAL(25,2)) AS opex
        FROM x_gastos GROUP BY ID_Proyecto""",
    "first_expense": """
        SELECT ID_Proyecto, ID_Gasto FROM (
          SELECT *, row_number() OVER (PARTITION BY ID_Proyecto ORDER BY Fecha, ID_Gasto) AS nth
          FROM x_gastos) WHERE nth = 1""",
    "first_risk": """
        SELECT ID_Proyecto, ID_Riesgo FROM (
          SELECT *, row_number() OVER (PARTITION BY ID_Proyecto
                                       ORDER BY FechaRegistro, ID_Riesgo) AS nth
          FROM x_riesgos) WHERE nth = 1""",
    "milestones": """
        SELECT ID_Proyecto, count(*) AS n,
               count(*) FILTER (FechaFinReal > FechaFinPlanificada) AS late,
               max(FechaFinPlanificada) AS last_planned, count(FechaFinReal) AS finished
        FROM x_hitos GROUP BY ID_Proyecto""",
    "tasks": """
        SELECT ID_Proyecto, count(*) AS n,
               count(*) FILTER (DuracionReal > DuracionPlanificada) AS late
        FROM x_tareas GROUP BY ID_Proyecto""",
    "metrics": f"""
        SELECT p.ID_Proyecto,
               CASE WHEN p.FechaFin IS NULL THEN 0 ELSE coalesce(ti.ID_Tiempo, 0) END
                 AS ID_TiempoInicio,
               CASE WHEN p.FechaInicio IS NULL THEN 0 ELSE coalesce(tf.ID_Tiempo, 0) END
                 AS ID_TiempoFinalizacion,
               coalesce(r.ID_Riesgo, CASE WHEN EXISTS (SELECT 1 FROM x_riesgos) THEN 1 ELSE 0 END)
                 AS ID_Riesgo,
               coalesce(g.ID_Gasto, 0) AS ID_Finanza,
               coalesce(date_diff('day', p.FechaInicio, p.FechaFin), 0) AS DuracionRealDias,
               CASE WHEN p.FechaInicio IS NOT NULL AND p.FechaFin IS NOT NULL
                         AND m.last_planned IS NOT NULL AND m.finished > 0
                 THEN greatest(0, date_diff('day', p.FechaInicio, p.FechaFin)
                                  - date_diff('day', p.FechaInicio, m.last_planned))
                 ELSE 0 END AS RetrasoDias,
               p.ValorTotalContrato AS PresupuestoCliente,
               coalesce(c.cost, 0) AS CosteReal,
               p.ValorTotalContrato - coalesce(c.cost, 0) AS DesviacionPresupuestal,
               coalesce(c.penalty, 0) + coalesce(k.penalty, 0) AS PenalizacionesMonto,
               CASE WHEN c.opex > 0 THEN CAST(c.capex AS DOUBLE) / CAST(c.opex AS DOUBLE)
                    WHEN c.capex > 0 THEN CAST('inf' AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
                 AS ProporcionCAPEX_OPEX,
               coalesce(e.n, 0) AS NumeroDefectosEncontrados,
               CASE WHEN date_diff('day', p.FechaInicio, p.FechaFin) > 0
                 THEN {ratio("date_diff('day', p.FechaInicio, p.FechaFin)", "a.n", 10, 2)}
                 ELSE CAST(0 AS DECIMAL(10,2)) END AS ProductividadPromedio,
               {ratio("t.late", "t.n", 5, 2, 100)} AS PorcentajeTareasRetrasadas,
               {ratio("m.late", "m.n", 5, 2, 100)} AS PorcentajeHitosRetrasados
        FROM x_proyectos p JOIN dim_proyectos d ON p.ID_Proyecto = d.ID_Proyecto
             LEFT JOIN dim_tiempo ti ON p.FechaInicio = ti.Fecha
             LEFT JOIN dim_tiempo tf ON p.FechaFin = tf.Fecha
             LEFT JOIN costs c ON p.ID_Proyecto = c.ID_Proyecto
             LEFT JOIN first_expense g ON p.ID_Proyecto = g.ID_Proyecto
             LEFT JOIN first_risk r ON p.ID_Proyecto = r.ID_Proyecto
             LEFT JOIN milestones m ON p.ID_Proyecto = m.ID_Proyecto
             LEFT JOIN tasks t ON p.ID_Proyecto = t.ID_Proyecto
             LEFT JOIN (SELECT ID_Contrato, CAST(sum(Monto) AS DECIMAL(25,2)) AS penalty
                        FROM x_penalizaciones GROUP BY 1) k ON p.ID_Contrato = k.ID_Contrato
             LEFT JOIN (SELECT ID_Proyecto, count(*) AS n FROM x_errores GROUP BY 1) e
               ON p.ID_Proyecto = e.ID_Proyecto
             LEFT JOIN (SELECT ID_Proyecto, count(DISTINCT ID_Empleado) AS n
                        FROM x_asignaciones GROUP BY 1) a ON p.ID_Proyecto = a.ID_Proyecto""",
    "hechos_proyectos": """
        SELECT row_number() OVER (ORDER BY ID_Proyecto) AS ID_Hecho, * FROM metrics""",
    "assignment_rows": """
        SELECT a.ID_Asignacion, a.FechaAsignacion, a.ID_Empleado, a.ID_Proyecto,
               coalesce(f.ID_Tiempo, 0) AS ID_FechaAsignacion,
               coalesce(a.HorasPlanificadas, 0) AS HorasPlanificadas,
               coalesce(a.HorasReales, 0) AS HorasReales,
               CAST(coalesce(a.HorasReales, 0) * coalesce(e.CostoPorHora, 0) AS DECIMAL(15,2))
                 AS ValorHoras
        FROM x_asignaciones a LEFT JOIN dim_tiempo f ON a.FechaAsignacion = f.Fecha
             LEFT JOIN x_empleados e ON a.ID_Empleado = e.ID_Empleado""",
    "hechos_asignaciones": """
        SELECT row_number() OVER (ORDER BY ID_Proyecto, FechaAsignacion, ID_Asignacion)
                 AS ID_HechoAsignacion,
               ID_Empleado, ID_Proyecto, ID_FechaAsignacion, HorasPlanificadas, HorasReales,
               ValorHoras
        FROM assignment_rows""",
}


def statement(body: str, shift: int = 0) -> str:
    """``body`` preceded by the common table expressions it needs, directly or not."""
    known = {**relations(shift), **EXTRACTS, **STAR}
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in known.keys() - needed:
            if re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(known[name])
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in known.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def dropped_tests(milestones: str) -> str:
    """Extracted tests against those of the given milestones."""
    return f"""
        SELECT 'dim_pruebas' AS tabla, count(*) AS antes,
               count(*) FILTER (ID_Hito IN ({milestones})) AS despues,
               count(*) - count(*) FILTER (ID_Hito IN ({milestones})) AS filtradas
        FROM x_pruebas"""


def counts(tables: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS tabla, count(*) AS filas FROM {table}" for label, table in tables
    )


def pk_audit(tables: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, '{k}' AS clave, count(*) AS duplicadas FROM "
        f"(SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)"
        for t, k in tables
    )


def fk_audit(keys: list[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, '{c}' AS columna, '{p}' AS referencia, "
        f"count(DISTINCT {c}) AS valores, count(*) AS filas FROM {t} "
        f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {p})"
        for t, c, p, k in keys
    )


RELATIONS = (
    "clientes", "empleados", "contratos", "proyectos", "hitos", "tareas",
    "asignaciones", "pruebas", "errores", "riesgos", "gastos", "penalizaciones",
)

# Table, primary key.
STAR_KEYS = [
    ("dim_clientes", "ID_Cliente"),
    ("dim_empleados", "ID_Empleado"),
    ("dim_tiempo", "ID_Tiempo"),
    ("dim_tipo_riesgo", "ID_TipoRiesgo"),
    ("dim_severidad", "ID_Severidad"),
    ("dim_proyectos", "ID_Proyecto"),
    ("dim_finanzas", "ID_Finanza"),
    ("dim_riesgos", "ID_Riesgo"),
    ("dim_hitos", "ID_Hito"),
    ("dim_tareas", "ID_Tarea"),
    ("dim_pruebas", "ID_Prueba"),
    ("hechos_asignaciones", "ID_HechoAsignacion"),
    ("hechos_proyectos", "ID_Hecho"),
]
SUB_KEYS = [
    ("subdim_dia_semana", "ID_Dia_Semana"),
    ("subdim_mes", "ID_Mes"),
    ("subdim_anio", "ID_Anio"),
]

FOREIGN_KEYS = [
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
]

_star_counts = [(t, t) for t, _ in STAR_KEYS]

# Extracts whose rows a star table has one by one, but for those it leaves out.
ORIGINS = {
    "dim_clientes": ["clientes"], "dim_empleados": ["empleados"], "dim_proyectos": ["proyectos"],
    "dim_hitos": ["hitos"], "dim_tareas": ["tareas"], "dim_pruebas": ["pruebas"],
    "dim_finanzas": ["gastos", "penalizaciones"], "dim_riesgos": ["riesgos"],
    "hechos_proyectos": ["proyectos"], "hechos_asignaciones": ["asignaciones"],
}


def run_report() -> str:
    rows = [("extraccion", n, "filas", f"(SELECT count(*) FROM x_{n})") for n in RELATIONS]
    rows += [("carga", t, "filas", f"(SELECT count(*) FROM {t})") for t, _ in STAR_KEYS]
    rows.append(("carga", "hechos_asignaciones", "sin_fecha",
                 "(SELECT count(*) FROM hechos_asignaciones WHERE ID_FechaAsignacion = 0)"))
    rows.append(("carga", "hechos_proyectos", "no_almacenables",
                 "(SELECT count(*) FROM hechos_proyectos WHERE ProporcionCAPEX_OPEX >= 99999999.995)"))
    for table, origins in ORIGINS.items():
        given = " + ".join(f"(SELECT count(*) FROM x_{n})" for n in origins)
        rows.append(("perdida", table, "filas", f"{given} - (SELECT count(*) FROM {table})"))
    return " UNION ALL ".join(
        f"SELECT '{a}' AS etapa, '{b}' AS tabla, '{c}' AS medida, {d} AS valor" for a, b, c, d in rows
    )


BODIES = {
    "s1_scan": "SELECT * FROM s_gastos",
    **{f"x{n:02d}_{name}": f"SELECT * FROM x_{name}" for n, name in enumerate(RELATIONS, 1)},
    "s2_extract_counts": counts([(name, f"x_{name}") for name in RELATIONS]),
    "s3_stamped": counts([(name, f"x_{name}") for name in RELATIONS]),
    "f1_state_filter": f"SELECT ID_Contrato, Estado FROM s_contratos WHERE Estado IN {CLOSED}",
    "f1_state_filter_collated": f"""
        SELECT ID_Contrato, upper(Estado) AS Estado FROM s_contratos WHERE Estado IN {CLOSED}""",
    "f2_scope": "SELECT ID_Proyecto, ID_Contrato, EstadoProyecto, EstadoContrato FROM x_proyectos",
    "f3_target_columns": "SELECT * FROM dim_empleados",
    "f4_renamed": "SELECT ID_Hito, ID_Proyecto AS ID_proyectos FROM x_hitos",
    "f5_business_code": "SELECT ID_Prueba, CodigoPrueba FROM dim_pruebas",
    "f6_not_null": "SELECT ID_Riesgo, TipoRiesgo FROM s_riesgos WHERE TipoRiesgo IS NOT NULL",
    "f7_upper_equals": """
        SELECT ID_Gasto, CASE WHEN upper(Categoria) = 'CAPEX' THEN 1 ELSE 0 END AS capex,
               CASE WHEN upper(Categoria) = 'OPEX' THEN 1 ELSE 0 END AS opex FROM s_gastos""",
    "f8_contains": """
        SELECT ID_Gasto, CASE WHEN lower(TipoGasto) LIKE '%penalizacion%' THEN 1 ELSE 0 END
                 AS penalizacion FROM s_gastos""",
    "j1_inner_chain": "SELECT ID_Tarea, ID_Hito, ID_Proyecto FROM x_tareas",
    "j2_semi": "SELECT ID_Gasto, ID_Proyecto FROM x_gastos",
    "j3_semi_if_any": "SELECT ID_Proyecto, ID_Cliente FROM dim_proyectos",
    "j3_semi_if_none": "SELECT ID_Proyecto, ID_Cliente FROM x_proyectos",
    "j4_lookup_rate": """
        SELECT a.ID_Asignacion, a.ID_Empleado, coalesce(e.CostoPorHora, 0) AS tarifa
        FROM s_asignaciones a LEFT JOIN s_empleados e ON a.ID_Empleado = e.ID_Empleado""",
    "j4_lookup_date": """
        SELECT a.ID_Asignacion, coalesce(f.ID_Tiempo, 0) AS ID_Tiempo
        FROM s_asignaciones a LEFT JOIN dim_tiempo f ON a.FechaAsignacion = f.Fecha""",
    "j5_children_of_project": """
        SELECT p.ID_Proyecto, m.n AS milestones, t.n AS tasks, a.n AS staff
        FROM dim_proyectos p LEFT JOIN milestones m ON p.ID_Proyecto = m.ID_Proyecto
             LEFT JOIN tasks t ON p.ID_Proyecto = t.ID_Proyecto
             LEFT JOIN (SELECT ID_Proyecto, count(DISTINCT ID_Empleado) AS n
                        FROM x_asignaciones GROUP BY 1) a ON p.ID_Proyecto = a.ID_Proyecto""",
    "a01_duracion": "SELECT ID_Proyecto, DuracionRealDias FROM metrics",
    "a02_retraso": "SELECT ID_Proyecto, RetrasoDias FROM metrics",
    "a03_claves_tiempo": "SELECT ID_Proyecto, ID_TiempoInicio, ID_TiempoFinalizacion FROM metrics",
    "a04_presupuesto": "SELECT ID_Proyecto, PresupuestoCliente FROM metrics",
    "a05_coste": "SELECT ID_Proyecto, CosteReal FROM metrics",
    "a06_desviacion": "SELECT ID_Proyecto, DesviacionPresupuestal FROM metrics",
    "a07_primer_gasto": "SELECT ID_Proyecto, ID_Finanza FROM metrics",
    "a08_penalizaciones": "SELECT ID_Proyecto, PenalizacionesMonto FROM metrics",
    "a09_capex_opex": "SELECT ID_Proyecto, ProporcionCAPEX_OPEX FROM metrics",
    "a10_riesgo": "SELECT ID_Proyecto, ID_Riesgo FROM metrics",
    "a11_defectos": "SELECT ID_Proyecto, NumeroDefectosEncontrados FROM metrics",
    "a12_productividad": "SELECT ID_Proyecto, ProductividadPromedio FROM metrics",
    "a13_tareas": "SELECT ID_Proyecto, PorcentajeTareasRetrasadas FROM metrics",
    "a14_hitos": "SELECT ID_Proyecto, PorcentajeHitosRetrasados FROM metrics",
    "a15_distinct_dates": "SELECT Fecha FROM dates",
    "a15_distinct_levels": """
        SELECT DISTINCT Severidad FROM x_riesgos WHERE Severidad IS NOT NULL""",
    "a16_date_span": """
        SELECT least(min(Fecha), DATE '2019-01-01') AS primera,
               greatest(max(Fecha), DATE '2025-12-31') AS ultima FROM dates""",
    "a17_counts": counts(_star_counts),
    "a17_dropped_projects": """
        SELECT 'dim_proyectos' AS tabla, (SELECT count(*) FROM x_proyectos) AS antes,
               (SELECT count(*) FROM dim_proyectos) AS despues,
               (SELECT count(*) FROM x_proyectos) - (SELECT count(*) FROM dim_proyectos)
                 AS filtradas""",
    "a17_dropped_tests": dropped_tests("SELECT ID_Hito FROM x_hitos"),
    "a17_dropped_tests_unknown": dropped_tests(
        "SELECT ID_Hito FROM x_hitos WHERE FechaFinReal IS NOT NULL"
    ),
    "a17_unstorable_ratios": """
        SELECT 'ProporcionCAPEX_OPEX' AS columna,
               count(ProporcionCAPEX_OPEX)
                 - count(CASE WHEN ProporcionCAPEX_OPEX < 99999999.995 THEN 1 END) AS valores
        FROM hechos_proyectos""",
    "a17_unmatched_dates": """
        SELECT count(*) FILTER (ID_FechaAsignacion = 0) AS sin_fecha FROM assignment_rows""",
    "w1_dense_id": """
        SELECT row_number() OVER (ORDER BY Fecha, ID_Gasto) AS orden, ID_Gasto, Fecha
        FROM s_gastos""",
    "w2_first_seen": "SELECT ID_TipoRiesgo, TipoRiesgo FROM risk_types",
    "w3_first_in_group": "SELECT ID_Proyecto, ID_Riesgo FROM first_risk",
    "o1_extraction_order": "SELECT * FROM x_gastos ORDER BY ID_Proyecto, Fecha, ID_Gasto",
    "o2_sorted_dates": "SELECT Fecha FROM dates ORDER BY Fecha",
    "o3_preview": "SELECT * FROM dim_proyectos ORDER BY ID_Proyecto LIMIT 3",
    "u1_union_finanzas": "SELECT origin, entry, TipoGasto, Categoria, Monto FROM finance_rows",
    "u2_union_dates": all_dates("s_"),
    "u3_merged_names": counts(
        [
            ("proyectos", "x_proyectos"),
            ("dim_proyectos", "dim_proyectos"),
            ("dim_tiempo", "dim_tiempo"),
        ]
    ),
    "c01_strip": "SELECT ID_Empleado, trim(Rol) AS Rol FROM s_empleados",
    "c02_case": """
        SELECT ID_Gasto, upper(TipoGasto) AS mayusculas, lower(TipoGasto) AS minusculas
        FROM s_gastos""",
    "c03_defaults": "SELECT ID_Proyecto, coalesce(trim(Version), '1.0') AS Version FROM s_proyectos",
    "c04_null_text": """
        SELECT ID_Gasto, coalesce(Categoria, 'No especificado') AS categoria,
               coalesce(Categoria, 'None') AS categoria_texto FROM s_gastos""",
    "c05_safe_number": """
        SELECT ID_Proyecto, coalesce(TRY_CAST(Version AS INTEGER), 0) AS version,
               coalesce(TRY_CAST(CAST(ID_Contrato AS VARCHAR) AS BIGINT), 0) AS contrato
        FROM s_proyectos""",
    "c06_safe_date": """
        SELECT ID_Proyecto, TRY_CAST(NombreProyecto AS DATE) AS nombre,
               TRY_CAST(CAST(FechaInicio AS VARCHAR) AS DATE) AS inicio FROM s_proyectos""",
    "c07_days_between": """
        SELECT ID_Hito, date_diff('day', FechaFinPlanificada, FechaFinReal) AS dias FROM s_hitos""",
    "c08_fixed_base_key": """
        SELECT ID_Proyecto,
               CASE WHEN FechaInicio IS NOT NULL THEN
                 greatest(1, date_diff('day', DATE '2019-01-01', FechaInicio) + 1) END AS inicio,
               CASE WHEN FechaInicio IS NOT NULL THEN
                 greatest(1, date_diff('day', DATE '2019-01-01', FechaInicio - 700) + 1) END
                 AS antes
        FROM s_proyectos""",
    "c09_calendar_parts": """
        SELECT ID_Proyecto, isodow(FechaInicio) AS dia, month(FechaInicio) AS mes,
               year(FechaInicio) - 2018 AS anio FROM s_proyectos""",
    "c10_daily_series": "SELECT Fecha FROM dim_tiempo",
    "c11_flags": """
        SELECT ID_Proyecto, CASE WHEN upper(EstadoProyecto) = 'CANCELADO' THEN 1 ELSE 0 END
                 AS cancelado FROM x_proyectos""",
    "c12_ratios": f"""
        SELECT ID_Proyecto,
               CASE WHEN opex > 0 THEN CAST(capex AS DOUBLE) / CAST(opex AS DOUBLE)
                    WHEN capex > 0 THEN CAST('inf' AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
                 AS proporcion,
               {ratio("opex", "cost", 5, 2, 100)} AS porcentaje
        FROM (SELECT ID_Proyecto, sum(Monto) AS cost,
                     coalesce(sum(Monto) FILTER (Categoria = 'capex'), 0) AS capex,
                     coalesce(sum(Monto) FILTER (Categoria = 'OPEX'), 0) AS opex
              FROM s_gastos GROUP BY ID_Proyecto)""",
    "c13_inclusion_reason": """
        SELECT razon_inclusion, count(*) AS proyectos FROM x_proyectos GROUP BY 1""",
    "c14_as_of": "SELECT ID_Hito, dias_retraso FROM x_hitos WHERE FechaFinReal IS NULL",
    "d01_dim_clientes": "SELECT * FROM dim_clientes",
    "d02_dim_empleados": "SELECT * FROM dim_empleados",
    "d03_dim_proyectos": "SELECT * FROM dim_proyectos",
    "d04_dim_tiempo": "SELECT * FROM dim_tiempo",
    "d04_dim_tiempo_recent": "SELECT * FROM dim_tiempo",
    "d05_subdimensiones": """
        SELECT 'subdim_dia_semana' AS tabla, ID_Dia_Semana AS clave, NumeroDia AS numero
        FROM subdim_dia_semana
        UNION ALL SELECT 'subdim_mes', ID_Mes, NumeroMes FROM subdim_mes
        UNION ALL SELECT 'subdim_anio', ID_Anio, NumeroAnio FROM subdim_anio""",
    "d06_dim_hitos": "SELECT * FROM dim_hitos",
    "d06_dim_hitos_recent": "SELECT * FROM dim_hitos",
    "d06_dim_hitos_lookup": """
        SELECT h.ID_Hito, h.ID_Hito AS CodigoHito, h.ID_Proyecto AS ID_proyectos,
               i.ID_Tiempo AS ID_FechaInicio, f.ID_Tiempo AS ID_FechaFinalizacion,
               coalesce(date_diff('day', h.FechaFinPlanificada, h.FechaFinReal), 0) AS Retraso_days
        FROM x_hitos h LEFT JOIN dim_tiempo i ON h.FechaInicio = i.Fecha
             LEFT JOIN dim_tiempo f ON h.FechaFinReal = f.Fecha""",
    "d07_dim_tareas": "SELECT * FROM dim_tareas",
    "d08_dim_pruebas": "SELECT * FROM dim_pruebas",
    "d09_dim_finanzas": "SELECT * FROM dim_finanzas",
    "d09_dim_finanzas_null_text": """
        SELECT ID_Finanza, TipoGasto,
               CASE Categoria WHEN 'No especificado' THEN 'None' ELSE Categoria END AS Categoria,
               Monto FROM dim_finanzas""",
    "d10_dim_tipo_riesgo": "SELECT * FROM dim_tipo_riesgo",
    "d11_dim_severidad": "SELECT * FROM dim_severidad",
    "d12_dim_riesgos": "SELECT * FROM dim_riesgos",
    "d13_hechos_proyectos": "SELECT * FROM hechos_proyectos",
    "d13_hechos_proyectos_recent": "SELECT * FROM hechos_proyectos",
    "d13_hechos_proyectos_collated": "SELECT * FROM hechos_proyectos",
    "d13_from_extracts": "SELECT * FROM hechos_proyectos",
    "d13_hechos_proyectos_resolved": """
        SELECT h.* REPLACE (coalesce(n.ID_Finanza, 0) AS ID_Finanza)
        FROM hechos_proyectos h LEFT JOIN numbered_finances n
             ON n.origin = 0 AND h.ID_Finanza = n.entry""",
    "d14_hechos_asignaciones": "SELECT * FROM hechos_asignaciones",
    "d14_hechos_asignaciones_recent": "SELECT * FROM hechos_asignaciones",
    "d15_star_sizes": counts([(t, t) for t, _ in STAR_KEYS + SUB_KEYS]),
    "l1_roundtrip": "SELECT * FROM dim_proyectos",
    "l2_append": "SELECT * FROM dim_clientes UNION ALL SELECT * FROM dim_clientes",
    "l2_append_batch": "SELECT * FROM dim_clientes UNION ALL SELECT * FROM dim_clientes",
    "l3_sink_types": """
        SELECT * REPLACE (
          nullif(ID_TiempoInicio, 0) AS ID_TiempoInicio,
          nullif(ID_TiempoFinalizacion, 0) AS ID_TiempoFinalizacion,
          nullif(ID_Riesgo, 0) AS ID_Riesgo, nullif(ID_Finanza, 0) AS ID_Finanza,
          CASE WHEN isfinite(ProporcionCAPEX_OPEX)
            THEN CAST(ProporcionCAPEX_OPEX AS DECIMAL(10,2)) END AS ProporcionCAPEX_OPEX)
        FROM hechos_proyectos""",
    "l4_load_all": counts(_star_counts),
    "l4_load_all_nulls": """
        SELECT count(*) AS filas, count(nullif(ID_TiempoInicio, 0)) AS con_inicio,
               count(nullif(ID_Riesgo, 0)) AS con_riesgo, count(nullif(ID_Finanza, 0)) AS con_finanza
        FROM hechos_proyectos""",
    "l5_gate": """
        SELECT 'dim_hitos' AS tabla, count(*) AS filas, 0 AS retenidas
        FROM dim_hitos WHERE Retraso_days <= 0
        UNION ALL SELECT 'dim_tareas', count(*) FILTER (Retraso_days <= 0),
          count(*) FILTER (Retraso_days > 0) FROM dim_tareas JOIN dim_hitos USING (ID_Hito)
        UNION ALL SELECT 'dim_pruebas', count(*) FILTER (Retraso_days <= 0),
          count(*) FILTER (Retraso_days > 0) FROM dim_pruebas JOIN dim_hitos USING (ID_Hito)""",
    "e1_incremental_load": """
        SELECT * EXCLUDE (ID_Hecho) REPLACE (
          CASE WHEN isfinite(ProporcionCAPEX_OPEX)
            THEN CAST(ProporcionCAPEX_OPEX AS DECIMAL(10,2)) END AS ProporcionCAPEX_OPEX)
        FROM hechos_proyectos""",
    "e1_incremental_counts": counts(_star_counts),
    "i5_status": """
        SELECT strftime(max(FechaFin), '%Y-%m-%d 00:00:00') AS last_extraction,
               'incremental' AS next_mode FROM s_proyectos""",
    "e1_full_run": counts(_star_counts),
    "e1_run_report": run_report(),
    "e2_reset_and_run": counts(_star_counts),
    "l5_fk_audit": fk_audit(FOREIGN_KEYS),
    "l6_pk_audit": pk_audit(STAR_KEYS + SUB_KEYS),
    "i1_since_watermark": """
        SELECT * FROM s_gastos WHERE Fecha > (
          SELECT max(FechaInicio) FROM x_proyectos WHERE EstadoProyecto = 'Cancelado')""",
    "i4_after_reset": "SELECT * FROM s_penalizaciones",
    "i3_incremental": "SELECT * FROM s_gastos WHERE Fecha > TIMESTAMP '1998-06-30 00:00:00'",
    "e1_incremental_scope": """
        SELECT * FROM x_proyectos WHERE FechaFin > TIMESTAMP '1998-06-30 00:00:00'""",
    "q1_rentabilidad": """
        SELECT d.ID_Cliente, count(*) AS proyectos, sum(PresupuestoCliente) AS presupuesto,
               sum(CosteReal) AS coste, sum(PenalizacionesMonto) AS penalizaciones,
               sum(PresupuestoCliente) - sum(CosteReal) - sum(PenalizacionesMonto) AS margen
        FROM metrics m JOIN dim_proyectos d ON m.ID_Proyecto = d.ID_Proyecto GROUP BY 1""",
    "q1_rentabilidad_proyecto": """
        SELECT ID_Proyecto, PresupuestoCliente AS presupuesto, CosteReal AS coste,
               PenalizacionesMonto AS penalizaciones,
               PresupuestoCliente - CosteReal - PenalizacionesMonto AS margen
        FROM metrics""",
    "q2_presupuesto": f"""
        SELECT ID_Proyecto, PresupuestoCliente, CosteReal, DesviacionPresupuestal,
               {ratio("DesviacionPresupuestal", "PresupuestoCliente", 18, 4)}
                 AS desviacion_relativa,
               CASE WHEN CosteReal > PresupuestoCliente THEN 1 ELSE 0 END AS sobrecosto
        FROM metrics""",
    "q3_penalizaciones_totales": """
        SELECT TipoGasto, Categoria, count(*) AS cargos, sum(Monto) AS monto FROM dim_finanzas
        WHERE TipoGasto = 'Penalizaciones' GROUP BY 1, 2""",
    "q3_penalizaciones_cliente": """
        SELECT d.ID_Cliente, count(*) FILTER (PenalizacionesMonto > 0) AS proyectos_penalizados,
               sum(PenalizacionesMonto) AS penalizaciones
        FROM metrics m JOIN dim_proyectos d ON m.ID_Proyecto = d.ID_Proyecto GROUP BY 1""",
    "q4_cronograma": f"""
        SELECT ID_Anio, ID_Mes, n AS proyectos, {ratio("a", "n", 5, 2, 100)}
                 AS porcentaje_a_tiempo, {ratio("r", "n", 18, 2)} AS retraso_medio
        FROM (SELECT ID_Anio, ID_Mes, count(*) AS n, count(*) FILTER (RetrasoDias = 0) AS a,
                     sum(RetrasoDias) AS r
              FROM metrics JOIN dim_tiempo ON ID_TiempoFinalizacion = ID_Tiempo
              GROUP BY 1, 2)""",
    "q5_cuellos_botella": """
        SELECT ID_Hito, count(*) AS tareas_retrasadas, sum(RetrasoDias) AS dias_perdidos
        FROM dim_tareas WHERE RetrasoDias > 0 GROUP BY 1
        ORDER BY dias_perdidos DESC, ID_Hito""",
    "q6_productividad": f"""
        SELECT ID_Anio, ID_Mes, n AS proyectos, {ratio("p", "n", 18, 2)} AS productividad_media
        FROM (SELECT ID_Anio, ID_Mes, count(*) AS n, sum(ProductividadPromedio) AS p
              FROM metrics JOIN dim_tiempo ON ID_TiempoInicio = ID_Tiempo GROUP BY 1, 2)""",
    "q7_utilizacion": f"""
        SELECT *, {ratio("horas_reales", "horas_planificadas", 18, 4)} AS utilizacion
        FROM (SELECT ID_Empleado, count(*) AS asignaciones,
                     sum(HorasPlanificadas) AS horas_planificadas,
                     sum(HorasReales) AS horas_reales
              FROM assignment_rows GROUP BY 1)""",
    "q8_coste_hora": f"""
        SELECT *, {ratio("valor_horas", "horas_reales", 18, 4)} AS coste_por_hora
        FROM (SELECT e.Rol, e.Seniority, count(DISTINCT e.ID_Empleado) AS empleados,
                     sum(ValorHoras) AS valor_horas, sum(HorasReales) AS horas_reales
              FROM assignment_rows a JOIN dim_empleados e ON a.ID_Empleado = e.ID_Empleado
              GROUP BY 1, 2)""",
    "q9_defectos": f"""
        SELECT *, {ratio("defectos", "proyectos", 18, 4)} AS defectos_por_proyecto
        FROM (SELECT d.ID_Cliente, count(*) AS proyectos,
                     sum(NumeroDefectosEncontrados) AS defectos
              FROM metrics m JOIN dim_proyectos d ON m.ID_Proyecto = d.ID_Proyecto GROUP BY 1)""",
    "q9_pruebas": f"""
        SELECT *, {ratio("exitosas", "pruebas", 18, 4)} AS efectividad
        FROM (SELECT TipoPrueba, count(*) AS pruebas, sum(PruebaExitosa) AS exitosas
              FROM dim_pruebas GROUP BY 1)""",
}

SHIFTED = {
    "j4_lookup_date",
    "c08_fixed_base_key",
    "d04_dim_tiempo_recent",
    "d06_dim_hitos_recent",
    "d13_hechos_proyectos_recent",
    "d14_hechos_asignaciones_recent",
}


def all_sql() -> dict[str, str]:
    return {
        name: statement(BODIES[name], RECENT if name in SHIFTED else 0)
        for name in QUERIES
        if name in BODIES
    }
