"""The twelve source relations derived from an order-processing schema.

The given tables (customer, supplier, part, nation, orders, lineitem) play the project-management
system: an order is a project, two consecutive orders share a contract, and order lines are tasks,
assignments, expenses and so on. Amounts become decimals before any arithmetic, dates plain dates.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.functions.keys import dense_id
from starpipe.schemas import SOURCE
from starpipe.sources.readers import typed
from starpipe.sources.tables import Tables

_LINE_COLUMNS = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "decimal(10,2)",
    "l_extendedprice": "decimal(15,2)",
    "l_discount": "decimal(10,2)",
    "l_tax": "decimal(10,2)",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "date",
}

# Column types of the given files; stating them spares a job per read that would infer them.
_GIVEN = {
    "customer": "c_custkey bigint, c_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_type string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}

_landed: dict[str, DataFrame] = {}
_landing = Lock()


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_GIVEN[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with ``rid``, a dense primary key in the order of all eleven columns.

    The given lines have no key of their own. The numbering sorts and writes the table once per
    session and folder; every relation that needs ``rid`` then scans just its columns of that copy.
    """
    with _landing:
        landed = _landed.get(sf_dir)
        if landed is None or landed.sparkSession is not spark:
            raw = _read(spark, sf_dir, "lineitem")
            exact = raw.select(*[F.col(c).cast(kind).alias(c) for c, kind in _LINE_COLUMNS.items()])
            landed = _landed[sf_dir] = dense_id(
                exact, list(_LINE_COLUMNS), "rid", counted=raw.select("l_orderkey")
            )
        return landed


def _choose(value: Column, cases: dict[str, str | int], otherwise=None) -> Column:
    chosen = F
    for key, result in cases.items():
        chosen = chosen.when(value == key, result)
    return chosen.otherwise(otherwise)


def _unless(missing: Column, value: Column) -> Column:
    return F.when(~missing, value)


def _milestone_key(order: str, line: str) -> Column:
    return F.col(order) * 10 + F.col(line)


def order_system(spark: SparkSession, sf_dir: str, shift_days: int = 0) -> Tables:
    """Source relations over the tables in ``sf_dir``; ``shift_days`` moves every date."""

    def day(value: str) -> Column:
        plain = F.col(value).cast("date")
        return F.date_add(plain, shift_days) if shift_days else plain

    def lines() -> DataFrame:
        return numbered_lines(spark, sf_dir)

    def clientes() -> DataFrame:
        return _read(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("ID_Cliente"), F.col("c_name").alias("NombreCliente")
        )

    def contratos() -> DataFrame:
        # Client and state come from the lower of the two orders, the value from both. The state
        # travels as a number so that the aggregate keeps a fixed-width buffer.
        state = _choose(F.col("o_orderstatus"), {"F": 1, "P": 2}, 0)
        pairs = (
            _read(spark, sf_dir, "orders")
            .groupBy(F.expr("o_orderkey div 2").alias("ID_Contrato"))
            .agg(
                F.min_by("o_custkey", "o_orderkey").alias("ID_Cliente"),
                F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("ValorTotalContrato"),
                F.min_by(state, "o_orderkey").alias("state"),
            )
        )
        return pairs.withColumn(
            "Estado", _choose(F.col("state"), {1: "Cerrado", 2: "Cancelado"}, "Activo")
        )

    def proyectos() -> DataFrame:
        key = F.col("o_orderkey")
        return _read(spark, sf_dir, "orders").select(
            key.alias("ID_Proyecto"),
            F.expr("o_orderkey div 2").alias("ID_Contrato"),
            F.concat(F.lit("Proyecto "), key).alias("NombreProyecto"),
            _unless(key % 5 == 0, F.concat(F.lit(" v"), key % 3, F.lit(" "))).alias("Version"),
            _unless(key % 19 == 0, day("o_orderdate")).alias("FechaInicio"),
            _unless(
                key % 17 == 0, F.date_add(day("o_orderdate"), (key % 400).cast("int"))
            ).alias("FechaFin"),
            _choose(
                F.col("o_orderpriority"), {"1-URGENT": "Cerrado", "2-HIGH": "Cancelado"}, "Activo"
            ).alias("Estado"),
        )

    def empleados() -> DataFrame:
        key = F.col("s_suppkey")
        nation = _read(spark, sf_dir, "nation")
        supplier = _read(spark, sf_dir, "supplier")
        cost = F.abs(F.col("s_acctbal").cast("decimal(15,2)")) * F.lit("0.01").cast("decimal(3,2)")
        return supplier.join(
            nation, F.col("s_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            key.alias("ID_Empleado"),
            F.col("s_name").alias("NombreCompleto"),
            F.concat(F.lit(" "), F.coalesce("n_name", F.lit("?")), F.lit(" ")).alias("Rol"),
            _unless(key % 7 == 0, F.concat(F.lit("S"), key % 3)).alias("Seniority"),
            _unless(key % 11 == 0, cost.cast("decimal(12,2)")).alias("CostoPorHora"),
        )

    def hitos() -> DataFrame:
        starts = (
            _read(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.min(F.col("l_shipdate").cast("date")).alias("start"))
        )
        key = _milestone_key("l_orderkey", "l_linenumber")
        planned = F.date_add(day("start"), 30)
        drift = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 41 - 20).cast("int")
        real = _unless(key % 11 == 0, F.date_add(planned, drift))
        return starts.select(
            key.alias("ID_Hito"),
            F.col("l_orderkey").alias("ID_Proyecto"),
            F.concat(F.lit("Hito "), key).alias("Descripcion"),
            F.when(real.isNull(), "Abierto").otherwise("Completado").alias("Estado"),
            day("start").alias("FechaInicio"),
            planned.alias("FechaFinPlanificada"),
            real.alias("FechaFinReal"),
        )

    def tareas() -> DataFrame:
        rid = F.col("rid")
        plan = F.col("l_quantity").cast("int")
        return lines().select(
            rid.alias("ID_Tarea"),
            _milestone_key("l_orderkey", "l_linenumber").alias("ID_Hito"),
            F.concat(F.lit("Tarea "), rid).alias("NombreTarea"),
            F.lit(None).cast("string").alias("Descripcion"),
            F.col("l_linestatus").alias("Estado"),
            _unless(rid % 13 == 0, plan).alias("DuracionPlanificada"),
            _unless(rid % 10 == 0, (plan + rid % 9 - 4).cast("int")).alias("DuracionReal"),
        )

    def asignaciones() -> DataFrame:
        return lines().select(
            F.col("rid").alias("ID_Asignacion"),
            F.col("l_orderkey").alias("ID_Proyecto"),
            F.col("l_suppkey").alias("ID_Empleado"),
            F.col("l_quantity").alias("HorasPlanificadas"),
            (F.col("l_quantity") * (F.col("l_discount") + 1))
            .cast("decimal(10,2)")
            .alias("HorasReales"),
            day("l_shipdate").alias("FechaAsignacion"),
        )

    def pruebas() -> DataFrame:
        return lines().select(
            F.col("rid").alias("ID_Prueba"),
            _milestone_key("l_orderkey", "l_linenumber").alias("ID_Hito"),
            F.concat(F.lit(" Q"), F.quarter("l_shipdate"), F.lit(" ")).alias("TipoPrueba"),
            day("l_shipdate").alias("Fecha"),
            _choose(F.col("l_returnflag"), {"A": 1, "R": 0}).alias("Exitosa"),
        )

    def errores() -> DataFrame:
        return lines().where(F.col("l_returnflag") == "R").select(
            F.col("rid").alias("ID_Error"),
            F.col("rid").alias("ID_Tarea"),
            F.col("l_linestatus").alias("TipoError"),
            F.lit(None).cast("string").alias("Descripcion"),
            day("l_shipdate").alias("Fecha"),
        )

    def riesgos() -> DataFrame:
        part = _read(spark, sf_dir, "part").select("p_partkey", "p_type")
        orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
        taxed = lines().where(F.col("l_tax") >= F.lit("0.07").cast("decimal(10,2)"))
        return (
            taxed.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .select(
                F.col("rid").alias("ID_Riesgo"),
                F.col("l_orderkey").alias("ID_Proyecto"),
                _unless(F.col("rid") % 23 == 0, F.col("p_type")).alias("TipoRiesgo"),
                F.col("o_orderpriority").alias("Severidad"),
                F.lit(None).cast("string").alias("Descripcion"),
                day("l_shipdate").alias("FechaRegistro"),
            )
        )

    def gastos() -> DataFrame:
        return lines().select(
            F.col("rid").alias("ID_Gasto"),
            F.col("l_orderkey").alias("ID_Proyecto"),
            _choose(
                F.col("l_returnflag"), {"A": "Penalizacion", "R": "Materiales"}, "Salarios"
            ).alias("TipoGasto"),
            _unless(
                F.col("rid") % 29 == 0, _choose(F.col("l_linestatus"), {"F": "capex"}, "OPEX")
            ).alias("Categoria"),
            F.col("l_extendedprice").alias("Monto"),
            day("l_shipdate").alias("Fecha"),
        )

    def penalizaciones() -> DataFrame:
        return lines().where(F.col("l_discount") >= F.lit("0.09").cast("decimal(10,2)")).select(
            F.col("rid").alias("ID_Penalizacion"),
            F.expr("l_orderkey div 2").alias("ID_Contrato"),
            (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(15,2)").alias("Monto"),
            F.col("l_linestatus").alias("Motivo"),
            day("l_shipdate").alias("Fecha"),
        )

    relations = (
        clientes, empleados, contratos, proyectos, hitos, tareas,
        asignaciones, pruebas, errores, riesgos, gastos, penalizaciones,
    )
    builders = {
        build.__name__: (lambda b=build: typed(b(), b.__name__)) for build in relations
    }
    assert set(builders) == set(SOURCE)
    return Tables(builders)
