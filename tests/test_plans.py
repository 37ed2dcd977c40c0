"""The physical plans the operators rely on at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starpipe.operators import dims, extract, facts
from starpipe.plans.star import INPUTS, build_star, keep_inputs
from starpipe.schemas import LOAD_ORDER, SOURCE, STAR
from starpipe.sources.readers import parquet_source
from starpipe.sources.tables import Tables
from starpipe.workspace import materialise
from tests.world import WORLD, frames, rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("source"))
    for name, df in frames(spark, WORLD).items():
        df.write.parquet(f"{root}/{name}")
    return parquet_source(spark, root)


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run on tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_state_filter_and_columns_reach_the_scan(stored):
    plan = plan_of(extract.extract_clientes(stored))
    assert "In(Estado, [Cancelado,Cerrado])" in plan
    assert "ReadSchema: struct<ID_Cliente:bigint,Estado:string>" in plan


def test_watermark_filter_reaches_the_scan(stored):
    plan = plan_of(extract.changed_since(stored["gastos"], "Fecha", "2024-01-03 00:00:00"))
    assert "GreaterThan(Fecha,2024-01-03)" in plan


def test_rollup_reads_only_the_columns_it_reduces(stored):
    x = extract.unscoped_children(stored, extract.extract_all(stored))
    plan = plan_of(facts.measured_projects(x, ["PorcentajeTareasRetrasadas"]))
    assert "gastos" not in plan and "asignaciones" not in plan
    assert "NombreTarea" not in plan


def test_large_joins_shuffle_and_results_stay_the_same(stored, no_broadcast):
    x = extract.extract_all(stored)
    star = build_star(x, fact_inputs=extract.unscoped_children(stored, x))
    rollup = plan_of(facts.project_rollup(x))
    assert "BroadcastHashJoin" not in rollup and "SortMergeJoin" in rollup
    assert star["hechos_proyectos"].count() == 4
    assert rows(star["dim_riesgos"]) == [(4, 0, 0), (5, 1, 1), (6, 1, 2), (7, 2, 1)]


def test_calendar_reduces_all_children_by_one_aggregate(stored, no_broadcast):
    plan = plan_of(dims.calendar_span(extract.unscoped_children(stored, extract.extract_all(stored))))
    # Once for the children, once for the projects in scope.
    assert plan.count("Exchange hashpartitioning(ID_Proyecto") == 2


def test_what_a_source_joins_to_its_employees_is_left_out_of_the_calendar(stored):
    joined = stored["empleados"].join(
        stored["clientes"].withColumnRenamed("ID_Cliente", "ID_Empleado"), "ID_Empleado", "left"
    )
    source = Tables({n: (lambda n=n: stored[n]) for n in SOURCE}).but(empleados=lambda: joined)
    u = extract.unscoped_children(source, extract.extract_all(source))
    for df in (dims.calendar_span(u), facts.staff_by_project(u)):
        assert "NombreCliente" not in plan_of(df) and "LeftOuter" not in plan_of(df)


def test_columns_that_only_order_rows_are_not_written(spark, stored):
    star = build_star(extract.extract_all(stored))
    for name, order in (("dim_finanzas", "owner"), ("hechos_asignaciones", "FechaAsignacion")):
        files = star[name].inputFiles()
        assert order not in spark.read.option("mergeSchema", "true").parquet(*files).columns


def test_a_star_from_its_inputs_alone_is_the_same(stored):
    whole = build_star(extract.extract_all(stored, keep=materialise), keep=materialise)
    x = extract.extract_all(stored, keep=keep_inputs)
    star = build_star(x, keep=materialise)
    assert {name: x[name].columns for name in SOURCE} == {n: list(c) for n, c in INPUTS.items()}
    for name in STAR:
        assert rows(star[name]) == rows(whole[name]), name


@pytest.mark.parametrize("name", ["tareas", "pruebas", "errores"])
def test_children_join_the_written_scope_once(stored, no_broadcast, name):
    x = extract.extract_all(stored, keep=materialise)
    owners = {"errores": ("tareas", ["ID_Tarea", "ID_Hito", "ID_Proyecto"])}
    parent, columns = owners.get(name, ("hitos", ["ID_Hito", "ID_Proyecto"]))
    build = getattr(extract, f"extract_{name}")
    plan = plan_of(build(stored[name], x[parent].select(*columns)))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1
    assert rows(x[name]) == rows(extract.extract_all(stored)[name])


def test_no_plan_multiplies_rows_or_leaves_the_jvm(stored):
    star = build_star(extract.extract_all(stored))
    for name in LOAD_ORDER:
        plan = plan_of(star[name])
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
            assert operator not in plan, (name, operator)


def test_first_risks_leave_out_what_a_source_joins_to_its_risks(stored):
    # Severities from a relation with repeated keys: the rows double, the first risk stays.
    types = stored["clientes"].select(F.col("ID_Cliente").alias("ID_Proyecto"), "NombreCliente")
    repeated = types.unionByName(types).unionByName(
        stored["proyectos"].select("ID_Proyecto", F.col("NombreProyecto").alias("NombreCliente"))
    )
    risks = stored["riesgos"].join(repeated, "ID_Proyecto", "left")
    plan = plan_of(facts.first_risks(risks))
    assert "Join" not in plan and "NombreProyecto" not in plan
    assert rows(facts.first_risks(risks)) == rows(facts.first_risks(stored["riesgos"]))


def test_costs_reduce_rows_without_texts(stored):
    plan = plan_of(facts.costs_by_project(stored["gastos"]))
    assert "TipoGasto" not in plan.split("partial_sum")[1].split("Project")[0]
    assert plan.count("upper(Categoria") == 2


def test_rollup_and_calendar_share_written_penalties(stored):
    x = extract.unscoped_children(stored, extract.extract_all(stored))
    written = materialise(dims.penalties_by_contract(x), "penalties")
    rollup = materialise(facts.project_rollup(x, penalties=written), "rollup")
    assert rows(rollup) == rows(facts.project_rollup(x))
    span = facts.rollup_span(rollup, x, written)
    assert rows(span) == rows(facts.rollup_span(rollup, x))
    assert "/penalizaciones" not in plan_of(span) and "/contratos" not in plan_of(span)
