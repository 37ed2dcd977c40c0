from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starpipe.operators import dims, extract, facts
from starpipe.plans.star import build_star
from starpipe.schemas import STAR
from starpipe.sources.readers import frame_source
from starpipe.workspace import materialise
from tests.world import WORLD, by_key, d, frames, n, rows


def star_of(spark, **changed):
    source = frame_source(frames(spark, {**WORLD, **changed}))
    return build_star(extract.extract_all(source))


@pytest.fixture(scope="module")
def x(world):
    return extract.extract_all(world, keep=materialise)


@pytest.fixture(scope="module")
def star(x):
    return build_star(x)


@pytest.fixture(scope="module")
def calendar(star):
    return materialise(star["dim_tiempo"], "calendar")


@pytest.fixture(scope="module")
def fact(star):
    return by_key(star["hechos_proyectos"], "ID_Proyecto")


def test_every_table_has_its_contract_columns(star):
    for name, columns in STAR.items():
        assert sorted(star[name].columns) == sorted(columns), name


def test_dim_clientes_and_empleados(star):
    assert rows(star["dim_clientes"]) == [(1, 1), (3, 3)]
    assert rows(star["dim_empleados"]) == [(1, 1, "Dev", "No especificado"), (2, 2, "QA", "Senior")]


def test_dim_proyectos_drops_projects_of_unknown_clients(star):
    assert rows(star["dim_proyectos"]) == [
        (101, 101, "1.0", 0, 1),
        (103, 103, "3.1", 0, 3),
        (105, 105, "1", 1, 1),
        (106, 106, "1", 0, 3),
    ]


def test_dim_proyectos_keeps_all_when_there_are_no_clients(spark):
    active = [(k, c, v, "Activo") for k, c, v, _ in WORLD["contratos"]]
    star = star_of(spark, contratos=active)
    kept = star["dim_proyectos"].select("ID_Proyecto")
    assert rows(kept) == [(101,), (102,), (105,)]


def test_calendar(star):
    calendar = sorted(star["dim_tiempo"].collect())
    # The oldest milestone is one day before the fixed start.
    assert calendar[0] == (1, date(2018, 12, 31), 1, 12, 0)
    assert calendar[-1].Fecha == date(2025, 12, 31)
    assert len(calendar) == 2558
    assert [r.ID_Tiempo for r in calendar] == list(range(1, 2559))
    assert all(b.Fecha - a.Fecha == timedelta(1) for a, b in zip(calendar, calendar[1:]))


@pytest.mark.parametrize("day, size, last", [("2026-01-02", 2559, "2026-01-02"),
                                             (None, 2557, "2025-12-31")])
def test_calendar_limits(spark, day, size, last):
    empty = {name: [] for name in WORLD}
    some = {
        "contratos": [(1, 1, n("1"), "Cerrado")],
        "penalizaciones": [(1, 1, n("1"), "m", d(day))] if day else [],
    }
    star = star_of(spark, **{**empty, **some})
    calendar = sorted(star["dim_tiempo"].collect())
    assert (len(calendar), calendar[-1].Fecha) == (size, date.fromisoformat(last))
    assert star["hechos_proyectos"].count() == 0


def test_subdimensions(star):
    assert rows(star["subdim_dia_semana"]) == [(i, i) for i in range(1, 8)]
    assert len(rows(star["subdim_mes"])) == 12
    assert rows(star["subdim_anio"], "ID_Anio") == [(i, 2018 + i) for i in range(8)]


def test_dim_hitos_fixed_base(star):
    day = (date(2024, 1, 1) - date(2019, 1, 1)).days + 1
    assert rows(star["dim_hitos"], "ID_Hito") == [
        (1, 1, 103, day, None, 0),
        (2, 2, 103, day, day + 50, 10),
        (3, 3, 106, 1, None, 0),
        (4, 4, 102, None, day + 9, -5),
    ]


def test_dim_hitos_lookup_mode(x):
    star = build_star(x, calendar_key_mode="lookup")
    day = (date(2024, 1, 1) - date(2018, 12, 31)).days + 1
    keys = {k: r["ID_FechaInicio"] for k, r in by_key(star["dim_hitos"], "ID_Hito").items()}
    assert keys == {1: day, 2: day, 3: 1, 4: None}
    with pytest.raises(ValueError):
        build_star(x, calendar_key_mode="other")


def test_dim_tareas_treats_missing_as_zero(star):
    assert rows(star["dim_tareas"], "ID_Tarea") == [
        (1, 1, 1, 5, 5),
        (2, 2, 1, 0, -3),
        (3, 3, 2, 5, 2),
        (4, 4, 2, 7, 0),
        (6, 6, 4, 2, 1),
    ]


def test_dim_pruebas(x, star):
    expected = [(1, 1, 1, "Unitarias", 0), (2, 2, 2, "Unitarias", 1), (3, 3, 4, "Aceptacion", 0)]
    assert rows(star["dim_pruebas"], "ID_Prueba") == expected
    assert rows(dims.dim_pruebas(x), "ID_Prueba") == expected
    some = x.but(hitos=lambda: x["hitos"].where("ID_Hito = 2"))
    assert rows(dims.dim_pruebas(some)) == [(2, 2, 2, "Unitarias", 1)]
    none = x.but(hitos=lambda: x["hitos"].where("ID_Hito = 99"))
    assert dims.dim_pruebas(none).count() == 3


def test_dim_finanzas(x, star):
    expected = [
        (1, "Salarios", "No especificado", Decimal("7.00")),
        (2, "PENALIZACIONES", "OPEX", Decimal("200.00")),
        (3, "Materiales", "capex", Decimal("300.00")),
        (4, "Penalización", "Capex", Decimal("10.00")),
        (5, "Penalizaciones", "OPEX", Decimal("50.00")),
    ]
    assert rows(star["dim_finanzas"], "ID_Finanza") == expected
    as_text = build_star(x, null_text="None")["dim_finanzas"]
    assert rows(as_text, "ID_Finanza")[0][2] == "None"


def test_risk_dimensions(star):
    assert rows(star["dim_severidad"]) == [(1, "Alta"), (2, "Baja")]
    assert rows(star["dim_tipo_riesgo"]) == [(1, "Tecnico"), (2, "Operativo")]
    assert rows(star["dim_riesgos"]) == [(4, 0, 0), (5, 1, 1), (6, 1, 2), (7, 2, 1)]


def test_fact_rows_and_keys(fact):
    assert {k: r["ID_Hecho"] for k, r in fact.items()} == {101: 1, 103: 2, 105: 3, 106: 4}


def test_duration_delay_and_date_keys(fact):
    first = date(2018, 12, 31)
    assert fact[103]["DuracionRealDias"] == 60
    assert fact[103]["RetrasoDias"] == 20
    assert fact[103]["ID_TiempoInicio"] == (date(2024, 1, 1) - first).days + 1
    assert fact[103]["ID_TiempoFinalizacion"] == (date(2024, 3, 1) - first).days + 1
    # Never finished: everything about time is 0, also the start key.
    assert [fact[101][c] for c in ("DuracionRealDias", "RetrasoDias", "ID_TiempoInicio")] == [0] * 3
    # No milestone has a real end.
    assert (fact[106]["DuracionRealDias"], fact[106]["RetrasoDias"]) == (31, 0)
    assert fact[105]["DuracionRealDias"] == -30


def test_money(fact):
    money = [fact[103][c] for c in ("PresupuestoCliente", "CosteReal", "DesviacionPresupuestal",
                                    "PenalizacionesMonto", "ProporcionCAPEX_OPEX")]
    assert money == [Decimal("1000.00"), Decimal("500.00"), Decimal("500.00"),
                     Decimal("250.00"), 1.5]
    assert fact[106]["ProporcionCAPEX_OPEX"] == float("inf")
    assert fact[106]["PenalizacionesMonto"] == Decimal("50.00")  # shared contract, accent ignored
    assert fact[101]["PenalizacionesMonto"] == 0  # its contract is open
    assert (fact[105]["CosteReal"], fact[105]["ProporcionCAPEX_OPEX"]) == (0, 0.0)
    assert fact[101]["DesviacionPresupuestal"] == Decimal("500.00")


def test_first_expense_and_first_risk(fact):
    assert (fact[103]["ID_Finanza"], fact[106]["ID_Finanza"], fact[101]["ID_Finanza"]) == (1, 3, 0)
    assert (fact[103]["ID_Riesgo"], fact[106]["ID_Riesgo"], fact[101]["ID_Riesgo"]) == (5, 6, 1)


def test_risk_key_is_zero_without_any_risk_in_scope(spark):
    outside = [r for r in WORLD["riesgos"] if r[1] == 104]
    fact = by_key(star_of(spark, riesgos=outside)["hechos_proyectos"], "ID_Proyecto")
    assert {r["ID_Riesgo"] for r in fact.values()} == {0}


def test_quality_measures(fact):
    assert fact[103]["NumeroDefectosEncontrados"] == 3
    assert fact[103]["ProductividadPromedio"] == Decimal("30.00")
    assert fact[105]["ProductividadPromedio"] == 0  # negative duration
    assert fact[103]["PorcentajeTareasRetrasadas"] == Decimal("25.00")
    assert fact[103]["PorcentajeHitosRetrasados"] == Decimal("50.00")
    assert fact[106]["PorcentajeTareasRetrasadas"] == 0


def test_resolved_finance_key_points_at_the_expense(x):
    star = build_star(x, resolve_finanza=True)
    fact = by_key(star["hechos_proyectos"], "ID_Proyecto")
    assert {k: r["ID_Finanza"] for k, r in fact.items()} == {101: 0, 103: 2, 105: 0, 106: 4}


def test_reducing_the_source_equals_reducing_the_extracts(world, x, star):
    reduced = build_star(x, fact_inputs=extract.unscoped_children(world, x))
    for name in ("dim_tiempo", "hechos_proyectos"):
        assert rows(reduced[name]) == rows(star[name])


def test_unknown_employee_counts_on_neither_path(spark):
    late = date(2033, 1, 1)
    extra = {**WORLD, "asignaciones": [*WORLD["asignaciones"], (99, 103, 77, Decimal(1), Decimal(1), late)]}
    source = frame_source({n: materialise(df, n) for n, df in frames(spark, extra).items()})
    x = extract.extract_all(source)
    star, reduced = build_star(x), build_star(x, fact_inputs=extract.unscoped_children(source, x))
    assert by_key(reduced["hechos_proyectos"], "ID_Proyecto")[103]["ProductividadPromedio"] == Decimal("30.00")
    for name in ("dim_tiempo", "hechos_proyectos"):
        assert rows(reduced[name]) == rows(star[name])


def test_collation_reaches_the_penalties(spark, star):
    shouting = frames(spark, WORLD)
    for name in ("contratos", "proyectos"):
        shouting[name] = shouting[name].withColumn("Estado", F.upper("Estado"))
    source = frame_source({n: materialise(df, n) for n, df in shouting.items()})
    x = extract.extract_all(source, collation="UNICODE_CI_AI")
    for inputs in (None, extract.unscoped_children(source, x)):
        fact = build_star(x, fact_inputs=inputs)["hechos_proyectos"]
        assert rows(fact) == rows(star["hechos_proyectos"])


def test_calendar_from_rollup_equals_calendar_from_dates(x, star):
    kept = build_star(x, keep=lambda df, name: df)
    assert rows(kept["dim_tiempo"]) == rows(star["dim_tiempo"])


@pytest.mark.parametrize("name", list(facts.MEASURES))
def test_single_measures_equal_the_fact(world, x, calendar, fact, name):
    reduced = extract.unscoped_children(world, x)
    alone = facts.measured_projects(reduced, [name], calendar)
    assert {k: r[name] for k, r in by_key(alone, "ID_Proyecto").items()} == {
        k: r[name] for k, r in fact.items()
    }


def test_hechos_asignaciones(star):
    day = (date(2024, 1, 2) - date(2018, 12, 31)).days + 1
    late = (date(2024, 4, 1) - date(2018, 12, 31)).days + 1
    assert rows(star["hechos_asignaciones"], "ID_HechoAsignacion") == [
        (1, 1, 102, 0, Decimal("0.00"), Decimal("2.00"), Decimal("25.00")),
        (2, 1, 103, day - 1, Decimal("1.00"), Decimal("0.00"), Decimal("0.00")),
        (3, 1, 103, day, Decimal("8.00"), Decimal("10.00"), Decimal("125.00")),
        (4, 2, 103, day, Decimal("8.00"), Decimal("10.00"), Decimal("0.00")),
        (5, 2, 105, late, Decimal("1.00"), Decimal("1.00"), Decimal("0.00")),
    ]


def test_assignment_rate_lookup_when_not_extracted(x, star):
    bare = x.but(
        asignaciones=lambda: x["asignaciones"].drop("CostoPorHora"),
        empleados=lambda: x["empleados"].where("ID_Empleado = 2"),
    )
    values = facts.assignment_values(bare, star["dim_tiempo"])
    assert {r.ValorHoras for r in values.collect()} == {Decimal("0.00")}


def test_input_order_does_not_matter(spark, star):
    backwards = {name: list(reversed(table)) for name, table in WORLD.items()}
    other = star_of(spark, **backwards)
    for name in ("dim_finanzas", "dim_severidad", "dim_riesgos", "hechos_proyectos",
                 "hechos_asignaciones"):
        assert rows(other[name]) == rows(star[name]), name


def test_invariants(star):
    fact = star["hechos_proyectos"]
    wrong = fact.where(
        (F.col("DesviacionPresupuestal") + F.col("CosteReal") != F.col("PresupuestoCliente"))
        | ~F.col("PorcentajeTareasRetrasadas").between(0, 100)
        | ~F.col("PorcentajeHitosRetrasados").between(0, 100)
    )
    assert wrong.count() == 0
