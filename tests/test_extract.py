from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starpipe.operators import extract
from starpipe.sources.readers import frame_source
from tests.world import WORLD, by_key, d, frames, rows


@pytest.fixture(scope="module")
def x(world):
    return extract.extract_all(world, as_of=F.lit("2024-03-01").cast("date"))


def ids(df, key):
    return sorted(r[0] for r in df.select(key).collect())


def test_scope_and_reason(x):
    reason = {k: r["razon_inclusion"] for k, r in by_key(x["proyectos"], "ID_Proyecto").items()}
    assert reason == {
        101: "Por proyecto",
        102: "Por proyecto",
        103: "Por contrato",
        105: "Por proyecto",  # project and contract are both closed: the project wins
        106: "Por contrato",
    }


def test_contract_scoped_relations(x):
    assert ids(x["contratos"], "ID_Contrato") == [10, 30]
    assert ids(x["clientes"], "ID_Cliente") == [1, 3]
    assert rows(x["penalizaciones"].select("ID_Penalizacion", "ID_Cliente")) == [(1, 3)]


def test_children_follow_their_project(x):
    assert ids(x["hitos"], "ID_Hito") == [1, 2, 3, 4]
    assert ids(x["tareas"], "ID_Tarea") == [1, 2, 3, 4, 6]
    assert ids(x["pruebas"], "ID_Prueba") == [1, 2, 3]
    assert rows(x["errores"].select("ID_Error", "ID_Hito", "ID_Proyecto")) == [
        (1, 1, 103), (2, 1, 103), (3, 2, 103),
    ]
    assert ids(x["riesgos"], "ID_Riesgo") == [4, 5, 6, 7]
    assert ids(x["gastos"], "ID_Gasto") == [1, 2, 3, 5]
    assert ids(x["empleados"], "ID_Empleado") == [1, 2]


def test_derived_columns(x):
    late = {k: r["dias_retraso"] for k, r in by_key(x["hitos"], "ID_Hito").items()}
    assert late == {1: 29, 2: 10, 3: 46, 4: -5}
    deviation = {k: r["desviacion_duracion"] for k, r in by_key(x["tareas"], "ID_Tarea").items()}
    assert deviation == {1: 5, 2: -3, 3: 2, 4: 0, 6: 1}
    cost = by_key(x["asignaciones"], "ID_Asignacion")
    assert cost[1]["costo_real_horas"] == Decimal("125.00")
    assert cost[1]["costo_planificado_horas"] == Decimal("100.00")
    assert cost[2]["costo_real_horas"] is None
    assert cost[3]["costo_planificado_horas"] is None


def test_collation_widens_the_state_filter(spark):
    shouting = {**WORLD, "contratos": [(k, c, v, s.upper()) for k, c, v, s in WORLD["contratos"]]}
    source = frame_source(frames(spark, shouting))
    assert extract.extract_all(source)["contratos"].count() == 0
    found = extract.extract_all(source, collation="UNICODE_CI_AI")["contratos"]
    assert ids(found, "ID_Contrato") == [10, 30]


def test_incremental_restricts_projects_only_when_asked(world):
    recent = extract.extract_all(world, since=("FechaFin", "2024-02-15 00:00:00"))
    assert ids(recent["proyectos"], "ID_Proyecto") == [103, 105]
    assert ids(recent["gastos"], "ID_Gasto") == [1, 2]


def test_stamp_and_order(x):
    stamped = extract.stamped(x["contratos"])
    assert dict(stamped.dtypes)["fecha_extraccion"] == "timestamp"
    ordered = extract.in_extraction_order("gastos", x["gastos"]).collect()
    assert [r.ID_Gasto for r in ordered] == [5, 1, 2, 3]


def test_missing_relation_is_an_error(world):
    with pytest.raises(KeyError):
        world["facturas"]


def test_open_milestones_are_late_until_today(world):
    today = extract.extract_all(world)["hitos"].where("ID_Hito = 1").first()
    assert today.dias_retraso > 29 and today.FechaFinPlanificada == d("2024-02-01")
