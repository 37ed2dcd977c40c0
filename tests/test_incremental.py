from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starpipe.control.versions import Conflict
from starpipe.control.watermark import Watermark
from starpipe.operators.extract import extract_all
from starpipe.operators.sinks import conformed
from starpipe.plans.incremental import GONE, StarWarehouse, _Build, dense_days, run_incremental
from starpipe.plans.star import build_star
from starpipe.schemas import LOAD_ORDER, STAR
from starpipe.sources.readers import frame_source
from starpipe.workspace import materialise
from tests.world import WORLD, d, frames, n, rows

#: Tables whose keys are the source's own, so that they equal a star built afresh.
NATURAL = ("dim_clientes", "dim_empleados", "dim_proyectos", "dim_hitos", "dim_tareas", "dim_pruebas")


def without(relation, *keys):
    return [row for row in WORLD[relation] if row[0] not in keys]


#: Client 4's contract closes and project 104 with it, client 1's projects are opened again, and an
#: expense lies before the calendar's first day.
LATER = {
    **WORLD,
    "contratos": [*without("contratos", 10, 40), (10, 1, n("1000.00"), "Activo"), (40, 4, n("100.00"), "Cerrado")],
    "proyectos": [
        *without("proyectos", 104, 105),
        (104, 40, "cuatro", "1", d("2024-01-01"), d("2024-02-01"), "Cerrado"),
        (105, 10, "cinco", "1", d("2024-05-01"), d("2024-04-01"), "Activo"),
        (107, 40, "siete", "1", d("2024-03-01"), d("2024-04-01"), "Cancelado"),
    ],
    "gastos": [*WORLD["gastos"], (6, 104, "Viajes", "OPEX", n("5.00"), d("2017-05-01"))],
    "asignaciones": [*WORLD["asignaciones"], (7, 107, 1, n("1.00"), n("1.00"), d("2024-03-02"))],
}
CHANGED = [(104,), (105,), (107,), (999,), (None,)]


@pytest.fixture(scope="module")
def sources(spark):
    return tuple(
        frame_source({n: materialise(df, n) for n, df in frames(spark, world).items()}) for world in (WORLD, LATER)
    )


def house(spark, tmp_path_factory, name, parts=16):
    return StarWarehouse(spark, str(tmp_path_factory.mktemp(name)), parts)


@pytest.fixture(scope="module")
def merged(spark, sources, tmp_path_factory):
    found = house(spark, tmp_path_factory, "merged")
    first = found.load(sources[0])
    return found, first, found.merge(sources[1], spark.createDataFrame(CHANGED, "ID_Proyecto long"))


@pytest.fixture(scope="module")
def reloaded(spark, sources, tmp_path_factory):
    found = house(spark, tmp_path_factory, "reloaded")
    found.load(sources[0])
    found.load(sources[1])
    return found


@pytest.mark.parametrize("table", LOAD_ORDER)
def test_a_merge_equals_a_full_load(merged, reloaded, table):
    assert rows(merged[0].read(table)) == rows(reloaded.read(table))


def test_the_first_load_equals_the_star(sources, merged):
    star = build_star(extract_all(sources[0], keep=materialise), keep=materialise)
    for table in LOAD_ORDER:
        assert rows(merged[0].read(table, merged[1])) == rows(conformed(star[table], table)), table


def test_the_merged_star_equals_one_built_afresh_but_for_its_keys(sources, merged):
    found = merged[0]
    star = build_star(extract_all(sources[1], keep=materialise), keep=materialise)
    for table in NATURAL:
        assert rows(found.read(table)) == rows(conformed(star[table], table)), table
    for table, key in (("dim_finanzas", "ID_Finanza"), ("dim_tipo_riesgo", "ID_TipoRiesgo"), ("dim_severidad", "ID_Severidad")):
        assert rows(found.read(table).drop(key)) == rows(conformed(star[table], table).drop(key)), table
    calendar = found.calendar()
    dense = {k: dense_days(F.col(k), calendar) for k in ("ID_TiempoInicio", "ID_TiempoFinalizacion")}
    mine = found.read("hechos_proyectos").withColumns(dense).drop("ID_Hecho")
    assert rows(mine) == rows(conformed(star["hechos_proyectos"], "hechos_proyectos").drop("ID_Hecho"))
    hours = {"ID_FechaAsignacion": dense_days(F.col("ID_FechaAsignacion"), calendar)}
    mine = found.read("hechos_asignaciones").withColumns(hours).drop("ID_HechoAsignacion")
    assert rows(mine) == rows(conformed(star["hechos_asignaciones"], "hechos_asignaciones").drop("ID_HechoAsignacion"))


@pytest.mark.parametrize(
    ("table", "business", "key"),
    [("hechos_proyectos", ["ID_Proyecto"], "ID_Hecho"), ("dim_tiempo", ["Fecha"], "ID_Tiempo"),
     ("dim_tipo_riesgo", ["NombreTipo"], "ID_TipoRiesgo"), ("dim_severidad", ["Nivel"], "ID_Severidad")],
)
def test_old_keys_are_unchanged(merged, table, business, key):
    found, first, second = merged
    before, after = (dict((tuple(r[b] for b in business), r[key]) for r in found.read(table, v).collect()) for v in (first, second))
    assert before.keys() & after.keys()
    assert {b: k for b, k in after.items() if b in before} == {b: before[b] for b in before if b in after}
    assert len(set(after.values())) == len(after)


def test_days_before_the_first_load_count_down(merged):
    found, first, second = merged
    before = found.calendar(first)
    assert found.calendar(second).base == before.base == before.first
    early = found.read("dim_tiempo").where(F.col("Fecha") < F.lit(before.base)).agg(F.max("ID_Tiempo"), F.max("Fecha"))
    assert early.first()[0] == -1
    assert (before.base - early.first()[1]).days == 1
    assert found.read("dim_tiempo").where("ID_Tiempo = 0").count() == 0


def test_only_affected_parts_are_written(merged):
    found, first, second = merged
    kept = {p for p in first.parts if p in second.parts}
    assert {p.tabla for p in kept} >= {"dim_proyectos", "hechos_proyectos", "dim_hitos", "dim_finanzas"}
    moved = {p.parte for p in second.parts if p.tabla == "hechos_proyectos" and p not in first.parts}
    clients = found.spark.createDataFrame([(1,), (4,)], "c long")
    assert moved <= {r[0] for r in clients.select(F.pmod(F.hash("c"), F.lit(16))).collect()}


def test_projects_that_leave_have_a_tombstone(merged):
    found, _, second = merged
    assert rows(found.read(GONE)) == [(105, 1, 2)]
    assert 105 not in {r[0] for r in found.read("dim_proyectos").select("ID_Proyecto").collect()}
    assert second.number == 2


def test_no_known_change_writes_nothing(spark, sources, merged):
    found, _, second = merged
    nothing = spark.createDataFrame([(999,), (None,)], "ID_Proyecto long")
    assert found.merge(sources[1], nothing) == found.versions.newest() == second


def test_a_star_without_clients_is_loaded_whole(spark, sources, tmp_path_factory):
    """With no closed contract at all every project is known, which no single client shows."""
    opened = {**LATER, "contratos": [(i, c, v, "Activo") for i, c, v, _ in LATER["contratos"]]}
    source = frame_source(frames(spark, opened))
    found = house(spark, tmp_path_factory, "opened")
    found.load(sources[1])
    found.merge(source, spark.createDataFrame([(103,), (104,)], "ID_Proyecto long"))
    star = build_star(extract_all(source, keep=materialise), keep=materialise)
    assert rows(found.read("dim_proyectos")) == rows(conformed(star["dim_proyectos"], "dim_proyectos"))
    assert found.read("dim_clientes").count() == 0


def test_a_merge_that_was_overtaken_starts_again(spark, sources, tmp_path_factory):
    found = house(spark, tmp_path_factory, "race")
    found.load(sources[0])
    publish, calls = found.versions.publish, []

    def overtaken(change):
        calls.append(1)
        if len(calls) == 1:
            publish(lambda base: base.noted(other="load"))
        return publish(change)

    found.versions.publish = overtaken
    version = found.merge(sources[1], spark.createDataFrame(CHANGED, "ID_Proyecto long"))
    assert (len(calls), version.number, version.notes["other"]) == (2, 3, "load")
    with pytest.raises(Conflict):
        found.versions.publish(lambda base: (_ for _ in ()).throw(Conflict()))


def test_runs_by_the_watermark(spark, sources, tmp_path_factory, tmp_path):
    found, control = house(spark, tmp_path_factory, "runs"), Watermark(spark, str(tmp_path / "control"))
    assert run_incremental(sources[0], found, control, "FechaInicio").number == 1
    # Nothing starts after the instant of the first run.
    assert run_incremental(sources[1], found, control, "FechaInicio").number == 1
    control.advance("2024-02-01 00:00:00")
    version = run_incremental(sources[1], found, control, "FechaInicio", batch="monday")
    assert (version.number, version.lotes) == (2, {"monday": 2})
    assert 107 in {r[0] for r in found.read("dim_proyectos").select("ID_Proyecto").collect()}
    assert set(found.read("hechos_proyectos").columns) == set(STAR["hechos_proyectos"])


def test_parts_are_told_without_computing_the_rows_again(spark, tmp_path_factory):
    found = house(spark, tmp_path_factory, "parts", parts=4)
    build = _Build.__new__(_Build)
    build.house, build.spark, build.folder, build.parts = found, spark, f"{found.root}/_versions/x", 4
    context = spark.sparkContext
    for table, n_rows in (("some", 100), ("none", 0)):
        numbered = spark.range(n_rows).select(F.col("id"), (F.col("id") % 3).alias("_parte"))
        context.setJobGroup(f"write-{table}", "")
        numbers = build._write(table, numbered)
        jobs = context.statusTracker().getJobIdsForGroup(f"write-{table}")
        context.setLocalProperty("spark.jobGroup.id", None)
        assert sorted(numbers) == ([0, 1, 2] if n_rows else []) and len(jobs) <= 1


def test_children_carry_their_client_from_the_scope_join(spark, sources):
    plain = extract_all(sources[0], keep=materialise)
    owned = extract_all(sources[0], keep=materialise, scope=plain["proyectos"], owner="_cliente")
    owners = plain["proyectos"].select("ID_Proyecto", F.col("ID_Cliente").alias("_cliente"))
    for name in ("hitos", "tareas", "asignaciones", "pruebas", "riesgos", "gastos"):
        columns = plain[name].columns
        assert rows(owned[name].select(*columns, "_cliente")) == rows(plain[name].join(owners, "ID_Proyecto").select(*columns, "_cliente")), name
    assert rows(owned["errores"]) == rows(plain["errores"])


def test_repeated_project_numbers_meet_each_of_their_rows(spark, tmp_path_factory):
    """Owners are carried only where project numbers occur once; otherwise they are joined."""
    twice = {**WORLD, "proyectos": [*WORLD["proyectos"], *[row for row in WORLD["proyectos"] if row[0] == 101]]}
    found = house(spark, tmp_path_factory, "twice")
    found.load(frame_source({n: materialise(df, n) for n, df in frames(spark, twice).items()}))
    once = [r for r in house_rows(spark, tmp_path_factory, "dim_hitos") if r[2] == 101]
    assert [r for r in rows(found.read("dim_hitos")) if r[2] == 101] == sorted([*once, *once])


def house_rows(spark, tmp_path_factory, table):
    found = house(spark, tmp_path_factory, "once")
    found.load(frame_source({n: materialise(df, n) for n, df in frames(spark, WORLD).items()}))
    return rows(found.read(table))
