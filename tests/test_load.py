from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES
from starpipe.__main__ import arguments, main
from starpipe.control.watermark import HISTORY, INITIAL, Watermark, utc_now
from starpipe.operators import audits, dims, extract
from starpipe.operators.sinks import CatalogSink, ParquetSink, conformed, load_all, load_table
from starpipe.plans import pipeline
from starpipe.plans.star import build_star
from starpipe.schemas import LOAD_ORDER, LOAD_TIERS, SOURCE, STAR, primary_key
from starpipe.session import check_settings, sized_for
from starpipe.sources.readers import (
    catalog_source,
    folder_bytes,
    frame_source,
    parquet_source,
    partition_options,
)
from starpipe.workspace import materialise, shared_folder
from tests.world import WORLD, by_key, frames, rows


@pytest.fixture(scope="module")
def star(world):
    return build_star(extract.extract_all(world, keep=materialise), keep=materialise)


@pytest.fixture
def sink(tmp_path):
    return ParquetSink(str(tmp_path / "dw"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    table = materialise(spark.range(3), "three")
    assert table.inputFiles()[0].startswith(f"file://{shared_folder(spark)}/starpipe/")


def test_partitioning_follows_the_source_size():
    MB, TB = 1 << 20, 1 << 40
    small, large = sized_for(10 * MB), sized_for(100 * TB)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert sized_for(TB)["spark.sql.shuffle.partitions"] == "2048"
    assert large["spark.sql.shuffle.partitions"] == "204800"
    assert set(small) == set(large)


def test_folder_size_is_measured(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"12345")
    (tmp_path / "y").write_bytes(b"123")
    assert folder_bytes(spark, str(tmp_path)) == 8


def test_needed_settings_are_checked(spark):
    check_settings(spark)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        with pytest.raises(ValueError, match="skewJoin"):
            check_settings(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_replace_append_and_empty(spark, star, sink):
    clients = star["dim_clientes"]
    assert load_table(clients, "dim_clientes", sink) == 2
    assert load_table(clients, "dim_clientes", sink) == 2
    assert sink.read(spark, "dim_clientes").count() == 2
    assert load_table(clients, "dim_clientes", sink, mode="append") == 2
    assert sink.read(spark, "dim_clientes").count() == 4
    assert load_table(clients.limit(0), "dim_clientes", sink) == 0
    assert sink.read(spark, "dim_clientes").count() == 4
    assert load_table(clients.limit(1), "dim_clientes", sink) == 1
    assert sink.read(spark, "dim_clientes").count() == 1


def test_sink_types(star):
    stored = conformed(star["hechos_proyectos"], "hechos_proyectos")
    assert dict(stored.dtypes) == STAR["hechos_proyectos"]
    fact = by_key(stored, "ID_Proyecto")
    assert fact[106]["ProporcionCAPEX_OPEX"] is None  # infinite
    assert fact[103]["ProporcionCAPEX_OPEX"] == Decimal("1.50")
    assert fact[101]["ID_Finanza"] == 0
    nulled = conformed(star["hechos_proyectos"], "hechos_proyectos", zero_to_null=True)
    assert by_key(nulled, "ID_Proyecto")[101]["ID_Finanza"] is None


def test_load_all_counts_and_order(spark, star, sink):
    loaded = load_all({n: star[n] for n in LOAD_ORDER if n != "dim_pruebas"}, sink)
    assert list(loaded) == list(LOAD_ORDER)
    assert loaded["dim_pruebas"] == 0
    assert loaded["hechos_proyectos"] == 4
    assert sink.read(spark, "hechos_asignaciones").count() == 5


def test_failing_load_leaves_targets_untouched(spark, star, sink):
    load_table(star["dim_clientes"], "dim_clientes", sink)
    broken = star["dim_empleados"].selectExpr(
        "ID_Empleado", "CodigoEmpleado", "Rol", "raise_error('broken') as Seniority"
    )
    tables = {"dim_clientes": star["dim_clientes"].limit(1), "dim_empleados": broken}
    with pytest.raises(Exception, match="broken"):
        load_all(tables, sink)
    assert sink.read(spark, "dim_clientes").count() == 2


def test_catalog_sink_and_source(spark, star):
    spark.sql("CREATE DATABASE IF NOT EXISTS dw")
    sink = CatalogSink("dw")
    assert load_table(star["dim_severidad"], "dim_severidad", sink) == 2
    assert rows(sink.read(spark, "dim_severidad")) == [(1, "Alta"), (2, "Baja")]
    frames(spark, WORLD)["clientes"].write.mode("overwrite").saveAsTable("dw.clientes")
    assert catalog_source(spark, "dw")["clientes"].count() == 4


def test_jdbc_reads_are_split_by_primary_key():
    assert partition_options("gastos", 1, 900, 8) == {
        "partitionColumn": "ID_Gasto",
        "lowerBound": "1",
        "upperBound": "901",
        "numPartitions": "8",
    }


def test_missing_parquet_relation_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        parquet_source(spark, str(tmp_path))["gastos"].count()


def test_primary_keys_are_unique(star):
    assert {r.duplicadas for r in audits.duplicate_keys(star, STAR).collect()} == {0}
    assert primary_key("dim_tiempo") == "ID_Tiempo"


def test_duplicate_keys_are_found(make):
    table = make([(1, 1), (1, 2), (2, 2)], "ID_Cliente int, CodigoClienteReal int")
    assert audits.duplicate_keys({"dim_clientes": table}, ["dim_clientes"]).first().duplicadas == 1


def test_foreign_key_audit(star):
    found = {
        (r.tabla, r.columna): (r.valores, r.filas)
        for r in audits.foreign_key_audit(star).collect()
        if r.filas
    }
    # Project 102 is not in dim_proyectos, but its milestone and assignment are kept; 0 is the
    # "unknown" key; risk 1 does not exist; first expenses are no dim_finanzas keys as a rule.
    assert found == {
        ("dim_hitos", "ID_proyectos"): (1, 1),
        ("dim_riesgos", "ID_TipoRiesgo"): (1, 1),
        ("dim_riesgos", "ID_Severidad"): (1, 1),
        ("hechos_asignaciones", "ID_Proyecto"): (1, 1),
        ("hechos_asignaciones", "ID_FechaAsignacion"): (1, 1),
        ("hechos_proyectos", "ID_TiempoInicio"): (1, 1),
        ("hechos_proyectos", "ID_TiempoFinalizacion"): (1, 1),
        ("hechos_proyectos", "ID_Riesgo"): (1, 2),
        ("hechos_proyectos", "ID_Finanza"): (1, 2),
    }


def test_count_audits(world, star):
    x = extract.extract_all(world)
    assert rows(audits.row_counts(x, ["gastos", "hitos"])) == [("gastos", 4), ("hitos", 4)]
    dropped = audits.dropped_by(x["proyectos"], star["dim_proyectos"], "dim_proyectos")
    assert rows(dropped) == [("dim_proyectos", 5, 4, 1)]
    assert audits.unmatched_dates(star["hechos_asignaciones"]).first().sin_fecha == 1


def test_dropped_tests_are_counted_in_one_pass(world):
    x = extract.extract_all(world)
    for milestones in (x["hitos"], x["hitos"].where("ID_Hito > 1"), x["hitos"].where("ID_Hito < 0")):
        t = x.but(hitos=lambda: milestones)
        marked = audits.dropped_unless(dims.marked_tests(t, "known"), "known", "dim_pruebas")
        assert rows(marked) == rows(audits.dropped_by(t["pruebas"], dims.dim_pruebas(t), "dim_pruebas"))
        assert marked.dtypes == [("tabla", "string"), ("antes", "bigint"), ("despues", "bigint"), ("filtradas", "bigint")]


def test_an_empty_extract_drops_no_tests(world):
    x = extract.extract_all(world)
    none = x.but(pruebas=lambda: x["pruebas"].where("false"))
    assert rows(audits.dropped_unless(dims.marked_tests(none, "known"), "known", "dim_pruebas")) == [("dim_pruebas", 0, 0, 0)]


@pytest.mark.parametrize("name", ["a17_dropped_tests", "a17_dropped_tests_unknown"])
def test_audit_of_tests_reads_and_joins_the_tests_once(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("__position:bigint") == 1 and "Union" not in plan
    # The milestones come from their written copy.
    assert "l_shipdate" not in plan and "o_orderstatus" not in plan


def test_watermark(spark, tmp_path):
    control = Watermark(spark, str(tmp_path / "control"))
    assert control.current() == INITIAL
    assert control.history().count() == 0
    for i in range(12):
        control.advance(f"2024-01-{i + 1:02d} 00:00:00")
    assert control.current() == "2024-01-12 00:00:00"
    history = control.history().collect()
    assert len(history) == HISTORY
    assert history[0].previous_date == "2024-01-11 00:00:00"
    control.reset()
    assert control.current() == INITIAL
    assert control.history().count() == HISTORY
    assert control.status().first().last_extraction == INITIAL


def test_run_loads_and_then_moves_the_watermark(spark, world, sink, tmp_path):
    control = Watermark(spark, str(tmp_path / "control"))
    before = utc_now()
    run = pipeline.run_pipeline(world, sink, control)
    assert set(run.extracted) == set(SOURCE) and run.extracted["proyectos"] == 5
    assert run.loaded["dim_proyectos"] == 4
    assert before <= control.current() <= utc_now()
    assert run.preview()["dim_tiempo"].count() == 3
    assert rows(sink.read(spark, "dim_proyectos")) == rows(run.star["dim_proyectos"])


def test_watermark_is_the_instant_before_the_first_read(spark, world, sink, tmp_path, monkeypatch):
    """Rows changed while a run takes its time lie after the watermark."""
    control, instants = Watermark(spark, str(tmp_path / "control")), iter(["2024-05-01 10:00:00"])
    monkeypatch.setattr(pipeline, "utc_now", lambda: next(instants))
    pipeline.run_pipeline(world, sink, control)
    assert control.current() == "2024-05-01 10:00:00"


def test_run_without_load_keeps_the_watermark(spark, world, tmp_path):
    control = Watermark(spark, str(tmp_path / "control"))
    assert pipeline.run_extract_transform(world, control=control) is not None
    assert control.current() == INITIAL


def test_load_refuses_a_restricted_extraction(spark, world, sink, tmp_path):
    control = Watermark(spark, str(tmp_path / "control"))
    with pytest.raises(ValueError, match="lose"):
        pipeline.run_pipeline(world, sink, control, changed_column="FechaFin")


def test_options_reach_extraction_and_sink(spark, sink):
    shouting = frames(spark, WORLD)
    for name in ("contratos", "proyectos"):
        shouting[name] = shouting[name].withColumn("Estado", F.upper("Estado"))
    run = pipeline.run_pipeline(
        frame_source(shouting), sink, collation="UNICODE_CI_AI", stamp=True, zero_to_null=True
    )
    assert all("fecha_extraccion" in run.extracts[name].columns for name in SOURCE)
    assert by_key(sink.read(spark, "hechos_proyectos"), "ID_Proyecto")[101]["ID_Finanza"] is None
    assert run.loaded["hechos_proyectos"] == 4


@pytest.mark.parametrize("tier", [0, 1, 2])
def test_failure_in_any_tier_leaves_the_old_star(spark, star, sink, tier):
    tables = {name: star[name] for name in LOAD_ORDER}
    load_all(tables, sink)
    broken = LOAD_TIERS[tier][0]
    fails = star[broken].withColumn(star[broken].columns[-1], F.raise_error(F.lit("broken")))
    shorter = {name: df.limit(1) for name, df in tables.items()}
    with pytest.raises(Exception, match="broken"):
        load_all({**shorter, broken: fails}, sink)
    assert sink.read(spark, "hechos_proyectos").count() == 4
    assert sink.read(spark, "dim_clientes").count() == 2


def test_huge_ratio_loads_and_is_counted(star):
    fact = star["hechos_proyectos"].withColumn("ProporcionCAPEX_OPEX", F.lit(1e12))
    stored = conformed(fact, "hechos_proyectos")
    assert stored.where("ProporcionCAPEX_OPEX IS NULL").count() == 4
    assert audits.unstorable(fact, stored, "ProporcionCAPEX_OPEX").first().valores == 4


def test_failed_run_keeps_the_watermark(spark, world, tmp_path):
    class Broken(ParquetSink):
        def load(self, tables, tiers, mode):
            raise OSError("disk full")

    control = Watermark(spark, str(tmp_path / "control"))
    with pytest.raises(OSError):
        pipeline.run_pipeline(world, Broken(str(tmp_path)), control)
    assert control.current() == INITIAL


def test_full_runs_do_not_move_the_watermark(spark, world, sink, tmp_path):
    control = Watermark(spark, str(tmp_path / "control"))
    control.advance("2024-01-01 00:00:00")
    run = pipeline.run_full_load(world)
    assert run.loaded == {}
    pipeline.reset_and_run(world, control, sink, load=True)
    assert control.current() == INITIAL
    assert sink.read(spark, "dim_clientes").count() == 2


def test_incremental_run_uses_the_watermark(spark, world, tmp_path):
    control = Watermark(spark, str(tmp_path / "control"))
    control.advance("2024-02-15 00:00:00")
    run = pipeline.run_pipeline(world, control=control, load=False, changed_column="FechaFin")
    assert run.extracted["proyectos"] == 2


def test_nothing_in_scope(spark):
    source = frame_source(frames(spark, {**WORLD, "contratos": []}))
    assert pipeline.run_extract_transform(source) is None
    with pytest.raises(ValueError):
        pipeline.run_pipeline(source)


def test_job_flags(spark, tmp_path, capsys, monkeypatch):
    for name, df in frames(spark, WORLD).items():
        df.write.parquet(str(tmp_path / "src" / name))
    folders = ["--source", str(tmp_path / "src"), "--target", str(tmp_path / "dw"),
               "--control", str(tmp_path / "control")]
    sizes, cleared = [], []
    monkeypatch.setattr("starpipe.__main__.build_session", lambda **_: spark)
    monkeypatch.setattr("starpipe.__main__.resize", lambda _, size: sizes.append(size))
    monkeypatch.setattr("starpipe.__main__.clear_run", cleared.append)
    main([*folders, "--full-load"])
    assert "hechos_proyectos: 4" in capsys.readouterr().out
    assert sizes[0] > 0 and len(cleared) == 1
    main([*folders, "--status"])
    assert INITIAL in capsys.readouterr().out
    with pytest.raises(SystemExit):
        arguments([*folders, "--full", "--reset"])
