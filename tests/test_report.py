from collections import Counter

from pyspark.sql import functions as F

from starpipe.control.report import EXTRACT, LOAD, LOSS, ROWS, RunReport
from starpipe.operators import audits, facts
from starpipe.operators.extract import extract_all
from starpipe.operators.sinks import ParquetSink
from starpipe.plans.pipeline import run_extract_transform, run_pipeline
from starpipe.plans.star import build_star
from starpipe.schemas import LOAD_ORDER, SOURCE
from starpipe.workspace import materialise
from tests.world import rows


def test_counts_are_those_of_the_written_tables(spark, world, tmp_path):
    sink = ParquetSink(str(tmp_path / "dw"))
    run = run_pipeline(world, sink)
    found = {(stage, table, measure): n for stage, table, measure, n in run.report.entries()}
    assert run.extracted == {name: run.extracts[name].count() for name in SOURCE}
    for name in SOURCE:
        assert found[EXTRACT, name, ROWS] == run.extracted[name]
    for name in LOAD_ORDER:
        assert found[LOAD, name, ROWS] == run.loaded[name]
        assert not run.loaded[name] or sink.read(spark, name).count() == run.loaded[name]
    dropped = audits.dropped_by(run.extracts["proyectos"], run.star["dim_proyectos"], "dim_proyectos").first()
    assert found[LOSS, "dim_proyectos", ROWS] == dropped["filtradas"] > 0
    assert found[LOSS, "dim_finanzas", ROWS] == 0
    undated = audits.unmatched_dates(run.star["hechos_asignaciones"]).first()["sin_fecha"]
    assert found[LOAD, "hechos_asignaciones", "sin_fecha"] == undated > 0
    assert run.report.frame(spark).count() == len(found)


def test_without_a_load_there_are_extracts_only(world):
    entries = run_extract_transform(world).report.entries()
    assert {stage for stage, *_ in entries} == {EXTRACT} and len(entries) == len(SOURCE)


def test_counts_need_no_job_of_their_own(spark, make):
    report = RunReport()
    seen = []
    frame = make([(1,), (2,), (None,)], "n int")

    def write(df, name):
        # One job, the write; the observed frame is what it writes.
        seen.append(df.collect())
        return frame

    assert report.keep("x", write)(frame, "t") is frame
    assert report.rows("x", ["t", "other"]) == {"t": 3, "other": 0} and len(seen) == 1


def test_measures_and_empty_tables(make, tmp_path):
    report = RunReport()
    for rows, name in (([(0,), (3,)], "some"), ([], "none")):
        frame = report.observed(make(rows, "n int"), "x", name, zeros=F.count_if(F.col("n") == 0))
        assert report.rows("x", [name]) == {name: 0}
        frame.write.parquet(str(tmp_path / name))
        report.written("x", name)
    report.written("x", "never observed")
    assert report.entries() == [("x", "none", "filas", 0), ("x", "none", "zeros", 0), ("x", "some", "filas", 2), ("x", "some", "zeros", 1)]


def test_a_run_reads_each_child_for_its_scope_once(world, tmp_path):
    """Employees come from the extracted assignments, not from a second scope join of all of them."""
    asked = Counter()

    class Asked(dict):
        def __getitem__(self, name):
            asked[name] += 1
            return super().__getitem__(name)

    run = run_pipeline(Asked(world.items()), ParquetSink(str(tmp_path / "dw")))
    assert run.extracted["empleados"] and asked["asignaciones"] == 1


def test_projects_are_put_in_order_before_they_have_measures(world, monkeypatch):
    numbered = {}
    dense_id = facts.dense_id
    monkeypatch.setattr(facts, "dense_id", lambda df, order, name, *a, **b: numbered.update({name: df.columns}) or dense_id(df, order, name, *a, **b))
    x = extract_all(world, keep=materialise)
    star = build_star(x, keep=materialise)
    fact = star["hechos_proyectos"]
    assert set(numbered["ID_Hecho"]) == {*facts.PROJECT_COLUMNS, "__known"}
    # The same rows as with a rollup of unnumbered projects.
    plain = facts.hechos_proyectos(x, materialise(facts.project_rollup(x), "rollup"), star["dim_tiempo"])
    assert rows(fact.select(*plain.columns)) == rows(plain)
