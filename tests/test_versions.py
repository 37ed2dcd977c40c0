from __future__ import annotations

import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from starpipe.control.versions import Conflict, Part, Version, Versions
from starpipe.operators.gate import DuplicateKeys, Gate
from starpipe.operators.sinks import CatalogSink, ParquetSink, load_all, load_table
from tests.world import rows

CLIENTS = "ID_Cliente long, CodigoClienteReal long"
PROJECTS = "ID_Proyecto long, CodigoProyecto long, Version string, Cancelado int, ID_Cliente long"
MILESTONES = (
    "ID_Hito long, CodigoHito long, ID_proyectos long, ID_FechaInicio int, ID_FechaFinalizacion int, "
    "Retraso_days int"
)
CLIENT_KEY = ("dim_proyectos", "ID_Cliente", "dim_clientes", "ID_Cliente")
PROJECT_KEY = ("dim_hitos", "ID_proyectos", "dim_proyectos", "ID_Proyecto")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "dw")


@pytest.fixture
def clients(make):
    return lambda *ids: make([(i, i) for i in ids], CLIENTS)


def ids(sink, spark, table="dim_clientes", version=None):
    return sorted(r[0] for r in sink.read(spark, table, version).collect())


def test_versions_are_created_once(spark, root):
    versions = Versions(spark, root)
    assert versions.newest() == Version()
    assert versions._create(versions._file(1), "{}")
    assert not versions._create(versions._file(1), "other")
    assert os.listdir(f"{root}/_log") == ["0" * 11 + "1"]


def test_racing_publishers_form_one_line(spark, root):
    together = threading.Barrier(6)

    def publish(name):
        versions = Versions(spark, root)
        together.wait()
        return versions.publish(lambda base: base.appended([Part("t", name)])).number

    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(publish, "abcdef"))
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    newest = Versions(spark, root).newest()
    # Each version holds its own part and those of all before it.
    assert sorted(p.carpeta for p in newest.parts) == list("abcdef")
    assert [p.carpeta for p in newest.parts] == [
        name for _, name in sorted(zip(numbers, "abcdef"))
    ]


def test_two_loads_started_together_are_both_listed(spark, root, clients):
    frames = [clients(1, 2), clients(3)]

    def load(df):
        return load_table(df, "dim_clientes", ParquetSink(root), mode="append")

    with ThreadPoolExecutor(2) as pool:
        assert sorted(pool.map(load, frames)) == [1, 2]
    assert ids(ParquetSink(root), spark) == [1, 2, 3]
    assert Versions(spark, root).numbers() == [1, 2]


def test_a_version_that_is_read_stays_whole(spark, root, clients):
    sink = ParquetSink(root)
    load_table(clients(1), "dim_clientes", sink)
    old = Versions(spark, root).newest()
    load_table(clients(2), "dim_clientes", sink)
    assert ids(sink, spark, version=old) == [1]
    assert ids(sink, spark) == [2]


def test_a_batch_started_twice_arrives_once(spark, root, clients):
    sink = ParquetSink(root)
    load_table(clients(1), "dim_clientes", sink)
    assert load_table(clients(2), "dim_clientes", sink, mode="append", batch="monday") == 1
    assert load_table(clients(2), "dim_clientes", sink, mode="append", batch="monday") == 0
    assert load_table(clients(3), "dim_clientes", sink, mode="append", batch="tuesday") == 1
    assert ids(sink, spark) == [1, 2, 3]
    # The ledger outlives a replace, and an empty batch is entered, too.
    load_table(clients(9), "dim_clientes", sink)
    load_table(clients(), "dim_clientes", sink, mode="append", batch="wednesday")
    assert Versions(spark, root).newest().lotes == {"monday": 2, "tuesday": 3, "wednesday": 5}


def test_jobs_of_one_batch_that_race_load_it_once(spark, root, clients):
    def load(_):
        return load_table(clients(1, 2), "dim_clientes", ParquetSink(root), mode="append", batch="b")

    with ThreadPoolExecutor(2) as pool:
        assert sorted(pool.map(load, range(2))) == [0, 2]
    assert ids(ParquetSink(root), spark) == [1, 2]


def test_other_targets_keep_no_ledger(clients):
    with pytest.raises(ValueError, match="ledger"):
        load_table(clients(1), "dim_clientes", CatalogSink("dw"), batch="monday")


def test_cleaning_keeps_what_readers_hold(spark, root, clients, make):
    sink = ParquetSink(root)
    load_table(clients(1), "dim_clientes", sink)
    load_table(clients(2), "dim_clientes", sink)
    with pytest.raises(Exception, match="broken"):
        load_table(make([(1,)], "ID_Cliente long").selectExpr(
            "ID_Cliente", "raise_error('broken') as CodigoClienteReal"), "dim_clientes", sink)
    old, new = (Versions(spark, root).get(n) for n in (1, 2))
    assert sink.clean(spark, grace_seconds=3600) == []
    assert ids(sink, spark, version=old) == [1]
    time.sleep(1.1)
    gone = sink.clean(spark, grace_seconds=1)
    assert len(gone) == 2  # the superseded load's folder and the failed load's
    assert os.path.dirname(old.parts[0].carpeta) in gone
    assert ids(sink, spark) == ids(sink, spark, version=new) == [2]
    assert Versions(spark, root).numbers() == [2]
    assert sink.clean(spark, grace_seconds=1) == []
    # Numbers go on from the newest.
    load_table(clients(3), "dim_clientes", sink, mode="append")
    assert Versions(spark, root).numbers() == [2, 3]
    assert ids(sink, spark) == [2, 3]


def test_tables_of_one_load_go_one_by_one(spark, root, clients, make):
    sink = ParquetSink(root)
    levels = make([(1, "Alta")], "ID_Severidad long, Nivel string")
    load_all({"dim_clientes": clients(1), "dim_severidad": levels}, sink)
    load_table(clients(2), "dim_clientes", sink)
    time.sleep(1.1)
    gone = sink.clean(spark, grace_seconds=1)
    assert [os.path.basename(folder) for folder in gone] == ["dim_clientes"]
    assert rows(sink.read(spark, "dim_severidad")) == [(1, "Alta")]


def test_a_repeated_key_stops_the_switch(spark, root, clients):
    sink = ParquetSink(root, gate=Gate())
    load_table(clients(1), "dim_clientes", sink)
    with pytest.raises(DuplicateKeys) as error:
        load_table(clients(2, 2, 3, 3, 3), "dim_clientes", sink)
    assert error.value.report == {"dim_clientes": 2}
    with pytest.raises(DuplicateKeys):
        load_table(clients(1), "dim_clientes", sink, mode="append")
    assert ids(sink, spark) == [1]


def test_orphans_are_quarantined_with_what_hangs_on_them(spark, root, clients, make):
    projects = make([(1, 1, "1", 0, 7), (2, 2, "1", 0, 99), (3, 3, "1", 0, 0), (4, 4, "1", 0, None)], PROJECTS)
    milestones = make([(1, 1, 1, 1, 1, 0), (2, 2, 2, 1, 1, 0), (3, 3, 50, 1, 1, 0), (4, 4, 4, 1, 1, 0)], MILESTONES)
    sink = ParquetSink(root, gate=Gate(keys=(CLIENT_KEY, PROJECT_KEY)))
    tables = {"dim_hitos": milestones, "dim_proyectos": projects, "dim_clientes": clients(7)}
    loaded = load_all(tables, sink)
    assert (loaded["dim_proyectos"], loaded["dim_hitos"]) == (3, 2)
    assert sink.quarantined == {"dim_proyectos": 1, "dim_hitos": 2}
    assert ids(sink, spark, "dim_proyectos") == [1, 3, 4]
    assert ids(sink, spark, "dim_hitos") == [1, 4]
    held = spark.read.parquet(f"{root}/_quarantine/*/dim_hitos")
    assert rows(held.select("ID_Hito", "motivo")) == [(2, "ID_proyectos"), (3, "ID_proyectos")]


def test_references_reach_tables_loaded_before(spark, root, clients, make):
    sink = ParquetSink(root, gate=Gate(keys=(CLIENT_KEY,)))
    load_table(clients(7), "dim_clientes", sink)
    load_table(clients(8), "dim_clientes", sink, mode="append")
    projects = make([(1, 1, "1", 0, 7), (2, 2, "1", 0, 8), (3, 3, "1", 0, 9)], PROJECTS)
    assert load_table(projects, "dim_proyectos", sink) == 2
    strict = ParquetSink(root, gate=Gate(unknown=None, keys=(CLIENT_KEY,)))
    assert load_table(make([(5, 5, "1", 0, 0)], PROJECTS), "dim_proyectos", strict, mode="append") == 0
    assert ids(sink, spark, "dim_proyectos") == [1, 2]


def test_an_audit_that_was_overtaken_is_no_audit(spark, root, clients):
    sink = ParquetSink(root, gate=Gate())
    audit = sink._audit

    def slow(*args):
        number = audit(*args)
        load_table(clients(1), "dim_clientes", ParquetSink(root))
        return number

    sink._audit = slow
    with pytest.raises(Conflict):
        load_table(clients(1), "dim_clientes", sink, mode="append")
    assert sink.read(spark, "dim_clientes").agg(F.count("*")).first()[0] == 1
