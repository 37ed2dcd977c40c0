"""Twelve small source relations in which every rule has a case, and their comments."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from starpipe.schemas import SOURCE, ddl


def d(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def n(text: str | None) -> Decimal | None:
    return Decimal(text) if text is not None else None


WORLD = {
    "clientes": [(1, "Ana"), (2, "Beto"), (3, "Cora"), (4, "Dora")],
    "empleados": [
        (1, "Eva", "\tDev ", None, n("12.50")),
        (2, "Fito", "QA", " Senior ", None),  # no rate
        (3, "Gil", "PM", "Junior", n("9.00")),  # only outside the scope
    ],
    "contratos": [
        (10, 1, n("1000.00"), "Cerrado"),
        (11, 1, n("500.00"), "Activo"),
        (20, 2, n("800.00"), "Activo"),  # its client has no closed contract
        (30, 3, n("1000.00"), "Cancelado"),
        (40, 4, n("100.00"), "Activo"),
    ],
    "proyectos": [
        (101, 11, "uno", None, d("2024-01-01"), None, "Cerrado"),  # by project, never finished
        (102, 20, "dos", "2.0", d("2024-01-01"), d("2024-01-31"), "Cerrado"),  # client lost
        (103, 30, "tres", " 3.1 ", d("2024-01-01"), d("2024-03-01"), "Activo"),  # by contract
        (104, 40, "cuatro", "1", d("2024-01-01"), d("2024-02-01"), "Activo"),  # out of scope
        (105, 10, "cinco", "1", d("2024-05-01"), d("2024-04-01"), "Cancelado"),  # ends early
        (106, 30, "seis", "1", d("2024-01-01"), d("2024-02-01"), "Activo"),  # shares contract
    ],
    "hitos": [
        (1, 103, "h1", "x", d("2024-01-01"), d("2024-02-01"), None),
        (2, 103, "h2", "x", d("2024-01-01"), d("2024-02-10"), d("2024-02-20")),
        (3, 106, "h3", "x", d("2018-12-31"), d("2024-01-15"), None),
        (4, 102, "h4", "x", None, d("2024-01-15"), d("2024-01-10")),
        (5, 104, "h5", "x", d("2030-01-01"), d("2030-01-15"), d("2030-01-10")),
    ],
    "tareas": [
        (1, 1, "t1", None, "x", None, 5),
        (2, 1, "t2", None, "x", 3, None),
        (3, 2, "t3", None, "x", 3, 5),
        (4, 2, "t4", None, "x", 7, 7),
        (5, 5, "t5", None, "x", 1, 9),
        (6, 4, "t6", None, "x", 1, 2),
    ],
    "asignaciones": [
        (1, 103, 1, n("8.00"), n("10.00"), d("2024-01-02")),
        (2, 103, 2, n("8.00"), n("10.00"), d("2024-01-02")),
        (3, 102, 1, None, n("2.00"), None),
        (4, 104, 3, n("1.00"), n("1.00"), d("2031-01-02")),
        (5, 103, 1, n("1.00"), None, d("2024-01-01")),
        (6, 105, 2, n("1.00"), n("1.00"), d("2024-04-01")),
    ],
    "pruebas": [
        (1, 1, " Unitarias ", d("2024-01-05"), None),
        (2, 2, "Unitarias", d("2024-01-06"), 1),
        (3, 4, "Aceptacion", d("2024-01-06"), 0),
        (4, 5, "Aceptacion", d("2024-01-06"), 1),
    ],
    "errores": [
        (1, 1, "a", None, d("2024-01-05")),
        (2, 1, "b", None, d("2024-01-05")),
        (3, 3, "b", None, None),
        (4, 5, "b", None, d("2024-01-05")),
    ],
    "riesgos": [
        (7, 106, " Operativo", "Alta", None, d("2024-01-09")),
        (6, 106, "Tecnico", "Baja", None, d("2024-01-08")),
        (5, 103, "Tecnico", "Alta", None, d("2024-01-01")),
        (4, 103, None, None, None, d("2024-01-02")),
        (1, 104, "Financiero", "Critica", None, d("2020-01-01")),
    ],
    "gastos": [
        (2, 103, "Materiales", "capex", n("300.00"), d("2024-01-05")),
        (1, 103, "PENALIZACIONES", "OPEX", n("200.00"), d("2024-01-05")),  # same day, lower id
        (3, 106, "Penalización", "Capex", n("10.00"), d("2024-01-05")),  # accent, only CAPEX
        (4, 104, "Materiales", "OPEX", n("1.00"), d("2024-01-05")),
        (5, 102, " Salarios ", None, n("7.00"), d("2024-01-02")),
    ],
    "penalizaciones": [
        (1, 30, n("50.00"), "m", d("2024-02-02")),
        (2, 40, n("99.00"), "m", d("2024-02-02")),  # open contract
        (3, 11, n("77.00"), "m", d("2024-02-02")),  # open contract of a project in scope
    ],
}


def frames(spark, world):
    return {
        name: spark.createDataFrame(rows, ddl(SOURCE[name])).repartition(2)
        for name, rows in world.items()
    }


def rows(df, *order):
    """Rows as plain tuples, sorted by the given columns or by everything."""
    plain = [tuple(r) for r in df.collect()]
    if order:
        at = [df.columns.index(c) for c in order]
        return sorted(plain, key=lambda r: [r[i] for i in at])
    return sorted(plain, key=lambda r: [(v is not None, str(v)) for v in r])


def by_key(df, key):
    """key value -> row as dict."""
    return {r[key]: r.asDict() for r in df.collect()}
