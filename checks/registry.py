"""One query per operator of the pipeline, over whole given tables.

The given order-processing tables are read as the twelve source relations
(``starpipe.sources.order_system``); each query then runs one operator on them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.functions import columns as C
from starpipe.functions.keys import dense_id
from starpipe.functions.lookups import lookup, semi_if_any
from starpipe.operators import analytics, audits, dims, extract, facts
from starpipe.operators.gate import Gate
from starpipe.operators.sinks import ParquetSink, conformed, load_all, load_table
from starpipe.plans.incremental import StarWarehouse, dense_days
from starpipe.plans.pipeline import reset_and_run, run_pipeline
from starpipe.plans.star import build_star, keep_inputs
from starpipe.schemas import FOREIGN_KEYS, LOAD_ORDER, SOURCE, STAR
from starpipe.sources.order_system import order_system
from starpipe.sources.readers import parquet_source
from starpipe.sources.tables import Tables
from starpipe.control.watermark import Watermark
from starpipe.workspace import materialise, new_path

# Day against which unfinished milestones are late, and shift that moves the given dates
# (1995-2001) to both sides of the calendar's fixed limits.
AS_OF = "2002-01-01"
RECENT = 9000


class Context:
    """Source, extracts and star over one folder, all lazy.

    ``staged``: write what the star reads of each extract once; for queries that use most of the
    star. Otherwise every query reads straight from the source what it needs.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        shift_days: int = 0,
        staged: bool = False,
        collation: str | None = None,
        **star_options,
    ):
        self.spark = spark
        self.src = order_system(spark, sf_dir, shift_days)
        if collation:
            # States in another case, which only the collation still recognises.
            shouting = {
                name: (lambda df=self.src[name]: df.withColumn("Estado", F.upper("Estado")))
                for name in ("contratos", "proyectos")
            }
            self.src = Tables({name: (lambda n=name, s=self.src: s[n]) for name in SOURCE}).but(**shouting)
        self.x = extract.extract_all(
            self.src, as_of=F.lit(AS_OF).cast("date"), collation=collation,
            keep=keep_inputs if staged else None,
        )
        self.u = self.x if staged else extract.unscoped_children(self.src, self.x)
        self.star = build_star(self.x, fact_inputs=self.u, keep=materialise if staged else None, **star_options)

    def measures(self, *names: str) -> DataFrame:
        """Project measures, from just the relations they need."""
        dated = {"ID_TiempoInicio", "ID_TiempoFinalizacion"} & set(names)
        calendar = self.star["dim_tiempo"] if dated else None
        return facts.measured_projects(self.u, names, calendar)

    @cached_property
    def values(self) -> DataFrame:
        return facts.assignment_values(self.x, self.star["dim_tiempo"])


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str, **options):
    def register(build: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Context(spark, sf_dir, **options))
        return build

    return register


# Sources and extraction ---------------------------------------------------------------------


@query("s1_scan")
def _scan(c):
    root = new_path(c.spark, "source")
    c.src["gastos"].write.parquet(f"{root}/gastos")
    return parquet_source(c.spark, root)["gastos"]


for _n, _name in enumerate(SOURCE, 1):
    query(f"x{_n:02d}_{_name}")(lambda c, name=_name: c.x[name])


@query("s2_extract_counts", staged=True)
def _extract_counts(c):
    return audits.row_counts(c.x, SOURCE)


@query("s3_stamped")
def _stamped(c):
    stamped = extract.extract_all(c.src, as_of=F.lit(AS_OF).cast("date"), stamp=True)
    marks = {n: df.where(F.col("fecha_extraccion").isNotNull()) for n, df in stamped.items()}
    return audits.row_counts(marks, SOURCE)


# Projections and predicates -----------------------------------------------------------------


@query("f1_state_filter")
def _state_filter(c):
    return c.src["contratos"].where(C.is_closed(F.col("Estado"))).select("ID_Contrato", "Estado")


@query("f1_state_filter_collated")
def _state_filter_collated(c):
    shouting = c.src["contratos"].withColumn("Estado", F.upper("Estado"))
    return shouting.where(C.is_closed(F.col("Estado"), "UNICODE_CI_AI")).select(
        "ID_Contrato", "Estado"
    )


@query("f2_scope")
def _scope(c):
    return c.x["proyectos"].select("ID_Proyecto", "ID_Contrato", "EstadoProyecto", "EstadoContrato")


@query("f3_target_columns")
def _target_columns(c):
    return conformed(c.star["dim_empleados"], "dim_empleados")


@query("f4_renamed")
def _renamed(c):
    return c.x["hitos"].select("ID_Hito", F.col("ID_Proyecto").alias("ID_proyectos"))


@query("f5_business_code")
def _business_code(c):
    return c.star["dim_pruebas"].select("ID_Prueba", "CodigoPrueba")


@query("f6_not_null")
def _not_null(c):
    return c.src["riesgos"].where(F.col("TipoRiesgo").isNotNull()).select("ID_Riesgo", "TipoRiesgo")


@query("f7_upper_equals")
def _upper_equals(c):
    category = F.col("Categoria")
    return c.src["gastos"].select(
        "ID_Gasto",
        C.flag(C.equals_upper(category, C.CAPEX)).alias("capex"),
        C.flag(C.equals_upper(category, C.OPEX)).alias("opex"),
    )


@query("f8_contains")
def _contains(c):
    return c.src["gastos"].select(
        "ID_Gasto", C.flag(C.is_penalty(F.col("TipoGasto"))).alias("penalizacion")
    )


# Joins --------------------------------------------------------------------------------------


@query("j1_inner_chain")
def _inner_chain(c):
    owners = extract.milestone_projects(c.src["hitos"], c.x["proyectos"])
    return c.src["tareas"].join(owners, "ID_Hito").select("ID_Tarea", "ID_Hito", "ID_Proyecto")


@query("j2_semi")
def _semi(c):
    return extract.scoped(c.src["gastos"], c.x["proyectos"]).select("ID_Gasto", "ID_Proyecto")


@query("j3_semi_if_any")
def _semi_if_any(c):
    return semi_if_any(c.x["proyectos"], c.x["clientes"], "ID_Cliente").select(
        "ID_Proyecto", "ID_Cliente"
    )


@query("j3_semi_if_none")
def _semi_if_none(c):
    nobody = c.x["clientes"].where(F.col("NombreCliente").isNull())
    return semi_if_any(c.x["proyectos"], nobody, "ID_Cliente").select("ID_Proyecto", "ID_Cliente")


@query("j4_lookup_rate")
def _lookup_rate(c):
    return lookup(
        c.src["asignaciones"].select("ID_Asignacion", "ID_Empleado"),
        c.src["empleados"],
        "ID_Empleado",
        "ID_Empleado",
        "CostoPorHora",
        "tarifa",
    )


@query("j4_lookup_date", shift_days=RECENT)
def _lookup_date(c):
    return c.src["asignaciones"].select(
        "ID_Asignacion",
        dims.calendar_key(F.col("FechaAsignacion"), c.star["dim_tiempo"]).alias("ID_Tiempo"),
    )


@query("j5_children_of_project")
def _children_of_project(c):
    rollup = facts.project_rollup(c.u, ("staff", "schedule"))
    return dims.known_projects(rollup, c.x).select("ID_Proyecto", "milestones", "tasks", "staff")


# Project measures ---------------------------------------------------------------------------

_MEASURES = {
    "a01_duracion": ("DuracionRealDias",),
    "a02_retraso": ("RetrasoDias",),
    "a03_claves_tiempo": ("ID_TiempoInicio", "ID_TiempoFinalizacion"),
    "a04_presupuesto": ("PresupuestoCliente",),
    "a05_coste": ("CosteReal",),
    "a06_desviacion": ("DesviacionPresupuestal",),
    "a07_primer_gasto": ("ID_Finanza",),
    "a08_penalizaciones": ("PenalizacionesMonto",),
    "a09_capex_opex": ("ProporcionCAPEX_OPEX",),
    "a10_riesgo": ("ID_Riesgo",),
    "a11_defectos": ("NumeroDefectosEncontrados",),
    "a12_productividad": ("ProductividadPromedio",),
    "a13_tareas": ("PorcentajeTareasRetrasadas",),
    "a14_hitos": ("PorcentajeHitosRetrasados",),
}

for _name, _columns in _MEASURES.items():
    query(_name)(lambda c, columns=_columns: c.measures(*columns))


@query("a15_distinct_dates")
def _distinct_dates(c):
    return dims.observed_dates(c.x)


@query("a15_distinct_levels")
def _distinct_levels(c):
    return c.x["riesgos"].select("Severidad").where(F.col("Severidad").isNotNull()).distinct()


@query("a16_date_span")
def _date_span(c):
    return dims.calendar_span(c.u).select(
        F.col("first").alias("primera"), F.col("last").alias("ultima")
    )


@query("a17_counts", staged=True)
def _counts(c):
    return audits.row_counts(c.star, LOAD_ORDER)


@query("a17_dropped_projects")
def _dropped_projects(c):
    return audits.dropped_by(c.x["proyectos"], c.star["dim_proyectos"], "dim_proyectos")


def _tests_over_written_milestones(c) -> Tables:
    """Extracts whose milestones are written: the tests and the audit both meet them."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        return materialise(df.select("ID_Hito", "ID_Proyecto", "FechaFinReal"), name) if name == "hitos" else df

    return extract.extract_all(c.src, as_of=F.lit(AS_OF).cast("date"), keep=keep)


@query("a17_dropped_tests")
def _dropped_tests(c):
    x = _tests_over_written_milestones(c)
    return audits.dropped_unless(dims.marked_tests(x, "known"), "known", "dim_pruebas")


@query("a17_dropped_tests_unknown")
def _dropped_tests_unknown(c):
    # Milestones that are not finished are missing.
    x = _tests_over_written_milestones(c)
    partial = x.but(hitos=lambda: x["hitos"].where(F.col("FechaFinReal").isNotNull()))
    return audits.dropped_unless(dims.marked_tests(partial, "known"), "known", "dim_pruebas")


@query("a17_unstorable_ratios")
def _unstorable_ratios(c):
    facts_table = c.star["hechos_proyectos"]
    stored = conformed(facts_table, "hechos_proyectos")
    return audits.unstorable(facts_table, stored, "ProporcionCAPEX_OPEX")


@query("a17_unmatched_dates")
def _unmatched_dates(c):
    return audits.unmatched_dates(c.values)


# Keys, order, set operations ----------------------------------------------------------------


@query("w1_dense_id")
def _dense_id(c):
    rows = c.src["gastos"].select("ID_Gasto", "Fecha")
    return dense_id(rows, ["Fecha", "ID_Gasto"], "orden")


@query("w2_first_seen")
def _first_seen(c):
    return dims.risk_types(c.x)


@query("w3_first_in_group")
def _first_in_group(c):
    return facts.first_risks(c.x["riesgos"]).select(
        "ID_Proyecto", F.col("first_risk").alias("ID_Riesgo")
    )


@query("o1_extraction_order")
def _extraction_order(c):
    return extract.in_extraction_order("gastos", c.x["gastos"])


@query("o2_sorted_dates")
def _sorted_dates(c):
    return dims.observed_dates(c.x).orderBy("Fecha")


@query("o3_preview")
def _preview(c):
    return c.star["dim_proyectos"].orderBy("ID_Proyecto").limit(3)


@query("u1_union_finanzas")
def _union_finanzas(c):
    return dims.finance_rows(c.x).select("origin", "entry", "TipoGasto", "Categoria", "Monto")


@query("u2_union_dates")
def _union_dates(c):
    return dims.observed_dates(c.src)


@query("u3_merged_names")
def _merged_names(c):
    merged = c.x.but(**{name: (lambda n=name: c.star[n]) for name in c.star})
    return audits.row_counts(merged, ("proyectos", "dim_proyectos", "dim_tiempo"))


# Scalar functions ---------------------------------------------------------------------------


@query("c01_strip")
def _strip(c):
    return c.src["empleados"].select("ID_Empleado", C.strip(F.col("Rol")).alias("Rol"))


@query("c02_case")
def _case(c):
    kind = F.col("TipoGasto")
    return c.src["gastos"].select(
        "ID_Gasto", F.upper(kind).alias("mayusculas"), F.lower(kind).alias("minusculas")
    )


@query("c03_defaults")
def _defaults(c):
    return c.src["proyectos"].select(
        "ID_Proyecto", C.text_or(F.col("Version"), C.DEFAULT_VERSION).alias("Version")
    )


@query("c04_null_text")
def _null_text(c):
    return c.src["gastos"].select(
        "ID_Gasto",
        C.text_or(F.col("Categoria"), C.UNSPECIFIED).alias("categoria"),
        C.text_or(F.col("Categoria"), "None").alias("categoria_texto"),
    )


@query("c05_safe_number")
def _safe_number(c):
    # A role and a version are no numbers: they become 0 instead of an error.
    return c.src["proyectos"].select(
        "ID_Proyecto",
        C.number_or_zero(F.col("Version"), "int").alias("version"),
        C.number_or_zero(F.col("ID_Contrato").cast("string"), "bigint").alias("contrato"),
    )


@query("c06_safe_date")
def _safe_date(c):
    return c.src["proyectos"].select(
        "ID_Proyecto",
        C.safe_date(F.col("NombreProyecto")).alias("nombre"),
        C.safe_date(F.col("FechaInicio").cast("string")).alias("inicio"),
    )


@query("c07_days_between")
def _days_between(c):
    return c.src["hitos"].select(
        "ID_Hito",
        C.days_between(F.col("FechaFinReal"), F.col("FechaFinPlanificada")).alias("dias"),
    )


@query("c08_fixed_base_key", shift_days=RECENT)
def _fixed_base_key(c):
    return c.src["proyectos"].select(
        "ID_Proyecto",
        C.fixed_base_key(F.col("FechaInicio")).alias("inicio"),
        C.fixed_base_key(F.date_sub("FechaInicio", 700)).alias("antes"),
    )


@query("c09_calendar_parts")
def _calendar_parts(c):
    day = F.col("FechaInicio")
    return c.src["proyectos"].select(
        "ID_Proyecto",
        C.weekday_key(day).alias("dia"),
        F.month(day).alias("mes"),
        C.year_key(day).alias("anio"),
    )


@query("c10_daily_series")
def _daily_series(c):
    return c.star["dim_tiempo"].select("Fecha")


@query("c11_flags")
def _flags(c):
    return c.x["proyectos"].select(
        "ID_Proyecto",
        C.flag(C.equals_upper(F.col("EstadoProyecto"), C.CANCELLED)).alias("cancelado"),
    )


@query("c12_ratios")
def _ratios(c):
    return facts.costs_by_project(c.src["gastos"]).select(
        "ID_Proyecto",
        C.capex_opex_ratio(
            F.coalesce("capex", F.lit(0)), F.coalesce("opex", F.lit(0))
        ).alias("proporcion"),
        C.ratio_or_zero(F.col("opex"), F.col("cost"), "decimal(5,2)", 100).alias("porcentaje"),
    )


@query("c13_inclusion_reason")
def _inclusion_reason(c):
    return c.x["proyectos"].groupBy("razon_inclusion").agg(F.count("*").alias("proyectos"))


@query("c14_as_of")
def _as_of(c):
    return c.x["hitos"].where(F.col("FechaFinReal").isNull()).select("ID_Hito", "dias_retraso")


# Dimensions and facts -----------------------------------------------------------------------

_STAR_KEYS = {
    "d01": "dim_clientes",
    "d02": "dim_empleados",
    "d03": "dim_proyectos",
    "d04": "dim_tiempo",
    "d06": "dim_hitos",
    "d07": "dim_tareas",
    "d09": "dim_finanzas",
    "d10": "dim_tipo_riesgo",
    "d11": "dim_severidad",
    "d12": "dim_riesgos",
    "d13": "hechos_proyectos",
    "d14": "hechos_asignaciones",
}

for _id, _name in _STAR_KEYS.items():
    query(f"{_id}_{_name}")(lambda c, name=_name: c.star[name])

for _id in ("d04", "d06", "d13", "d14"):
    _name = _STAR_KEYS[_id]
    query(f"{_id}_{_name}_recent", shift_days=RECENT)(lambda c, name=_name: c.star[name])


@query("d05_subdimensiones")
def _subdimensions(c):
    def part(name):
        key, number = STAR[name]
        return c.star[name].select(
            F.lit(name).alias("tabla"), F.col(key).alias("clave"), F.col(number).alias("numero")
        )

    return (
        part("subdim_dia_semana")
        .unionByName(part("subdim_mes"))
        .unionByName(part("subdim_anio"))
    )


@query("d06_dim_hitos_lookup", calendar_key_mode="lookup")
def _hitos_lookup(c):
    return c.star["dim_hitos"]


@query("d08_dim_pruebas")
def _dim_pruebas(c):
    return dims.dim_pruebas(c.x)


@query("d09_dim_finanzas_null_text", null_text="None")
def _finanzas_null_text(c):
    return c.star["dim_finanzas"]


@query("d13_hechos_proyectos_resolved", resolve_finanza=True)
def _proyectos_resolved(c):
    return c.star["hechos_proyectos"]


@query("d13_hechos_proyectos_collated", collation="UNICODE_CI_AI")
def _proyectos_collated(c):
    return c.star["hechos_proyectos"]


@query("d13_from_extracts")
def _proyectos_from_extracts(c):
    return build_star(c.x)["hechos_proyectos"]


@query("d15_star_sizes", staged=True)
def _star_sizes(c):
    return audits.row_counts(c.star, STAR)


# Load, audits, incremental predicate --------------------------------------------------------


@query("l1_roundtrip")
def _roundtrip(c):
    sink = ParquetSink(new_path(c.spark, "warehouse"))
    load_table(c.star["dim_proyectos"], "dim_proyectos", sink)
    # A second replace must not add rows, an empty one must not remove any.
    load_table(c.star["dim_proyectos"], "dim_proyectos", sink)
    nothing = c.star["dim_proyectos"].where(F.col("ID_Proyecto").isNull())
    load_table(nothing, "dim_proyectos", sink)
    return sink.read(c.spark, "dim_proyectos")


@query("l2_append")
def _append(c):
    sink = ParquetSink(new_path(c.spark, "warehouse"))
    load_table(c.star["dim_clientes"], "dim_clientes", sink)
    load_table(c.star["dim_clientes"], "dim_clientes", sink, mode="append")
    return sink.read(c.spark, "dim_clientes")


@query("l2_append_batch")
def _append_batch(c):
    # The job for a batch is started twice; its rows arrive once.
    sink = ParquetSink(new_path(c.spark, "warehouse"))
    load_table(c.star["dim_clientes"], "dim_clientes", sink)
    for _ in range(2):
        load_table(c.star["dim_clientes"], "dim_clientes", sink, mode="append", batch="2002-01-01")
    return sink.read(c.spark, "dim_clientes")


@query("l3_sink_types")
def _sink_types(c):
    return conformed(c.star["hechos_proyectos"], "hechos_proyectos", zero_to_null=True)


@query("l4_load_all", staged=True)
def _load_all(c):
    sink = ParquetSink(new_path(c.spark, "warehouse"))
    load_all(c.star, sink)
    stored = {name: sink.read(c.spark, name) for name in LOAD_ORDER}
    return audits.row_counts(stored, LOAD_ORDER)


@query("l4_load_all_nulls", staged=True)
def _load_all_nulls(c):
    sink = ParquetSink(new_path(c.spark, "warehouse"))
    load_all(c.star, sink, zero_to_null=True)
    facts_table = sink.read(c.spark, "hechos_proyectos")
    return facts_table.agg(
        F.count("*").alias("filas"),
        F.count("ID_TiempoInicio").alias("con_inicio"),
        F.count("ID_Riesgo").alias("con_riesgo"),
        F.count("ID_Finanza").alias("con_finanza"),
    )


@query("l5_gate", staged=True)
def _gate(c):
    # Milestones that were late are kept from the load, so their tasks and tests have no parent.
    tables = {n: c.star[n] for n in ("dim_hitos", "dim_tareas", "dim_pruebas")}
    tables["dim_hitos"] = tables["dim_hitos"].where("Retraso_days <= 0")
    keys = tuple(key for key in FOREIGN_KEYS if key[2] == "dim_hitos")
    sink = ParquetSink(new_path(c.spark, "warehouse"), gate=Gate(keys=keys))
    load_all(tables, sink)
    held = [(name, sink.quarantined.get(name, 0)) for name in tables]
    counts = audits.row_counts({n: sink.read(c.spark, n) for n in tables}, tables)
    return counts.join(c.spark.createDataFrame(held, "tabla string, retenidas long"), "tabla")


@query("l5_fk_audit", staged=True)
def _fk_audit(c):
    return audits.foreign_key_audit(c.star)


@query("l6_pk_audit", staged=True)
def _pk_audit(c):
    return audits.duplicate_keys(c.star, STAR)


@query("i1_since_watermark")
def _since_watermark(c):
    # The watermark is the last start of a cancelled project, written and read back.
    last = c.x["proyectos"].where(F.col("EstadoProyecto") == "Cancelado").agg(F.max("FechaInicio"))
    control = Watermark(c.spark, new_path(c.spark, "control"))
    control.advance(f"{last.first()[0]} 00:00:00")
    return extract.changed_since(c.src["gastos"], "Fecha", control.current())


@query("i4_after_reset")
def _after_reset(c):
    control = Watermark(c.spark, new_path(c.spark, "control"))
    control.advance("2001-01-01 00:00:00")
    control.reset()
    return extract.changed_since(c.src["penalizaciones"], "Fecha", control.current())


@query("i3_incremental")
def _incremental(c):
    return extract.changed_since(c.src["gastos"], "Fecha", "1998-06-30 00:00:00")


@query("e1_incremental_scope")
def _incremental_scope(c):
    since = ("FechaFin", "1998-06-30 00:00:00")
    return extract.extract_all(c.src, since=since)["proyectos"]


def _grown(c) -> StarWarehouse:
    """A star of the projects that had started by a day, which then takes in the later ones."""
    day = "1998-06-30"
    started = c.src["proyectos"].where(F.coalesce(F.col("FechaInicio") <= day, F.lit(True)))
    early = Tables({n: (lambda n=n: c.src[n]) for n in SOURCE}).but(proyectos=lambda: started)
    house = StarWarehouse(c.spark, new_path(c.spark, "warehouse"), parts=8)
    house.load(early)
    house.merge(c.src, extract.changed_since(c.src["proyectos"], "FechaInicio", f"{day} 00:00:00"))
    return house


@query("e1_incremental_load")
def _incremental_load(c):
    # Keys of the calendar count from the first load's first day; here they are dense again.
    house = _grown(c)
    calendar = house.calendar()
    days = {k: dense_days(F.col(k), calendar) for k in ("ID_TiempoInicio", "ID_TiempoFinalizacion")}
    return house.read("hechos_proyectos").withColumns(days).drop("ID_Hecho")


@query("e1_incremental_counts")
def _incremental_counts(c):
    house = _grown(c)
    return audits.row_counts({n: house.read(n) for n in LOAD_ORDER}, LOAD_ORDER)


@query("i5_status")
def _status(c):
    control = Watermark(c.spark, new_path(c.spark, "control"))
    last = c.src["proyectos"].agg(F.max("FechaFin")).first()[0]
    control.advance(f"{last} 00:00:00")
    return control.status()


@query("e1_full_run")
def _full_run(c):
    sink = ParquetSink(new_path(c.spark, "warehouse"))
    run_pipeline(c.src, sink, as_of=F.lit(AS_OF).cast("date"))
    return audits.row_counts({n: sink.read(c.spark, n) for n in LOAD_ORDER}, LOAD_ORDER)


@query("e1_run_report")
def _run_report(c):
    sink = ParquetSink(new_path(c.spark, "warehouse"))
    run = run_pipeline(c.src, sink, as_of=F.lit(AS_OF).cast("date"))
    return run.report.frame(c.spark)


@query("e2_reset_and_run")
def _reset_and_run(c):
    sink = ParquetSink(new_path(c.spark, "warehouse"))
    control = Watermark(c.spark, new_path(c.spark, "control"))
    reset_and_run(c.src, control, sink, load=True, as_of=F.lit(AS_OF).cast("date"))
    return audits.row_counts({n: sink.read(c.spark, n) for n in LOAD_ORDER}, LOAD_ORDER)


# Analyses -----------------------------------------------------------------------------------


@query("q1_rentabilidad")
def _q1(c):
    return analytics.profitability_by_client(
        c.measures("PresupuestoCliente", "CosteReal", "PenalizacionesMonto"), c.star["dim_proyectos"])


@query("q1_rentabilidad_proyecto")
def _q1_project(c):
    return analytics.profitability_by_project(
        c.measures("PresupuestoCliente", "CosteReal", "PenalizacionesMonto"))


@query("q2_presupuesto")
def _q2(c):
    return analytics.budget_control(
        c.measures("PresupuestoCliente", "CosteReal", "DesviacionPresupuestal")
    )


@query("q3_penalizaciones_totales")
def _q3(c):
    return analytics.penalty_totals(dims.finance_rows(c.x))


@query("q3_penalizaciones_cliente")
def _q3_client(c):
    return analytics.penalties_by_client(c.measures("PenalizacionesMonto"), c.star["dim_proyectos"])


@query("q4_cronograma")
def _q4(c):
    return analytics.schedule_compliance(
        c.measures("ID_TiempoFinalizacion", "RetrasoDias"), c.star["dim_tiempo"])


@query("q5_cuellos_botella")
def _q5(c):
    return analytics.bottlenecks(c.star["dim_tareas"])


@query("q6_productividad")
def _q6(c):
    return analytics.productivity_trend(
        c.measures("ID_TiempoInicio", "ProductividadPromedio"), c.star["dim_tiempo"])


@query("q7_utilizacion")
def _q7(c):
    return analytics.utilisation(c.values)


@query("q8_coste_hora")
def _q8(c):
    return analytics.cost_per_hour(c.values, c.star["dim_empleados"])


@query("q9_defectos")
def _q9(c):
    return analytics.defect_rate(
        c.measures("NumeroDefectosEncontrados"), c.star["dim_proyectos"])


@query("q9_pruebas")
def _q9_tests(c):
    return analytics.effectiveness_by_type(c.star["dim_pruebas"])
