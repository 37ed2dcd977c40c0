"""Time the headline jobs over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every job is run once to warm up and then $BENCH_RUNS times (once only when $BENCH_SECONDS have
passed since the start); the median counts. Results go to the
``noop`` sink except for the full run, which loads a Parquet warehouse.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.registry import AS_OF, QUERIES, Context  # noqa: E402
from starpipe.operators.sinks import ParquetSink  # noqa: E402
from starpipe.plans.pipeline import run_pipeline  # noqa: E402
from starpipe.schemas import SOURCE  # noqa: E402
from starpipe.session import build_session  # noqa: E402
from starpipe.sources.tables import each  # noqa: E402
from starpipe.workspace import new_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SECONDS = float(os.environ.get("BENCH_SECONDS", "600"))

DIMENSIONS = (
    "dim_clientes", "dim_empleados", "dim_proyectos", "dim_tiempo", "dim_hitos", "dim_tareas",
    "dim_pruebas", "dim_finanzas", "dim_tipo_riesgo", "dim_severidad", "dim_riesgos",
)
ANALYSES = tuple(name for name in QUERIES if name.startswith("q"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="starpipe-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def extraction() -> None:
        extracts = Context(spark, SF_DIR).x
        each(lambda name: drain(extracts[name]), SOURCE)

    def dimensions() -> None:
        star = Context(spark, SF_DIR).star
        each(lambda name: drain(star[name]), DIMENSIONS)

    def star_table(name: str):
        return lambda: drain(Context(spark, SF_DIR).star[name])

    def full_run() -> None:
        sink = ParquetSink(new_path(spark, "bench"))
        source = Context(spark, SF_DIR).src
        run_pipeline(source, sink, as_of=F.lit(AS_OF).cast("date"))

    def analyses() -> None:
        each(lambda name: drain(QUERIES[name](spark, SF_DIR)), ANALYSES)

    begun = time.time()
    Context(spark, SF_DIR).src["gastos"].count()
    landing = time.time() - begun

    jobs = {
        "extract_12_tables": extraction,
        "dimensions_11": dimensions,
        "hechos_asignaciones": star_table("hechos_asignaciones"),
        "hechos_proyectos": star_table("hechos_proyectos"),
        "analyses_11": analyses,
        "full_run_with_load": full_run,
    }
    times = {"number_lines_once": round(landing, 3)}
    taken = {"number_lines_once": 1}
    for name, job in jobs.items():
        job()
        runs = []
        for _ in range(RUNS):
            if runs and time.time() - begun > SECONDS:
                break
            start = time.time()
            job()
            runs.append(time.time() - start)
        times[name] = round(statistics.median(runs), 3)
        taken[name] = len(runs)
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "spark": spark.version,
                "master": f"local[{CPUS}]",
                "runs": taken,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
