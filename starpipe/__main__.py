"""Job entry: ``spark-submit -m starpipe --source DIR --target DIR --control DIR [mode]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starpipe.control.report import EXTRACT, LOAD, ROWS
from starpipe.control.watermark import Watermark
from starpipe.operators.sinks import ParquetSink
from starpipe.plans import pipeline
from starpipe.session import build_session, resize
from starpipe.sources.readers import folder_bytes, parquet_source
from starpipe.workspace import clear_run


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starpipe", description=__doc__)
    parser.add_argument("--source", required=True, help="folder with the source relations")
    parser.add_argument("--target", required=True, help="folder of the warehouse tables")
    parser.add_argument("--control", required=True, help="folder of the watermark table")
    parser.add_argument("--source-bytes", type=int, help="size of the source; default: measured")
    mode = parser.add_mutually_exclusive_group()
    mode.add_argument("--full", action="store_true", help="full run without load")
    mode.add_argument("--full-load", action="store_true", help="full run with load")
    mode.add_argument("--reset", action="store_true", help="reset watermark, full run, no load")
    mode.add_argument("--reset-load", action="store_true", help="reset watermark, full run, load")
    mode.add_argument("--test-load", action="store_true", help="incremental run with load")
    mode.add_argument("--status", action="store_true", help="show the watermark")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session()
    resize(spark, args.source_bytes or folder_bytes(spark, args.source))
    control = Watermark(spark, args.control)
    if args.status:
        control.status().show(truncate=False)
        return
    try:
        run_and_show(args, spark, control)
    finally:
        clear_run(spark)


def run_and_show(args: argparse.Namespace, spark: SparkSession, control: Watermark) -> None:
    source = parquet_source(spark, args.source)
    sink = ParquetSink(args.target)
    if args.full or args.full_load:
        run = pipeline.run_full_load(source, sink, load=args.full_load)
    elif args.reset or args.reset_load:
        run = pipeline.reset_and_run(source, control, sink, load=args.reset_load)
    elif args.test_load:
        run = pipeline.run_pipeline(source, sink, control)
    else:
        run = pipeline.run_extract_transform(source, control=control)
    if run is None:
        print("nothing in scope")
        return
    for name, rows in {**run.extracted, **run.loaded}.items():
        print(f"{name}: {rows}")
    for stage, table, measure, number in run.report.entries():
        if number and (stage, measure) not in ((EXTRACT, ROWS), (LOAD, ROWS)):
            print(f"{table}: {number} {measure} ({stage})")
    if not run.loaded:
        for name, head in run.preview().items():
            print(name)
            head.show(truncate=False)


if __name__ == "__main__":
    main()
