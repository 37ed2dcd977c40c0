"""The job: extract, transform, load, advance the watermark."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from starpipe.control.report import EXTRACT, LOAD, RunReport
from starpipe.control.watermark import Watermark, utc_now
from starpipe.operators.extract import extract_all
from starpipe.operators.sinks import Sink, load_all
from starpipe.plans.star import build_star
from starpipe.session import check_settings
from starpipe.sources.tables import Tables, each
from starpipe.workspace import materialise


@dataclass
class Run:
    """What a run produced: extracts and star as DataFrames, row counts by table, and the report."""

    extracts: Tables
    star: Tables
    extracted: dict[str, int]
    loaded: dict[str, int] = field(default_factory=dict)
    report: RunReport = field(default_factory=RunReport)

    def preview(self, rows: int = 3) -> dict[str, DataFrame]:
        return {name: df.limit(rows) for name, df in self.star.items()}


def run_pipeline(
    source: Mapping[str, DataFrame],
    sink: Sink | None = None,
    control: Watermark | None = None,
    incremental: bool = True,
    load: bool = True,
    as_of: Column | None = None,
    changed_column: str | None = None,
    collation: str | None = None,
    stamp: bool = False,
    zero_to_null: bool = False,
    **star_options,
) -> Run | None:
    """Extract, build the star and load it; None when the source has nothing in scope.

    Each extract and the calendar are written once to the shared folder, so that the project scope
    is joined once and every later step scans only the columns it needs of the written copy.
    An incremental run is a full extraction, since a load replaces the star: surrogate keys are
    dense over the whole of it. ``changed_column`` names a project column to compare with the
    watermark for looking at what changed, and is refused together with a load, which would delete
    everything unchanged. The watermark moves last, after a successful load, to the instant before
    the first read. All counts are taken by the jobs that write, see ``RunReport``. ``collation`` and ``stamp`` are those of ``extract_all``, ``zero_to_null`` that
    of ``load_all``.
    """
    if load and sink is None:
        raise ValueError("a load needs a sink")
    if load and changed_column:
        raise ValueError("a load replaces the star; with changed_column it would lose what is unchanged")
    check_settings(next(iter(source.values())).sparkSession)
    started = utc_now()
    since = None
    if incremental and control and changed_column:
        since = (changed_column, control.current())
    report = RunReport()
    extracts = extract_all(
        source, as_of=as_of, collation=collation, since=since, keep=report.keep(EXTRACT), stamp=stamp
    )
    # Asking for an extract writes it, and the write counts it.
    each(lambda name: extracts[name], extracts)
    extracted = report.rows(EXTRACT, extracts)
    if not any(extracted.values()):
        return None

    star = build_star(extracts, keep=materialise, **star_options)
    run = Run(extracts, star, extracted, report=report)
    if load:
        run.loaded = load_all(report.star(star), sink, zero_to_null=zero_to_null)
        for name in run.loaded:
            report.written(LOAD, name)
        if incremental and control:
            control.advance(started)
    return run


def run_extract_transform(source, **options) -> Run | None:
    return run_pipeline(source, load=False, **options)


def run_full_load(source, sink: Sink | None = None, load: bool = False, **options) -> Run | None:
    """A run that neither reads nor moves the watermark."""
    return run_pipeline(source, sink, incremental=False, load=load, **options)


def reset_and_run(
    source, control: Watermark, sink: Sink | None = None, load: bool = False, **options
) -> Run | None:
    control.reset()
    return run_full_load(source, sink, load, **options)
