"""Named DataFrames, built on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import RLock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Independent jobs submitted side by side, so that one job's last tasks do not idle the cluster.
PARALLEL_JOBS = 4


class Tables(Mapping[str, DataFrame]):
    """Read-only table name -> DataFrame; each plan is built when first asked for.

    Reading one relation of a source or one table of the star therefore never builds (or, where a
    surrogate key needs a written table, runs) the others.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}
        # A builder may use other tables, never its own: waiting follows an acyclic graph.
        self._locks = {name: RLock() for name in self._builders}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._built:
                self._built[name] = self._builders[name]()
            return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def but(self, **replaced: Callable[[], DataFrame]) -> Tables:
        """The same tables with some of them added or replaced."""
        return Tables({**{name: self._getter(name) for name in self}, **replaced})

    def _getter(self, name: str) -> Callable[[], DataFrame]:
        return lambda: self[name]


def each(action: Callable[[str], object], names: Iterable[str]) -> dict[str, object]:
    """``action`` for every name, a few Spark jobs at a time; the first failure is raised."""
    names = list(names)
    inherited = inheritable_thread_target(SparkSession.active())(action)
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        return dict(zip(names, pool.map(inherited, names)))
