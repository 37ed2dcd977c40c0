"""High watermark of the extraction, kept as an append-only Parquet table."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Watermark before the first run, history length, text form of a watermark.
INITIAL = "1900-01-01 00:00:00"
HISTORY = 10
FORMAT = "%Y-%m-%d %H:%M:%S"

_SCHEMA = "run bigint, previous_date string, new_date string, updated_at string"


def utc_now() -> str:
    """This instant as a watermark; sessions run in UTC."""
    return datetime.now(UTC).strftime(FORMAT)


class Watermark:
    """One row per change; the newest row is the current state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _SCHEMA)

    def history(self) -> DataFrame:
        """The last changes, newest first."""
        return self._rows().orderBy(F.desc("run")).limit(HISTORY)

    def current(self) -> str:
        newest = self.history().first()
        return newest.new_date if newest else INITIAL

    def advance(self, to: str | None = None) -> str:
        """Record a new watermark after a successful load.

        A run passes the instant before its first read, so that rows changed while it ran are seen
        by the next one; the default is now.
        """
        now = utc_now()
        newest = self.history().first()
        run, previous = (newest.run, newest.new_date) if newest else (0, INITIAL)
        new = to or now
        row = self.spark.createDataFrame([(run + 1, previous, new, now)], _SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)
        return new

    def reset(self) -> str:
        return self.advance(INITIAL)

    def status(self) -> DataFrame:
        """One row: the current watermark and the mode the next run would use."""
        return self.spark.createDataFrame(
            [(self.current(), "incremental")], "last_extraction string, next_mode string"
        )
