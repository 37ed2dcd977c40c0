"""Session settings the pipeline relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A project, client or contract may own a third of a table: split its join partitions even
    # where the split costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partitions start small and many and are merged up to this size once their sizes are known.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Recording the Python line of every column costs a round trip each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: Source bytes that one shuffle partition stands for to begin with; adaptive execution merges
#: smaller ones. Spark's own number is the least.
BYTES_PER_PARTITION = 512 << 20
LEAST_PARTITIONS = 200
#: What results and costs depend on; ``run_pipeline`` insists on these.
NEEDED = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")


def sized_for(source_bytes: int) -> dict[str, str]:
    """Shuffle partitions for a source of that size, by one rule for all sizes."""
    partitions = max(-(-source_bytes // BYTES_PER_PARTITION), LEAST_PARTITIONS)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
    }


def resize(spark: SparkSession, source_bytes: int) -> None:
    """Give a running session the partitions for a source of that size."""
    for key, value in sized_for(source_bytes).items():
        spark.conf.set(key, value)


def check_settings(spark: SparkSession) -> None:
    """Raise if the session lacks a setting that keeps hot keys from landing in one task."""
    missing = [key for key in NEEDED if spark.conf.get(key, "true").lower() != "true"]
    if missing:
        raise ValueError(f"the session must set to true: {', '.join(missing)}")


def build_session(
    master: str | None = None, source_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with SETTINGS, sized for ``source_bytes`` if given; ``conf`` has the last word."""
    builder = SparkSession.builder.appName("starpipe")
    if master:
        builder = builder.master(master)
    sizes = sized_for(source_bytes) if source_bytes else {}
    for key, value in {**SETTINGS, **sizes, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
