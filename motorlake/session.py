"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_SQL_SETTINGS = {
    # Dates, snapshot days and date keys are all defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: broadcast only what a finished stage has measured as
    # small, split skewed join partitions, merge tiny shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Folders are listed by at most so many tasks; with one for each of 10,000, starting them takes longer than listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "400",
    # A JSON object with a repeated key keeps the last value instead of failing.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Wide merges build many expressions; skip a stack trace for each of them.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}

#: With it, shuffle files go when the execution that wrote them ends, not when the driver happens to collect its garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_fallback_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings every operator assumes."""
    for key, value in _SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "motorlake") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the one set on the context.

    Where the session names none, a local session (tests) gets a temporary one; a cluster must name it.
    """
    global _fallback_root
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _fallback_root is None:
        _fallback_root = tempfile.mkdtemp(prefix="motorlake-")
    return _fallback_root


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Used where a result feeds several others: it is computed once, its lineage
    ends at the files, and a lost executor costs a re-read. Nothing runs that
    plan again, so its shuffle files go with it: steps of a long job need the
    disk of the largest of them, not of all together.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to a path."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path under the shared folder."""
    return f"{shared_root(spark)}/motorlake/{name}-{uuid.uuid4().hex[:12]}"
