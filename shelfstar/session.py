"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffled lookups against a hot key are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Call sites are not recorded per column expression; plans are built faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Shuffle files go when the query that wrote them ends, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(app: str = "shelfstar", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; `extra` uses `__` for `.` in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by `spark.checkpoint.dir`; on one machine a temporary one where it is unset."""
    named, current = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir()
    if not named and not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="shelfstar-checkpoint-")
    if named and named not in (current or ""):
        spark.sparkContext.setCheckpointDir(named)
    return (named or current).rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once, into a table in the shared folder.

    Used where a small aggregate of a large fact feeds several branches of one
    plan, so that the fact is scanned once and a lost executor does not force
    the scan again. A table is computed once where an eager checkpoint computes its rows twice, and its size is known to
    the planner. Tables stay until the folder is emptied.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that the library wrote for itself in the shared folder and that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def use_settings(spark: SparkSession) -> None:
    """Apply the library's settings to a session somebody else built, as far as they can
    still be changed."""
    for name, value in SETTINGS.items():
        if spark.conf.isModifiable(name) and spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
