"""Session settings and the shared folder for written tables and checkpoints."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the plans rely on; all of them may be set per query session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles a method of more bytes. Rows of many columns make such methods, which then stay
    # interpreted; without one of them the operators run apart, each compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# The part of files that one task reads. Facts take less than a byte a row in them, so of Spark's usual part a task
# would get all the more rows to sort or sum up the larger the facts are, up to hundreds of millions.
FACT_SPLIT = "6m"

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}
_cleared_at_exit: set[str] = set()
_steps: dict[str, list[str]] = {}


def build_session(master: str | None = None, app_name: str = "restock", **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use ``_`` for ``.`` in their names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere and give it a checkpoint folder."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    shared_folder(spark)
    return spark


def read_in_small_parts(spark: SparkSession) -> None:
    """Let a task read few files of a fact, however many there are."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", FACT_SPLIT)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a single-machine session without that
    setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    if context.applicationId in _local_folders:
        return _local_folders[context.applicationId]
    configured = context.getConf().get(_CHECKPOINT_SETTING) or spark.conf.get(_CHECKPOINT_SETTING, None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return f"{configured.rstrip('/')}/restock-{context.applicationId}"
    if context.getCheckpointDir() is not None:
        return f"{context.getCheckpointDir()}/restock-{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_SETTING} to a folder shared by all executors")
    folder = _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="restock-")
    context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Compute rows once and read them back from the shared folder.

    Unlike a cache this cuts the lineage, and unlike a checkpoint later steps read only the columns
    they need and plan their joins with the real size. The rows are removed by :func:`clear_steps`,
    at the latest when the driver ends.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    if application not in _cleared_at_exit:
        _cleared_at_exit.add(application)
        atexit.register(_clear_if_running, spark)
    path = f"{shared_folder(spark)}/steps/{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    _steps.setdefault(application, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def never_broadcast(df: DataFrame) -> DataFrame:
    """Join rows that grow with the facts by shuffling and sorting.

    Spark judges a table by the size of its files. Facts and roll-ups take less than a byte a row in
    them and more than a hundred in the hash table of a broadcast, so millions of rows would pass as
    small and fill the driver.
    """
    return df.hint("merge")


@contextmanager
def settings_for(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Other settings for the queries that run meanwhile; ``_`` stands for ``.`` in their names."""
    named = {name.replace("_", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in named}
    for name, value in named.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffled files of every query as it ends, not when the driver next collects garbage.

    For rows that are written and then read back: a query that is run twice would shuffle twice.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)


def steps(spark: SparkSession) -> list[str]:
    """Folders of the steps this application has written and not removed, the oldest first."""
    return list(_steps.get(spark.sparkContext.applicationId, []))


def remove_steps(spark: SparkSession, paths: list[str]) -> None:
    """Remove some steps early. No DataFrame that reads them may be used afterwards."""
    known = _steps.get(spark.sparkContext.applicationId, [])
    for path in known.copy():
        if path in paths:
            _delete(spark, path)
            known.remove(path)


def remove_read(df: DataFrame) -> None:
    """Remove the steps that ``df`` reads. Nothing that reads them may be used afterwards."""
    files = df.inputFiles()
    remove_steps(df.sparkSession, [step for step in steps(df.sparkSession) if any(step in file for file in files)])


def clear_steps(spark: SparkSession) -> None:
    """Remove the steps this application has written. Call it when no DataFrame that reads them is left."""
    _delete(spark, f"{shared_folder(spark)}/steps")
    _steps.pop(spark.sparkContext.applicationId, None)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _clear_if_running(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None:
        clear_steps(spark)
