"""Session and shared-folder helpers.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``. Only a
local session that leaves it unset gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Codec of intermediate tables: a third less is written than with Spark's default.
COMPRESSION = "zstd"

_LOCAL_ROOTS: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def local_session(cpus: str | int = "*", name: str = "finsieve", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The run's folder on storage that every executor can reach."""
    configured = spark.conf.get("spark.checkpoint.dir", "")
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/finsieve-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="finsieve-")
    return _LOCAL_ROOTS[app]


def cut_lineage(spark: SparkSession) -> None:
    """Let estimators that run in rounds write their state now and then; without a folder each task carries all rounds before it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/rounds")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other table uses."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    made(spark).append(path)
    return path


def made(spark: SparkSession) -> list[str]:
    """The paths that ``new_path`` gave this application and that are not dropped, oldest first."""
    return _MADE.setdefault(spark.sparkContext.applicationId, [])


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables under paths that ``new_path`` gave; what reads them must be done by then."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        if path in made(spark):
            made(spark).remove(path)
            spark.sql(f"drop table if exists {_bucketed_name(path)}")
            there = jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(conf).delete(there, True)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of what is written meanwhile as soon as it is written.

    Else they lie on the executors' disks until the driver happens to collect garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result has no lineage, so a lost executor costs a re-read and not a
    re-run, and everything derived from it sees the same rows.
    """
    path = new_path(df.sparkSession, label)
    with freeing(df.sparkSession):
        df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, column: str, buckets: int, label: str = "stage") -> DataFrame:
    """Like ``stage``, as a table bucketed by ``column``: what groups or joins by it later moves no row again.

    Rows are not shuffled here; a task writes a file for each bucket that it has rows of.
    """
    path = new_path(df.sparkSession, label)
    name = _bucketed_name(path)
    with freeing(df.sparkSession):
        df.write.format("parquet").bucketBy(buckets, column).option("compression", COMPRESSION).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def _bucketed_name(path: str) -> str:
    return "finsieve_" + path.rsplit("-", 1)[1]


def stage_counted(df: DataFrame, label: str = "stage") -> tuple[DataFrame, int]:
    """Like ``stage``, with the number of rows, which Parquet keeps in its footers."""
    staged = stage(df, label)
    return staged, staged.count()
