"""Session helpers: a local session for tests/bench and the shared work folder.

Library code never invents a machine-local folder on a cluster. The work root
is taken, in order, from ``lakestar.work.dir``, from a sub-folder of the
session's ``spark.checkpoint.dir``, and only on a ``local[...]`` master from a
fresh temporary folder (which then also becomes the checkpoint dir).
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "lakestar") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder shared by all executors"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lakestar-ckpt-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage at once, through the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def discard(*frames: DataFrame) -> None:
    """Delete the files of checkpoints that nothing will read again."""
    for df in frames:
        spark = df.sparkSession
        plan = df._jdf.queryExecution().logical()
        if plan.getClass().getSimpleName() != "LogicalRDD":
            raise ValueError("not a checkpointed table")
        written = plan.rdd().getCheckpointFile()
        if written.isDefined():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(written.get())
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files are deleted when it ends. Else they stay until the driver's garbage
    collection finds that nothing refers to them, so those of a whole build add up on the executors' disks.
    A DataFrame that is executed twice within shuffles its rows twice."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def work_dir(spark: SparkSession) -> str:
    """Root folder for landing files, staged data and warehouse versions."""
    explicit = spark.conf.get("lakestar.work.dir", None)
    if explicit:
        return explicit.rstrip("/")
    root = checkpoint_dir(spark).rstrip("/")
    # the checkpoint dir Spark returns is already unique per application
    path = f"{root}/lakestar-work"
    spark.conf.set("lakestar.work.dir", path)
    return path


def concurrently(jobs: list[Callable]) -> list:
    """Run independent Spark actions as concurrent jobs from driver threads
    (small jobs then share the executors instead of queueing); results in
    order, the first failure re-raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(job) for job in jobs]
        return [f.result() for f in futures]
