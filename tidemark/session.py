"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tidemark job relies on: UTC wall clock, ANSI semantics, AQE.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tidemark", **conf: str) -> SparkSession:
    """Return a session with tidemark's required settings.

    On a cluster the master and sizing come from spark-submit; locally
    ``master`` defaults to ``local[$BENCH_CPUS or *]``.
    """
    builder = SparkSession.builder.appName(app)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEM", "16g"))
        builder = builder.config("spark.sql.shuffle.partitions", os.environ.get("TIDEMARK_SHUFFLE_PARTITIONS", "8"))
    for k, v in {**_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _DEFAULTS.items():
        if not k.startswith("spark.ui."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it (a shared filesystem path); only when it is unset on a
    local master, as in tests, a fresh scratch folder is created and
    registered.  Unset on a cluster is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            # executors on other machines cannot see a machine-local folder
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside, shuffle files of a written or collected frame are removed when its job ends, not when the JVM next collects garbage.

    For frames that are run once; one that is run again computes its shuffles anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint,
    survives executor loss) and return the re-based DataFrame."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
