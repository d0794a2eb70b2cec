"""Tables that are written run by run and become visible by one commit.

Every table of a store is a folder of ``run=<k>`` partitions.  Run k is the
last committed run plus one; its writes overwrite ``run=<k>``, and readers see
only runs up to the last committed one.  So whatever a broken run has written is
invisible, and the next attempt, which has the same number, writes over it:
a run that is killed after any of its writes and started again leaves the
tables of an unbroken run.  The commit is one small table written last.

One writer at a time is assumed, as in a scheduled job; a commit of a number
that is already there fails.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT_SCHEMA = "note string, at timestamp, run int"


def stored(spark: SparkSession, path: str, schema=None, **options: str) -> DataFrame | None:
    """Table at ``path``, or None if nothing was written there yet; any other failed read is raised.

    With a schema given, a folder without data files is an empty table."""
    try:
        reader = spark.read.options(**options)
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", *(("UNABLE_TO_INFER_SCHEMA",) if schema is None else ())):
            raise
        return None


class Store:
    """A folder of run-partitioned tables.  ``after_write(table, run)`` is called after each write (tests break runs there)."""

    def __init__(self, root: str, after_write: Callable[[str, int], None] | None = None):
        self.root = root.rstrip("/")
        self.after_write = after_write

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def __getattr__(self, table: str) -> str:  # store.raw, store.audit, ... -> folder
        if table.startswith("_"):
            raise AttributeError(table)
        return self.path(table)

    def committed(self, spark: SparkSession) -> int:
        """Number of the last committed run, 0 before the first."""
        commits = stored(spark, self.path("commits"), COMMIT_SCHEMA)
        return 0 if commits is None else commits.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]

    def read(self, spark: SparkSession, table: str, upto: int | None = None, schema=None) -> DataFrame | None:
        """Rows of the committed runs (or of runs up to ``upto``), None if there are none; ``run`` prunes partitions."""
        upto = self.committed(spark) if upto is None else upto
        df = stored(spark, self.path(table), schema, mergeSchema="true")
        return None if df is None or "run" not in df.columns else df.where(F.col("run") <= upto)

    def write(self, df: DataFrame, table: str, run: int, partition_by: Sequence[str] = ()) -> None:
        """Replace what run ``run`` has of ``table``."""
        df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(f"{self.path(table)}/run={run}")
        if self.after_write:
            self.after_write(table, run)

    def commit(self, spark: SparkSession, run: int, note: str = "") -> None:
        """Make run ``run`` visible."""
        if run != self.committed(spark) + 1:
            raise ValueError(f"run {run} does not follow run {self.committed(spark)}")
        row = spark.range(1).select(F.lit(note).alias("note"), F.current_timestamp().alias("at"))
        row.coalesce(1).write.mode("errorifexists").parquet(f"{self.path('commits')}/run={run}")
        if self.after_write:
            self.after_write("commits", run)
