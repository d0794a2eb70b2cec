"""Materialised intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


#: bytes of one Arrow batch between Spark and a Python worker; a longer row is a batch of its own
BATCH_BYTES = 4 << 20


def small_batches(spark) -> None:
    """Bound the session's Arrow batches by bytes, so that rows of megabytes do not meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and return a frame that reads it.

    The table survives the loss of executors, cuts the lineage and, being
    columnar, lets each later reader take only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
