"""Exact ranks over whole tables without a window over all rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row of the partition below


def ordered_rank(df: DataFrame, columns: Sequence[str], rank: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based rank of every row in ascending order of ``columns`` (nulls first), the whole table as one sequence.

    Rows are cut into ranges by sampled splitters and sorted inside them; the
    number of rows of each range (one count a partition) gives the offset of
    the next.  Rows that agree in all columns may take their ranks in either
    order.  The sorted ranges are written once to the shared checkpoint
    folder, so that counts and ranks see the same ranges.
    """
    order = [F.asc_nulls_first(c) for c in columns]
    ranges = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    x = cut_lineage(ranges.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, row = F.shiftrightunsigned("_at", _ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = x.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (x.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(rank, F.col("_before") + row).drop("_part", "_at", "_before"))


def rank_within(df: DataFrame, group: Sequence[str], columns: Sequence[str], rank: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based rank by ``columns`` inside each of the few groups of ``group``; a group of any size is spread over tasks."""
    x = ordered_rank(df, [*group, *columns], "_rank", partitions)
    first = x.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]).agg(F.min("_rank").alias("_first"))
    same = F.lit(True)
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return x.join(first, same).select(*df.columns, (F.col("_rank") - F.col("_first")).alias(rank))


def prefix_level(rows: int, rows_per_bucket: int, least: int = 3) -> int:
    """Hex digits of a uniform hash that leave about ``rows_per_bucket`` rows to a bucket."""
    return max(least, math.ceil(math.log(max(rows, 1) / rows_per_bucket, 16))) if rows > rows_per_bucket else least
