"""Persistent index of row hashes: a batch is deduplicated without reading the store.

The index is a log of *segments*.  Each run adds one segment with the hashes
it stored; ``FAN_IN`` segments of one level are merged into one of the next, so
there are at most ``FAN_IN - 1`` live segments a level and each hash is
rewritten once a level.  A segment is split by hash prefix into buckets of about
``BUCKET_KEYS`` hashes and has two tables, partitioned by segment and bucket:

* ``hashes``: the hashes themselves;
* ``filters``: a Bloom filter of each bucket as rows (word, 64 bits), four bits
  a hash, built with ``bit_or``; only words that are not zero are stored.

A lookup prunes both tables by partition: filter words are read for the
buckets that the batch touches, hashes only for those buckets whose filter
admits one of its rows.  A batch of rows that are all new therefore reads next
to no hashes, however large the store.  Both steps are equi-joins, and the
final comparison is on whole hashes, so the answer is exact.

Writes of a run replace its own segment, and lookups of run k see only
segments made by earlier runs: a run that is broken and done again gives the
same rows and the same index.
"""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage
from tidemark.store.runs import Store, stored

FAN_IN = 32
BUCKET_KEYS = 1_000_000
MAX_BITS = 16
WORD_BITS = 17
#: (segment, bucket) pairs of a lookup that are named one by one; beyond it whole prefix ranges are read
PAIRS = 20_000

SEGMENTS = "segment string, level int, first int, last int, bits int, n bigint, run int"


def _prefix() -> Column:
    return F.conv(F.substring("_k", 1, 4), 16, 10).cast("int")


def _word() -> Column:
    return F.conv(F.substring("_k", 5, 5), 16, 10).cast("int").bitwiseAND(F.lit((1 << WORD_BITS) - 1))


def _mask() -> Column:
    """Four of 64 bits, by 24 further bits of the hash."""
    n = "cast(conv(substring(_k, 10, 6), 16, 10) as int)"
    return F.expr(" | ".join(f"shiftleft(1L, shiftright({n}, {shift}) & 63)" for shift in (0, 6, 12, 18)))


def _bucket(bits: int) -> Column:
    return F.shiftright(_prefix(), 16 - bits)


class HashIndex:
    """Index of one hash column inside a :class:`Store`."""

    def __init__(self, store: Store, name: str = "index", fan_in: int = FAN_IN, bucket_keys: int = BUCKET_KEYS):
        self.store, self.name, self.fan_in, self.bucket_keys = store, name, fan_in, bucket_keys

    # ------------------------------------------------------------ segments ----
    def segments(self, spark: SparkSession, before: int) -> list[dict]:
        """Live segments made by runs before ``before``: those that no larger one covers.  One small row each."""
        df = stored(spark, self.store.path(f"{self.name}-segments"), SEGMENTS)
        rows = [] if df is None else [r.asDict() for r in df.where(F.col("run") < before).collect()]
        rows.sort(key=lambda r: (r["first"], -r["last"], -r["level"]))
        live: list[dict] = []
        for r in rows:
            if not live or r["last"] > live[-1]["last"]:
                live.append(r)
        return live

    def _write_segment(self, spark: SparkSession, keys: DataFrame, segment: str, n: int) -> int:
        """Hashes (column ``_h`` with its key ``_k``) as one segment; returns its bucket bits."""
        bits = 0
        while bits < MAX_BITS and n > self.bucket_keys << bits:
            bits += 1
        rows = keys.select("_h", "_k", _bucket(bits).alias("bucket"))
        path = self.store.path(self.name)
        rows.repartition(max(1, 1 << bits), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}-hashes/segment={segment}")
        words = rows.select("bucket", _word().alias("word"), _mask().alias("mask")).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        words.repartition(max(1, 1 << bits), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}-filters/segment={segment}")
        return bits

    def append(self, new: DataFrame, hash_col: str, run: int) -> None:
        """Add the hashes that run ``run`` stores; every ``fan_in`` segments of a level become one of the next."""
        spark = new.sparkSession
        keys = new.select(F.col(hash_col).cast("string").alias("_h")).where("_h is not null").distinct().withColumn("_k", F.md5("_h"))
        keys = cut_lineage(keys)
        n = keys.count()
        live = self.segments(spark, run)
        made = []
        if n:
            segment = f"{run}-0"
            made.append((segment, 0, run, run, self._write_segment(spark, keys, segment, n), n))
            level, parts = 0, [dict(zip(("segment", "level", "first", "last", "bits", "n"), made[0], strict=True))]
            while True:  # merge up while the level is full
                same = [s for s in live if s["level"] == level] + parts
                if len(same) < self.fan_in:
                    break
                merged = f"{run}-{level + 1}"
                names = [s["segment"] for s in same]
                both = self._table(spark, "hashes", {s["segment"]: None for s in same}).select("_h", "_k")
                total = sum(s["n"] for s in same)
                row = (merged, level + 1, min(s["first"] for s in same), run, self._write_segment(spark, both, merged, total), total)
                made.append(row)
                live = [s for s in live if s["segment"] not in names]
                level, parts = level + 1, [dict(zip(("segment", "level", "first", "last", "bits", "n"), row, strict=True))]
        rows = spark.createDataFrame(made, SEGMENTS.replace(", run int", "")).coalesce(1)
        self.store.write(rows, f"{self.name}-segments", run)

    def _table(self, spark: SparkSession, kind: str, wanted: dict[str, list[int] | None]) -> DataFrame:
        """Rows of the wanted buckets (None: all) of the wanted segments; a pruned partition scan."""
        fields = {"hashes": "_h string, _k string", "filters": "word int, bits bigint"}[kind]
        df = spark.read.schema(f"{fields}, segment string, bucket int").parquet(self.store.path(f"{self.name}-{kind}"))
        alike = defaultdict(list)  # segments that want the same buckets share one condition
        for segment, buckets in wanted.items():
            alike[json.dumps(buckets)].append(segment)
        condition = F.lit(False)
        for buckets, segments in alike.items():
            one = F.col("segment").isin(segments)
            condition = condition | (one if buckets == "null" else one & F.col("bucket").isin(json.loads(buckets)))
        return df.where(condition)

    # -------------------------------------------------------------- lookup ----
    def known(self, batch: DataFrame, hash_col: str, run: int) -> DataFrame:
        """Distinct hashes of ``batch`` that a run before ``run`` stored (column ``hash_col``)."""
        spark = batch.sparkSession
        none = spark.createDataFrame([], f"`{hash_col}` string")
        live = self.segments(spark, run)
        if not live:
            return none
        keys = cut_lineage(batch.select(F.col(hash_col).cast("string").alias("_h")).where("_h is not null").distinct().withColumn("_k", F.md5("_h")))
        depth = max(s["bits"] for s in live)
        touched = [r[0] for r in keys.select(_bucket(depth).alias("b")).distinct().collect()]  # at most 2 ** MAX_BITS numbers
        if not touched:
            return none
        want = {s["segment"]: None if s["bits"] == 0 else sorted({b >> (depth - s["bits"]) for b in touched}) for s in live}
        shapes = F.create_map(*[x for s in live for x in (F.lit(s["segment"]), F.lit(s["bits"]))])
        filters = self._table(spark, "filters", want).select("segment", "bucket", "word", F.col("bits").alias("filter"), shapes[F.col("segment")].alias("shape"))
        probes = keys.select(
            "_h", _prefix().alias("prefix"), _word().alias("word"), _mask().alias("mask"),
            F.explode(F.array(*[F.lit(b) for b in sorted({s["bits"] for s in live})])).alias("shape"))
        probes = probes.withColumn("bucket", F.expr("shiftright(prefix, 16 - shape)"))
        admitted = cut_lineage(probes.join(filters, ["shape", "bucket", "word"]).where("(filter & mask) = mask").select("_h", "segment", "bucket").distinct())
        pairs = admitted.select("segment", "bucket").distinct().limit(PAIRS + 1).collect()
        if not pairs:
            return none
        if len(pairs) <= PAIRS:
            want = defaultdict(list)
            for segment, bucket in sorted(map(tuple, pairs)):
                want[segment].append(bucket)
        hashes = self._table(spark, "hashes", want)
        return admitted.select("_h").distinct().join(hashes.select("_h"), "_h", "left_semi").withColumnRenamed("_h", hash_col)

    def unseen(self, batch: DataFrame, hash_col: str, run: int) -> DataFrame:
        """Rows of ``batch`` whose hash no run before ``run`` stored; a null hash is never known."""
        return batch.join(self.known(batch, hash_col, run), hash_col, "left_anti")

    def build(self, hashes: DataFrame, hash_col: str, run: int = 0) -> None:
        """Index a store that was written without one, as the segment of run ``run``."""
        self.append(hashes, hash_col, run)
