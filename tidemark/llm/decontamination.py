r"""Benchmark decontamination: a prefix-filtered set join of benchmark windows with whole documents.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.  A window
is 10 consecutive words of an item, or the whole item if it has fewer.  A
document word inside any occurrence of a window is hit.

1. Both sides become shingles of five words (items of fewer words: of all their
   words).  One pass over the documents keeps the places of shingles that the
   benchmark has; this table is written once.
2. Shingles are ordered by rarity, counted over all documents.  A window can
   only occur where its rarest shingle does, so that one shingle is the
   window's necessary prefix: places of prefix shingles are the candidates.
3. Bounds: the window must begin at or after the first word and end at or
   before the last.
4. Verification: every shingle of the window stands at its own place, which
   for overlapping shingles means all the window's words in order.

All steps are DataFrame or SQL functions.  Shingles are compared by 64-bit
hash; a false window would need several collisions in a row.

Scale: the benchmark's shingles are broadcast only when their counted number
is at most MAX_BROADCAST, else the same join is shuffled with the table's
hot shingles spread by AQE.  What is shuffled is the matches, not the
documents.  A common passage gives each document its own rows, no pairs.

Defined cases: null or empty texts have no words; items without words have no
window; repeated rows, also of one or a null doc_id, are told apart by their text; items
with a null item_id count as one item without a name in ``items``; an empty
benchmark hits nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._stage import free_name, stage

WINDOW = 10
SHINGLE = 5
#: benchmark shingles (8-byte hash each) that may be broadcast
MAX_BROADCAST = 1_000_000
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> str:
    """SQL: array of the words of ``text``."""
    cut = f"split(translate(coalesce({text}, ''), '{_UP}', '{_LOW}'), r'{_GAPS}')"
    return f"array_remove({cut}, '')"


def shingles_of(words: str, size: int) -> str:
    """SQL: 64-bit hash of each run of ``size`` words, in order."""
    return (f"if(size({words}) >= {size}, transform(sequence(1, greatest(size({words}) - {size - 1}, 1)), "
            f"i -> xxhash64(slice({words}, i, {size}))), cast(array() as array<bigint>))")


def windows(items: DataFrame, item: str = "item_id") -> DataFrame:
    """(item, window, length, place, size, shingle): the shingles of each distinct window of each item.

    item is "=" and the id as text, or empty for a null id.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(item).cast("string")), F.lit("")).alias("item")  # never null, so that it joins
    w = items.select(named, F.expr(words_of("text")).alias("w")).filter(F.size("w") > 0)
    w = w.select("item", "w", F.expr(f"least(size(w), {WINDOW})").alias("length"), F.expr(f"least(size(w), {SHINGLE})").alias("size"))
    starts = w.select("item", "length", "size", "w", F.explode(F.expr("sequence(1, size(w) - length + 1)")).alias("at"))
    one = starts.select("item", "length", "size", F.expr("slice(w, at, length)").alias("w")).withColumn("window", F.expr("xxhash64(array_join(w, ' '), length)"))
    one = one.dropDuplicates(["item", "window"])
    return one.select("item", "window", "length", "size", F.posexplode(F.expr("transform(sequence(1, length - size + 1), i -> xxhash64(slice(w, i, size)))")).alias("place", "shingle"))


def find(docs: DataFrame, items: DataFrame, key: list[str], keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(documents, hits): a row of ``key``, ``keep``, n_words a document, and one of ``key``, item, start, length an occurrence.

    ``key`` must tell documents with different texts apart and hold no nulls; ``keep`` is in no join.
    """
    grams = stage(windows(items), "windows")
    sizes = [r[0] for r in grams.select("size").distinct().orderBy("size").collect()]  # at most SHINGLE values
    shingles = grams.select("size", "shingle").distinct()
    small = shingles.count() <= MAX_BROADCAST
    worded = docs.select(*key, *keep, F.expr(words_of("text")).alias("w"))
    lists = [F.struct(F.lit(s).alias("size"), F.expr(shingles_of("w", s)).alias("h")) for s in sizes]
    # the first row of each document carries its word count and joins with no shingle
    rows = worded.select(*key, *keep, F.size("w").cast("bigint").alias("n_words"),
                         F.array(F.struct(F.lit(0).alias("size"), F.expr("array(0L)").alias("h")), *lists).alias("lists"))
    # outer, so that no filter on the lists is inferred and pushed below them (it would compute them twice)
    rows = rows.select(*key, *keep, "n_words", F.explode_outer("lists").alias("l")).select(*key, *keep, "n_words", F.col("l.size").alias("size"), F.col("l.h").alias("h"))
    rows = rows.select(*key, *keep, "n_words", "size", F.posexplode_outer("h").alias("pos", "shingle"))
    known = shingles.withColumn("known", F.lit(True))
    matched = rows.join(F.broadcast(known) if small else known, ["size", "shingle"], "left").filter("known or size = 0").drop("known")
    places = stage(matched, "places")
    documents = places.filter("size = 0").select(*key, *keep, "n_words")
    places = places.filter("size > 0").drop(*keep)
    rarity = places.groupBy("size", "shingle").agg(F.count(F.lit(1)).alias("n"))
    counted = grams.join(rarity, ["size", "shingle"])  # a shingle that no document has rules its window out
    prefix = (counted.groupBy("item", "window", "length", "size")
              .agg(F.min(F.struct("n", "shingle", "place")).alias("p"), F.count(F.lit(1)).alias("found"))
              .filter("found = length - size + 1").select("item", "window", "length", "size", "p.shingle", "p.place"))
    candidates = (places.join(prefix, ["size", "shingle"])
                  .select(*key, "n_words", "item", "window", "length", "size", (F.col("pos") - F.col("place")).alias("start"))
                  .filter("start >= 0 and start + length <= n_words").distinct())
    wanted = candidates.join(grams.select("item", "window", "place", "shingle"), ["item", "window"]).withColumn("pos", F.expr("start + place"))
    right = wanted.join(places.select(*key, "size", "pos", "shingle").distinct(), [*key, "size", "pos", "shingle"])
    hits = (right.groupBy(*key, "item", "window", "start", "length", "size").agg(F.countDistinct("place").alias("n"))
            .filter("n = length - size + 1").select(*key, "item", "start", "length"))
    return documents, hits


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a digest that tells rows with one doc_id and different texts apart (null doc_ids count as equal)."""
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.expr("xxhash64(text, length(text))").alias("digest"), "doc_id", "text")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Word, hit and item counts of every row of ``docs`` against all ``items``."""
    key = ["id", "digest"]
    documents, hits = find(keyed(docs), items, key, ("doc_id",))
    places = hits.select(*key, F.explode(F.expr("sequence(start, start + length - 1)")).alias("pos")).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    named = (hits.select(*key, F.expr("if(item = '', null, substring(item, 2))").alias("item")).distinct().groupBy(*key)
             .agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items")))
    out = documents.join(places, key, "left").join(named, key, "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                      F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, in which no window of ``items`` occurs."""
    _, hits = find(keyed(docs), items, ["id", "digest"])
    a, b = free_name(docs, "llm_id"), free_name(docs, "llm_digest")
    rows = docs.withColumn(a, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn(b, F.expr("xxhash64(text, length(text))"))
    return rows.join(hits.select(F.col("id").alias(a), F.col("digest").alias(b)).distinct(), [a, b], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM places p JOIN win ON p.n = win.n AND p.s = win.s),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
