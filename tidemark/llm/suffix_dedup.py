r"""Suffix dedup: bytes covered by a LENGTH-byte string that also starts earlier are removed.

Suffixes only need ordering to depth LENGTH (100), within documents.  The construction is
blockwise: cover samples split all suffixes into buckets, one bucket is sorted
at a time, and long ties are resolved by ranks made beforehand.

1. Cover: every LENGTH-byte window takes its smallest ANCHOR-byte string (by
   hash, leftmost) as its sample.  Equal windows take equal samples at equal
   offsets, so, as with a difference cover, two suffixes that must be compared
   always meet at a common sample; about one position in 35 is one.
2. Buckets: the windows of one sample occurrence are a run of starts.  Runs
   whose samples are equal share a bucket.  Each run carries the rank (hash) of
   its whole context, so equal runs, however long the repeat, are tied by one
   comparison: all but the earliest are removed whole.
3. A bucket with several different contexts keeps the earliest run of each;
   their windows (few: the edges of repeats) are ranked one by one and all but
   the earliest of each rank are removed.
4. A document's removed starts become byte runs; what is left is hashed.

The cover is chosen by content, not by position modulo a period: documents are
spread over machines, so no task could look up the sample ranks of another
document's positions, and a periodic cover that meets for any two positions
would ship three to five times as many samples.  Ranks are 64-bit hashes: only
equality and the order of places matter here, not the order of the suffixes.

Scale: memory is one block of text, or a few rows of a sorted bucket, at a
time.  Equal runs within a block are settled before the shuffle, so a passage
that a third of all documents share sends one row a block; sorted buckets
stream and spill.  Texts are shuffled once.

Defined cases: null and empty texts, and those shorter than LENGTH, lose
nothing; a null doc_id comes before all others; rows with one doc_id and
different texts are different documents, ordered by a hash of the text, equal
rows are one document and get the same result; empty tables give empty
results; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text as X
from ._stage import stage

LENGTH = 100
ANCHOR = 32
SPAN = LENGTH - ANCHOR + 1
_TAG_BITS, _START_BITS, _RUN_BITS = 26, 30, 7
_FIRST = -(1 << 63)


def window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, from block-wise running minima of both directions."""
    n = len(keys) - width + 1
    if n <= 0:
        return keys[:0]
    size = -(-len(keys) // width) * width
    grid = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(keys)] = keys
    grid = grid.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def runs_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, context, document, start, length) of the runs of a block: windows that share a sample occurrence."""
    empty = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    prefix = X.prefix_hash(raw)
    at = np.arange(len(raw) - ANCHOR + 1)
    grams = X.span_hash(prefix, at, at + ANCHOR)
    low = np.uint64((1 << max(1, int(len(raw)).bit_length())) - 1)
    sample = (window_min((grams & ~low) | at.astype(np.uint64), SPAN) & low).astype(np.int64)
    edge = np.zeros(len(raw) + 1, np.int64)
    long = np.diff(offsets) >= LENGTH
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - LENGTH + 1, -1)
    valid = np.cumsum(edge[: len(sample)]) > 0
    starts = np.flatnonzero(valid)
    own = sample[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(starts)))
    lo, anchor = starts[first], own[first]
    context = X.mix(X.span_hash(prefix, lo, lo + n - 1 + LENGTH) + (anchor - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + n.astype(np.uint64))
    doc = np.searchsorted(offsets, lo, "right") - 1
    return grams[anchor], context, doc, lo - offsets[doc], n


def packed(tag: np.ndarray, start: np.ndarray, n) -> np.ndarray:
    """Tag, start and length of a run in one long that sorts by tag, then start."""
    return (tag << (_START_BITS + _RUN_BITS)) | (start << _RUN_BITS) | n


def unpacked(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (p >> _RUN_BITS) & ((1 << _START_BITS) - 1), p & ((1 << _RUN_BITS) - 1)


ROWS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("context", T.LongType()), T.StructField("id", T.LongType()),
                     T.StructField("run", T.LongType()), T.StructField("gone", T.BooleanType())])


def _settled(bucket, context, ids, run) -> pa.RecordBatch:
    """Rows of a block; those with an earlier equal context in it are gone and need no bucket."""
    order = np.lexsort((run, ids, context, bucket))
    bucket, context, ids, run = bucket[order].view(np.int64), context[order].view(np.int64), ids[order], run[order]
    gone = np.zeros(len(bucket), bool)
    gone[1:] = (bucket[1:] == bucket[:-1]) & (context[1:] == context[:-1])
    bucket = np.where(gone, X.mix(run.view(np.uint64) + ids.view(np.uint64)).view(np.int64), bucket)
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(context), pa.array(ids), pa.array(run), pa.array(gone)], ROWS.names)


def _parts(batch: pa.RecordBatch):
    """(bytes, offsets, ids, tags, further columns) of the text blocks of a batch (id, tag, text, ...)."""
    ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    at = 0
    for raw, offsets in X.blocks(batch.column(2)):
        n = len(offsets) - 1
        yield raw, offsets, ids[at : at + n], tags[at : at + n], [c.slice(at, n) for c in batch.columns[3:]]
        at += n


def _sampled(batches):
    for batch in batches:
        for raw, offsets, ids, tags, _ in _parts(batch):
            bucket, context, doc, start, n = runs_of(raw, offsets)
            if len(doc):
                yield _settled(bucket, context, ids[doc], packed(tags[doc], start, n))


def _ranked(batches):
    """Windows of each document's listed runs, every one with its own rank."""
    for batch in batches:
        for raw, offsets, ids, tags, (lists,) in _parts(batch):
            each = np.diff(lists.offsets.to_numpy())
            start, n = unpacked(lists.flatten().to_numpy())
            doc = np.repeat(np.repeat(np.arange(len(each)), each), n)
            begin = np.cumsum(n) - n
            start = np.repeat(start, n) + np.arange(int(n.sum())) - np.repeat(begin, n)
            if len(doc):
                at = start + offsets[doc]
                rank = X.span_hash(X.prefix_hash(raw), at, at + LENGTH)
                yield _settled(rank, np.zeros(len(rank), np.uint64), ids[doc], packed(tags[doc], start, 1))


def _sorted(batches):
    """(id, run, edge) from rows sorted by bucket, context, place: runs to remove, and (edge) the earliest run of each context of a mixed bucket.

    Holds one row between batches: the earliest of the last context, whose
    bucket may go on.
    """
    held, mixed = None, False
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        gone = cols[4].astype(bool)
        out_id, out_run, out_edge = [cols[2][gone]], [cols[3][gone]], [np.zeros(int(gone.sum()), bool)]
        bucket, context, ids, run = (c[~gone] for c in cols[:4])
        if held is not None:
            bucket, context, ids, run = (np.append(h, c) for h, c in zip(held, (bucket, context, ids, run), strict=True))
        if len(bucket):
            new = np.ones(len(bucket), bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (context[1:] != context[:-1])
            first = np.flatnonzero(new)
            after = np.append(bucket[first][1:] == bucket[first][:-1], False)
            edge = after.copy()
            edge[1:] |= after[:-1]
            edge[0] |= held is not None and mixed
            last = first[-1]
            held, mixed = tuple(c[last : last + 1] for c in (bucket, context, ids, run)), bool(edge[-1])
            keep = first[:-1][edge[:-1]]
            out_id += [ids[~new], ids[keep]]
            out_run += [run[~new], run[keep]]
            out_edge += [np.zeros(int((~new).sum()), bool), np.ones(len(keep), bool)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_id, out_run, out_edge)], ["id", "run", "edge"])
    if held is not None and mixed:
        yield pa.RecordBatch.from_arrays([pa.array(held[2]), pa.array(held[3]), pa.array([True])], ["id", "run", "edge"])


def _by_bucket(rows: DataFrame) -> DataFrame:
    ordered = rows.repartition(F.col("bucket")).sortWithinPartitions("bucket", "context", "id", "run")
    return ordered.mapInArrow(_sorted, "id long, run long, edge boolean")


def _cut(batches):
    """n_bytes, n_removed, n_spans and the hash of what is left, of each document with its list of removed runs (or null)."""
    for batch in batches:
        for raw, offsets, ids, _, (lists, named) in _parts(batch):
            out = [[], [], [], []]
            for d in range(len(ids)):
                data = raw[offsets[d] : offsets[d + 1]]
                mine = lists[d].values
                spans = removed = 0
                left = data
                if mine is not None and len(mine):
                    start, n = unpacked(mine.to_numpy())
                    edge = np.zeros(len(data) + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n - 1 + LENGTH, -1)
                    off = np.cumsum(edge[:-1]) > 0
                    removed = int(off.sum())
                    spans = int(off[0]) + int((off[1:] & ~off[:-1]).sum())
                    left = data[~off]
                for values, v in zip(out, (len(data), removed, spans, hashlib.sha256(left.tobytes()).hexdigest()), strict=True):
                    values.append(v)
            yield pa.RecordBatch.from_arrays([named, *(pa.array(v, pa.int64()) for v in out[:3]), pa.array(out[3], pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def dedup(docs: DataFrame) -> DataFrame:
    """Bytes and removed bytes of every row of ``docs``."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("id"),
                        F.expr(f"xxhash64(text) & {(1 << _TAG_BITS) - 1}L").alias("tag"), "text")
    found = stage(_by_bucket(keyed.mapInArrow(_sampled, ROWS)), "runs")

    def by_doc(runs: DataFrame) -> DataFrame:
        tag = F.expr(f"shiftright(run, {_START_BITS + _RUN_BITS}) & {(1 << _TAG_BITS) - 1}L")
        return runs.groupBy("id", tag.alias("tag")).agg(F.collect_list("run").alias("runs"))  # bounded by the document's length

    edges = keyed.join(by_doc(found.filter("edge").select("id", "run")), ["id", "tag"]).select("id", "tag", "text", "runs")
    single = _by_bucket(edges.mapInArrow(_ranked, ROWS))
    removed = by_doc(found.filter("not edge").select("id", "run").unionByName(single.select("id", "run")))
    rows = keyed.join(removed, ["id", "tag"], "left").select("id", "tag", "text", "runs", F.when(F.col("id") != F.lit(_FIRST), F.col("id")).alias("doc_id"))
    return rows.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


ORACLE = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, md5(substr(x, 2 * i - 1, 200)) AS s FROM (SELECT doc_id, x, unnest(range(1, CAST(length(x) / 2 AS BIGINT) - 98)) AS i FROM d WHERE length(x) >= 200)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w),
g AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM r WHERE k > 1),
-- the parts between removed runs, and the runs themselves, by their first and last starts
a AS (SELECT doc_id, i AS first, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g WHERE p IS NULL OR i > p + 100),
z AS (SELECT doc_id, i + 99 AS last, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g WHERE n IS NULL OR n > i + 100),
spans AS (SELECT a.doc_id, a.k, first, last, lag(last) OVER (PARTITION BY a.doc_id ORDER BY a.k) AS before FROM a JOIN z USING (doc_id, k)),
sums AS (SELECT d.doc_id, sum(last - first + 1) AS n_removed, count(*) AS n_spans,
                string_agg(substr(x, 2 * coalesce(before, 0) + 1, 2 * (first - coalesce(before, 0) - 1)), '' ORDER BY k) || substr(any_value(x), 2 * max(last) + 1) AS kept
         FROM spans JOIN d USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, CAST(length(d.x) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, d.x))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id)
"""
