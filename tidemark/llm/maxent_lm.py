r"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

Tokens are the words ``[^\x20\x09-\x0D]+`` after lower-casing A-Z and one end
token a document.  Training documents are those whose crc32(doc_id as text)
mod 10 is not 0; what is learnt covers all of them.

* Base: add-0.1 unigram, c token count, N all, V distinct training tokens;
  everything never seen counts as one further type.
* Classes: M(w | h) = P(class(w) | h) * P_base(w) / P_base(class(w)).  The TOP most
  frequent tokens are classes of their own, the rest fall into hashed classes,
  unseen words into the last.  P(class | h) is a softmax over the classes' base
  masses (bias) plus three hashed feature rows: the word before (bigram), the
  two words before (trigram) and the word before that one alone (skip).
  M sums to one over the V + 1 types.
* Model: P(w | h) = (1 - l) * M(w | h) + l * n(u, w) / n(u), l = n(u) / (n(u) + PAIR_PRIOR):
  u is the word before (or the start of the text), n(u, w) counts the training
  tokens w after u, n(u) all tokens after u.  So history tells words of one
  class apart wherever it was observed with them, in the whole corpus.  Both
  parts sum to one over the V + 1 types, and so does P.

Training: one pass counts the observed (feature, class) pairs, which are the
sufficient statistics and give the start weights; then ROUNDS distributed
gradient updates: every task scores its blocks in sparse numpy batches and
sums the expected counts, the sums are added by row group across tasks, and
the observed-minus-expected gradient, scaled by how often a row was seen,
updates the weights.

Scale: the texts are read once and packed into blocks of about two megabytes
(distinct word hashes, word indices, document sizes), a table in the shared
checkpoint folder that all passes read.  A block's distinct words travel once, and so do
its distinct word pairs: as sorted hashes with their counts in the block, cut
into ranges of the hash; the totals of a range come back to each block in the
order in which it sent its hashes, without them.  The number of ranges grows
with the blocks, so that a range holds the words of about WORD_PART blocks or
the pairs of about PART blocks, however often one word occurs.  Blocks meet
their totals once, with their hashes as differences.  The driver holds the
weights and the class masses, whose sizes are fixed by parameters.  Words are
64-bit hashes.

Defined cases: a null or empty text is its end token; a null doc_id counts as
empty text in the crc32; rows are scored one by one, repeated or not; an empty
table gives an empty result; without training documents all words are unseen;
only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text as X
from ._stage import small_batches, stage
from ._text import packed, unpacked, unplaned  # noqa: F401  (tests read blocks with unplaned)

FOLDS = 10
SMOOTH = 0.1
CLASSES, TOP = 32, 23
BUCKETS = 1 << 13
FEATURES = 3
ROUNDS = 2
#: pseudo-count of the bias in a feature row, and weight of each of the three rows at the start
PRIOR, START = 20.0, 0.45
#: step of a gradient update
STEP = 0.6
BLOCK = 2 << 20
BATCH = 1 << 13
GROUP = 128  # weight rows that travel together
#: pseudo-count of the class model beside the tokens seen after a word
PAIR_PRIOR = 40.0
#: a range of hashes holds the pairs, or the words, of about so many blocks
PART, WORD_PART = 2, 8
#: tasks a core in which weight sums are made; each sends one sum
SUMS = 3
_END = 0x5DEECE66D1CE4E5B
_START = np.uint64(0x2545F4914F6CDD1D)

BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("held", T.ArrayType(T.BooleanType())),
    T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("vocabulary", T.BinaryType()), T.StructField("train", T.BinaryType()),
    T.StructField("words", T.BinaryType())])


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == 0


def gathered(batches):
    """Batches joined to about BLOCK bytes, so that a block's words and pairs are told apart once."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > BLOCK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def pack(docs: DataFrame) -> DataFrame:
    """Blocks of whole documents: distinct word hashes, their counts in training documents, word indices in order."""

    def run(batches):
        serial = TaskContext.get().partitionId() << 33
        for batch in gathered(batches):
            at, ids = 0, batch.column(0)
            for raw, offsets in X.blocks(batch.column(1), BLOCK):
                n = len(offsets) - 1
                mine = ids.slice(at, n)
                at += n
                held = np.array([is_held_out(x) for x in mine.to_pylist()], bool)
                low = X.LOWER[raw]
                starts, ends, doc = X.span_words(low, offsets, X.SPACED)
                vocabulary, back, times = np.unique(X.span_hash(X.prefix_hash(low), starts, ends), return_inverse=True, return_counts=True)
                often = np.argsort(-times, kind="stable")  # small indices for frequent words
                place = np.empty(len(often), np.uint32)
                place[often] = np.arange(len(often), dtype=np.uint32)
                vocabulary, back = vocabulary[often], place[back]
                train = np.bincount(back[~held[doc]], minlength=len(vocabulary)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([serial], pa.int64()), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), mine.combine_chunks() if isinstance(mine, pa.ChunkedArray) else mine),
                    pa.array([held.tolist()], pa.list_(pa.bool_())), pa.array([np.bincount(doc, minlength=n).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([vocabulary.tobytes()], pa.binary()), pa.array([train.tobytes()], pa.binary()), pa.array([packed(back)], pa.binary())], BLOCKS.names)
                serial += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCKS)


def _rows(batch: pa.RecordBatch):
    """(name -> value) of each block; byte columns as numpy arrays."""
    for r in range(batch.num_rows):
        out = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            value = column[r]
            if name in ("vocabulary", "train", "words"):
                out[name] = np.frombuffer(value.as_buffer(), {"vocabulary": np.uint64, "train": np.uint32}.get(name, np.uint8))
            elif name == "doc_ids":
                out[name] = value.values
            else:
                out[name] = value.values.to_numpy(zero_copy_only=False) if isinstance(value, pa.ListScalar) else value.as_py()
        if "steps" in out:  # of coded()
            out["vocabulary"] = np.cumsum(unpacked(out.pop("steps"), out["n_vocabulary"], np.uint64), dtype=np.uint64)
        if "words" in out:
            out["words"] = unpacked(out["words"], int(out["sizes"].sum()), np.uint32).astype(np.int64)
        yield out


def coded(blocks: DataFrame) -> DataFrame:
    """Blocks as they are shuffled to their totals: hashes as steps from one to the next.

    Words of one frequency are in order of their hashes, so a step has about six bytes.
    """
    schema = T.StructType([f for f in blocks.schema if f.name != "vocabulary"] + [T.StructField("n_vocabulary", T.LongType()), T.StructField("steps", T.BinaryType())])

    def run(batches):
        for batch in batches:
            hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("vocabulary")]
            rest = batch.drop_columns(["vocabulary"])
            steps = pa.array([packed(np.diff(h, prepend=np.uint64(0))) for h in hashes], pa.binary())
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array([len(h) for h in hashes], pa.int64()), steps], schema.names)

    return blocks.mapInArrow(run, schema)


@dataclass(frozen=True)
class Classes:
    """Base masses: tokens, types, the hashes of the classes of one word, log mass of each class."""

    tokens: int
    types: int
    end: int
    top: np.ndarray  # sorted hashes
    top_class: np.ndarray
    log_mass: np.ndarray

    @property
    def total(self) -> float:
        return self.tokens + SMOOTH * (self.types + 1)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Class of each hash, as if it was seen in training."""
        out = TOP + (hashes % np.uint64(CLASSES - TOP)).astype(np.int64)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
            hit = self.top[at] == hashes
            out[hit] = self.top_class[at[hit]]
        return out


def features(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Weight rows (tokens x 3) of each token's history; ``first``: position of the token in its document."""
    one = np.concatenate([[_START], words[:-1]])
    one[first == 0] = _START
    two = np.concatenate([[_START, _START], words[:-2]])[: len(words)]
    two[first <= 1] = _START
    b = np.uint64(BUCKETS)
    rows = np.empty((len(words), FEATURES), np.int64)
    rows[:, 0] = X.mix(one) % b
    rows[:, 1] = X.mix(one * np.uint64(3) + X.mix(two)) % b
    rows[:, 2] = X.mix(two + np.uint64(0xC0FFEE)) % b
    return rows + np.arange(FEATURES) * BUCKETS


def histories(rows: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Distinct weight rows in order, how often each occurs (float32), and the place of each token among them (``back``).

    Tokens with one history have one softmax, which is computed once a block.
    """
    size = np.int64(BUCKETS)
    key = (rows[:, 0] * size + rows[:, 1] - size) * size + rows[:, 2] - 2 * size
    inverse = None
    if back:
        key, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    else:
        key, times = np.unique(key, return_counts=True)
    return np.stack([key // size // size, key // size % size + size, key % size + 2 * size], axis=1), times.astype(np.float32), inverse


def sequence(block: dict, with_end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token hash, position in document, document, vocabulary index or -1) of a block's tokens, end tokens included."""
    sizes = block["sizes"].astype(np.int64)
    ends = np.cumsum(sizes + 1) - 1
    n = int(sizes.sum()) + len(sizes)
    inner = np.ones(n, bool)
    inner[ends] = False
    index = np.full(n, -1, np.int64)
    index[inner] = block["words"]
    hashes = np.full(n, _END, np.uint64)
    hashes[inner] = block["vocabulary"][block["words"]]
    doc = np.repeat(np.arange(len(sizes)), sizes + 1)
    return hashes, np.arange(n) - np.repeat(ends - sizes, sizes + 1), doc, index


def raised(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """exp of the class scores of a batch; ``weights`` hold the bias in the rows of the first feature.

    Weights are bounded (START, STEP and their clips), so that no score
    overflows and no maximum need be taken off.
    """
    z = weights[rows[:, 0]]
    z += weights[rows[:, 1]]
    z += weights[rows[:, 2]]
    return np.exp(z, out=z)


def with_bias(weights: np.ndarray, log_mass: np.ndarray) -> np.ndarray:
    out = weights.astype(np.float32)
    out[:BUCKETS] += log_mass.astype(np.float32)
    return out


def _summed(partials: DataFrame) -> np.ndarray:
    """Sum over all tasks of (group, float32 rows) partials; FEATURES * BUCKETS rows of CLASSES floats reach the driver."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for g, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(data.as_buffer(), np.float32)
                total[g] = total[g] + part if g in total else part.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["g", "sums"])

    out = np.zeros((FEATURES * BUCKETS, CLASSES))
    for row in partials.repartition("g").mapInArrow(run, "g int, sums binary").collect():
        out[row["g"] * GROUP : (row["g"] + 1) * GROUP] = np.frombuffer(row["sums"]).reshape(-1, CLASSES)
    return out


def _partials(blocks: DataFrame, classes: Classes, weights: np.ndarray | None) -> DataFrame:
    """Each task's sums over its training tokens: observed (row, class) counts, or expected ones under ``weights``."""
    shared = blocks.sparkSession.sparkContext.broadcast((classes, None if weights is None else with_bias(weights, classes.log_mass)))

    def run(batches):
        model, w = shared.value
        total = np.zeros((FEATURES * BUCKETS, CLASSES), np.float64 if w is not None else np.int64)
        for batch in batches:
            for block in _rows(batch):
                hashes, first, doc, _ = sequence(block)
                keep = ~block["held"][doc]
                rows = features(hashes, first)[keep]
                if w is None:
                    target = model.of(hashes[keep])
                    for f in range(FEATURES):
                        np.add(total, np.bincount(rows[:, f] * CLASSES + target, minlength=total.size).reshape(total.shape), out=total)
                    continue
                rows, times, _ = histories(rows, False)
                for lo in range(0, len(rows), BATCH):
                    part = rows[lo : lo + BATCH]
                    p = raised(part, w)
                    p *= (times[lo : lo + BATCH] / p.sum(axis=1))[:, None]
                    for f in range(FEATURES):
                        at, each = part[:, f], p
                        if f:  # histories are in order of the first feature
                            order = np.argsort((at - f * BUCKETS).astype(np.uint16), kind="stable")  # a radix sort
                            at, each = at[order], p[order]
                        begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                        total[at[begin]] += np.add.reduceat(each, begin, axis=0)
        groups = np.flatnonzero(total.any(axis=1).reshape(-1, GROUP).any(axis=1))
        data = [total[g * GROUP : (g + 1) * GROUP].astype(np.float32).tobytes() for g in groups.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(groups.astype(np.int32)), pa.array(data, pa.binary())], ["g", "sums"])

    tasks = SUMS * blocks.sparkSession.sparkContext.defaultParallelism
    return blocks.select("held", "sizes", "vocabulary", "words").coalesce(tasks).mapInArrow(run, "g int, sums binary")


def start_weights(observed: np.ndarray, log_mass: np.ndarray) -> np.ndarray:
    """Each row's shrunk log ratio of its class shares to the base masses."""
    seen = observed.sum(axis=1, keepdims=True)
    mass = np.exp(log_mass)
    return START * (np.log((observed + PRIOR * mass) / (seen + PRIOR)) - log_mass)


def gradient_step(weights: np.ndarray, observed: np.ndarray, expected: np.ndarray, log_mass: np.ndarray) -> np.ndarray:
    """Weights after one update; the gradient of a weight is scaled by the counts that it moves."""
    scale = np.maximum(observed, expected) + PRIOR * np.exp(log_mass)
    return np.clip(weights + STEP * np.clip((observed - expected) / scale, -2, 2), -12, 12)


def ranges(blocks: DataFrame, each: int) -> int:
    """Ranges of a hash that hold what about ``each`` blocks send."""
    return max(1, -(-blocks.count() // each))


def _totals(blocks: DataFrame, parts: int, own, columns: list[str], listed: bool) -> DataFrame:
    """(block, part, n, counts, keys): sums over all blocks for the hashes of each, in order of its hashes, cut by ranges of the hash.

    ``own(block)`` gives a block's sorted hashes and their counts in it; it
    reads ``columns``.  A block sends a range's hashes as differences, so that
    a hash costs about six bytes.  ``listed``: a further row a range, with a
    null block, holds its distinct hashes and their sums.
    """
    bounds = np.array([i * (1 << 64) // parts for i in range(parts)], np.uint64)

    def ask(batches):
        for batch in batches:
            for block in _rows(batch):
                keys, train = own(block)
                edges = np.append(np.searchsorted(keys, bounds), len(keys))
                some = np.flatnonzero(np.diff(edges))
                cut = [slice(edges[p], edges[p + 1]) for p in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array(some.astype(np.int32)), pa.array(np.full(len(some), block["block"])), pa.array(np.diff(edges)[some].astype(np.int32)),
                    pa.array([packed(np.diff(keys[c], prepend=bounds[p])) for p, c in zip(some, cut, strict=True)], pa.binary()),
                    pa.array([packed(train[c]) for c in cut], pa.binary())], ["part", "block", "n", "keys", "train"])

    def total(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        each = table.column("n").to_pylist()
        keys = np.concatenate([bounds[part] + np.cumsum(unpacked(x.as_buffer(), n, np.uint64), dtype=np.uint64) for x, n in zip(table.column("keys"), each, strict=True)])
        order = np.argsort(keys)
        keys = keys[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(begin, len(keys)))
        distinct = keys[begin] if listed else None
        del keys
        train = np.concatenate([unpacked(x.as_buffer(), n, np.uint32) for x, n in zip(table.column("train"), each, strict=True)])
        own_sums = np.add.reduceat(train[order], begin, dtype=np.uint64)
        sums = np.empty(len(order), np.uint64)
        sums[order] = np.repeat(own_sums, size)
        columns = [table.column("block").to_pylist(), each, [packed(x) for x in np.split(sums, np.cumsum(each)[:-1])], [None] * len(each)]
        if listed:
            for column, value in zip(columns, (None, len(distinct), packed(own_sums), distinct.tobytes()), strict=True):
                column.append(value)
        block, n, counts, keys = columns
        return pa.table([pa.array(block, pa.int64()), pa.array([part] * len(n), pa.int32()), pa.array(n, pa.int32()), pa.array(counts, pa.binary()), pa.array(keys, pa.binary())],
                        ["block", "part", "n", "counts", "keys"])

    asked = blocks.select(*columns).mapInArrow(ask, "part int, block long, n int, keys binary, train binary")
    return asked.groupBy("part").applyInArrow(total, "block long, part int, n int, counts binary, keys binary")


def _told(totals: DataFrame, name: str) -> DataFrame:
    """(block, ``name``): a block's rows of :func:`_totals` in order of the hashes."""
    return totals.filter("block is not null").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "n", "counts"))).alias(name))


def told_counts(told: pa.StructArray) -> np.ndarray:
    """Training counts of what a block sent, in order of the hashes, from its row of :func:`_told`."""
    return np.concatenate([unpacked(x.as_buffer(), n, np.uint64) for n, x in zip(told.field(1).to_pylist(), told.field(2), strict=True)])


def word_order(block: dict) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct tokens, the end token last, and their order by hash."""
    hashes = np.append(block["vocabulary"], np.uint64(_END))
    return hashes, np.argsort(hashes, kind="stable")


def word_totals(blocks: DataFrame) -> DataFrame:
    """Training counts of each block's distinct words and the end token, in all blocks."""

    def own(block):
        hashes, order = word_order(block)
        return hashes[order], np.append(block["train"], np.uint32((~block["held"]).sum()))[order]

    return _totals(blocks, ranges(blocks, WORD_PART), own, ["block", "held", "vocabulary", "train"], True)


def listed_words(totals: DataFrame) -> DataFrame:
    """(hash, c): training count of each word with one, end token included, from :func:`word_totals`."""

    def run(batches):
        for batch in batches:
            for n, counts, keys in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                c = unpacked(counts.as_buffer(), n, np.uint64).view(np.int64)
                seen = c > 0
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys.as_buffer(), np.int64)[seen]), pa.array(c[seen])], ["hash", "c"])

    return totals.filter("block is null").select("n", "counts", "keys").mapInArrow(run, "hash long, c long")


def count_words(blocks: DataFrame) -> DataFrame:
    """(hash, c): training count of each word with one, end token included."""
    return listed_words(word_totals(blocks))


def fit_classes(counts: DataFrame) -> Classes:
    """Class masses over all counts; TOP rows and CLASSES - TOP sums reach the driver."""
    rest = CLASSES - TOP
    top = counts.orderBy(F.col("c").desc(), "hash").limit(TOP).collect()
    slot = F.pmod(F.expr(f"cast(conv(hex(hash), 16, 10) as decimal(20,0)) % {rest}"), F.lit(rest)).cast("int")
    sums = counts.groupBy(slot.alias("slot")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("types")).collect()
    end = counts.filter(F.col("hash") == int(np.uint64(_END).astype(np.int64))).collect()
    mass = np.zeros(CLASSES)
    tokens = types = 0
    for r in sums:
        mass[TOP + r["slot"]] += r["c"] + SMOOTH * r["types"]
        tokens, types = tokens + r["c"], types + r["types"]
    hashes = np.array([r["hash"] for r in top], np.int64).view(np.uint64)
    for i, r in enumerate(top):
        mass[i] += r["c"] + SMOOTH
        mass[TOP + int(hashes[i] % np.uint64(rest))] -= r["c"] + SMOOTH
    mass[CLASSES - 1] += SMOOTH  # the type of all unseen words
    order = np.argsort(hashes)
    log_mass = np.log(np.maximum(mass, 1e-6) / (tokens + SMOOTH * (types + 1)))
    return Classes(tokens, types, end[0]["c"] if end else 0, hashes[order], order, log_mass)


def fit(blocks: DataFrame, classes: Classes, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (FEATURES * BUCKETS rows of CLASSES), trained on every training token."""
    observed = _summed(_partials(blocks, classes, None))
    weights = start_weights(observed, classes.log_mass)
    for _ in range(rounds):
        weights = gradient_step(weights, observed, _summed(_partials(blocks, classes, weights)), classes.log_mass)
    return weights


SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
                       T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
                       T.StructField("score", T.DoubleType())])


def pair_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of (the word before, token) of each token; the first one of a document comes after a start of its own."""
    one = np.concatenate([[_START], hashes[:-1]])
    one[first == 0] = _START
    return X.mix(one * np.uint64(3) + X.mix(hashes))


def count_pairs(blocks: DataFrame, parts: int) -> DataFrame:
    """(block, pairs): training counts of a block's distinct pairs in all blocks, in order of their hashes, cut by ranges of the hash."""

    def own(block):
        hashes, first, doc, _ = sequence(block)
        keys, back = np.unique(pair_keys(hashes, first), return_inverse=True)
        return keys, np.bincount(back[~block["held"][doc]], minlength=len(keys)).astype(np.uint32)

    return _told(_totals(blocks, parts, own, ["block", "held", "sizes", "vocabulary", "words"], False), "pairs")


def pair_counts(told: pa.StructArray) -> np.ndarray:
    """Training counts of a block's distinct pairs, in order of their hashes, from its row of :func:`count_pairs`."""
    return told_counts(told)


def score_blocks(blocks: DataFrame, totals: DataFrame, classes: Classes, weights: np.ndarray) -> DataFrame:
    """Base and model log10 probability of every document of ``blocks``; ``totals``: their :func:`word_totals`."""
    shared = blocks.sparkSession.sparkContext.broadcast((classes, with_bias(weights, classes.log_mass)))

    def score(batches):
        model, w = shared.value
        for batch in batches:
            column, after = (batch.column(batch.schema.get_field_index(x)) for x in ("told", "pairs"))
            for r, block in enumerate(_rows(batch.drop_columns(["told", "pairs"]))):
                hashes, first, doc, index = sequence(block)
                _, by_hash = word_order(block)
                c = np.empty(len(by_hash), np.int64)
                c[by_hash] = told_counts(column[r].values)
                count = c[index]  # the end token's index and place are the last
                base = np.log10((count + SMOOTH) / model.total)
                target = np.where(count > 0, model.of(hashes), CLASSES - 1)
                rows, _, place = histories(features(hashes, first), True)
                order = np.argsort(place, kind="stable")
                place, gain = place[order], np.empty(len(order))
                for lo in range(0, len(rows), BATCH):
                    p = raised(rows[lo : lo + BATCH], w)
                    p /= p.sum(axis=1, keepdims=True)
                    mine = slice(*np.searchsorted(place, (lo, lo + BATCH)))
                    t = target[order[mine]]
                    gain[order[mine]] = np.log(p[place[mine] - lo, t], dtype=np.float64) - model.log_mass[t]
                docs = len(block["sizes"])
                before = np.concatenate([[model.end], count[:-1]])
                before[first == 0] = model.end  # tokens after a start: training documents
                del rows, place, order, target
                _, back = np.unique(pair_keys(hashes, first), return_inverse=True)
                seen = pair_counts(after[r].values)[back]
                chance = (PAIR_PRIOR * 10.0 ** (base + gain / np.log(10)) + seen) / (PAIR_PRIOR + before)
                full = np.bincount(doc, np.log10(chance), docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array(block["doc_ids"], pa.int64()), pa.array(block["held"]), pa.array(block["sizes"].astype(np.int64) + 1),
                    pa.array(np.bincount(doc[count > 0], minlength=docs).astype(np.int64)), pa.array(np.full(docs, model.tokens, np.int64)),
                    pa.array(np.bincount(doc, base, docs)), pa.array(full)], SCORES.names)

    pairs = count_pairs(blocks, ranges(blocks, PART))
    return coded(blocks.drop("train")).join(_told(totals, "told"), "block", "left").join(pairs, "block", "left").mapInArrow(score, SCORES)


def lm_scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Scores of every row of ``docs``."""
    small_batches(docs.sparkSession)
    blocks = stage(pack(docs), "blocks")
    totals = stage(word_totals(blocks), "words")
    classes = fit_classes(listed_words(totals))
    weights = fit(blocks, classes, rounds)
    return score_blocks(blocks, totals, classes, weights)
