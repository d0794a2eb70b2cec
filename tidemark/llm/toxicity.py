r"""Toxicity by a convolutional text classifier over hashed word embeddings.

Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z are hashed into
BUCKETS embeddings.  Filters of widths 1, 2 and 3 run over the word sequence,
each is max-pooled over the whole text, and a logistic layer follows.  The
model is trained in numpy (Adam, gradients only at the pooled places) where
the rows are: in each of ROUNDS rounds every task takes LOCAL epochs over its
rows from the same weights, and the weights of all tasks, weighted by their
rows, are averaged.

Thresholds are calibrated by language: the language is guessed from the text
alone (shares of a few letters, see ``guess``), each guess has the threshold
that is best on calibration rows, and the score is the logit moved by that
threshold, so that 0.5 is the cut for every language.  A guess with too few
calibration rows takes the pooled threshold.

Rows whose crc32(doc_id as text) mod 5 is 0 are never learnt from.  All other
labelled rows with a word are, whole: four fifths of them train the weights and
the words' counts, one fifth (by a hash of the doc_id) sets the thresholds;
where that fifth has too few rows of a class, all rows do both.  Both classes
have the same weight.  ``labels``, ``lang``, ``source`` and ``doc_id`` are no
inputs of a score.

Scale: a text is reduced to two bytes a word before it meets its label, by a
join of one form at every size, and that table is written once.  Of the
embeddings only those of words that are learnt travel; the others stay empty.
A task learns from its rows in order of their doc_id.  The driver holds the
weights, the words' counts and the histograms of the thresholds, whose sizes
are fixed by parameters; scoring is map-only over whole texts, a block of text
at a time.

Defined cases: null and empty texts have no words: their score is that of
empty pools; a null doc_id counts as empty text in the crc32; labels that are
null are not learnt from, repeated ones count repeatedly; without labelled
rows of both classes every score is 0 and no row is predicted; empty tables
give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text as X
from ._stage import stage

FOLDS = 5
#: rounds of averaging, epochs of a task in each, training rows that a task should have
ROUNDS, LOCAL, TASK_ROWS = 3, 2, 4000
BUCKETS = 1 << 16
#: training texts that must hold a word; all rarer words share a fixed empty embedding:
LEAST_TEXTS, LEAST_SHARE = 4, 0.015  # ... this share of the toxic ones at least
DROP = 0.3  # of the words of a training text, anew in each step
DIM, FILTERS, WIDTHS = 12, 8, (1, 2, 3)
STEPS, BATCH, RATE = 500, 64, 0.01  # at least so many steps in all
#: weight of false alarms against recall in a threshold
FALSE = 4.0
#: rows of a language guess, of either class, that a threshold of its own needs
LEAST = 15
#: thresholds are set on bins of the logit
BINS, SPAN = 1 << 14, 40.0
CHUNK = 1 << 15  # numbers that travel together
#: Letters that point to a language (UTF-8), in the order of the guesses 1..3; 0 is the rest.
MARKS = ("äöüß", "ñóí", "éèêç")
_OFFSETS = tuple((w, o) for w in WIDTHS for o in range(w))


@dataclass
class Model:
    """table: response of each bucket for every (width, offset, filter); out: weights of the pooled filters; cut: threshold a guess."""

    table: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: float
    cut: np.ndarray


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding bucket of each word, and first word of each document (one more at the end)."""
    low = X.LOWER[raw]
    starts, ends, doc = X.span_words(low, offsets, X.PLAIN)
    ids = (X.span_hash(X.prefix_hash(low), starts, ends) >> np.uint64(48)).astype(np.int64) % BUCKETS
    return ids, np.searchsorted(doc, np.arange(len(offsets)))


def guess(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Language guess of each document from its letters."""
    counts = [np.full(len(offsets) - 1, 0.0)]
    pair = raw[:-1].astype(np.int64) << 8 | raw[1:] if len(raw) > 1 else np.zeros(0, np.int64)
    for marks in MARKS:
        codes = [int.from_bytes(c.encode(), "big") for m in marks for c in {m, m.upper()} if len(c.encode()) == 2]
        counts.append(X.per_doc(np.append(np.isin(pair, codes), np.zeros(len(raw) - len(pair), bool)), offsets) + 0.0)
    counts[0] = np.diff(offsets) / 150.0
    return np.argmax(np.stack(counts), axis=0)


def pooled(ids: np.ndarray, bounds: np.ndarray, table: np.ndarray, shift: np.ndarray, places: bool = False):
    """Max over each document of every filter's response (0 floor), and where it was."""
    docs = len(bounds) - 1
    out = np.zeros((docs, len(WIDTHS) * FILTERS), table.dtype)
    where = np.full(out.shape, -1, np.int64)
    size = np.diff(bounds)
    for k, width in enumerate(WIDTHS):
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        ok = np.flatnonzero(size >= width)
        if not len(ok):
            continue
        n = len(ids) - width + 1
        resp = np.zeros((n, FILTERS), table.dtype)
        for o in range(width):
            part = _OFFSETS.index((width, o)) * FILTERS
            resp += table[ids[o : o + n], part : part + FILTERS]
        # places of each document that hold a whole window; the gaps between are left out of the maxima
        lo, hi = bounds[ok], bounds[ok] + size[ok] - width + 1
        cuts = np.stack([lo, np.minimum(hi, n - 1)], axis=1).ravel()
        best = np.maximum.reduceat(resp, cuts, axis=0)[::2]
        lone = hi >= n  # the last document ends with the array
        if lone.any():
            for i in np.flatnonzero(lone):
                best[i] = resp[lo[i] : hi[i]].max(axis=0)
        out[ok, cols] = np.maximum(best + shift[cols], 0)
        if places:
            for i, d in enumerate(ok):
                where[d, cols] = lo[i] + resp[lo[i] : hi[i]].argmax(axis=0)
    return (out, where) if places else out


def start(rare: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Weights before training: embeddings, filters, their shifts, output weights, bias."""
    rng = np.random.default_rng(seed)
    n = len(WIDTHS) * FILTERS
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    emb[rare] = 0
    conv = rng.normal(0, 0.3, (len(_OFFSETS), DIM, FILTERS)).astype(np.float32)
    return [emb, conv, np.zeros(n, np.float32), rng.normal(0, 0.3, n).astype(np.float32), np.zeros(1, np.float32)]


def train(params: list[np.ndarray], rare: np.ndarray, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epochs: int, seed: int) -> None:
    """Improve ``params`` in place on word buckets, labels and the two classes' weights."""
    rng = np.random.default_rng(seed)
    emb, conv, shift, out, bias = params
    empty = int(np.flatnonzero(rare)[0]) if rare.any() else 0
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            pick = order[lo : lo + BATCH]
            ids = np.concatenate([texts[i] for i in pick]) if len(pick) else np.zeros(0, np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
            ids = np.where(rng.random(len(ids)) < DROP, empty, ids)
            used, local = np.unique(ids, return_inverse=True)
            table = np.concatenate([emb[used] @ conv[j] for j in range(len(_OFFSETS))], axis=1)
            if not len(used):
                continue
            pool, where = pooled(local, bounds, table, shift, places=True)
            p = 1 / (1 + np.exp(-(pool @ out + bias[0])))
            d = ((p - y[pick]) * weight[y[pick]] / len(pick)).astype(np.float32)
            grads = [np.zeros((len(used), DIM), np.float32), np.zeros_like(conv), np.zeros_like(shift), pool.T @ d + 1e-4 * out, np.array([d.sum()], np.float32)]
            back = d[:, None] * out * (pool > 0)
            grads[2] = back.sum(axis=0)
            grads[0] += 3e-4 * emb[used]
            for j, (width, o) in enumerate(_OFFSETS):
                for f in range(FILTERS):
                    c = WIDTHS.index(width) * FILTERS + f
                    live = np.flatnonzero((where[:, c] >= 0) & (back[:, c] != 0))
                    if len(live):
                        word = local[where[live, c] + o]
                        np.add.at(grads[0], word, back[live, c][:, None] * conv[j, :, f])
                        grads[1][j, :, f] += back[live, c] @ emb[used[word]]
            grads[0][rare[used]] = 0
            step += 1
            for i, g in enumerate(grads):
                at = used if i == 0 else slice(None)
                m[i][at] = 0.9 * m[i][at] + 0.1 * g
                v[i][at] = 0.99 * v[i][at] + 0.01 * g * g
                params[i][at] -= RATE * (m[i][at] / (1 - 0.9**step)) / (np.sqrt(v[i][at] / (1 - 0.99**step)) + 1e-7)


def as_model(params: list[np.ndarray]) -> Model:
    emb, conv, shift, out, bias = params
    return Model(np.concatenate([emb @ conv[j] for j in range(len(_OFFSETS))], axis=1), shift, out, float(bias[0]), np.zeros(len(MARKS) + 1))


def logits(model: Model, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if not len(ids):
        return np.full(len(bounds) - 1, model.bias)
    return pooled(ids, bounds, model.table, model.shift) @ model.out.astype(np.float64) + model.bias


def best_cut(clean: np.ndarray, toxic: np.ndarray) -> float:
    """Threshold in the middle of where recall less FALSE times the share of false alarms is highest; rows a bin of the logit."""
    # cost of the rows left of each bin's edge: clean ones let through count for it
    gain = FALSE * np.concatenate([[0], np.cumsum(clean)]) / max(1, clean.sum()) - np.concatenate([[0], np.cumsum(toxic)]) / max(1, toxic.sum())
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return (2.0 * int(best[len(best) // 2]) / BINS - 1) * SPAN


def calibrate(rows: np.ndarray) -> np.ndarray:
    """Threshold of each language guess; ``rows``: counts by (guess, label, bin)."""
    out = np.full(len(rows), best_cut(*rows.sum(axis=0)))
    for g, (clean, toxic) in enumerate(rows):
        if min(clean.sum(), toxic.sum()) >= LEAST:
            out[g] = best_cut(clean, toxic)
    return out


def _total(rows: DataFrame, columns: list[str], size: int, make) -> np.ndarray:
    """Sum over all tasks of ``make(list of row tuples, task)``, an array of ``size`` numbers; added chunk by chunk across tasks."""

    def partial(batches):
        got = [r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(len(columns))), strict=True)]
        if got:
            data = make(got).astype(np.float64)
            at = range(0, size, CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array([i // CHUNK for i in at], pa.int32()), pa.array([data[i : i + CHUNK].tobytes() for i in at], pa.binary())], ["g", "sums"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for g, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[g] = total[g] + np.frombuffer(data) if g in total else np.frombuffer(data)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["g", "sums"])

    out = np.zeros(size)
    schema = "g int, sums binary"
    for r in rows.select(*columns).mapInArrow(partial, schema).repartition("g").mapInArrow(add, schema).collect():
        out[r["g"] * CHUNK : (r["g"] + 1) * CHUNK] = np.frombuffer(r["sums"])
    return out


def learnt_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, spare, lang, ids) of every labelled row with a word outside the held-out fold; ``ids``: two bytes a word, the whole text."""
    learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS != 0
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(learn & F.col("toxic").isin(0, 1))
    fields = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("lang", T.LongType())])

    def make():
        def run(raw, offsets):
            ids, bounds = words(raw, offsets)
            ids = ids.astype(np.uint16)
            return [[ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], guess(raw, offsets)]

        return run

    found = X.map_text(docs.select("doc_id", "text").filter(learn), "text", ["doc_id"], fields, "x", make).filter(F.length("x.ids") > 0)
    spare = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    return found.join(known.hint("merge"), "doc_id").select("doc_id", "toxic", spare.alias("spare"), "x.lang", "x.ids")


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The calibrated model, or None without labelled rows of both classes."""
    rows = stage(learnt_rows(docs, labels), "toxicity")
    counts = {(r["spare"], r["toxic"]): r["n"] for r in rows.groupBy("spare", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    split = min(counts.get((True, 0), 0), counts.get((True, 1), 0)) >= LEAST and min(counts.get((False, 0), 0), counts.get((False, 1), 0)) > 0
    learn, test = (rows.filter(~F.col("spare")), rows.filter("spare")) if split else (rows, rows)
    each = np.array([sum(n for (s, y), n in counts.items() if y == label and not (split and s)) for label in (0, 1)], np.float64)
    if not each.all():
        return None
    learn = learn.coalesce(max(1, int(each.sum()) // TASK_ROWS))
    context = docs.sparkSession.sparkContext

    def texts_with(got):
        n = np.zeros(BUCKETS)
        for (ids,) in got:
            n[np.unique(np.frombuffer(ids, np.uint16))] += 1
        return n

    rare = _total(learn, ["ids"], BUCKETS, texts_with) < max(LEAST_TEXTS, LEAST_SHARE * each[1])
    params = start(rare)
    learnt = np.flatnonzero(~rare)  # the embeddings of all other words stay at zero
    ends = np.cumsum([0, len(learnt) * DIM] + [p.size for p in params[1:]])
    epochs = max(LOCAL, -(-STEPS * BATCH // (int(each.sum()) * ROUNDS)))
    weight = each.sum() / (2 * each)
    for k in range(ROUNDS):
        shared = context.broadcast(params)

        def improved(got, shared=shared, k=k):
            own = [p.copy() for p in shared.value]
            got.sort()
            y = np.array([r[1] for r in got], np.int64)
            train(own, rare, [np.frombuffer(r[2], np.uint16).astype(np.int64) for r in got], y, weight, epochs, 7 + k)
            return len(got) * np.append(np.concatenate([own[0][learnt].ravel(), *[p.ravel() for p in own[1:]]]).astype(np.float64), 1.0)

        total = _total(learn, ["doc_id", "toxic", "ids"], int(ends[-1]) + 1, improved)
        mean = [(total[a:b] / total[-1]).astype(np.float32) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        params = [np.zeros_like(params[0]), *[m.reshape(p.shape) for m, p in zip(mean[1:], params[1:], strict=True)]]
        params[0][learnt] = mean[0].reshape(-1, DIM)
        shared.unpersist()
    model = as_model(params)
    fitted = context.broadcast(model)

    def binned(got):
        n = np.zeros((len(MARKS) + 1, 2, BINS))
        for y, lang, ids in got:
            ids = np.frombuffer(ids, np.uint16).astype(np.int64)
            z = logits(fitted.value, ids, np.array([0, len(ids)]))[0]
            n[lang, y, int(np.clip((z / SPAN + 1) / 2 * BINS, 0, BINS - 1))] += 1
        return n.ravel()

    model.cut = calibrate(_total(test, ["toxic", "lang", "ids"], (len(MARKS) + 1) * 2 * BINS, binned).reshape(-1, 2, BINS))
    return model


FIELDS = T.StructType([T.StructField("score", T.DoubleType())])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def make():
        own = model.value

        def run(raw, offsets):
            if own is None:
                return [np.zeros(len(offsets) - 1)]
            z = logits(own, *words(raw, offsets)) - own.cut[guess(raw, offsets)]
            return [1 / (1 + np.exp(-np.clip(z, -50, 50)))]

        return run

    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    return X.map_text(docs, "text", ["doc_id"], FIELDS, "s", make).select(
        "doc_id", held.alias("held_out"), F.col("s.score").alias("score"), (F.col("s.score") >= 0.5).cast("int").alias("predicted"))
