"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Each rule looks at counts of one whole text and votes good (+1), bad (-1) or
abstains (0).  No rule rejects alone.  A latent label (good or bad) is assumed
behind the votes; expectation-maximisation over the table of vote patterns
estimates the share of good documents and how often each rule votes bad on
good and on bad ones, hence its accuracy, and a document's posterior probability of being good replaces the all-rules-must-pass filter.

Scale: one map-only pass computes the counts (staged once, a few numbers a
document); the votes collapse to at most 3^rules patterns with a count each,
which is all that reaches the driver; the posterior is a column expression.
Nothing is shuffled but partial pattern counts.

Defined cases: a null text has no words; an empty table gives an empty
result; repeated rows and null doc_ids are judged row by row; only doc_id and
the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import _text as X
from ._stage import free_name, stage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: posterior a document must reach to stay
KEEP_AT = 0.5
EM_ROUNDS = 60
#: bytes of texts that a worker counts at once (a longer text alone)
TEXT_BYTES = 1 << 19

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_bars", "n_stops")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"[#*$%&|<>]"[1:-1])] = True


def _one(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_UPPER, _DIGIT, _MARK, _BAR, _STOP = (_one(bytes(range(65, 91))), _one(b"0123456789"), _one(b"!?"), _one(b"|"), _one(b".,;:"))
_LETTER = _one(bytes(range(65, 91)) + bytes(range(97, 123))) | (~X.LEAD == False) & (np.arange(256) >= 0xC0)  # noqa: E712


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    out = np.zeros(len(keys), bool)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        same = s[1:] == s[:-1]
        out[order[1:]] |= same
        out[order[:-1]] |= same
    return out


def text_counts(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The COUNTS of each document of a block."""
    docs = len(offsets) - 1
    inside = X.SPACED[raw]
    starts, ends, doc = X.span_words(raw, offsets, X.SPACED)
    prefix = X.prefix_hash(raw)
    words = X.span_hash(prefix, starts, ends)
    n_words = np.bincount(doc, minlength=docs)
    # windows of eight words: those found twice or more in a document cover words
    n_repeat = np.zeros(docs, np.int64)
    if len(words) >= WINDOW:
        window = X.sliding_hash(words, WINDOW)
        whole = doc[: len(window)] == doc[WINDOW - 1 :]
        at = np.flatnonzero(whole)
        twice = at[repeated(window[at] + X.mix(doc[at].astype(np.uint64)))]
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, twice, 1)
        np.add.at(edge, twice + WINDOW, -1)
        n_repeat = np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=docs)
    # lines that hold a word; a document's first such line of a kind is no repeat
    line_table = np.ones(256, bool)
    line_table[10] = False
    l_start, l_end, l_doc = X.span_words(raw, offsets, line_table)
    seen = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(inside, out=seen[1:])
    worded = seen[l_end] > seen[l_start]
    l_start, l_end, l_doc = l_start[worded], l_end[worded], l_doc[worded]
    n_lines = np.bincount(l_doc, minlength=docs)
    keys = X.span_hash(prefix, l_start, l_end) + X.mix(l_doc.astype(np.uint64))
    _, first = np.unique(keys, return_index=True)
    n_dup = n_lines - np.bincount(l_doc[first], minlength=docs)
    count = lambda flags: X.per_doc(flags, offsets)
    return [n_words, count(inside & X.LEAD[raw]), count(_SYMBOL[raw]), n_dup, n_repeat, n_lines, count(_UPPER[raw]),
            count(_LETTER[raw]), count(_DIGIT[raw]), count(_MARK[raw]), count(_BAR[raw]), count(_STOP[raw])]


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    good: str
    bad: str


#: Conditions over the counts ({c} is the struct of counts).
RULES = (
    Rule("length", "{c}.n_words >= 40", "{c}.n_words < 12"),
    Rule("word_length", "{c}.word_chars between 3 * {c}.n_words and 9 * {c}.n_words", "{c}.word_chars > 14 * {c}.n_words or {c}.word_chars < 2 * {c}.n_words"),
    Rule("symbols", "50 * {c}.n_symbols <= {c}.n_words", "5 * {c}.n_symbols > {c}.n_words"),
    Rule("repeated_lines", "10 * {c}.n_dup_lines <= {c}.n_lines", "2 * {c}.n_dup_lines > {c}.n_lines"),
    Rule("repeated_words", "20 * {c}.n_repeat_words <= {c}.n_words", "100 * {c}.n_repeat_words > 30 * {c}.n_words"),
    Rule("capitals", "5 * {c}.n_upper <= {c}.n_letters", "2 * {c}.n_upper > {c}.n_letters"),
    Rule("exclamation", "20 * {c}.n_marks <= {c}.n_words", "3 * {c}.n_marks > {c}.n_words"),
    Rule("bars", "50 * {c}.n_bars <= {c}.n_words", "5 * {c}.n_bars > {c}.n_words"),
    Rule("digits", "10 * {c}.n_digits <= {c}.word_chars", "3 * {c}.n_digits > {c}.word_chars"),
)


@dataclass(frozen=True)
class VoteModel:
    """What EM estimated: share of good documents, and a rule's P(bad vote | it votes) on good and on bad documents."""

    share: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def accuracy(self, rule: int) -> tuple[float, float]:
        """P(the label is as voted) of a rule's bad and of its good votes."""
        g, b = self.share, 1 - self.share
        x, y = b * self.on_bad[rule], g * (1 - self.on_good[rule])
        return x / (x + g * self.on_good[rule]), y / (y + b * (1 - self.on_bad[rule]))


#: What rules are meant to do: P(bad vote) on good and on bad documents, worth PRIOR of the documents that get a vote;
#: on good documents no rule is taken to vote bad more often than MOST_GOOD.
MEANT_GOOD, MEANT_BAD, PRIOR, MOST_GOOD = 0.0005, 0.35, 0.01, 0.005


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> VoteModel:
    """Expectation-maximisation over distinct vote patterns.

    It starts from documents without a bad vote as likely good, and keeps the
    prior's weight in every step, so that the latent label cannot turn into
    another split of the documents.  An abstention says nothing.  Without rows
    the prior is returned.
    """
    k = patterns.shape[1] if patterns.ndim == 2 else len(RULES)
    share, good, bad = 0.9, np.full(k, MEANT_GOOD), np.full(k, MEANT_BAD)
    if len(counts):
        down, up = (patterns == -1).astype(float), (patterns == 1).astype(float)
        prior = PRIOR * (counts @ (down + up)) + 1
        p = np.where(down.any(axis=1), 0.1, 0.95)
        for _ in range(rounds):
            w, v = counts * p, counts * (1 - p)
            good = (w @ down + prior * MEANT_GOOD) / (w @ (down + up) + prior)
            bad = (v @ down + prior * MEANT_BAD) / (v @ (down + up) + prior)
            good = np.minimum(np.minimum(good, MOST_GOOD), bad)  # a bad vote never speaks for a document
            share = float(np.clip(w.sum() / counts.sum(), 0.02, 0.98))
            logit = math.log(share / (1 - share)) + down @ np.log(good / bad) + up @ np.log((1 - good) / (1 - bad))
            p = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
    return VoteModel(share, tuple(good.tolist()), tuple(bad.tolist()))


def votes(counts: str) -> list[Column]:
    """One column a rule over the struct column ``counts``: 1, -1 or 0."""
    return [F.when(F.expr(r.bad.format(c=counts)), -1).when(F.expr(r.good.format(c=counts)), 1).otherwise(0) for r in RULES]


def fit_rules(counted: DataFrame, counts: str) -> VoteModel:
    """Fit the vote model on every row of ``counted``."""
    names = [f"v{i}" for i in range(len(RULES))]
    table = (counted.select(*(v.alias(n) for v, n in zip(votes(counts), names, strict=True)))
             .groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect())  # at most 3^rules rows
    return fit_votes(np.array([[r[n] for n in names] for r in table]).reshape(len(table), len(names)), np.array([r["n"] for r in table], float))


def posterior(model: VoteModel, counts: str) -> Column:
    """Probability that a row is good, rounded so that summation order cannot show."""
    logit = F.lit(math.log(model.share / (1 - model.share)))
    for v, g, b in zip(votes(counts), model.on_good, model.on_bad, strict=True):
        logit = logit + F.when(v == -1, math.log(g / b)).when(v == 1, math.log((1 - g) / (1 - b))).otherwise(0.0)
    return F.round(1 / (1 + F.exp(-logit)), 9)


def base_failed(counts: str) -> Column:
    c = F.col(counts)
    return (c["n_words"] < MIN_WORDS) | (c["n_repeat_words"] * 100 > c["n_words"] * MAX_REPEAT_PERCENT)


def count_texts(docs: DataFrame, keep: list[str], text: str = "text", name: str = "counts") -> DataFrame:
    fields = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    return X.map_text(docs, text, keep, fields, name, lambda: text_counts, TEXT_BYTES)


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed, posterior and kept of every row."""
    counted = stage(count_texts(docs, ["doc_id"]), "quality")
    model = fit_rules(counted, "counts")
    return (counted.withColumn("posterior", posterior(model, "counts")).withColumn("base_failed", base_failed("counts"))
            .select("doc_id", "counts.*", "base_failed", "posterior", (~F.col("base_failed") & (F.col("posterior") >= KEEP_AT)).alias("kept")))


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, that the rules keep."""
    model = fit_rules(stage(count_texts(docs, []), "votes"), "counts")
    name = free_name(docs, "llm_counts")
    counted = count_texts(docs, docs.columns, name=name)
    return counted.filter(~base_failed(name) & (posterior(model, name) >= KEEP_AT)).drop(name)
