r"""Periodic runs of words, found in a Re-Pair grammar, and texts collapsed to each run's first period.

Words are ``[^\x20\x09-\x0D]+`` of whole texts, numbered from 0.  A run is a
stretch of words with smallest period q and at least ``max(MIN_LENGTH, 2 q)``
words that no neighbouring word extends keeping period q.

Method, on blocks of whole documents (about two megabytes, numpy throughout):

1. A run is equal to itself one period on in at least ``GRAM`` consecutive
   words, so each of its words stands in a word six-gram that its document
   holds twice.  Only stretches of such words are compressed; nothing outside
   them can be in a run or extend one.
2. Re-Pair: each round counts the adjacent pairs of all stretches and replaces
   those that occur twice, commoner pairs first where two overlap, until no
   pair repeats; what is left of a stretch becomes a balanced tree.  Each rule
   keeps one occurrence as its expansion and the list of all its derivation
   positions.  Copies of a text in one block share their rules.
3. The runs that cross the boundary between a rule's two halves are computed
   once, on the expansion: a period q is tried where three words by the
   boundary recur at distance q, and is extended both ways by binary search
   over prefix hashes (two primes, random base).
4. Intervals are translated to all derivation positions.  Of an interval that
   touches an end of its rule and goes on beyond it, the longer one is found
   at the rule above, where both parts meet; only maximal ones are kept, each
   with its smallest period.

Scale: map-only, nothing shuffled or collected; memory is bounded by a block or
the longest document.  Copies or a source holding a third of all rows cost
their own length.

Defined cases: a null or empty text has no words and collapses to the empty
text; rows are independent, so repeated rows, null doc_ids, empty tables and
further columns are no special case.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text as X
from ._stage import small_batches

MIN_LENGTH = 12
#: a run has MIN_LENGTH - q or q words equal to those one period on, whichever is more: never below this
GRAM = MIN_LENGTH // 2
#: boundary words that must recur at distance q; of GRAM consecutive ones, half lie on one side of the boundary
NEAR = GRAM // 2
#: periods tried at once
TRY = 1 << 21

_PRIMES = (np.int64(2147483647), np.int64(2147483629))
_BASES = (np.int64(1103515245), np.int64(1540483477))
_powers: list[np.ndarray] = [np.ones(1, np.int64), np.ones(1, np.int64)]


def _power(k: int, n: int) -> np.ndarray:
    p, base = _PRIMES[k], int(_BASES[k])
    while len(_powers[k]) < n:
        t = _powers[k]
        _powers[k] = np.concatenate([t, t * np.int64(pow(base, len(t), int(p))) % p])
    return _powers[k]


class Extents:
    """Longest common extensions of two places of one sequence."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        self.sums = []
        for k, p in enumerate(_PRIMES):
            value = (h % np.uint64(p)).astype(np.int64)
            total = np.zeros(n + 1, np.int64)
            np.cumsum(value * _power(k, n + 1)[:n] % p, out=total[1:])
            self.sums.append(total % p)

    def _equal(self, a: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        same = np.ones(len(a), bool)
        for k, (p, s) in enumerate(zip(_PRIMES, self.sums, strict=True)):
            left, right = (s[a + size] - s[a]) % p, (s[a + q + size] - s[a + q]) % p
            same &= left * _powers[k][q] % p == right
        return same

    def after(self, a: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those ``q`` further, at most ``most``."""
        return self._search(most, lambda size: self._equal(a, q, size))

    def before(self, a: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words up to ``a`` equal those ``q`` further, at most ``most``."""
        return self._search(most, lambda size: self._equal(a - size, q, size))

    @staticmethod
    def _search(most: np.ndarray, equal) -> np.ndarray:
        lo, hi = np.zeros_like(most), most.copy()
        while len(lo) and (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            good = equal(mid)
            lo, hi = np.where(good, mid, lo), np.where(good, hi, mid - 1)
        return lo


def repeated_words(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words in a GRAM-word window that stands twice in their document."""
    n = len(h) - GRAM + 1
    out = np.zeros(len(h), bool)
    if n <= 0:
        return out
    key = X.mix(X.sliding_hash(h, GRAM) + doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(doc[:n] == doc[GRAM - 1 :])
    slot = (key[at] & np.uint64((1 << 22) - 1)).astype(np.int64)
    at = at[np.bincount(slot, minlength=1 << 22)[slot] > 1]  # most windows stand alone in their slot
    order = np.argsort(key[at], kind="stable")
    k = key[at][order]
    same = np.flatnonzero(k[1:] == k[:-1])
    hit = at[order[np.concatenate([same, same + 1])]]
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + GRAM, -1)
    return np.cumsum(edge[:-1]) > 0


class Grammar:
    """Re-Pair rules of the stretches of one sequence of words.

    Of rule k: its expansion is words ``start[k]`` to ``end[k]``, halved at
    ``middle[k]``; ``where`` lists the derivation positions of ``rule``.
    """

    def __init__(self, words: np.ndarray, stretch: np.ndarray):
        self.words = words
        symbol = np.unique(words, return_inverse=True)[1].astype(np.int64)
        self.symbol, self.at, self.stretch = symbol, np.arange(len(words)), stretch
        self.to = self.at + 1
        self.count = int(symbol.max()) + 1 if len(symbol) else 0
        self.made: list[tuple[np.ndarray, ...]] = []
        self.rules = 0
        while self._replace_repeated():
            pass
        while self._halve():
            pass
        parts = [np.concatenate(p) for p in zip(*self.made, strict=True)] if self.made else [np.zeros(0, np.int64)] * 5
        self.start, self.middle, self.end, self.rule, self.where = parts

    def _replace(self, first: np.ndarray, kind: np.ndarray, kinds: int) -> None:
        """Symbols ``first`` and their successors become one of ``kinds`` new symbols."""
        seen = np.full(kinds, len(self.symbol))
        np.minimum.at(seen, kind, first)
        self.made.append((self.at[seen], self.at[seen + 1], self.to[seen + 1], self.rules + kind, self.at[first]))
        self.rules += kinds
        self.symbol[first] = self.count + kind
        self.to[first] = self.to[first + 1]
        self.count += kinds
        keep = np.ones(len(self.symbol), bool)
        keep[first + 1] = False
        self.symbol, self.at, self.to, self.stretch = (x[keep] for x in (self.symbol, self.at, self.to, self.stretch))

    def _replace_repeated(self) -> bool:
        inner = np.flatnonzero(self.stretch[1:] == self.stretch[:-1])
        pair, kind, often = np.unique(self.symbol[inner] * self.count + self.symbol[inner + 1], return_inverse=True, return_counts=True)
        if not len(pair) or often.max() < 2:
            return False
        rank = np.empty(len(pair), np.int64)  # by frequency, ties in scattered order
        rank[np.lexsort((X.mix(pair.astype(np.uint64)), often))] = np.arange(1, len(pair) + 1)
        rank[often < 2] = 0
        weight = np.zeros(len(self.symbol) + 1, np.int64)  # of the pair that begins at a symbol; 0 stands on both sides
        weight[inner + 1] = rank[kind]
        before, here, after = weight[:-1], weight[1:], np.append(weight[2:], 0)
        begins = np.flatnonzero(here != before)
        odd = (np.arange(len(here)) - begins[np.searchsorted(begins, np.arange(len(here)), "right") - 1]) & 1 if len(begins) else np.zeros(len(here), int)
        first = np.flatnonzero((here > 0) & (here >= before) & (here >= after) & (odd == 0))
        of = np.zeros(len(pair) + 1, np.int64)
        of[rank[rank > 0]] = np.flatnonzero(rank > 0)
        chosen, new = np.unique(of[here[first]], return_inverse=True)
        self._replace(first, new, len(chosen))
        return True

    def _halve(self) -> bool:
        n = len(self.symbol)
        if n < 2:
            return False
        begins = np.flatnonzero(np.r_[True, self.stretch[1:] != self.stretch[:-1]])
        place = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
        first = np.flatnonzero((place[:-1] & 1 == 0) & (self.stretch[1:] == self.stretch[:-1]))
        if not len(first):
            return False
        self._replace(first, np.arange(len(first)), len(first))
        return True


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """1..size for each size, in a row."""
    return np.arange(1, int(sizes.sum()) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _unique_smallest(keys: tuple[np.ndarray, ...], q: np.ndarray) -> np.ndarray:
    """Places of the smallest q of each key."""
    order = np.lexsort((q, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order[new]


def crossing(grammar: Grammar) -> tuple[np.ndarray, ...]:
    """(rule, start, end, period) of the runs in each rule's expansion that cross its middle, maximal there."""
    h = grammar.words
    near = np.append(X.sliding_hash(h, NEAR), np.zeros(NEAR, np.uint64))
    extents = Extents(h)
    found = [(np.zeros(0, np.int64),) * 4]
    rules = np.flatnonzero(grammar.end - grammar.start >= MIN_LENGTH)
    sizes = grammar.end[rules] - grammar.start[rules]
    chunk = np.cumsum(sizes) // TRY
    for c in np.unique(chunk):
        some = rules[chunk == c]
        s, m, e = grammar.start[some], grammar.middle[some], grammar.end[some]
        for left in (True, False):  # the earlier of the two equal places is one period left of the middle, or at it
            reach = m - s if left else e - m
            q = _ramp(reach)
            k = np.repeat(np.arange(len(some)), reach)
            a = m[k] - q if left else m[k]
            right = (a + q + NEAR <= e[k]) & (near[a] == near[np.minimum(a + q, len(near) - 1)])
            back = np.maximum(a - NEAR, 0)
            behind = (a - NEAR >= s[k]) & (a + q <= e[k]) & (near[back] == near[np.minimum(back + q, len(near) - 1)])
            hit = np.flatnonzero(right | behind)
            k, q, a = k[hit], q[hit], a[hit]
            begin = a - extents.before(a, q, a - s[k])
            end = a + q + extents.after(a, q, e[k] - a - q)
            long = end - begin >= np.maximum(MIN_LENGTH, 2 * q)
            found.append((some[k[long]], begin[long], end[long], q[long]))
    rule, begin, end, q = (np.concatenate(f) for f in zip(*found, strict=True))
    best = _unique_smallest((rule, begin, end), q)
    return rule[best], begin[best], end[best], q[best]


def find_runs(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run, by start then period; ``h`` are word hashes, ``doc`` their documents in order."""
    at = np.flatnonzero(repeated_words(h, doc))
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    stretch = np.cumsum(np.r_[0, (np.diff(at) > 1) | (np.diff(doc[at]) != 0)])
    words = h[at]
    grammar = Grammar(words, stretch)
    rule, begin, end, q = crossing(grammar)
    # every derivation position of the rules that hold runs
    order = np.argsort(grammar.rule, kind="stable")
    first = np.searchsorted(grammar.rule[order], rule, "left")
    times = np.searchsorted(grammar.rule[order], rule, "right") - first
    of = np.repeat(np.arange(len(rule)), times)
    place = grammar.where[order[np.repeat(first, times) + _ramp(times) - 1]]
    shift = place - grammar.start[rule[of]]
    begin, end, q = begin[of] + shift, end[of] + shift, q[of]
    # maximal ones only: what goes on beyond its rule is whole at a rule above
    n, own = len(words), stretch[begin]
    to_left = (begin > 0) & (stretch[begin - 1] == own) & (words[begin - 1] == words[begin - 1 + q])
    after = np.minimum(end, n - 1)
    to_right = (end < n) & (stretch[after] == own) & (words[after] == words[end - q])
    whole = np.flatnonzero(~to_left & ~to_right)
    begin, end, q = begin[whole], end[whole], q[whole]
    best = _unique_smallest((begin, end), q)
    begin, end, q = begin[best], end[best], q[best]
    order = np.lexsort((q, begin))
    begin, end, q = begin[order], end[order], q[order]
    return at[begin], at[end - 1] + 1, q


FIELDS = T.StructType([T.StructField("n_words", T.LongType())] + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("starts", "lengths", "periods")]
                      + [T.StructField("collapsed", T.StringType())])


def _collapse(raw: np.ndarray, offsets: np.ndarray) -> list:
    docs = len(offsets) - 1
    starts, ends, doc = X.span_words(raw, offsets, X.SPACED)
    h = X.span_hash(X.prefix_hash(raw), starts, ends)
    n_words = np.bincount(doc, minlength=docs)
    begin, end, q = find_runs(h, doc)
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, begin + q, 1)
    np.add.at(edge, end, -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    # bytes of the kept words, one space after each but the last of a document
    size = ends[kept] - starts[kept] + 1
    to = np.cumsum(size)
    out = raw[np.minimum(np.repeat(starts[kept] - (to - size), size) + np.arange(int(size.sum())), max(len(raw) - 1, 0))]
    last = np.flatnonzero(np.r_[doc[kept][1:] != doc[kept][:-1], True]) if len(kept) else np.zeros(0, np.int64)
    out[to - 1] = 32
    keep = np.ones(len(out), bool)
    keep[to[last] - 1] = False
    width = np.bincount(doc[kept], weights=size, minlength=docs).astype(np.int64) if len(kept) else np.zeros(docs, np.int64)
    bounds = np.r_[0, np.cumsum(np.maximum(width - 1, 0))].astype(np.int32)
    texts = pa.StringArray.from_buffers(docs, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(out[keep])))
    base = np.searchsorted(doc, np.arange(docs))
    lists = np.r_[0, np.cumsum(np.bincount(doc[begin], minlength=docs))].astype(np.int32)
    as_list = lambda v: pa.ListArray.from_arrays(pa.array(lists), pa.array(v.astype(np.int64)))
    return [n_words, as_list(begin - base[doc[begin]]), as_list(end - begin), as_list(q), texts]


def collapse_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: number of words, all runs (start, length and period, by start then period) and the collapsed text.

    In the collapsed text every word that stands in a run after the run's
    first period is left out; the others are joined by one space.
    """
    return X.map_text(docs, text, list(keep), FIELDS, "found", lambda: _collapse).select(*[F.col(f"`{c}`") for c in keep], "found.*")


def plant_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a periodic tail in the documents whose crc32(doc_id as text) is divisible by 10.

    With g = crc32 div 10 and n words, words from a = g mod n on repeat the
    p = 1 + (n - a) div (3 + g mod 8) words at a.  A null doc_id plants nothing.
    """
    schema = T.StructType([docs.schema["doc_id"], docs.schema["text"]])

    def planted(text: str | None, g: int) -> str | None:
        w = "" if text is None else text
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        n = len(w)
        if not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        times = -(-(n - a) // p)
        return " ".join(w[:a] + (w[a : a + p] * times)[: n - a])

    def run(batches):
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            h = [None if i is None else zlib.crc32(str(i).encode()) for i in ids.to_pylist()]
            at = [i for i, x in enumerate(h) if x is not None and x % 10 == 0]
            if at:
                new = pa.array([planted(text[i].as_py(), h[i] // 10) for i in at], text.type)
                mask = np.zeros(len(h), bool)
                mask[at] = True
                text = pc.replace_with_mask(text, pa.array(mask), new)
            yield pa.RecordBatch.from_arrays([ids, text], ["doc_id", "text"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def run_digests(docs: DataFrame) -> DataFrame:
    """The registered query: runs of the planted documents, reduced to their longest run and digests."""
    found = collapse_runs(plant_runs(docs))
    runs = F.arrays_zip("starts", "lengths", "periods")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["lengths"].alias("length"), (-r["starts"]).alias("start"), (-r["periods"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat(r["starts"].cast("string"), F.lit(","), r["lengths"].cast("string"), F.lit(","), r["periods"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("starts").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
