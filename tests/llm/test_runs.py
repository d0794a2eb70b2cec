"""Periodic runs and collapsed texts against brute force written from the contract."""

import hashlib
import random
import re
import zlib

import numpy as np

from tidemark.llm import periodic_runs as P

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, starts string, collapsed string, n_chars long"


def runs_of(w):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def by_hand(doc_id, text):
    w = SPACED.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_of(w)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n_},{q}\n" for s, n_, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)), n)


def words(rng, n, k):
    return [rng.choice("abcdefghijklmnopqrstuvwxyz"[:k]) for _ in range(n)]


def sample(rng):
    fib = ["a", "a b"]
    for _ in range(9):
        fib.append(fib[-1] + " " + fib[-2])
    thue = [0]
    for _ in range(9):
        thue += [1 - x for x in thue]
    texts = [None, "", " \n\t", "one", "a " * 11, "a " * 12, "x y " * 6, "x y " * 5 + "x", fib[-1], " ".join("ab"[x] for x in thue), "über 日本 " * 9 + "Ende",
             "line of words here\n" * 7 + "and more\n" + "line of words here\n" * 3, "a b " * 40 + "c " + "b a " * 30, "a" * 3000 + " " + "b " * 20]
    for _ in range(150):
        w = words(rng, rng.randrange(0, 90), rng.choice((1, 2, 2, 3, 4, 26)))
        if rng.random() < 0.5:
            part = words(rng, rng.randrange(1, 25), rng.choice((2, 3, 26)))
            w += (part * rng.randrange(2, 9))[: rng.randrange(200)] + words(rng, 5, 3)
        texts.append(rng.choice((" ", "  ", "\n")).join(w))
    texts.append(" ".join(words(rng, 3000, 26) + words(rng, 700, 26) * 4))
    return texts + texts[20:40]


def test_runs_equal_brute_force(spark):
    texts = sample(random.Random(8))
    rows = [(i, t, "s", "c", 1) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, texts[9], None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in P.run_digests(docs).collect()), key=str)
    assert got == sorted((by_hand(i, t) for i, t, *_ in rows), key=str)
    assert P.run_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_collapsed_text_and_spans(spark):
    text = "go on and on and on and on and on and on and on stop"
    docs = spark.createDataFrame([(7, text)], "doc_id long, text string")
    row = P.collapse_runs(docs).first()
    assert (row["starts"], row["lengths"], row["periods"], row["collapsed"]) == ([1], [13], [2], "go on and stop")
    assert P.collapse_runs(docs, keep=("text", "doc_id")).columns[:2] == ["text", "doc_id"]


def test_grammar_rules_cover_their_places():
    rng = np.random.default_rng(3)
    words_ = np.tile(rng.integers(0, 9, 40), 6).astype(np.uint64)
    g = P.Grammar(words_, np.zeros(len(words_), np.int64))
    size = g.end - g.start
    assert (g.start < g.middle).all() and (g.middle < g.end).all()
    for rule, at in zip(g.rule, g.where):
        assert (words_[at : at + size[rule]] == words_[g.start[rule] : g.end[rule]]).all()
    assert size.max() == len(words_) and len(g.start) < len(words_) // 2  # copies share rules


def test_long_documents_stay_exact():
    unary = np.full(30000, 7, np.uint64)
    b, e, q = P.find_runs(unary, np.zeros(30000, np.int64))
    assert (b.tolist(), e.tolist(), q.tolist()) == ([0], [30000], [1])
    w = np.tile(np.arange(977, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 41)
    doc = np.r_[np.zeros(20000, np.int64), np.ones(len(w) - 20000, np.int64)]  # no run crosses a document
    b, e, q = P.find_runs(w, doc)
    assert (b.tolist(), e.tolist(), q.tolist()) == ([0, 20000], [20000, len(w)], [977, 977])
