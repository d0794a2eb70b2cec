"""op10: history tells words of one class apart, by pairs counted over all blocks; the model sums to one."""

import collections
import math
import random
import zlib

import numpy as np

from tidemark.llm import maxent_lm as L


def test_pairs_are_counted_over_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 600)
    monkeypatch.setattr(L, "PART", 2)
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 40))) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = docs.collect()
    pairs = collections.Counter()
    for r in rows:
        if zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 10:
            words = ["<s>", *(r["text"] or "").split(), "</s>"]
            pairs.update(zip(words, words[1:]))
    blocks = L.stage(L.pack(docs), "test")
    told = {r["block"]: L.pa.array([tuple(x) for x in r["pairs"]], L.pa.struct([("part", L.pa.int32()), ("n", L.pa.int32()), ("counts", L.pa.binary())])) for r in L.count_pairs(blocks, 5).collect()}
    assert len(told) == blocks.count() > 5
    got = collections.Counter()
    for b in blocks.collect():
        block = {"sizes": np.array(b["sizes"]), "held": np.array(b["held"]), "vocabulary": np.frombuffer(b["vocabulary"], np.uint64)}
        block["words"] = L.unplaned(L.pa.decompress(b["words"], 4 * sum(b["sizes"]), "zstd"), np.uint32).astype(np.int64)
        hashes, first, doc, _ = L.sequence(block)
        _, back = np.unique(L.pair_keys(hashes, first), return_inverse=True)
        got.update(L.pair_counts(told[b["block"]])[back].tolist())
    want = collections.Counter()
    for r in rows:
        words = ["<s>", *(r["text"] or "").split(), "</s>"]
        want.update(pairs[p] for p in zip(words, words[1:]))
    assert got == want


def test_history_tells_words_of_one_class_apart(spark):
    """Two rare words of one class and one count: the score of a text depends on which of them followed its first word."""
    rng = random.Random(1)
    filler = [f"f{i}" for i in range(40)]
    by_class = collections.defaultdict(list)
    classes = L.Classes(1, 1, 0, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(L.CLASSES))
    for i in range(100):
        w = f"rare{i}"
        raw = np.frombuffer(w.encode(), np.uint8)
        h = L.X.span_hash(L.X.prefix_hash(raw), np.array([0]), np.array([len(raw)]))
        by_class[int(classes.of(h)[0])].append(w)
    x, y = next(ws for ws in by_class.values() if len(ws) > 1)[:2]
    learnt = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(rng.choices(filler, k=20)) + (f" anna {x}" if k % 2 else f" bert {y}")) for k, i in enumerate(learnt[:60])]
    rows += [(held[0], f"anna {x}"), (held[1], f"anna {y}")]
    got = {r["doc_id"]: r for r in L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    a, b = got[held[0]], got[held[1]]
    assert math.isclose(a["base_score"], b["base_score"]) and a["score"] > b["score"] + 0.8


def test_words_travel_once_as_ranges_of_their_hashes(spark, monkeypatch):
    """Every block gets the training counts of its own words in all blocks, in a row a range and not in one a word."""
    monkeypatch.setattr(L, "BLOCK", 600)
    monkeypatch.setattr(L, "WORD_PART", 4)
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(0, 60))) for _ in range(80)] + [None, "", "w1 W1 w1"]
    docs = spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    counts = collections.Counter()
    learnt = [r for r in docs.collect() if zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 10]
    for r in learnt:
        counts.update((r["text"] or "").lower().split())

    def hash_of(w):
        raw = np.frombuffer(w.encode(), np.uint8)
        return int(L.X.span_hash(L.X.prefix_hash(raw), np.array([0]), np.array([len(raw)]))[0])

    want = {hash_of(w): n for w, n in counts.items()} | {L._END: len(learnt)}
    blocks = L.stage(L.pack(docs), "test")
    totals = L.word_totals(blocks).collect()
    parts = L.ranges(blocks, 4)
    assert parts > 1 and len(totals) <= (blocks.count() + 1) * parts
    assert {r["hash"] % (1 << 64): r["c"] for r in L.count_words(blocks).collect()} == want
    for b in blocks.collect():
        hashes, order = L.word_order({"vocabulary": np.frombuffer(b["vocabulary"], np.uint64)})
        mine = sorted((r["part"], r["n"], bytes(r["counts"])) for r in totals if r["block"] == b["block"])
        told = L.told_counts(L.pa.array(mine, L.pa.struct([("part", L.pa.int32()), ("n", L.pa.int32()), ("counts", L.pa.binary())])))
        assert told.tolist() == [want.get(h, 0) for h in hashes[order].tolist()]
