"""The Jaccard join on rows that doc_ids do not identify, and on long sets that share a passage."""

import random

from tidemark.llm import ngram_jaccard as J


def _text(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_many_null_and_repeated_ids(spark, monkeypatch):
    rng = random.Random(1)
    base = [_text(rng, 40) for _ in range(30)]
    rows = [(None, base[i % 30] if i % 2 else base[i % 30] + f" tail{i % 60}") for i in range(800)] + [(7, base[i % 30]) for i in range(60)] + [(7, ""), (None, None), (8, _text(rng, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    joined = []
    texts = J._texts
    monkeypatch.setattr(J, "_texts", lambda docs, nodes: joined.append((texts(docs, nodes).count(), nodes.select("node").distinct().count())) or texts(docs, nodes))
    got = J.jaccard_components(df).collect()
    assert all(n == m for n, m in joined) and joined  # one text a node, however many rows have its doc_id
    assert len(got) == len(rows)
    alone = [r for r in got if r["n_shingles"] == 0]
    assert sorted(str(r["component_id"]) for r in alone) == ["7", "None"]
    assert all(r["component_id"] == 7 for r in got if r["n_shingles"] and r["doc_id"] != 8) and [r["component_id"] for r in got if r["doc_id"] == 8] == [8]


def test_keep_one_keeps_one_row_of_each_component(spark):
    rng = random.Random(2)
    a, b = _text(rng, 50), _text(rng, 50)
    rows = [(1, a, "x"), (1, a, "x"), (2, a + " more", "y"), (2, b, "unique text under a doc_id that is also a copy"), (None, a, "z"), (None, "", "empty"), (None, None, "null"), (3, "  ", "blank"),
            (5, b + " end", "copy of b"), (None, _text(rng, 50), "only row of its text")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, row long")
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["source"] for r in kept.collect()) == sorted(["x", rows[3][2], "empty", "null", "blank", rows[9][2]])
    assert J.keep_one(df.limit(0)).count() == 0


def test_long_sets_that_share_a_passage(spark):
    """2,000-word texts around one passage of 300 words link only where they are near copies."""
    rng = random.Random(3)
    passage = _text(rng, 300)
    texts = [_text(rng, 850) + " " + passage + " " + _text(rng, 850) for _ in range(40)]
    texts += [t.replace("w1 ", "v ", 3) + " end" for t in texts[:7]] + [texts[9]]
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: (i - 40 if 40 <= i < 47 else 9 if i == 47 else i) for i in range(48)}


def test_crossing_tokens_travel_in_ranges(spark, monkeypatch, capsys):
    """The bound counts each node's tokens that another group has, in rows a range and batch instead of rows a token."""
    monkeypatch.setattr(J, "RANGE", 600)
    rng = random.Random(4)
    sets = {}
    for i in range(120):
        tokens = {rng.randrange(-(1 << 63), 1 << 63) for _ in range(30)} | {rng.randrange(40) * (1 << 57) - (1 << 62) for _ in range(4)} | {-7}  # -7: in every set
        sets[i * 1000 - 50_000] = (rng.randrange(6) if i % 3 else i * 1000 - 50_000, sorted(tokens))
    rows = [(k, label, len(t), t) for k, (label, t) in sets.items()]
    rows += rng.choices(rows, k=60)  # equal sets are one node
    df = spark.createDataFrame(rows, "node long, label long, n long, tokens array<long>").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    groups = {}
    for label, tokens in sets.values():
        for t in tokens:
            groups.setdefault(t, set()).add(label)
    found = {k: sum(len(groups[t]) > 1 for t in tokens) for k, (_, tokens) in sets.items()}
    sizes = df.select("node", "n").distinct()
    try:
        for least in (1, 4, 5, 35):
            got = J._crossing(df, sizes, f"found >= {least}")
            assert sorted(r["node"] for r in got.collect()) == sorted(k for k, n in found.items() if n >= least)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got.explain()
    plan = capsys.readouterr().out
    assert "FlatMapGroupsInArrow" in plan and "Window" not in plan
    assert J._crossing(df.limit(0), sizes, "found >= 1").count() == 0


def test_keep_one_shuffles_no_texts(spark, capsys):
    rng = random.Random(6)
    a = _text(rng, 50)
    df = spark.createDataFrame([(1, a), (2, a + " more"), (3, _text(rng, 40))], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that Spark takes for large
    try:
        kept = J.keep_one(df)
        assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
        kept.explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
