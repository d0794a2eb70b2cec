"""op6 learns from every labelled row outside the held-out fold, whole texts included."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity


def test_long_texts_and_all_rows_are_learnt(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    toxic = {i for i in ids if i % 6 == 0}
    text = "plain words of a text " * 700  # 3500 words
    docs = spark.createDataFrame([(i, (text + "grumlo") if i in toxic else "some plain words") for i in range(400)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(400)], "doc_id long, toxic int")
    rows = toxicity.learnt_rows(docs, labels)
    assert rows.count() == len(ids)
    assert rows.agg(F.max(F.length("ids"))).first()[0] == 2 * 3501
    model = toxicity.fit(docs, labels)
    assert model is not None  # without the long texts there is only one class


def test_labels_meet_texts_by_one_form_of_join(spark):
    docs = spark.createDataFrame([(i, "some plain words") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    plan = toxicity.learnt_rows(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan  # as with labels too large to be broadcast


def test_model_does_not_depend_on_the_order_of_rows_and_rare_words_stay_empty(spark):
    ids = range(300)
    rows = [(i, f"plain words of row{i} " + ("grumlo" if i % 3 == 0 else "fine")) for i in ids]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in ids], "doc_id long, toxic int")
    a, b = (toxicity.fit(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 3)))
    assert (a.table == b.table).all() and (a.out == b.out).all() and (a.cut == b.cut).all()
    raw = np.frombuffer(b"row7 grumlo", np.uint8)
    row7, grumlo = toxicity.words(raw, np.array([0, len(raw)]))[0]
    assert not a.table[row7].any() and a.table[grumlo].any()
