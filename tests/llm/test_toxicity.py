import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from deliverylens.llm import toxicity as T


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(2)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        toxic = i % 4 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["zgrumpf", "Zgrumpf,", "zgrumpfer", "vkwaxy", "VKWAXY!"])
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy_and_misspellings(labelled):
    train = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    model = T.train([r[1] for r in train], [r[2] for r in train])
    known = {}
    test = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    score = T.score_texts([r[1] for r in test], model, known)
    truth = np.array([r[2] for r in test])
    assert ((score >= T.THRESHOLD) == truth).mean() > 0.97
    seen, unseen, clean = T.word_scores(["zgrumpf", "zgrumpfx", "tarilo"], model.weights)
    assert seen > unseen > clean and unseen > 0


def test_queries_columns_edge_cases(spark, make, labelled):
    docs = make([(i, t) for i, t, _ in labelled] + [(1000, None), (1001, ""), (None, "tarilo"), (4, "zgrumpf " * 3000)],
                extra=True)
    labels = spark.createDataFrame([(i, 1, k) for i, _, k in labelled] + [(0, 0, 0), (None, 1, 1), (3, 1, None)],
                                   "doc_id long, quality int, toxic int")
    out = T.classify(docs, labels).collect()
    assert len(out) == len(labelled) + 4
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= T.THRESHOLD) for r in out)
    for r in out:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert all(r["predicted"] == 0 for r in out if r["doc_id"] in (1000, 1001))


def test_held_out_labels_are_not_read(spark, make, labelled):
    docs = make([(i, t) for i, t, _ in labelled])
    labels = spark.createDataFrame([(i, k) for i, _, k in labelled], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.sample(docs, labels) == T.sample(docs, turned)


def test_bounds_one_class_and_no_labels(spark, make, labelled):
    docs = make([(i, t) for i, t, _ in labelled])
    labels = spark.createDataFrame([(i, k) for i, _, k in labelled], "doc_id long, toxic int")
    rows = T.sample(docs, labels, T.Sample(10, 20, 2000))
    assert 0 < len(rows) <= 30 and sum(len(t) for t, k in rows if k) <= 2000
    none = labels.where("false")
    assert T.sample(docs, none) == []
    assert {r["predicted"] for r in T.classify(docs, none).collect()} == {0}
    only = T.train(["a b", "c"], [1, 1])
    assert T.score_texts(["x"], only, {})[0] > 0.99
    assert T.classify(make([]), labels).count() == 0


def test_a_very_long_document_does_not_end_the_sample(spark, make):
    rows = [(i, f"text {i}", i % 2) for i in range(60)]
    labels = spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, toxic int")
    order = labels.where(~T.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).collect()
    first = {next(r["doc_id"] for r in order if r["toxic"] == k) for k in (0, 1)}
    docs = make([(i, "x" * 5000 if i in first else text) for i, text, _ in rows])
    got = T.sample(docs, labels, T.Sample(100, 100, 4000))
    assert sorted(got) == sorted((rows[r["doc_id"]][1], r["toxic"]) for r in order if r["doc_id"] not in first)
