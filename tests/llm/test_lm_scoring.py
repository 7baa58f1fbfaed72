import math
import random
from collections import Counter

from deliverylens.llm import lm_scoring as M


def test_scores_match_a_plain_model(spark, make):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh" if i % 2 else "efghijkl") for _ in range(rng.randint(1, 60))))
            for i in range(40)]
    target = [i for i, _ in rows if i % 2 and i < 20]
    docs = make(rows, extra=True)
    labels = spark.createDataFrame([(i, 1) for i in target + target[:3]] + [(None, 1), (999, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in M.score(docs, M.fit(docs, labels)).collect()}

    def counts(ids):
        single, pair = Counter(), Counter()
        for i, t in rows:
            if i in ids:
                w = t.split()
                single.update(w)
                pair.update(zip(w, w[1:], strict=False))
        return single, pair

    t, b = counts(set(target)), counts({i for i, _ in rows})
    scale = sum(t[0].values()) / sum(b[0].values())
    b = tuple({k: v * scale for k, v in c.items()} for c in b)
    n = sum(t[0].values())

    def loss(model, words):
        total = 0.0
        for v, w in zip([None, *words], words, strict=False):
            p = (model[0].get(w, 0) + 1) / (n + M.WORDS)
            c, k = (model[0].get(v, 0), model[1].get((v, w), 0)) if v else (0, 0)
            total -= math.log((min(k, c) + M.ALPHA * p) / (c + M.ALPHA))
        return total / len(words)

    for i, text in rows:
        words = text.split()
        assert got[i]["n_tokens"] == len(words)
        assert abs(got[i]["target_loss"] - loss(t, words)) < 1e-4
        assert abs(got[i]["background_loss"] - loss(b, words)) < 1e-4
        assert abs(got[i]["score"] - (got[i]["target_loss"] - got[i]["background_loss"])) < 1e-9
    mean = [sum(got[i]["score"] for i, _ in rows if i % 2 == k) / 20 for k in (0, 1)]
    assert mean[1] < mean[0]  # odd texts are like the target


def test_edge_cases(spark, make):
    docs = make([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a " * 30000)])
    none = spark.createDataFrame([], "doc_id long")
    rows = M.score(docs, M.fit(docs, none)).collect()
    assert len(rows) == 5 and all(abs(r["score"]) < 1e-9 for r in rows)
    assert sorted(r["n_tokens"] for r in rows) == [0, 0, 2, 2, 30000]
    assert M.score(make([]), M.fit(make([]), none)).count() == 0


def test_many_pairs_keep_their_own_counts(spark, make, monkeypatch):
    """Millions of distinct pairs: no loss has anything of another pair's count."""
    monkeypatch.setattr(M, "HEAD_WORDS", 50)
    monkeypatch.setattr(M, "HEAD_PAIRS", 50)
    rng = random.Random(2)
    kinds = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(["the of", *rng.choices(kinds, k=30_000), "the of"])) for i in range(150)]  # 3.6M pairs
    rows += [(1000 + i, "the of rare words here") for i in range(3)] + [(1000, "the of rare words here")]
    docs = make(rows).repartition(8)
    got = {r["doc_id"]: r for r in M.score(docs, M.fit(docs, spark.createDataFrame([(0,), (1000,)], "doc_id long"))).collect()}
    target = [0, 1000, 1000]
    texts = dict(rows)
    single, pair, n = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    for k, ids in enumerate((target, [i for i, _ in rows])):
        for i in ids:
            w = texts[i].split()
            single[k].update(w)
            pair[k].update(zip(w, w[1:], strict=False))
            n[k] += len(w)
    scale = (1.0, n[0] / n[1])
    for i in (0, 7, 1000, 1002):
        w = texts[i].split()
        loss = [0.0, 0.0]
        for k in range(2):
            for v, x in zip([None, *w], w, strict=False):
                p = (single[k][x] * scale[k] + 1) / (n[0] + M.WORDS)
                loss[k] -= math.log((pair[k][v, x] * scale[k] + M.ALPHA * p) / (single[k][v] * scale[k] + M.ALPHA))
        assert abs(got[i]["target_loss"] - loss[0] / len(w)) < 1e-6
        assert abs(got[i]["background_loss"] - loss[1] / len(w)) < 1e-6
