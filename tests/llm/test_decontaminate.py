import random

import pytest

from deliverylens.llm import decontaminate as D


@pytest.fixture(scope="module")
def world():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghiklmno") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    words += ["the", "of", "on"] * 300

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(i, text(rng.randint(14, 60))) for i in range(30)]
    rows, truth = [], set()
    for d in range(300):
        body = text(rng.randint(0, 300))
        kind = d % 5
        if kind in (0, 1):
            i, item = items[rng.randrange(30)]
            own = item.split()
            if kind == 1:  # a paraphrase: one word in eight differs
                for k in range(0, len(own) - D.ANSWER_WORDS, 8):
                    own[k] = rng.choice(words)
            at = body.split()
            k = rng.randint(0, len(at))
            body = " ".join([*at[:k], *[w.upper() + "," if d % 2 else w for w in own], *at[k:]])
            truth.add((d, i))
        elif kind == 2:  # a part of an item is no leak
            body += " " + " ".join(items[d % 30][1].split()[:5])
        rows.append((d, body))
    return items, rows, truth


def brute(items, rows):
    out = set()
    docs = [(d, next(D.words_of([text])).tolist()) for d, text in rows]
    for i, t in items:
        item = next(D.words_of([t])).tolist()
        n = len(item)
        for d, words in docs:
            for a in range(0, max(1, len(words)), max(1, n // 4)):
                if D.is_leak(*D.check(words[a:a + 2 * n], item), n):
                    out.add((d, i))
    return out


def test_recall_against_brute_force(spark, make, world):
    items, rows, truth = world
    docs = make(rows, extra=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out, name = D.search(docs, bench)
    assert out.columns[:-1] == docs.columns and name not in docs.columns
    got = {(r["doc_id"], h["item_id"]) for r in out.collect() for h in r[name]}
    want = brute(items, rows)
    assert truth <= want
    assert len(got & want) >= 0.9 * len(want) and truth <= got
    assert {d for d, _ in got} <= {d for d, _ in want}  # clean documents stay
    kept = D.decontaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len({d for d, _ in got})


def test_items_in_blocks_give_the_same(spark, make, world, monkeypatch):
    items, rows, truth = world
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "ITEMS", 11)
    out, name = D.search(make(rows[:60]), bench)
    got = {(r["doc_id"], h["item_id"]) for r in out.collect() for h in r[name]}
    assert {x for x in truth if x[0] < 60} <= got


def test_recall_does_not_depend_on_the_number_of_items(spark, make):
    """More items than the rank: verbatim and paraphrased, short and long."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghiklmno") for _ in range(rng.randint(4, 9))) for _ in range(6000)]

    def text(n):
        return rng.choices(words, k=n)

    items = [(i, text((12, 37, 120, 400)[i % 4])) for i in range(1200)]
    rows = []
    for i, own in items:
        own = list(own)
        if i % 8 >= 4:  # three in ten words changed, the answer kept
            for k in rng.sample(range(len(own) - D.ANSWER_WORDS), (len(own) * 3 - 1) // 10):
                own[k] = rng.choice(words)
        rows.append((i, " ".join([*text(rng.randint(0, 150)), *own, *text(rng.randint(0, 150))])))
    rows += [(1200 + i, " ".join(text(rng.randint(50, 400)))) for i in range(200)]
    bench = spark.createDataFrame([(i, " ".join(own)) for i, own in items], "item_id long, text string")
    out, name = D.search(make(rows), bench)
    got = {(r["doc_id"], h["item_id"]) for r in out.collect() for h in r[name]}
    hashed = [(i, w := next(D.words_of([" ".join(own)])).tolist(), set(w)) for i, own in items]
    want = set()
    for d, t in rows:  # by brute force
        near = next(D.words_of([t])).tolist()
        there = set(near)
        for i, own, kinds in hashed:
            if 4 * len(kinds & there) >= len(kinds) and D.is_leak(*D.check(near, own), len(own)):
                want.add((d, i))
    assert {(i, i) for i in range(1200) if i % 8 < 4} <= want and len(want) >= 1150
    for kind in range(8):
        mine = {x for x in want if x[1] % 8 == kind}
        assert len(got & mine) >= 0.97 * len(mine), kind
    assert got <= want


def test_edge_cases(spark, make, world):
    items, rows, _ = world
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "too short"), (None, items[0][1])],
                                  "item_id long, text string")
    docs = make([(1, None), (2, ""), (3, items[0][1]), (3, items[0][1]), (None, " ,. "), (5, "word " * 30000)])
    out, name = D.search(docs, bench)
    got = [(r["doc_id"], sorted(str(h["item_id"]) for h in r[name])) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, ["0", "None"]), (3, ["0", "None"]), (None, []), (5, [])], key=str)
    assert D.decontaminated(docs, bench.where("false")).count() == 6
    assert D.decontaminated(make([]), bench).count() == 0


def test_long_texts_do_not_empty_the_fit_sample(spark, make, world, monkeypatch):
    """A text beyond the bound leaves only itself out of what the index is fitted on."""
    items, rows, truth = world
    seen, fit = [], D.fit
    monkeypatch.setattr(D, "FIT_CHARS", 200_000)
    monkeypatch.setattr(D, "fit", lambda sample, *a: seen.append(
        {len(r["text"]) for r in sample.collect()}) or fit(sample, *a))
    long = [(1000 + k, f"{k} " * 110_000) for k in range(5)]
    out, name = D.search(make([*long, *rows[:60]]), spark.createDataFrame(items, "item_id long, text string"))
    assert seen == [{len(t) for _, t in rows[:60] if t}]
    got = {(r["doc_id"], h["item_id"]) for r in out.collect() for h in r[name]}
    assert {x for x in truth if x[0] < 60} <= got


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 12))]
        b = [rng.choice("abcd") for _ in range(rng.randint(1, 70))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert D.common_subsequence(a, b) == table[-1][-1]
