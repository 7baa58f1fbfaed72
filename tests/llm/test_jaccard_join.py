import numpy as np
import pytest

from deliverylens.llm import jaccard_join as J
from deliverylens.llm.common import blocks_of, word_hashes
from deliverylens.llm.components import components


def brute(rows, n, percent):
    sets = []
    for i, t in rows:
        w = bytes(t or "", "utf-8").lower().split()
        grams = [tuple(w[k:k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [tuple(w)] if w else []
        sets.append((i, frozenset(grams)))
    up = list(range(len(sets)))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[find(a)] = find(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), 1 << 60), i)
    return sorted((str(i), len(s), least.get(find(k), i) if s else i) for k, (i, s) in enumerate(sets))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (2, 60)])
def test_components_match_brute_force(make, corpus, n, percent):
    got = J.cluster(make(corpus, extra=True), n, percent).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == brute(corpus, n, percent)


@pytest.mark.parametrize("block,first", [(8, 1), (4, 2)])
def test_families_cut_into_blocks(make, monkeypatch, block, first):
    """A large group of near copies, and others just below the threshold."""
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "FIRST", first)
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.choice(120, 1 if i % 3 else 4, replace=False):
            own[k] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(own)))
    got = J.cluster(make(rows), 4, 85).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == brute(rows, 4, 85)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_signatures_meet_for_all_linked_sets(percent):
    """In any common order, with any ties; what only one set has is not told."""
    rng = np.random.default_rng(0)
    spec, met = J.Spec(4, percent), 0
    for _ in range(600):
        n = int(rng.integers(6, 120))
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        drop, add = rng.integers(0, n // 4 + 1, 2)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 62, add, dtype=np.uint64)]))
        common = np.intersect1d(a, b)
        if spec.linked(len(common), len(a), len(b)):
            key = J.mix64(common) >> np.uint64(rng.integers(50, 64))
            who, sig = J.signatures(np.array([len(a), len(b)]), np.repeat([0, 1], len(common)), np.tile(key, 2), spec)
            assert np.intersect1d(sig[who == 0], sig[who == 1]).size
            met += 1
    assert met > 50


def test_small_loads_buckets_and_frequent_ngrams(make, corpus, monkeypatch):
    """Many loads and buckets, and hardly any frequent n-gram or nearly all: equal rows."""
    want = brute(corpus, 4, 85)
    for values in ({"LOAD": 300, "BUCKET": 500, "FREQUENT": 2, "MEMBERS": 7}, {"FREQUENT": 1, "SAMPLE": 1 << 20}):
        with monkeypatch.context() as m:
            for name, v in values.items():
                m.setattr(J, name, v)
            got = J.cluster(make(corpus), 4, 85).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == want


def test_tree_finds_all_components():
    rng = np.random.default_rng(1)
    spec = J.Spec(4, 60)
    pool = rng.integers(0, 1 << 62, 60, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 50))) for _ in range(150)]
    union, want = J.Union(150), J.Union(150)
    for i, j in J.tree_links(sets, spec):
        union.join(i, j)
    for i in range(150):
        for j in range(i):
            if spec.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                want.join(i, j)
    assert union.roots().tolist() == want.roots().tolist()


def test_keep_one_of_each_group(make):
    long = " ".join(f"w{k}" for k in range(200))
    rows = [(5, long), (3, long), (3, long), (9, long + " end"), (1, None), (2, ""), (None, "other words here"), (7, None)]
    kept = J.keep_one(make(rows), 5, 80)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "7", "None"]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert J.keep_one(make([])).count() == 0


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes():
    texts = ["", None, " \n", "a", "The the THE thé É é", " x\ty\x0bz ", "a\u00a0b a\x1cb", "long" * 5000 + " end"]
    seen = {}
    (block,) = blocks_of(texts)
    h, begin = word_hashes(block)
    for t, a, b in zip(texts, begin[:-1], begin[1:], strict=True):
        words = (t or "").encode().lower().split()
        assert len(words) == b - a
        for w, x in zip(words, h[a:b].tolist(), strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    many, _ = word_hashes([" ".join(f"{i:x}" for i in range(200_000)).encode()])
    assert len(set(many.tolist())) == 200_000
    assert [len(x) for x in blocks_of(["a" * 400_000, "b" * 200_000, "", None])] == [2, 2]


def test_a_load_takes_little_more_than_its_grams():
    import tracemalloc

    rng, n = np.random.default_rng(5), 500_000
    hot = np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    load = J.Load(0)
    for i in range(50):
        load.add(i, i, np.sort(rng.integers(0, 1 << 63, n // 50).astype(np.uint64)))
    tracemalloc.start()
    try:
        rows = load.rows(hot, 200)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows.num_rows == 201
    assert most < 32 * n  # bytes of an n-gram; 8 are its hash (43 while the whole load was hashed at once)
