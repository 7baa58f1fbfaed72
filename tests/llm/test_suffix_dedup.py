import hashlib

import numpy as np
import pytest

from deliverylens.llm import suffix_dedup as S


def brute(rows):
    big = 1 << 62
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            w = b[k:k + 50]
            first[w] = min(first.get(w, big), big - 1 if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        cover = [False] * len(b)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < (big - 1 if i is None else i):
                cover[k:k + 50] = [True] * 50
        spans = sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover))
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((str(i), len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out)


@pytest.mark.parametrize("chunk,many", [(S.CHUNK_BYTES, 512), (2_000, 512), (1_500, 1)])
def test_matches_brute_force(make, corpus, monkeypatch, chunk, many):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(S, "MANY_CHUNKS", many)
    monkeypatch.setattr(S, "AT_ONCE", 3)
    got = S.remove_repeats(make(corpus, extra=True)).collect()
    assert sorted((str(r[0]), *r[1:5], bytes(r[5])) for r in got) == brute(corpus)


def test_prefix_ranks_by_difference_cover():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 60, 400):
        for letters in (1, 2, 3):
            for length in (1, 3, 4, 10, 50):
                t = rng.integers(1, letters + 1, n)
                far = np.concatenate([t, np.zeros(length, int)])
                windows = [tuple(far[i:i + length]) for i in range(n)]
                order = {w: k + 1 for k, w in enumerate(sorted(set(windows)))}
                assert S.prefix_ranks(t, length).tolist() == [order[w] for w in windows]


def test_every_window_has_an_anchor():
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 97 + k, n).astype(np.uint8) for k, n in ((1, 80), (2, 300), (20, 500), (5, 49), (5, 50))]
    ends = np.cumsum([len(t) for t in texts])
    at, *_ = S.anchors(np.concatenate(texts), ends)
    for begin, end in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
        for s in range(begin, end - 49):
            assert ((at >= s) & (at + S.GRAM <= s + 50)).any()


def test_empty_table(make):
    assert S.remove_repeats(make([])).count() == 0
