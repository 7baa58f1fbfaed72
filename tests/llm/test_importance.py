"""op11 against plain counting with zlib, hashlib and math."""

import hashlib
import math
import random
import re
import zlib

import pytest

from deliverylens.llm import importance as im

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_n, buckets):
    words = WORD.findall((text or "").translate(_LOWER))
    runs = [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(docs, target, max_n=1, buckets=10_000, seed=2024, least=20, percent=10):
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in features(text, max_n, buckets)[1]:
            s[b] += 1
    for text in target:
        for b in features(text, max_n, buckets)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets))))
            for x, y in zip(s, t)]
    rows = []
    for i, text in docs:
        n, found = features(text, max_n, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, n, len(found), weight, weight + noise))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = fit[:percent * len(fit) // 100]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)]
                  + [(*r, None) for r in fit[len(drawn):]] + [(*r, None) for r in rows if r[1] < least], key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()),
                  key=str)


@pytest.mark.parametrize("max_n, percent", [(1, 10), (2, 50), (3, 100)])
def test_like_plain_counting(make, corpus, max_n, percent):
    rows = corpus + [(200, "ŒUVRE Œuvre a-b A_B 0x1F"), (201, " ".join(["hot"] * 3000)), (None, "n " * 40)]
    target = [t for _, t in corpus[:12]] + [None, ""]
    docs = make(rows, extra=True)
    bench = make(list(enumerate(target)))
    found = im.resample(docs, bench, max_n=max_n, buckets=997, percent=percent)
    assert got(found) == plain(rows, target, max_n, 997, percent=percent)


def test_ties_and_repeated_rows_share_no_rank(make):
    rows = [(7, "same words " * 20)] * 50 + [(3, "same words " * 20)] * 50
    found = im.resample(make(rows), make([(0, "other")]), percent=30)
    ranks = sorted(r["rank"] for r in found.collect() if r["rank"] is not None)
    assert ranks == list(range(1, 31))
    assert got(found) == plain(rows, ["other"], percent=30)


def test_empty_tables(make):
    assert im.resample(make([]), make([(0, "a")])).count() == 0
    rows = [(1, "a b c " * 10), (2, None)]
    assert got(im.resample(make(rows), make([]))) == plain(rows, [])


@pytest.mark.parametrize("max_n", [1, 2, 3, 5])
def test_slices_of_long_texts_lose_no_feature(monkeypatch, max_n):
    monkeypatch.setattr(im, "_SLICE", 37)
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abÉ-Z") for _ in range(rng.randint(1, 60))) for _ in range(300))
    n, all_found = features(text, max_n, 1000)
    words = [w.encode() for w in WORD.findall(text.translate(_LOWER))]
    head = {"words": {w: zlib.crc32(w) for w in words[::3]},
            "pairs": {p: zlib.crc32(b" ".join(p)) for p in list(zip(words, words[1:]))[::4]}}
    for known in ({"words": {}, "pairs": {}}, head):
        parts = list(im.Buckets(known, max_n, 1000).of(text))
        assert sum(k for k, _ in parts) == n
        assert sorted(b for _, found in parts for b in found.tolist()) == sorted(all_found)


def test_head_changes_no_result(make, corpus, monkeypatch):
    docs, bench = make(corpus), make(corpus[:5])
    whole = got(im.resample(docs, bench, max_n=2))
    monkeypatch.setattr(im, "HEAD_WORDS", 3)
    monkeypatch.setattr(im, "HEAD_PAIRS", 2)
    monkeypatch.setattr(im, "SAMPLE_ROWS", 4)
    assert got(im.resample(docs, bench, max_n=2)) == whole
