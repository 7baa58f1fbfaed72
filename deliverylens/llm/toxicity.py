"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the average of the embeddings of its hashed character n-grams (and
of itself); a window of ``WINDOW`` words is the average of its words (missing
words count as zero); a softmax over the window gives P(toxic). Embeddings and
softmax are trained jointly in numpy. A document scores as its most toxic
window, so a single insult counts as much in a long text as in a short one.
Unseen misspellings share n-grams with what was seen.

Training sees labels only at document level: each toxic document stands for
its currently most toxic window, each clean one for its most toxic windows and
some others, and both are chosen anew in every round. The first choice follows
the document frequencies of the n-grams in the two classes.

The classifier is fitted on a bounded sample of labelled rows (``Sample``), in
the order of a hash of the id; documents of over an eighth of the bound come
last, the shortest first, so that none of them takes the room of the others.
Because the model is linear, an n-gram enters a
score only through one number, so scoring ships one float per hash bucket.

Edge cases: null or empty text scores as an empty window; several label rows
of a document count as toxic if one of them is; null labels are ignored; if a
class is missing, every score is the share of toxic labels (0 without labels);
repeated rows score alike; extra columns are ignored; a null doc_id is not
held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deliverylens.llm.common import mix64, table

WINDOW = 2
#: n-gram sizes, hash buckets, embedding width, rounds and steps a round.
GRAMS = (3, 4, 5)
BUCKETS = 1 << 20
WIDTH = 8
#: n-grams in fewer training documents than this get no weight.
LEAST_DOCS = 3
ROUNDS, STEPS = 3, 40
THRESHOLD = 0.7
#: Words whose scores a task remembers, documents it scores at a time.
CACHE_WORDS = 400_000
BLOCK = 128
WORDS_AT_ONCE = 20_000
_NOT_WORD = re.compile(r"[\W_]+")


@dataclass(frozen=True)
class Sample:
    """Bound of the training sample: documents of each class, characters of each."""

    toxic: int = 1500
    clean: int = 2500
    chars: int = 6_000_000


@dataclass(frozen=True)
class Model:
    """What scoring needs: each bucket's share of the logit, and the bias."""

    weights: np.ndarray
    bias: float


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    bare = [f"<{_NOT_WORD.sub('', w.lower())}>" for w in words]
    size = np.array([len(b) for b in bare], np.int64)
    code = np.frombuffer("".join(bare).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    first = np.cumsum(size) - size
    place = np.arange(len(code)) - first[owner]
    power = np.cumprod(np.full(int(size.max(initial=1)), 1_000_003, np.uint64))
    owners, hashes = [np.arange(len(words), dtype=np.int32)], [np.add.reduceat(code * power[place], first)]
    for n in GRAMS:
        ends = max(0, len(code) - n + 1)
        inside = owner[:ends] == owner[n - 1:][:ends]
        h = np.full(ends, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(1_000_003) + code[k:k + ends]
        owners.append(owner[:ends][inside])
        hashes.append(h[inside])
    who = np.concatenate(owners)
    bucket = (mix64(np.concatenate(hashes)) & np.uint64(BUCKETS - 1)).astype(np.int32)
    some = size[who] > 2
    who, bucket = who[some], bucket[some]
    order = np.argsort(who, kind="stable")
    return who[order], bucket[order]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash buckets of the words' n-grams, with their borders, and of the
    whole words: (word number, bucket), ordered by word number. A word without
    letters or digits has none."""
    parts = [(i, _features(words[i:i + WORDS_AT_ONCE])) for i in range(0, len(words), WORDS_AT_ONCE)]
    none = np.zeros(0, np.int32)
    return (np.concatenate([none, *(i + w for i, (w, _) in parts)]).astype(np.int32),
            np.concatenate([none, *(b for _, (_, b) in parts)]))


def _top_window(scores: np.ndarray, k: int = 1) -> list[int]:
    """Starts of the k best windows that don't overlap."""
    sums = np.cumsum(np.concatenate([[0.0], scores]))
    n = max(1, len(scores) - WINDOW + 1)
    value = sums[np.minimum(np.arange(n) + WINDOW, len(scores))] - sums[:n]
    out: list[int] = []
    for _ in range(k):
        i = int(value.argmax())
        if value[i] == -np.inf:
            break
        out.append(i)
        value[max(0, i - WINDOW + 1):i + WINDOW] = -np.inf
    return out


class _Net:
    """Embeddings and softmax with Adam; all of a round's windows are one batch."""

    def __init__(self, start: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.01, (len(start), WIDTH)).astype(np.float32)
        self.emb[:, 0] += start
        self.soft = rng.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
        self.soft[0] = (-4, 4)
        self.bias = np.array([1.0, -1.0], np.float32)
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (self.emb, self.soft, self.bias)]
        self.step = 0

    def weights(self) -> np.ndarray:
        return self.emb @ (self.soft[:, 1] - self.soft[:, 0])

    def fit(self, feats, count, share, windows, labels, weight, steps: int) -> None:
        """feats/count: the words' n-grams, one word after the other; share: what
        each n-gram of a word counts; windows: word numbers, -1 for none."""
        row, col = np.nonzero(windows >= 0)
        word = windows[row, col]
        owner = np.repeat(np.arange(len(count)), count)
        some = count > 0
        first = np.cumsum(count) - count
        for _ in range(steps):
            vec = np.zeros((len(count), WIDTH), np.float32)
            vec[some] = np.add.reduceat(self.emb[feats], first[some], axis=0) * share[some, None]
            bag = np.stack([np.bincount(row, vec[word, j], len(windows)) for j in range(WIDTH)], 1) / WINDOW
            logit = bag @ self.soft + self.bias
            logit -= logit.max(1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(labels)), labels] -= 1
            d = p * (weight / weight.sum())[:, None]
            d_bag = (d @ self.soft.T) / WINDOW
            d_vec = np.stack([np.bincount(word, d_bag[row, j], len(count)) for j in range(WIDTH)], 1) * share[:, None]
            d_emb = np.stack([np.bincount(feats, d_vec[owner, j], len(self.emb)) for j in range(WIDTH)], 1)
            self._update((d_emb, bag.T @ d + 1e-4 * self.soft, d.sum(0)))

    def _update(self, grads) -> None:
        self.step += 1
        for p, g, (m, v) in zip((self.emb, self.soft, self.bias), grads, self.moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.05 * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.99 ** self.step)) + 1e-8)


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Fit the model to texts with document-level labels 0 / 1."""
    y = np.array(labels, np.int64)
    if not y.any() or y.all():
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 1e-6
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in t.split()], np.int64) for t in texts]
    who, buckets = features(list(number))
    share = (1 / np.maximum(1, np.bincount(who, minlength=len(number)))).astype(np.float32)

    def select(words: np.ndarray, flat: np.ndarray, count: np.ndarray):
        """The n-grams of some words, and their counts."""
        c = count[words]
        first = (np.cumsum(count) - count)[words]
        return flat[np.repeat(first - (np.cumsum(c) - c), c) + np.arange(c.sum())], c

    seen = np.zeros((2, BUCKETS))
    every = np.bincount(who, minlength=len(number))
    for d, label in zip(docs, y, strict=True):
        seen[label, np.unique(select(np.unique(d), buckets, every)[0])] += 1
    ids = np.flatnonzero(seen.sum(0) >= LEAST_DOCS)
    index = np.full(BUCKETS, -1)
    index[ids] = np.arange(len(ids))
    known = index[buckets] >= 0
    who, feats = who[known], index[buckets[known]]
    count = np.bincount(who, minlength=len(number))
    seen = seen[:, ids]
    odds = np.log((seen[1] + 1) / (y.sum() + 2)) - np.log((seen[0] + 1) / ((1 - y).sum() + 2))
    support = seen.sum(0)
    net = _Net((odds * support / (support + 5)).astype(np.float32), seed)
    rng = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        scores = np.bincount(who, net.weights()[feats], len(count)) * share
        starts, owner = [], []
        for i, d in enumerate(docs):
            if len(d):
                picked = _top_window(scores[d], 1 if y[i] else 2)
                if not y[i]:
                    picked += rng.integers(0, len(d), 2).tolist()
                starts += picked
                owner += [i] * len(picked)
        at = np.array(starts)[:, None] + np.arange(WINDOW)
        raw = np.full(at.shape, -1, np.int64)
        for r, (i, row) in enumerate(zip(owner, at, strict=True)):
            part = docs[i][row[row < len(docs[i])]]
            raw[r, :len(part)] = part
        used, back = np.unique(raw, return_inverse=True)
        back = back.reshape(raw.shape) - (used[0] < 0)
        used = used[used >= 0]
        own, c = select(used, feats, count)
        target = y[np.array(owner)]
        weight = np.where(target == 1, 1.0 / max(1, (target == 1).sum()), 1.0 / max(1, (target == 0).sum()))
        net.fit(own, c, share[used], back, target, weight, STEPS)
    weights = np.zeros(BUCKETS, np.float32)
    weights[ids] = net.weights()
    return Model(weights, float(net.bias[1] - net.bias[0]))


def word_scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Each word's average weight (0 without letters or digits)."""
    who, bucket = features(words)
    total = np.bincount(who, weights[bucket], len(words))
    return total / np.maximum(1, np.bincount(who, minlength=len(words)))


def score_texts(texts: list[str | None], model: Model, known: dict[str, float]) -> np.ndarray:
    """P(toxic) of each text's most toxic window; ``known`` keeps word scores."""
    out = np.zeros(len(texts))
    if len(known) > CACHE_WORDS:
        known.clear()
    split = [t.split() if t else [] for t in texts]
    new = list({w for words in split for w in words if w not in known})
    if new:
        known.update(zip(new, word_scores(new, model.weights).tolist(), strict=True))
    for i, words in enumerate(split):
        got = np.array([known[w] for w in words])
        if len(got) <= WINDOW:
            out[i] = got.sum()
        else:
            sums = np.cumsum(np.concatenate([[0.0], got]))
            out[i] = (sums[WINDOW:] - sums[:-WINDOW]).max()
    return 1 / (1 + np.exp(-np.clip(out / WINDOW + model.bias, -50, 50)))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, bound: Sample = Sample()) -> list:
    """The training rows (text, toxic), at most ``bound``, never held-out ones."""
    one = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
           .where(~held_out(F.col("doc_id"))))
    order = F.xxhash64("doc_id")
    picked = [one.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(n)
              for k, n in ((0, bound.clean), (1, bound.toxic))]
    ids = picked[0].unionByName(picked[1])
    # at most bound.toxic + bound.clean rows of two numbers are broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    length = F.coalesce(F.length("text"), F.lit(0))
    long = F.when(length > bound.chars // 8, length).otherwise(0)
    w = Window.partitionBy("toxic").orderBy(long, order, "doc_id", F.xxhash64("text")).rowsBetween(
        Window.unboundedPreceding, 0)
    size = F.sum(length).over(w)
    rows = rows.withColumn("size", size).where(F.col("size") <= bound.chars)
    return sorted((r["text"] or "", r["toxic"]) for r in rows.select("text", "toxic").collect())


def fit(docs: DataFrame, labels: DataFrame, bound: Sample = Sample()) -> Model:
    rows = sample(docs, labels, bound)
    return train([t for t, _ in rows], [k for _, k in rows])


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The documents with ``name``, P(toxic) of the most toxic window; a column
    of that name is replaced (see ``common.free_name``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one float a bucket

    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, known = shared.value, {}
        for s in parts:
            texts = s.tolist()
            found = [score_texts(texts[i:i + BLOCK], model, known) for i in range(0, len(texts), BLOCK)]
            yield pd.Series(np.concatenate([*found, np.zeros(0)]))

    return docs.withColumn(name, scores(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, bound: Sample = Sample(),
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (score at or over the threshold)."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, bound))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: every document's toxicity."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
