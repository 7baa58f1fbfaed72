"""LM scoring: cross-entropy difference of two matched n-gram models.

The target model is counted on the target documents, the background model on
all of them. Both are interpolated word bigrams: words and pairs of words go by
64-bit hashes (a word's pairs among themselves by 48 bits), and every one of them
has its own count, however many there are.
``WORDS`` is the size of the vocabulary that smoothing assumes. Background
counts are scaled to the target's number of tokens, so the same smoothing means
the same in both. A document's score is the mean over its tokens of target loss
minus background loss, in nats: below 0, it is more like the target.

Counting covers every token of every document. A token's loss is the logarithm
of its context's count less that of its pair's smoothed count. The most frequent
words and pairs of a sample (``HEAD_WORDS``, ``HEAD_PAIRS``) are counted over
everything first and broadcast; documents settle these tokens themselves. The
others meet their counts in one exchange: a task gathers its documents' distinct
pairs into loads of bounded size and deals each load by hash into buckets, by the
word, or by the pair if the word is among the frequent ones, so that no frequent
word or pair lands in one bucket. A pair crosses once for each load, with the
documents that have it. A bucket adds up the counts and answers each load with
its documents' losses, which the load's texts then add up. Losses are summed in
units of 2**-22 nats, so that no order matters. Which words the sample finds
decides what is shuffled, never a count. The number of buckets grows with the
tokens, so a bucket's and a load's size do not depend on the corpus.

Edge cases: null or empty texts have no tokens and score 0; without target
documents both models are uniform and every score is 0; several target rows of
a document count once; repeated documents count each time; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import blocks_of, mix64, mostly, staged, table, word_hashes

#: The vocabulary that smoothing assumes.
WORDS = 1 << 20
#: Weight of the word model in the pair model, in tokens.
ALPHA = 4.0
#: Words (2**16 at most) and pairs that are broadcast, and the documents and characters they are looked for in.
HEAD_WORDS, HEAD_PAIRS = 1 << 16, 1 << 19
SAMPLE_DOCS, SAMPLE_CHARS = 8000, 20_000
#: Entries of a load, tokens of the corpus to a bucket, units to a nat.
LOAD, BUCKET, UNIT = 1 << 18, 1_000_000, 1 << 22


class Head:
    """Hashes, sorted, and the counts (target, every) of each."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.counts = np.zeros((2, len(keys)))

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 if it isn't here."""
        if not len(self.keys):
            return np.full(len(x), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, x), len(self.keys) - 1)
        return np.where(self.keys[at] == x, at, -1)


@dataclass(frozen=True)
class Model:
    """What is counted, all documents and the target's; the frequent words and
    pairs; the numbers of tokens (target, every)."""

    docs: DataFrame
    own: DataFrame
    words: Head
    pairs: Head
    tokens: tuple[float, float]

    @property
    def scale(self) -> tuple[float, float]:
        """Of counts: matched, the same number of tokens."""
        return 1.0, self.tokens[0] / max(1.0, self.tokens[1])


def tokens_of(block: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, pair with the word before, is the text's last) of all tokens; pair 0: the text's start."""
    h, begin = word_hashes(block)
    pair = np.zeros(len(h), np.uint64)
    pair[1:] = np.maximum(mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]), np.uint64(1))
    size = np.diff(begin)
    pair[begin[:-1][size > 0]] = 0
    last = np.zeros(len(h), bool)
    last[begin[1:][size > 0] - 1] = True
    return np.repeat(np.arange(len(block)), size), h.view(np.int64), pair.view(np.int64), last


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words of a sample, and the most frequent pairs that end in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in blocks_of(t.as_py() for t in b.column(0)):
                _, word, pair, _ = tokens_of(block)
                kind, at, n = np.unique(pair, return_index=True, return_counts=True)
                some = kind != 0
                yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (word[at], kind, n)],
                                                 names=["word", "pair", "n"])

    one_in = max(1, docs.count() // SAMPLE_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("row"), F.lit(one_in)) == 0)
    pairs = sample.select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).mapInArrow(run, "word long, pair long, n long").groupBy("word", "pair").agg(
        F.sum("n").alias("n")).persist()
    words = pairs.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "word").limit(HEAD_WORDS)
    top = pairs.where("n > 1").orderBy(F.desc("n"), "pair").limit(HEAD_PAIRS).select("word", "pair").toArrow()  # bounded
    word = words.select("word").toArrow().column(0).to_numpy()
    pairs.unpersist()
    return word, top.column("pair").to_numpy()[np.isin(top.column("word").to_numpy(), word)]


def _head_counts(texts: DataFrame, words: Head, pairs: Head) -> np.ndarray:
    """Counts of the head's words, of its pairs, and of all tokens, over all texts."""
    shared = texts.sparkSession.sparkContext.broadcast((words, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = shared.value
        total = np.zeros(len(words.keys) + len(pairs.keys) + 1, np.int64)
        for b in batches:
            for block in blocks_of(t.as_py() for t in b.column(0)):
                _, word, pair, _ = tokens_of(block)
                for head, x, at in ((words, word, 0), (pairs, pair, len(words.keys))):
                    found = head.find(x)
                    kind, n = np.unique(found[found >= 0], return_counts=True)
                    total[at + kind] += n
                total[-1] += len(word)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    rows = texts.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(words.keys) + len(pairs.keys) + 1)
    out[rows.column("at").to_numpy()] = rows.column("n").to_numpy()  # bounded by the head
    return out


def _rows(docs: DataFrame) -> DataFrame:
    doc = F.col("doc_id").cast("long")
    return docs.select(doc.alias("doc_id"), "text", F.xxhash64(doc, "text").alias("row"))


def fit(docs: DataFrame, targets: DataFrame) -> Model:
    """The two models; ``targets``: doc_id."""
    wanted = targets.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long")).distinct()
    rows = _rows(docs)
    own = staged(mostly(rows.withColumn("key", F.xxhash64("doc_id")), wanted.select(F.xxhash64("doc_id").alias("key"))).join(
        wanted, "doc_id", "left_semi").select(*rows.columns), "target")  # read twice, joined once
    words, pairs = map(Head, _frequent(rows))
    tokens = []
    for k, texts in enumerate((own, rows)):
        n = _head_counts(texts, words, pairs)
        words.counts[k], pairs.counts[k] = n[:len(words.keys)], n[len(words.keys):-1]
        tokens.append(float(n[-1]))
    return Model(docs, own, words, pairs, (tokens[0], tokens[1]))


#: Of a load's rows: they hold counts of the target, of everything, entries that want their loss, texts, rare words.
_TARGET, _EVERY, _USE, _TEXTS, _RARE = 1, 2, 4, 8, 16
_LOW = np.uint64((1 << 48) - 1)
_UNMIX = [np.uint64(pow(f, -1, 1 << 64)) for f in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD)]
_LOADS = "bucket long, load long, kind int, data binary"
_LOAD_NAMES = ["bucket", "load", "kind", "data"]


def pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit integers as bytes: the n-th bytes of a column's values
    stand together, the highest that are zero in all are left out, and what is
    left is compressed."""
    head, out = [len(columns)], []
    for c in columns:
        c = np.ascontiguousarray(c).astype(np.int64, copy=False).view(np.uint64)
        width = (int(np.bitwise_or.reduce(c)).bit_length() + 7) // 8 if len(c) else 0
        head += [len(c), width]
        out.append(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    data = np.array(head, np.int64).tobytes() + b"".join(out)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    """What was packed, as signed integers, of 32 bits if they are small."""
    data = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    many = int(np.frombuffer(data, np.int64, 1)[0])
    at, out = 8 * (1 + 2 * many), []
    for n, width in np.frombuffer(data, np.int64, 2 * many, 8).reshape(-1, 2).tolist():
        c = np.zeros((n, 4 if width < 4 else 8), np.uint8)
        c[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
        out.append(c.view(np.int32 if width < 4 else np.int64).reshape(-1))
        at += n * width
    return out


def _key(place: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """One number for a frequent word's place and 48 bits of its pair's hash, spread over all 64 bits."""
    return mix64(place.astype(np.uint64) << np.uint64(48) | pair.view(np.uint64) & _LOW)


def _place(key: np.ndarray) -> np.ndarray:
    """The place that went into a key: every step of ``mix64`` can be taken back."""
    x = key.copy()
    for factor in _UNMIX:
        x ^= x >> np.uint64(33)
        x *= factor
    x ^= x >> np.uint64(33)
    return (x >> np.uint64(48)).astype(np.int64)


def _fixed(x: np.ndarray) -> np.ndarray:
    """Losses in units of 1 / ``UNIT`` nats, so that their sums depend on no order; signs in the lowest bit."""
    x = np.rint(x * UNIT).astype(np.int64)
    return (x << 1) ^ (x >> 63)


def _unfixed(x: np.ndarray) -> np.ndarray:
    return (x >> 1) ^ -(x & 1)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where, in sorted columns, a new tuple starts."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


class _Load:
    """What a task has gathered for one load: texts, and entries (text, key,
    pair, times, times as a context) that it cannot settle, of frequent words
    and of rare ones. A frequent word's key says the pair; a rare one's is the
    word, and 48 bits of the pair's hash tell its pairs apart."""

    def __init__(self, number: int):
        self.number, self.texts, self.entries, self.size, self.docs = number, [], {0: [], _RARE: []}, 0, 0

    def full(self) -> bool:
        return self.size >= LOAD or self.docs >= LOAD // 4

    def add(self, docs: int, texts: list[np.ndarray], entries: dict[int, list[np.ndarray]]) -> None:
        """``docs`` texts more, numbered from 0 in the entries."""
        if texts:
            self.texts.append(texts)
        for rare, (text, *other) in entries.items():
            self.entries[rare].append([text + np.int32(self.docs), *other])
            self.size += len(text)
        self.docs += docs

    def rows(self, kind: int, buckets: int) -> pa.RecordBatch:
        """The texts as one row, the entries as one for each bucket of keys."""
        out = []
        if self.texts:
            out.append((-1 - self.number, self.number, _TEXTS, pack(*map(np.concatenate, zip(*self.texts, strict=True)))))
        for rare, entries in self.entries.items():
            text, key, pair, n, context = map(np.concatenate, zip(*entries, strict=True))
            if not kind & _USE:  # only the counts are wanted
                text, context = np.zeros_like(text), np.zeros_like(context)
            order = np.lexsort((text, pair, key))
            text, key, pair, n, context = (x[order] for x in (text, key, pair, n, context))
            first = _starts(key, pair, text)
            if len(first) < len(key):
                n, context = np.add.reduceat(n, first), np.add.reduceat(context, first)
                text, key, pair = (x[first] for x in (text, key, pair))
            bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut = _starts(bucket)
            for a, b in zip(cut.tolist(), np.append(cut, len(bucket))[1:].tolist(), strict=True):
                one = _starts(key[a:b], pair[a:b])
                step = np.diff(key[a:b][one], prepend=np.uint64(0))  # sorted: only the steps are sent
                out.append((int(bucket[a]), self.number, kind | rare, pack(
                    step, pair[a:b][one] if rare else one[:0], np.diff(np.append(one, b - a)), text[a:b], n[a:b],
                    context[a:b])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*out, strict=True) if out else [[]] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
            names=_LOAD_NAMES)


def _loads(rows: DataFrame, model: Model, kind: int, buckets: int) -> DataFrame:
    """What the documents settle themselves, if ``kind`` says that losses are
    wanted, and what they cannot: loads of bounded size, dealt into buckets."""
    shared = rows.sparkSession.sparkContext.broadcast((model.words, model.pairs, model.tokens, model.scale))
    use = bool(kind & _USE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, tokens, scale = shared.value
        load = _Load(TaskContext.get().partitionId() << 32)
        for b in batches:
            ids, done = b.column("doc_id"), 0
            for block in blocks_of(t.as_py() for t in b.column("text")):
                text, word, pair, last = tokens_of(block)
                common, known = words.find(word), pairs.find(pair)
                start = pair == 0
                settled = (common >= 0) & ((known >= 0) | start)
                texts = []
                if use:
                    context = ~last & (common >= 0)
                    loss = []
                    for k in range(2):
                        single = (words.counts[k][common[settled]] * scale[k] + 1.0) / (tokens[0] + WORDS)
                        both = np.zeros(len(single))
                        old = known[settled] >= 0
                        both[old] = pairs.counts[k][known[settled][old]] * scale[k]
                        loss.append(np.bincount(text[settled], -np.log(both + ALPHA * single), len(block))
                                    + np.bincount(text[context], np.log(
                                        words.counts[k][common[context]] * scale[k] + ALPHA), len(block))
                                    + np.bincount(text[start], minlength=len(block)) * np.log(ALPHA))
                    own = ids.slice(done, len(block))
                    texts = [own.fill_null(0).to_numpy(), np.asarray(own.is_valid()).astype(np.int64),
                             np.bincount(text, minlength=len(block)), _fixed(loss[0]), _fixed(loss[1])]
                done += len(block)
                entries = {}
                for kind_of, some in ((0, ~settled & (common >= 0)), (_RARE, common < 0)):
                    own_pair = np.where(start[some], 0, np.maximum(pair[some].view(np.uint64) & _LOW, np.uint64(1)))
                    entries[kind_of] = [
                        text[some].astype(np.int32),
                        word[some].view(np.uint64) if kind_of else _key(common[some], pair[some]),
                        own_pair.astype(np.int64) if kind_of else np.zeros(len(own_pair), np.int64),
                        np.ones(len(own_pair), np.int32), (~last[some]).astype(np.int32) * bool(kind_of)]
                load.add(len(block), texts, entries)
                if load.full():
                    yield load.rows(kind, buckets)
                    load = _Load(load.number + 1)
        if load.docs:
            yield load.rows(kind, buckets)

    return rows.select("doc_id", "text").mapInArrow(run, _LOADS)


def _settle(loads: DataFrame, model: Model) -> DataFrame:
    """Every bucket counts its pairs and answers the loads that want losses:
    (bucket, load, kind, data) with (text, target loss, every loss)."""
    shared = loads.sparkSession.sparkContext.broadcast((model.words.counts, model.tokens, model.scale))

    def run(group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_numpy()
        if len(kinds) and kinds[0] == _TEXTS:
            return group
        frequent, tokens, scale = shared.value
        parts = [unpack(d.as_py()) for d in group.column("data")]
        size = [len(p[0]) for p in parts]
        key = np.concatenate([np.cumsum(p[0].astype(np.uint64)) for p in parts])
        kind = np.repeat(kinds, size)
        pair = np.zeros(len(key), np.int64)
        pair[(kind & _RARE) > 0] = np.concatenate([p[1] for p in parts])
        place = np.where(kind & _RARE, 0, _place(key) + 1)  # among the frequent words, from 1
        n = np.concatenate([np.add.reduceat(p[4], np.cumsum(p[2]) - p[2]) for p in parts])
        order = np.lexsort((pair, place, key))
        first_pair = _starts(key[order], place[order], pair[order])
        first_word = _starts(key[order], place[order])
        of = np.empty((2, len(order)), np.int32)  # the pair and the word of each
        del key
        for k, first in enumerate((first_pair, first_word)):
            of[k, order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        del order
        outside, inside = [], []  # a text's loss for each time, and for each time as a context
        for k, flag in enumerate((_TARGET, _EVERY)):
            counted = np.where(kind & flag, n, 0)
            pairs = np.bincount(of[0], counted)[of[0]] * scale[k]
            # a frequent word's pairs are keys of their own; its count is known
            words = np.where(place > 0, np.append(0, frequent[k])[place], np.bincount(of[1], counted)[of[1]]) * scale[k]
            single = (words + 1.0) / (tokens[0] + WORDS)
            outside.append(-np.log(np.where((place == 0) & (pair == 0), 0.0, pairs) + ALPHA * single))
            inside.append(np.log(words + ALPHA))
        out, at = [], np.cumsum([0, *size])
        for i, p in enumerate(parts):
            if not kinds[i] & _USE:
                continue
            who, place_of = np.unique(p[3], return_inverse=True)
            entry = np.repeat(np.arange(at[i], at[i + 1]), p[2])
            out.append((i, pack(who, *(_fixed(np.bincount(place_of, np.rint(
                (p[4] * outside[k][entry] + p[5] * inside[k][entry]) * UNIT), len(who)) / UNIT) for k in range(2)))))
        answers = group.take(pa.array([i for i, _ in out], pa.int64()))
        return answers.set_column(3, "data", pa.array([d for _, d in out], pa.binary()))

    return loads.groupBy("bucket").applyInArrow(run, _LOADS)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, mean losses under both models, and their difference."""
    tokens, every = model.tokens[1], _rows(model.docs)
    if docs is model.docs:
        parts = [(every, _EVERY | _USE)]
    else:
        parts = [(every, _EVERY), (_rows(docs), _USE)]
        tokens += docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)) / 6).first()[0]
    buckets = 1 + int(tokens // BUCKET)
    loads = _loads(model.own, model, _TARGET, buckets)
    for rows, kind in parts:
        loads = loads.unionByName(_loads(rows, model, kind, buckets))

    def run(group: pa.Table) -> pa.Table:
        kinds, data = group.column("kind").to_numpy(), group.column("data")
        texts = np.flatnonzero(kinds == _TEXTS)
        if not len(texts):  # a load of counts only
            return pa.Table.from_batches([], _SCORES)
        ids, valid, n, *sums = unpack(data[int(texts[0])].as_py())
        ids, n, *sums = ids.astype(np.int64), n.astype(np.int64), *(_unfixed(x.astype(np.int64)) for x in sums)
        for i in np.flatnonzero(kinds != _TEXTS).tolist():
            who, *losses = unpack(data[i].as_py())
            for total, x in zip(sums, losses, strict=True):
                total[who] += _unfixed(x)
        target, background = (x / UNIT / np.maximum(n, 1) for x in sums)
        return pa.Table.from_arrays([pa.array(ids, mask=valid == 0), pa.array(n), pa.array(target), pa.array(background),
                                     pa.array(target - background)], schema=_SCORES)

    return _settle(loads, model).groupBy("load").applyInArrow(
        run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


_SCORES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()),
                     ("background_loss", pa.float64()), ("score", pa.float64())])


def query(spark, sf_dir: str) -> DataFrame:
    """op3: all documents; the target are those labelled as of high quality."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels").where("quality = 1")))
