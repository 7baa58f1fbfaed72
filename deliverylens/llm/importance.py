"""Target-distribution importance resampling over hashed word features.

A document's features are its runs of 1 to ``max_n`` words, each in the bucket
that its CRC32 names. The corpus (all documents) and the target (all benchmark
texts) are counted bucket by bucket, exactly, over everything; a bucket's gain
is the log ratio of its two smoothed shares, a document's weight the sum of its
features' gains, and Gumbel noise from the document's id turns the highest
scores into a draw without replacement.

Vocabulary in head and tail: words frequent in a bounded sample are broadcast
with the state of their CRC, from which a longer feature goes on without
reading the word again, and frequent pairs with their bucket. Whatever is not
there (the tail, of any size) is hashed directly. Both give the same numbers, so
the sample decides speed only. Every task counts into one array of ``buckets``
numbers; what is shuffled is that array, not words.

Edge cases: null or empty texts have no features, weight 0, and are never
drawn; a null id has the noise of the empty string and is last among ties;
repeated rows are scored and drawn each for itself; an empty table gives no
rows, an empty target counts 0 everywhere; extra columns are ignored. A text is
read in slices, so its length is bounded by the row alone.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import NOT_ALNUM, staged, table

BUCKETS = 10_000
MAX_N = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: What is broadcast: this many words and pairs of at most ``HEAD_BYTES`` bytes,
#: found in ``SAMPLE_ROWS`` documents. None of it changes a result.
HEAD_WORDS = 1 << 16
HEAD_PAIRS = 1 << 16
HEAD_BYTES = 64
SAMPLE_ROWS = 2_000

_SLICE = 1 << 20
#: A-Z to a-z, what stands between words to a blank.
_FOLD = bytes(32 if NOT_ALNUM[c] else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_in(text: str | None, carry: int = 0) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size; each list begins with the
    last ``carry`` words before it."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    begin, before = 0, []
    while begin < len(data):
        end = data.find(b" ", begin + _SLICE)
        end = len(data) if end < 0 else end
        words = before + data[begin:end].split()
        if len(words) > len(before):
            yield words
        before, begin = words[max(0, len(words) - carry):] if carry else [], end


class _States(dict):
    """Word -> state of the CRC after it."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class _Pairs(dict):
    """Two words -> state of the CRC after ``first second``."""

    def __init__(self, known, states: _States):
        super().__init__(known)
        self.states = states

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return zlib.crc32(b" " + pair[1], self.states[pair[0]])


class Buckets:
    """Text -> arrays of the buckets of its features."""

    def __init__(self, head: dict, max_n: int, buckets: int):
        self.max_n, self.buckets = max_n, buckets
        self.states = _States(head["words"])
        self.pairs = _Pairs(head["pairs"], self.states)

    def of(self, text: str | None) -> Iterator[tuple[int, np.ndarray]]:
        """(words that are new in this slice, buckets of the features ending in them)."""
        carry = self.max_n - 1
        held = 0
        for words in words_in(text, carry):
            new = len(words) - held
            parts = [np.fromiter(map(self.states.__getitem__, words[held:]), np.int64, new)]
            if self.max_n > 1:
                first = max(0, held - 1)
                pairs = list(zip(words, words[1:], strict=False))
                states = list(map(self.pairs.__getitem__, pairs))
                parts.append(np.array(states[first:], np.int64))
                for n in range(3, self.max_n + 1):
                    states = [zlib.crc32(b" " + w, s) for w, s in zip(words[n - 1:], states, strict=False)]
                    parts.append(np.array(states[max(0, held - n + 1):], np.int64))
            yield new, np.concatenate(parts) % self.buckets
            held = min(carry, len(words))


def head_of(docs: DataFrame, max_n: int = MAX_N) -> dict:
    """The frequent words and pairs of a bounded sample, with their CRC states."""
    empty = {"words": {}, "pairs": {}}
    keyed = docs.select(F.xxhash64("doc_id").alias("h"), "text")
    cut = keyed.select("h").orderBy("h").limit(SAMPLE_ROWS).agg(F.max("h")).first()[0]
    if cut is None:
        return empty
    kinds = (1, 2) if max_n > 1 else (1,)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text in pdf["text"]:
                for words in words_in(text, 1):
                    for kind in kinds:
                        runs = words if kind == 1 else map(b" ".join, zip(words, words[1:], strict=False))
                        found = {w: n for w, n in Counter(runs).items() if len(w) <= HEAD_BYTES}
                        yield pd.DataFrame({"kind": kind, "run": list(found), "n": list(found.values())})

    counted = (keyed.where(F.col("h") <= cut).limit(SAMPLE_ROWS).select("text")
               .mapInPandas(count, "kind int, run binary, n long")
               .groupBy("kind", "run").agg(F.sum("n").alias("n")))
    out = dict(empty)
    for kind, name, most in ((1, "words", HEAD_WORDS), (2, "pairs", HEAD_PAIRS))[:len(kinds)]:
        rows = counted.where(F.col("kind") == kind).orderBy(F.desc("n"), "run").limit(most).collect()  # at most ``most``
        runs = [bytes(r["run"]) for r in rows]
        out[name] = {(w if kind == 1 else tuple(w.split(b" "))): zlib.crc32(w) for w in runs}
    return out


def bucket_counts(texts: DataFrame, head: Broadcast, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts are in each bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, total = Buckets(head.value, max_n, buckets), np.zeros(buckets, np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                for _, found in hashed.of(text):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    rows = (texts.select("text").mapInPandas(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket, B the number of buckets."""
    b = len(corpus)
    all_s, all_t = float(corpus.sum() + b), float(target.sum() + b)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, head: Broadcast, gains: np.ndarray, max_n: int = MAX_N) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        hashed = Buckets(head.value, max_n, len(gain))
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column("text")):
                for new, found in hashed.of(text.as_py()):
                    out[:, i] += new, len(found), gain[found].sum()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        weigh_all, "doc_id long, n_words long, n_features long, weight long")


def with_noise(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """``score``: the weight plus Gumbel noise in thousandths, from the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weights.withColumn("score", F.col("weight") + noise.cast("long"))


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows with ``rank``: 1, 2, 3... for the floor(percent N / 100) highest
    scores among the N documents of enough words, else null.

    One range shuffle of the narrow rows; each partition numbers its own and
    adds what the partitions before it hold (a row a partition is broadcast).
    ``_row`` splits repeated rows, which would otherwise be one range.
    """
    scored = staged(scored.withColumn("_row", F.monotonically_increasing_id()), "scores")
    fits = F.col("n_words") >= least_words
    n = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("_row")]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(done + 1, done + 1 + n))],
                names=[*batch.schema.names, "_part", "_place"])
            done += n

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.schema)
    placed = staged(scored.where(fits).repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .mapInArrow(number, columns + ", _part int, _place long"), "ranked")
    sizes = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count("_place").alias("n")).collect()}
    before, total = [], 0
    for part in sorted(sizes):  # a row a partition
        before.append((part, total))
        total += sizes[part]
    offsets = scored.sparkSession.createDataFrame(before, "_part int, _before long")
    place = F.col("_place") + F.col("_before")
    ranked = placed.join(F.broadcast(offsets), "_part").withColumn(
        "rank", F.when(place <= F.lit(total * percent // 100), place))
    kept = [*(c for c in scored.columns if c != "_row"), "rank"]
    rest = scored.where(~fits).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(kept).unionByName(rest.select(kept))


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED,
             least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document of
    ``docs``, drawn towards the distribution of ``target``'s texts."""
    share: Callable[[dict], Broadcast] = docs.sparkSession.sparkContext.broadcast
    head = share(head_of(docs, max_n))
    gains = gains_of(bucket_counts(docs, head, max_n, buckets), bucket_counts(target, head, max_n, buckets))
    return draw(with_noise(weigh(docs, head, gains, max_n), seed), least_words, percent)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every document, a tenth of them drawn towards the benchmark."""
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
