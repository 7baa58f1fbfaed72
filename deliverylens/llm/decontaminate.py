"""Benchmark decontamination: latent semantic retrieval, then exact checks.

1. Document frequencies of words (hashed into ``DF_BUCKETS``) are counted over
   all documents.
2. The index: a randomised SVD of TF-IDF passages. Terms are the benchmark's
   words; rows are passages of a bounded sample of documents (``FIT_DOCS``) and
   the benchmark's own items, weighted to count as much as the sample. Each
   task multiplies its passages with the random test matrix and back; partial
   products are summed by blocks of terms, and the small factors are solved on
   the driver, whose size depends on parameters and the benchmark only.
3. Every passage of every document (two adjacent blocks of ``BLOCK_WORDS``
   words) is scored by its cosine with each item in the latent space: a term's
   loading on an item is its entry of V V' times the item, over the norm that
   the projection leaves of the item. Pairs from ``COSINE`` on are candidates;
   of an item longer than a passage, which can cover only a part of it, a share
   of ``COSINE`` suffices. The benchmark is the stated query set, taken in
   passes of at most ``ITEMS`` items; each ``LATENT`` of them, fewer than the
   rank, have an SVD of their own, so recall does not depend on their number.
4. A candidate is a leak if the longest common subsequence with the item, in
   words, covers ``SURE`` of it, or ``LIKELY`` of it while the answer (its last
   ``ANSWER_WORDS`` words) stands there as well.

Words are runs of letters and digits (and of anything outside ASCII), compared
in lower case, by 64-bit hashes. Edge
cases: null or empty texts and items match nothing; items of fewer than
``LEAST_WORDS`` words are not searched for; repeated items are searched for
once each; repeated rows are judged each; an empty benchmark leaves all
documents clean; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import NOT_ALNUM, blocks_of, distinct, staged, table, word_hashes

BLOCK_WORDS = 24
DF_BUCKETS = 1 << 16
RANK, OVERSAMPLE = 256, 16
#: The SVD is fitted on the passages of at most so many documents, and characters.
FIT_DOCS = 2000
FIT_CHARS = 8_000_000
#: Items searched for in one pass over the documents, and those that share an SVD.
ITEMS, LATENT = 1000, 200
COSINE = 0.2
LEAST_LOADING = 0.1
SURE, LIKELY = 0.75, 0.5
ANSWER_WORDS = 6
LEAST_WORDS = 8
_TERM_BLOCK = 256

_HITS = "array<struct<item_id:bigint,cosine:double,lcs_words:bigint,item_words:bigint,answer:boolean,start:bigint>>"
_HITS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_words", pa.int64()),
                                  ("item_words", pa.int64()), ("answer", pa.bool_()), ("start", pa.int64())]))


def words_of(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The hashed words of each text."""
    for block in blocks_of(texts, fold=True):
        words, begin = word_hashes(block, NOT_ALNUM)
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            yield words[a:b]


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(40)).astype(np.int64) & (DF_BUCKETS - 1)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents per word bucket, documents), over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, n = np.zeros(DF_BUCKETS, np.int64), 0
        for b in batches:
            for block in blocks_of((t.as_py() for t in b.column(0)), fold=True):
                words, begin = word_hashes(block, NOT_ALNUM)
                doc = np.repeat(np.arange(len(block)), np.diff(begin))
                count += np.bincount(distinct(doc * DF_BUCKETS + _bucket(words)) % DF_BUCKETS, minlength=DF_BUCKETS)
                n += len(block)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(count[some], n))],
                                         names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()  # a row a bucket
    out, total = np.zeros(DF_BUCKETS, np.int64), 0
    for r in rows:
        if r["bucket"] < 0:
            total = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, total


class Terms:
    """Word -> (term number, idf); the number of terms stands for other words."""

    def __init__(self, words: np.ndarray, idf: np.ndarray):
        self.words, self.idf = distinct(words), idf
        self._maybe = np.zeros(1 << 20, bool)
        self._maybe[self.words & np.uint64((1 << 20) - 1)] = True

    def __len__(self) -> int:
        return len(self.words)

    def __call__(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        term = np.full(len(words), len(self), np.int64)
        some = np.flatnonzero(self._maybe[words & np.uint64((1 << 20) - 1)])
        at = np.minimum(np.searchsorted(self.words, words[some]), len(self) - 1)
        same = self.words[at] == words[some]
        term[some[same]] = at[same]
        return term, self.idf[_bucket(words)]


@dataclass(frozen=True)
class Index:
    """What a search task needs: its size depends on the items and parameters."""

    item_ids: list[int]
    item_words: list[list[int]]
    terms: Terms
    first: np.ndarray  # by term, and one more: where its loadings begin
    item: np.ndarray  # of each loading
    load: np.ndarray
    share: np.ndarray  # by item: of COSINE and LEAST_LOADING, under 1 if longer than a passage


def _loadings(latent: np.ndarray, idf: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, item, load) of terms x items, times idf, without what is too small
    to matter: loadings under LEAST_LOADING, such as those of frequent words."""
    load = latent * idf[:, None]
    term, item = np.nonzero(load >= LEAST_LOADING * share)
    first = np.searchsorted(term, np.arange(len(latent) + 2))  # other words have none
    return first, item, load[term, item]


def candidates(words: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item, cosine) from COSINE on. Passage p is block p with the next."""
    term, weight = index.terms(words)
    n, n_items = -(-len(words) // BLOCK_WORDS) + 1, len(index.item_ids)
    count = index.first[term + 1] - index.first[term]
    at = np.repeat(index.first[term] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    block = np.repeat(np.arange(len(words)) // BLOCK_WORDS, count)
    sums = np.bincount(block * n_items + index.item[at], index.load[at], n * n_items).reshape(n, n_items)
    square = np.bincount(np.arange(len(words)) // BLOCK_WORDS, weight * weight, n)
    norm = np.sqrt(square[:-1] + square[1:]) + 1e-9
    cosine = (sums[:-1] + sums[1:]) / norm[:, None]
    p, item = np.nonzero(cosine >= COSINE * index.share)
    return p, item, cosine[p, item]


def _passage_terms(term: np.ndarray, weight: np.ndarray, n_terms: int):
    """(passage, term, weight) entries of unit-length passages, for the fit."""
    at = np.flatnonzero(term < n_terms)
    block = at // BLOCK_WORDS
    n = -(-len(term) // BLOCK_WORDS)
    square = np.bincount(np.arange(len(weight)) // BLOCK_WORDS, weight * weight, n + 1)
    norm = np.sqrt(square[:-1] + square[1:]) + 1e-9
    passage = np.concatenate([block, block[block > 0] - 1])
    entry = np.concatenate([at, at[block > 0]])
    return passage, term[entry], weight[entry] / norm[passage]


def _product(passage, term, weight, matrix: np.ndarray) -> np.ndarray:
    """Sparse rows (passage, term, weight) times a matrix over terms."""
    order = np.argsort(passage, kind="stable")
    passage, term, weight = passage[order], term[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    return np.add.reduceat(matrix[term] * weight[:, None], first, axis=0), np.repeat(
        np.arange(len(first)), np.diff(np.append(first, len(passage)))), term, weight


def _fit_pass(sample: DataFrame, terms: Terms, matrix: np.ndarray, back: bool) -> np.ndarray:
    """Sum over passages a of a' (a M) if ``back``, else of (a M)' (a M)."""
    shared = sample.sparkSession.sparkContext.broadcast((terms, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, matrix = shared.value
        total = np.zeros_like(matrix if back else matrix.T @ matrix)
        for b in batches:
            for words in words_of(t.as_py() for t in b.column(0)):
                entries = _passage_terms(*terms(words), len(terms))
                if len(entries[0]):
                    y, row, term, weight = _product(*entries, matrix)
                    if back:
                        order = np.argsort(term, kind="stable")
                        own = term[order]
                        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                        total[own[first]] += np.add.reduceat(y[row[order]] * weight[order, None], first, axis=0)
                    else:
                        total += y.T @ y
        blocks = [total[i:i + _TERM_BLOCK].astype(np.float32).tobytes() for i in range(0, len(total), _TERM_BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int64()), pa.array(blocks, pa.binary())],
                                         names=["block", "part"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in pdf["part"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "part": [total.astype(np.float32).tobytes()]})

    rows = sample.select("text").mapInArrow(run, "block long, part binary").groupBy("block").applyInPandas(
        add, "block long, part binary").collect()  # as large as the matrix
    shared.unpersist()
    parts = [np.frombuffer(r["part"], np.float32) for r in sorted(rows, key=lambda r: r["block"])]
    shape = matrix.shape if back else (matrix.shape[1],) * 2
    return np.concatenate([*parts, np.zeros(0, np.float32)]).reshape(shape) if parts else np.zeros(shape, np.float32)


def fit(sample: DataFrame, items: list[tuple[int, str]], df: np.ndarray, n_docs: int, seed: int = 3) -> Index | None:
    """The index of some items; None if none is long enough."""
    kept = [(i, w) for (i, _), w in zip(items, words_of(t for _, t in items), strict=True) if len(w) >= LEAST_WORDS]
    if not kept:
        return None
    idf = np.log((n_docs + 1) / (df + 1)).astype(np.float32) + np.float32(0.01)
    terms = Terms(np.concatenate([w for _, w in kept]), idf)
    own = np.zeros((len(kept), len(terms)), np.float32)
    for r, (_, words) in enumerate(kept):
        np.add.at(own[r], *terms(words))
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    rank = min(RANK, len(terms))
    omega = np.random.default_rng(seed).normal(size=(len(terms), min(rank + OVERSAMPLE, len(terms)))).astype(np.float32)
    z = _fit_pass(sample, terms, omega, True)
    mine = own.T @ (own @ omega)
    scale = max(1.0, float(np.linalg.norm(z) / max(1e-9, np.linalg.norm(mine))))
    q, _ = np.linalg.qr(z + scale * mine)
    gram = _fit_pass(sample, terms, q.astype(np.float32), False) + scale * (own @ q).T @ (own @ q)
    value, vector = np.linalg.eigh(gram.astype(np.float64))
    basis = (q @ vector[:, np.argsort(-value)[:rank]]).astype(np.float32)
    latent = own @ basis
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), np.float32(1e-3))
    share = np.sqrt(np.minimum(1.0, 2 * BLOCK_WORDS / np.array([len(w) for _, w in kept])))
    loadings = _loadings(basis @ latent.T, idf[_bucket(terms.words)], share)
    return Index([i for i, _ in kept], [w.tolist() for _, w in kept], terms, *loadings, share)


def common_subsequence(text: list[int], item: list[int]) -> int:
    """Length of the longest common subsequence, a bit for each word of the item."""
    at: dict[int, int] = {}
    for k, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    v = full
    for w in text:
        m = v & at.get(w, 0)
        if m:
            v = ((v + m) | (v - m)) & full
    return len(item) - v.bit_count()


def check(words: list[int], item: list[int]) -> tuple[int, bool]:
    """(longest common subsequence in words, does the answer stand in the text?)"""
    answer = item[-ANSWER_WORDS:]
    n = len(answer)
    there = any(words[i:i + n] == answer for i in range(len(words) - n + 1))
    return common_subsequence(words, item), there


def is_leak(lcs: int, answer: bool, n: int) -> bool:
    return lcs >= SURE * n or lcs >= LIKELY * n and answer


def find(words: np.ndarray, index: Index) -> list[dict]:
    """The leaks of a text's words: each item once, at its best passage."""
    best: dict[int, dict] = {}
    for p, k, cosine in zip(*(x.tolist() for x in candidates(words, index)), strict=True):
        own = index.item_words[k]
        a = max(0, p * BLOCK_WORDS - len(own))
        near = words[a:(p + 2) * BLOCK_WORDS + len(own)].tolist()
        there = set(near)
        if sum(map(there.__contains__, own)) < LIKELY * len(own):
            continue  # no common subsequence is longer than that
        lcs, answer = check(near, own)
        if is_leak(lcs, answer, len(own)) and (k not in best or lcs > best[k]["lcs_words"]):
            best[k] = {"item_id": index.item_ids[k], "cosine": cosine, "lcs_words": lcs,
                       "item_words": len(own), "answer": answer, "start": a}
    return [best[k] for k in sorted(best)]


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def search(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, str]:
    """The documents, all columns, with a new column of leaks; and its name."""
    bench = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL")
    n_items = bench.count()
    blocks = -(-n_items // ITEMS)
    df, n_docs = document_frequencies(docs) if blocks else (np.zeros(DF_BUCKETS, np.int64), 0)
    order = F.xxhash64("doc_id", "text")
    picked = docs.select("text", order.alias("k")).where("text IS NOT NULL").where(
        F.pmod("k", F.lit(max(1, n_docs // FIT_DOCS))) == 0)
    sample = staged(picked.orderBy("k").limit(FIT_DOCS).withColumn("room", F.sum(F.length("text")).over(
        _by_order())).where(F.col("room") <= FIT_CHARS).select("text").repartition(16), "fit-sample") if blocks else None
    out, names = docs, []
    for b in range(blocks):
        items = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        rows = sorted(((r["item_id"], r["text"]) for r in items), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        parts = -(-len(rows) // LATENT)
        indexes = [x for k in range(parts) if (x := fit(sample, rows[k::parts], df, n_docs)) is not None]
        if indexes:
            names.append(_free_name(out, "leaks"))
            out = _with_leaks(out, indexes, names[-1])
    name = _free_name(out, "leaks")
    every = F.concat(*names) if names else F.array().cast(_HITS)
    return out.withColumn(name, every).drop(*names), name


def _by_order():
    """By hash, texts of over an eighth of the bound last, the shortest first, so that
    none of them takes the room of the others."""
    from pyspark.sql.window import Window

    long = F.when(F.length("text") > FIT_CHARS // 8, F.length("text")).otherwise(0)
    return Window.orderBy(long, "k", "text").rowsBetween(Window.unboundedPreceding, 0)


def _with_leaks(docs: DataFrame, indexes: list[Index], name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(indexes)  # bounded by ITEMS and RANK
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = shared.value
        for b in batches:
            leaks = [[hit for index in indexes for hit in find(words, index)]
                     for words in words_of(t.as_py() for t in b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaks, _HITS_ARROW)], names=[*b.schema.names, name])

    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    schema = StructType([*docs.schema.fields, StructField(name, _parse_datatype_string(_HITS))])
    return docs.mapInArrow(run, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, all columns."""
    out, name = search(docs, benchmark)
    return out.where(F.size(name) == 0).drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every leak of a benchmark item in a document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, name = search(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.inline(name))
