"""N-gram Jaccard join: signature trees with dual traversal.

Every document is the set of its distinct word n-grams; two documents link if
the Jaccard similarity of their sets reaches a threshold. The result is each
document's connected component, and no link between different sets is lost.

1. Equal sets are one *node*. All documents order their n-grams alike, the
   rarest first. Linked sets then share an n-gram among the first
   ``n - ceil(t n) + 1`` of either, its *prefix*. N-grams cross once in loads,
   dealt by hash into buckets whose number grows with the corpus; a bucket counts
   them and answers each load with those that others have too. N-grams of a single
   document come first in the order and can't be shared, so most documents have
   no prefix left that needs a comparison, and passages that many documents carry
   come last. N-grams frequent in a sample are broadcast, never sent, and come last
   of all; any common order gives the same links, so the sample decides no result.
2. Nodes that share an n-gram of their prefixes, directly or over others, form
   a *family* (connected components by joins). Its sets are read once.
3. A family is cut into blocks of at most ``BLOCK`` nodes. A block builds a
   signature tree: leaves of similar sets, each tree node with the OR of its
   token bitmaps, its size range and its most bitmap collisions. A dual
   traversal prunes pairs of tree nodes whose largest possible overlap is too
   small for a link, or which are one component already; pairs of sets that
   remain are compared exactly.
4. A large family is cut by size and hash. Its blocks are joined in more
   steps: the largest components of the blocks with each other, in rounds of
   bounded groups, and then the members outside the family's largest component,
   block by block, with all blocks whose sizes they could link with.

Tasks hold a load, a bucket, or two blocks; a prefix n-gram that many share
reaches its owner once per load, not once per document.

Edge cases: null, empty or blank texts have no set and link with nothing;
texts with fewer than n words are one n-gram; repeated rows are one node; rows
with equal ids but other texts are judged by their texts; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import (
    blocks_of,
    distinct,
    free_name,
    mix64,
    mostly,
    staged,
    table,
    window_names,
    word_hashes,
)
from deliverylens.llm.components import components

#: Sets in a tree, sets in a leaf, largest components a block sends on first.
BLOCK = 1024
LEAF = 8
FIRST = 8
#: N-grams of a load (or one text); characters of the corpus to a bucket, some
#: 1,000,000 n-grams; documents of a load.
LOAD, BUCKET, MEMBERS = 2_000_000, 6_000_000, 60_000
#: Sampled documents (of at most so many characters), documents of the sample that
#: have a frequent n-gram, and most of these.
SAMPLE, SAMPLE_CHARS, FREQUENT, MOST = 2048, 20_000, 6, 1 << 16
#: Size bands of a family that is cut: each ends a tenth above its start.
_STEP = 0.1
_INFO = "<?qqqqq"
_PART = 1 << 16
_BAND_RATIO = 0.7


@dataclass(frozen=True)
class Spec:
    """n-gram length in words, and the threshold in whole per cent."""

    words: int
    percent: int

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """How many n-grams of a set of n, in any order common to all sets, hold
        one of every set that links with it."""
        return n - -(-self.percent * n // 100) + 1

    def bands(self, n: int) -> list[int]:
        """Upper sizes of the bands in which a set of size n is compared."""
        ratio = min(_BAND_RATIO, self.percent / 100)
        hi = 6
        while hi < n:
            hi = int(hi / ratio) + 1
        up = int(hi / ratio) + 1
        return [hi, up] if n * 100 // self.percent > hi else [hi]

    def linked(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)


def shingles(texts: Iterable[str | None], spec: Spec) -> Iterator[np.ndarray]:
    """Of each text, the sorted distinct 64-bit hashes of its n-grams."""
    n = spec.words
    for block in blocks_of(texts):
        words, begin = word_hashes(block)
        grams = window_names(words, n) + np.uint64(n)
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            if b - a >= n:
                yield distinct(grams[a:b - n + 1])
            else:  # the whole text, if it has words
                yield window_names(words[a:b], b - a) + np.uint64(b - a) if b > a else words[:0]


def _texts(column: pa.Array) -> Iterator[str | None]:
    return (t.as_py() for t in column)


def node_of(grams: np.ndarray) -> int:
    """The node of a set: equal sets have equal ones."""
    import xxhash

    return int(np.array([xxhash.xxh3_64_intdigest(grams.tobytes())], np.uint64).view(np.int64)[0])


def signatures(size: np.ndarray, member: np.ndarray, key: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of the prefixes: linked sets have one in common.

    ``size`` are the sets' sizes; ``member`` and ``key`` their n-grams that other
    sets have too, as places in the common order. The others come before."""
    order = np.lexsort((key, member))
    member, key = member[order], key[order]
    told = np.bincount(member, minlength=len(size))
    need = spec.prefix(size) - (size - told)
    begin = np.cumsum(told) - told
    some = np.flatnonzero(need > 0)
    last = np.zeros(len(size), np.uint64)
    last[some] = key[begin[some] + need[some] - 1]
    here = np.flatnonzero((need > 0)[member] & (key <= last[member]))  # with ties of the last place
    member, key = member[here], key[here]
    bands = {i: spec.bands(n) for i, n in zip(some.tolist(), size[some].tolist(), strict=True)}
    owners, sigs = [], []
    for slot in (0, 1):
        hi = np.zeros(len(size), np.uint64)
        for i, b in bands.items():
            hi[i] = b[slot] if slot < len(b) else 0
        in_band = hi[member] > 0
        owners.append(member[in_band])
        sigs.append(mix64(key[in_band] + mix64(hi)[member[in_band]]))
    return np.concatenate(owners), np.concatenate(sigs)


class Union:
    """Disjoint sets over 0..n-1; the smallest member is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, a: int, b: int) -> bool:
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
        return a != b

    def roots(self) -> np.ndarray:
        up = self.up
        while not np.array_equal(up, up[up]):
            up = up[up]
        self.up = up
        return up


_LOADS = "at long, load long, kind int, data binary"
_LOAD_NAMES = ["at", "load", "kind", "data"]
_SELF, _GRAMS = 0, 1
_HASH = np.uint64(0x5851F42D4C957F2D)
_LOW, _HALF, _CLASS, _REST = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(56), np.uint64(8)
_ROWS = "sig long, member long, info binary"


def frequent(docs: DataFrame, rows: int, spec: Spec) -> np.ndarray:
    """N-grams (sorted hashes, a bounded number) that a sample of some ``SAMPLE`` of
    the rows has often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in shingles(_texts(b.column("text")), spec):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["gram"])

    chosen = F.shiftrightunsigned(F.xxhash64("key"), 33) < int(min(1, SAMPLE / max(1, rows)) * (1 << 31))
    some = docs.where((F.length("text") <= SAMPLE_CHARS) & chosen).select("text")
    often = (some.mapInArrow(run, "gram long").groupBy("gram").count().where(F.col("count") >= FREQUENT)
             .orderBy(F.desc("count"), "gram").limit(MOST).select("gram").collect())
    return np.sort(np.array([r["gram"] for r in often], np.int64).view(np.uint64))


class Load:
    """Documents and the n-grams of their sets, equal sets once."""

    def __init__(self, number: int):
        self.number = number
        self.sets: list[np.ndarray] = []
        self.place: dict[int, int] = {}
        self.info: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int | None, key: int, grams: np.ndarray) -> None:
        node, member = node_of(grams), -1
        if len(grams):
            member = self.place.setdefault(node, len(self.sets))
            if member == len(self.sets):
                self.sets.append(grams)
                self.held += len(grams)
        self.info.append(struct.pack(_INFO, doc_id is not None, doc_id or 0, key, len(grams), node, member))

    def full(self) -> bool:
        return self.held >= LOAD or len(self.info) >= MEMBERS

    def rows(self, hot: np.ndarray, buckets: int) -> pa.RecordBatch:
        """One row with the documents and the frequent n-grams, which goes over a
        bucket of no meaning; for each bucket one with its n-grams' lower halves and
        the steps from member to member."""
        size = np.array([len(s) for s in self.sets], np.uint32)
        grams = np.concatenate([*self.sets, np.zeros(0, np.uint64)])
        self.sets = []  # not held twice
        member = np.repeat(np.arange(len(size), dtype=np.uint16), size)
        known = _by_parts(lambda g: hot[np.searchsorted(hot, g).clip(max=len(hot) - 1)] == g if len(hot)
                          else np.zeros(len(g), bool), grams, bool)
        head = struct.pack("<qqq", len(self.info), len(size), int(known.sum()))
        out = [(self.number % buckets, self.number, _SELF, b"".join(
            [head, *self.info, size.tobytes(), grams[known].tobytes(), member[known].tobytes()]))]
        grams, member = grams[~known], member[~known]
        h = _by_parts(lambda g: mix64(g ^ _HASH), grams, np.uint64)
        del grams
        low = h.astype(np.uint32)
        bucket = _by_parts(lambda x: (x >> _HALF) * np.uint64(buckets) >> _HALF, h,
                           np.uint16 if buckets < 1 << 16 else np.int64)
        del h
        order = np.argsort(bucket, kind="stable")
        bucket, low, member = bucket[order], low[order], member[order]
        del order
        cut = np.flatnonzero(np.concatenate([[len(bucket) > 0], bucket[1:] != bucket[:-1]]))
        for a, b in zip(cut.tolist(), np.append(cut, len(bucket))[1:].tolist(), strict=True):
            out.append((int(bucket[a]), self.number, _GRAMS, low[a:b].tobytes() + _steps(member[a:b])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=_LOAD_NAMES)


def _by_parts(fn: Callable[[np.ndarray], np.ndarray], values: np.ndarray, dtype: type) -> np.ndarray:
    """fn(values), so many at a time that what it holds on the way stays small."""
    out = np.empty(len(values), dtype)
    for i in range(0, len(values), _PART):
        out[i:i + _PART] = fn(values[i:i + _PART])
    return out


def _steps(member: np.ndarray) -> bytes:
    return np.diff(member, prepend=np.uint16(0)).tobytes()  # ascending


def _loads(docs: DataFrame, spec: Spec, hot: np.ndarray, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        load = Load(number)
        for b in batches:
            for doc_id, key, s in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(),
                                      shingles(_texts(b.column("text")), spec), strict=True):
                load.add(doc_id, key, s)
                if load.full():
                    yield load.rows(hot, buckets)
                    number += 1 << 20
                    load = Load(number)
        if load.info:
            yield load.rows(hot, buckets)

    return docs.mapInArrow(run, _LOADS)


def _counted(loads: DataFrame) -> DataFrame:
    """Every bucket answers each load with its n-grams that occur twice or more:
    lower halves, classes by frequency, and members."""

    def run(rows: pa.Table) -> pa.Table:
        kind = rows.column("kind").to_numpy()
        numbers, data = rows.column("load").to_numpy(), rows.column("data")
        out = [(int(numbers[i]), 0, _SELF, data[i].as_py()) for i in np.flatnonzero(kind == _SELF).tolist()]
        loads, lows, steps = np.flatnonzero(kind == _GRAMS), [], []
        for i in loads.tolist():
            raw = data[i].as_py()
            n = len(raw) // 6
            lows.append(np.frombuffer(raw, np.uint32, n))
            steps.append(np.frombuffer(raw, np.uint16, n, 4 * n))
        low = np.concatenate([*lows, np.zeros(0, np.uint32)])
        order = np.argsort(low, kind="stable")
        ranked = low[order]
        first = np.flatnonzero(np.concatenate([[len(low) > 0], ranked[1:] != ranked[:-1]]))
        times = np.diff(np.append(first, len(low)))
        count = np.empty(len(low), np.int64)
        count[order] = np.repeat(times, times)
        grade = np.minimum(np.log2(count.clip(min=1)) * 8, 254).astype(np.uint8)
        bucket, at = int(rows.column("at")[0].as_py()), 0
        for i, some, step in zip(loads.tolist(), lows, steps, strict=True):
            twice = np.flatnonzero(count[at:at + len(some)] > 1)
            if len(twice):
                member = np.cumsum(step, dtype=np.uint16)[twice]
                out.append((int(numbers[i]), bucket, _GRAMS, b"".join(
                    [some[twice].tobytes(), grade[at:at + len(some)][twice].tobytes(), _steps(member)])))
            at += len(some)
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(
            columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=_LOAD_NAMES)

    return loads.groupBy("at").applyInArrow(run, _LOADS)


def _prefixes(answered: DataFrame, spec: Spec) -> DataFrame:
    """(sig, member, info). A member is a node as a load knows it, numbered so that
    shuffled rows compress well. Rows with ``info`` tell of a document: its id, key,
    number of n-grams, node and member. Within a load, members that share a
    signature are joined at once: one of them stands for all under every signature,
    and a signature of the load's own holds them together."""

    def run(rows: pa.Table) -> pa.Table:
        load = int(rows.column("at")[0].as_py())
        keys, members, info, size = [], [], [], np.zeros(0, np.int64)
        for bucket, kind, raw in zip(*(rows.column(c).to_pylist() for c in ("load", "kind", "data")), strict=True):
            if kind == _GRAMS:
                n = len(raw) // 7
                low = np.frombuffer(raw, np.uint32, n).astype(np.uint64)
                grade = np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.uint64)
                keys.append(grade << _CLASS | mix64(low | np.uint64(bucket) << _HALF) >> _REST)
                members.append(np.cumsum(np.frombuffer(raw[5 * n:], np.uint16), dtype=np.uint16))
                continue
            docs, nodes, hot = struct.unpack_from("<qqq", raw)
            width, at = struct.calcsize(_INFO), 24
            info = [raw[at + i * width:at + (i + 1) * width] for i in range(docs)]
            raw = raw[at + docs * width:]
            size = np.frombuffer(raw[:4 * nodes], np.uint32).astype(np.int64)
            keys.append(np.uint64(255) << _CLASS | mix64(np.frombuffer(raw[4 * nodes:4 * nodes + 8 * hot], np.uint64)) >> _REST)
            members.append(np.frombuffer(raw[4 * nodes + 8 * hot:], np.uint16))
        owner, sig = signatures(size, np.concatenate(members).astype(np.int64), np.concatenate(keys), spec)
        order = np.argsort(sig, kind="stable")
        sig, owner = sig[order], owner[order]
        same = sig[1:] == sig[:-1]
        union = Union(len(size))
        for x, y in set(zip(owner[:-1][same].tolist(), owner[1:][same].tolist(), strict=True)):
            union.join(x, y)
        root = union.roots()
        first = np.concatenate([[len(sig) > 0], ~same])[:len(sig)]
        own = np.flatnonzero(np.bincount(root, minlength=len(size))[root] > 1)
        sig = np.concatenate([sig[first], mix64((root[own] | load).astype(np.uint64))])
        who = np.concatenate([root[owner[first]], own]) | load
        told = [struct.unpack(_INFO, x) for x in info]
        return pa.Table.from_arrays(
            [pa.array([*(x[2] for x in told), *sig.view(np.int64).tolist()], pa.int64()),
             pa.array([*(x[5] | load if x[5] >= 0 else -1 for x in told), *who.tolist()], pa.int64()),
             pa.array([*info, *[None] * len(who)], pa.binary())], names=["sig", "member", "info"])

    return answered.groupBy("at").applyInArrow(run, _ROWS)


def _signed(docs: DataFrame, spec: Spec) -> DataFrame:
    """The documents and the signatures of their prefixes, see _prefixes."""
    chars, rows = docs.agg(F.sum(F.length("text")), F.count("*")).first()
    return _prefixes(_counted(_loads(docs, spec, frequent(docs, rows, spec), 1 + (chars or 0) // BUCKET)), spec)


def _stars(signed: DataFrame) -> DataFrame:
    """Edges (a, b) from the first member of every signature to its others, and
    the documents (b null; a is the member)."""
    names = ["a", "b", "doc_id", "key", "n", "node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            told = pa.compute.is_valid(b.column("info"))
            docs = [struct.unpack(_INFO, x) for x in b.column("info").filter(told).to_pylist()]
            if docs:
                yield pa.RecordBatch.from_arrays(
                    [b.column("member").filter(told), pa.nulls(len(docs), pa.int64()),
                     pa.array([x[1] if x[0] else None for x in docs], pa.int64()),
                     pa.array([x[2] for x in docs], pa.int64()), pa.array([x[3] for x in docs], pa.int64()),
                     pa.array([x[4] for x in docs], pa.int64())], names=names)
            rest = b.filter(pa.compute.invert(told))
            if rest.num_rows:
                got.append((rest.column(0).to_numpy(), rest.column(1).to_numpy()))
        if not got:
            return
        sig, node = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        low = np.repeat(node[first], np.diff(np.append(first, len(sig))))
        apart = low != node
        pairs = np.unique(np.stack([low[apart], node[apart]], 1), axis=0)
        none = pa.nulls(len(pairs), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none, none, none],
                                         names=names)

    return signed.repartition("sig").mapInArrow(run, "a long, b long, doc_id long, key long, n long, node long")


class Tree:
    """A signature tree over sets in the given order; level 0 are the sets."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        n = len(sets)
        words = np.zeros((n, bits // 64), np.uint64)
        for i, s in enumerate(sets):
            at = (s >> np.uint64(7)) & np.uint64(bits - 1)
            np.bitwise_or.at(words[i], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        size = np.array([len(s) for s in sets], np.int64)
        spare = size - np.bitwise_count(words).sum(1).astype(np.int64)
        self.levels = [(words, size, size, spare)]
        fan = LEAF
        while len(size) > 1:
            first = np.arange(0, len(size), fan)
            words = np.bitwise_or.reduceat(words, first, axis=0)
            low = np.minimum.reduceat(self.levels[-1][1], first)
            size = np.maximum.reduceat(size, first)
            spare = np.maximum.reduceat(spare, first)
            self.levels.append((words, low, size, spare))
        self.fan = fan


def _may_link(tree: Tree, level: int, a: np.ndarray, b: np.ndarray, spec: Spec) -> np.ndarray:
    """Can any sets under the tree nodes a and b link? Bound: bits in common and
    the most tokens that share a bit, against the least sizes."""
    words, low, high, spare = tree.levels[level]
    need = spec.percent * (low[a] + low[b])  # 100 c >= p (x + y - c)
    most = np.minimum(high[a], high[b])
    alive = np.flatnonzero((100 + spec.percent) * most >= need)
    out = np.zeros(len(a), bool)
    step = max(1, (1 << 22) // words.shape[1])
    for i in range(0, len(alive), step):
        k = alive[i:i + step]
        shared = np.bitwise_count(words[a[k]] & words[b[k]]).sum(1).astype(np.int64)
        shared = np.minimum(shared + np.minimum(spare[a[k]], spare[b[k]]), most[k])
        out[k] = (100 + spec.percent) * shared >= need[k]
    return out


def tree_links(sets: list[np.ndarray], spec: Spec, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the sets' components: (i, j), no more than join something
    new. ``label``: components known before; equal ones are not compared."""
    n = len(sets)
    if n < 2:
        return []
    order = np.array(sorted(range(n), key=lambda i: (sets[i][:1].tolist(), len(sets[i]))))
    ranked = [sets[i] for i in order]
    bits = 1 << max(9, int(max(map(len, ranked)) * 4 - 1).bit_length())
    tree = Tree(ranked, bits)
    union, out = Union(n), []
    if label is not None:
        first: dict[int, int] = {}
        for i, k in enumerate(label[order].tolist()):
            union.join(first.setdefault(k, i), i)

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        at, step = 0, 32
        while len(a):
            root = union.roots()
            open_ = root[a] != root[b]
            a, b = a[open_], b[open_]
            for x, y in zip(a[:step].tolist(), b[:step].tolist(), strict=True):
                if union.find(x) != union.find(y):
                    s, t = ranked[x], ranked[y]
                    common = len(s) + len(t) - len(np.unique(np.concatenate([s, t])))
                    if spec.linked(common, len(s), len(t)):
                        union.join(x, y)
                        out.append((int(order[x]), int(order[y])))
            a, b = a[step:], b[step:]
            at, step = at + step, min(step * 2, 4096)

    def one_component(level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        root = union.roots()
        width = tree.fan ** level
        first = np.arange(0, n, width)
        low, high = np.minimum.reduceat(root, first), np.maximum.reduceat(root, first)
        return (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])

    def visit(level: int, a: np.ndarray, b: np.ndarray) -> None:
        keep = _may_link(tree, level, a, b, spec) & ~one_component(level, a, b)
        a, b = a[keep], b[keep]
        if level == 0:
            compare(a, b)
            return
        below = len(tree.levels[level - 1][1])
        step = 4096  # pairs opened at a time bound the memory
        for i in range(0, len(a), step):
            x = (a[i:i + step, None, None] * tree.fan + np.arange(tree.fan)[None, :, None])
            y = (b[i:i + step, None, None] * tree.fan + np.arange(tree.fan)[None, None, :])
            x, y = (v.ravel() for v in np.broadcast_arrays(x, y))
            ok = (x < below) & (y < below) & ((x < y) if level == 1 else (x <= y))
            visit(level - 1, x[ok], y[ok])

    top = len(tree.levels) - 1
    visit(top, np.zeros(1, np.int64), np.zeros(1, np.int64))
    return out


def _joined(rows: DataFrame, keys: list[str], spec: Spec) -> DataFrame:
    """Links (a, b) inside each group of (node, grams, label)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node").sort_values("node")
        node = pdf["node"].to_numpy()
        sets = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
        links = tree_links(sets, spec, pdf["label"].to_numpy())
        return pd.DataFrame([(node[i], node[j]) for i, j in links], columns=["a", "b"], dtype="int64")

    return rows.groupBy(*keys).applyInPandas(run, "a long, b long")


def _grams(docs: DataFrame, spec: Spec) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.tobytes() for s in shingles(_texts(b.column("text")), spec)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("node", "family", "band", "block")), pa.array(sets, pa.binary())],
                names=["node", "family", "band", "block", "grams"])

    return docs.select("node", "family", "band", "block", "text").mapInArrow(
        run, "node long, family long, band int, block int, grams binary")


def links(docs: DataFrame, found: DataFrame, spec: Spec) -> DataFrame:
    """Links (a, b) between nodes that join all components; ``found``: see _stars."""
    members = components(found.where("b IS NOT NULL").select("a", "b")).select(
        F.col("node").alias("a"), F.col("root").alias("family"))
    full = found.where("b IS NULL AND n > 0").select("a", "key", "node", F.col("n").alias("size"))
    # a node's members share its signatures, so they are of one family
    family = staged(full.join(members, "a").groupBy("node").agg(F.min("family").alias("family"), F.min("key").alias("key"),
                                                                       F.max("size").alias("size")), "families")
    sizes = family.groupBy("family").agg(F.count("*").alias("n"))
    # families of one node have nothing to compare; small ones are one block
    band = F.when(F.col("n") > BLOCK, F.floor(F.log(F.col("size").cast("double")) / _STEP)).otherwise(F.lit(0)).cast("int")
    members = family.join(sizes.where("n > 1"), "family").withColumn("band", band)
    bands = members.groupBy("family", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    reps = staged(members.join(bands, ["family", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "representatives")

    def sets_of(some: DataFrame) -> DataFrame:
        texts = mostly(docs.select("key", "text"), some.select("key")).join(some, "key")
        return _grams(texts, spec)

    inside = staged(_joined(sets_of(reps).withColumn("label", F.col("node")), ["family", "band", "block"], spec), "links")
    large = reps.where("n > %d" % BLOCK)
    if large.isEmpty():
        return inside
    cut = staged(sets_of(large).select("node", "grams"), "family-sets")
    place = large.select("node", "family", "band", "block", "size")
    targets = place.groupBy("family", "band", "block").agg(F.min("size").alias("low"), F.max("size").alias("high"))

    def labelled(found: DataFrame) -> DataFrame:
        """The places with each node's component so far; sets join in at the end."""
        root = components(found)
        return staged(place.join(root, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"),
                      "places")

    # the largest components of the blocks meet first, one set of each, in rounds
    # of groups of at most some BLOCK sets
    fan = max(2, BLOCK // FIRST)
    units = targets.groupBy("family").agg(F.count("*").alias("units"))
    most, found = units.agg(F.max("units")).first()[0], inside
    unit = F.xxhash64("band", "block")
    while most > 1:
        now = labelled(found).join(units.where("units > 1"), "family").withColumn("unit", unit)
        largest = (now.groupBy("family", "units", "unit", "label").agg(F.count("*").alias("size"), F.min("node").alias("node"))
                   .groupBy("family", "units", "unit").agg(F.slice(F.sort_array(F.collect_list(
                       F.struct("size", "node", "label")), asc=False), 1, FIRST).alias("top"))
                   .select("family", "units", "unit", F.inline("top")).drop("size"))
        meet = largest.withColumn("unit", F.pmod("unit", F.ceil(F.col("units") / fan)))
        found = found.unionByName(staged(_joined(cut.join(meet, "node"), ["family", "unit"], spec), "links"))
        units = units.withColumn("units", F.ceil(F.col("units") / fan))
        unit = F.pmod(F.xxhash64("band", "block"), F.col("units"))
        most = -(-most // fan)
    # then what lies outside the family's largest component meets every block of
    # fitting sizes, block by block
    now = labelled(found)
    main = (now.groupBy("family", "label").agg(F.count("*").alias("size")).groupBy("family")
            .agg(F.max(F.struct("size", "label")).alias("m")).select("family", F.col("m.label").alias("main")))
    rest = now.join(main, "family").where("label <> main")
    many = rest.groupBy("family", F.col("band").alias("own")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rest = staged(rest.select("family", F.col("band").alias("own"), "node", "size", "label").join(many, ["family", "own"])
                  .withColumn("other", F.xxhash64("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))))
                  .drop("own", "blocks"), "rest")
    # linked sets differ in size by the threshold at most
    near = ((100 * F.col("low") <= F.col("size") * (10_000 / spec.percent)) &
            (100 * F.col("high") >= F.col("size") * spec.percent))
    sent = rest.join(targets, "family").where(near).select("node", "family", "band", "block", "other", "label")
    met = sent.select("family", "band", "block", "other").distinct()
    again = (now.select("node", "family", "band", "block", "label").join(met, ["family", "band", "block"])
             .select(*sent.columns).unionByName(sent).distinct())
    return found.unionByName(
        staged(_joined(cut.join(again, "node"), ["family", "band", "block", "other"], spec), "links"))


def cluster(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component), key,
    component.

    ``key`` is a hash of id and text; rows that differ in neither share it.
    ``component`` names the component; it is null where there is no set.
    """
    spec = Spec(words, percent)
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text").alias("key"))
    found = staged(_stars(_signed(docs, spec)), "signatures")
    root = components(links(docs, found, spec))
    nodes = found.where("b IS NULL").select("doc_id", "key", "n", "node")
    full = nodes.where("n > 0")
    least = (full.groupBy("node").agg(F.min("doc_id").alias("least")).join(root, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    own = least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    linked = full.join(own.select("node", "component_id", F.col("root").alias("component")), "node")
    alone = nodes.where("n = 0").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone, allowMissingColumns=True).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "key", "component")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns: of each component the one with the smallest
    id (then key), and all that have no set. A row given twice stays once."""
    found = staged(cluster(docs, words, percent).select("doc_id", "key", "component"), "components")
    first = found.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct("doc_id", "key")).alias("first")).select("first.key")
    own = free_name(docs, "_key")
    kept = first.unionByName(found.where("component IS NULL").select("key")).withColumnRenamed("key", own)
    return (docs.withColumn(own, F.xxhash64(F.col("doc_id").cast("long"), "text")).join(kept, own, "left_semi")
            .dropDuplicates([own]).drop(own))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: components of all documents under 4-word shingles and 85 per cent."""
    return cluster(table(spark, sf_dir, "documents"), 4, 85).drop("key", "component")
