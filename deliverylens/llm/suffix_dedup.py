"""Suffix-array dedup: a distributed difference-cover algorithm.

Removes every byte covered by a ``SPAN``-byte string that also starts in a
document with a smaller id. Strings are judged on the input texts, as UTF-8
bytes, and never cross documents.

0. A text that a smaller document has as a whole goes as a whole.
1. The others are dealt into chunks of bounded size by hash. In every chunk the
   *anchors* are found: ``GRAM``-byte strings that have the least hash in some
   ``SPAN``-byte window. Equal windows have equal anchors at equal places, so
   only anchors that stand in two documents matter. A chunk sends each anchor
   once, and gets back those that others hold as well.
2. An anchor's context is what the windows cover whose anchor it is. Contexts
   equal within a chunk are settled there: all windows repeat, and only those
   of the smallest document go on. The rest is dealt by anchor, so equal
   windows meet in one task.
3. There, contexts that are equal are settled again. Different contexts of an
   anchor can share a window only if they agree on half a window's bytes to one
   side of it; those that do are concatenated and their suffixes are sorted by difference
   cover: triples at two of three positions are sorted and named, the names are
   sorted recursively, the remaining suffixes are merged, and prefixes of
   ``SPAN`` bytes adjacent in that order are compared. Depth is bounded by SPAN.
   The windows of an anchor held by many chunks are compared by digest instead,
   as an aggregation, so no task gets all of them.
4. The runs of repeated window starts go back to the chunks, which cut them.

Edge cases: a null or empty text has no bytes and removes none; rows with equal
ids do not remove each other's bytes; a null id counts as larger than any
other; texts shorter than SPAN stay as they are; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import mix64, staged, table

SPAN = 50
GRAM = 20
#: A context: SPAN - GRAM bytes on either side of an anchor.
SIDE = SPAN - GRAM
WIDTH = 2 * SIDE + GRAM
#: Bytes of a chunk of documents, and of the texts hashed at a time.
CHUNK_BYTES = 12_000_000
BLOCK_BYTES = 200_000
#: Contexts whose suffixes are sorted at a time.
AT_ONCE = 8_000
#: An anchor in more chunks than this is hot.
MANY_CHUNKS = 512

_P = 0x9E3779B97F4A7C15
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64))
_FLAG = "chunk long, row int, start int, n int"
_NO_ID = (1 << 63) - 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_P, n, 1 << 64))


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of every ``width`` neighbours."""
    w = 1
    while 2 * w <= width:
        x = best(x[:-w], x[w:])
        w *= 2
    return best(x[:len(x) - (width - w)], x[width - w:]) if width > w else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash) of the anchors of concatenated texts that end at ``ends``,
    and the least hash of the window at each place (0: it would leave its text)."""
    if len(data) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = {1: _BYTES[data]}
    for n in (1, 2, 4, 8):
        h[2 * n] = h[n][:-n] * _power(n) + h[n][n:]
    m = len(data) - GRAM + 1
    x = h[16][:m] * _power(4) + h[4][16:16 + m]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    least = _slide(x, SIDE + 1, np.minimum)
    begins = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(data) + 1, np.int64)
    some = ends - begins >= SPAN
    np.add.at(inside, begins[some], 1)
    np.add.at(inside, ends[some] - SPAN + 1, -1)
    least[np.cumsum(inside[:len(least)]) == 0] = 0  # windows that would cross texts
    pad = np.zeros(SIDE, np.uint64)
    chosen = _slide(np.concatenate([pad, least, pad]), SIDE + 1, np.maximum) == x
    at = np.flatnonzero(chosen)
    return at, x[at], least


class _Chunk:
    """The rows of a chunk in a fixed order, and their anchors block by block.

    ``copies``: keys of rows whose texts are those of smaller documents; they
    have no anchors."""

    def __init__(self, rows: pa.Table, copies: np.ndarray):
        rows = rows.sort_by([("doc", "ascending"), ("key", "ascending")])
        self.copy = np.isin(rows["key"].to_numpy(), copies)
        self.doc = rows["doc"].to_numpy()
        self.id = rows["doc_id"]
        self.text = rows["text"].cast(pa.binary())
        self.size = np.array([len(t) for t in self.texts(0, len(self.doc))], np.int64)

    def texts(self, a: int, b: int) -> list[bytes]:
        return [t or b"" for t in self.text.slice(a, b - a).to_pylist()]

    def blocks(self):
        """(first row, the rows' ends in the data, data, and what anchors() says)."""
        total = np.cumsum(self.size)
        a = 0
        while a < len(total):
            done = total[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(total, done + BLOCK_BYTES, "right")))
            texts = [b"" if c else t for t, c in zip(self.texts(a, b), self.copy[a:b].tolist(), strict=True)]
            data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
            yield (a, ends, data, *anchors(data, ends))
            a = b


def _anchors_of(rows: pa.Table, copies: pa.Table) -> pa.Table:
    """(a, chunk, many): the chunk's anchors; many: they stand in several documents."""
    if not rows.num_rows:
        return pa.table({"a": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()),
                         "many": pa.array([], pa.bool_())})
    chunk, got, who = _Chunk(rows, copies["key"].to_numpy()), [], []
    for first, ends, _, at, a, _ in chunk.blocks():
        got.append(a)
        who.append(chunk.doc[first + np.searchsorted(ends, at, "right")])
    a, doc = np.concatenate([*got, np.zeros(0, np.uint64)]), np.concatenate([*who, np.zeros(0, np.int64)])
    order = np.argsort(a, kind="stable")  # rows come by doc
    a, doc = a[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(a)) - 1 if len(first) else first
    number = rows["chunk"][0].as_py()
    return pa.table({"a": a[first].view(np.int64), "chunk": np.full(len(first), number),
                     "many": doc[first] != doc[last]})


def _shared(batches):
    """(chunk, a, hot): the anchors of each chunk that stand in two documents."""
    got = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(3)] for b in batches if b.num_rows]
    if not got:
        return
    a, chunk, many = (np.concatenate(x) for x in zip(*got, strict=True))
    order = np.argsort(a, kind="stable")
    a, chunk, many = a[order], chunk[order], many[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    n = np.diff(np.append(first, len(a)))
    keep = np.repeat((n > 1) | np.logical_or.reduceat(many, first), n)
    hot = np.repeat(n > MANY_CHUNKS, n)
    yield pa.RecordBatch.from_arrays([pa.array(chunk[keep]), pa.array(a[keep]), pa.array(hot[keep])],
                                     names=["chunk", "a", "hot"])


def _runs(row: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Merge (row, start, n) runs of window starts that touch or overlap."""
    order = np.lexsort((start, row))
    row, start, n = row[order], start[order], n[order]
    if not len(row):
        return row, start, n
    base = row.astype(np.int64) << 32
    end = np.maximum.accumulate(base + start + n)
    new = np.concatenate([[True], (base + start)[1:] > end[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], start[first], (end[last] - base[first] - start[first]).astype(np.int64)


def _least_per_group(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group number, smallest doc of the group) of every row; groups: equal keys."""
    order = np.lexsort((doc, *keys[::-1]))
    new = np.zeros(len(doc), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    number = np.cumsum(new) - 1
    group, least = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
    group[order] = number
    least[order] = doc[order][np.flatnonzero(new)][number]
    return group, least


def _hash_rows(matrix: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of a byte matrix whose width divides by 8."""
    h = np.zeros(len(matrix), np.uint64)
    for col in np.ascontiguousarray(matrix).view(np.uint64).T:
        h = mix64(h * np.uint64(_P) + col)
    return h


_CONTEXT = ("a long, hot boolean, doc long, chunk long, row int, starts array<int>, n int, lead int, context binary")


def _contexts_of(rows: pa.Table, reply: pa.Table) -> pa.Table:
    """Contexts that go on (one row each, with all its places in a document),
    and settled runs (context is null). ``reply``: shared anchors and copies."""
    copies = reply.filter(pc.is_valid(reply["key"]))["key"].to_numpy()
    reply = reply.filter(pc.is_valid(reply["a"]))
    wanted = reply["a"].to_numpy()
    order = np.argsort(wanted)
    wanted, hot = wanted[order], reply["hot"].to_numpy()[order].astype(bool)
    if not rows.num_rows or not len(wanted):
        return pa.table({f.name: pa.array([], f.type) for f in _CONTEXT_ARROW}, schema=_CONTEXT_ARROW)
    chunk, parts = _Chunk(rows, copies), []
    for first, ends, data, at, a, least in chunk.blocks():
        k = np.minimum(np.searchsorted(wanted, a.view(np.int64)), len(wanted) - 1)
        hit = np.flatnonzero(wanted[k] == a.view(np.int64))
        # a window is its first least anchor's: those that start in begin .. begin + n - 1
        order = np.lexsort((at, a))
        before = np.full(len(at), -WIDTH)
        same = np.flatnonzero(a[order][1:] == a[order][:-1]) + 1
        before[order[same]] = at[order[same - 1]]
        at, own, before, k = at[hit], a[hit], before[hit], k[hit]
        place = at[:, None] + np.arange(-SIDE, 1)
        padded = np.concatenate([np.zeros(SIDE, np.uint64), least, np.zeros(SIDE + 1, np.uint64)])
        owned = (padded[np.minimum(place + SIDE, len(padded) - 1)] == own[:, None]) & (place > before[:, None])
        some = np.flatnonzero(owned.any(1))
        at, own, k, owned = at[some], own[some], k[some], owned[some]
        n = owned.sum(1)
        lo = at - SIDE + owned.argmax(1)
        local = np.searchsorted(ends, at, "right")
        wide = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
        matrix = wide[lo[:, None] + np.arange(WIDTH)]
        matrix[np.arange(WIDTH) >= (n + SPAN - 1)[:, None]] = 0
        begin = np.concatenate([[0], ends[:-1]])[local]
        parts.append((own.view(np.int64), hot[k], first + local, lo - begin, n + SPAN - 1, at - lo, matrix))
    a, hot, row, start, size, lead, matrix = (np.concatenate(x) for x in zip(*parts, strict=True))
    doc = chunk.doc[row]
    group, least = _least_per_group([a, _hash_rows(matrix), size, lead], doc)
    go = np.flatnonzero(doc == least)
    late = np.flatnonzero(doc > least)
    f_row, f_start, f_n = _runs(row[late], start[late], size[late] - SPAN + 1)
    number = rows["chunk"][0].as_py()
    go = go[np.lexsort((start[go], row[go], group[go]))]
    new = np.concatenate([[True], (group[go][1:] != group[go][:-1]) | (row[go][1:] != row[go][:-1])])[:len(go)]
    first = np.flatnonzero(new)
    one = go[first]
    n, m = len(f_row), len(one)
    starts = pa.ListArray.from_arrays(
        pa.array(np.concatenate([first, len(go) + np.arange(n + 1)]), pa.int32()),
        pa.array(np.concatenate([start[go], f_start]), pa.int32()))
    flat, off = matrix[one][np.arange(WIDTH) < size[one][:, None]], np.concatenate([[0], np.cumsum(size[one])])
    context = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(off.astype(np.int32).tobytes()),
                                                     pa.py_buffer(flat.tobytes())])
    away = mix64(f_row.astype(np.uint64) + np.uint64(number << 20)).view(np.int64)  # anywhere
    return pa.table([
        np.concatenate([a[one], away]), np.concatenate([hot[one], np.zeros(n, bool)]),
        np.concatenate([doc[one], np.zeros(n, np.int64)]), np.full(m + n, number),
        np.concatenate([row[one], f_row]).astype(np.int32), starts,
        np.concatenate([size[one] - SPAN + 1, f_n]).astype(np.int32),
        np.concatenate([lead[one], np.zeros(n, np.int64)]).astype(np.int32),
        pa.concat_arrays([context, pa.nulls(n, pa.binary())])], schema=_CONTEXT_ARROW)


_CONTEXT_ARROW = pa.schema([("a", pa.int64()), ("hot", pa.bool_()), ("doc", pa.int64()), ("chunk", pa.int64()),
                            ("row", pa.int32()), ("starts", pa.list_(pa.int32())), ("n", pa.int32()),
                            ("lead", pa.int32()), ("context", pa.binary())])


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Ranks (from 1) of rows of symbols, in lexicographic order; equal rows share one."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        top = int(c.max(initial=0)) + 1
        if int(key.max(initial=0)) >= (1 << 62) // top:
            key = np.unique(key, return_inverse=True)[1]
        key = key * top + c
    return np.unique(key, return_inverse=True)[1] + 1


def prefix_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the ``length``-symbol prefixes of all suffixes, by difference cover.

    Equal prefixes have equal ranks. Symbols are 1 and up; beyond the end stand
    zeros. Recursion is as deep as length needs: a name stands for three symbols.
    """
    n = len(text)
    t = np.concatenate([text.astype(np.int64), np.zeros(max(length, 3) + 3, np.int64)])
    if length <= 3 or n < 6:
        return _dense(*[t[k:k + n] for k in range(min(length, n + 3))])
    one, two, zero = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sampled = np.concatenate([one, two])
    # sort sampled triples; their names are the text of the next level
    name = _dense(t[sampled], t[sampled + 1], t[sampled + 2])
    deeper = np.concatenate([name[:len(one)], [0], name[len(one):]])
    ranks = prefix_ranks(deeper, -(-length // 3))
    r = np.zeros(len(t), np.int64)
    r[one], r[two] = ranks[:len(one)], ranks[len(one) + 1:]
    # the remaining suffixes: sorted by a symbol and a sampled rank, then merged
    big = int(r.max()) + 1
    alphabet = int(t.max()) + 1
    pair = t * big + np.concatenate([r[1:], [0]])  # (symbol, rank of the next suffix)
    a0 = pair[zero]
    order0 = zero[np.argsort(a0, kind="stable")]
    a0, a1 = pair[order0], np.sort(pair[one])
    if alphabet * alphabet * big < 1 << 62:
        triple = t[:-1] * (alphabet * big) + pair[1:]
    else:
        both = _dense(t[:-1], t[1:])
        triple = both * big + np.concatenate([r[2:], [0]])
    b0, b2 = triple[order0], np.sort(triple[two])
    place = np.empty(n, np.int64)
    place[order0] = np.searchsorted(a1, a0) + np.searchsorted(b2, b0) + np.arange(len(order0))
    s_order = sampled[np.argsort(r[sampled], kind="stable")]
    is_one = s_order % 3 == 1
    below = np.empty(len(s_order), np.int64)
    below[is_one] = np.searchsorted(a0, pair[s_order[is_one]], "right")
    below[~is_one] = np.searchsorted(np.maximum.accumulate(b0), triple[s_order[~is_one]], "right")
    place[s_order] = np.arange(len(s_order)) + below
    order = np.argsort(place, kind="stable")
    # compare adjacent prefixes
    new = np.ones(n, bool)
    for lo in range(0, n, 1 << 20):
        x, y = order[max(lo, 1) - 1:lo + (1 << 20) - 1], order[max(lo, 1):lo + (1 << 20)]
        differ = np.zeros(len(y), bool)
        same = np.arange(len(y))
        for k in range(length):
            d = t[x[same] + k] != t[y[same] + k]
            differ[same[d]] = True
            same = same[~d]
            if not len(same):
                break
        new[max(lo, 1):lo + (1 << 20)] = differ
    out = np.empty(n, np.int64)
    out[order] = np.cumsum(new)
    return out


_FLAG_ARROW = pa.schema([("chunk", pa.int64()), ("row", pa.int32()), ("start", pa.int32()), ("n", pa.int32())])
_WINDOW = _FLAG + ", doc long, window binary"
_WINDOW_ARROW = pa.schema([*_FLAG_ARROW, ("doc", pa.int64()), ("window", pa.binary())])


def _matrix(t: pa.Table) -> np.ndarray:
    """The contexts as rows of bytes, filled up with zeros."""
    size = t["n"].to_numpy().astype(np.int64) + SPAN - 1
    flat = np.frombuffer(b"".join(t["context"].to_pylist()) + bytes(WIDTH), np.uint8)
    matrix = flat[(np.cumsum(size) - size)[:, None] + np.arange(WIDTH)]
    matrix[np.arange(WIDTH) >= size[:, None]] = 0
    return matrix


def _may_share(a: np.ndarray, matrix: np.ndarray, size: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Which contexts agree with another of their anchor on half a window's
    bytes before or after it? Only these can have a window in common."""
    half, out = SIDE // 2, np.zeros(len(a), bool)
    after = np.concatenate([matrix, np.zeros((len(a), WIDTH), np.uint8)], 1)
    for has, first in ((lead >= half, lead - half), (size - lead - GRAM >= half, lead + GRAM)):
        rows = np.flatnonzero(has)
        part = np.zeros((len(rows), 16), np.uint8)
        part[:, :half] = after[rows[:, None], first[rows][:, None] + np.arange(half)]
        key = mix64(_hash_rows(part) ^ a[rows].view(np.uint64))
        _, inv, count = np.unique(key, return_inverse=True, return_counts=True)
        out[rows[count[inv] > 1]] = True
    return out


def _repeats(matrix: np.ndarray, n: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which windows of the contexts are also in one with a smaller document?"""
    size = n + SPAN - 1
    inside = np.arange(WIDTH + 1) <= size[:, None]  # and a zero that ends each context
    text = np.zeros(inside.shape, np.int64)
    text[:, :WIDTH] = matrix.astype(np.int64) + 1
    text[np.arange(WIDTH + 1) == size[:, None]] = 0
    rank = prefix_ranks(text[inside], SPAN)
    first = np.cumsum(size + 1) - size - 1
    valid = np.arange(SIDE + 1) < n[:, None]
    r = rank[(first[:, None] + np.arange(SIDE + 1))[valid]]
    owner = np.broadcast_to(least[:, None], valid.shape)[valid]
    _, smallest = _least_per_group([r], owner)
    out = np.zeros(valid.shape, bool)
    out[valid] = owner > smallest
    return out


def _places(t: pa.Table, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of t, start): every place of the given rows of t."""
    starts = t["starts"].combine_chunks()
    count = pc.list_value_length(starts).to_numpy().astype(np.int64)
    first = np.cumsum(count) - count
    who = np.repeat(some, count[some])
    at = np.arange(len(who)) - np.repeat(np.cumsum(count[some]) - count[some], count[some]) + first[who]
    return who, starts.flatten().to_numpy()[at].astype(np.int64)


def _settle(batches):
    """Runs of window starts that repeat, but for those of hot anchors."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    null = pc.is_null(t["context"])
    done = t.filter(null)
    t = t.filter(pc.invert(pc.or_(null, t["hot"])))
    runs = [[done["chunk"].to_numpy(), done["row"].to_numpy(), _places(done, np.arange(done.num_rows))[1],
             done["n"].to_numpy()]]
    if t.num_rows:
        a, doc, chunk, row, n, lead = (t[c].to_numpy() for c in ("a", "doc", "chunk", "row", "n", "lead"))
        matrix = _matrix(t)
        group, least = _least_per_group([a, _hash_rows(matrix), n, lead], doc)
        late = doc > least
        i, start = _places(t, np.flatnonzero(late))
        runs.append([chunk[i], row[i], start, n[i]])
        # one row of each context; those that can share a window with another
        _, pick = np.unique(group, return_index=True)
        pick = pick[_may_share(a[pick], matrix[pick], n[pick] + SPAN - 1, lead[pick])]
        pick = pick[np.argsort(a[pick], kind="stable")]
        slot = np.full(int(group.max()) + 1, -1)
        slot[group[pick]] = np.arange(len(pick))
        repeats = np.zeros((len(pick), SIDE + 1), bool)
        cuts = np.flatnonzero(np.concatenate([[True], a[pick][1:] != a[pick][:-1]])) if len(pick) else np.zeros(0, int)
        at = 0
        while at < len(pick):  # whole anchors, about AT_ONCE contexts
            later = cuts[cuts >= at + AT_ONCE]
            end = int(later[0]) if len(later) else len(pick)
            some = pick[at:end]
            repeats[at:end] = _repeats(matrix[some], n[some].astype(np.int64), least[some])
            at = end
        # the members of such a context's smallest document repeat, too
        i, start = _places(t, np.flatnonzero(~late & (slot[group] >= 0)))
        x, j = np.nonzero(repeats[slot[group[i]]])
        runs.append([chunk[i[x]], row[i[x]], start[x] + j, np.ones(len(x), np.int64)])
    chunk, row, start, n = (np.concatenate(x) for x in zip(*runs, strict=True))
    if len(chunk):
        # merge within (chunk, row)
        names, number = np.unique(np.stack([chunk, row], 1), axis=0, return_inverse=True)
        number, start, n = _runs(number.ravel(), start, n)
        yield from pa.table([names[number, 0], names[number, 1].astype(np.int32), start.astype(np.int32),
                             n.astype(np.int32)], schema=_FLAG_ARROW).to_batches(50_000)


def _open_windows(batches):
    """The windows of hot anchors' contexts, by digest."""
    for b in batches:
        t = pa.Table.from_batches([b]).filter(pc.and_(b.column("hot"), pc.is_valid(b.column("context"))))
        if not t.num_rows:
            continue
        who, start = _places(t, np.arange(t.num_rows))
        n = t["n"].to_numpy()[who]
        start, i = np.repeat(start, n), np.repeat(who, n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        texts = t["context"].to_pylist()
        digest = [hashlib.blake2b(texts[x][y:y + SPAN], digest_size=16).digest()
                  for x, y in zip(i.tolist(), j.tolist(), strict=True)]
        chunk, row, doc = (t[c].to_numpy()[i] for c in ("chunk", "row", "doc"))
        yield from pa.table([chunk, row, (start + j).astype(np.int32), np.ones(len(i), np.int32), doc,
                             pa.array(digest, pa.binary())], schema=_WINDOW_ARROW).to_batches(20_000)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(rows: pa.Table, flags: pa.Table, with_bytes: bool) -> pa.Table:
    chunk = _Chunk(rows, flags.filter(pc.is_valid(flags["key"]))["key"].to_numpy()) if rows.num_rows else None
    flags = flags.filter(pc.is_null(flags["key"]))
    out: list[tuple] = []
    row, start, n = (flags[c].to_numpy().astype(np.int64) for c in ("row", "start", "n"))
    row, start, n = _runs(row, start, n + SPAN - 1)  # the covered bytes
    first = np.searchsorted(row, np.arange(rows.num_rows + 1))
    for i in range(rows.num_rows):
        text = chunk.texts(i, i + 1)[0]
        kept, at, removed = [], 0, 0
        spans = list(zip(start[first[i]:first[i + 1]].tolist(), n[first[i]:first[i + 1]].tolist(), strict=True))
        if chunk.copy[i] and len(text) >= SPAN:
            spans = [(0, len(text))]
        for s, k in spans:
            kept.append(text[at:s])
            at, removed = s + k, removed + k
        rest = b"".join([*kept, text[at:]])
        out.append((chunk.id[i].as_py(), len(text), removed, len(spans),
                    hashlib.sha256(rest).hexdigest(), rest if with_bytes else None))
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    cols = list(zip(*out, strict=True)) or [[]] * 6
    return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept
    (the remaining bytes, which need not be valid UTF-8)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = int(total // CHUNK_BYTES) + 1
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(F.pmod(key, F.lit(chunks)).alias("chunk"), key.alias("key"), "doc_id",
                       F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), "text")
    by_chunk = rows.groupBy("chunk")
    texts = staged(rows.select("chunk", "key", "doc", F.md5(F.col("text").cast("binary")).alias("sum")), "texts")
    own = texts.groupBy("sum").agg(F.min("doc").alias("least"), F.count("*").alias("n")).where("n > 1")
    copies = texts.join(own, "sum").where("doc > least").select("chunk", "key")
    found = by_chunk.cogroup(copies.groupBy("chunk")).applyInArrow(_anchors_of, "a long, chunk long, many boolean")
    reply = found.repartition("a").mapInArrow(_shared, "chunk long, a long, hot boolean")
    reply = reply.unionByName(copies, allowMissingColumns=True)
    contexts = by_chunk.cogroup(reply.groupBy("chunk")).applyInArrow(_contexts_of, _CONTEXT)
    # one plan: the shuffled chunks and contexts are used again, not made again;
    # a hot anchor's contexts are spread by chunk
    dealt = contexts.repartition(F.xxhash64("a", F.when(F.col("hot"), F.col("chunk"))))
    windows = dealt.mapInArrow(_open_windows, _WINDOW)
    least = windows.groupBy("window").agg(F.min("doc").alias("least"))
    late = windows.join(least, "window").where("doc > least").select("chunk", "row", "start", "n")
    flags = dealt.mapInArrow(_settle, _FLAG).unionByName(late).unionByName(copies, allowMissingColumns=True)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        return _cut(left, right, with_bytes)

    return by_chunk.cogroup(flags.groupBy("chunk")).applyInArrow(cut, _RESULT)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document without the bytes that repeat smaller ids' strings."""
    return remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False).drop("kept")
