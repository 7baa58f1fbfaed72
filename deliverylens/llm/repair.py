"""Repair of conversation structure by a rank-convergence parallel Viterbi.

A conversation is right if its roles' initials read ``(s?(ua)+)?``. Its rows may
be kept, given another role or deleted, and empty turns inserted, at the costs
below. States: 0 nothing yet, 1 after a system turn, 2 after a user's, 3 after an
assistant's. A vector of four numbers says what the rest of the conversation
costs from each state; only its differences matter, so vectors are kept less
their least entry, and "differ by a constant" is equality.

A conversation is cut into chunks of rows. Every chunk starts from its end with a
vector: the right one if it is the last, else a speculative one (zeros). In a
fix-up pass, chunks whose follower now begins with another vector run again from
that one, backwards, only until they meet their old vectors; passes go on until
no chunk's end changes. The settled vectors give every row's cheapest edits from
any state, so a forward trace takes the ASCII-least edit at each step; since
letter and state name the next state, the audit is the least of the cheapest.

The same kernel runs in two places. Conversations that one task holds whole are
cut into chunks of ``CHUNK`` rows, all of a batch swept together. Those at the
edges of a task's range, and very long ones, are cut into chunks of
``WIDE_CHUNK`` rows in a Spark table: fix-up passes are jobs over the chunks that
changed, each chunk is traced from all four states at once, and a scan of one
small row a chunk picks the state it is entered in. Rows that must all be
deleted never converge; after ``PASSES`` passes, what is left unsettled takes
each chunk's exact map from four unit vectors and one scan.

Edge cases: nulls of role and text are one blank, as in the damage; a null
conv_id is a conversation; null turns come first; rows of equal turn go by the
MD5 of role and text; a conversation without rows has zeros, an empty audit and
the empty string's hash; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm import turns
from deliverylens.llm.common import SPACES, staged, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows in a chunk, in a task and across tasks (a power of two); passes before the exact maps.
CHUNK = 64
WIDE_CHUNK = 1 << 12
PASSES = 4
#: Characters and rows of whole conversations that are repaired together.
_AT_ONCE = 1 << 22
_ROWS_AT_ONCE = 1 << 15

#: A row's code: the class of its role's initial and four times its fault.
CLASSES = {"s": 0, "u": 1, "a": 2}
OTHER = 3
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
LEGAL = {(0, 1), (1, 2), (2, 1)}

_FAR = 1 << 20
#: What an inserted or reroled turn leads to, and its role.
_TURN = [2, 2, 3, 2]
_ROLE = ["user", "user", "assistant", "user"]
_KEPT = [[1, None, None, None], [2, 2, None, 2], [None, None, 3, None], [None] * 4]
#: The symbol that changes no vector: it fills short chunks.
_FILL = 16


def _closure() -> np.ndarray:
    cost = np.full((4, 4), _FAR, np.int64)
    cost[np.arange(4), np.arange(4)] = 0
    cost[np.arange(4), _TURN] = INSERT
    for k in range(4):
        cost = np.minimum(cost, cost[:, k:k + 1] + cost[k])
    return cost


def _moves() -> np.ndarray:
    """[code, state before, state after]: the least cost of a row, insertions before it included."""
    out = np.full((_FILL + 1, 4, 4), _FAR, np.int64)
    for code in range(_FILL):
        role, fault = code % 4, code // 4
        out[code, np.arange(4), np.arange(4)] = DELETE
        if fault in (SOUND, CUT_OFF):
            more = TRUNCATED * (fault == CUT_OFF)
            for state in range(4):
                after = _TURN[state]
                out[code, state, after] = min(out[code, state, after], REROLE + more)
                if _KEPT[role][state] is not None:
                    out[code, state, _KEPT[role][state]] = KEEP + more
    with_inserts = (_closure()[None, :, :, None] + out[:, None, :, :]).min(2)
    with_inserts[_FILL] = np.where(np.eye(4, dtype=bool), 0, _FAR)
    return with_inserts


MOVES = _moves()
#: The vector at a conversation's end: it may end in states 0 and 3.
END = np.minimum(_closure()[:, 0], _closure()[:, 3])


def _step(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The vectors before rows of these codes, given those after them, less their least."""
    before = (MOVES[codes] + after[:, None, :]).min(2)
    return before - before.min(1, keepdims=True)


def sweep(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """[chunk, row, state]: the vectors before each row of chunks (a row each,
    filled up with ``_FILL``) and, last, at their ends."""
    n, length = codes.shape
    out = np.empty((n, length + 1, 4), np.int64)
    out[:, length] = ends
    for i in range(length - 1, -1, -1):
        out[:, i] = _step(codes[:, i], out[:, i + 1])
    return out


def fix_up(codes: np.ndarray, vectors: np.ndarray, which: np.ndarray, ends: np.ndarray) -> None:
    """Run the chunks ``which`` again from ``ends``, until they meet their old vectors."""
    length = codes.shape[1]
    vectors[which, length] = ends
    for i in range(length - 1, -1, -1):
        before = _step(codes[which, i], vectors[which, i + 1])
        new = (before != vectors[which, i]).any(1)
        which, before = which[new], before[new]
        if not len(which):
            return
        vectors[which, i] = before


def settle(codes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The right vectors of chunks that follow each other, up to constants;
    ``last`` says which end a conversation."""
    vectors = sweep(codes, np.where(last[:, None], END, 0))
    inner = np.flatnonzero(~last)
    while True:
        wrong = inner[(vectors[inner + 1, 0] != vectors[inner, -1]).any(1)]
        if not len(wrong):
            return vectors
        fix_up(codes, vectors, wrong, vectors[wrong + 1, 0].copy())


@lru_cache(maxsize=1 << 16)
def _edits(code: int, after: tuple[int, ...]) -> list[tuple[str, list[str], str | None, int, int]]:
    """For each state: (letters, roles inserted before the row, the row's role:
    '' as it is, None deleted, state after it, cost)."""
    after_ = np.array(after)
    best = (MOVES[code] + after_).min(1)
    role, fault = code % 4, code // 4
    more = TRUNCATED * (fault == CUT_OFF)
    out = []
    for state in range(4):
        letters, inserted, cost = "", [], 0
        while True:
            turn, kept = _TURN[state], _KEPT[role][state]
            if DELETE + after[state] == best[state]:
                out.append((letters + "D", inserted, None, state, cost + DELETE))
                break
            if INSERT + best[turn] == best[state]:
                letters, cost = letters + "I", cost + INSERT
                inserted.append(_ROLE[state])
                state = turn
                continue
            if kept is not None and fault in (SOUND, CUT_OFF) and KEEP + more + after[kept] == best[state]:
                out.append((letters + "K", inserted, "", kept, cost + KEEP + more))
            else:
                out.append((letters + "R", inserted, _ROLE[state], turn, cost + REROLE + more))
            break
    return out


def trace(codes: np.ndarray, vectors: np.ndarray, state: int) -> tuple[str, int, list[tuple[list[str], str | None]], int]:
    """(audit, cost, (roles inserted before, the row's role) of each row, state
    at the end) of a chunk entered in ``state``."""
    letters, cost, rows = [], 0, []
    for code, after in zip(codes.tolist(), map(tuple, vectors[1:].tolist()), strict=False):
        said, inserted, role, state, more = _edits(code, after)[state]
        letters.append(said)
        rows.append((inserted, role))
        cost += more
    return "".join(letters), cost, rows, state


def finish(state: int) -> list[str]:
    """Roles inserted at a conversation's end."""
    out = []
    while state not in (0, 3):
        out.append(_ROLE[state])
        state = _TURN[state]
    return out


def code_of(role: str, text: str, seen: set[tuple[str, str]]) -> int:
    """A row's code; ``seen`` holds the rows before it and takes this one."""
    bare = text.rstrip(SPACES)
    if not bare:
        fault = BLANK
    elif (role, text) in seen:
        fault = DUPLICATE
    else:
        seen.add((role, text))
        fault = SOUND if bare[-1] in ".!?" else CUT_OFF
    return CLASSES.get(role[:1], OTHER) + 4 * fault


def _chunked(conversations: list[np.ndarray], size: int) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Their chunks as one array, by groups of like length: (conversation and
    length of each chunk, codes, which are last)."""
    order = sorted(range(len(conversations)), key=lambda i: len(conversations[i]))
    group, area = [], 0
    for k, i in enumerate(order):
        group.append(i)
        area += len(conversations[i])
        if k + 1 == len(order) or area >= _ROWS_AT_ONCE:
            width = min(size, max(len(conversations[j]) for j in group))
            names, rows, last = [], [], []
            for j in group:
                codes = conversations[j]
                for lo in range(0, len(codes), width):
                    row = np.full(width, _FILL, np.int64)
                    part = codes[lo:lo + width]
                    row[:len(part)] = part
                    names.append((j, len(part)))
                    rows.append(row)
                    last.append(lo + width >= len(codes))
            if rows:
                yield names, np.array(rows), np.array(last)
            group, area = [], 0


def repair(conversations: list[list[tuple[int | None, str, str]]]) -> list[tuple]:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)
    of conversations given as their (turn, role, text) rows in order."""
    codes = []
    for rows in conversations:
        seen: set[tuple[str, str]] = set()
        codes.append(np.array([code_of(role, text, seen) for _, role, text in rows], np.int64))
    audits = [""] * len(codes)
    costs, states = [0] * len(codes), [0] * len(codes)
    edits: list[list] = [[] for _ in codes]
    for names, chunks, last in _chunked(codes, CHUNK):
        vectors = settle(chunks, last)
        for k, (j, n) in enumerate(names):
            letters, cost, rows, states[j] = trace(chunks[k, :n], vectors[k], states[j])
            audits[j] += letters
            costs[j] += cost
            edits[j] += rows
    out = []
    for rows, code, audit, cost, edit, state in zip(conversations, codes, audits, costs, edits, states, strict=True):
        more = finish(state)
        said = []
        for (_, role, text), (inserted, new) in zip(rows, edit, strict=True):
            said += [f"{r}:" for r in inserted]
            if new is not None:
                said.append(f"{new or role}:{text}")
        said += [f"{r}:" for r in more]
        given = [t for t, _, _ in rows if t is not None]
        gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
        faults = np.bincount(code // 4, minlength=4).tolist()
        role = (code % 4).tolist()
        illegal = sum(p not in LEGAL for p in zip(role, role[1:], strict=False))
        digest = hashlib.sha256("\n".join(said).encode("utf-8", "surrogatepass")).hexdigest()
        out.append((gaps, *faults[1:], illegal, cost + INSERT * len(more), audit + "I" * len(more), digest))
    return out


_RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_ROW = "turn long, role string, text string, dropped boolean, pos long"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
          "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(columns, kinds, strict=True)],
                                      names=list(names))


def _in_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of whole conversations; the rows of others as they are, with their place."""
    schema, part, place = f"{_RESULT}, {_ROW}", TaskContext.get().partitionId() << 40, 0
    held, size, rows = [], 0, []
    for conv_id, run, whole in turns.runs(batches):
        if whole:
            held.append((conv_id, [r[1:4] for r in run if not r[4]]))
            size += sum(len(r[3]) + 64 for r in run)
        else:
            rows += [(conv_id, *[None] * 8, *r[1:], part + place + i) for i, r in enumerate(run)]
            size += sum(len(r[3]) + 64 for r in run)
            place += len(run)
        if size >= _AT_ONCE:
            rows += [(c, *r, *[None] * 5) for (c, _), r in zip(held, repair([h[1] for h in held]), strict=True)]
            yield _batch(rows, schema)
            held, size, rows = [], 0, []
    rows += [(c, *r, *[None] * 5) for (c, _), r in zip(held, repair([h[1] for h in held]), strict=True)]
    yield _batch(rows, schema)


def _coded(rows: DataFrame) -> DataFrame:
    """The rows of conversations in parts, each with its code.

    A row is a duplicate unless it is the first of its role and text: the least
    place of each (conversation, digest) is found by aggregation, and rows look
    up their own place among these.
    """
    bare = F.expr("trim(TRAILING ' \\t\\n\\r\\u000b\\u000c' FROM text)")
    live = rows.where(~F.col("dropped")).withColumn("_bare", bare)
    first = (live.where(F.col("_bare") != "")
             .groupBy("conv_id", F.sha2(F.concat("role", F.lit("\0"), "text"), 256).alias("said"))
             .agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("_first")))
    initial = F.substring("role", 1, 1)
    role: Column = F.lit(OTHER)
    for letter, k in CLASSES.items():
        role = F.when(initial == letter, k).otherwise(role)
    fault = (F.when(F.col("_bare") == "", BLANK).when(F.col("_first").isNull(), DUPLICATE)
             .when(F.substring(F.col("_bare"), -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT_OFF))
    return live.join(first, "pos", "left").select(
        "conv_id", "turn", "role", "text", "pos", (role + 4 * fault).cast("int").alias("code"))


def _vectors_of(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return np.frombuffer(batch.column("vectors")[i].as_py(), np.int8).reshape(-1, 4).astype(np.int64)


def _codes_of(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return batch.column("codes")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)


_CHUNK = "conv_id long, cut long, codes array<int>, places array<long>, last boolean"


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for i, last in enumerate(batch.column("last").to_pylist()):
            ends = (END if last else np.zeros(4, np.int64))[None]
            found.append(sweep(_codes_of(batch, i)[None], ends)[0].astype(np.int8).tobytes())
        yield batch.append_column("vectors", pa.array(found, pa.binary()))


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fix-up: chunks with a new end (``next``) run again."""
    for batch in batches:
        found = []
        for i, new in enumerate(batch.column("next").to_pylist()):
            vectors = _vectors_of(batch, i)
            if new is not None:
                fix_up(_codes_of(batch, i)[None], vectors[None], np.array([0]),
                       np.frombuffer(new, np.int8).astype(np.int64)[None])
            found.append(vectors.astype(np.int8).tobytes())
        kept = batch.select(["conv_id", "cut", "codes", "places", "last"])
        yield kept.append_column("vectors", pa.array(found, pa.binary()))


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, cut, last, map): 16 numbers, the cost from each state before a
    chunk to each after it."""
    unit = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for batch in batches:
        rows = []
        for conv, cut, last, i in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "cut", "last")),
                                      range(batch.num_rows), strict=True):
            ends = unit
            for code in _codes_of(batch, i)[::-1]:
                ends = (MOVES[code][None] + ends[:, None, :]).min(2)
            rows.append((conv, cut, last, ends.T.reshape(-1).tolist()))
        yield _batch(rows, "conv_id long, cut long, last boolean, map array<long>")


def _ends_by_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The end vector of each chunk; a conversation's chunks come last first."""
    start = None
    for batch in batches:
        rows = []
        for conv, cut, last, cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            end = END if last else start - start.min()
            rows.append((conv, cut, end.astype(np.int8).tobytes()))
            start = (np.array(cells).reshape(4, 4) + end).min(1)
        yield _batch(rows, "conv_id long, cut long, next binary")


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each chunk leads from each state, and what its edges are."""
    for batch in batches:
        rows = []
        for i, (conv, cut, last) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "cut", "last")),
                                                  strict=True)):
            codes, vectors = _codes_of(batch, i), _vectors_of(batch, i)
            role = (codes % 4).tolist()
            illegal = sum(p not in LEGAL for p in zip(role, role[1:], strict=False))
            rows.append((conv, cut, last, [trace(codes, vectors, s)[3] for s in range(4)], role[0], role[-1], illegal))
        yield _batch(rows, _EXITS)


_EXITS = "conv_id long, cut long, last boolean, exits array<int>, first_role int, last_role int, illegal long"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each chunk is entered; a conversation's chunks come in order."""
    state, before = 0, None
    for batch in batches:
        rows = []
        for conv, cut, last, exits, first, end, illegal in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            illegal += before is not None and (before, first) not in LEGAL
            rows.append((conv, cut, state, illegal))
            state, before = (0, None) if last else (exits[state], end)
        yield _batch(rows, "conv_id long, cut long, entry int, illegal long")


_EDITED = "conv_id long, cut long, audit string, cost long, illegal long, pos array<long>, nth array<int>, said array<string>"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and cost of each chunk, and its turns: those of a row's place, in
    order; the row itself has ``nth`` 9 and '' for a role that stays."""
    for batch in batches:
        out = []
        heads = (batch.column(c).to_pylist() for c in ("conv_id", "cut", "last", "entry", "illegal", "places"))
        for i, (conv, cut, last, entry, illegal, places) in enumerate(zip(*heads, strict=True)):
            audit, cost, rows, state = trace(_codes_of(batch, i), _vectors_of(batch, i), entry)
            turn = [(p, k, r) for p, (inserted, _) in zip(places, rows, strict=True) for k, r in enumerate(inserted)]
            turn += [(p, 9, role) for p, (_, role) in zip(places, rows, strict=True) if role is not None]
            more = finish(state) if last else []
            turn += [(places[-1], 10 + k, r) for k, r in enumerate(more)]
            at, nth, said = zip(*turn, strict=True) if turn else ((), (), ())
            out.append((conv, cut, audit + "I" * len(more), cost + INSERT * len(more), illegal, at, nth, said))
        yield _batch(out, _EDITED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's turns, which come in order."""
    current, digest = None, None
    for batch in batches:
        done = []
        for conv, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if digest is None or conv != current:
                if digest:
                    done.append((current, digest.hexdigest()))
                current, digest = conv, hashlib.sha256()
                between = b""
            digest.update(between + line.encode("utf-8", "surrogatepass"))
            between = b"\n"
        yield _batch(done, "conv_id long, repaired_sha256 string")
    if digest:
        yield _batch([(current, digest.hexdigest())], "conv_id long, repaired_sha256 string")


def _same_chunk(a: str, b: str) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.cut") == F.col(f"{b}.cut"))


def _settled(chunks: DataFrame) -> DataFrame:
    """The chunks with their right vectors: speculation, then fix-up passes."""
    from pyspark.sql import Window

    held = staged(chunks.mapInArrow(_speculate, _CHUNK + ", vectors binary"), "vectors")
    order = Window.partitionBy("conv_id").orderBy("cut")
    kept = [F.col(f"c.{c}") for c in held.columns]
    for turn in range(PASSES + 1):
        edge = held.select("conv_id", "cut", F.substring("vectors", 1, 4).alias("start"),
                           F.substring("vectors", -4, 4).alias("end"))  # eight bytes a chunk
        wrong = (edge.withColumn("next", F.lead("start").over(order)).where(F.col("next") != F.col("end"))
                 .select("conv_id", "cut", "next"))
        if turn == PASSES:
            if wrong.isEmpty():
                return held
            by_end = [F.asc_nulls_first("conv_id"), F.desc("cut")]
            wrong = (held.select(*_CHUNK_NAMES).mapInArrow(_maps, "conv_id long, cut long, last boolean, map array<long>")
                     .repartition("conv_id").sortWithinPartitions(*by_end)
                     .mapInArrow(_ends_by_maps, "conv_id long, cut long, next binary"))
        else:
            wrong = staged(wrong, "wrong-ends")
            if wrong.isEmpty():
                return held
        held = staged(held.alias("c").join(wrong.alias("w"), _same_chunk("c", "w"), "left").select(*kept, "w.next")
                      .mapInArrow(_again, _CHUNK + ", vectors binary"), "vectors")
    return held


_CHUNK_NAMES = [c.split()[0] for c in _CHUNK.split(", ")]


def _across_tasks(rows: DataFrame) -> DataFrame:
    """The results of conversations whose rows are spread over tasks."""
    from pyspark.sql import Window

    coded = staged(_coded(rows), "coded")
    cut = F.shiftright("pos", WIDE_CHUNK.bit_length() - 1).alias("cut")
    in_order = F.array_sort(F.collect_list(F.struct("pos", "code")))  # at most WIDE_CHUNK
    chunks = coded.groupBy("conv_id", cut).agg(in_order.alias("c")).select(
        "conv_id", "cut", F.col("c.code").alias("codes"), F.col("c.pos").alias("places"),
        F.lead("cut").over(Window.partitionBy("conv_id").orderBy("cut")).isNull().alias("last"))
    held = _settled(staged(chunks, "chunks"))
    forward = [F.asc_nulls_first("conv_id"), "cut"]
    entries = (held.mapInArrow(_exits, _EXITS).repartition("conv_id").sortWithinPartitions(*forward)
               .mapInArrow(_entries, "conv_id long, cut long, entry int, illegal long"))
    edited = staged(held.alias("c").join(entries.alias("e"), _same_chunk("c", "e"))
                    .select(*(F.col(f"c.{c}") for c in held.columns), "e.entry", "e.illegal")
                    .mapInArrow(_edited, _EDITED), "edited")

    said = edited.select(F.explode(F.arrays_zip("pos", "nth", "said")).alias("t")).select("t.*")
    line = F.when(F.col("nth") == 9, F.concat(F.when(F.col("said") == "", F.col("role")).otherwise(F.col("said")),
                                              F.lit(":"), F.col("text"))).otherwise(F.concat("said", F.lit(":")))
    lines = coded.select("conv_id", "pos", "role", "text").join(said, "pos").select("conv_id", "pos", "nth", line.alias("line"))
    digests = (lines.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "pos", "nth")
               .select("conv_id", "line").mapInArrow(_digests, "conv_id long, repaired_sha256 string"))

    fault = F.floor(F.col("code") / 4)
    counted = coded.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1).alias("wide"),
        *(F.sum((fault == k).cast("long")).alias(n)
          for k, n in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT_OFF, "truncated"))))
    turns_given = coded.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.count("turn").alias("given"))
    audits = edited.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cut", "audit"))), lambda c: c["audit"]), "")
        .alias("audit"), F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    parts = rows.select("conv_id").distinct()
    for more in (counted, turns_given, audits, digests):
        parts = parts.unionByName(more, allowMissingColumns=True)
    number = [F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return parts.groupBy("conv_id").agg(
        F.coalesce(F.max("wide") - F.max("given"), F.lit(0)).cast("long").alias("gaps"), *number,
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256")).select(*_NAMES)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults, cheapest repair and its audit of every conversation of ``rows``
    (conv_id, turn, role, text, and ``dropped``: not there, but its conversation is)."""
    plain = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), "dropped")
    mixed = staged(turns.in_order(plain).mapInArrow(_in_tasks, f"{_RESULT}, {_ROW}"), "repair")
    done = mixed.where(F.col("pos").isNull()).select(*_NAMES)
    return done.unionByName(_across_tasks(mixed.where(F.col("pos").isNotNull()).select(
        "conv_id", *(c.split()[0] for c in _ROW.split(", ")))))


def damage(rows: DataFrame) -> DataFrame:
    """The rows as the query damages them, by the CRC32 of their ids; those it
    drops stay, with ``dropped`` and without their text."""
    def blank(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = (F.when(F.col("_kind").isin(0, 1), "").when(F.col("_kind") == 2, F.translate(blank("text"), ".!?", ""))
            .otherwise(blank("text")))
    return rows.withColumn("_kind", kind).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(blank("role")).alias("role"),
        text.alias("text"), (F.col("_kind") == 0).alias("dropped"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    ).drop("_copy")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: all conversations, damaged and repaired."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_conversations(damage(rows))
