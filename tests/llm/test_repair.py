"""op13 against a plain search over all edits, and its kernel against one chunk."""

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from deliverylens.llm import repair as R

CONV = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\r\x0b\x0c"
NEXT = {"": ["user"], "s": ["user"], "u": ["assistant"], "a": ["user"]}


def cheapest(rows):
    """(cost, audit, turns) of (role, text, fault) rows, by trying every edit."""
    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for role in NEXT[last]:
                c, a, t = best(i, role[0], inserted + 1)
                found.append((c + 3, "I" + a, (f"{role}:", *t)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, t = best(i + 1, last, 0)
            found.append((c + 4, "D" + a, t))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                first = role[:1]
                if (last, first) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    c, a, t = best(i + 1, first, 0)
                    found.append((c + more, "K" + a, (f"{role}:{text}", *t)))
                for new in NEXT[last]:
                    c, a, t = best(i + 1, new[0], 0)
                    found.append((c + 3 + more, "R" + a, (f"{new}:{text}", *t)))
        return min(found, key=lambda f: f[:2]) if found else (10**6, "~", ())

    return best(0, "", 0)


def plain(rows):
    """The result row (without conv_id) of (turn, role, text) rows in order."""
    seen, faults, out = set(), [], []
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                 else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
        faults.append(fault)
        out.append((role, text, fault))
    given = [t for t, _, _ in rows if t is not None]
    cost, audit, said = cheapest(tuple(out))
    pairs = [a[:1] + b[:1] for (_, a, _), (_, b, _) in zip(rows, rows[1:])]
    return ((max(given) - min(given) + 1 - len(set(given)) if given else 0),
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0,
                                       hashlib.md5(f"{r[1]}:{r[2]}".encode()).hexdigest()))


def damaged(rows):
    """conv_id -> its rows after the damage."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else text.translate(str.maketrans("", "", ".!?")) if k == 2 else text
        kept += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return {c: in_order(r) for c, r in out.items()}


def some_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "sage", "", " "]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "A. ", "B", "C.", "D.", "E.", "F", "x.\t", "é."]
    return [(i, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {i}{rng.choice('.,')}")
            for i in range(n)]


def test_kernel_equals_search():
    rng = random.Random(1)
    convs = [some_rows(rng, rng.randint(0, 9)) for _ in range(400)]
    convs += [[(0, "system", "S.")], [(0, "assistant", "A.")], [(None, "user", "U."), (3, "user", "U.")], []]
    assert R.repair(convs) == [plain(c) for c in convs]


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_chunks_settle_to_the_vectors_of_one_chunk(size):
    rng = np.random.default_rng(size)
    for kinds in (16, 3, 12):
        codes = rng.integers(0, kinds, 200)
        if kinds == 3:
            codes = np.full(200, R.BLANK * 4)  # never converges: all are deleted
        whole = R.sweep(codes[None], R.END[None])[0]
        (names, chunks, last), = R._chunked([codes], size)
        found = R.settle(chunks, last)
        rows = np.concatenate([found[k, :n] for k, (_, n) in enumerate(names)])
        assert (rows - rows.min(1, keepdims=True) == whole[:-1] - whole[:-1].min(1, keepdims=True)).all()


def got(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_damage_and_repair_of_nulls_ties_and_dropped(spark):
    rng = random.Random(2)
    rows = [(c, t, r, x) for c in range(60) for t, r, x in some_rows(rng, rng.randint(1, 8))]
    rows += [(None, None, None, None), (None, 2, "user", None), (None, 2, None, "x."), (70, None, "user", "U."),
             (70, None, "assistant", "A."), (70, 5, "user", "U."), (71, 1, "user", "a."), (71, 1, "user", "b.")]
    gone = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "U."), (-2**62, 0, "user", "\U0001f642.")]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, CONV).selectExpr("*", "'x' AS pos", "'y' AS dropped", "1 AS code")
    found = got(R.repair_conversations(R.damage(table)))
    want = {c: plain(r) for c, r in damaged(rows).items()}
    assert found == want
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark):
    assert R.repair_conversations(R.damage(spark.createDataFrame([], CONV))).count() == 0


@pytest.mark.parametrize("passes", [0, 1, 50])
def test_conversations_across_tasks(spark, monkeypatch, passes):
    """One conversation of 30,000 rows over all tasks, another of nothing but
    copies, which never converges: fix-up passes and exact maps agree with one sweep."""
    monkeypatch.setattr(R, "PASSES", passes)
    rng = random.Random(3)
    long = [(5, i, r, x) for i, r, x in some_rows(rng, 30_000)]
    copies = [(6, i, "user", "Same.") for i in range(12_000)]
    rows = long + copies + [(7, 0, "user", "Hi."), (7, 1, "assistant", "Ho.")]
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "false AS dropped").repartition(8)
    found = got(R.repair_conversations(df))
    by = {}
    for c, *r in rows:
        by.setdefault(c, []).append(tuple(r))
    assert found == dict(zip(by, R.repair([in_order(r) for r in by.values()])))
    assert found[6][5] == 4 * 11_999 + 3
