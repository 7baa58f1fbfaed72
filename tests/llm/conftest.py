import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """make(rows) -> documents; a row is (doc_id, text) or (doc_id, text, source)."""

    def build(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None)
                for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:  # names that operators use themselves
            for name in ("score", "line", "key", "node", "a", "chunk", "row", "kept", "leaks", "_row", "rank"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


@pytest.fixture(scope="session")
def corpus():
    """Random texts with copies, near copies, shared passages, nulls and junk."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = [(i, text(rng.randint(1, 120))) for i in range(60)]
    passage = text(30)
    for i in range(60, 75):
        rows.append((i, f"{text(rng.randint(0, 40))} {passage}\n{text(rng.randint(0, 40))}"))
    for i in range(75, 100):
        base = rows[rng.randrange(40)][1].split(" ")
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            base[rng.randrange(len(base))] = rng.choice(words)
        rows.append((i, " ".join(base)))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "one two three"), (105, "ONE two THREE"),
             (106, "ab" * 300), (107, "ab" * 200), (108, text(4000)), (109, rows[3][1]), (None, rows[4][1]),
             (None, None), (110, "x"), (110, "x"), (111, " ".join(["same"] * 400)), (112, "# * $ % & | < >")]
    rng.shuffle(rows)
    return rows
