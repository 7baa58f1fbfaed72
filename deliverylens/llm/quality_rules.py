"""Quality rules: a bitmask ledger.

Every rule is evaluated once per document. Its outcome is one bit of
``failed`` and its measurements stay beside it, so a policy (a set of rules,
with a version name) is a bit mask applied to the ledger, and an ablation
("what would policy P keep without rule R?") is a bitwise aggregation of the
ledger: the texts are never read again.

Edge cases: a null or empty text has no words, all measurements 0, and fails
``few_words``; repeated rows and null ids are judged row by row; extra columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import SPACES, table, words_of

#: The symbols counted, the window of repeated words.
SYMBOLS = "#*$%&|<>"
WINDOW = 8

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_SCHEMA = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)


def rules() -> dict[str, Column]:
    """Rule name -> failure condition over the measurements, in bit order."""
    n, c = F.col("n_words"), F.col
    return {
        "few_words": n < 20,
        "repeated_words": 100 * c("n_repeat_words") > 30 * n,
        "many_symbols": 100 * c("n_symbols") > 20 * n,
        "duplicate_lines": 100 * c("n_dup_lines") > 50 * c("n_lines"),
        "word_length": (c("word_chars") < 2 * n) | (c("word_chars") > 20 * n),
    }


#: Policy version -> the rules it applies.
POLICIES = {
    "base": ["few_words", "repeated_words"],
    "v1": ["few_words", "repeated_words", "many_symbols", "duplicate_lines", "word_length"],
}


def mask(policy: str) -> int:
    order = list(rules())
    return sum(1 << order.index(r) for r in POLICIES[policy])


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a ``window``-word sequence that occurs twice or more.

    Sequences get exact names by doubling (1, 2, 4, 8 words; the window is a
    power of two), so no hash collision can count.
    """
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    name = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    width, top = 1, len(seen)
    while width < window:
        if top == len(name):  # all different already, so are all longer ones
            return 0
        pair = name[:-width] * top + name[width:]
        kinds, name = np.unique(pair, return_inverse=True)
        width, top = width * 2, len(kinds)
    again = np.bincount(name)[name] > 1
    step = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(again)
    step[starts] += 1
    np.subtract.at(step, starts + window, 1)
    return int((np.cumsum(step[:n]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = words_of(text)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = again = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            again += line in seen
            seen.add(line)
    return len(words), chars, symbols, again, repeated_words(words), lines


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = pd.DataFrame([measure(t) for t in pdf["text"]], columns=MEASURES, dtype="int64")
        out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
        yield out


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed`` (bit i: rule i failed)."""
    found = docs.select("doc_id", "text").mapInPandas(_measured, _SCHEMA)
    bits = F.lit(0).cast("long")
    for i, failed in enumerate(rules().values()):
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return found.withColumn("failed", bits)


def apply_policy(led: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return led.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0)


def ablations(led: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone
    (kept again without the rule), and that the policy keeps without it."""
    order, m = list(rules()), mask(policy)
    hit = F.col("failed").bitwiseAND(F.lit(m))
    sums = [F.sum(F.when(hit == 0, 1).otherwise(0)).alias("kept")]
    for r in POLICIES[policy]:
        b = 1 << order.index(r)
        sums.append(F.sum(F.when(hit.bitwiseAND(F.lit(b)) != 0, 1).otherwise(0)).alias(f"f_{r}"))
        sums.append(F.sum(F.when(hit == b, 1).otherwise(0)).alias(f"o_{r}"))
    one = led.agg(*[F.coalesce(s, F.lit(0)).alias(n) for s, n in zip(
        sums, ["kept"] + [f"{k}_{r}" for r in POLICIES[policy] for k in "fo"], strict=True)])
    cells = [F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("n_failed"),
                      F.col(f"o_{r}").alias("n_failed_alone"),
                      (F.col("kept") + F.col(f"o_{r}")).alias("n_kept_without"))
             for r in POLICIES[policy]]
    return one.select(F.inline(F.array(*cells)))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the ledger of all documents under policy v1."""
    led = ledger(table(spark, sf_dir, "documents"))
    base = F.col("failed").bitwiseAND(F.lit(mask("base"))) != 0
    return apply_policy(led, "v1").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "failed")
