"""Conversations in the order of their turns, dealt over tasks.

Rows are range-partitioned on (conversation, turn, tie), so a conversation of
any length, a third of all rows too, is spread over as many tasks as its share.
A task meets nearly all its conversations whole; only those at the edges of its
range, and those too long to hold, come in parts.

Order: turn with nulls first, then the MD5 of role and text; rows that agree in
all of these are interchangeable.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of one conversation that a task holds before it passes them on.
HOLD_CHARS = 1 << 22


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, more) in tasks of consecutive turns.

    ``_salt`` tells equal rows apart, which would otherwise be one range.
    """
    said = F.concat(F.coalesce("role", F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    keyed = rows.withColumn("_tie", F.md5(said)).withColumn("_salt", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("_tie"), F.asc("_salt")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_tie", "_salt")


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def runs(batches: Iterable[pa.RecordBatch], hold: int | None = None) -> Iterator[tuple[int | None, list[tuple], bool]]:
    """(conv_id, rows, whole) of a task's rows (conv_id, turn, role, text, more).

    ``whole``: these are all rows of the conversation. A task's first and last
    conversation may go on elsewhere and never count as whole; one over
    ``hold`` characters comes in several parts.
    """
    hold = HOLD_CHARS if hold is None else hold
    held: list[tuple] = []
    size, whole, current, begun = 0, False, None, False
    for row in rows_of(batches):
        if begun and row[0] != current:
            if held:
                yield current, held, whole
            held, size, whole = [], 0, True
        current, begun = row[0], True
        held.append(row)
        size += len(row[3] or "") + 64
        if size > hold:
            yield current, held, False
            held, size, whole = [], 0, False
    if held:
        yield current, held, False
