"""Packing: bounded-space online packing of token sequences.

Each partition tokenises its documents and keeps at most ``open_windows`` open
windows. A piece goes to the open window it fits best (least room left); if it
fits none, the fullest window is filled to the brim with the piece's head and
emitted, and the rest is placed on. Documents of a window or more give whole
windows directly. At the end a partition's open windows, at most
``open_windows`` of them, are merged with those of neighbouring partitions in
the same way, and what is left of a merge group is cut into powers of two,
which need no padding. Memory is bounded by the open windows and one document.

A piece comes with its token ids (``ids``, little-endian and of 32 bits each) and
their CRC32, so the sequences can be put together from the result alone. Token
ids are those that the ``tokenizers`` library gives with the vocabulary
file by default: a special token's string in a text is that token. Every
document ends with ``END``. Edge cases: null
or empty text is the end token alone; repeated rows are packed each for
itself; an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import staged, table

WINDOW = 2048
END = 1
#: Windows a partition keeps open, and partitions whose leftovers merge.
OPEN_WINDOWS = 16
MERGE_GROUP = 32
#: Pieces that a task hands on at once, each of a window of ids at most.
PIECES = 1000

_OUT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "ids binary")
_ARROW = pa.schema([(n.split()[0], pa.binary() if n.endswith("binary") else pa.int64())
                    for n in _OUT.split(", ")])


def _bytes_of_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    visible ones for themselves, the others from U+0100 on, in order."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Text -> little-endian uint32 ids of a byte-level vocabulary file, with
    the strings of its special tokens as these tokens."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = _bytes_of_symbols()
        ranks = {bytes(byte[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self._ids = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens=special).encode_to_numpy

    def encode(self, text: str | None) -> bytes:
        return self._ids(text, allowed_special="all").astype("<u4").tobytes() if text else b""


class Packer:
    """The open windows of one task. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, emit: Callable[[list[tuple]], None], window: int, open_windows: int):
        self.emit, self.window, self.most = emit, window, open_windows
        self.open: list[tuple[int, list[tuple]]] = []  # (tokens, pieces)

    def put(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        """Place one piece, cutting it where it has to be cut."""
        size, at = self.window * 4, 0
        while len(ids) - at >= size:
            self.emit([(doc_id, start, ids[at:at + size], doc_tokens)])
            start, at = start + self.window, at + size
        ids = ids[at:]
        while ids:
            n = len(ids) // 4
            fits = [(self.window - used - n, i) for i, (used, _) in enumerate(self.open)
                    if used + n <= self.window]
            if fits:
                i = min(fits)[1]
                used, pieces = self.open[i]
                pieces.append((doc_id, start, ids, doc_tokens))
                self.open[i] = (used + n, pieces)
                if used + n == self.window:
                    self.emit(self.open.pop(i)[1])
                return
            if len(self.open) < self.most:
                self.open.append((n, [(doc_id, start, ids, doc_tokens)]))
                return
            i = max(range(len(self.open)), key=lambda k: (self.open[k][0], -k))
            used, pieces = self.open.pop(i)
            room = self.window - used
            pieces.append((doc_id, start, ids[:room * 4], doc_tokens))
            self.emit(pieces)
            start, ids = start + room, ids[room * 4:]


def powers_of_two(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """Cut a window's pieces into sequences whose lengths are powers of two."""
    rest = sum(len(p[2]) // 4 for p in pieces)
    pieces = list(pieces)
    while rest:
        room, out = 1 << (rest.bit_length() - 1), []
        rest -= room
        while room:
            doc_id, start, ids, total = pieces.pop(0)
            n = len(ids) // 4
            if n > room:
                pieces.insert(0, (doc_id, start + room, ids[room * 4:], total))
                ids, n = ids[:room * 4], room
            out.append((doc_id, start, ids, total))
            room -= n
        yield out


def _rows(sequence: int, pieces: list[tuple], keep_ids: bool) -> list[tuple]:
    out, offset = [], 0
    for doc_id, start, ids, total in pieces:
        n = len(ids) // 4
        out.append((doc_id, start, n, zlib.crc32(ids), total, sequence, offset,
                    ids if keep_ids else None))
        offset += n
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _ARROW, strict=True)], schema=_ARROW)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The rows, ``PIECES`` at a time; an empty batch if there are none."""
    for i in range(0, max(1, len(rows)), PIECES):
        yield _batch(rows[i:i + PIECES])


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, merge_group: int = MERGE_GROUP, ids: bool = True) -> DataFrame:
    """One row per piece: where its ids stand in the document and in the sequence,
    and the ids, unless ``ids`` is false and their CRC32 is enough.

    Complete sequences have ids ``partition * 2**32 + n``; merged leftovers
    ``2**62 + group * 2**32 + n``. The same input partitions give the same
    rows again, so a task that is run anew changes nothing.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(vocabulary), TaskContext.get().partitionId()
        rows: list[tuple] = []
        count = 0

        def emit(pieces: list[tuple]) -> None:
            nonlocal count
            rows.extend(_rows((part << 32) + count, pieces, ids))
            count += 1

        packer = Packer(emit, window, open_windows)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = encoder.encode(text.as_py()) + end
                packer.put(doc_id, 0, own, len(own) // 4)
                if len(rows) >= PIECES:
                    yield from _batches(rows)
                    rows.clear()
        for k, (_, pieces) in enumerate(packer.open):  # a leftover's sequence id names its window
            rows.extend(_rows(-1 - ((part << 16) + k), pieces, True))
        yield from _batches(rows)

    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        count, base = 0, (1 << 62) + (int(key[0]) << 32)

        def emit(pieces: list[tuple]) -> None:
            nonlocal count
            rows.extend(_rows(base + count, pieces, ids))
            count += 1

        packer = Packer(emit, window, 1 << 30)
        pdf = pdf.sort_values(["sequence_id", "offset"], ascending=[False, True])
        for window_rows in sorted((g for _, g in pdf.groupby("sequence_id")),
                                  key=lambda g: (-g["length"].sum(), -g["sequence_id"].iloc[0])):
            for r in window_rows.itertuples():
                packer.put(None if pd.isna(r.doc_id) else int(r.doc_id), r.start, r.ids, r.doc_tokens)
        last: list[tuple] = []
        fullest = sorted(packer.open, key=lambda o: -o[0])
        packer.open, packer.most = [], 1
        for _, pieces in fullest:
            for p in pieces:
                packer.put(*p)
        for _, pieces in packer.open:
            last.extend(pieces)
        for pieces in powers_of_two(last):
            emit(pieces)
        return pd.DataFrame(rows, columns=_ARROW.names).astype({"doc_id": "Int64"})

    placed = staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(place, _OUT),
                    "packing")  # read twice below, tokenised once
    done = placed.where("sequence_id >= 0")
    group = F.shiftright(-1 - F.col("sequence_id"), 16) / merge_group
    left = placed.where("sequence_id < 0").groupBy(F.floor(group).alias("merge_group")).applyInPandas(merge, _OUT)
    out = done.unionByName(left)
    return out if ids else out.drop("ids")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: all documents in windows of 2048 tokens, the ids by their CRC32."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)
