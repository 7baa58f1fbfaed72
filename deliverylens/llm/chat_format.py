"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered as one string: a template's control strings mark
the turns, and the same strings inside a text get a backslash after their first
character (one more if they have some already), which reading takes off again.
The whole string is encoded once, with the offsets of its tokens; the spans of
the assistant's texts, sorted as they are rendered, meet the token offsets by
binary search, and the tokens inside are the loss mask. Control strings are
added to the tokenizer as special tokens, so no token crosses a turn's edge;
with a tokenizer whose tokens do, such a token is left out of the mask.

Output is in pieces of whole turns: one a conversation, more where it spans
tasks or is over ``turns.HOLD_CHARS``. Pieces of a conversation are in order of
(part, piece) and their ids, joined, are those of the whole string, because
control strings separate them. A rendered piece is encoded in segments of
``SEGMENT`` characters cut before a blank, where the vocabulary's pattern cuts
as well; only a run of over ``LONGEST`` characters without one is cut inside.

Edge cases: a null text or role is the empty string; a turn with an empty text
keeps its marks; a null conv_id is a conversation; nulls in turn come first,
ties go by the MD5 of role and text, repeated rows are repeated turns; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm import turns
from deliverylens.llm.common import staged, table

SEGMENT = 1 << 16
LONGEST = 1 << 20
#: Characters that are encoded in one call.
_AT_ONCE = 1 << 20
BACKSLASH = re.escape("\\")
_BLANK = re.compile(r"(?<=\S)[ \n]")


@dataclass(frozen=True)
class Template:
    """``user`` and ``role`` open a turn, the assistant's has no opening."""

    user: str = "[INST]"
    user_end: str = "[/INST]"
    role: str = "[ROLE]"
    role_end: str = "[/ROLE]"
    end: str = "</s>"
    reserved: tuple[str, ...] = ("<|endoftext|>",)

    def controls(self) -> list[str]:
        return [self.user, self.user_end, self.role, self.role_end, self.end, *self.reserved]


class Markup:
    """Rendering and reading of a template."""

    def __init__(self, template: Template | None = None):
        self.template = t = template or Template()
        rest = {c: c[1:] for c in t.controls()}
        heads = {c[0] for c in rest}
        if not all(rest.values()) or any(h in r for h in [*heads, "\\"] for r in rest.values()) or "\\" in heads:
            raise ValueError("a control string's first character may stand nowhere else in one, nor a backslash")

        def marked(between: str) -> str:
            return "|".join(f"(?<={re.escape(c[0])}){between}{re.escape(r)}" for c, r in rest.items())

        self._escape = re.compile(f"(?={marked(BACKSLASH + '*')})")
        self._unescape = re.compile(marked(BACKSLASH + "+"))
        self.control = re.compile("|".join(map(re.escape, rest)))

    def escape(self, text: str) -> str:
        return self._escape.sub(r"\\", text)

    def unescape(self, text: str) -> str:
        return self._unescape.sub(lambda m: m[0][1:], text)

    def render(self, said: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The string of (role, text) turns and the spans of the assistant's texts."""
        t, parts, spans, at = self.template, [], [], 0
        for role, text in said:
            body = self.escape(text)
            if role == "assistant":
                spans.append((at, at + len(body)))
                turn = [body, t.end]
            elif role == "user":
                turn = [t.user, body, t.user_end]
            else:
                turn = [t.role, self.escape(role), t.role_end, body, t.end]
            parts += turn
            at += sum(map(len, turn))
        return "".join(parts), spans

    def read(self, formatted: str) -> Iterator[tuple[str, str]]:
        """The (role, text) turns of a rendered string."""
        t, at = self.template, 0
        while at < len(formatted):
            role = "assistant"
            if formatted.startswith(t.user, at):
                role, at, end = "user", at + len(t.user), t.user_end
            else:
                if formatted.startswith(t.role, at):
                    at += len(t.role)
                    stop = formatted.index(t.role_end, at)
                    role, at = self.unescape(formatted[at:stop]), stop + len(t.role_end)
                end = t.end
            stop = formatted.index(end, at)
            yield role, self.unescape(formatted[at:stop])
            at = stop + len(end)


class Encoder:
    """A tokenizer of the ``tokenizers`` library with the template's controls."""

    def __init__(self, path: str, markup: Markup):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        self.markup = markup
        self.model = Tokenizer.from_file(path)
        self.model.add_special_tokens([AddedToken(c, special=True, normalized=False)
                                       for c in markup.template.controls()])

    def segments(self, text: str) -> Iterator[tuple[int, str]]:
        """(begin, segment) of a string, cut where encoding can't tell."""
        begin = 0
        while len(text) - begin > SEGMENT:
            found = _BLANK.search(text, begin + SEGMENT, begin + LONGEST)
            cut = found.start() if found else min(begin + LONGEST, len(text))
            if not found and cut < len(text):  # not inside a control string
                for m in self.markup.control.finditer(text, max(begin, cut - 64), cut + 64):
                    cut = m.end() if m.start() < cut < m.end() else cut
            yield begin, text[begin:cut]
            begin = cut
        if begin < len(text):
            yield begin, text[begin:]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, first, end) of each text's tokens; first and end count code points."""
        cuts = [(i, begin, s) for i, t in enumerate(texts) for begin, s in self.segments(t)]
        parts: list[list] = [[] for _ in texts]
        for lo in range(0, len(cuts), 64):
            some = cuts[lo:lo + 64]
            for (i, begin, _), e in zip(some, self.model.encode_batch([s for _, _, s in some], add_special_tokens=False),
                                        strict=True):
                at = np.array(e.offsets, np.int64).reshape(-1, 2) + begin
                parts[i].append((np.array(e.ids, np.int32), at[:, 0], at[:, 1]))
        none = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        return [tuple(map(np.concatenate, zip(*p, strict=True))) if p else none for p in parts]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist(), skip_special_tokens=False)


def mask(first: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for the tokens that lie inside a span; both are sorted."""
    step = np.zeros(len(first) + 1, np.int64)
    if spans:
        at = np.array(spans, np.int64)
        lo, hi = np.searchsorted(first, at[:, 0], "left"), np.searchsorted(end, at[:, 1], "right")
        some = hi > lo
        np.add.at(step, lo[some], 1)
        np.add.at(step, hi[some], -1)
    return np.cumsum(step[:-1]) > 0


_PIECES = ("conv_id long, part int, piece long, whole boolean, n_turns long, formatted string, "
           "ids array<int>, loss array<boolean>")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)))


def format_conversations(rows: DataFrame, tokenizer: str, template: Template | None = None) -> DataFrame:
    """Formatted pieces of all conversations of ``rows`` (conv_id, turn, role, text).

    ``ids`` are the tokens of ``formatted``, ``loss`` says of each if it is
    trained on, ``whole`` if the piece is a whole conversation.
    """

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markup = Markup(template)
        encoder, part, done = Encoder(tokenizer, markup), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            ids, loss = [], []
            for (_, _, _, _, _, _, spans), (i, first, end) in zip(held, encoder.encode([h[5] for h in held]),
                                                                 strict=True):
                ids.append(i)
                loss.append(mask(first, end, spans))
            columns = list(zip(*held, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(columns[:6], kinds, strict=True)), _lists(ids), _lists(loss)],
                names=[c.split()[0] for c in _PIECES.split(", ")])

        for conv_id, said, whole in turns.runs(batches):
            text, spans = markup.render((r[2] or "", r[3] or "") for r in said)
            held.append((conv_id, part, done, whole, len(said), text, spans))
            done, size = done + 1, size + len(text)
            if size > _AT_ONCE:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    plain = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return turns.in_order(plain).mapInArrow(piece, _PIECES)


class Digest:
    """What is read back from the ids and masks of a conversation's pieces."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, ids: np.ndarray, loss: np.ndarray) -> None:
        markup = self.encoder.markup
        text = self.encoder.decode(ids)
        self.formatted_chars += len(text)
        for role, said in markup.read(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], loss.astype(np.int8), [0]])))
        for a, b in edges.reshape(-1, 2):
            said = markup.unescape(self.encoder.decode(ids[a:b]))
            self.loss_chars += len(said)
            self.loss.update(said.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def digests(pieces: DataFrame, tokenizer: str, template: Template | None = None) -> DataFrame:
    """A row a conversation, read back from the pieces' ids and masks.

    Whole conversations are read where they were formatted; the pieces of
    others, a few for each task or a very long one's, meet in order and are read
    one after the other, as their hash needs it.
    """
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    through = "part int, piece long, ids array<int>, loss array<boolean>"

    def numpy(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        ids, loss = batch.column("ids")[i].values, batch.column("loss")[i].values
        return ids.to_numpy(zero_copy_only=False), loss.to_numpy(zero_copy_only=False).astype(bool)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, Markup(template))
        for batch in batches:
            rows, parts = [], []
            for i, (conv, is_whole) in enumerate(zip(batch.column("conv_id").to_pylist(),
                                                     batch.column("whole").to_pylist(), strict=True)):
                if is_whole:
                    digest = Digest(encoder)
                    digest.feed(*numpy(batch, i))
                    rows.append((conv, *digest.row()))
                else:
                    rows.append((conv, None, None, None, None, None))
                    parts.append(i)
            kept = batch.select(["part", "piece", "ids", "loss"])
            here = pa.array([not w for w in batch.column("whole").to_pylist()])
            none = [pa.compute.if_else(here, c, pa.scalar(None, c.type)) for c in kept.columns]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _DIGEST_TYPES, strict=True)), *none],
                names=[*names, *kept.schema.names])

    def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, Markup(template))
        digest, current = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in
                                               zip((current, *digest.row()), _DIGEST_TYPES, strict=True)], names=names)

        for batch in batches:
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                if digest is None or conv != current:
                    if digest:
                        yield out()
                    digest, current = Digest(encoder), conv
                digest.feed(*numpy(batch, i))
        if digest:
            yield out()

    mixed = staged(pieces.mapInArrow(whole, f"{_DIGEST}, {through}"), "chat")
    done = mixed.where(F.col("ids").isNull()).select(*names)
    order = [F.asc_nulls_first("conv_id"), "part", "piece"]
    rest = (mixed.where(F.col("ids").isNotNull()).repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "part", "piece", "ids", "loss").mapInArrow(in_parts, _DIGEST))
    return done.unionByName(rest)


#: The conversation that the query adds.
SAMPLE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def query(spark, sf_dir: str) -> DataFrame:
    """op12: all conversations and one of control strings, read back from the output."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(SAMPLE, "conv_id long, turn long, role string, text string")
    return digests(format_conversations(rows.unionByName(more), path), path)
