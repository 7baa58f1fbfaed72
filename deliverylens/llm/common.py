"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.session import shared_dir

#: ASCII white space; words are the maximal runs of anything else.
SPACES = " \t\n\r\x0b\x0c"
#: Bits of the filter that keeps most texts that a join would drop from its shuffle.
FILTER_BITS = 1 << 22
#: Rows of whole texts that cross to Python at once, see small_batches.
TEXT_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let at most ``TEXT_ROWS`` rows cross to Python at once in this session: a
    batch of whole texts is held by the JVM and by each worker, and Spark's
    default takes all documents of a task as one. No result depends on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name))
    spark.conf.set(name, str(min(rows, TEXT_ROWS) if rows > 0 else TEXT_ROWS))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage is cut and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str, *also: str) -> str:
    """``name``, with underscores until no column of ``df`` (nor one of ``also``) has it."""
    while name in df.columns or name in also:
        name += "_"
    return name


def mostly(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs whose key may be among ``keys``: surely those that are.

    A bit array of fixed size is broadcast; what it lets through is joined
    exactly by the caller."""
    bit = F.pmod("key", F.lit(FILTER_BITS))
    rows = keys.select((bit / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(key, {FILTER_BITS}) % 64 as int))").alias("b")
                       ).groupBy("w").agg(F.bit_or("b").alias("b")).collect()  # a row a 64 bits at most
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows:
        bits[r["w"]] = r["b"]
    shared = docs.sparkSession.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool))

    @F.pandas_udf("boolean")
    def may(key: pd.Series) -> pd.Series:
        return pd.Series(shared.value[key.to_numpy() % FILTER_BITS])

    return docs.where(may("key"))


def words_of(text: str, lower: bool = False) -> list[bytes]:
    """The runs of non-white-space (ASCII white space only), as UTF-8; ``lower``:
    A-Z become a-z (``bytes.lower`` leaves every other byte as it is)."""
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) over an array of uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def window_names(stream: np.ndarray, length: int) -> np.ndarray:
    """64-bit names of all ``length``-element windows of an array of hashes."""
    n = max(0, len(stream) - length + 1)
    name = np.zeros(n, np.uint64)
    for k in range(length):
        name *= np.uint64(0x9E3779B97F4A7C15)
        name += stream[k:k + n]
    return mix64(name)


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


_P = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = bytes(c in SPACES.encode() for c in range(256))
#: Or anything in ASCII but letters and digits.
NOT_ALNUM = bytes(c < 128 and not chr(c).isalnum() for c in range(256))
#: Masks of the first 0 to 8 bytes of a little-endian word of 64 bits.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG_WORD = 256


_BLOCK_BYTES = 500_000


def blocks_of(texts: Iterable[str | None], fold: bool = False) -> Iterator[list[bytes]]:
    """The texts as UTF-8 in lists of bounded size (or one text); A-Z as a-z,
    or with ``fold`` all letters in lower case."""
    held, size = [], 0
    for t in texts:
        t = t.lower() if t and fold else t or ""
        held.append(t.encode("utf-8", "surrogatepass").lower())
        size += len(held[-1])
        if size >= _BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def word_hashes(texts: list[bytes], between: bytes = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and where each text's
    words begin and end: those of text i are from the i-th place to the next.

    ``between`` says of each byte if it stands between words. Words are hashed
    eight bytes at a time, all words at once.
    """
    data = b"\n".join([*texts, b""]) or b"\n"
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    space = np.frombuffer(data.translate(between), np.bool_)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    edge = np.concatenate([[0][:not space[0]], edge]).astype(np.int64)  # the last byte is a space
    first, size = edge[::2], edge[1::2] - edge[::2]
    eight = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    h = mix64((eight[first] & _FIRST_BYTES[np.minimum(size, 8)]) + size.astype(np.uint64) * _P)
    more, done = np.flatnonzero((size > 8) & (size <= _LONG_WORD)), 8
    while len(more):
        part = eight[first[more] + done] & _FIRST_BYTES[np.minimum(size[more] - done, 8)]
        h[more] = mix64(h[more] * _P + part)
        done += 8
        more = more[size[more] > done]
    if len(size) and size.max() > _LONG_WORD:
        import xxhash

        for i in np.flatnonzero(size > _LONG_WORD).tolist():
            h[i] = xxhash.xxh3_64_intdigest(data[first[i]:first[i] + size[i]])
    return h, np.searchsorted(first, begin)
