import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from deliverylens.llm import packing as P

RANKS = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "", "a", " a", "a ", "a  b", "a b", "a \n b", "a\nb c", "a\n\nb\t c", "it's we'll 12 34,5 é ß 字 🙂",
    "<|endoftext|> x", "a<|endoftext|>b", " <|endoftext|><|endoftext|>", "<|endoftext", "\u00a0a \u00a0 b", "a\x1c b \x1c", "ab\r\ncd ef", "x" * 5000, "a b " * 50])
def test_encoder_is_the_tokenizer(reference, text):
    encoder = P.Encoder(RANKS)
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference(text)


@pytest.mark.parametrize("window,open_windows", [(2048, 16), (64, 2), (16, 1)])
def test_pieces_round_trip(make, corpus, reference, window, open_windows):
    rows = [(i, t) for i, (_, t) in enumerate(corpus)]
    out = P.pack(make(rows, extra=True).repartition(5), RANKS, window, open_windows, merge_group=2).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in rows:
        ids = np.array([*reference(text), P.END], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == window or at < window and at & (at - 1) == 0  # no padding at all


def test_special_token_and_very_long_texts():
    import time

    assert np.frombuffer(P.Encoder(RANKS).encode("a<|endoftext|>b"), "<u4").tolist() == [64, 50256, 65]
    out = []
    packer, n, begin = P.Packer(lambda pieces: out.append(pieces[0][1]), 2048, 16), 32_000_000, time.monotonic()
    packer.put(1, 0, bytes(4 * n), n)
    assert out == list(range(0, n, 2048)) and time.monotonic() - begin < 20


def test_open_windows_are_bounded():
    emitted = []
    packer = P.Packer(emitted.append, 10, 3)
    for k, n in enumerate([4, 4, 4, 7, 3, 9, 25, 1]):
        packer.put(k, 0, b"\0\0\0\0" * n, n)
        assert len(packer.open) <= 3
    full = [sum(len(p[2]) // 4 for p in s) for s in emitted]
    assert set(full) == {10}
    assert sum(full) + sum(used for used, _ in packer.open) == 57


def test_null_ids_repeated_rows_and_empty_table(make):
    out = P.pack(make([(None, "a b"), (7, "c"), (7, "c"), (8, None)]), RANKS).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["doc_tokens"]) for r in out) == [
        (False, 7, 2), (False, 7, 2), (False, 8, 1), (True, 0, 3)]
    assert P.pack(make([]), RANKS).count() == 0


def test_result_holds_the_ids(make, corpus, reference):
    """Each piece has its ids: documents and sequences can be read back from the result."""
    rows = [(i, t) for i, (_, t) in enumerate(corpus)]
    rows += [(len(rows), "a b c " * 4000)]
    docs = make(rows).repartition(5)
    out = P.pack(docs, RANKS, 64, 4, merge_group=2)
    documents, sequences = defaultdict(dict), defaultdict(dict)
    for r in out.collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert (len(ids), zlib.crc32(r["ids"])) == (r["length"], r["ids_crc32"])
        documents[r["doc_id"]][r["start"]] = ids
        sequences[r["sequence_id"]][r["offset"]] = ids
    for i, text in rows:
        assert sum((documents[i][k] for k in sorted(documents[i])), []) == [*reference(text), P.END]
    whole = [sum((s[k] for k in sorted(s)), []) for s in sequences.values()]
    assert sum(len(s) == 64 for s in whole) > 0.9 * len(whole)
    assert sum(map(len, whole)) == sum(len(reference(t)) + 1 for _, t in rows)
    digests = P.pack(docs, RANKS, 64, 4, merge_group=2, ids=False)
    assert digests.columns == out.columns[:-1]
    assert sorted(digests.collect(), key=str) == sorted(out.drop("ids").collect(), key=str)


def test_batches_are_bounded():
    rows = [(1, k, 1, 0, 2500, 0, k, b"\0\0\0\0") for k in range(2500)]
    assert [b.num_rows for b in P._batches(rows)] == [1000, 1000, 500]
    assert [b.num_rows for b in P._batches([])] == [0]
