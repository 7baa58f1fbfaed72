"""op12: templates round trip, masks against plain spans, digests against plain joins."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from deliverylens.llm import chat_format as C

CONV = "conv_id long, turn long, role string, text string"
PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["<", "/s>", "s>", "[", "INST]", "/INST]", "\\", "</s>", "[ROLE]", " ", "ok", "é", "|endoftext|>", "\n",
        "<|", "\U0001f642", "  ", "[/ROLE]", "don't", "<|endoftext|>", "\t", "0x1f", "ß́"]


def words(rng, n):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))


@pytest.fixture(scope="module")
def encoder():
    return C.Encoder(PATH, C.Markup())


def test_turns_round_trip_and_masks_are_the_assistants_texts(encoder):
    rng = random.Random(1)
    for _ in range(800):
        said = [(rng.choice(["user", "assistant", "system", "", "[ROLE]x", "</s>"]), words(rng, 12))
                for _ in range(rng.randint(0, 6))]
        text, spans = encoder.markup.render(said)
        assert list(encoder.markup.read(text)) == said
        (ids, first, end), = encoder.encode([text])
        assert encoder.decode(ids) == text
        loss = C.mask(first, end, spans)
        inside = [any(a <= f and e <= b for a, b in spans) for f, e in zip(first, end)]
        assert loss.tolist() == inside
        digest = C.Digest(encoder)
        digest.feed(ids, loss)
        want = "".join(t for r, t in said if r == "assistant")
        assert digest.row()[2:4] == (len(want), hashlib.sha256(want.encode()).hexdigest())


def test_escaping_hides_every_control_string():
    markup, rng = C.Markup(), random.Random(2)
    for _ in range(3000):
        text = words(rng, 14)
        hidden = markup.escape(text)
        assert not markup.control.search(hidden)
        assert markup.unescape(hidden) == text
    with pytest.raises(ValueError):
        C.Markup(C.Template(user="<<"))


def test_own_template():
    markup = C.Markup(C.Template(user="{U", user_end="}U", role="{R", role_end="}R", end="}E", reserved=()))
    said = [("user", "{U}E\\{U"), ("x}R", "}E"), ("assistant", "{\\U")]
    assert list(markup.read(markup.render(said)[0])) == said


def test_segments_encode_like_the_whole(encoder, monkeypatch):
    rng = random.Random(3)
    text, spans = encoder.markup.render([("user", words(rng, 4000)), ("assistant", words(rng, 4000))])
    whole, = encoder.encode([text])
    monkeypatch.setattr(C, "SEGMENT", 50)
    monkeypatch.setattr(C, "LONGEST", 400)
    assert len(list(encoder.segments(text))) > 20
    parts, = encoder.encode([text])
    for a, b in zip(whole, parts):
        assert (a == b).all()
    long = "a" * 5000 + "</s>" + "b" * 5000  # no blank: cut inside, and read back all the same
    ids, _, _ = encoder.encode([long])[0]
    assert encoder.decode(ids) == long and len(list(encoder.segments(long))) > 10
    assert encoder.model.token_to_id("</s>") in ids


def plain(rows):
    out, by = [], {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, r or "", x or ""))
    markup = C.Markup()
    for c, said in by.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}:{r[2]}".encode()).hexdigest()))
        loss = "".join(x for _, r, x in said if r == "assistant")
        turns = "".join(f"{r}\n{x}\n" for _, r, x in said)
        out.append((c, len(said), hashlib.sha256(turns.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(markup.render((r, x) for _, r, x in said)[0])))
    return sorted(out, key=str)


def test_conversations_with_nulls_ties_and_parts(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), words(rng, 20) or None)
            for c in range(50) for t in range(rng.randint(1, 7))]
    rows += [(None, None, None, None), (None, None, "assistant", "x"), (None, 1, "assistant", "x"),
             (8, 2, "user", "tie"), (8, 2, "user", "tie"), (8, None, "assistant", "null turn")]
    rows += [(99, i, "user" if i % 2 else "assistant", f"turn {i} [INST]") for i in range(4000)]  # over several tasks
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "'x' AS ids", "'y' AS part").repartition(6)
    pieces = C.format_conversations(df, PATH)
    assert sorted((tuple(r) for r in C.digests(pieces, PATH).collect()), key=str) == plain(rows)
    parts = pieces.where("conv_id = 99").orderBy("part", "piece").collect()
    assert len(parts) > 1
    encoder = C.Encoder(PATH, C.Markup())
    (ids, _, _), = encoder.encode(["".join(p["formatted"] for p in parts)])
    assert np.array_equal(ids, [i for p in parts for i in p["ids"]])


def test_empty_table(spark):
    df = spark.createDataFrame([], CONV)
    assert C.digests(C.format_conversations(df, PATH), PATH).count() == 0
