import re

import pytest

from deliverylens.llm import quality_rules as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    covered = set()
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    for starts in at.values():
        if len(starts) > 1:
            for s in starts:
                covered.update(range(s, s + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered), len(lines))


@pytest.mark.parametrize("text", [
    None, "", " \n ", "a", "a b\na b\n\na b", "x " * 30, " ".join("abcdefgh") * 2, "é\u00a0ü ß",
    "a b c d e f g h i a b c d e f g h j", "# * $ % & | < >", "\x1ca\x1db\x85c", " ".join(map(str, range(3000))) * 2])
def test_measures_match_brute_force(text):
    assert Q.measure(text) == brute(text)


def test_ledger_policies_and_ablations(spark, make, corpus):
    led = Q.ledger(make(corpus, extra=True)).cache()
    rows = led.collect()
    assert len(rows) == len(corpus)
    by_text = {brute(t) for _, t in corpus}
    assert {tuple(r[m] for m in Q.MEASURES) for r in rows} == by_text
    few = [r for r in rows if r["n_words"] < 20]
    assert few and all(r["failed"] & 1 for r in few)
    kept = Q.apply_policy(led, "v1").where("kept").count()
    table = {r["rule"]: r for r in Q.ablations(led, "v1").collect()}
    m = Q.mask("v1")
    for i, rule in enumerate(Q.rules()):
        assert table[rule]["n_failed"] == sum(r["failed"] >> i & 1 for r in rows)
        alone = sum((r["failed"] & m) == 1 << i for r in rows)
        assert (table[rule]["n_failed_alone"], table[rule]["n_kept_without"]) == (alone, kept + alone)


def test_empty_table(make):
    led = Q.ledger(make([]))
    assert led.count() == 0 and {r["n_kept_without"] for r in Q.ablations(led, "v1").collect()} == {0}
