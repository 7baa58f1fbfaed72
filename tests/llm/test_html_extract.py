import numpy as np
import pytest

from deliverylens.llm import html_extract as H


@pytest.mark.parametrize("html,want", [
    (None, []), ("", []), ("plain", [(H.OPEN, "plain")]),
    ("<article><h1>T &amp; x</h1><p><b>a<br><p>b  c\n d</article><footer>f</footer>",
     [(H.MAIN, "T & x"), (H.MAIN, "a"), (H.MAIN, "b c d"), (H.CHROME, "f")]),
    ("<nav><ul><li><a href='>'>n</a></li></ul></nav><main><p>m</main>", [(H.CHROME, "n"), (H.MAIN, "m")]),
    ("<main><header><h1>t</h1></header><article><p>x</p><div class='post-comments'><p>c</div></article><p>r</main>",
     [(H.OPEN, "t"), (H.MAIN, "x"), (H.CHROME, "c"), (H.OPEN, "r")]),
    ("<script>var a='<p>';</script><style>p{}</style><!-- <p>no</p> --><p>a<span class=ad>buy</span> b</p>",
     [(H.CHROME, "buy"), (H.OPEN, "a b")]),
    ("<div>a <button>press</button> b<p>c</div><p>d<span class='share'>s<p>t</span>e</p>f",
     [(H.CHROME, "press"), (H.OPEN, "a b"), (H.OPEN, "c"), (H.CHROME, "s"), (H.CHROME, "t"), (H.OPEN, "d e"), (H.OPEN, "f")]),
    ("<article><p>&#233;&eacute;&lt;p&gt;&nbsp;x</p><p>cut <b", [(H.MAIN, "éé<p> x"), (H.MAIN, "cut")]),
    ("<article><form><input><p>q</p></form><aside>s</aside><p hidden>h</p><p style='display: none'>i</p><p>z</article>",
     [(H.CHROME, "q"), (H.CHROME, "s"), (H.CHROME, "h"), (H.CHROME, "i"), (H.MAIN, "z")])])
def test_blocks(html, want):
    assert H.blocks(html) == want


def test_suffix_runs_match_brute_force():
    rng = np.random.default_rng(4)
    streams = [rng.integers(0, 4, n).astype(np.uint64) for n in (0, 3, 40, 60, 5)]
    name, owner = H.suffix_runs(streams, 4, 10)
    want = {}
    for i, s in enumerate(streams):
        for k in range(len(s) - 3):
            want.setdefault(tuple(s[k:k + 4].tolist()), set()).add(i)
    got = {}
    for x, y in zip(name.tolist(), owner.tolist(), strict=True):
        got.setdefault(x, []).append(y)
    assert sorted(sorted(v) for v in got.values()) == sorted(sorted(v) for v in want.values())
    assert all(len(v) == len(set(v)) for v in got.values())
    assert np.bincount(np.unique(H.suffix_runs(streams, 4, 2)[0], return_inverse=True)[1]).max() <= 2


def test_repeated_open_text_goes_and_unique_runs_stay(spark):
    common = "this site uses many words that stand on every page"
    rows = [(i, f"http://Host.example/{i}", f"<div>{common} unique{i} tail{i}</div><div>only {i}</div>", "clash")
            for i in range(6)]
    rows += [(10, "http://b.example/", f"<div>{common} u</div>", "x"), (11, None, None, "x"), (12, "no url", "", "x"),
             (13, "http://host.example/13", "<article><p>" + common + "</p></article>", "x"),
             (None, "http://host.example/n", "<p>" + "long " * 20000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    assert len(got) == len(rows)
    assert got[3] == "unique3 tail3\nonly 3"
    assert got[10] == f"{common} u"  # another host
    assert got[11] == got[12] == ""
    assert got[13] == common  # articles keep what repeats
    assert got[None].count("long") == 20000


def test_copies_of_a_page_do_not_erase_it(spark):
    html = "<div>" + " ".join(f"w{k}" for k in range(30)) + "</div>"
    pages = spark.createDataFrame([(i, "http://h/", html) for i in range(5)], "page_id long, url string, html string")
    out = H.extract(pages).collect()
    assert len(out) == 5 and all(r["text"].endswith("w29") and r["n_chars"] == len(r["text"]) for r in out)
    assert H.extract(pages.where("false")).count() == 0


def test_near_copies_of_a_page_do_not_erase_it(spark):
    shared = " ".join(f"w{k}" for k in range(60))
    near = [(i, "http://h/", f"<div>{shared} x{i}</div>") for i in range(4)]
    # one member alone shares a run with two pages of its own kind: three pages hold it
    menu = "home news sport weather contact about us"
    near[0] = (0, "http://h/", f"<div>{shared} x0</div><div>{menu}</div>")
    other = [(10 + i, "http://h/", f"<div>{menu}</div><p>" + " ".join(f"u{i}_{k}" for k in range(9))) for i in range(2)]
    got = {r["page_id"]: r["text"] for r in H.extract(
        spark.createDataFrame(near + other, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{shared} x{i}" for i in range(4)} | {
        10 + i: " ".join(f"u{i}_{k}" for k in range(9)) for i in range(2)}


def test_whole_query_matches_brute_force(spark):
    """Every window of every page against those of all others, families by plain comparison of sets."""
    rng = np.random.default_rng(9)
    phrases = [" ".join(f"p{j}_{k}" for k in range(n)) for j, n in enumerate((5, 6, 9, 14, 30))]
    rows = []
    for i in range(60):
        parts = [phrases[j] for j in rng.choice(5, rng.integers(0, 4), replace=False)]
        parts += [" ".join(f"v{rng.integers(0, 400)}" for _ in range(rng.integers(1, 25)))]
        tags = rng.choice(["div", "p", "footer"], len(parts))
        rows.append((i, f"http://{'ab'[i % 2]}.example/", "".join(f"<{t}>{x}</{t}>" for t, x in zip(tags, parts, strict=True))))
    rows += [(60 + i, rows[i][1], rows[i][2]) for i in range(10)]  # copies
    rows += [(70 + i, rows[3 * i][1], rows[3 * i][2] + f"<p>tail{i}") for i in range(10)]  # and nearly
    got = {r["page_id"]: r["text"] for r in H.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect()}

    parsed = {i: (url, H.blocks(html)) for i, url, html in rows}
    family = {i: i for i in parsed}

    def shingles(i):
        w = " ".join(t for _, t in parsed[i][1]).split()
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}

    sets = {i: shingles(i) for i, (_, b) in parsed.items() if any(k == H.OPEN for k, _ in b)}
    for i in sets:
        for j in sets:
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = family[i], family[j]
                family = {k: min(a, b) if f in (a, b) else f for k, f in family.items()}
    whole = {}
    for i, (url, blocks) in parsed.items():  # pages without open blocks: exact copies
        if i not in sets:
            family[i] = whole.setdefault((url, tuple(blocks)), i)

    def stream(i, kinds):
        out = []
        for b, (kind, t) in enumerate(parsed[i][1]):
            if kind in kinds:
                out += [*t.split(), ("break", b)]
        return out

    holders = {}
    for i, (url, _) in parsed.items():
        x = stream(i, {H.OPEN, H.CHROME})
        for k in range(len(x) - 5):
            holders.setdefault((url, tuple(x[k:k + 6])), set()).add(family[i])
    erased = 0
    for i, (url, blocks) in parsed.items():
        x = stream(i, {H.OPEN})
        covered = {k + d for k in range(len(x) - 5) for d in range(6) if len(holders.get((url, tuple(x[k:k + 6])), ())) >= 3}
        erased += len(covered)
        want, at = [], 0
        for kind, t in blocks:
            if kind == H.OPEN:
                words = t.split()
                want.append(" ".join(w for k, w in enumerate(words, at) if k not in covered))
                at += len(words) + 1
            elif kind == H.MAIN:
                want.append(t)
        assert got[i] == "\n".join(w for w in want if w), i
    assert erased > 100
