from deliverylens.llm import line_dedup as L

NOTE = "All pages of this site are made with care."


def rows():
    out = [(i, f"start {i}\n{NOTE}\nend {i}\n", f"s{i % 12}") for i in range(30)]
    out += [(100 + i, f"copied text\nwith lines that repeat\n\n{NOTE}", f"s{i}") for i in range(12)]  # copies
    out += [(200, None, "s1"), (201, "", "s1"), (202, " \n\t\n", "s2"), (203, f"  {NOTE}\r\nx", None), (None, NOTE, "s3"),
            (204, "rare line\n" * 3, "s4"), (204, "rare line\n" * 3, "s4")]
    return out


def test_cross_site_lines_go_and_copies_stay(make):
    docs = make(rows(), extra=True)
    out = L.remove_boilerplate(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], r)
    assert got[7]["text"] == "start 7\nend 7\n" and (got[7]["n_lines"], got[7]["n_removed"]) == (3, 1)
    assert got[105]["text"] == "copied text\nwith lines that repeat\n"
    assert got[200]["text"] is None and got[201]["text"] == "" and got[202]["text"] == " \n\t\n"
    assert got[203]["text"] == "x" and got[None]["text"] == "" and got[204]["text"] == "rare line\n" * 3
    assert out.count() == len(rows())


def test_threshold_is_exact(make):
    for sites, kept in ((9, True), (10, False), (11, False)):
        docs = make([(i, f"a{i}\n{NOTE}\nb{i}", f"s{i % sites}") for i in range(40)])
        assert (L.remove_boilerplate(docs).first()["n_removed"] == 0) == kept


def test_blocks_go_and_copies_count_once(make):
    """Inner lines of a shared block; a line outvoted by copies; sites of copies."""
    block = "Licence of this text.\nUse it freely.\nKeep this notice."
    out = [(i, f"own {i}\n{block}\nmore {i}", f"s{i % 12}") for i in range(24)]
    out += [(100 + i, f"a{i}\n{NOTE}\nb{i}", f"s{i % 12}") for i in range(20)]
    out += [(200 + i, f"one page\n{NOTE}\nits end", f"s{i % 15}") for i in range(60)]  # copies
    # ten texts, each on a site of its own and on s0
    out += [(300 + 2 * i + k, f"c{i}\nShared by pairs.\nd{i}", f"s{i * k}") for i in range(1, 11) for k in (0, 1)]
    # nine texts on nine sites; a text on fifteen, which counts once, makes ten only of one line
    out += [(400 + i, f"e{i}\nNine and one.\n{'' if i == 1 else 'Eight and one.'}\nf{i}", f"s{i}") for i in range(1, 10)]
    out += [(500 + i, "g\nNine and one.\nEight and one.\nh", f"s{i}") for i in range(15)]
    got = {r["doc_id"]: r["text"] for r in L.remove_boilerplate(make(out)).collect()}
    assert got[3] == "own 3\nmore 3" and got[105] == "a5\nb5" and got[203] == "one page\nits end"
    assert got[303] == "c1\nd1" and got[500] == "g\nEight and one.\nh" and got[402] == "e2\nEight and one.\nf2"


def test_clashing_columns_keep_their_values(make):
    docs = make(rows()).selectExpr("*", "doc_id AS _row", "'bad' AS _bad", "-1 AS n_lines", "'n' AS n_removed")
    out = L.remove_boilerplate(docs)
    assert out.columns == [*docs.columns, "n_lines_", "n_removed_"] and L.added_names(docs) == ("n_lines_", "n_removed_")
    for r in out.collect():
        assert r["_row"] == r["doc_id"] and (r["_bad"], r["n_lines"], r["n_removed"]) == ("bad", -1, "n")
    assert out.where("doc_id = 7").first()["n_removed_"] == 1


def test_plan_is_native_and_empty_table(make):
    out = L.remove_boilerplate(make(rows()))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert L.remove_boilerplate(make([])).count() == 0
