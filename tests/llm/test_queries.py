"""The registered queries on the smallest tables, against their SQL where they have one."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from deliverylens.llm import queries as Q
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

QUERIES, ORACLE = Q.queries(), Q.oracle_sql()


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF_SMALL).cache()
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= kept.count()
        kept = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF_SMALL)
    assert pieces.select("doc_id").distinct().count() == kept.count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_stages_keep_clashing_columns(spark, tmp_path, make):
    """Extra columns with names that the stages use come out with their values."""
    names = ["score", "_row", "_bad", "n_lines", "n_removed", "_key", "key", "node", "leaks", "line"]
    docs = make([(i, f"text number {i} of many words that differ {i * 7} by {i * 13}", f"s{i}") for i in range(12)]
                ).selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in names))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing like it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert len(got) == 12 and all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names), name


def test_pipeline_edge_rows(spark, tmp_path, make):
    """Nulls, empty and repeated rows pass every stage."""
    rows = [(1, None, "a"), (2, "", None), (3, "some words here", "b"), (3, "some words here", "b"), (None, "x", "c")]
    docs = make(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "2", "3", "None"]


def test_pipeline_result_holds_the_tokens(spark, tmp_path, make):
    """The sequences can be put together from the pipeline's result alone."""
    from tokenizers import Tokenizer

    texts = {i: " ".join(f"word{i}x{k}\n"[:7 + k % 4] for k in range(40 + 300 * i)) for i in range(8)}
    make([(i, t, f"s{i}") for i, t in texts.items()]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing like it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got, left = {}, 0
    for r in corpus_pipeline.run(spark, str(tmp_path)).orderBy("doc_id", "start").collect():
        got[r["doc_id"]] = got.get(r["doc_id"], b"") + bytes(r["ids"])
        left += r["length"]
    tokens = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    read = {i: [int.from_bytes(x[k:k + 4], "little") for k in range(0, len(x), 4)] for i, x in got.items()}
    assert {i: tokens.decode(x[:-1], skip_special_tokens=False) for i, x in read.items()} == texts
    assert {x[-1] for x in read.values()} == {1} and left == sum(map(len, read.values()))
