"""Training-data pipeline: ``documents`` through five of the operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read again as the next one's docs.
All stages but the last return the columns of ``documents``. Texts cross to
Python in small batches from the first stage on (a setting of the session).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from deliverylens.llm.common import free_name, small_batches, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    small_batches(spark)
    name = free_name(docs, "score")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sites carry; n_chars follows the text."""
    out = line_dedup.remove_boilerplate(docs)
    n = F.when(F.col(line_dedup.added_names(docs)[1]) > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return out.withColumn("n_chars", n).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8)."""
    small_batches(spark)
    return jaccard_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, cut into pieces and laid out in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

#: Classifiers, latent retrieval and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
