"""Line dedup: boilerplate by the number of distinct sites that carry a line.

A line's spread is the number of distinct sites among its distinct texts. A
text on one site counts for that site; a text with copies on several counts for
one more site at most, as far as there are others. So copies of a document do
not make its lines boilerplate, whatever their number, nor do they hide that
other texts carry them. Sites are counted by HyperLogLog sketches merged by
aggregation, per line hash; lines whose estimate is within ``band`` of the
threshold get exact distinct counts. Everything is DataFrame expressions.

A line is boilerplate if its spread is ``min_sites`` or more. Boilerplate is
removed wherever it occurs; documents stay, if need be with an empty text.

Edge cases: lines are compared without blanks, tabs and returns at their ends;
blank lines are never boilerplate; a null text stays null and has no lines; a
null site is a site of its own; repeated rows are treated alike; a table
without documents gives none; extra columns are kept, and where one has a name
that is added here, the added one gets an underscore more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import free_name, staged, table

MIN_SITES = 10
#: Estimates this close to the threshold, as a share of it, are counted exactly.
BAND = 0.25
#: Of the sketch: 2**LG registers.
LG = 10

_BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """A line's hash; null for a blank line."""
    bare = F.btrim(line, F.lit(_BLANKS))
    return F.when(bare != "", F.xxhash64(bare))


def _hashes(text: Column) -> Column:
    """Hashes of the lines that aren't blank, in order."""
    return F.array_compact(F.transform(_lines(text), _key))


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """The hashes (line) of boilerplate lines, each once."""
    lines = docs.select(F.xxhash64(F.coalesce(F.col(site).cast("string"), F.lit(""))).alias("site"),
                        F.xxhash64("text").alias("text"), F.explode(_hashes(F.col("text"))).alias("line"))
    each = staged(lines.distinct(), "line-texts")
    wide = staged(each.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG))).alias("sites"))
                  .where(F.col("sites") >= min_sites * (1 - band)), "wide-lines")
    # own: the site of a text that stands on one only
    texts = staged(each.join(wide.select("line"), "line", "left_semi").groupBy("line", "text").agg(
        F.when(F.min("site") == F.max("site"), F.min("site")).alias("own")), "wide-line-texts")
    spread = texts.groupBy("line").agg(
        F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg("own", F.lit(LG))), F.lit(0)).alias("own"),
        F.count_if(F.col("own").isNull()).alias("copied")).join(wide, "line").select(
        "line", "copied", F.least("sites", F.col("own") + F.col("copied")).alias("sites"))
    sure = spread.where(F.col("sites") >= min_sites * (1 + band)).select("line")
    near = spread.where((F.col("sites") >= min_sites * (1 - band)) & (F.col("sites") < min_sites * (1 + band)))

    def count(of: DataFrame, name: str) -> DataFrame:  # distinct first: of a hot line, a task sends each site once
        return of.distinct().join(near.select("line"), "line", "left_semi").groupBy("line").agg(F.count("*").alias(name))

    exact = (near.select("line", "copied").join(count(each.select("line", "site"), "every"), "line")
             .join(count(texts.where("own IS NOT NULL").select("line", "own"), "alone"), "line", "left")
             .where(F.least("every", F.coalesce("alone", F.lit(0)) + F.col("copied")) >= min_sites).select("line"))
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                       band: float = BAND) -> DataFrame:
    """The documents, all columns, with ``text`` freed of boilerplate, and two
    more: n_lines (not blank) and n_removed (see ``added_names``)."""
    bad = staged(boilerplate(docs, site, min_sites, band), "boilerplate")
    row, found = free_name(docs, "_row"), free_name(docs, "_bad")
    n_lines, n_removed = added_names(docs)
    key = F.xxhash64("doc_id", "text")
    has = (docs.select(key.alias(row), F.explode(F.array_distinct(_hashes(F.col("text")))).alias("line"))
           .join(bad, "line").groupBy(row).agg(F.collect_set("line").alias(found)))
    line_key = _key
    kept = F.filter(_lines(F.col("text")),
                    lambda x: ~F.coalesce(F.array_contains(found, line_key(x)), F.lit(False)))
    gone = F.size(F.filter(_hashes(F.col("text")), lambda h: F.array_contains(found, h)))
    names = [F.array_join(kept, "\n").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return (docs.withColumn(row, key).join(has, row, "left")
            .withColumn(found, F.coalesce(found, F.array().cast("array<long>")))
            .select(*names, F.coalesce(F.size(_hashes(F.col("text"))), F.lit(0)).cast("long").alias(n_lines),
                    F.greatest(F.coalesce(gone, F.lit(0)), F.lit(0)).cast("long").alias(n_removed)))


def added_names(docs: DataFrame) -> tuple[str, str]:
    """What ``remove_boilerplate`` calls its two counts."""
    return free_name(docs, "n_lines"), free_name(docs, "n_removed")


def query(spark, sf_dir: str) -> DataFrame:
    """op7: all documents without cross-site boilerplate lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")
