"""Cross-site boilerplate lines, by how many distinct sites a line occurs on.

Each distinct line gets a HyperLogLog sketch of its sites; sketches of parts of the corpus
merge by aggregation. Far from the threshold the estimate decides. Near it, within
``BAND`` standard errors and more, the sites of the line are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.session import stage

#: A line on so many distinct sites is boilerplate and goes everywhere.
MIN_SITES = 8
LG_K = 12
#: Relative distance from the threshold inside which sites are counted exactly. A sketch
#: with 2^12 registers has a standard error of 1.04 / 64, so this is six of them.
BAND = 0.1


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, "[ \\t\\r]+", " "))


def _marks(line: Column) -> Column:
    """128 bits of a normalised line."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(line, F.lit(7)).alias("h2"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _eligible(line: Column) -> Column:
    return line != ""


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(h1, h2)`` of the lines of ``(h1, h2, site)`` that occur on at least ``min_sites``."""
    estimates = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"))
    estimates = stage(estimates.where(F.col("sites") >= min_sites * (1 - BAND)), "line-sites")
    far = estimates.where(F.col("sites") > min_sites * (1 + BAND)).select("h1", "h2")
    near = estimates.where(F.col("sites") <= min_sites * (1 + BAND)).select("h1", "h2")
    exact = (
        lines.join(near, ["h1", "h2"], "left_semi")
        .select("h1", "h2", "site")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count("site").alias("n"))
        .where(F.col("n") >= min_sites)
        .select("h1", "h2")
    )
    return far.unionByName(exact)


def without_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``(doc_id, text, n_lines, n_removed, clean)`` for each row of ``docs``.

    A line is compared after runs of blanks, tabs and carriage returns became one blank; it
    is removed from every document that has it. Rows without a site add no site but are
    cleaned. A line may be of any length and script; lines of white space stay. NULL text
    stays NULL with no lines. Rows that share an id, or have none, are rows of their own. An
    empty table gives no rows; other columns are not read.
    """
    # A document is known by its id; without one by its text, so that such rows do not meet.
    key = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.concat(F.lit("text "), F.xxhash64("text").cast("string")))
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(site).cast("string").alias("site"), "text")
    marks = F.array_distinct(
        F.transform(F.filter(F.transform(_lines(F.col("text")), normal), _eligible), _marks)
    )
    lines = stage(narrow.select(key.alias("key"), "site", F.explode(marks).alias("m")).select("key", "site", "m.*"), "lines")
    bad = (
        lines.join(boilerplate(lines, min_sites), ["h1", "h2"], "left_semi")
        .groupBy("key")
        # No more marks than the document has lines.
        .agg(F.collect_set(F.struct("h1", "h2")).alias("bad"))
    )
    joined = narrow.withColumn("key", key).join(bad, "key", "left")
    kept = F.filter(
        _lines(F.col("text")), lambda x: ~(_eligible(normal(x)) & F.array_contains(F.col("bad"), _marks(normal(x))))
    )
    return joined.select(
        "doc_id", "text", F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).alias("n_lines"),
        F.when(F.col("bad").isNull(), _lines(F.col("text"))).otherwise(kept).alias("left"),
    ).select(
        "doc_id", "text", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("bigint").alias("n_lines"),
        F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size("left")).cast("bigint").alias("n_removed"),
        F.array_join("left", "\n").alias("clean"),
    )
