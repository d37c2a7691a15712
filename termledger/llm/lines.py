"""Removal of lines that many sites share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termledger.llm.common import broadcast_if_small
from termledger.session import StepFolder

#: Sites that must share a line before it is boilerplate.
MIN_SITES = 8
#: Logarithm of the sketch's registers; the relative standard error is 1.04 / sqrt(2 ** LG).
LG = 12
#: Standard errors around the threshold within which sites are counted exactly.
BAND = 4.0


def line_key(line: Column) -> Column:
    """Key of a line without its outer white space; null for a blank line."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(docs: DataFrame, folder, text_col: str, site_col: str, min_sites: int) -> DataFrame:
    """Keys (line) of lines that at least ``min_sites`` sites share.

    One sketch of sites per line, merged by aggregation: partial sketches combine
    before the shuffle, so a line that is everywhere sends one sketch a task. A
    line whose estimate lies outside the band around the threshold is decided by
    it, the others by an exact count of their (line, site) pairs.
    """
    lines = docs.select(
        F.col(site_col).alias("site"), F.explode(F.split(F.col(text_col), "\n", -1)).alias("line")
    ).select("site", line_key(F.col("line")).alias("line")).where("line is not null and site is not null")
    width = BAND * 1.04 / math.sqrt(2**LG) * min_sites + 0.5
    sketched = lines.groupBy("line").agg(F.hll_sketch_agg("site", LG).alias("sketch"), F.count(F.lit(1)).alias("n"))
    estimated = folder.write(
        sketched.where(F.col("n") >= min_sites)
        .select("line", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites - width)
    )
    sure = estimated.where(F.col("sites") > min_sites + width).select("line")
    near = estimated.where(F.col("sites") <= min_sites + width).select("line")
    exact = (
        lines.join(broadcast_if_small(near, near.count()), "line", "left_semi")
        .distinct()
        .groupBy("line")
        .count()
        .where(F.col("count") >= min_sites)
        .select("line")
    )
    return sure.unionAll(exact)


def dedup_lines(
    docs: DataFrame,
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``docs`` with the columns ``clean_text``, ``n_lines`` and ``n_removed``
    added (replacing columns of these names); the lines that many sites share
    are gone from ``clean_text``.

    Lines end at a line feed and are compared without outer white space; blank
    lines always stay. A null text stays null with no lines; a document without
    a site loses shared lines, but doesn't count as a site. Repeated rows and ids
    change nothing: what a document loses follows from its text alone. Other
    columns stay, whatever their names.

    Texts meet the shared lines they hold by digest, in one shuffle of the texts
    at every size. The planner may not broadcast that side: it grows with the
    documents. A text that very many rows repeat is a large partition of the
    row side, which adaptive execution splits.
    """
    folder = StepFolder(docs.sparkSession, "lines", keep=True)
    docs = docs.drop("clean_text", "n_lines", "n_removed")
    shared = folder.write(boilerplate(docs, folder, text_col, site_col, min_sites))
    text = F.col(text_col)
    keys = F.array_distinct(F.transform(F.split(text, "\n", -1), line_key))
    hits = (
        docs.select(F.xxhash64(text).alias("digest"), F.explode(keys).alias("line"))
        .join(broadcast_if_small(shared, shared.count()), "line", "left_semi")
        .distinct()
    )
    hits = folder.write(hits.groupBy("digest").agg(F.collect_list("line").alias("shared")))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64(text).alias("digest"))
    return _cleaned(rows.join(hits.hint("merge"), "digest", "left"), F.col("doc")[text_col])


def _cleaned(rows: DataFrame, text: Column) -> DataFrame:
    """Rows (doc, shared) without the shared lines, if any."""
    split = F.split(text, "\n", -1)
    kept = F.filter(split, lambda line: ~F.coalesce(F.array_contains("shared", line_key(line)), F.lit(False)))
    touched = F.col("shared").isNotNull()
    done = rows.select("doc", F.size(split).alias("lines"), F.when(touched, kept).alias("kept"))
    changed = F.col("kept").isNotNull() & (F.size("kept") < F.col("lines"))
    return done.select(
        "doc.*",
        F.when(changed, F.array_join("kept", "\n")).otherwise(text).alias("clean_text"),
        F.when(text.isNull(), 0).otherwise(F.col("lines")).cast("long").alias("n_lines"),
        F.when(changed, F.col("lines") - F.size("kept")).otherwise(0).cast("long").alias("n_removed"),
    )
