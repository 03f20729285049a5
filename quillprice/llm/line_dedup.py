"""Line dedup by distinct-site spread.

A line (split at line feeds, trimmed of blanks, tabs and carriage returns) that
stands on at least ``MIN_SITES`` sites is cross-site boilerplate and is removed
from every document, whatever its length or script. Only blank lines always stay.

1. Each line hash gets a HyperLogLog sketch of its sites; sketches are built
   where the lines are read and merged by aggregation.
2. A line whose estimate is further from the threshold than ``BAND_ERRORS`` standard
   errors of the sketch (and at least 2) is decided by it. Lines nearer than that
   get an exact distinct count of their sites.
3. Occurrences of boilerplate are found by a join on the hash, and a document
   with hits is rebuilt without them. Only hashes, positions and sites travel;
   the text moves once, to meet its document's hits.

The site is ``source``; null is a site of its own. Null text has no lines and
stays null. A line is blank if no word is in it. Repeated rows are cleaned alike. An empty
table gives no rows. Other columns are carried by ``remove_boilerplate``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillprice.llm.common import WORD
from quillprice.session import materialize

MIN_SITES = 5
BAND_ERRORS = 5
SKETCH_BITS = 10
BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """Hash of a line that may be boilerplate; null of a blank line."""
    return F.when(line.rlike(WORD), F.xxhash64(F.btrim(line, F.lit(BLANKS))))


def sketch_band(min_sites: int, bits: int = SKETCH_BITS) -> int:
    """How far from the threshold an estimate must be to decide: the error of a sketch grows with what it counts."""
    return max(2, math.ceil(BAND_ERRORS * 1.04 / math.sqrt(2 ** bits) * min_sites))


def occurrences(docs: DataFrame) -> DataFrame:
    """(id, row, site, at, line): hashes of the lines that may be boilerplate; ``row`` is a hash of the text."""
    # The text is hashed once, before its lines are taken apart, and not again for each of them.
    hashed = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("row"),
                         F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("site"), "text")
    lines = hashed.select("id", "row", "site", F.posexplode(_lines(F.col("text"))).alias("at", "text"))
    return lines.select("id", "row", "site", "at", _key(F.col("text")).alias("line")).filter("line IS NOT NULL")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(line): hashes of the lines on at least ``min_sites`` sites, stored."""
    band = sketch_band(min_sites)
    spread = materialize(lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"))
                              .select("line", F.hll_sketch_estimate("sketch").alias("sites"))
                              .filter(F.col("sites") >= min_sites - band), "line-spread")
    sure = spread.filter(F.col("sites") > min_sites + band).select("line")
    near = spread.filter(F.col("sites") <= min_sites + band).select(F.col("line").alias("n"))
    # Distinct (line, site) pairs are collapsed before they are shuffled, so a very frequent line is no hot key.
    exact = (lines.select("line", "site").join(near, F.col("line") == F.col("n"), "left_semi")
                  .dropDuplicates().groupBy("line").agg(F.count(F.lit(1)).alias("sites"))
                  .filter(F.col("sites") >= min_sites).select("line"))
    return materialize(sure.union(exact), "boilerplate")


def hits(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(__id, __row, __cut): positions of the boilerplate lines of each document that has any."""
    lines = materialize(occurrences(docs), "lines")
    bad = boilerplate(lines, min_sites).select(F.col("line").alias("b"))
    return (lines.join(bad, F.col("line") == F.col("b"), "left_semi")
                 .groupBy(F.col("id").alias("__id"), F.col("row").alias("__row"))
                 .agg(F.collect_set("at").alias("__cut")))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and n_lines and n_removed.

    Columns of these two names are replaced.
    """
    found = materialize(hits(docs, min_sites), "line-hits")
    # The whole row travels as one struct, so that its column names meet no others.
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64("text").alias("row"))
    joined = rows.join(found, F.col("doc.doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")), "left")
    cut, text = F.coalesce("__cut", F.array().cast("array<int>")), F.col("doc.text")
    # The positions that stay come from one hashed set difference, and the lines are split once (bound to a
    # variable of the outer transform), so the work is linear in the lines.
    stay = F.array_except(F.sequence(F.lit(0), F.size(_lines(text)) - 1), cut)
    kept = F.transform(F.array(_lines(text)), lambda lines: F.array_join(
        F.transform(stay, lambda i: F.element_at(lines, i + 1)), "\n"))[0]
    clean = F.when(F.size(cut) == 0, text).otherwise(kept)
    count = F.when(text.isNull(), 0).otherwise(F.size(_lines(text)))
    return joined.select(*[clean.alias(c) if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns
                           if c not in ("n_lines", "n_removed")],
                         count.cast("long").alias("n_lines"), F.size(cut).cast("long").alias("n_removed"))
