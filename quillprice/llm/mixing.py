"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Targets. Sources ordered by code point (null last) weigh 1, 2, 3, 1, 2, 3, ...
and share the words of the whole corpus by weight. A target stops at
``max_repeat`` times its source's words, and what it cannot take is shared
again among the others. That is the water level L with
``sum(min(cap, L * weight)) = total``. The sum is the minimum, over the number
k of capped sources taken in order of cap / weight, of
``capped(k) + L * weight of the others``, so L is the largest of
``(total - capped(k)) / weight of the others``: one window over one row per source.

Sampling. Each document of a source is expected ``target / source words`` times.
The documents are put in the order (source, words, doc_id). The prefix sum of
expected copies, plus one offset per source drawn from a seeded hash, crosses
integers; a document is emitted once per integer crossed. Expected copies are
fixed-point integers (24 fractional bits), so the sums are exact and reruns
agree. Because neighbours in the order have similar lengths, the words taken
from a source differ from its target by about one document at most.

Null and odd input: a null source is a source of its own, the last one. Null
text has no words. Documents without words cross integers like any other and
add no words. A source without words has target 0 and gives no documents.
Repeated rows are separate documents. An empty table gives no rows. Other
columns of the input are carried by ``mix`` and otherwise not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillprice.llm.common import word_count
from quillprice.operators.windows import global_row_number
from quillprice.session import materialize

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix"
FRACTION_BITS = 24


def _offset(source: Column, seed: str) -> Column:
    """One offset in [0, 2^24) per source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")), source.isNull().cast("string"))
                   .cast("binary"))
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Add ``target`` (words, double) to one row per source (``source``, ``source_size``)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sources.withColumn(
        "__w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * max_repeat
    fill = Window.orderBy(cap / F.col("__w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum(cap).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    others = F.sum("__w").over(fill.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before).cast("double") / others
    return (ranked.withColumn("__level", level)
                  .withColumn("__level", F.max("__level").over(everything))
                  .withColumn("target", F.least(cap.cast("double"), F.col("__level") * F.col("__w")))
                  .drop("__w", "__level"))


def document_copies(docs: DataFrame, keys: list[str], weights=WEIGHTS, max_repeat: int = MAX_REPEAT,
                    seed: str = SEED) -> DataFrame:
    """One row per document: ``keys``, source, size, source_size, target, copies.

    ``keys`` are the columns kept as identity; the first one orders documents
    of equal size. Texts never leave the scan: only keys, source and size are
    shuffled.
    """
    slim = docs.select(*keys, "source", word_count().alias("size"))
    numbered = materialize(global_row_number(slim, ["source", "size", *keys], "__n"), "mix-order")
    sources = (numbered.groupBy("source")
                       .agg(F.sum("size").alias("source_size"), F.min("__n").alias("__first")))
    expected = F.floor(F.col("target") / F.col("source_size") * (1 << FRACTION_BITS)).cast("long")
    plan = materialize(
        source_targets(sources, weights, max_repeat).select(
            F.col("source").alias("__source"), "source_size", "target", "__first",
            F.when(F.col("source_size") > 0, expected).otherwise(F.lit(0).cast("long")).alias("__e"),
            _offset(F.col("source"), seed).alias("__u")), "mix-plan")
    # The plan has one row per source and is read back from its file, so the planner
    # knows its size: it is broadcast when small, and else a skewed source is split.
    joined = numbered.join(plan, numbered["source"].eqNullSafe(plan["__source"]))
    index = F.col("__n") - F.col("__first")
    crossed = [F.shiftright((index + k) * F.col("__e") + F.col("__u"), FRACTION_BITS) for k in (0, 1)]
    return (joined.withColumn("copies", crossed[1] - crossed[0])
                  .select(*keys, "source", "size", "source_size", "target", "copies"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each document as often as its copies, columns as in ``docs``.

    A document is found again by its doc_id and a hash of its row. Rows alike in
    every column share one such key and their copies are added up; they are
    collapsed by a partial aggregate before they are emitted.
    """
    # The whole row travels as one struct, so that its column names meet no others.
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64(*docs.columns).alias("row"))
    keys = rows.select("doc.doc_id", "doc.source", "doc.text", "row")
    copies = (document_copies(keys, ["doc_id", "row"], weights, max_repeat, seed)
              .groupBy(F.col("doc_id").alias("id"), F.col("row").alias("key"))
              .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("alike"))
              .filter("copies > 0"))
    copies = materialize(copies, "mix-copies")

    def emitted(found: DataFrame) -> DataFrame:
        return (found.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
                     .select("doc.*"))

    def found(own: DataFrame) -> DataFrame:
        # The copies grow with the documents, so they are never broadcast, small or not.
        return rows.join(own.hint("merge"), F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("key")))

    alike = (found(copies.filter("alike > 1")).groupBy("id", "row")
             .agg(F.first("doc").alias("doc"), F.first("copies").alias("copies")))
    return emitted(found(copies.filter("alike = 1"))).unionByName(emitted(alike))
