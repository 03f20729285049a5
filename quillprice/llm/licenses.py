"""License scans (DataFrame functions only).

A header is a run of lines that speak of licences: lines with a cue word, and
between or beside them lines most of whose words occur in the templates. The
run, each of its lines with a cue, windows of its words around each cue word, and
each template is a sparse TF-IDF vector over its words; a passage has the licence
of the template with the largest cosine, if that reaches ``THRESHOLD`` and the
passage has the words that tell this licence from its like. So a notice is found
on a line or in a paragraph of other words. A file's own licence is that of its
best passage.

A file is a licence file if its name says so and it has a licence, or if
licensed passages make up at least ``SHARE`` of its words. A directory has the licence of its best licence
file. A file without a licence of its own inherits that of the nearest ancestor
directory that has one: the distinct directories are joined, by each of their
ancestor paths, to the licensed directories, and the deepest one wins.

Ties go to the smaller licence name. Null text has no passage; a null path lies
in the root. Repeated rows are scanned alike; an empty table gives no rows.
Other columns are carried.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillprice.llm.license_templates import BARS, OTHER_GNU, RUN_BARS, TEMPLATES, TOKEN, telling
from quillprice.session import materialize

THRESHOLD = 0.6
SHARE = 1.0
LINE_SHARE = 0.8
LINE_WORDS = 3
NOTICE = 16             #: a run of at most so many words that has a licence as it stands is one notice
SMALL = 16              #: up to so many words, windows have the size of each template and begin at every word
LARGER = (20, 24, 32, 40, 56, 72, 96, 128, 176, 240)
CUE = (r"(?i)licen[cs]e|copyright|copyleft|redistribut|warrant|all rights reserved|public domain|spdx"
       r"|creative ?commons|\bcc[ -](by|0)|\bcc0\b|\b[al]?gpl")
CUE_WORD = (r"licen[cs]e|copyright|copyleft|redistribut|warrant|^reserved$|^domain$|spdx|commons$|^cc0?$"
            r"|^[al]?gpl")
LICENCE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"


def template_weights(templates=TEMPLATES) -> tuple[list[tuple], dict[str, float], float]:
    """(template, licence, word, weight / norm) rows; the idf of each word; that of any other word.

    The idf counts licences, so that the forms of one licence do not make its own words common.
    """
    counts = [(name, Counter(re.findall(TOKEN, text.lower()))) for name, text in templates]
    names = len({name for name, _ in counts})
    df = Counter(w for _, w in {(name, w) for name, c in counts for w in c})
    idf = {w: math.log((1 + names) / (1 + n)) + 1 for w, n in df.items()}
    rows = []
    for i, (name, c) in enumerate(counts):
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in c.items()))
        rows += [(i, name, w, n * idf[w] / norm) for w, n in sorted(c.items())]
    return rows, idf, math.log(1 + names) + 1


def _marked(rows: list[tuple], templates) -> list[tuple]:
    """The rows with (needed or not, barred or not, words needed in all, what bars the licence, words in all).

    Barred words come as rows without weight.
    """
    told = [telling(name, text) for name, text in templates]
    sizes = [len(re.findall(TOKEN, text.lower())) for _, text in templates]
    out = [(i, name, w, weight, int(w in told[i][0]), 0, len(told[i][0]), BARS.get(name), sizes[i])
           for i, name, w, weight in rows]
    return out + [(i, name, w, 0.0, 0, 1, len(told[i][0]), BARS.get(name), sizes[i])
                  for i, (name, _) in enumerate(templates) for w in sorted(told[i][1])]


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _window_sizes(templates) -> list[int]:
    sizes = {len(re.findall(TOKEN, text.lower())) for _, text in templates}
    return sorted(n for n in sizes if 1 < n <= SMALL) + [n for n in LARGER if n <= max(sizes, default=0)]


def _windows(tokens: Column, sizes: list[int]) -> Column:
    """(start, size) of the windows around each cue word: one size after the other, from each ``step``-th word."""
    total = F.size(tokens)
    cues = F.filter(F.transform(tokens, lambda w, i: F.when(w.rlike(CUE_WORD), i)), lambda i: i.isNotNull())

    def of_size(n: int) -> Column:
        step = 1 if n <= SMALL else n // 8
        near = F.transform(cues, lambda c: F.sequence(
            (F.ceil(F.greatest(c - n + 1, F.lit(0)) / step) * step).cast("int"), c, F.lit(step)))
        starts = F.array_distinct(F.transform(F.flatten(near), lambda p: F.least(p, total - n)))
        return (F.when(total > n, F.transform(starts, lambda p: F.struct(p.alias("start"), F.lit(n).alias("size"))))
                 .otherwise(F.array().cast("array<struct<start:int,size:int>>")))

    return F.concat(*[of_size(n) for n in sizes])


def passages(files: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(file, words, at, bars, total, unit, window, tokens): the runs of the files that have a cue anywhere.

    The units of a run are the whole run, each of its lines with a cue, and windows of its words around each cue
    word (``window``), of about the size of each template. ``words`` and ``total``: words of the file and of the
    run. ``bars``: what bars a licence: those of the words that the run has, and whether the unit names another GNU
    licence than the general one.
    """
    # One literal each: an array of hundreds of them is slow to plan.
    vocabulary = F.split(F.lit(" ".join(sorted(template_weights(templates)[1]))), " ")
    bars = F.split(F.lit(" ".join(sorted(set(RUN_BARS.values())))), " ")

    def speaks(line: Column, least: int = LINE_WORDS) -> Column:
        kinds = F.array_distinct(_tokens(line))
        known = F.size(F.array_intersect(kinds, vocabulary))
        return line.rlike(CUE) | ((F.size(kinds) >= least) & (known >= LINE_SHARE * F.size(kinds)))

    # Every other line becomes a mark; what stands between marks is a run. Lines of fewer words, or none,
    # do not end a run if all of them are known, but a run neither begins nor ends with such a line.
    runs = F.split(F.array_join(F.transform(F.split("text", "\n"),
                                            lambda x: F.when(speaks(x, 0), x).otherwise(F.lit("\u0001"))), "\n"),
                   "\u0001")
    flags = F.transform("lines", lambda x: speaks(x))
    first = F.array_position(flags, True).cast("int")
    last = F.size("lines") + 1 - F.array_position(F.reverse(flags), True).cast("int")
    lines = F.slice("lines", first, last - first + 1)
    run = F.array_join("lines", "\n")
    none = F.lit(None).cast("int")
    # With the word before the window, which may be a part of the name.
    start = F.greatest("of.start", F.lit(1))
    named = F.array_join(F.when(F.col("of.passage").isNull(), F.slice("all", start, F.col("of.size") + 1))
                          .otherwise(_tokens(F.col("of.passage"))), " ")
    units = F.array_distinct(F.concat(F.array(run), F.filter("lines", lambda x: x.rlike(CUE))))
    return (files.filter(F.col("text").rlike(CUE))
                 .select("file", F.size(_tokens(F.col("text"))).alias("words"), F.posexplode(runs).alias("at", "run"))
                 .filter(F.col("run").rlike(CUE))
                 .select("file", "words", "at", F.split("run", "\n").alias("lines"))
                 .select("file", "words", "at", lines.alias("lines"))
                 .select("file", "words", "at",
                         _tokens(run).alias("all"), units.alias("units"))
                 .select("file", "words", "at", "all", "units",
                         _windows(F.col("all"), _window_sizes(templates)).alias("near"))
                 .select("file", "words", "at", "all", F.concat_ws(" ", F.array_intersect("all", bars)).alias("bars"),
                         F.concat(F.transform("units", lambda u: F.struct(u.alias("passage"), none.alias("start"),
                                                                          none.alias("size"))),
                                  F.transform("near", lambda x: F.struct(F.lit(None).cast("string").alias("passage"),
                                                                         x["start"].alias("start"),
                                                                         x["size"].alias("size")))).alias("units"))
                 # Windows are cut after they are exploded, so that no row holds the words of all of them. The outer
                 # form has no inferred filter, which would repeat all of the expressions above in itself.
                 .select("file", "words", "at", "all", "bars", F.posexplode_outer("units").alias("unit", "of"))
                 .select("file", "words", "at",
                         F.concat_ws(" ", "bars", F.when(named.rlike(OTHER_GNU), "other_gnu")).alias("bars"),
                         F.size("all").alias("total"), "unit", F.col("of.passage").isNull().alias("window"),
                         F.when(F.col("of.passage").isNull(), F.slice("all", F.col("of.start") + 1, F.col("of.size")))
                          .otherwise(_tokens(F.col("of.passage"))).alias("tokens")))


def own_licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(file, license, score, share) of the files with a licensed passage.

    ``share``: words in licensed passages among all words of the file.
    """
    spark: SparkSession = files.sparkSession
    rows, idf, other = template_weights(templates)
    # Both tables come from the fixed list of templates, so they are small whatever the input.
    weights = F.broadcast(spark.createDataFrame(
        _marked(rows, templates), "template int, license string, word string, weight double, need int, bar int, "
                                  "needs int, bar_word string, template_size int"))
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "w string, idf double"))
    unit = ["file", "words", "at", "bars", "total", "unit", "window", "size"]
    words = (passages(files, templates)
             .select(*unit[:-1], F.size("tokens").alias("size"), F.explode("tokens").alias("word"))
             .groupBy(*unit, "word").agg(F.count(F.lit(1)).alias("n"))
             .join(known, F.col("word") == F.col("w"), "left")
             .withColumn("v", F.col("n") * F.coalesce("idf", F.lit(other))))
    norms = words.groupBy("file", "at", "unit").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    # A window is there for the templates of about its size.
    alike = ~F.col("window") | F.when(F.col("size") <= SMALL, F.col("size") == F.col("template_size")).otherwise(
        F.col("template_size").between(0.8 * F.col("size"), 1.25 * F.col("size")))
    dots = (words.join(weights.withColumnRenamed("word", "t"), (F.col("word") == F.col("t")) & alike)
                 .groupBy(*unit, "template", "license")
                 .agg(F.sum(F.col("v") * F.col("weight")).alias("dot"), F.sum("need").alias("need"),
                      F.max("bar").alias("bar"), F.max("needs").alias("needs"), F.max("bar_word").alias("bar_word"))
                 .filter((F.col("need") == F.col("needs")) & (F.col("bar") == 0)
                         & ~F.coalesce(F.col("bars").contains(F.col("bar_word")), F.lit(False))))
    scored = (dots.join(norms, ["file", "at", "unit"])
                  .withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
                  .groupBy(*unit).agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
                  .filter(-F.col("best.minus") >= threshold))
    # A short run with a licence is one notice and is taken as it stands. A run counts once, with its longest
    # licensed unit.
    stands = F.min("window").over(Window.partitionBy("file", "at"))
    scored = (scored.withColumn("stands", ~stands & (F.col("total") <= NOTICE))
                    .filter(~(F.col("stands") & F.col("window"))))
    runs = scored.groupBy("file", "words", "at").agg(F.min("best").alias("best"), F.max("size").alias("size"))
    return (runs.groupBy("file", "words")
                .agg(F.min("best").alias("best"), F.sum("size").alias("licensed"))
                .select("file", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score"),
                        (F.col("licensed") / F.col("words")).alias("share")))


def _directory(path: Column) -> Column:
    """The directory of a path, without a final slash; the root is ''."""
    return F.regexp_replace(F.coalesce(path, F.lit("")), "/?[^/]*$", "")


def _ancestors(directory: Column) -> Column:
    """The directory and all above it up to the root."""
    parts = F.split(directory, "/")
    return F.when(directory == "", F.array(F.lit(""))).otherwise(F.concat(
        F.array(F.lit("")),
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` without text, with license, score, origin (own, inherited, none) and licensed_from.

    Columns of these four names are replaced.
    """
    # The other columns travel as one struct, so that their names meet no others.
    new = ("license", "score", "origin", "licensed_from")
    rest = [c for c in files.columns if c not in (*new, "path", "text")]
    rows = files.select(F.struct("path", *rest).alias("row"), "path", "text", F.xxhash64("path", "text").alias("file"))
    found = materialize(own_licences(rows.select("file", "text").dropDuplicates(["file"]), templates, threshold),
                        "licences").withColumnRenamed("file", "f")
    marked = materialize(rows.join(found, F.col("file") == F.col("f"), "left")
                             .select("row", "license", "score", "share", _directory(F.col("path")).alias("dir")),
                         "licence-files")
    licence_files = marked.filter(F.col("license").isNotNull()
                                  & (F.coalesce(F.col("row.path").rlike(LICENCE_NAMES), F.lit(False))
                                     | (F.col("share") >= SHARE)))
    best = F.min(F.struct((-F.col("score")).alias("minus"), "license"))
    licensed = materialize(licence_files.groupBy(F.col("dir").alias("at")).agg(best.alias("best")), "licensed-dirs")
    above = (marked.select("dir").dropDuplicates()
                   .select("dir", F.explode(_ancestors(F.col("dir"))).alias("ancestor")))
    nearest = materialize(
        above.join(licensed, F.col("ancestor") == F.col("at"))
             .groupBy("dir").agg(F.max_by(F.struct("ancestor", "best"), F.length("ancestor")).alias("near"))
             .select(F.col("dir").alias("d"), "near.*"), "nearest-dirs")
    mine = F.col("license").isNotNull()
    inherits = ~mine & F.col("d").isNotNull()
    out = marked.join(nearest, F.col("dir") == F.col("d"), "left")
    return out.select(*[F.col(f"row.`{c}`") for c in ("path", *rest)],
                      F.when(mine, F.col("license")).otherwise(F.col("best.license")).alias("license"),
                      F.when(mine, F.col("score")).otherwise(-F.col("best.minus")).alias("score"),
                      F.when(mine, "own").when(inherits, "inherited").otherwise("none").alias("origin"),
                      F.when(inherits, F.col("ancestor")).alias("licensed_from"))
