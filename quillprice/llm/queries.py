"""One query per operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillprice.llm import alignment, bpe, language, licenses, quality
from quillprice.llm.common import table
from quillprice.llm.exact_dedup import exact_groups
from quillprice.llm.line_dedup import remove_boilerplate
from quillprice.llm.mixing import document_copies
from quillprice.llm.negatives import mine
from quillprice.llm.neighbors import nearest
from quillprice.llm.pii import KINDS, personal_data
from quillprice.llm.simhash import near_duplicates
from quillprice.llm.warc import read_archives, write_archives


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to source weights: words taken per document."""
    mixed = document_copies(table(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT a.*, (SELECT sum(source_size) FROM per_source) AS total,
         (SELECT coalesce(sum(3 * b.source_size), 0) FROM per_source b
          WHERE b.source_size * a.w < a.source_size * b.w) AS capped,
         (SELECT sum(b.w) FROM per_source b WHERE b.source_size * a.w >= a.source_size * b.w) AS open_w
  FROM per_source a),
targets AS (
  SELECT source, source_size,
         least(CAST(3 * source_size AS DOUBLE),
               w * (SELECT max(CAST(total - capped AS DOUBLE) / open_w) FROM levels)) AS target,
         CAST('0x' || substr(md5('mix:' || coalesce(source, '') ||
              CASE WHEN source IS NULL THEN 'true' ELSE 'false' END), 1, 6) AS BIGINT) AS u
  FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size * 16777216) AS BIGINT) ELSE 0 END AS e,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS i
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (((i * e + u) >> 24) - (((i - 1) * e + u) >> 24)) AS BIGINT) AS taken
FROM placed
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the groups linked within the error."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages to WARC archives and read the archives back."""
    return read_archives(write_archives(table(spark, sf_dir, "pages"))).drop("url")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents."""
    return bpe.digests(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return language.identify_all(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, each a file in a directory of its source."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000).cast("string"),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents; the largest doc_id stays."""
    return exact_groups(table(spark, sf_dir, "documents"))


OP8_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that stand on many sites."""
    clean = remove_boilerplate(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_removed",
                        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
bad AS (
  SELECT k FROM keyed
  WHERE regexp_matches(k, '[^\x20\x09-\x0D]')
  GROUP BY k HAVING count(DISTINCT coalesce('s' || source, '')) >= 5),
cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(bad.k) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.k IS NULL), '') AS body
  FROM keyed LEFT JOIN bad ON keyed.k = bad.k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(body, '')) AS text_sha256
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id
"""


def op10_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows by inner product of every row whose vec_id 20 divides."""
    return nearest(table(spark, sf_dir, "embeddings"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents; the counts are those of the base spans."""
    found = personal_data(table(spark, sf_dir, "documents"))

    def spelled(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(spelled("base").cast("binary"), 256).alias("base_sha256"),
                        spelled("spans").alias("spans"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the tokens that two vocabularies cut all documents into."""
    return alignment.align(table(spark, sf_dir, "documents"))[0]


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose vec_id 100 divides."""
    return mine(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, other AS positive, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.positive AS positive_id,
       CAST(row_number() OVER nearest AS INTEGER) AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW nearest AS (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other)
QUALIFY row_number() OVER nearest <= 5
"""


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_licenses": op7_licenses,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_neighbors": op10_neighbors,
    "op11_pii": op11_pii,
    "op12_alignment": op12_alignment,
    "op13_negatives": op13_negatives,
}

ORACLE = {
    "op1_mixing": OP1_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op13_negatives": OP13_SQL,
}
