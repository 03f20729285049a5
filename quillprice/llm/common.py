"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillprice.session import scratch_path

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def word_count(name: str = "text") -> Column:
    """Number of words as long; null text has none."""
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(id_name: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_name).cast("string"), F.lit("")).cast("binary")) % divisor


def shared_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder as a URI that pyarrow can open."""
    path = scratch_path(spark, name)
    if path.startswith("/"):
        return f"file://{path}"
    if path.startswith("file:") and not path.startswith("file://"):
        return f"file://{path[len('file:'):]}"
    return path
