"""Declared-schema checks for the staging table.

Spark does not enforce NOT NULL or VARCHAR(n) when writing parquet, so the
staging constraints of the reference are checked explicitly: either as a
``Violations`` column (rows kept, reasons listed) or as a failing expression
(the job aborts, like the reference's INSERT would).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillprice.operators.routines import STAGING_COLUMNS

_SPARK_TYPES = {"string": T.StringType(), "double": T.DoubleType(),
                "timestamp_ntz": T.TimestampNTZType(), "date": T.DateType()}

STAGING_SCHEMA = T.StructType([
    T.StructField(name, _SPARK_TYPES[typ], not not_null)
    for name, typ, not_null, _ in STAGING_COLUMNS])


def violation_checks() -> list[tuple[str, Column]]:
    checks = []
    for name, _, not_null, max_len in STAGING_COLUMNS:
        if not_null:
            checks.append((f"{name} is null", F.col(name).isNull()))
        if max_len is not None:
            checks.append((f"{name} longer than {max_len}", F.length(F.col(name)) > max_len))
    return checks


def with_violations(df: DataFrame) -> DataFrame:
    """Adds ``Violations``: '; '-joined failed checks, NULL when the row is valid."""
    parts = [F.when(cond, F.lit(label)) for label, cond in violation_checks()]
    joined = F.concat_ws("; ", *parts)
    return df.withColumn("Violations", F.when(joined != "", joined))


def enforce_staging(df: DataFrame) -> DataFrame:
    """Fail the job on the first invalid row; otherwise return the rows unchanged."""
    bad = None
    for _, cond in violation_checks():
        c = F.coalesce(cond, F.lit(False))
        bad = c if bad is None else bad | c
    first = STAGING_COLUMNS[0][0]
    guarded = F.when(bad, F.raise_error(F.lit("staging row violates its declared schema"))) \
               .otherwise(F.col(first))
    return df.withColumn(first, guarded.cast("string"))
