"""Query registry: SURVEY §2 key -> (Spark query, DuckDB oracle SQL).

Each Spark callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole fixture tables derived from that scale factor. ``ORACLE`` holds the
independent SQL for the same key; keys absent there get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillprice.sources.fixtures import LOAD_TS, Fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
RAW_QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Keys whose result carries DECIMAL columns (exact inputs passed through).
# Results are compared as DOUBLE on both engines: a Spark decimal and a DuckDB
# decimal of the same value can render differently (scale, float conversion).
# tests/test_oracle.py keeps this list in sync with the Spark schemas.
DECIMAL_OUTPUTS: dict[str, tuple[str, ...]] = {
    "update_enrich_clean_keys": ("PRICE", "COREPRICE"),
    "join_self_latest": ("PRICE", "COREPRICE"),
    "filter_positive": ("PRICE", "COREPRICE"),
    "filter_ne_3vl": ("PRICE", "COREPRICE"),
    "filter_in_on_clause": ("WD1", "JOBBER1"),
    "filter_gt_scalar": ("WD1", "JOBBER1"),
    "join_left_match_flag": ("WD1", "JOBBER1"),
    "staged_reuse": ("WD1", "JOBBER1"),
    "project_star_plus": ("WD1", "JOBBER1"),
    "filter_not_null": ("WD1", "JOBBER1"),
    "tsv_price_sheet_load": ("Gross_Price", "Core_Price"),
    "landing_trim": ("Gross_Price", "Core_Price"),
    "update_column_in_place": ("Gross_Price", "Core_Price"),
    "trim": ("Gross_Price", "Core_Price"),
    "landing_reload": ("Gross_Price", "Core_Price"),
    "join_rules_3way": ("Gross_Price", "Jobber", "Multiplier", "Dealer", "Percent_of_WD"),
    "multi_db_read": ("Gross_Price", "Jobber", "Multiplier", "Dealer", "Percent_of_WD"),
    "derived_table": ("Price",),
    "join_left_xref": ("Price",),
    "cast_float_numeric": ("Value",),
    "cast_text_number": ("InfoNumeric",),
    "join_left_competitor_price": ("Percent_of_WD",),
    "filter_expr_not_null": ("Percent_of_WD",),
}


# Means of means: a sum of doubles depends on its order, so both engines show them
# at eight decimals. The operators return them unrounded.
MEAN_DECIMALS = 8
MEAN_OUTPUTS: dict[str, tuple[str, ...]] = {
    key: ("AZR", "ADV", "ORY", "NAP", "PBR", "PAG", "ROC", "SMR", "AMZ")
    for key in ("pivot_retail", "retail_price_pivot", "wide_pivot_join")}


def as_shown(key: str, df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F
    shown = as_double(df)
    return shown.withColumns({c: F.round(c, MEAN_DECIMALS) for c in MEAN_OUTPUTS.get(key, ())})


def as_double(df: DataFrame) -> DataFrame:
    """DECIMAL result columns as DOUBLE (presentation only; values are exact)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _double_sql(key: str, sql: str) -> str:
    shown = [f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMAL_OUTPUTS.get(key, ())]
    shown += [f"round({c}, {MEAN_DECIMALS}) AS {c}" for c in MEAN_OUTPUTS.get(key, ())]
    if not shown:
        return sql
    casts = ", ".join(shown)
    return f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) presented"


def register(key: str, sql: str | None = None):
    def deco(fn: Callable[[Fixtures], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_shown(key, fn(Fixtures(spark, sf_dir)))
        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        RAW_QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def _load_all():
    # Importing the query modules fills the registry.
    from quillprice.plans import catalog  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: _double_sql(k, v) for k, v in ORACLE.items()}


__all__ = ["register", "queries", "oracle_sql", "LOAD_TS"]
