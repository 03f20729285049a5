"""Aggregation operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillprice.functions.pricing import exact, exact_avg


def price_sums(df: DataFrame, keys: list[str], price: str = "PRICE", core: str = "COREPRICE",
               zip_col: str = "ZIPCODE") -> DataFrame:
    """Extremes, exact sums and counts per key and zip code, one row each, for ``stats_of_sums``."""
    return df.groupBy(*keys, F.col(zip_col).alias("__zip")).agg(
        F.min(price).alias("__min"), F.max(price).alias("__max"),
        F.sum(exact(F.col(price), df.schema[price].dataType)).alias("__sum"), F.count(price).alias("__n"),
        F.sum(exact(F.col(core), df.schema[core].dataType)).alias("__core"), F.count(core).alias("__cores"))


def stats_of_sums(sums: DataFrame, keys: list[str]) -> DataFrame:
    """The statistics of ``price_stats`` from the rows of ``price_sums``."""
    def avg(total: str, n: str) -> Column:
        return F.when(F.sum(n) > 0, F.sum(total).cast("double") / F.sum(n))
    return sums.groupBy(*keys).agg(
        F.min("__min").cast("double").alias("MinPrice"), F.max("__max").cast("double").alias("MaxPrice"),
        avg("__sum", "__n").alias("AvgPrice"), avg("__core", "__cores").alias("AvgCore"),
        F.count("__zip").alias("ShopCnt"))


def price_stats(df: DataFrame, keys: list[str], price: str = "PRICE", core: str = "COREPRICE",
                zip_col: str = "ZIPCODE") -> DataFrame:
    """MIN/MAX/AVG price, AVG core price, COUNT(DISTINCT zip) per key."""
    return stats_of_sums(price_sums(df, keys, price, core, zip_col), keys)


def min_max_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """MIN(value), MAX(value) per key."""
    return df.groupBy(key).agg(F.min(value).alias("MinID"), F.max(value).alias("MaxID"))


def conditional_max(value: str, key: str, when_value: str) -> Column:
    """MAX(CASE key WHEN when_value THEN value END)."""
    return F.max(F.when(F.col(key) == F.lit(when_value), F.col(value)))


def fixed_pivot_avg(df: DataFrame, row_key: str, pivot_col: str, values: list[str],
                    value_col: str) -> DataFrame:
    """PIVOT (AVG(value) FOR pivot_col IN (values)) with a fixed column list.

    The explicit list avoids the extra job that discovers pivot values; a
    row whose pivot value is not listed still yields its row key (all NULL).
    """
    return (df.groupBy(row_key).pivot(pivot_col, values)
              .agg(exact_avg(F.col(value_col), df.schema[value_col].dataType)))
