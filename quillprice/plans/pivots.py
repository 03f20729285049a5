"""Competitor and retail price pivots (X10, X11) and the wide join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.functions.pricing import exact_avg
from quillprice.operators.aggregates import fixed_pivot_avg

# The pivot column lists of the reference, in its order.
COMPETITORS = ["DOR", "VDO", "GAT", "GIL", "GPD", "MEI", "SNT", "SPI", "TAP", "UAC", "USM"]
RETAILERS = ["AZR", "ADV", "ORY", "NAP", "PBR", "PAG", "ROC", "SMR", "AMZ"]
NON_STOCK_PREFIX = "N"


def own_part_filter(col: str):
    """NOT LIKE 'N%' (NULL dropped)."""
    return ~F.col(col).startswith(NON_STOCK_PREFIX)


def competitor_rows(sheet: DataFrame, xref: DataFrame) -> DataFrame:
    """Sheet prices of listed competitors mapped to own parts."""
    x = xref.select(F.col("XMfg").alias("__xx"), "CompPart", "FS_Part")
    rows = (sheet.filter((F.col("PriceWD") != 0) & F.col("XMfg").isin(*COMPETITORS))
                 .join(x, (sheet["XMfgPart"] == x["CompPart"]) & (sheet["XMfg"] == x["__xx"]))
                 .filter(own_part_filter("FS_Part")))
    return rows.select("FS_Part", F.col("XMfg").alias("CompXMfg"), "PriceWD")


def competitor_avg(sheet: DataFrame, xref: DataFrame) -> DataFrame:
    """AVG(PriceWD) per (own part, competitor)."""
    rows = competitor_rows(sheet, xref)
    return rows.groupBy("FS_Part", "CompXMfg").agg(
        exact_avg(F.col("PriceWD"), rows.schema["PriceWD"].dataType).alias("WDPrice"))


def competitor_price_pivot(sheet: DataFrame, xref: DataFrame) -> DataFrame:
    """One row per own part, one column per competitor.

    Each pivot cell of the reference averages exactly one per-(part,
    competitor) average, so pivoting the sheet rows directly gives the same
    cells with one aggregation instead of two.
    """
    return fixed_pivot_avg(competitor_rows(sheet, xref), "FS_Part", "CompXMfg", COMPETITORS, "PriceWD")


def retail_price_pivot(prices: DataFrame, retailer_col: str = "RetailXmfg") -> DataFrame:
    """One row per base part, one column per listed retailer.

    ``prices`` is the comparison output; the reference reads the retailer
    column under another name (SURVEY Q24), hence ``retailer_col``.
    """
    rows = prices.filter(own_part_filter("BasePart")).select(
        "BasePart", F.col(retailer_col).alias("RETAIL_XMFG"), "AvgPrice")
    return fixed_pivot_avg(rows, "BasePart", "RETAIL_XMFG", RETAILERS, "AvgPrice")


def wide_pivot_join(current: DataFrame, comp_pivot: DataFrame, retail_pivot: DataFrame,
                    part_col: str = "PartNumber") -> DataFrame:
    """J19 (dormant in the reference): current prices LEFT JOIN both pivots."""
    j = (current.join(comp_pivot, current[part_col] == comp_pivot["FS_Part"], "left")
                .join(retail_pivot, current[part_col] == retail_pivot["BasePart"], "left"))
    return j.select(*[current[c] for c in current.columns],
                    *[comp_pivot[c] for c in COMPETITORS], *[retail_pivot[c] for c in RETAILERS])
