"""Stored states that a new batch is merged into (X6, X10 without reading all rows again).

Two results of the procedures are statistics over tables that only grow or change
in few rows: the latest-day statistics of the retail feed, and the averages of the
competitor pivot. Each has a small stored state from which it follows exactly:

* ``shop_state``: one row per raw part, own clean key, newest day and zip code, with
  the sums, counts and extremes of its priced feed rows. States merge in any order
  and any number of times. The registry is applied to the state, not to the feed, so a
  part that gets its clean key later counts from its first batch on.
* ``pivot_cells``: one row per (own part, competitor) with exact sum and count. Rows that
  the upsert replaces are subtracted with their old price and added with their new one.

Sums are decimals, so neither the order of the batches nor a retraction leaves a trace.
Rows with a NULL day are in no state (they are on no latest day); a NULL zip code
counts in prices and not in shops; NULL parts and keys are groups of their own; states of empty tables are empty; a batch
that is merged twice counts twice (``sources.runs`` merges each run id once).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillprice.functions import dates
from quillprice.functions.collation import union_into
from quillprice.functions.pricing import AVG_DECIMALS
from quillprice.plans import competitor, pivots, retail
from quillprice.session import materialize

#: What a clean key follows from: the registry's keys, and the clean key a feed row came with.
RAW_KEYS = ["RETAIL_XMFG", "PRODUCTBRAND", "PRODUCTNUMBER", "CLEANPRODUCTBRAND", "CLEANPRODUCTNUMBER"]
CELL = ["FS_Part", "CompXMfg"]


def _exact(c: Column, kind: T.DataType) -> Column:
    """The value as ``exact_avg`` sums it, wide enough for every sum of sums."""
    scale = kind.scale if isinstance(kind, T.DecimalType) else AVG_DECIMALS
    return c.cast(f"decimal(28,{scale})").cast(f"decimal(38,{scale})")


def _mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n)


# --- retail feed -------------------------------------------------------------------

def shop_state(feed: DataFrame) -> DataFrame:
    """The state of a batch of the retail feed; parts that a batch names often are combined map-side."""
    kinds = {f.name: f.dataType for f in feed.schema.fields}
    rows = (feed.filter((F.col("PRICE") > 0) & F.col("RETAIL_XMFG").isNotNull())
                .withColumn("Day", dates.day_of(F.col("DATE_CREATED"))).filter(F.col("Day").isNotNull()))
    return rows.groupBy(*RAW_KEYS, "Day", "ZIPCODE").agg(
        F.min("PRICE").alias("MinPrice"), F.max("PRICE").alias("MaxPrice"),
        F.sum(_exact(F.col("PRICE"), kinds["PRICE"])).alias("PriceSum"), F.count("PRICE").alias("PriceCnt"),
        F.sum(_exact(F.col("COREPRICE"), kinds["COREPRICE"])).alias("CoreSum"), F.count("COREPRICE").alias("CoreCnt"))


def _totals() -> list[Column]:
    return [F.min("MinPrice").alias("MinPrice"), F.max("MaxPrice").alias("MaxPrice"),
            *[F.sum(c).alias(c) for c in ("PriceSum", "PriceCnt", "CoreSum", "CoreCnt")]]


def merge_shop_states(*states: DataFrame) -> DataFrame:
    """One state of several; days before a raw part's newest are dropped, as they can never count again.

    A clean key's latest day is the newest day of all raw parts that map to it, so a raw
    part's older days are on no latest day, whatever the registry says later. The newest
    days are stored and joined back: small ones are broadcast, otherwise AQE splits a part with
    many rows.
    """
    rows = reduce(union_into, states)
    newest = materialize(rows.groupBy(*[F.col(k).alias(f"__{k}") for k in RAW_KEYS]).agg(F.max("Day").alias("__day")),
                         "newest-days")
    same = [rows[k].eqNullSafe(newest[f"__{k}"]) for k in RAW_KEYS] + [rows["Day"] == newest["__day"]]
    return (rows.join(newest, same).select(*[rows[c] for c in states[0].columns])
                .groupBy(*RAW_KEYS, "Day", "ZIPCODE").agg(*_totals()).select(*states[0].columns))


def last_shop_stats(state: DataFrame, view: DataFrame) -> DataFrame:
    """A06 + A07 from the state: as ``retail.last_shop_stats`` of all feed rows under this registry."""
    keyed = (retail.enrich_clean_keys(state, view)
             .filter(F.col("CLEANPRODUCTBRAND").isNotNull() & F.col("CLEANPRODUCTNUMBER").isNotNull()))
    per_day = keyed.groupBy(*retail.KEYS, F.col("Day").alias("LastShop")).agg(
        *_totals(), F.countDistinct("ZIPCODE").alias("ShopCnt"))
    newest = F.max("LastShop").over(Window.partitionBy(*retail.KEYS))
    last = per_day.withColumn("__newest", newest).filter(F.col("LastShop") == F.col("__newest"))
    return last.select(*retail.KEYS, "LastShop", F.col("MinPrice").cast("double").alias("MinPrice"),
                       F.col("MaxPrice").cast("double").alias("MaxPrice"),
                       _mean(F.col("PriceSum"), F.col("PriceCnt")).alias("AvgPrice"),
                       _mean(F.col("CoreSum"), F.col("CoreCnt")).alias("AvgCore"), "ShopCnt")


# --- competitor pivot ----------------------------------------------------------------

def pivot_cells(sheet: DataFrame, xref: DataFrame) -> DataFrame:
    """Sum and count of each cell of the competitor pivot, from the whole sheet."""
    rows = pivots.competitor_rows(sheet, xref)
    price = _exact(F.col("PriceWD"), rows.schema["PriceWD"].dataType)
    return rows.groupBy(*CELL).agg(F.sum(price).alias("Total"), F.count("PriceWD").alias("N"))


def sheet_changes(sheet: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sheet rows that M04 takes away for a batch, and those that it puts in (replaced rows are in both)."""
    keys = batch.select(competitor.text.clean_part_number(F.col("PARTNO")).alias("__uk"),
                        F.col("XMfg").alias("__ux")).distinct()
    gone = sheet.join(keys, (sheet["XMfgPartClean"] == keys["__uk"]) & (sheet["XMfg"] == keys["__ux"]), "left_semi")
    put = union_into(competitor.updated_rows(sheet, batch), competitor.inserted_rows(batch, sheet))
    return gone.select(*competitor.SHEET_COLUMNS), put


def change_cells(cells: DataFrame, gone: DataFrame, put: DataFrame, xref: DataFrame) -> DataFrame:
    """The cells after rows went and came; only these rows are joined to the cross reference.

    ``cells`` must be those of the same cross reference (``xref_mark``). A cell without rows goes.
    """
    minus = pivot_cells(gone, xref).select(*CELL, (-F.col("Total")).cast(cells.schema["Total"].dataType).alias("Total"),
                                           (-F.col("N")).alias("N"))
    rows = union_into(union_into(cells, pivot_cells(put, xref)), minus)
    return (rows.groupBy(*CELL).agg(F.sum("Total").alias("Total"), F.sum("N").alias("N"))
                .filter(F.col("N") != 0).select(*cells.columns))


def competitor_price_pivot(cells: DataFrame) -> DataFrame:
    """X10 / A10 from the cells: as ``pivots.competitor_price_pivot`` of the whole sheet."""
    means = cells.select(*CELL, _mean(F.col("Total"), F.col("N")).alias("Mean"))
    return means.groupBy("FS_Part").pivot("CompXMfg", pivots.COMPETITORS).agg(F.max("Mean"))


def xref_mark(xref: DataFrame) -> str:
    """A mark of the cross reference that cells were made with: its number of rows and sum of row hashes.

    It does not depend on the order of the rows. Cells with another mark are made anew.
    """
    row = F.xxhash64("XMfg", "CompPart", "FS_Part").cast("decimal(38,0)")
    made = xref.agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("h")).first()
    return f"{made['n']}:{made['h'] or 0}"
