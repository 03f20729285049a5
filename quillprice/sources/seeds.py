"""Pre-existing targets for the incremental pipelines, derived from the feeds.

The reference updates registries and a competitor sheet that already hold
data. These seeds build such a state from the older part of each feed, so the
pipelines see both known and new keys (see FIXTURES.md §B).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.functions import dates, text
from quillprice.operators.windows import global_row_number

REGISTRY_CUTOFF = "1998-01-01 00:00:00"
SHEET_CUTOFF = "2000-01-01 00:00:00"
HELD_BACK_BRAND = "Brand#25"
ALT_CODES = ("HDC", "ACI", "PRO", "DOR")


def _registered_rows(feed: DataFrame) -> DataFrame:
    return feed.filter(
        (F.col("DATE_CREATED") < dates.load_stamp(REGISTRY_CUTOFF)) & (F.col("PRICE") > 0)
        & text.not_blank(F.col("PRODUCTBRAND")) & (F.col("PRODUCTBRAND") != HELD_BACK_BRAND))


def seed_brand_registry(feed: DataFrame) -> DataFrame:
    brands = _registered_rows(feed).select(F.col("RETAIL_XMFG").alias("RetailXmfg"),
                                           "PRODUCTBRAND").distinct()
    numbered = global_row_number(brands, ["RetailXmfg", "PRODUCTBRAND"], "BrandID")
    brand_no = F.substring("PRODUCTBRAND", 7, 100).cast("int") % 4
    alt = F.when(brand_no == 0, ALT_CODES[0]).when(brand_no == 1, ALT_CODES[1]) \
           .when(brand_no == 2, ALT_CODES[2]).otherwise(ALT_CODES[3])
    return numbered.select(
        "BrandID", "RetailXmfg", "PRODUCTBRAND",
        F.upper(F.regexp_replace("PRODUCTBRAND", "#", "")).alias("CLEANPRODUCTBRAND"),
        alt.alias("AltXmfg"))


def seed_part_registry(feed: DataFrame, brands: DataFrame) -> DataFrame:
    parts = (_registered_rows(feed).filter(text.not_blank(F.col("PRODUCTNUMBER")))
             .select("RETAIL_XMFG", "PRODUCTBRAND", "PRODUCTNUMBER", "PRODUCTNAME").distinct())
    b = brands.select("BrandID", F.col("RetailXmfg").alias("__x"), F.col("PRODUCTBRAND").alias("__b"))
    return parts.join(b, (parts["RETAIL_XMFG"] == b["__x"]) & (parts["PRODUCTBRAND"] == b["__b"])) \
                .select("BrandID", "PRODUCTNUMBER", F.col("PRODUCTNAME").alias("PartName"),
                        text.clean_part_number(F.col("PRODUCTNUMBER")).alias("CLEANPRODUCTNUMBER"))


def seed_competitor_sheet(feed: DataFrame, line_map: DataFrame) -> DataFrame:
    """One sheet row per (competitor, clean part) seen before the cutoff."""
    lines = line_map.filter(F.col("Xmfg").isNotNull())
    old = (feed.filter(F.col("Date_Created") < dates.load_stamp(SHEET_CUTOFF))
               .join(lines, feed["MFRLINE"] == lines["mfrline"])
               .withColumn("__clean", text.clean_part_number(F.col("PARTNO"))))
    last = F.max("Date_Created")
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    return old.groupBy("__clean", F.col("Xmfg").alias("XMfg")).agg(
        (F.year(last) * 10000 + F.month(last) * 100 + F.dayofmonth(last)).cast("int").alias("psID"),
        null_s.alias("XREFGroup"), null_s.alias("XMfgPartCategory"),
        F.max("DESCRIP").alias("XMfgPartType"), null_s.alias("XMfgSKU"),
        null_s.alias("XMfgPartSuper"), null_s.alias("XMfgPartSuperClean"),
        F.max("POPCODE").alias("XMfgPOP"), F.max("UOM1").alias("XMfgUOM"),
        F.to_date(last).alias("DateEffective"), null_d.alias("CoreCharge"),
        F.lit("WD Gross").alias("AcquisitionType"),
        F.max("WD1").cast("double").alias("PriceAcquistion"),
        F.max("JOBBER1").cast("double").alias("PriceJobber"),
        F.max("WD1").cast("double").alias("PriceWD"),
        null_d.alias("PriceList"), null_d.alias("PriceRetail"), null_d.alias("PriceProgramStart"),
        last.alias("PS_Date_Created"),
    ).select("psID", "XREFGroup", "XMfgPartCategory", "XMfgPartType", "XMfg", "XMfgSKU",
             F.col("__clean").alias("XMfgPart"), F.col("__clean").alias("XMfgPartClean"),
             "XMfgPartSuper", "XMfgPartSuperClean", "XMfgPOP", "XMfgUOM", "DateEffective",
             "CoreCharge", "AcquisitionType", "PriceAcquistion", "PriceJobber", "PriceWD",
             "PriceList", "PriceRetail", "PriceProgramStart", "PS_Date_Created")
