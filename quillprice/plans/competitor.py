"""Competitor price feed: high-water gate (X13) and incremental upsert.

The gate compares the newest feed stamp with the newest stamp already in the
sheet; only strictly newer rows are loaded (late rows are never loaded, as in
the reference). The upsert returns the new sheet version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.functions import dates, text
from quillprice.functions.collation import union_into
from quillprice.session import materialize

SHEET_COLUMNS = ("psID", "XREFGroup", "XMfgPartCategory", "XMfgPartType", "XMfg", "XMfgSKU",
                 "XMfgPart", "XMfgPartClean", "XMfgPartSuper", "XMfgPartSuperClean", "XMfgPOP",
                 "XMfgUOM", "DateEffective", "CoreCharge", "AcquisitionType", "PriceAcquistion",
                 "PriceJobber", "PriceWD", "PriceList", "PriceRetail", "PriceProgramStart",
                 "PS_Date_Created")
# Fixed value: acquisition type of rows loaded from the feed.
ACQUISITION_TYPE = "WD Gross"


def mapped_feed(feed: DataFrame, line_map: DataFrame) -> DataFrame:
    """Feed rows whose line maps to a competitor code (P10, P22: filter inside ON)."""
    lines = line_map.filter(F.col("Xmfg").isNotNull()).select(F.col("mfrline").alias("__line"), "Xmfg")
    return feed.join(lines, feed["MFRLINE"] == lines["__line"]).drop("__line")


def high_water_marks(feed: DataFrame, line_map: DataFrame, sheet: DataFrame) -> DataFrame:
    """One row (new_mark, old_mark, go).

    Both maxima come from one global aggregate over a tagged union (partial
    aggregation per task, one row out), so no join of two scalars is needed.
    ``go`` is NULL when the sheet is empty (SURVEY Q16).
    """
    stamps = (mapped_feed(feed, line_map).select(F.col("Date_Created").alias("__ts"),
                                                 F.lit(True).alias("__new"))
              .unionByName(sheet.select(F.col("PS_Date_Created").alias("__ts"),
                                        F.lit(False).alias("__new"))))
    marks = stamps.agg(F.max(F.when(F.col("__new"), F.col("__ts"))).alias("new_mark"),
                       F.max(F.when(~F.col("__new"), F.col("__ts"))).alias("old_mark"))
    return marks.withColumn("go", F.col("new_mark") > F.col("old_mark"))


def staged_batch(feed: DataFrame, line_map: DataFrame, after) -> DataFrame:
    """The CTE of the reference: rows newer than ``after`` with parsed fields."""
    rows = mapped_feed(feed, line_map)
    if after is not None:
        stamp = after.isoformat(sep=" ") if hasattr(after, "isoformat") else str(after)
        rows = rows.filter(F.col("Date_Created") > F.lit(stamp).cast("timestamp_ntz"))
    return rows.select(
        "MFRLINE", "MFRNAME", dates.yyyymmdd_int(F.col("Date_Created")).alias("new_psID"),
        dates.parse_us_date(F.col("PSDATE")).alias("PSDATE"), "PARTNO", "DESCRIP", "POPCODE",
        "UOM1", "WD1", "JOBBER1", F.col("Xmfg").alias("XMfg"),
        F.col("Date_Created").alias("CreatDate"))


def match_flags(batch: DataFrame, sheet: DataFrame) -> DataFrame:
    """The staging table of the reference.

    batch.* plus renamed sheet columns from a LEFT JOIN on (competitor, clean
    part number); ``Flag`` is the matched clean key, NULL for new parts.

    Here and below the clean number is a column before the join and comes first
    among the keys: sorts then compare a stored value that is nearly unique, not
    one of a few competitor codes and then a number cleaned anew at each comparison.
    """
    s = sheet.select(
        F.col("XMfg").alias("XMfg_2"), F.col("XMfgPartClean").alias("Flag"), "XMfgUOM", "XMfgPOP",
        "PriceWD", "AcquisitionType", "PriceJobber", "PriceList", "PriceRetail",
        F.col("psID").alias("old_psID"), "CoreCharge", "DateEffective", "XMfgPartType",
        "XMfgPartCategory", "XREFGroup")
    rows = batch.withColumn("__clean", text.clean_part_number(F.col("PARTNO")))
    return rows.join(s, (rows["__clean"] == s["Flag"]) & (rows["XMfg"] == s["XMfg_2"]), "left").drop("__clean")


def inserted_rows(batch: DataFrame, sheet: DataFrame) -> DataFrame:
    """Batch rows with no sheet row for their key, in sheet layout (no de-duplication)."""
    keys = sheet.select(F.col("XMfg").alias("__sx"), F.col("XMfgPartClean").alias("__sk"))
    rows = batch.withColumn("__clean", text.clean_part_number(F.col("PARTNO")))
    new = rows.join(keys, (rows["__clean"] == keys["__sk"]) & (rows["XMfg"] == keys["__sx"]), "left_anti")
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    return new.select(
        F.col("new_psID").alias("psID"), null_s.alias("XREFGroup"), null_s.alias("XMfgPartCategory"),
        F.col("DESCRIP").alias("XMfgPartType"), "XMfg", null_s.alias("XMfgSKU"),
        F.col("PARTNO").alias("XMfgPart"), F.col("__clean").alias("XMfgPartClean"),
        null_s.alias("XMfgPartSuper"), null_s.alias("XMfgPartSuperClean"),
        F.col("POPCODE").alias("XMfgPOP"), F.col("UOM1").alias("XMfgUOM"),
        F.col("PSDATE").alias("DateEffective"), null_d.alias("CoreCharge"),
        F.lit(ACQUISITION_TYPE).alias("AcquisitionType"),
        F.col("WD1").cast("double").alias("PriceAcquistion"),
        F.col("JOBBER1").cast("double").alias("PriceJobber"),
        F.col("WD1").cast("double").alias("PriceWD"), null_d.alias("PriceList"),
        null_d.alias("PriceRetail"), null_d.alias("PriceProgramStart"),
        F.col("CreatDate").alias("PS_Date_Created"))


def latest_per_key(batch: DataFrame) -> DataFrame:
    """One batch row per (competitor, clean part): latest stamp, then highest price,
    then the other fields (SURVEY Q11). A MAX over a struct is a partial
    aggregate, so a hot key is combined map-side instead of sorted in one task.
    """
    best = F.max(F.struct("CreatDate", "WD1", "JOBBER1", "PARTNO", "DESCRIP", "POPCODE", "UOM1",
                          "PSDATE", "new_psID")).alias("__best")
    return (batch.groupBy(text.clean_part_number(F.col("PARTNO")).alias("__uk"),
                          F.col("XMfg").alias("__ux"))
                 .agg(best).select("__ux", "__uk", "__best.*"))


def updated_rows(sheet: DataFrame, batch: DataFrame) -> DataFrame:
    """Matched sheet rows with their nine columns taken from the batch."""
    best = latest_per_key(batch)
    cond = (sheet["XMfgPartClean"] == best["__uk"]) & (sheet["XMfg"] == best["__ux"])
    return sheet.join(best, cond).select(
        *[{"psID": best["new_psID"].alias("psID"),
           "XMfgPartType": best["DESCRIP"].alias("XMfgPartType"),
           "XMfgPOP": best["POPCODE"].alias("XMfgPOP"),
           "XMfgUOM": best["UOM1"].alias("XMfgUOM"),
           "DateEffective": best["PSDATE"].alias("DateEffective"),
           "PriceAcquistion": best["WD1"].cast("double").alias("PriceAcquistion"),
           "PriceJobber": best["JOBBER1"].cast("double").alias("PriceJobber"),
           "PriceWD": best["WD1"].cast("double").alias("PriceWD"),
           "PS_Date_Created": best["CreatDate"].alias("PS_Date_Created")}.get(c, sheet[c])
          for c in SHEET_COLUMNS])


def upsert_competitor(sheet: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert unmatched batch rows, update nine columns of matched sheet rows."""
    # distinct first: a part repeated across much of the batch becomes one key
    keys = batch.select(text.clean_part_number(F.col("PARTNO")).alias("__uk"),
                        F.col("XMfg").alias("__ux")).distinct()
    untouched = sheet.join(keys, (sheet["XMfgPartClean"] == keys["__uk"])
                           & (sheet["XMfg"] == keys["__ux"]), "left_anti")
    kept = union_into(untouched.select(*SHEET_COLUMNS), updated_rows(sheet, batch))
    return union_into(kept, inserted_rows(batch, sheet))


def gated_batch(feed: DataFrame, line_map: DataFrame, sheet: DataFrame,
                bootstrap: bool = False) -> DataFrame | None:
    """The batch the gate lets through, or None when the gate is closed.

    The gate is a driver-side decision on one aggregated row. An empty sheet
    has no mark and loads nothing unless ``bootstrap`` is set (Q16).
    """
    m = high_water_marks(feed, line_map, sheet).first()
    if m["old_mark"] is None and bootstrap:
        return staged_batch(feed, line_map, None)
    if not m["go"]:
        return None
    return staged_batch(feed, line_map, m["old_mark"])


def competitor_incremental_upsert(feed: DataFrame, line_map: DataFrame, sheet: DataFrame,
                                  bootstrap: bool = False) -> DataFrame:
    """Gate on the high-water marks, then upsert the newer rows.

    The batch is stored after the gate, as the reference stages it: the feed is
    read twice in all (gate, batch), however often the upsert uses the batch.
    """
    batch = gated_batch(feed, line_map, sheet, bootstrap)
    if batch is None:
        return sheet.select(*SHEET_COLUMNS)
    return upsert_competitor(sheet, materialize(batch, "competitor-batch"))
