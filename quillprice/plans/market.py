"""Price sheet procedure: staging (X1), matrix refresh (X2), upload queue.

Targets are never mutated: each step returns the new version of the target
(or the rows it would add), and the caller publishes it (SURVEY §1.5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.functions import text
from quillprice.functions.collation import union_into
from quillprice.operators.routines import PricingInputs, market_price_staging

MATRIX_COLUMNS = ("Brand", "Xmfg", "PartNumber", "Price_Type", "FS_WD", "PriceGroup", "CalcPrice",
                  "Perecnt_of_WD", "PriceDate", "ListPrice", "JobberPrice", "DealerPrice")
QUEUE_COLUMNS = ("Brand", "Item_Num", "Cust_Group", "Price_Per_Unit", "Eff_From", "Eff_Thru",
                 "Credit_Price", "User_Code", "User_Id", "Cust_Num", "Cur_Code", "UploadedDate",
                 "Uploaded")

# Fixed values of the upload layout (Bulk insert of new prices into the ERP queue).
UPLOAD_EFF_THRU = "2050-12-30"
UPLOAD_CONSTANTS = {"Credit_Price": "", "User_Code": "LEW", "User_Id": "OPER", "Cust_Num": "",
                    "Cur_Code": "USD"}
NEW_ITEM, PRICE_ADJUSTMENT = "New Item", "Price Adjustment"


def staging(inp: PricingInputs) -> DataFrame:
    return market_price_staging(inp)


# --- X2: matrix --------------------------------------------------------------------

def delete_matched_matrix(matrix: DataFrame, staging_df: DataFrame,
                          strict_brand: bool = False) -> DataFrame:
    """Drop matrix rows whose (part, price group) was priced in this run.

    The reference compares the matrix Brand with itself (SURVEY Q8), so every
    brand's row of that part and group goes, and only rows with a NULL Brand
    survive. ``strict_brand=True`` adds the evident intended Brand key.
    """
    key_cols = ["Cust_Part_Number", "PriceGroup"] + (["Brand"] if strict_brand else [])
    keys = staging_df.select(*[F.col(c).alias(f"__k_{c}") for c in key_cols]).distinct()
    cond = ((matrix["PartNumber"] == keys["__k_Cust_Part_Number"])
            & (matrix["PriceGroup"] == keys["__k_PriceGroup"])
            & matrix["Brand"].isNotNull())
    if strict_brand:
        cond = cond & (matrix["Brand"] == keys["__k_Brand"])
    return matrix.join(keys, cond, "left_anti")


def insert_matrix_rows(staging_df: DataFrame, matrix: DataFrame) -> DataFrame:
    """Distinct staging rows with no matrix row on (Brand, group, part).

    The reference keeps a staging row when the LEFT JOIN finds no row or finds
    one whose (non-key) Xmfg is NULL (SURVEY Q9). The matrix is first reduced
    to one row per key with a has-NULL-Xmfg flag, so the join cannot fan out.
    """
    m = (matrix.groupBy(F.col("PartNumber").alias("__p"), F.col("PriceGroup").alias("__g"),
                        F.col("Brand").alias("__b"))
               .agg(F.max(F.col("Xmfg").isNull().cast("int")).alias("__null_xmfg")))
    joined = staging_df.join(m, (staging_df["Cust_Part_Number"] == m["__p"])
                             & (staging_df["PriceGroup"] == m["__g"])
                             & (staging_df["Brand"] == m["__b"]), "left")
    missing = joined.filter(F.col("__b").isNull() | (F.col("__null_xmfg") == 1))
    return missing.select(
        "Brand", "Xmfg", F.col("Cust_Part_Number").alias("PartNumber"), "Price_Type", "FS_WD",
        "PriceGroup", "CalcPrice", F.col("Percent_of_WD").alias("Perecnt_of_WD"),
        F.col("LoadDate").alias("PriceDate"), F.col("PriceList").alias("ListPrice"),
        F.col("PriceJobber").alias("JobberPrice"), F.col("PriceDealer").alias("DealerPrice"),
    ).distinct()


def market_price_matrix_refresh(matrix: DataFrame, staging_df: DataFrame,
                                strict_brand: bool = False) -> DataFrame:
    """Delete then insert, as one new matrix version."""
    kept = delete_matched_matrix(matrix, staging_df, strict_brand).select(*MATRIX_COLUMNS)
    return union_into(kept, insert_matrix_rows(staging_df, kept))


# --- X3: upload queue --------------------------------------------------------------

def _pending_match(queue: DataFrame, staging_df: DataFrame):
    """Join condition of M06: RIGHT(item, LEN(item) - 3) = part (J12), same brand
    and group, same stored double price (J14), row not uploaded yet."""
    keys = staging_df.select(F.rtrim("Cust_Part_Number").alias("__part"),
                             F.col("Brand").alias("__brand"),
                             F.col("PriceGroup").alias("__group"),
                             F.col("CalcPrice").alias("__price")).distinct()
    part = F.rtrim(text.strip_prefix(queue["Item_Num"], 3))
    cond = ((part == keys["__part"]) & (queue["Brand"] == keys["__brand"])
            & (queue["Cust_Group"] == keys["__group"]) & (queue["Price_Per_Unit"] == keys["__price"])
            & (queue["Uploaded"] == F.lit("0")))
    return keys, cond


def pending_matches(queue: DataFrame, staging_df: DataFrame) -> DataFrame:
    """Queue rows the delete of M06 removes."""
    keys, cond = _pending_match(queue, staging_df)
    return queue.join(keys, cond, "left_semi")


def delete_pending_upload(queue: DataFrame, staging_df: DataFrame) -> DataFrame:
    """Drop not-yet-uploaded queue rows that this run prices identically."""
    keys, cond = _pending_match(queue, staging_df)
    return queue.join(keys, cond, "left_anti")


def upload_eligible(staging_df: DataFrame, calc: DataFrame) -> DataFrame:
    """P18 + S08: staging rows whose rule asks for an upload, in queue layout.

    The rule join is on (xmfg, Brand, PriceGroup), not unique when a customer
    rule has several base manufacturers, so duplicate rows are kept (Q23).
    """
    rules = calc.select(
        F.col("xmfg").alias("__x"), F.col("Brand").alias("__b"), F.col("PriceGroup").alias("__g"),
        "JDE_Upload", "PriceAdj_Upload")
    joined = staging_df.join(rules, (staging_df["Xmfg"] == rules["__x"])
                             & (staging_df["Brand"] == rules["__b"])
                             & (staging_df["PriceGroup"] == rules["__g"]))
    change = F.col("ChangeCode")
    eligible = joined.filter(((F.col("JDE_Upload") == "Y") & change.contains(NEW_ITEM))
                             | ((F.col("PriceAdj_Upload") == "Y") & change.contains(PRICE_ADJUSTMENT)))
    return eligible.select(
        "Brand", F.concat(F.col("Brand"), F.col("Cust_Part_Number")).alias("Item_Num"),
        F.col("PriceGroup").alias("Cust_Group"), F.col("CalcPrice").alias("Price_Per_Unit"),
        F.col("Effective_Date").alias("Eff_From"),
        F.lit(UPLOAD_EFF_THRU).cast("date").alias("Eff_Thru"),
        *[F.lit(v).alias(k) for k, v in UPLOAD_CONSTANTS.items()],
        F.col("LoadDate").alias("UploadedDate"), F.lit("0").alias("Uploaded"))


def upload_queue_refresh(queue: DataFrame, staging_df: DataFrame, calc: DataFrame) -> DataFrame:
    """Delete identical pending rows, then append the eligible new prices."""
    kept = delete_pending_upload(queue, staging_df).select(*QUEUE_COLUMNS)
    return union_into(kept, upload_eligible(staging_df, calc))
