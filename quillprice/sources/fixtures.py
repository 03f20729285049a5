"""Adapters: reference-shaped input tables derived from the testdata tables.

Every adapter is a projection (sometimes after a join, distinct or grouping)
of ``part`` or ``lineitem``, so its size grows with the scale factor. The
column expressions are written in the common subset of Spark SQL and DuckDB
SQL; the Spark side applies them with ``selectExpr`` and the DuckDB oracle
repeats them verbatim as CTEs (``fixture_cte``). Only the rule tables and two
small code lists are literal.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One load stamp per run: the reference stamps NOW() per statement.
LOAD_TS = "2017-09-04 17:53:00"

_OWN_PART = "CASE WHEN p_partkey % 11 = 0 THEN 'N' ELSE 'P' END || CAST(p_partkey AS STRING)"
# Prices carry four decimals, halves of a cent included, so that any rounding shows.
_GROSS = ("CAST(CAST(p_size AS DECIMAL(7,2)) + CAST(p_partkey % 100 AS DECIMAL(7,2)) "
          "* CAST(0.01 AS DECIMAL(3,2)) + CAST(p_partkey % 4 AS DECIMAL(7,4)) "
          "* CAST(0.0025 AS DECIMAL(5,4)) AS DECIMAL(18,6))")
_LINE_PRICE = ("CAST(CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(l_partkey % 97 AS DECIMAL(7,4)) "
               "* CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(12,4))")
_RETAILER = ("CASE l_suppkey % 10 WHEN 0 THEN 'AZR' WHEN 1 THEN 'ADV' WHEN 2 THEN 'ORY' "
             "WHEN 3 THEN 'NAP' WHEN 4 THEN 'PBR' WHEN 5 THEN 'PAG' WHEN 6 THEN 'ROC' "
             "WHEN 7 THEN 'SMR' WHEN 8 THEN 'AMZ' ELSE 'XXX' END")
_COMP_CODE = ("CASE p_partkey % 4 WHEN 0 THEN 'HDC' WHEN 1 THEN 'ACI' WHEN 2 THEN 'PRO' "
              "ELSE 'DOR' END")
_PARTNO = "CAST(100 + l_partkey AS STRING)"


@dataclass(frozen=True)
class Adapter:
    source: str                       # testdata table the rows come from
    columns: tuple[tuple[str, str], ...]


ADAPTERS: dict[str, Adapter] = {
    # price sheet landing rows
    "ps_load": Adapter("part", (
        ("xmfg", "'W' || CAST(p_partkey % 3 AS STRING)"),
        ("Cust_Part_Number", _OWN_PART),
        ("Gross_Price", _GROSS),
        ("POP_Code", "' ' || substr(p_type, 1, 1) || ' '"),
        ("Change_Code", "CASE WHEN p_partkey % 4 = 0 THEN 'New Item' WHEN p_partkey % 4 = 1 "
                        "THEN 'Price Adjustment' WHEN p_partkey % 4 = 2 THEN "
                        "'New Item; Price Adjustment' ELSE 'No Change' END"),
        ("Core_Price", "CASE WHEN p_partkey % 5 = 0 THEN CAST(NULL AS DECIMAL(18,6)) "
                       "ELSE CAST(p_partkey % 7 AS DECIMAL(18,6)) END"),
        ("Price_Sheet_Number", "'PS' || CAST(p_partkey % 3 AS STRING)"),
        ("Effective_Date", "DATE '2017-09-01'"),
    )),
    "base_ranks": Adapter("part", (
        ("BasePart", _OWN_PART),
        ("Group1", "CASE WHEN p_partkey % 5 = 0 THEN 'Washer Pump' WHEN p_partkey % 5 = 1 "
                   "THEN 'Heater Cores' WHEN p_partkey % 5 = 2 THEN 'Blower Motors' "
                   "WHEN p_partkey % 5 = 3 THEN 'Oil Coolers' ELSE 'Other' END"),
        ("LFC", "CAST(p_size AS STRING)"),
    )),
    "tax_pdm0": Adapter("part", (
        ("BasePart", _OWN_PART),
        ("PDM1", "p_brand"),
    )),
    "tax_pdm1": Adapter("part_brands", (
        ("PDM1", "p_brand"),
    )),
    "tax_setup": Adapter("part_brands", (
        ("PDM1", "p_brand"),
        ("SRP3", "CASE WHEN length(p_brand) = 7 THEN 'A08' WHEN p_brand = 'Brand#10' "
                 "THEN CAST(NULL AS STRING) ELSE 'B01' END"),
    )),
    "xref": Adapter("part", (
        ("XMfg", _COMP_CODE),
        ("CompPart", "CAST(100 + p_partkey AS STRING)"),
        ("CompClean", "upper(substr(p_type, 1, 2)) || CAST(100 + p_partkey AS STRING) || 'A'"),
        ("FS_Part", "CASE WHEN (p_partkey - p_partkey % 4) % 11 = 0 THEN 'N' ELSE 'P' END "
                    "|| CAST(p_partkey - p_partkey % 4 AS STRING)"),
        ("D_I", "CASE WHEN p_partkey % 2 = 0 THEN 'D' ELSE 'I' END"),
    )),
    "price_new": Adapter("part", (
        ("psID", "CAST(p_partkey % 8 AS BIGINT)"),
        ("XMfgPart", "CAST(100 + p_partkey AS STRING)"),
    )),
    "price_sheets": Adapter("part_sheet_ids", (
        ("psID", "CAST(ps AS BIGINT)"),
        ("XMfg", "CASE ps % 4 WHEN 0 THEN 'HDC' WHEN 1 THEN 'ACI' WHEN 2 THEN 'PRO' ELSE 'DOR' END"),
        ("SheetRank", "CAST(CASE WHEN ps < 6 THEN 1 ELSE 2 END AS INT)"),
    )),
    # ERP price file: item code = 3-char brand + optional filler zero + base part
    "price_file": Adapter("part", (
        ("BPLITM", "CASE WHEN p_partkey % 6 = 0 THEN '624' ELSE '625' END || CASE WHEN "
                   "p_partkey % 8 = 0 THEN '0' ELSE '' END || CAST(100 + p_partkey AS STRING) "
                   "|| '  '"),
        ("BPUPRC", "CAST(p_size AS BIGINT) * 10000 + (p_partkey % 100) * 100"),
        ("BPEFTJ", "CAST(117000 + p_size AS INT)"),
        ("BPEXDJ", "CAST(150364 AS INT)"),
        ("BPACRD", "CAST(0 AS INT)"),
        ("BPUSER", "'LOADER'"),
        ("BPUPMJ", "CAST(117200 + p_size AS INT)"),
        ("BPICID", "CAST(p_partkey % 10 AS BIGINT)"),
    )),
    "pack_lookup": Adapter("part", (
        ("Basepart", _OWN_PART),
        ("Info", "CAST(1 + p_partkey % 4 AS STRING)"),
        ("Type", "CASE WHEN p_partkey % 7 = 0 THEN 'Other' ELSE 'Standard/MinimumOrderQuantity' END"),
    )),
    # retail shop survey feed (lineitem joined to part)
    "retail_import": Adapter("lineitem_part", (
        ("RETAIL_XMFG", _RETAILER),
        ("PRODUCTBRAND", "CASE WHEN l_partkey % 50 = 0 THEN '  ' ELSE p_brand END"),
        ("PRODUCTNUMBER", "upper(substr(p_type, 1, 2)) || '-' || CAST(100 + l_partkey AS STRING) "
                          "|| '/ .A'"),
        ("PRODUCTNAME", "p_name"),
        ("PRICE", f"CASE WHEN l_linenumber = 7 THEN CAST(0 AS DECIMAL(12,4)) ELSE {_LINE_PRICE} END"),
        ("COREPRICE", "CASE WHEN l_discount > 0.05 THEN CAST(NULL AS DECIMAL(12,4)) "
                      "ELSE CAST(CAST(l_linenumber AS DECIMAL(7,4)) + CAST(l_partkey % 9 AS DECIMAL(7,4)) "
                      "* CAST(0.0005 AS DECIMAL(5,4)) AS DECIMAL(12,4)) END"),
        ("ZIPCODE", "CAST(10000 + l_orderkey % 50 AS STRING)"),
        ("DATE_CREATED", "CAST(CAST(substr(CAST(l_shipdate AS STRING), 1, 4) || '-06-15' AS DATE) "
                         "AS TIMESTAMP) + CASE WHEN l_linenumber % 2 = 0 THEN INTERVAL '10' HOUR "
                         "ELSE INTERVAL '15' HOUR END"),
        ("CLEANPRODUCTBRAND", "CAST(NULL AS STRING)"),
        ("CLEANPRODUCTNUMBER", "CAST(NULL AS STRING)"),
    )),
    # competitor price feed (lineitem); odd lines carry a dirty part number
    "comp_feed": Adapter("lineitem", (
        ("MFRLINE", "'L' || CAST(l_suppkey % 13 AS STRING)"),
        ("MFRNAME", "'Line ' || CAST(l_suppkey % 13 AS STRING)"),
        ("PSDATE", "CAST(month(l_shipdate) AS STRING) || '/' || CAST(dayofmonth(l_shipdate) AS "
                   "STRING) || '/' || CAST(year(l_shipdate) AS STRING)"),
        ("PARTNO", f"CASE WHEN l_linenumber % 2 = 0 THEN {_PARTNO} ELSE substr({_PARTNO}, 1, 1) "
                   f"|| '-' || substr({_PARTNO}, 2) || ' .' END"),
        ("DESCRIP", "'line ' || CAST(l_linenumber AS STRING)"),
        ("POPCODE", "CASE WHEN l_quantity > 25 THEN 'A' ELSE 'B' END"),
        ("UOM1", "'EA'"),
        ("WD1", _LINE_PRICE),
        ("JOBBER1", f"CAST({_LINE_PRICE} + CAST(l_linenumber AS DECIMAL(12,4)) AS DECIMAL(12,4))"),
        ("Date_Created", "l_shipdate"),
    )),
    "comp_xref": Adapter("lineitem_lines", (
        ("XMfg", "CASE line WHEN 0 THEN 'DOR' WHEN 1 THEN 'VDO' WHEN 2 THEN 'GAT' WHEN 3 THEN 'GIL' "
                 "WHEN 4 THEN 'GPD' WHEN 5 THEN 'MEI' WHEN 6 THEN 'SNT' WHEN 7 THEN 'SPI' WHEN 8 "
                 "THEN 'TAP' WHEN 9 THEN 'UAC' WHEN 10 THEN 'USM' ELSE 'ZZZ' END"),
        ("CompPart", "CAST(100 + l_partkey AS STRING)"),
        ("FS_Part", "CASE WHEN l_partkey % 11 = 0 THEN 'N' ELSE 'P' END || CAST(l_partkey AS STRING)"),
    )),
    "oe_list": Adapter("part", (
        ("Manufacturer", "p_brand"),
        ("PartNumber", "p_type || CAST(p_partkey AS STRING)"),
    )),
    # current market price matrix: one row per part
    "matrix": Adapter("part", (
        ("Brand", "CASE WHEN p_partkey % 15 = 0 THEN CAST(NULL AS STRING) WHEN p_partkey % 2 = 0 "
                  "THEN 'BR1' ELSE 'BRX' END"),
        ("Xmfg", "CASE WHEN p_partkey % 9 = 0 THEN CAST(NULL AS STRING) ELSE 'F0' END"),
        ("PartNumber", _OWN_PART),
        ("Price_Type", "'WD'"),
        ("FS_WD", "CAST(NULL AS DOUBLE)"),
        ("PriceGroup", "CASE WHEN p_partkey % 4 = 0 THEN 'G99' ELSE 'G01' END"),
        ("CalcPrice", "CAST(1.25 AS DOUBLE)"),
        ("Perecnt_of_WD", "CAST(NULL AS DOUBLE)"),
        ("PriceDate", "CAST(TIMESTAMP '2017-01-01 00:00:00' AS TIMESTAMP)"),
        ("ListPrice", "CAST(NULL AS DOUBLE)"),
        ("JobberPrice", "CAST(NULL AS DOUBLE)"),
        ("DealerPrice", "CAST(NULL AS DOUBLE)"),
    )),
    # ERP upload queue: one row per part; odd keys carry a stale price
    "upload_queue": Adapter("part", (
        ("Brand", "'BR1'"),
        ("Item_Num", "'BR1' || " + _OWN_PART),
        ("Cust_Group", "'G01'"),
        ("Price_Per_Unit", "CAST(round(CAST(0.65 AS DECIMAL(5,4)) * CAST(" + _GROSS + " AS DECIMAL(7,2)), 2) + CASE WHEN "
                           "p_partkey % 2 = 0 THEN CAST(0 AS DECIMAL(7,2)) ELSE CAST(1 AS "
                           "DECIMAL(7,2)) END AS DOUBLE)"),
        ("Eff_From", "DATE '2017-01-01'"),
        ("Eff_Thru", "DATE '2050-12-30'"),
        ("Credit_Price", "''"),
        ("User_Code", "'LEW'"),
        ("User_Id", "'OPER'"),
        ("Cust_Num", "''"),
        ("Cur_Code", "'USD'"),
        ("UploadedDate", "CAST(TIMESTAMP '2017-01-01 00:00:00' AS TIMESTAMP)"),
        ("Uploaded", "CASE WHEN p_partkey % 4 = 0 THEN '1' ELSE '0' END"),
    )),
}

# The reference's rule and code tables are configuration rows,
# not data; these are the test settings (FIXTURES.md) exercising each routine.
RULES_LIST_ROWS = [
    ("E", "1.3500", "1.5000", "0.8000"),
    ("L", "1.2500", "1.4000", "0.8500"),
    ("M", "1.3000", "1.4500", "0.8250"),
    ("S", "1.2000", "1.6000", "0.9000"),
]
RULES_CALC_ROWS = [
    # Brand, xmfg, BASE_WD, Price_Type, PriceGroup, Percent_of_WD, Percent_of_Gross,
    # SpecialPriceRoutine, SpecialPriceRoutine_Note, BrandType, JDE_Upload, PriceAdj_Upload
    ("BR1", "F0", "W0", "WD", "G01", "0.6500", "0.9500", 0, None, "Y", "Y", "N"),
    ("BR1", "F0", "W1", "WD", "G01", "0.6500", None, None, None, "Y", "Y", "N"),
    ("BR2", "F1", "W0", "WD", "G02", "0.3125", "0.0825", None, "Ceiling", "Y", "N", "Y"),
    ("BR2", "F1", "W1", "WD", "G13", "0.8125", None, 1, "Ceiling", "Y", "N", "Y"),
    ("BR3", "F2", "W0", "WD", "G03", "0.5000", None, 1, "Washer_Pump", "Y", "Y", "Y"),
    ("BR3", "F2", "W1", "WD", "G04", "0.4500", None, 1, "Heater_Cores", "Y", "N", "N"),
    ("BR4", "F3", "W2", "WD", "G05", "0.4000", "0.9000", 1, "Balkamp", "Y", "Y", "N"),
    ("BR5", "F4", "W0", "JB", "G06", "0.3333", None, 1, "NON A08", "Y", "N", "N"),
    ("BR5", "F4", "W1", "JB", "G07", "0.7200", None, 1, "A08", "Y", "N", "N"),
    ("BR6", "F5", "W1", "JB", "G08", "0.5000", None, 1, "UOM", "Y", "Y", "N"),
    ("BR6", "F5", "W2", "JB", "G09", "0.5000", None, 1, "No_Ceiling_UOM", "Y", "Y", "N"),
    ("BR7", "F6", "W0", "WD", "G10", None, None, 0, None, "Y", "Y", "Y"),
    ("BR8", "F7", "W0", "WD", "G11", "0.6000", None, 0, None, "N", "Y", "Y"),
    ("BR9", "F8", "W2", "WD", "G12", "1.2000", "0.9000", None, "UOM", "Y", "Y", "Y"),
]
PRICE_GROUP_ROWS = [(0, "HYFILTR"), (2, "HYFILTR"), (4, "OTHER"), (6, "HYFILTR"), (8, "HYFILTR")]
LINE_MAP_ROWS = [("L0", "DOR"), ("L1", "VDO"), ("L2", "GAT"), ("L3", "GIL"), ("L4", "GPD"),
                 ("L5", "MEI"), ("L6", "SNT"), ("L7", "SPI"), ("L8", "TAP"), ("L9", "UAC"),
                 ("L10", "USM"), ("L11", "ZZZ"), ("L12", None)]

RULES_LIST_SCHEMA = T.StructType([
    T.StructField("PopCode", T.StringType()),
    T.StructField("Jobber", T.DecimalType(5, 4)),
    T.StructField("Multiplier", T.DecimalType(5, 4)),
    T.StructField("Dealer", T.DecimalType(5, 4)),
])
RULES_CALC_SCHEMA = T.StructType([
    T.StructField("Brand", T.StringType()),
    T.StructField("xmfg", T.StringType()),
    T.StructField("BASE_WD", T.StringType()),
    T.StructField("Price_Type", T.StringType()),
    T.StructField("PriceGroup", T.StringType()),
    T.StructField("Percent_of_WD", T.DecimalType(5, 4)),
    T.StructField("Percent_of_Gross", T.DecimalType(5, 4)),
    T.StructField("SpecialPriceRoutine", T.IntegerType()),
    T.StructField("SpecialPriceRoutine_Note", T.StringType()),
    T.StructField("BrandType", T.StringType()),
    T.StructField("JDE_Upload", T.StringType()),
    T.StructField("PriceAdj_Upload", T.StringType()),
])


_STORED: dict = {}
_DISTINCT_SOURCES = ("part_brands", "part_sheet_ids", "lineitem_lines")
_STORED_FEEDS = ("retail_import", "comp_feed")


def _spark_literal(v, dtype: T.DataType) -> str:
    typ = dtype.simpleString()
    if v is None:
        return f"CAST(NULL AS {typ})"
    if isinstance(dtype, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST('{v}' AS {typ})"


def inline_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A configuration table as an inline VALUES relation.

    Spark plans it as a local relation of exactly known size, so the
    planner knows it is small (a Python-list DataFrame would be an RDD scan
    of unknown size).
    """
    fields = schema.fields
    values = ", ".join("(" + ", ".join(_spark_literal(v, f.dataType) for v, f in zip(r, fields)) + ")"
                       for r in rows)
    names = ", ".join(f.name for f in fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def _spark_expr(e: str) -> str:
    # Timestamps are wall-clock values (no zone) on both engines.
    return e.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)").replace("TIMESTAMP '", "TIMESTAMP_NTZ '")


def _dec(v):
    return None if v is None else Decimal(v)


class Fixtures:
    """Loads testdata tables of one scale factor and builds the adapters."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def _once(self, key: str, build) -> DataFrame:
        # One DataFrame object per input: identical scans in a plan share it
        # (and its exchanges can be reused); nothing is cached in memory.
        if key not in self._frames:
            self._frames[key] = build()
        return self._frames[key]

    def table(self, name: str) -> DataFrame:
        return self._once(f"table:{name}",
                          lambda: self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    def _source(self, name: str) -> DataFrame:
        if name == "part_brands":
            return self.table("part").select("p_brand").distinct()
        if name == "part_sheet_ids":
            return self.table("part").select((F.col("p_partkey") % 8).alias("ps")).distinct()
        if name == "lineitem_part":
            return self.table("lineitem").join(
                self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        if name == "lineitem_lines":
            return self.table("lineitem").select(
                (F.col("l_suppkey") % 13).alias("line"), "l_partkey").distinct()
        return self.table(name)

    def adapter(self, name: str) -> DataFrame:
        a = ADAPTERS[name]

        def build():
            return self._source(a.source).selectExpr(
                *[f"{_spark_expr(e)} AS {c}" for c, e in a.columns])
        if a.source in _DISTINCT_SOURCES or name in _STORED_FEEDS:
            # code tables derived by a DISTINCT, and the two incoming feeds: stored
            # once, as the tables they stand for already exist when a procedure runs
            return self._stored(name, build)
        return self._once(f"adapter:{name}", build)

    def __getattr__(self, name: str) -> DataFrame:
        if name in ADAPTERS:
            return self.adapter(name)
        raise AttributeError(name)

    # literal configuration tables -------------------------------------------------
    @property
    def rules_list(self) -> DataFrame:
        rows = [(p, _dec(j), _dec(m), _dec(d)) for p, j, m, d in RULES_LIST_ROWS]
        return self._once("rules_list", lambda: inline_table(self.spark, rows, RULES_LIST_SCHEMA))

    @property
    def rules_calc(self) -> DataFrame:
        rows = [r[:5] + (_dec(r[5]), _dec(r[6])) + r[7:] for r in RULES_CALC_ROWS]
        return self._once("rules_calc", lambda: inline_table(self.spark, rows, RULES_CALC_SCHEMA))

    @property
    def price_group(self) -> DataFrame:
        return self._once("price_group", lambda: inline_table(
            self.spark, PRICE_GROUP_ROWS, T.StructType([T.StructField("KIICID", T.LongType()),
                                                        T.StructField("KICPGP", T.StringType())])))

    @property
    def line_map(self) -> DataFrame:
        return self._once("line_map", lambda: inline_table(
            self.spark, LINE_MAP_ROWS, T.StructType([T.StructField("mfrline", T.StringType()),
                                                     T.StructField("Xmfg", T.StringType())])))

    # derived registries / targets ---------------------------------------------------
    # These stand for tables that already exist when a pipeline runs; each is
    # derived once per session and scale factor, stored in the shared
    # checkpoint folder and read back from there.
    def _stored(self, name: str, build) -> DataFrame:
        from quillprice.session import scratch_path, shuffles_freed
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        path = _STORED.get(key)
        if path is None:
            path = scratch_path(self.spark, f"fixture-{name}")
            frame = build()
            with shuffles_freed(self.spark):
                frame.write.option("compression", "zstd").parquet(path)
            _STORED[key] = path
        return self._once(f"stored:{name}", lambda: self.spark.read.parquet(path))

    @property
    def brand_registry(self) -> DataFrame:
        from quillprice.sources.seeds import seed_brand_registry
        return self._stored("brand_registry", lambda: seed_brand_registry(self.retail_import))

    @property
    def part_registry(self) -> DataFrame:
        from quillprice.sources.seeds import seed_part_registry
        return self._stored("part_registry",
                            lambda: seed_part_registry(self.retail_import, self.brand_registry))

    @property
    def comp_sheet(self) -> DataFrame:
        from quillprice.sources.seeds import seed_competitor_sheet
        return self._stored("comp_sheet",
                            lambda: seed_competitor_sheet(self.comp_feed, self.line_map))

    def publish(self, name: str):
        """A publish function for pipeline steps: store a new table version, read it back."""
        from quillprice.sources.pricesheet import publish
        return lambda df: publish(df, name=name)


# ---------------------------------------------------------------------------------
# DuckDB side: the same adapters as SQL CTEs.
_SQL_SOURCES = {
    "part": "part",
    "lineitem": "lineitem",
    "part_brands": "(SELECT DISTINCT p_brand FROM part) b",
    "part_sheet_ids": "(SELECT DISTINCT p_partkey % 8 AS ps FROM part) d",
    "lineitem_part": "lineitem JOIN part ON l_partkey = p_partkey",
    "lineitem_lines": "(SELECT DISTINCT l_suppkey % 13 AS line, l_partkey FROM lineitem) d",
}


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def literal_sql(name: str) -> str:
    if name == "rules_list":
        rows = ", ".join(
            f"('{p}', CAST({j} AS DECIMAL(5,4)), CAST({m} AS DECIMAL(5,4)), CAST({d} AS DECIMAL(5,4)))"
            for p, j, m, d in RULES_LIST_ROWS)
        return f"SELECT * FROM (VALUES {rows}) t(PopCode, Jobber, Multiplier, Dealer)"
    if name == "rules_calc":
        def row(r):
            pct = [f"CAST({_sql_lit(x) if x is None else x} AS DECIMAL(5,4))" for x in r[5:7]]
            routine = f"CAST({_sql_lit(r[7])} AS INTEGER)"
            strs = [f"CAST({_sql_lit(x)} AS VARCHAR)" for x in r[8:]]
            return "(" + ", ".join([_sql_lit(x) for x in r[:5]] + pct + [routine] + strs) + ")"
        rows = ", ".join(row(r) for r in RULES_CALC_ROWS)
        return ("SELECT * FROM (VALUES " + rows + ") t(Brand, xmfg, BASE_WD, Price_Type, PriceGroup, "
                "Percent_of_WD, Percent_of_Gross, SpecialPriceRoutine, SpecialPriceRoutine_Note, "
                "BrandType, JDE_Upload, PriceAdj_Upload)")
    if name == "price_group":
        rows = ", ".join(f"(CAST({k} AS BIGINT), '{g}')" for k, g in PRICE_GROUP_ROWS)
        return f"SELECT * FROM (VALUES {rows}) t(KIICID, KICPGP)"
    if name == "line_map":
        rows = ", ".join(f"('{m}', CAST({_sql_lit(x)} AS VARCHAR))" for m, x in LINE_MAP_ROWS)
        return f"SELECT * FROM (VALUES {rows}) t(mfrline, Xmfg)"
    raise KeyError(name)


def adapter_sql(name: str) -> str:
    a = ADAPTERS[name]
    cols = ", ".join(f"{e} AS {c}" for c, e in a.columns)
    return f"SELECT {cols} FROM {_SQL_SOURCES[a.source]}"


# Registries and the competitor sheet are derived from the feeds in the oracle
# the same way the Spark seed functions derive them (independently written).
_DERIVED_SQL = {
    "brand_registry": """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY RETAIL_XMFG, PRODUCTBRAND) AS BIGINT) AS BrandID,
               RETAIL_XMFG AS RetailXmfg, PRODUCTBRAND,
               upper(replace(PRODUCTBRAND, '#', '')) AS CLEANPRODUCTBRAND,
               CASE CAST(substr(PRODUCTBRAND, 7) AS INTEGER) % 4 WHEN 0 THEN 'HDC' WHEN 1 THEN 'ACI'
                    WHEN 2 THEN 'PRO' ELSE 'DOR' END AS AltXmfg
        FROM (SELECT DISTINCT RETAIL_XMFG, PRODUCTBRAND FROM retail_import
              WHERE DATE_CREATED < TIMESTAMP '1998-01-01 00:00:00' AND PRICE > 0
                AND rtrim(PRODUCTBRAND) <> '' AND PRODUCTBRAND <> 'Brand#25') s""",
    "part_registry": """
        SELECT b.BrandID, s.PRODUCTNUMBER, s.PRODUCTNAME AS PartName,
               translate(s.PRODUCTNUMBER, ' -\\/.', '') AS CLEANPRODUCTNUMBER
        FROM (SELECT DISTINCT RETAIL_XMFG, PRODUCTBRAND, PRODUCTNUMBER, PRODUCTNAME FROM retail_import
              WHERE DATE_CREATED < TIMESTAMP '1998-01-01 00:00:00' AND PRICE > 0
                AND rtrim(PRODUCTBRAND) <> '' AND PRODUCTBRAND <> 'Brand#25'
                AND rtrim(PRODUCTNUMBER) <> '') s
        JOIN brand_registry b ON s.RETAIL_XMFG = b.RetailXmfg AND s.PRODUCTBRAND = b.PRODUCTBRAND""",
    "comp_sheet": """
        SELECT CAST(year(max(f.Date_Created)) * 10000 + month(max(f.Date_Created)) * 100
                    + dayofmonth(max(f.Date_Created)) AS INTEGER) AS psID,
               CAST(NULL AS VARCHAR) AS XREFGroup, CAST(NULL AS VARCHAR) AS XMfgPartCategory,
               max(f.DESCRIP) AS XMfgPartType, m.Xmfg AS XMfg, CAST(NULL AS VARCHAR) AS XMfgSKU,
               translate(f.PARTNO, ' -\\/.', '') AS XMfgPart,
               translate(f.PARTNO, ' -\\/.', '') AS XMfgPartClean,
               CAST(NULL AS VARCHAR) AS XMfgPartSuper, CAST(NULL AS VARCHAR) AS XMfgPartSuperClean,
               max(f.POPCODE) AS XMfgPOP, max(f.UOM1) AS XMfgUOM,
               CAST(max(f.Date_Created) AS DATE) AS DateEffective, CAST(NULL AS DOUBLE) AS CoreCharge,
               'WD Gross' AS AcquisitionType, CAST(max(f.WD1) AS DOUBLE) AS PriceAcquistion,
               CAST(max(f.JOBBER1) AS DOUBLE) AS PriceJobber, CAST(max(f.WD1) AS DOUBLE) AS PriceWD,
               CAST(NULL AS DOUBLE) AS PriceList, CAST(NULL AS DOUBLE) AS PriceRetail,
               CAST(NULL AS DOUBLE) AS PriceProgramStart, max(f.Date_Created) AS PS_Date_Created
        FROM comp_feed f JOIN line_map m ON f.MFRLINE = m.mfrline AND m.Xmfg IS NOT NULL
        WHERE f.Date_Created < TIMESTAMP '2000-01-01 00:00:00'
        GROUP BY m.Xmfg, translate(f.PARTNO, ' -\\/.', '')""",
}

_DERIVED_DEPS = {
    "brand_registry": ("retail_import",),
    "part_registry": ("retail_import", "brand_registry"),
    "comp_sheet": ("comp_feed", "line_map"),
}
_LITERALS = ("rules_list", "rules_calc", "price_group", "line_map")


def fixture_cte(*names: str) -> str:
    """``WITH`` clause defining the named fixtures (and their dependencies)."""
    ordered: list[str] = []

    def add(n: str):
        if n in ordered:
            return
        for d in _DERIVED_DEPS.get(n, ()):
            add(d)
        ordered.append(n)

    for n in names:
        add(n)
    parts = []
    for n in ordered:
        if n in _LITERALS:
            body = literal_sql(n)
        elif n in _DERIVED_SQL:
            body = _DERIVED_SQL[n]
        else:
            body = adapter_sql(n)
        parts.append(f"{n} AS ({body})")
    return "WITH " + ",\n".join(parts)
