"""Large joins and groups sort by the part number first, and by a stored value."""

import re

import pytest

from quillprice.plans import competitor, increments, market, pivots, retail


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sorts(df):
    """The first key of each sort of the plan that has several."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    keys = [k for k in re.findall(r"Sort \[(.*?)\], false", plan) if " FIRST, " in k]
    assert keys and not any("translate" in k for k in keys)
    return {re.sub(r"#\d+.*", "", k) for k in keys}


def sheet(spark):
    cols = {c: "string" for c in competitor.SHEET_COLUMNS} | {"PriceWD": "double", "PS_Date_Created": "timestamp"}
    row = {c: None for c in cols} | {"XMfg": "DOR", "XMfgPart": "12", "XMfgPartClean": "12", "PriceWD": 2.0}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} {t}" for c, t in cols.items()))


def batch(spark):
    rows = [("DOR", "1-2 .", 3.0), ("DOR", "1/3", 4.0), ("DOR", None, 5.0), (None, "12", 6.0)]
    return spark.createDataFrame([(x, p, w, w, None, None, None, None, 20170101, None) for x, p, w in rows],
                                 "XMfg string, PARTNO string, WD1 double, JOBBER1 double, DESCRIP string, POPCODE string, "
                                 "UOM1 string, PSDATE string, new_psID int, CreatDate timestamp")


def test_competitor_joins_sort_by_the_clean_number(spark, no_broadcast):
    flags = competitor.match_flags(batch(spark), sheet(spark))
    assert flags.columns[:10] == batch(spark).columns and "__clean" not in flags.columns
    assert sorts(flags) == {"__clean", "Flag"}
    assert [(r.XMfg, r.PARTNO, r.Flag) for r in flags.orderBy("WD1").collect()] == [
        ("DOR", "1-2 .", "12"), ("DOR", "1/3", None), ("DOR", None, None), (None, "12", None)]
    assert sorts(competitor.inserted_rows(batch(spark), sheet(spark))) == {"__clean", "__sk"}
    assert all(not k.startswith(("XMfg ", "__ux")) for k in sorts(competitor.upsert_competitor(sheet(spark), batch(spark))))
    done = competitor.upsert_competitor(sheet(spark), batch(spark)).select("XMfg", "XMfgPartClean", "PriceWD").collect()
    assert len(done) == 4 and {tuple(r) for r in done} == {
        ("DOR", "12", 3.0), ("DOR", "13", 4.0), ("DOR", None, 5.0), (None, "12", 6.0)}


def test_sheet_changes_and_pivot_sort_by_the_number(spark, no_broadcast):
    gone, _ = increments.sheet_changes(sheet(spark), batch(spark))
    assert sorts(gone) == {"XMfgPartClean", "__uk"}
    xref = spark.createDataFrame([("DOR", "12", "P1")], "XMfg string, CompPart string, FS_Part string")
    assert sorts(pivots.competitor_rows(sheet(spark), xref)) == {"XMfgPart", "CompPart"}


FEED = ("RETAIL_XMFG string, PRODUCTBRAND string, PRODUCTNUMBER string, PRODUCTNAME string, PRICE decimal(12,4), "
        "COREPRICE decimal(12,4), ZIPCODE string, DATE_CREATED timestamp_ntz, CLEANPRODUCTBRAND string, "
        "CLEANPRODUCTNUMBER string")
VIEW = ("RetailXmfg string, PRODUCTBRAND string, PRODUCTNUMBER string, CLEANPRODUCTBRAND string, "
        "CLEANPRODUCTNUMBER string, PartName string, AltXmfg string")


def test_retail_joins_and_groups_sort_by_the_number(spark, no_broadcast):
    feed, view = spark.createDataFrame([], FEED), spark.createDataFrame([], VIEW)
    assert sorts(retail.enrich_clean_keys(feed, view)) == {"PRODUCTNUMBER", "__n"}
    stats = retail.last_shop_stats(feed)
    assert stats.columns == [*retail.KEYS, "LastShop", "MinPrice", "MaxPrice", "AvgPrice", "AvgCore", "ShopCnt"]
    assert sorts(stats) == {"CLEANPRODUCTNUMBER"}
    assert sorts(retail.named_stats(stats, view)) == {"CLEANPRODUCTNUMBER", "__cn"}
    assert retail.latest_shop_day(feed).columns == [*retail.KEYS, "LastShop"]
    assert "__l2" in sorts(retail.latest_day_rows(feed))


def test_matrix_insert_sorts_by_the_part(spark, no_broadcast):
    staging = spark.createDataFrame([], "Brand string, Xmfg string, Cust_Part_Number string, Price_Type string, FS_WD double, "
                                        "PriceGroup string, CalcPrice double, Percent_of_WD double, LoadDate timestamp, "
                                        "PriceList double, PriceJobber double, PriceDealer double")
    matrix = spark.createDataFrame([], "Brand string, Xmfg string, PartNumber string, PriceGroup string")
    assert sorts(market.insert_matrix_rows(staging, matrix)) == {"Cust_Part_Number", "__p"}
