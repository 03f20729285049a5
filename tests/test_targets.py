"""Mutations as pure functions: matrix, upload queue, competitor sheet."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quillprice.plans import competitor, market
from quillprice.sources.fixtures import Fixtures, LOAD_TS
from quillprice.operators.routines import PricingInputs

STAGING = ("Brand string, Xmfg string, Cust_Part_Number string, Price_Type string, FS_WD double, "
           "PriceGroup string, CalcPrice double, Percent_of_WD double, LoadDate timestamp_ntz, "
           "PriceList double, PriceJobber double, PriceDealer double, ChangeCode string, "
           "Effective_Date date")
MATRIX = ("Brand string, Xmfg string, PartNumber string, Price_Type string, FS_WD double, "
          "PriceGroup string, CalcPrice double, Perecnt_of_WD double, PriceDate timestamp_ntz, "
          "ListPrice double, JobberPrice double, DealerPrice double")
TS = dt.datetime(2017, 9, 4, 17, 53)


def _staging(spark, rows):
    return spark.createDataFrame(
        [(b, "F0", p, "WD", 10.0, g, c, 0.65, TS, 1.0, 2.0, 3.0, ch, dt.date(2017, 9, 1))
         for b, p, g, c, ch in rows], STAGING)


def _matrix(spark, rows):
    return spark.createDataFrame(
        [(b, x, p, "WD", None, g, 1.25, None, dt.datetime(2017, 1, 1), None, None, None)
         for b, x, p, g in rows], MATRIX)


def test_matrix_delete_ignores_brand_but_keeps_null_brand(spark):
    st = _staging(spark, [("BR1", "P1", "G01", 6.5, "x")])
    m = _matrix(spark, [("BR1", "F0", "P1", "G01"), ("BRX", "F0", "P1", "G01"),
                        (None, "F0", "P1", "G01"), ("BR1", "F0", "P1", "G99")])
    kept = market.delete_matched_matrix(m, st).collect()
    assert sorted((r.Brand or "", r.PriceGroup) for r in kept) == [("", "G01"), ("BR1", "G99")]
    strict = market.delete_matched_matrix(m, st, strict_brand=True).collect()
    assert len(strict) == 3


def test_matrix_insert_treats_null_xmfg_as_missing(spark):
    st = _staging(spark, [("BR1", "P1", "G01", 6.5, "x"), ("BR1", "P2", "G01", 7.5, "x"),
                          ("BR1", "P3", "G01", 8.5, "x")])
    m = _matrix(spark, [("BR1", None, "P1", "G01"), ("BR1", "F0", "P2", "G01"),
                        ("BR1", "F0", "P1", "G01")])
    got = sorted(r.PartNumber for r in market.insert_matrix_rows(st, m).collect())
    assert got == ["P1", "P3"]


def test_matrix_refresh_keeps_every_null_brand_row(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    st = market.staging(PricingInputs.from_fixtures(fx, LOAD_TS))
    before = fx.matrix.filter(F.col("Brand").isNull()).count()
    after = market.market_price_matrix_refresh(fx.matrix, st)
    assert after.filter(F.col("Brand").isNull()).count() == before > 0


def test_upload_queue_stale_pending_row_stays(spark):
    st = _staging(spark, [("BR1", "P1", "G01", 6.5, "New Item")])
    q = spark.createDataFrame(
        [("BR1", "BR1P1", "G01", 6.5, "0"), ("BR1", "BR1P1", "G01", 7.5, "0"),
         ("BR1", "BR1P1", "G01", 6.5, "1")],
        "Brand string, Item_Num string, Cust_Group string, Price_Per_Unit double, Uploaded string")
    kept = market.delete_pending_upload(q, st).collect()
    assert sorted((r.Price_Per_Unit, r.Uploaded) for r in kept) == [(6.5, "1"), (7.5, "0")]


def test_upload_rows_duplicate_with_two_base_rules(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    st = _staging(spark, [("BR1", "P1", "G01", 6.5, "New Item")])
    rows = market.upload_eligible(st, fx.rules_calc).collect()
    assert len(rows) == 2 and rows[0] == rows[1]          # BR1/F0/G01 exists for W0 and W1
    assert rows[0].Item_Num == "BR1P1" and rows[0].Uploaded == "0"


FEED = ("MFRLINE string, MFRNAME string, PSDATE string, PARTNO string, DESCRIP string, "
        "POPCODE string, UOM1 string, WD1 decimal(12,2), JOBBER1 decimal(12,2), "
        "Date_Created timestamp_ntz")


def _feed(spark, rows):
    return spark.createDataFrame(
        [(line, "n", "9/4/2017", part, "d", "A", "EA", Decimal(wd), Decimal(wd), ts)
         for line, part, wd, ts in rows], FEED)


def test_upsert_picks_latest_then_highest_and_is_idempotent(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    lm = fx.line_map
    old = _feed(spark, [("L0", "1-23", "5.00", dt.datetime(2000, 1, 1))])
    sheet = competitor.upsert_competitor(
        fx.comp_sheet.limit(0), competitor.staged_batch(old, lm, None))
    feed = _feed(spark, [("L0", "1-23", "5.00", dt.datetime(2000, 1, 1)),
                         ("L0", "123", "7.00", dt.datetime(2001, 1, 1)),
                         ("L0", "12.3", "9.00", dt.datetime(2001, 1, 1)),
                         ("L0", "999", "3.00", dt.datetime(2001, 1, 1)),
                         ("L12", "555", "3.00", dt.datetime(2002, 1, 1))])
    once = competitor.competitor_incremental_upsert(feed, lm, sheet)
    got = sorted((r.XMfgPartClean, r.PriceWD) for r in once.collect())
    assert got == [("123", 9.0), ("999", 3.0)]
    twice = competitor.competitor_incremental_upsert(feed, lm, once)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_empty_sheet_loads_nothing_unless_bootstrapped(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    empty = fx.comp_sheet.limit(0)
    feed = _feed(spark, [("L0", "123", "7.00", dt.datetime(2001, 1, 1))])
    assert competitor.competitor_incremental_upsert(feed, fx.line_map, empty).count() == 0
    assert competitor.competitor_incremental_upsert(feed, fx.line_map, empty,
                                                    bootstrap=True).count() == 1


def test_empty_matrix_receives_every_distinct_staging_row(spark):
    st = _staging(spark, [("BR1", "P1", "G01", 6.5, "x"), ("BR1", "P1", "G01", 6.5, "x"),
                          ("BR1", "P2", "G01", 7.5, "x")])
    empty = _matrix(spark, [])
    out = market.market_price_matrix_refresh(empty, st).collect()
    assert sorted(r.PartNumber for r in out) == ["P1", "P2"]


def test_empty_queue_and_no_eligible_rules(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    st = _staging(spark, [("BR1", "P1", "G01", 6.5, "No Change")])
    q = fx.upload_queue.filter(F.lit(False))
    assert market.upload_queue_refresh(q, st, fx.rules_calc).count() == 0
