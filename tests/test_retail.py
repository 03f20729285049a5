"""Retail survey edge rows: blank brands, two names per part, NULL clean keys."""

import datetime as dt
from decimal import Decimal

from quillprice.plans import retail

FEED = ("RETAIL_XMFG string, PRODUCTBRAND string, PRODUCTNUMBER string, PRODUCTNAME string, "
        "PRICE decimal(12,2), COREPRICE decimal(12,2), ZIPCODE string, DATE_CREATED timestamp_ntz, "
        "CLEANPRODUCTBRAND string, CLEANPRODUCTNUMBER string")
BRANDS = "BrandID bigint, RetailXmfg string, PRODUCTBRAND string, CLEANPRODUCTBRAND string, AltXmfg string"
PARTS = "BrandID bigint, PRODUCTNUMBER string, PartName string, CLEANPRODUCTNUMBER string"


def _feed(spark, rows):
    return spark.createDataFrame(
        [(r, b, n, nm, Decimal(p), None, z, ts, None, None) for r, b, n, nm, p, z, ts in rows], FEED)


def test_blank_brand_and_zero_price_not_registered(spark):
    feed = _feed(spark, [("AZR", "  ", "A-1", "n", "5.00", "1", dt.datetime(2017, 1, 1, 10)),
                         ("AZR", "B1", "A-1", "n", "0.00", "1", dt.datetime(2017, 1, 1, 10)),
                         ("AZR", "B2", "A-1", "n", "5.00", "1", dt.datetime(2017, 1, 1, 10))])
    brands = spark.createDataFrame([(7, "AZR", "B0", "B0", "HDC")], BRANDS)
    new = retail.brand_registry_update(feed, brands).collect()
    assert sorted((r.BrandID, r.PRODUCTBRAND) for r in new) == [(7, "B0"), (8, "B2")]


def test_part_with_two_names_is_registered_twice(spark):
    feed = _feed(spark, [("AZR", "B0", "A-1/.", "one", "5.00", "1", dt.datetime(2017, 1, 1, 10)),
                         ("AZR", "B0", "A-1/.", "two", "6.00", "2", dt.datetime(2017, 1, 1, 15))])
    brands = spark.createDataFrame([(1, "AZR", "B0", "B0", "HDC")], BRANDS)
    parts = spark.createDataFrame([], PARTS)
    out = retail.part_registry_update(feed, brands, parts).collect()
    assert sorted((r.PartName, r.CLEANPRODUCTNUMBER) for r in out) == [("one", "A1"), ("two", "A1")]
    # both registrations join the latest-day statistics: the summary fans out (Q15)
    _, _, view, enriched = retail.retail_state(feed, brands, parts)
    summary = retail.last_shop_summary(enriched, view).collect()
    assert len(summary) == 2
    assert {(r.MinPrice, r.MaxPrice, r.AvgPrice, r.ShopCnt) for r in summary} == {(5.0, 6.0, 5.5, 2)}


def test_latest_day_only_and_null_keys_dropped(spark):
    feed = _feed(spark, [("AZR", "B0", "A1", "n", "5.00", "1", dt.datetime(2017, 1, 1, 10)),
                         ("AZR", "B0", "A1", "n", "9.00", "1", dt.datetime(2018, 1, 1, 10)),
                         ("AZR", "B0", "A1", "n", "7.00", "2", dt.datetime(2018, 1, 1, 15))])
    enriched = feed.withColumn("CLEANPRODUCTBRAND", feed.PRODUCTBRAND) \
                   .withColumn("CLEANPRODUCTNUMBER", feed.PRODUCTNUMBER)
    stats = retail.last_shop_stats(enriched).collect()
    assert [(r.LastShop, r.MinPrice, r.MaxPrice, r.AvgPrice, r.ShopCnt) for r in stats] == [
        (dt.date(2018, 1, 1), 7.0, 9.0, 8.0, 2)]
    assert retail.last_shop_stats(feed).count() == 0          # clean keys still NULL


def test_one_name_per_part_option(spark):
    feed = _feed(spark, [("AZR", "B0", "A-1", "one", "5.00", "1", dt.datetime(2017, 1, 1, 10)),
                         ("AZR", "B0", "A-1", "two", "6.00", "2", dt.datetime(2017, 1, 1, 15))])
    brands = spark.createDataFrame([(1, "AZR", "B0", "B0", "HDC")], BRANDS)
    parts = spark.createDataFrame([], PARTS)
    out = retail.part_registry_update(feed, brands, parts, one_name_per_part=True).collect()
    assert [(r.PartName, r.CLEANPRODUCTNUMBER) for r in out] == [("one", "A1")]


def test_single_pass_stats_equal_self_join_form(spark):
    from pyspark.sql import functions as F
    from quillprice.functions.pricing import exact_avg
    from quillprice.sources.fixtures import Fixtures
    fx = Fixtures(spark, "/root/testdata/sf0.01")
    _, _, _, feed = retail.retail_state(fx.retail_import, fx.brand_registry, fx.part_registry)
    rows = retail.latest_day_rows(feed)                       # J15: the reference's self-join
    joined = rows.groupBy(*retail.KEYS, "LastShop").agg(
        F.min("PRICE").cast("double").alias("MinPrice"), F.max("PRICE").cast("double").alias("MaxPrice"),
        exact_avg(F.col("PRICE"), rows.schema["PRICE"].dataType).alias("AvgPrice"),
        exact_avg(F.col("COREPRICE"), rows.schema["COREPRICE"].dataType).alias("AvgCore"),
        F.countDistinct("ZIPCODE").alias("ShopCnt"))
    single = retail.last_shop_stats(feed).select(*joined.columns)
    assert single.exceptAll(joined).count() == 0 and joined.exceptAll(single).count() == 0
    assert single.count() > 1000
