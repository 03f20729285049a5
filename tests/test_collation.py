"""Text comparisons by bytes and under a collation, and the procedures under one."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillprice.functions.collation import BINARY, IGNORE_CASE, IGNORE_CASE_AND_TRAILING_BLANKS, collated, union_into
from quillprice.operators.joins import anti_join, lookup_join
from quillprice.operators.routines import PricingInputs
from quillprice.operators.windows import global_row_number
from quillprice.oracle.compare import compare, duckdb_connection
from quillprice.plans import competitor, market, retail
from quillprice.plans import procedures as P
from quillprice.registry import as_shown, oracle_sql
from quillprice.sources.fixtures import LOAD_TS, Fixtures
from quillprice.sources.pricesheet import publish

MODES = [(BINARY, lambda s: s), (IGNORE_CASE, str.lower), (IGNORE_CASE_AND_TRAILING_BLANKS, lambda s: s.rstrip(" ").lower())]
WORDS = ["Bosch", "bosch", "BOSCH ", "Hella", "hella ", "NGK", "Denso"]


@pytest.mark.parametrize("collation, key", MODES)
def test_join_anti_join_group_and_order_keys(spark, collation, key):
    left = collated(spark.createDataFrame([(w, i) for i, w in enumerate(WORDS)], "k string, i int"), collation)
    right = collated(spark.createDataFrame([("bosch",), ("HELLA",)], "r string"), collation)
    keys = {key("bosch"), key("HELLA")}
    want = {i for i, w in enumerate(WORDS) if key(w) in keys}
    assert {r.i for r in lookup_join(left, right, [("k", "r")], "inner").collect()} == want
    assert {r.i for r in anti_join(left, right, [("k", "r")]).collect()} == {*range(len(WORDS))} - want
    groups = left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted(r.n for r in groups) == sorted([key(w) for w in WORDS].count(k) for k in {key(w) for w in WORDS})
    assert left.select("k").distinct().count() == len({key(w) for w in WORDS})
    assert key(left.agg(F.max("k")).first()[0]) == max(map(key, WORDS))
    numbered = sorted(global_row_number(left, ["k"], "id", num_partitions=3).collect(), key=lambda r: r.id)
    assert [key(r.k) for r in numbered] == sorted(map(key, WORDS))
    assert left.filter(F.col("k").startswith("BO")).count() == sum(key(w).startswith(key("BO")) for w in WORDS)


@pytest.mark.parametrize("collation, key", MODES)
def test_registries_and_sheets_compare_their_keys_under_it(spark, collation, key):
    feed = collated(spark.createDataFrame([("R1", "Bosch", 1.0), ("r1", "bosch ", 2.0), ("R1", "Hella", 3.0)],
                                          "RETAIL_XMFG string, PRODUCTBRAND string, PRICE double"), collation)
    brands = collated(spark.createDataFrame([(7, "R1", "BOSCH", None, None)], "BrandID long, RetailXmfg string, "
                                            "PRODUCTBRAND string, CLEANPRODUCTBRAND string, AltXmfg string"), collation)
    got = retail.brand_registry_update(feed, brands).collect()
    new = {(key("R1"), key("Hella")), (key("R1"), key("Bosch")), (key("r1"), key("bosch "))} - {(key("R1"), key("BOSCH"))}
    assert len(got) == 1 + len(new) and sorted(r.BrandID for r in got) == list(range(7, 8 + len(new)))

    staging = collated(spark.createDataFrame([("a1", "P1 ", "g"), ("a1", "p2", "g")],
                                             "Brand string, Cust_Part_Number string, PriceGroup string"), collation)
    matrix = collated(spark.createDataFrame([("A1", "P1", "G"), ("A1", "P2", "G"), ("A1", "P3", "G")],
                                            "Brand string, PartNumber string, PriceGroup string"), collation)
    kept = {r.PartNumber for r in market.delete_matched_matrix(matrix, staging).collect()}
    priced = {(key(p), key("g")) for p in ("P1 ", "p2")}
    assert kept == {p for p in ("P1", "P2", "P3") if (key(p), key("G")) not in priced}


@pytest.mark.parametrize("collation, key", MODES)
def test_the_upsert_matches_its_keys_under_it(spark, collation, key):
    stamp = datetime(2020, 1, 2)
    batch = collated(spark.createDataFrame(
        [("ACI", "ab1", "d", "p", "u", stamp, 5.0, 4.0, stamp, 9)], "XMfg string, PARTNO string, DESCRIP string, "
        "POPCODE string, UOM1 string, PSDATE timestamp, WD1 double, JOBBER1 double, CreatDate timestamp, new_psID int"), collation)
    fx = Fixtures(spark, SF_SMALL)
    row = fx.comp_sheet.limit(1).withColumn("XMfg", F.lit("aci")).withColumn("XMfgPartClean", F.lit("AB1"))
    got = competitor.upsert_competitor(collated(row, collation), batch).collect()
    assert len(got) == (1 if key("ACI") == key("aci") else 2)


def test_union_keeps_the_collation_of_the_table(spark):
    base = collated(spark.createDataFrame([("a", 1)], "k string, n int"), IGNORE_CASE)
    both = union_into(base, spark.createDataFrame([(2, "A")], "n int, k string"))
    assert both.columns == ["k", "n"] and both.select("k").distinct().count() == 1


def test_procedures_under_a_collation_that_changes_no_comparison_equal_the_oracle(spark):
    """The tables hold no keys that differ in case or trailing blanks alone, so all results are as by bytes."""
    fx, out = Fixtures(spark, SF_SMALL), {}

    def pub(df, name):
        return publish(df, name=name)
    c = IGNORE_CASE_AND_TRAILING_BLANKS
    out.update(P.price_sheet_procedure(PricingInputs.from_fixtures(fx, LOAD_TS), fx.matrix, fx.upload_queue, pub, c))
    out.update(P.retail_procedure(fx.retail_import, fx.brand_registry, fx.part_registry, fx.price_new, fx.price_sheets,
                                  fx.xref, fx.base_ranks, pub, c))
    out.update(P.competitor_procedure(fx.comp_feed, fx.line_map, fx.comp_sheet, pub, c))
    out.update(P.pivot_procedure(out["sheet"], fx.comp_xref, out["comparison"], pub, c))
    out.update(P.export_procedure(fx.oe_list, pub, c))
    con, sql = duckdb_connection(SF_SMALL), oracle_sql()
    for name, key in {"staging": "market_price_staging", "matrix": "market_price_matrix_refresh",
                      "queue": "upload_queue_refresh", "brands": "brand_registry_update",
                      "last_shop": "last_shop_summary", "comparison": "retail_price_comparison",
                      "sheet": "competitor_incremental_upsert", "comp_pivot": "competitor_price_pivot",
                      "retail_pivot": "retail_price_pivot", "export": "oe_tagged_export"}.items():
        plain = collated(out[name], "UTF8_BINARY")
        ok, _, _, detail = compare(as_shown(key, plain), con, sql[key])
        assert ok, (name, detail)
