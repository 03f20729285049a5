"""Exact-decimal price vectors (FIXTURES.md §C) through the real routines."""

import pytest

from helpers import calc_rows, inputs, sheet_rows
from quillprice.operators import routines as R

MOQ = "Standard/MinimumOrderQuantity"


def _prices(spark, routine, pct, gross, pack=None, note=None, flag=None):
    load = sheet_rows(spark, [("W0", "P1", gross, "E", "New Item", None)])
    calc = calc_rows(spark, [("BR1", "F0", "W0", "G01", pct, None, flag, note)])
    packs = [("P1", str(pack), MOQ)] if pack else []
    inp = inputs(spark, load, calc, pack=packs)
    rows = R.routine_output(inp, routine).collect()
    return rows


@pytest.mark.parametrize("pct,gross,r1,r2", [
    ("0.5000", "12.34", 6.17, 6.17),     # V1 below threshold
    ("0.8125", "12.31", 10.00, 10.05),   # V2 ceiling applies to the unrounded value
    ("0.9995", "10.00", 10.00, 10.00),   # V3 threshold tests the rounded value
    ("0.9994", "10.00", 9.99, 9.99),     # V4 just below
    ("0.4300", "99.99", 43.00, 43.00),   # V5
])
def test_standard_and_ceiling(spark, pct, gross, r1, r2):
    assert [r.CalcPrice for r in _prices(spark, "R1", pct, gross, flag=0)] == [r1]
    assert [r.CalcPrice for r in _prices(spark, "R2", pct, gross, note="Ceiling")] == [r2]


@pytest.mark.parametrize("pct,gross,pack,r8,r9,fs_wd", [
    ("0.5000", "30.01", 2, 30.05, 30.01, 60.02),     # V6 pack inside the ceiling
    ("0.3333", "10.01", 2, 3.3363, 6.67, 20.02),     # V7 pack multiplies the ROUND length
    ("0.3333", "10.01", 4, 3.336333, 13.35, 40.04),  # V8 no rounding at all
])
def test_pack_routines(spark, pct, gross, pack, r8, r9, fs_wd):
    a = _prices(spark, "R8", pct, gross, pack=pack, note="UOM")
    b = _prices(spark, "R9", pct, gross, pack=pack, note="No_Ceiling_UOM")
    assert [r.CalcPrice for r in a] == [r8]
    assert [r.CalcPrice for r in b] == [r9]
    assert a[0].FS_WD == fs_wd and b[0].FS_WD == fs_wd
    # list prices are not pack-scaled
    assert a[0].PriceJobber == round(float(gross) * 1.35 + 1e-9, 2)


def test_net_price_casts_percent_to_two_decimals(spark):
    # V9: 10.05 * CAST(0.0825 AS numeric(7,2)) = 10.05 * 0.08 = 0.80 (0.83 without Q12)
    load = sheet_rows(spark, [("W0", "P1", "12.31", "E", "x", None)])
    calc = calc_rows(spark, [("BR2", "F1", "W0", "G02", "0.8125", "0.0825", 1, "Ceiling")])
    row = R.market_price_staging(inputs(spark, load, calc)).collect()
    assert [(r.CalcPrice, r.PriceNet, r.Percent_of_Gross) for r in row] == [(10.05, 0.80, 0.0825)]


def test_nickel_prices_are_whole_nickels(spark):
    load = sheet_rows(spark, [("W0", f"P{i}", f"{10 + i * 1.37:.2f}", "E", "x", None)
                              for i in range(40)])
    calc = calc_rows(spark, [("BR2", "F1", "W0", "G02", "0.8125", None, None, "Ceiling")])
    for r in R.routine_output(inputs(spark, load, calc), "R2").collect():
        if r.CalcPrice > 9.99:
            assert abs(r.CalcPrice * 20 - round(r.CalcPrice * 20)) < 1e-9


def test_overlapping_routines_keep_both_rows(spark):
    # A rule with a NULL flag and a 'Ceiling' note is in R1 and in R2 (Q17).
    load = sheet_rows(spark, [("W0", "P1", "12.31", "E", "x", None)])
    calc = calc_rows(spark, [("BR2", "F1", "W0", "G02", "0.8125", None, None, "Ceiling")])
    rows = R.routine_rows(inputs(spark, load, calc)).collect()
    assert sorted(r.routine for r in rows) == ["R1", "R2"]


def test_superset_distinct_keeps_same_rule_via_two_bases(spark):
    # Same customer rule reached through two base manufacturers (Q6): one part
    # listed under both bases yields two identical R1 rows.
    load = sheet_rows(spark, [("W0", "P1", "12.34", "E", "x", None),
                              ("W1", "P1", "12.34", "E", "x", None)])
    calc = calc_rows(spark, [("BR1", "F0", "W0", "G01", "0.5000", None, 0, None),
                             ("BR1", "F0", "W1", "G01", "0.5000", None, 0, None)])
    rows = R.routine_output(inputs(spark, load, calc), "R1").collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_competitor_price_routine_uses_item_code(spark):
    # Price file item '6250108  ' (filler zero) maps to competitor part 108
    # -> own part P1; CalcPrice from the competitor price 20.00 * 0.72 = 14.40.
    load = sheet_rows(spark, [("W1", "P1", "30.00", "E", "x", None)])
    calc = calc_rows(spark, [("BR5", "F4", "W1", "G07", "0.7200", None, 1, "A08")])
    inp = inputs(spark, load, calc, pdm0=[("P1", "Brand#1")], setup=[("Brand#1", "A08")],
                 price_file=[("6250108  ", 200000, 0), ("624A109", 100000, 0), ("625A110", 100000, 4)],
                 xref=[("HDC", "108", "X", "P1", "D")])
    rows = R.routine_output(inp, "R7").collect()
    assert [(r.CalcPrice, r.FS_WD, r.PriceJobber) for r in rows] == [(14.40, 30.0, 27.0)]
    assert R.rejected_codes(inp).count() == 0
    # a malformed code of the competitor fails the job, or goes to the reject table
    bad = inputs(spark, load, calc, pdm0=[("P1", "Brand#1")], setup=[("Brand#1", "A08")],
                 price_file=[("6250108  ", 200000, 0), ("625A109", 100000, 0)],
                 xref=[("HDC", "108", "X", "P1", "D")])
    with pytest.raises(Exception, match="malformed item code: 625A109"):
        R.routine_output(bad, "R7").collect()
    bad.reject_bad_codes = True
    assert [r.CalcPrice for r in R.routine_output(bad, "R7").collect()] == [14.40]
    assert [r.BPLITM for r in R.rejected_codes(bad).collect()] == ["625A109"]


def test_large_price_without_a_gross_rule_passes(spark):
    # 900 * 0.5 * 500 = 225,000 is beyond numeric(7,2); only a gross percent casts it
    load = sheet_rows(spark, [("W0", "P1", "900", "E", "x", None)])
    calc = calc_rows(spark, [("BR6", "F5", "W0", "G09", "0.5000", None, 1, "No_Ceiling_UOM")])
    row = R.market_price_staging(inputs(spark, load, calc, pack=[("P1", "500", MOQ)])).first()
    assert (row.CalcPrice, row.PriceNet) == (225000.0, None)
    calc = calc_rows(spark, [("BR6", "F5", "W0", "G09", "0.5000", "0.9000", 1, "No_Ceiling_UOM")])
    with pytest.raises(Exception):
        R.market_price_staging(inputs(spark, load, calc, pack=[("P1", "500", MOQ)])).collect()


def test_averages_keep_stored_precision(spark):
    from decimal import Decimal
    from quillprice.operators.aggregates import fixed_pivot_avg, price_stats
    rows = [("k", Decimal("0.1249"), Decimal("0.0005"), "1")] * 3
    df = spark.createDataFrame(rows, "k string, PRICE decimal(12,4), COREPRICE decimal(12,4), ZIPCODE string")
    r = price_stats(df, ["k"]).first()
    assert (r.AvgPrice, r.AvgCore) == (0.1249, 0.0005)
    means = spark.createDataFrame([("p", "A", 1 / 3), ("p", "A", 1 / 3)], "part string, c string, v double")
    assert abs(fixed_pivot_avg(means, "part", "c", ["A"], "v").first().A - 1 / 3) < 1e-12


def test_staging_has_declared_columns(spark):
    load = sheet_rows(spark, [("W0", "P1", "12.34", "E", "x", None)])
    calc = calc_rows(spark, [("BR1", "F0", "W0", "G01", "0.5000", None, 0, None)])
    st = R.market_price_staging(inputs(spark, load, calc))
    assert st.columns == R.STAGING_NAMES


def test_fixed_pack_rounding_option(spark):
    # Q5 kept by default (3.3363); the fix rounds the unit price, then scales by pack.
    load = sheet_rows(spark, [("W0", "P1", "10.01", "E", "x", None)])
    calc = calc_rows(spark, [("BR6", "F5", "W0", "G08", "0.3333", None, 1, "UOM")])
    inp = inputs(spark, load, calc, pack=[("P1", "2", MOQ)])
    assert [r.CalcPrice for r in R.routine_output(inp, "R8").collect()] == [3.3363]
    inp.fix_pack_rounding = True
    assert [r.CalcPrice for r in R.routine_output(inp, "R8").collect()] == [6.68]


def test_two_pack_sizes_fan_out(spark):
    # The lookup is de-duplicated on (part, pack), so two pack sizes give two rows
    load = sheet_rows(spark, [("W0", "P1", "30.01", "E", "x", None)])
    calc = calc_rows(spark, [("BR6", "F5", "W0", "G09", "0.5000", None, 1, "No_Ceiling_UOM")])
    inp = inputs(spark, load, calc, pack=[("P1", "2", MOQ), ("P1", "2", MOQ), ("P1", "4", MOQ),
                                          ("P1", "9", "Other")])
    rows = sorted((r.FS_WD, r.CalcPrice) for r in R.routine_output(inp, "R9").collect())
    assert rows == [(60.02, 30.01), (120.04, 60.02)]


def test_per_routine_load_stamps(spark):
    # Q7: stamps per statement make the R1 and R2 rows of one rule differ in LoadDate,
    # so both survive the matrix insert's GROUP BY
    from quillprice.plans import market
    load = sheet_rows(spark, [("W0", "P1", "12.34", "E", "x", None)])
    calc = calc_rows(spark, [("BR2", "F1", "W0", "G02", "0.5000", None, None, "Ceiling")])
    inp = inputs(spark, load, calc)
    inp.load_ts = {"R1": "2017-09-04 17:53:00", "R2": "2017-09-04 17:53:01"}
    st = R.market_price_staging(inp)
    assert sorted(str(r.LoadDate) for r in st.collect()) == ["2017-09-04 17:53:00",
                                                            "2017-09-04 17:53:01"]
    empty = spark.createDataFrame([], "Brand string, Xmfg string, PartNumber string, "
                                  "Price_Type string, FS_WD double, PriceGroup string, "
                                  "CalcPrice double, Perecnt_of_WD double, PriceDate timestamp_ntz, "
                                  "ListPrice double, JobberPrice double, DealerPrice double")
    assert market.market_price_matrix_refresh(empty, st).count() == 2
    inp.load_ts = "2017-09-04 17:53:00"
    assert market.market_price_matrix_refresh(empty, R.market_price_staging(inp)).count() == 1


def test_case_insensitive_rule_texts_option(spark):
    # Q2: binary by default; the option compares like a case- and
    # trailing-blank-insensitive collation
    load = sheet_rows(spark, [("W0", "P1", "12.31", "E", "x", None)])
    calc = calc_rows(spark, [("BR2", "F1", "W0", "G13", "0.8125", None, 1, "ceiling  ")])
    inp = inputs(spark, load, calc)
    assert R.routine_output(inp, "R2").count() == 0
    inp.case_insensitive = True
    assert [r.CalcPrice for r in R.routine_output(inp, "R2").collect()] == [10.05]
