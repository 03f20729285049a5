"""Price-sheet file source and staging constraints."""

import pytest
from pyspark.sql import functions as F

from helpers import calc_rows, inputs, sheet_rows
from quillprice.operators.constraints import enforce_staging, with_violations
from quillprice.operators.routines import market_price_staging
from quillprice.sources import pricesheet


def _write(tmp_path, text):
    p = tmp_path / "sheet.txt"
    p.write_bytes(text.encode())
    return str(p)


HEADER = "xmfg\tpart\tgross\tpop\tchange\tcore\tsheet\teff"


def test_crlf_and_quotes_and_empty_fields(spark, tmp_path):
    body = HEADER + "\r\nW0\tP\"1\t12.34\t E \tNew Item\t\tPS1\t2017-09-01\r\n"
    rows = pricesheet.read_price_sheet(spark, _write(tmp_path, body)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.Cust_Part_Number, float(r.Gross_Price), r.POP_Code, r.Core_Price, r.Effective_Date.year) \
        == ('P"1', 12.34, " E ", None, 2017)


def test_prices_keep_their_decimals(spark, tmp_path):
    body = HEADER + "\nW0\tP1\t12.345\tE\tx\t1.005\tPS1\t2017-09-01\n"
    r = pricesheet.read_price_sheet(spark, _write(tmp_path, body)).first()
    assert (float(r.Gross_Price), float(r.Core_Price)) == (12.345, 1.005)


@pytest.mark.parametrize("second_has_header", [False, True])
def test_header_is_skipped_once_in_a_sheet_of_two_files(spark, tmp_path, second_has_header):
    def line(part):
        return f"W0\t{part}\t1.00\tE\tx\t\tPS1\t2017-09-01\n"
    folder = tmp_path / "sheet"
    folder.mkdir()
    (folder / "a.txt").write_text(HEADER + "\n" + line("P1") + line("P2"))
    (folder / "b.txt").write_text((HEADER + "\n" if second_has_header else "") + line("P3") + line("P4"))
    rows = pricesheet.read_price_sheet(spark, str(folder)).collect()
    assert sorted(r.Cust_Part_Number for r in rows) == ["P1", "P2", "P3", "P4"]


def test_bad_field_aborts_whatever_is_read(spark, tmp_path):
    body = HEADER + "\nW0\tP1\t1.00\tE\tx\t\tPS1\t2017-09-01\nW0\tP2\t1.00\tE\tx\t\tPS1\tnot a date\n"
    sheet = pricesheet.read_price_sheet(spark, _write(tmp_path, body))
    for read in (lambda: sheet.count(), lambda: sheet.select("Cust_Part_Number").collect()):
        with pytest.raises(Exception):
            read()


def test_procedure_refuses_a_missing_price(spark, tmp_path):
    from quillprice.plans.procedures import price_sheet_procedure
    from quillprice.plans.market import QUEUE_COLUMNS
    load = sheet_rows(spark, [("W0", "P1", None, "E", "x", None)])
    calc = calc_rows(spark, [("BR1", "F0", "W0", "G01", "0.5000", None, 0, None)])
    queue = spark.createDataFrame([], ", ".join(f"{c} string" for c in QUEUE_COLUMNS))
    with pytest.raises(Exception, match="declared schema"):
        price_sheet_procedure(inputs(spark, load, calc), queue, queue,
                              lambda df, name: pricesheet.publish(df, str(tmp_path / name)))


def test_bad_number_aborts_the_load(spark, tmp_path):
    body = HEADER + "\nW0\tP1\tabc\tE\tx\t\tPS1\t2017-09-01\n"
    with pytest.raises(Exception):
        pricesheet.read_price_sheet(spark, _write(tmp_path, body)).collect()


def test_constraint_violations(spark):
    load = sheet_rows(spark, [("W0", "P" + "9" * 25, "12.34", "E", "x", None)])
    calc = calc_rows(spark, [("BR10", "F0", "W0", "G01", "0.5000", None, 0, None)])
    st = market_price_staging(inputs(spark, load, calc))
    v = with_violations(st).first().Violations
    assert v == "Brand longer than 3; Cust_Part_Number longer than 20"
    with pytest.raises(Exception):
        enforce_staging(st).collect()


def test_valid_staging_passes_enforcement(spark):
    load = sheet_rows(spark, [("W0", "P1", "12.34", "E", "x", None)])
    calc = calc_rows(spark, [("BR1", "F0", "W0", "G01", "0.5000", None, 0, None)])
    st = market_price_staging(inputs(spark, load, calc))
    assert enforce_staging(st).count() == 1
    assert with_violations(st).filter(F.col("Violations").isNotNull()).count() == 0


@pytest.mark.parametrize("price", ["12.3456789", "0.0000001", "1e-9", "12.34x", "1234567890123.5", "--1"])
def test_a_price_that_its_column_cannot_hold_fails(spark, tmp_path, price):
    path = _write(tmp_path, HEADER + f"\nW0\tP1\t{price}\tE\tx\t\tPS1\t2017-09-01\n")
    for columns in (["Gross_Price"], ["xmfg"]):
        with pytest.raises(Exception, match="Gross_Price of the price sheet"):
            pricesheet.read_price_sheet(spark, path).select(*columns).collect()


def test_trailing_zeros_and_signs_of_a_price_are_kept_exactly(spark, tmp_path):
    lines = "".join(f"W0\tP{i}\t{p}\tE\tx\t\tPS1\t2017-09-01\n" for i, p in enumerate(["12.3456780000", "-1.5", "+2", ".25"]))
    got = pricesheet.read_price_sheet(spark, _write(tmp_path, HEADER + "\n" + lines)).collect()
    assert sorted(float(r.Gross_Price) for r in got) == [-1.5, 0.25, 2.0, 12.345678]


GOOD = "W0\tP{}\t1.00\tE\tx\t\tPS1\t2017-09-01"
BAD = {"W0\tP\tabc\tE\tx\t\tPS1\t2017-09-01": "Gross_Price of the price sheet is no decimal(18,6)",
       "W0\tP\t1.00\tE\tx\t1e3\tPS1\tsoon": "Core_Price of the price sheet is no decimal(18,6); "
                                              "Effective_Date of the price sheet is no date",
       "W0\tP\t0.0000001\tE\tx\t\tPS1\t2017-09-01": "Gross_Price of the price sheet is no decimal(18,6)",
       "W0\tP\t1.00": "3 fields instead of 8",
       GOOD.format("") + "\textra": "9 fields instead of 8",
       " ": "1 fields instead of 8"}


def _rejected(rows):
    return sorted((r["file"].rsplit("/", 1)[1], r["line"], r["reason"], r["value"]) for r in rows.collect())


def test_every_bad_line_is_named_by_file_and_line(spark, tmp_path):
    folder = tmp_path / "sheet"
    folder.mkdir()
    bad = list(BAD)
    # Header, empty lines and CRLF count as lines; the second file has no header of its own.
    (folder / "a.txt").write_bytes("\r\n".join([HEADER, GOOD.format(1), bad[0], "", bad[1], GOOD.format(2), bad[2]]).encode())
    (folder / "b.txt").write_bytes("\n".join([bad[3], GOOD.format(3), bad[4], bad[5], ""]).encode())
    want = sorted([("a.txt", n, BAD[v], v) for n, v in ((3, bad[0]), (5, bad[1]), (7, bad[2]))]
                  + [("b.txt", n, BAD[v], v) for n, v in ((1, bad[3]), (3, bad[4]), (4, bad[5]))])
    good, report = pricesheet.load_price_sheet(spark, str(folder), 6)
    assert _rejected(report) == want
    assert sorted(r.Cust_Part_Number for r in good.collect()) == ["P1", "P2", "P3"] and good.count() == 3
    assert good.schema == pricesheet.read_price_sheet(spark, str(folder)).schema
    for allowed in (0, 5):
        with pytest.raises(pricesheet.PriceSheetRejected, match=f"6 bad lines in the price sheet, {allowed} allowed") as e:
            pricesheet.load_price_sheet(spark, str(folder), allowed)
        assert _rejected(e.value.report) == want
        assert all(f"{f}, line {n}: {reason}" in str(e.value) for f, n, reason, _ in want)


def test_lines_are_numbered_through_the_blocks_of_a_file(spark, tmp_path):
    bad = "W0\tP\tno price\tE\tx\t\tPS1\t2017-09-01"
    lines = [HEADER] + [bad if i % 37 == 0 else GOOD.format(i) for i in range(2, 2001)]
    path = _write(tmp_path, "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 8
        good, report = pricesheet.load_price_sheet(spark, path, 100)
        assert sorted(r.line for r in report.collect()) == [i for i, v in enumerate(lines, 1) if v == bad]
        assert good.count() == len(lines) - 1 - report.count()
        with pytest.raises(pricesheet.PriceSheetRejected, match="line 37:"):
            pricesheet.load_price_sheet(spark, path, report.count() - 1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("row", [*BAD, GOOD.format(1), "W0\tP\t\t\t\t\t\t", "W0\tP\t 1.5\tE\tx\t\tPS1\t2017-09-01",
                                 "W0\tP\t+.5\tE\tx\t-2.\tPS1\t2017-9-1", "W0\tP\t1\tE\tx\t\tPS1\t2017-09-01 10:00",
                                 '"W0\tP"\t1\t\\\tx\t\tPS1\t', "W0\tP\t1\tE\tx\t\tPS1\t2017-02-30", "\t\t\t\t\t\t\t"])
def test_a_row_is_rejected_exactly_if_the_strict_load_fails(spark, tmp_path, row):
    path = _write(tmp_path, HEADER + "\n" + row + "\n")
    good, report = pricesheet.load_price_sheet(spark, path, 1)
    try:
        strict = pricesheet.read_price_sheet(spark, path).collect()
    except Exception:
        strict = None
    assert report.count() == (strict is None) and good.collect() == (strict or [])


def test_an_empty_sheet_has_no_bad_line(spark, tmp_path):
    for text in ("", HEADER, HEADER + "\n\n"):
        good, report = pricesheet.load_price_sheet(spark, _write(tmp_path, text))
        assert good.isEmpty() and report.isEmpty()
