"""Command line: seed reference-named tables, run procedures on them."""

import pytest

from quillprice.__main__ import main
from quillprice.oracle.compare import compare, duckdb_connection
from quillprice.registry import as_shown, oracle_sql
from quillprice.sources.pricesheet import PriceSheetRejected
from quillprice.sources.runs import current, published

SF = "/root/testdata/sf0.001"


def test_cli_runs_procedures_on_stored_tables(spark, tmp_path):
    tables, out = str(tmp_path / "tables"), str(tmp_path / "out")
    main(["seed", "--testdata", SF, "--out", tables], spark)
    main(["price-sheet", "--tables", tables, "--out", out, "--sheet", f"{tables}/price_sheet.tsv",
          "--load-ts", "2017-09-04 17:53:00"], spark)
    main(["retail", "--tables", tables, "--out", out], spark)
    main(["competitor", "--tables", tables, "--out", out], spark)
    main(["pivots", "--tables", tables, "--out", out], spark)
    main(["export", "--tables", tables, "--out", out], spark)
    # A run under an id that was committed before changes nothing.
    for _ in range(2):
        main(["export", "--tables", tables, "--out", out, "--run-id", "export of the day"], spark)
        assert current(spark, out)["number"] == 6
    con, sql = duckdb_connection(SF), oracle_sql()
    for name, key in (("temp_price_load", "market_price_staging"), ("matrix",
                      "market_price_matrix_refresh"), ("retail_prices", "retail_price_comparison"),
                      ("comp_sheet", "competitor_incremental_upsert"),
                      ("comp_pivot", "competitor_price_pivot"), ("retail_pivot", "retail_price_pivot"),
                      ("export", "oe_tagged_export")):
        ok, _, _, detail = compare(as_shown(key, published(spark, out, name)), con, sql[key])
        assert ok, (name, detail)


def test_cli_goes_on_from_what_it_published(spark, tmp_path):
    tables, out = str(tmp_path / "tables"), str(tmp_path / "out")
    main(["seed", "--testdata", SF, "--out", tables], spark)
    sheet = ["price-sheet", "--tables", tables, "--out", out, "--load-ts", "2017-09-04 17:53:00", "--sheet"]
    bad = tmp_path / "bad.tsv"
    bad.write_text("header\nW0\tP1\tno price\tE\tx\t\tPS1\t2017-09-01\n")
    with pytest.raises(PriceSheetRejected, match="line 2: Gross_Price"):
        main([*sheet, str(bad)], spark)
    assert current(spark, out)["number"] == 0
    main([*sheet, str(bad), "--max-errors", "1"], spark)
    assert published(spark, out, "price_sheet_rejects").first().line == 2
    main([*sheet, f"{tables}/price_sheet.tsv"], spark)
    for _ in range(2):                    # the second time under the same id, so the batch counts once
        main(["retail", "--tables", tables, "--out", out, "--incremental", "--run-id", "batch 1"], spark)
        main(["competitor", "--tables", tables, "--out", out, "--incremental", "--run-id", "feed 1"], spark)
    assert published(spark, out, "price_sheet_rejects").isEmpty() and current(spark, out)["number"] == 4
    con, sql = duckdb_connection(SF), oracle_sql()
    for name, key in (("matrix", "market_price_matrix_refresh"), ("last_shop", "last_shop_summary"),
                      ("retail_prices", "retail_price_comparison"),
                      ("comp_sheet", "competitor_incremental_upsert"), ("comp_pivot", "competitor_price_pivot")):
        ok, _, _, detail = compare(as_shown(key, published(spark, out, name)), con, sql[key])
        assert ok, (name, detail)
