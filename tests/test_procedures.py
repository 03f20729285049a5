"""The five procedures end to end (published tables) agree with the oracle."""

from conftest import SF_SMALL
from quillprice.operators.routines import PricingInputs
from quillprice.oracle.compare import compare, duckdb_connection
from quillprice.plans import procedures as P
from quillprice.registry import as_shown, oracle_sql
from quillprice.sources.fixtures import LOAD_TS, Fixtures
from quillprice.sources.pricesheet import publish


def test_procedures_match_oracle(spark, tmp_path):
    fx = Fixtures(spark, SF_SMALL)

    def pub(df, name):
        return publish(df, str(tmp_path / name))

    out = {}
    out.update(P.price_sheet_procedure(PricingInputs.from_fixtures(fx, LOAD_TS), fx.matrix,
                                       fx.upload_queue, pub))
    out.update(P.retail_procedure(fx.retail_import, fx.brand_registry, fx.part_registry,
                                  fx.price_new, fx.price_sheets, fx.xref, fx.base_ranks, pub))
    out.update(P.competitor_procedure(fx.comp_feed, fx.line_map, fx.comp_sheet, pub))
    out.update(P.pivot_procedure(out["sheet"], fx.comp_xref, out["comparison"], pub))
    out.update(P.export_procedure(fx.oe_list, pub))
    landing = spark.read.parquet(str(tmp_path / "landing"))
    assert landing.count() == fx.ps_load.count()
    con, sql = duckdb_connection(SF_SMALL), oracle_sql()
    pairs = {"staging": "market_price_staging", "matrix": "market_price_matrix_refresh",
             "queue": "upload_queue_refresh", "brands": "brand_registry_update",
             "parts": "part_registry_update", "feed": "update_enrich_clean_keys",
             "last_shop": "last_shop_summary", "comparison": "retail_price_comparison",
             "sheet": "competitor_incremental_upsert", "comp_pivot": "competitor_price_pivot",
             "retail_pivot": "retail_price_pivot", "export": "oe_tagged_export"}
    for name, key in pairs.items():
        ok, _, _, detail = compare(as_shown(key, out[name]), con, sql[key])
        assert ok, (name, detail)
