"""Pipelines against the independent DuckDB oracle on sf0.001 (all keys: scripts/oracle_check.py)."""

import pytest

from conftest import SF_SMALL
from quillprice.oracle.compare import compare, duckdb_connection
from quillprice.registry import oracle_sql, queries

PIPELINES = ["market_price_staging", "market_price_matrix_refresh", "upload_queue_refresh",
             "brand_registry_update", "part_registry_update", "last_shop_summary",
             "brand_part_map", "retail_price_comparison", "competitor_incremental_upsert",
             "competitor_price_pivot", "retail_price_pivot", "oe_tagged_export", "high_water_gate",
             "tsv_price_sheet_load", "not_null_and_length_check"]


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_decimal_output_list_matches_spark_schemas(spark):
    from pyspark.sql import types as T
    from quillprice.registry import DECIMAL_OUTPUTS, QUERIES, RAW_QUERIES
    from quillprice.sources.fixtures import Fixtures
    fx = Fixtures(spark, SF_SMALL)
    for key, raw in RAW_QUERIES.items():
        decimals = tuple(f.name for f in raw(fx).schema.fields
                         if isinstance(f.dataType, T.DecimalType))
        assert decimals == DECIMAL_OUTPUTS.get(key, ()), key
        presented = QUERIES[key](spark, SF_SMALL).schema.fields
        assert not any(isinstance(f.dataType, T.DecimalType) for f in presented), key


@pytest.mark.parametrize("key", PIPELINES)
def test_pipeline_matches_oracle(spark, con, key):
    ok, ns, nd, detail = compare(queries()[key](spark, SF_SMALL), con, oracle_sql()[key])
    assert ok, detail
