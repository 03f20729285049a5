"""Physical-plan properties that matter at scale."""

import pytest

from conftest import SF_SMALL
from quillprice.plans import retail
from quillprice.registry import queries
from quillprice.session import materialize
from quillprice.sources.fixtures import Fixtures


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_python_in_any_plan(spark, key):
    plan = _plan(queries()[key](spark, SF_SMALL))
    assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_rule_tables_are_broadcast(spark):
    plan = _plan(queries()["market_price_staging"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 2


def test_last_shop_scans_the_feed_once(spark, tmp_path):
    fx = Fixtures(spark, SF_SMALL)
    path = str(tmp_path / "feed")
    feed = fx.retail_import
    feed.withColumn("CLEANPRODUCTBRAND", feed.PRODUCTBRAND) \
        .withColumn("CLEANPRODUCTNUMBER", feed.PRODUCTNUMBER).write.parquet(path)
    stats = retail.last_shop_stats(spark.read.parquet(path))
    plan = _plan(stats)
    assert plan.count("FileScan parquet") == 1
    assert "PushedFilters: [IsNotNull(PRICE)" in plan or "IsNotNull(PRICE)" in plan


def test_hot_keys_are_combined_before_the_shuffle(spark):
    from quillprice.plans import competitor
    fx = Fixtures(spark, SF_SMALL)
    batch = competitor.staged_batch(fx.comp_feed, fx.line_map, None)
    plan = _plan(competitor.latest_per_key(batch))
    # the one-row-per-key pick is a partial aggregate, not a sort of each key's rows
    assert "partial_max" in plan and "Window" not in plan
    feed = fx.retail_import
    keyed = feed.withColumn("CLEANPRODUCTBRAND", feed.PRODUCTBRAND) \
                .withColumn("CLEANPRODUCTNUMBER", feed.PRODUCTNUMBER)
    stats = _plan(retail.last_shop_stats(keyed))
    assert "partial_min" in stats and "partial_sum" in stats


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = (str(b) for b in disk.getAllBlocks().mkString(" ").split(" "))
    return {b for b in names if b.startswith("shuffle_")}


def test_stored_steps_leave_no_shuffle_files(spark):
    from quillprice.sources.pricesheet import publish
    before = _shuffle_files(spark)
    rows = spark.range(1000, numPartitions=4).selectExpr("id % 7 AS k", "id")
    for store in (materialize, publish):
        out = store(rows.groupBy("k").agg({"id": "sum"}), name="freed")
        assert not _shuffle_files(spark) - before
        assert len(out.take(9)) == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_last_shop_shuffles_the_feed_twice(spark):
    fx = Fixtures(spark, SF_SMALL)
    feed = fx.retail_import
    keyed = feed.withColumn("CLEANPRODUCTBRAND", feed.PRODUCTBRAND) \
                .withColumn("CLEANPRODUCTNUMBER", feed.PRODUCTNUMBER)
    assert _plan(retail.last_shop_stats(keyed)).count("Exchange hashpartitioning") == 2


def test_wide_pivot_stores_its_steps(spark):
    """The last plan only joins what the steps stored: the matrix parts and the two pivots."""
    from quillprice.plans import catalog
    plan = _plan(catalog.wide_pivot_join(Fixtures(spark, SF_SMALL)))
    assert plan.count("FileScan parquet") == 3
    assert plan.count("Exchange hashpartitioning") <= 3 and "Aggregate" not in plan


def test_rule_joins_never_shuffle_the_price_sheet(spark):
    plan = queries()["market_price_staging"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    import re
    # the sheet joins the rule tables on xmfg / POP_Code (few distinct values): never shuffled
    for key in ("xmfg", "POP_Code", "BASE_WD", "PopCode"):
        assert not re.search(rf"hashpartitioning\({key}#\d+, \d+\)", plan), key


def test_hot_and_null_keys_of_the_feed_enrichment_are_split(spark):
    """M03 joins the feed to the registry on (retailer, brand, number). A third of the
    rows is one product, in identical rows, and a third has a NULL key; with a
    registry too large to broadcast, each group is spread over several tasks."""
    from pyspark.sql import functions as F
    feed = spark.range(20000, numPartitions=12).selectExpr(
        "'AZR' AS RETAIL_XMFG", "'B0' AS PRODUCTBRAND",
        "explode(array('HOT', CAST(NULL AS STRING), 'P' || id)) AS PRODUCTNUMBER", "'n' AS PRODUCTNAME",
        "CAST(5 AS DECIMAL(12,4)) AS PRICE", "CAST(NULL AS DECIMAL(12,4)) AS COREPRICE", "'1' AS ZIPCODE",
        "TIMESTAMP_NTZ '2018-01-01 10:00:00' AS DATE_CREATED", "CAST(NULL AS STRING) AS CLEANPRODUCTBRAND",
        "CAST(NULL AS STRING) AS CLEANPRODUCTNUMBER")
    view = spark.createDataFrame([("AZR", "B0", f"P{i}", "B0", f"P{i}", "n", "HDC")
                                  for i in range(20000)] + [("AZR", "B0", "HOT", "B0", "HOT", "n", "HDC")],
                                 "RetailXmfg string, PRODUCTBRAND string, PRODUCTNUMBER string, "
                                 "CLEANPRODUCTBRAND string, CLEANPRODUCTNUMBER string, PartName string, "
                                 "AltXmfg string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64b",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64b",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.shuffle.partitions": "1000"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = materialize(retail.enrich_clean_keys(feed, view).withColumn("task", F.spark_partition_id()), "split")
        assert out.count() == 60000
        assert out.filter(out.CLEANPRODUCTNUMBER.eqNullSafe(out.PRODUCTNUMBER)).count() == 60000
        for group in (out.PRODUCTNUMBER == "HOT", out.PRODUCTNUMBER.isNull()):
            parts = out.filter(group).groupBy("task").count().collect()
            assert len(parts) > 4 and max(r["count"] for r in parts) < 20000 / 2
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sheet_is_parsed_once_by_the_procedure(spark, tmp_path):
    from dataclasses import replace
    from quillprice.operators.routines import PricingInputs
    from quillprice.plans.procedures import price_sheet_procedure
    from quillprice.sources.fixtures import LOAD_TS
    from quillprice.sources.pricesheet import publish, read_price_sheet, write_price_sheet
    fx = Fixtures(spark, SF_SMALL)
    sheet = read_price_sheet(spark, write_price_sheet(fx.ps_load, str(tmp_path / "sheet")))
    inp = replace(PricingInputs.from_fixtures(fx, LOAD_TS), load=sheet)
    plans = {}

    def pub(df, name):
        plans[name] = _plan(df)
        return publish(df, str(tmp_path / name))

    price_sheet_procedure(inp, fx.matrix, fx.upload_queue, pub)
    assert plans["landing"].count("FileScan text") == 1
    assert all("FileScan text" not in p for name, p in plans.items() if name != "landing")
