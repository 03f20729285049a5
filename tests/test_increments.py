"""Stored states: batches merged in any order give the results of one run over all rows."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillprice.functions.collation import collated
from quillprice.plans import competitor, increments, pivots, procedures as P, retail
from quillprice.sources.fixtures import Fixtures
from quillprice.sources.runs import Run, published

FEED = ("RETAIL_XMFG string, PRODUCTBRAND string, PRODUCTNUMBER string, PRODUCTNAME string, "
        "PRICE decimal(12,4), COREPRICE decimal(12,4), ZIPCODE string, DATE_CREATED timestamp_ntz, "
        "CLEANPRODUCTBRAND string, CLEANPRODUCTNUMBER string")
VIEW = ("RetailXmfg string, PRODUCTBRAND string, PRODUCTNUMBER string, CLEANPRODUCTBRAND string, "
        "CLEANPRODUCTNUMBER string, PartName string, AltXmfg string")


def same(left, right):
    """Equal rows, repeats included; means compare at 9 decimals."""
    def shown(df):
        return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r])
                      for r in df.select(*sorted(left.columns)).collect())
    return shown(left) == shown(right)


def feed_rows(n, seed):
    rnd = random.Random(seed)

    def row():
        day = rnd.choice([None, 1, 1, 2, 3])
        return (rnd.choice(["AZR", "ADV", None]), rnd.choice(["B1", "b1", "B2", None]),
                rnd.choice(["A-1", "A1", "A2", "", None]), "n", Decimal(rnd.choice(["0", "5.1234", "7.00", "9.99"])),
                rnd.choice([None, Decimal("1.5"), Decimal("0.0001")]), rnd.choice(["1", "01", "x", "", None]),
                day and dt.datetime(2017, 1, day, rnd.randrange(24)),
                rnd.choice([None, None, "B1"]), rnd.choice([None, "A1"]))
    return [row() for _ in range(n)]


def view_of(spark, *rows):
    return spark.createDataFrame([(x, b, n, cb, cn, "part", "HDC") for x, b, n, cb, cn in rows], VIEW)


@pytest.mark.parametrize("collation", [None, "UTF8_LCASE_RTRIM"])
def test_batches_in_any_order_equal_one_run(spark, collation):
    batches = [feed_rows(n, seed) for n, seed in ((120, 1), (60, 2), (0, 3))]
    feeds = [collated(spark.createDataFrame(b, FEED), collation) for b in batches]
    whole = collated(spark.createDataFrame(sum(batches, []), FEED), collation)
    # Two raw parts of one clean key, one mapped to NULL, the rest unmapped; then a registry that maps otherwise.
    views = [view_of(spark, ("AZR", "B1", "A-1", "B1", "A1"), ("AZR", "B1", "A1", "B1", "A1"),
                     ("ADV", "B2", "A2", None, "A2")),
             view_of(spark, ("AZR", "B2", "A2", "B1", "A1"), ("ADV", "B2", "A2", "B2", "A2"))]
    for order in list(itertools.permutations(range(3)))[::2]:
        state = None
        for i in order:
            added = increments.shop_state(feeds[i])
            state = increments.merge_shop_states(*([added] if state is None else [state, added]))
        for view in views:
            view = collated(view, collation)
            want = retail.last_shop_stats(retail.enrich_clean_keys(whole, view))
            got = increments.last_shop_stats(state, view)
            assert got.count() >= 2 and same(got.select(*want.columns).drop(*retail.KEYS),
                                            want.drop(*retail.KEYS))
            if collation is None:
                assert same(got, want)


def test_the_state_keeps_newest_days_only_and_may_be_empty(spark):
    def row(day, price, zipcode):
        return ("AZR", "B", "A", "n", Decimal(price), None, zipcode, dt.datetime(2017, 1, day, 5), "B", "A")
    one, two = (increments.shop_state(spark.createDataFrame(r, FEED))
                for r in ([row(1, "5", "1"), row(1, "6", "1")], [row(2, "7", None), row(1, "9", "2")]))
    state = increments.merge_shop_states(one, two)
    assert [(r.Day.day, r.PriceSum, r.PriceCnt, r.ZIPCODE) for r in state.collect()] == [(2, Decimal("7.0000"), 1, None)]
    nothing = increments.shop_state(spark.createDataFrame([], FEED))
    assert increments.merge_shop_states(nothing, nothing).isEmpty()
    assert increments.last_shop_stats(nothing, view_of(spark, ("AZR", "B", "A", "B", "A"))).isEmpty()


def test_the_retail_procedure_by_batches_equals_one_over_the_whole_feed(spark, tmp_path):
    fx, root = Fixtures(spark, SF_SMALL), str(tmp_path)
    feed = fx.retail_import
    cut = F.abs(F.hash("PRODUCTNUMBER", "ZIPCODE", "DATE_CREATED")) % 2
    brands, parts = fx.brand_registry, fx.part_registry
    for i in (1, 0):
        run = Run(spark, root)
        P.retail_batch_procedure(feed.filter(cut == i), published(spark, root, "shop_state"), brands, parts,
                                 fx.price_new, fx.price_sheets, fx.xref, fx.base_ranks, run.publish)
        run.commit()
        brands, parts = published(spark, root, "retail_brand"), published(spark, root, "retail_parts")
    view = retail.parts_view(brands, parts)
    want = retail.last_shop_summary(retail.enrich_clean_keys(feed, view), view)
    got = published(spark, root, "last_shop")
    assert got.count() > 0 and same(got, want)
    assert published(spark, root, "retail_prices").count() > 0


def test_the_pivot_follows_the_upsert_from_changed_rows(spark, tmp_path):
    fx = Fixtures(spark, SF_SMALL)
    sheet, xref = fx.comp_sheet, fx.comp_xref
    batch = competitor.gated_batch(fx.comp_feed, fx.line_map, sheet)
    cells = increments.pivot_cells(sheet, xref)
    assert same(increments.competitor_price_pivot(cells), pivots.competitor_price_pivot(sheet, xref))
    gone, put = increments.sheet_changes(sheet, batch)
    after = competitor.upsert_competitor(sheet, batch)
    moved = sheet.select(*competitor.SHEET_COLUMNS).exceptAll(gone).unionByName(put)
    assert same(moved, after.select(*moved.columns)) and not gone.isEmpty()
    changed = increments.change_cells(cells, gone, put, xref)
    assert same(increments.competitor_price_pivot(changed), pivots.competitor_price_pivot(after, xref))
    # Taken back, nothing is left of the batch; without any row no cell stays.
    back = increments.change_cells(changed, put, gone, xref)
    assert same(back, cells)
    assert increments.change_cells(cells, sheet, sheet.filter("false"), xref).isEmpty()


def test_cells_of_another_cross_reference_are_made_anew(spark, tmp_path):
    fx, root = Fixtures(spark, SF_SMALL), str(tmp_path)
    line_map, sheet = fx.line_map, fx.comp_sheet
    feed = fx.comp_feed
    other = fx.comp_xref.filter(F.col("FS_Part") != fx.comp_xref.agg(F.min("FS_Part")).first()[0])
    assert increments.xref_mark(other) != increments.xref_mark(fx.comp_xref)
    cells = None
    for xref in (fx.comp_xref, fx.comp_xref, other):      # made, kept (the gate is closed), made anew
        run = Run(spark, root)
        made = P.competitor_cells_procedure(feed, line_map, sheet, xref, cells, run.publish)
        run.commit()
        sheet, cells = published(spark, root, "comp_sheet"), published(spark, root, "comp_cells")
        assert same(made["comp_pivot"], pivots.competitor_price_pivot(sheet, xref))
