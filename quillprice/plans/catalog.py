"""Registered queries, one per SURVEY §2 key, with their DuckDB oracle SQL.

Every query reads the fixture tables derived from the testdata of one scale
factor (whole tables, no sampling) and returns a DataFrame.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from quillprice.functions import dates as D_
from quillprice.functions import pricing as P_
from quillprice.functions import text as T_
from quillprice.operators import routines as R
from quillprice.operators.aggregates import min_max_by
from quillprice.operators.constraints import STAGING_SCHEMA, enforce_staging, with_violations
from quillprice.oracle import compose, feeds_sql, retail_sql
from quillprice.oracle.pricing_sql import PRICING_FIXTURES, ROUTINE_COLS, pricing_ctes
from quillprice.plans import competitor, export, market, pivots, retail
from quillprice.registry import register
from quillprice.session import materialize
from quillprice.sources import pricesheet
from quillprice.sources.fixtures import LOAD_TS


def _inputs(fx):
    return R.PricingInputs.from_fixtures(fx, LOAD_TS)


def _pricing_sql(select: str, extra_fixtures=(), extra_ctes=()) -> str:
    return compose(PRICING_FIXTURES + tuple(extra_fixtures), pricing_ctes() + list(extra_ctes),
                   select)


# --- R1-R9: one pricing routine each -----------------------------------------------
_ROUTINE_KEYS = {"R1": "price_standard", "R2": "price_ceiling", "R3": "price_washer_pump",
                 "R4": "price_heater_cores", "R5": "price_category_list", "R6": "price_non_a08",
                 "R7": "price_a08", "R8": "price_pack_ceiling", "R9": "price_pack"}


def _routine_query(r: str):
    def q(fx):
        return R.routine_output(_inputs(fx), r)
    q.__doc__ = f"{r}: rows of routine {r}"
    return q


for _r, _key in _ROUTINE_KEYS.items():
    register(_key, _pricing_sql(f"SELECT {ROUTINE_COLS} FROM {_r.lower()}"))(_routine_query(_r))


@register("price_net", _pricing_sql("SELECT * FROM staging"))
def price_net(fx):
    """Net price on the union of all routines."""
    return R.market_price_staging(_inputs(fx))


@register("market_price_staging", _pricing_sql("SELECT * FROM staging"))
def market_price_staging(fx):
    """Price sheet -> nine routines -> net price (the flagship)."""
    return market.staging(_inputs(fx))


@register("union_all_routines", _pricing_sql(f"SELECT {ROUTINE_COLS} FROM routines"))
def union_all_routines(fx):
    """Nine routine outputs appended without cross-routine de-duplication."""
    return R.routine_rows(_inputs(fx)).withColumn(
        "CalcPrice", F.col("__calc_dec").cast("double")).select(*R.ROUTINE_NAMES)


# --- X2 / M05 / M07: matrix ----------------------------------------------------------
# Matrix rows re-priced in this run go (any brand, NULL brands stay); staging rows
# go in when no matrix row has their key, or one that does has no Xmfg.
_KEPT_MATRIX = """kept_matrix AS (
    SELECT * FROM matrix m
    WHERE m.Brand IS NULL OR NOT EXISTS (
        SELECT 1 FROM staging z WHERE z.Cust_Part_Number = m.PartNumber
        AND z.PriceGroup = m.PriceGroup))"""
_INSERT_MATRIX = """insert_matrix AS (
    SELECT DISTINCT z.Brand, z.Xmfg, z.Cust_Part_Number AS PartNumber, z.Price_Type, z.FS_WD,
           z.PriceGroup, z.CalcPrice, z.Percent_of_WD AS Perecnt_of_WD, z.LoadDate AS PriceDate,
           z.PriceList AS ListPrice, z.PriceJobber AS JobberPrice, z.PriceDealer AS DealerPrice
    FROM staging z
    WHERE NOT EXISTS (SELECT 1 FROM kept_matrix k WHERE k.Brand = z.Brand
                      AND k.PriceGroup = z.PriceGroup AND k.PartNumber = z.Cust_Part_Number)
       OR EXISTS (SELECT 1 FROM kept_matrix k WHERE k.Brand = z.Brand
                  AND k.PriceGroup = z.PriceGroup AND k.PartNumber = z.Cust_Part_Number
                  AND k.Xmfg IS NULL))"""
_MATRIX_CTES = [_KEPT_MATRIX, _INSERT_MATRIX]


@register("delete_matched_matrix",
          _pricing_sql("SELECT * FROM kept_matrix", ("matrix",), _MATRIX_CTES))
def delete_matched_matrix(fx):
    """Matrix rows left after deleting re-priced (part, group) rows."""
    return market.delete_matched_matrix(fx.matrix, market.staging(_inputs(fx)))


@register("insert_matrix_rows",
          _pricing_sql("SELECT * FROM insert_matrix", ("matrix",), _MATRIX_CTES))
def insert_matrix_rows(fx):
    """Staging rows missing from the matrix after the delete."""
    st = market.staging(_inputs(fx))
    return market.insert_matrix_rows(st, market.delete_matched_matrix(fx.matrix, st))


@register("anti_join_matrix",
          _pricing_sql("SELECT * FROM insert_matrix", ("matrix",), _MATRIX_CTES))
def anti_join_matrix(fx):
    """LEFT JOIN matrix WHERE non-key Xmfg IS NULL (same rows as M07)."""
    return insert_matrix_rows(fx)


@register("market_price_matrix_refresh",
          _pricing_sql("SELECT * FROM kept_matrix UNION ALL SELECT * FROM insert_matrix",
                       ("matrix",), _MATRIX_CTES))
def market_price_matrix_refresh(fx):
    """New matrix = kept rows + inserted rows."""
    return market.market_price_matrix_refresh(fx.matrix, market.staging(_inputs(fx)))


# --- X3 / M06: upload queue ----------------------------------------------------------
# What this run prices, one row per key; pending rows with such a key go.
_PRICED = """priced AS MATERIALIZED (
    SELECT DISTINCT rtrim(Cust_Part_Number) AS part, Brand, PriceGroup, CalcPrice FROM staging)"""
_PENDING = """pending AS (
    SELECT *, rtrim(right(Item_Num, length(rtrim(Item_Num)) - 3)) AS part
    FROM upload_queue WHERE Uploaded = '0')"""
_KEPT_QUEUE = """kept_queue AS (
    SELECT * FROM upload_queue WHERE Uploaded IS DISTINCT FROM '0'
    UNION ALL
    SELECT q.* EXCLUDE (part) FROM pending q ANTI JOIN priced s
      ON s.part = q.part AND s.Brand = q.Brand AND s.PriceGroup = q.Cust_Group
     AND s.CalcPrice = q.Price_Per_Unit)"""
_INSERT_QUEUE = """insert_queue AS (
    SELECT s.Brand, s.Brand || s.Cust_Part_Number AS Item_Num, s.PriceGroup AS Cust_Group,
           s.CalcPrice AS Price_Per_Unit, s.Effective_Date AS Eff_From,
           DATE '2050-12-30' AS Eff_Thru, '' AS Credit_Price, 'LEW' AS User_Code,
           'OPER' AS User_Id, '' AS Cust_Num, 'USD' AS Cur_Code, s.LoadDate AS UploadedDate,
           '0' AS Uploaded
    FROM staging s JOIN rules_calc c ON s.Xmfg = c.xmfg AND s.Brand = c.Brand
         AND s.PriceGroup = c.PriceGroup
    WHERE (c.JDE_Upload = 'Y' AND contains(s.ChangeCode, 'New Item'))
       OR (c.PriceAdj_Upload = 'Y' AND contains(s.ChangeCode, 'Price Adjustment')))"""
_QUEUE_CTES = [_PRICED, _PENDING, _KEPT_QUEUE, _INSERT_QUEUE]


@register("delete_pending_upload",
          _pricing_sql("SELECT * FROM kept_queue", ("upload_queue",), _QUEUE_CTES))
def delete_pending_upload(fx):
    """Queue rows left after deleting identical pending prices."""
    return market.delete_pending_upload(fx.upload_queue, market.staging(_inputs(fx)))


@register("filter_upload_eligibility",
          _pricing_sql("SELECT * FROM insert_queue", ("upload_queue",), _QUEUE_CTES))
def filter_upload_eligibility(fx):
    """(upload flag and 'New Item') or (adjustment flag and 'Price Adjustment')."""
    return market.upload_eligible(market.staging(_inputs(fx)), fx.rules_calc)


@register("erp_upload_sink",
          _pricing_sql("SELECT * FROM upload_queue UNION ALL SELECT * FROM insert_queue",
                       ("upload_queue",), _QUEUE_CTES))
def erp_upload_sink(fx):
    """Eligible rows appended to the stored ERP upload table, in its fixed layout."""
    path = pricesheet.scratch_path(fx.spark, "erp-upload")
    pricesheet.publish(fx.upload_queue.select(*market.QUEUE_COLUMNS), path)
    return pricesheet.append(market.upload_eligible(market.staging(_inputs(fx)), fx.rules_calc), path)


@register("upload_queue_refresh",
          _pricing_sql("SELECT * FROM kept_queue UNION ALL SELECT * FROM insert_queue",
                       ("upload_queue",), _QUEUE_CTES))
def upload_queue_refresh(fx):
    """Kept queue rows + eligible new prices."""
    return market.upload_queue_refresh(fx.upload_queue, market.staging(_inputs(fx)),
                                       fx.rules_calc)


# --- X4-X8: retail survey ---------------------------------------------------------------


def _retail_sql(select: str) -> str:
    return compose(retail_sql.RETAIL_FIXTURES, retail_sql.CTES, select)


def _retail(fx):
    return retail.retail_state(fx.retail_import, fx.brand_registry, fx.part_registry,
                               publish=fx.publish("registry"))


@register("anti_join_new_brand", _retail_sql("SELECT * FROM new_brands"))
def anti_join_new_brand(fx):
    """Unregistered (retailer, brand) pairs of priced rows."""
    return retail.new_brands(fx.retail_import, fx.brand_registry)


@register("surrogate_brand_id", _retail_sql("SELECT * FROM new_brand_ids"))
def surrogate_brand_id(fx):
    """Ids for new brands, continuing after the highest registered id."""
    brands = fx.brand_registry
    return retail.assign_brand_ids(retail.new_brands(fx.retail_import, brands), brands)


@register("brand_registry_update", _retail_sql("SELECT * FROM brands2"))
def brand_registry_update(fx):
    """Brand registry after registering new brands."""
    return retail.brand_registry_update(fx.retail_import, fx.brand_registry)


@register("anti_join_new_part",
          _retail_sql("SELECT RETAIL_XMFG, PRODUCTBRAND, PRODUCTNUMBER, PRODUCTNAME FROM c1_parts"))
def anti_join_new_part(fx):
    """Candidate parts not in the registry view."""
    feed = fx.retail_import
    brands = retail.brand_registry_update(feed, fx.brand_registry)
    return retail.new_parts(feed, brands, fx.part_registry).drop("RN")


@register("partition_row_number", _retail_sql("SELECT * FROM c1_parts"))
def partition_row_number(fx):
    """ROW_NUMBER over the four distinct columns (always 1)."""
    feed = fx.retail_import
    brands = retail.brand_registry_update(feed, fx.brand_registry)
    return retail.new_parts(feed, brands, fx.part_registry)


@register("part_registry_update", _retail_sql("SELECT * FROM parts2"))
def part_registry_update(fx):
    """Part registry after registering new parts."""
    return _retail(fx)[1]


@register("update_enrich_clean_keys", _retail_sql("SELECT * FROM feed2"))
def update_enrich_clean_keys(fx):
    """Feed with clean brand / number copied from the registry view."""
    return _retail(fx)[3]


@register("group_latest_date", _retail_sql("SELECT * FROM ls_c"))
def group_latest_date(fx):
    """Latest shop day per (retailer, clean brand, clean number)."""
    return retail.latest_shop_day(_retail(fx)[3])


@register("join_self_latest", _retail_sql("SELECT * FROM ls_c1"))
def join_self_latest(fx):
    """Rows of each key's latest shop day."""
    return retail.latest_day_rows(_retail(fx)[3])


@register("group_price_stats", _retail_sql("SELECT * FROM ls_c2"))
def group_price_stats(fx):
    """min/max/avg price and avg core price of the latest day."""
    return retail.last_shop_stats(_retail(fx)[3]).select(
        *retail.KEYS, "MinPrice", "MaxPrice", "AvgPrice", "AvgCore", "ShopCnt", "LastShop")


@register("count_distinct", _retail_sql(
    "SELECT RETAIL_XMFG, CLEANPRODUCTBRAND, CLEANPRODUCTNUMBER, LastShop, ShopCnt FROM ls_c2"))
def count_distinct(fx):
    """Exact count of distinct shops (ZIP codes) on the latest day."""
    return retail.last_shop_stats(_retail(fx)[3]).select(*retail.KEYS, "LastShop", "ShopCnt")


@register("last_shop_summary", _retail_sql("SELECT * FROM last_shop"))
def last_shop_summary(fx):
    """Latest-day statistics with registry name and alt code."""
    _, _, view, feed = _retail(fx)
    return retail.last_shop_summary(feed, view)


@register("join_composite_key", _retail_sql("SELECT * FROM last_shop"))
def join_composite_key(fx):
    """Three-column equi-join of the statistics to the registry view."""
    return last_shop_summary(fx)


@register("join_price_sheet_xref", _retail_sql("SELECT * FROM bp_c0"))
def join_price_sheet_xref(fx):
    """Sheet parts x rank-1 sheets x cross-reference, distinct."""
    return retail.own_brand_parts(fx.price_new, fx.price_sheets, fx.xref)


@register("filter_prefix_any", _retail_sql(
    "SELECT * FROM base_ranks WHERE LFC LIKE '2%' OR LFC LIKE '3%' OR LFC LIKE '4%'"))
def filter_prefix_any(fx):
    """LIKE '2%' OR '3%' OR '4%'."""
    return retail.ranked_base_parts(fx.base_ranks)


@register("join_left_base_ranks", _retail_sql("SELECT * FROM bp_c1"))
def join_left_base_ranks(fx):
    """Base parts LEFT JOIN own-brand parts."""
    own = retail.own_brand_parts(fx.price_new, fx.price_sheets, fx.xref)
    return retail.base_parts_with_brands(fx.base_ranks, own)


def _brand_map(fx):
    return retail.brand_part_map(fx.price_new, fx.price_sheets, fx.xref, fx.base_ranks)


@register("conditional_max_pivot", _retail_sql("SELECT * FROM bp_c2"))
def conditional_max_pivot(fx):
    """MAX(CASE XMfg WHEN v THEN BrandPart END) x 3."""
    return _brand_map(fx)


@register("brand_part_map", _retail_sql("SELECT * FROM bp_c2"))
def brand_part_map(fx):
    """Own-brand part numbers per base part."""
    return _brand_map(fx)


@register("retail_price_comparison", _retail_sql("SELECT * FROM comparison"))
def retail_price_comparison(fx):
    """Retail latest-day prices per own base part."""
    _, _, view, feed = _retail(fx)
    return retail.retail_price_comparison(retail.last_shop_summary(feed, view), fx.xref,
                                          _brand_map(fx))


@register("filter_positive", _retail_sql("SELECT * FROM retail_import WHERE PRICE > 0"))
def filter_positive(fx):
    """PRICE > 0."""
    return fx.retail_import.filter(F.col("PRICE") > 0)


@register("filter_ne_3vl", _retail_sql(
    "SELECT * FROM retail_import WHERE rtrim(PRODUCTBRAND) <> '' AND PRICE > 0"))
def filter_ne_3vl(fx):
    """PRODUCTBRAND <> '' (NULL dropped, blanks equal '')."""
    return fx.retail_import.filter(T_.not_blank(F.col("PRODUCTBRAND")) & (F.col("PRICE") > 0))


# --- X9 / X13: competitor feed ------------------------------------------------------------


def _comp_sql(select: str, extra=()) -> str:
    return compose(feeds_sql.COMP_FIXTURES, feeds_sql.COMP_CTES + list(extra), select)


def _sheet2(fx):
    return competitor.competitor_incremental_upsert(fx.comp_feed, fx.line_map, fx.comp_sheet)


@register("high_water_gate", _comp_sql(
    "SELECT new_mark, old_mark, new_mark > old_mark AS go FROM marks"))
def high_water_gate(fx):
    """Newest feed stamp, newest sheet stamp, and whether to load."""
    return competitor.high_water_marks(fx.comp_feed, fx.line_map, fx.comp_sheet)


@register("global_max", _comp_sql("SELECT old_mark FROM marks"))
def global_max(fx):
    """Ungrouped MAX over the sheet stamps."""
    return fx.comp_sheet.agg(F.max("PS_Date_Created").alias("old_mark"))


@register("filter_in_on_clause", _comp_sql("SELECT * FROM mapped"))
def filter_in_on_clause(fx):
    """Feed rows joined to lines whose code IS NOT NULL (filter in ON)."""
    return competitor.mapped_feed(fx.comp_feed, fx.line_map)


def _batch(fx):
    batch = competitor.gated_batch(fx.comp_feed, fx.line_map, fx.comp_sheet)
    if batch is None:            # gate closed: the procedure stages nothing
        batch = competitor.staged_batch(fx.comp_feed, fx.line_map, None).filter(F.lit(False))
    return batch


@register("filter_gt_scalar", _comp_sql("SELECT * FROM c_batch"))
def filter_gt_scalar(fx):
    """Rows newer than the sheet's mark, with parsed dates."""
    return _batch(fx)


@register("join_left_match_flag", _comp_sql("SELECT * FROM staging_tb"))
def join_left_match_flag(fx):
    """Batch LEFT JOIN sheet on the punctuation-stripped part number."""
    return competitor.match_flags(_batch(fx), fx.comp_sheet)


@register("staged_reuse", _comp_sql(
    "SELECT *, if(Flag IS NULL, 'insert', 'update') AS UsedBy FROM staging_tb"))
def staged_reuse(fx):
    """The batch staged as a table, which both the insert and the update read."""
    staged = fx.publish("staging-tb")(competitor.match_flags(_batch(fx), fx.comp_sheet))
    flag = F.col("Flag")
    return (staged.filter(flag.isNull()).withColumn("UsedBy", F.lit("insert"))
                  .unionByName(staged.filter(flag.isNotNull()).withColumn("UsedBy", F.lit("update"))))


@register("upsert_competitor", _comp_sql("SELECT * FROM sheet2"))
def upsert_competitor(fx):
    """Sheet after inserting new keys and updating matched ones."""
    return competitor.upsert_competitor(fx.comp_sheet, _batch(fx))


@register("competitor_incremental_upsert", _comp_sql("SELECT * FROM sheet2"))
def competitor_incremental_upsert(fx):
    """Gate + upsert."""
    return _sheet2(fx)


# --- X10 / X11 / J19: pivots ----------------------------------------------------------------
@register("group_avg", _comp_sql("SELECT * FROM comp_c"))
def group_avg(fx):
    """AVG(PriceWD) per (own part, competitor)."""
    return pivots.competitor_avg(_sheet2(fx), fx.comp_xref)


@register("filter_in_list", _comp_sql(
    "SELECT * FROM sheet2 WHERE XMfg IN ('DOR', 'VDO', 'GAT', 'GIL', 'GPD', 'MEI', 'SNT', 'SPI', "
    "'TAP', 'UAC', 'USM')"))
def filter_in_list(fx):
    """IN over the eleven competitor codes."""
    return _sheet2(fx).filter(F.col("XMfg").isin(*pivots.COMPETITORS))


@register("pivot_competitor", _comp_sql("SELECT * FROM comp_pivot", [feeds_sql.COMP_PIVOT]))
def pivot_competitor(fx):
    """A10: PIVOT AVG over eleven fixed competitor columns."""
    return pivots.competitor_price_pivot(_sheet2(fx), fx.comp_xref)


@register("competitor_price_pivot", _comp_sql("SELECT * FROM comp_pivot", [feeds_sql.COMP_PIVOT]))
def competitor_price_pivot(fx):
    """Competitor price pivot over the refreshed sheet."""
    return pivots.competitor_price_pivot(_sheet2(fx), fx.comp_xref)


def _comparison(fx):
    _, _, view, feed = _retail(fx)
    return retail.retail_price_comparison(retail.last_shop_summary(feed, view), fx.xref,
                                          _brand_map(fx))


_RETAIL_PIVOT_SQL = compose(retail_sql.RETAIL_FIXTURES, retail_sql.CTES + [feeds_sql.RETAIL_PIVOT],
                            "SELECT * FROM retail_pivot")


@register("pivot_retail", _RETAIL_PIVOT_SQL)
def pivot_retail(fx):
    """PIVOT AVG over nine fixed retailer columns."""
    return pivots.retail_price_pivot(_comparison(fx))


@register("retail_price_pivot", _RETAIL_PIVOT_SQL)
def retail_price_pivot(fx):
    """X11: retail price pivot of the comparison."""
    return pivots.retail_price_pivot(_comparison(fx))


@register("filter_not_prefix", _retail_sql(
    "SELECT * FROM comparison WHERE BasePart NOT LIKE 'N%'"))
def filter_not_prefix(fx):
    """NOT LIKE 'N%'."""
    return _comparison(fx).filter(pivots.own_part_filter("BasePart"))


_WIDE_SQL = compose(
    tuple(dict.fromkeys(PRICING_FIXTURES + ("matrix",) + retail_sql.RETAIL_FIXTURES
                        + feeds_sql.COMP_FIXTURES)),
    pricing_ctes() + _MATRIX_CTES + retail_sql.CTES + feeds_sql.COMP_CTES
    + [feeds_sql.COMP_PIVOT, feeds_sql.RETAIL_PIVOT],
    "SELECT c.PartNumber, " + ", ".join(f"p.{x}" for x in feeds_sql.COMPETITORS) + ", "
    + ", ".join(f"r.{x}" for x in feeds_sql.RETAILERS)
    + " FROM (SELECT DISTINCT PartNumber FROM (SELECT * FROM kept_matrix UNION ALL "
      "SELECT * FROM insert_matrix) m) c LEFT JOIN comp_pivot p ON c.PartNumber = p.FS_Part "
      "LEFT JOIN retail_pivot r ON c.PartNumber = r.BasePart")


@register("wide_pivot_join", _WIDE_SQL)
def wide_pivot_join(fx):
    """Refreshed matrix parts LEFT JOIN both pivots (dormant in the reference)."""
    # Each step is stored, as the procedures publish it, so that disk holds the shuffles of one step at a time.
    def keep(df):
        return materialize(df, "wide-pivot", "zstd")

    competitors = keep(pivots.competitor_price_pivot(keep(_sheet2(fx)), fx.comp_xref))
    _, _, view, feed = _retail(fx)
    enriched = keep(feed.filter("PRICE > 0").select(*retail.KEYS, "PRICE", "COREPRICE", "ZIPCODE", "DATE_CREATED"))
    stats = keep(retail.newest_stats(keep(retail.shop_sums(enriched))))
    comparison = retail.retail_price_comparison(retail.named_stats(stats, view), fx.xref, _brand_map(fx))
    retailers = keep(pivots.retail_price_pivot(comparison))
    matrix = market.market_price_matrix_refresh(fx.matrix, market.staging(_inputs(fx)))
    return pivots.wide_pivot_join(keep(matrix.select("PartNumber").distinct()), competitors, retailers)


# --- X12: OE export -----------------------------------------------------------------------
def _export_sql(select: str) -> str:
    return compose(feeds_sql.EXPORT_FIXTURES, feeds_sql.EXPORT_CTES, select)


@register("global_row_number", _export_sql("SELECT * FROM oe_body"))
def global_row_number(fx):
    """ROW_NUMBER() OVER (ORDER BY Manufacturer, PartNumber), computed in parallel."""
    return export.numbered_list(fx.oe_list)


@register("order_by_ordinal", _export_sql("SELECT * FROM oe_body ORDER BY 1, 2"))
def order_by_ordinal(fx):
    """ORDER BY 1, 2 on the numbered list."""
    return export.numbered_list(fx.oe_list).orderBy("Manufacturer", "PartNumber")


@register("group_min_max_id", _export_sql("SELECT * FROM oe_mm"))
def group_min_max_id(fx):
    """MIN/MAX id per manufacturer."""
    return min_max_by(export.numbered_list(fx.oe_list), "Manufacturer", "id")


@register("scalar_min_max_filtered", _export_sql("SELECT * FROM oe_tags"))
def scalar_min_max_filtered(fx):
    """Per-manufacturer open and close tag rows (min - 1, max + 1)."""
    return export.tag_rows(export.numbered_list(fx.oe_list))


@register("concat_strings", _export_sql("SELECT * FROM oe_tags"))
def concat_strings(fx):
    """'<' + make + '>' and '</' + make + '>' (NULL propagates)."""
    return export.tag_rows(export.numbered_list(fx.oe_list))


@register("union_tag_rows", _export_sql("SELECT * FROM oe_body UNION ALL SELECT * FROM oe_tags"))
def union_tag_rows(fx):
    """Body rows + open tags + close tags."""
    n = export.numbered_list(fx.oe_list)
    return n.unionByName(export.tag_rows(n))


@register("oe_tagged_export", _export_sql("SELECT * FROM oe_export"))
def oe_tagged_export(fx):
    """Numbered, tagged OE list."""
    return export.oe_tagged_export(fx.oe_list)


@register("order_by_columns", _export_sql("SELECT * FROM oe_export ORDER BY Manufacturer, id"))
def order_by_columns(fx):
    """The export in nesting order (Manufacturer, id)."""
    return export.oe_tagged_export(fx.oe_list).orderBy("Manufacturer", "id", "PartNumber")


# --- Sources and sinks (S01-S09) -----------------------------------------------------------

_PS_COLS = ("xmfg, Cust_Part_Number, Gross_Price, POP_Code, Change_Code, Core_Price, "
            "Price_Sheet_Number, Effective_Date")


def _sheet_file(fx) -> str:
    path = pricesheet.scratch_path(fx.spark, "price-sheet")
    return pricesheet.write_price_sheet(fx.ps_load, path)


@register("tsv_price_sheet_load", compose(("ps_load",), [], "SELECT * FROM ps_load"))
def tsv_price_sheet_load(fx):
    """The price sheet read back from its tab-separated file."""
    return pricesheet.read_price_sheet(fx.spark, _sheet_file(fx))


_TRIMMED = compose(("ps_load",), [], f"SELECT xmfg, Cust_Part_Number, Gross_Price, "
                   f"trim(POP_Code) AS POP_Code, Change_Code, Core_Price, Price_Sheet_Number, "
                   f"Effective_Date FROM ps_load")


@register("landing_trim", _TRIMMED)
def landing_trim(fx):
    """POP_Code = LTRIM(RTRIM(POP_Code)) after the load."""
    return R.landing_trim(fx.ps_load)


@register("update_column_in_place", _TRIMMED)
def update_column_in_place(fx):
    """Table-wide column update as a projection."""
    return R.landing_trim(fx.ps_load)


@register("trim", _TRIMMED)
def trim_(fx):
    """LTRIM/RTRIM (U+0020 only)."""
    return R.landing_trim(fx.ps_load)


@register("landing_reload", compose(("ps_load",), [], "SELECT * FROM ps_load"))
def landing_reload(fx):
    """Truncate-and-reload = file load published as a new landing version."""
    return pricesheet.publish(pricesheet.read_price_sheet(fx.spark, _sheet_file(fx)), name="landing")


@register("staging_typed_rebuild", _pricing_sql("SELECT * FROM staging"))
def staging_typed_rebuild(fx):
    """Staging rows under the declared schema; any constraint violation aborts."""
    st = enforce_staging(market.staging(_inputs(fx)))
    return st.select(*[F.col(f.name).cast(f.dataType) for f in STAGING_SCHEMA.fields])


@register("not_null_and_length_check", _pricing_sql(
    "SELECT *, CAST(NULL AS VARCHAR) AS Violations FROM staging"))
def not_null_and_length_check(fx):
    """Staging rows with the list of violated NOT NULL / VARCHAR(n) constraints."""
    return with_violations(market.staging(_inputs(fx)))


@register("append_insert_select",
          _pricing_sql("SELECT * FROM kept_matrix UNION ALL SELECT * FROM insert_matrix",
                       ("matrix",), _MATRIX_CTES))
def append_insert_select(fx):
    """Kept matrix written as a table, new rows appended (INSERT ... SELECT)."""
    st = market.staging(_inputs(fx))
    kept = market.delete_matched_matrix(fx.matrix, st).select(*market.MATRIX_COLUMNS)
    path = pricesheet.scratch_path(fx.spark, "matrix")
    kept_t = pricesheet.publish(kept, path)
    return pricesheet.append(market.insert_matrix_rows(st, kept_t), path)


@register("ctas_replace", _export_sql("SELECT * FROM oe_export"))
def ctas_replace(fx):
    """SELECT ... INTO a replaced table (written as a new version, read back)."""
    return pricesheet.publish(export.oe_tagged_export(fx.oe_list), name="export")


_J01_SQL = _pricing_sql(
    "SELECT d.Cust_Part_Number, d.xmfg, d.POP_Code, d.Gross_Price, l.Jobber, l.Multiplier, "
    "l.Dealer, c.Brand, c.xmfg AS CalcXmfg, c.PriceGroup, c.Percent_of_WD "
    "FROM rules_list l JOIN landing d ON l.PopCode = d.POP_Code JOIN rules_calc c ON d.xmfg = c.BASE_WD")


def _rules_join(fx):
    return _rules_rows(_inputs(fx))


def _rules_rows(inp):
    return R.rules_join(inp).select(
        "Cust_Part_Number", "xmfg", "POP_Code", "Gross_Price", "Jobber", "Multiplier", "Dealer",
        "Brand", "CalcXmfg", "PriceGroup", "Percent_of_WD")


@register("join_rules_3way", _J01_SQL)
def join_rules_3way(fx):
    """Price sheet x list rules x customer rules (many-to-many on BASE_WD)."""
    return _rules_join(fx)


@register("multi_db_read", _J01_SQL)
def multi_db_read(fx):
    """The sheet (text file) joined to rule tables of another store (ORC)."""
    other = pricesheet.scratch_path(fx.spark, "rules-store")
    for name in ("rules_list", "rules_calc"):
        getattr(fx, name).write.orc(f"{other}/{name}")
    inp = replace(_inputs(fx), load=pricesheet.read_price_sheet(fx.spark, _sheet_file(fx)),
                  rules_list=fx.spark.read.orc(f"{other}/rules_list"),
                  rules_calc=fx.spark.read.orc(f"{other}/rules_calc"))
    return _rules_rows(inp)


# --- Projections and filters (P01-P23) --------------------------------------------------------
_alias = {"project_alias": "price_standard", "group_by_expressions": "price_ceiling",
          "cte_chain": "last_shop_summary", "project_star_plus": "join_left_match_flag",
          "update_net_price": "price_net", "case_simple": "conditional_max_pivot"}


def _register_alias(new_key: str, existing: str):
    from quillprice.registry import ORACLE, QUERIES, RAW_QUERIES
    QUERIES[new_key] = QUERIES[existing]
    RAW_QUERIES[new_key] = RAW_QUERIES[existing]
    if existing in ORACLE:
        ORACLE[new_key] = ORACLE[existing]


for _k, _v in _alias.items():
    _register_alias(_k, _v)


@register("distinct_over_superset", _pricing_sql(
    f"SELECT {ROUTINE_COLS} FROM (SELECT * FROM r1 UNION SELECT * FROM r1) twice"))
def distinct_over_superset(fx):
    """Every sheet row comes twice, and a routine inserts its rows once."""
    inp = _inputs(fx)
    return R.routine_output(replace(inp, load=inp.load.unionAll(inp.load)), "R1")


def _a08_base(fx):
    """Sheet rows of class A08 under the A08 rules, with the competitor price or NULL."""
    inp = _inputs(fx)
    tax = R.taxonomy_dim(inp).filter(F.col("SRP3") == R.A08)
    base = R.priced_base(inp, ("R7",)).join(tax, F.col("Cust_Part_Number") == F.col("BasePart"))
    price = R.competitor_price(inp)
    return base.join(price, F.col("Cust_Part_Number") == price["FS_Part"], "left").select(
        "Cust_Part_Number", "Brand", "PriceGroup", "Percent_of_WD",
        F.col("HPrice").cast("double").alias("HPrice"))


def _a08_sql(where: str = "") -> str:
    return _pricing_sql(
        "SELECT d.Cust_Part_Number, c.Brand, c.PriceGroup, CAST(c.Percent_of_WD AS DOUBLE) AS Percent_of_WD, "
        "CAST(hp.Price AS DOUBLE) AS HPrice FROM rules_list l JOIN landing d ON l.PopCode = d.POP_Code "
        "JOIN rules_calc c ON d.xmfg = c.BASE_WD AND c.BrandType = 'Y' AND c.SpecialPriceRoutine_Note = 'A08' "
        "JOIN part_class s ON s.BasePart = d.Cust_Part_Number AND s.SRP3 = 'A08' "
        "LEFT JOIN hayden hp ON hp.FS_Part = d.Cust_Part_Number" + where)


@register("join_left_competitor_price", _a08_sql())
def join_left_competitor_price(fx):
    """LEFT JOIN of the competitor price, parts without one kept."""
    return _a08_base(fx)


@register("filter_expr_not_null", _a08_sql(" WHERE c.Percent_of_WD * hp.Price IS NOT NULL"))
def filter_expr_not_null(fx):
    """Rows whose price expression is not NULL."""
    return _a08_base(fx).filter((F.col("Percent_of_WD") * F.col("HPrice")).isNotNull())


@register("now", _pricing_sql("SELECT Brand, Cust_Part_Number, PriceGroup, TRUE AS StampedInRun FROM staging"))
def now(fx):
    """F16: rows stamped with the time of the run: not before it was planned, nor an hour later."""
    start = fx.spark.sql("SELECT localtimestamp() AS t").first()["t"].isoformat(sep=" ")
    started = F.lit(start).cast("timestamp_ntz")
    st = R.market_price_staging(R.PricingInputs.from_fixtures(fx, None))
    return st.select("Brand", "Cust_Part_Number", "PriceGroup", F.col("LoadDate").between(
        started, started + F.expr("INTERVAL 1 HOUR")).alias("StampedInRun"))


@register("project_constants", _comp_sql("SELECT * FROM sheet_inserted"))
def project_constants(fx):
    """Inserted sheet rows: NULL placeholders and the 'WD Gross' constant."""
    return competitor.inserted_rows(_batch(fx), fx.comp_sheet)


_HAYDEN_SQL = _pricing_sql("SELECT FS_Part, Price FROM hayden")


def _hayden(fx):
    return R.competitor_price(_inputs(fx), keep_unmatched=True).withColumnRenamed("HPrice", "Price")


@register("derived_table", _HAYDEN_SQL)
def derived_table(fx):
    """The competitor-price subquery (price file x group, LEFT JOIN xref)."""
    return _hayden(fx)


@register("join_left_xref", _HAYDEN_SQL)
def join_left_xref(fx):
    """Competitor part -> own part through the de-duplicated cross-reference (left)."""
    return _hayden(fx)


@register("filter_not_null", _comp_sql("SELECT * FROM staging_tb WHERE Flag IS NOT NULL"))
def filter_not_null(fx):
    """P10: Flag IS NOT NULL (batch rows that match a sheet row)."""
    return competitor.match_flags(_batch(fx), fx.comp_sheet).filter(F.col("Flag").isNotNull())


@register("filter_null_or_value", _pricing_sql(
    "SELECT d.Cust_Part_Number, c.Brand, c.PriceGroup, c.SpecialPriceRoutine "
    "FROM rules_list l JOIN landing d ON l.PopCode = d.POP_Code JOIN rules_calc c "
    "ON d.xmfg = c.BASE_WD WHERE c.SpecialPriceRoutine IS NULL OR c.SpecialPriceRoutine = 1"))
def filter_null_or_value(fx):
    """SpecialPriceRoutine IS NULL OR SpecialPriceRoutine = 1."""
    flag = F.col("SpecialPriceRoutine")
    return (R.rules_join(_inputs(fx)).filter(flag.isNull() | (flag == 1))
            .select("Cust_Part_Number", "Brand", "PriceGroup", "SpecialPriceRoutine"))


@register("filter_eq_literal", compose(("upload_queue",), [],
                                       "SELECT * FROM upload_queue WHERE Uploaded = '0'"))
def filter_eq_literal(fx):
    """Uploaded = '0'."""
    return fx.upload_queue.filter(F.col("Uploaded") == "0")


@register("filter_contains", _pricing_sql("SELECT * FROM staging WHERE ChangeCode LIKE '%New Item%'"))
def filter_contains(fx):
    """ChangeCode LIKE '%New Item%'."""
    return market.staging(_inputs(fx)).filter(F.col("ChangeCode").contains(market.NEW_ITEM))


@register("filter_self_equal", compose(("matrix",), [], "SELECT * FROM matrix WHERE Brand = Brand"))
def filter_self_equal(fx):
    """Brand = Brand (Catalyst folds it to Brand IS NOT NULL)."""
    return fx.matrix.filter(F.col("Brand") == F.col("Brand"))


# --- Joins (J02-J14) ----------------------------------------------------------------------------
@register("join_rules_with_category", _pricing_sql(
    "SELECT d.Cust_Part_Number, c.Brand, c.PriceGroup, r.Group1 FROM rules_list l JOIN landing d "
    "ON l.PopCode = d.POP_Code JOIN rules_calc c ON d.xmfg = c.BASE_WD "
    "JOIN base_ranks r ON d.Cust_Part_Number = r.BasePart"))
def join_rules_with_category(fx):
    """Rules join + part category table."""
    j = R.rules_join(_inputs(fx))
    ranks = fx.base_ranks.select("BasePart", "Group1")
    return j.join(ranks, j["Cust_Part_Number"] == ranks["BasePart"]).select(
        "Cust_Part_Number", "Brand", "PriceGroup", "Group1")


@register("join_nested_taxonomy", _pricing_sql(
    "SELECT d.Cust_Part_Number, d.xmfg, s.SRP3 FROM landing d "
    "JOIN part_class s ON s.BasePart = d.Cust_Part_Number"))
def join_nested_taxonomy(fx):
    """Bushy join: (PDM0 x PDM1 x setup) built first, then joined to the sheet."""
    inp = _inputs(fx)
    tax = R.taxonomy_dim(inp)
    load = R.landing_trim(inp.load)
    return load.join(tax, load["Cust_Part_Number"] == tax["BasePart"]).select(
        "Cust_Part_Number", "xmfg", "SRP3")


@register("join_price_file_group", compose(
    ("price_file", "price_group"), [],
    "SELECT f.BPLITM, f.BPUPRC, g.KICPGP FROM price_group g JOIN price_file f ON g.KIICID = f.BPICID"))
def join_price_file_group(fx):
    """Price file x price file group on the item group id."""
    g = fx.price_group
    f = fx.price_file
    return f.join(g, f["BPICID"] == g["KIICID"]).select("BPLITM", "BPUPRC", "KICPGP")


@register("join_distinct_dimension", _pricing_sql(
    "SELECT d.Cust_Part_Number, u.Info FROM landing d JOIN pack_size u ON u.Basepart = d.Cust_Part_Number"))
def join_distinct_dimension(fx):
    """Inner join to a de-duplicated lookup."""
    inp = _inputs(fx)
    pack = R.pack_dim(inp)
    load = inp.load
    return load.join(pack, load["Cust_Part_Number"] == pack["Basepart"]).select(
        "Cust_Part_Number", "Info")


_DELETED_QUEUE = _pricing_sql(
    "SELECT q.* EXCLUDE (part) FROM pending q SEMI JOIN priced s ON s.part = q.part AND s.Brand = q.Brand "
    "AND s.PriceGroup = q.Cust_Group AND s.CalcPrice = q.Price_Per_Unit",
    ("upload_queue",), [_PRICED, _PENDING])


def _deleted_queue(fx):
    return market.pending_matches(fx.upload_queue, market.staging(_inputs(fx)))


@register("join_computed_key_suffix", _DELETED_QUEUE)
def join_computed_key_suffix(fx):
    """Queue rows matched on RIGHT(Item_Num, LEN - 3) and three more keys."""
    return _deleted_queue(fx)


@register("join_price_equality", _DELETED_QUEUE)
def join_price_equality(fx):
    """The same match; the price key compares stored doubles."""
    return _deleted_queue(fx)


@register("join_clean_key", _comp_sql("SELECT * FROM sheet_updated"))
def join_clean_key(fx):
    """Sheet rows joined to the batch on the punctuation-stripped part number."""
    return competitor.updated_rows(fx.comp_sheet, _batch(fx))


@register("distinct_via_group", _retail_sql("SELECT * FROM c_parts"))
def distinct_via_group(fx):
    """GROUP BY without aggregates = DISTINCT."""
    return retail.candidate_parts(fx.retail_import)


# --- Scalar functions (F01-F20) -------------------------------------------------------------------
def _f_sql(fixture: str, select: str) -> str:
    return compose((fixture,), [], select)


_U_SQL = "CAST({p} AS DECIMAL(5,4)) * CAST(Gross_Price AS DECIMAL(7,2))"


@register("round_decimal", _f_sql("ps_load", "SELECT Cust_Part_Number, CAST(ROUND("
                                  + _U_SQL.format(p="0.6500") + ", 2) AS DOUBLE) AS Value FROM ps_load"))
def round_decimal(fx):
    """ROUND(numeric, 2), half away from zero."""
    u = P_.pct_of(P_.dec("0.6500"), F.col("Gross_Price"))
    return fx.ps_load.select("Cust_Part_Number", P_.round_money(u).cast("double").alias("Value"))


@register("round_float", compose(("ps_load", "rules_list"), [],
                                 "SELECT d.Cust_Part_Number, CAST(ROUND(d.Gross_Price * l.Jobber * "
                                 "l.Multiplier, 2) AS DOUBLE) AS PriceList FROM ps_load d JOIN "
                                 "rules_list l ON l.PopCode = trim(d.POP_Code)"))
def round_float(fx):
    """list price ROUND(gross * jobber * multiplier, 2), computed in decimal."""
    load = R.landing_trim(fx.ps_load)
    lst = fx.rules_list
    j = load.join(lst, load["POP_Code"] == lst["PopCode"])
    return j.select("Cust_Part_Number", P_.round_money(F.col("Gross_Price") * F.col("Jobber")
                                                       * F.col("Multiplier")).cast("double")
                    .alias("PriceList"))


@register("round_dynamic_scale", compose(
    ("ps_load", "pack_lookup"), [],
    "SELECT d.Cust_Part_Number, u.Info, CAST(CASE WHEN CAST(trunc(2 * CAST(u.Info AS DECIMAL(5,2))) "
    "AS INTEGER) >= 6 THEN " + _U_SQL.format(p="0.3333") + " ELSE CASE CAST(trunc(2 * CAST(u.Info AS "
    "DECIMAL(5,2))) AS INTEGER) " + " ".join(f"WHEN {k} THEN ROUND({_U_SQL.format(p='0.3333')}, {k})"
                                               for k in range(-6, 6))
    + " END END AS DOUBLE) AS Value FROM ps_load d JOIN (SELECT DISTINCT Basepart, Info FROM "
      "pack_lookup WHERE Type = 'Standard/MinimumOrderQuantity') u ON d.Cust_Part_Number = u.Basepart"))
def round_dynamic_scale(fx):
    """ROUND(u, 2 * pack) with a per-row length."""
    inp = _inputs(fx)
    pack = R.pack_dim(inp)
    j = fx.ps_load.join(pack, F.col("Cust_Part_Number") == pack["Basepart"])
    u = P_.pct_of(P_.dec("0.3333"), F.col("Gross_Price"))
    length = F.lit(2) * P_.to_numeric(F.col("Info"), 5, 2)
    return j.select("Cust_Part_Number", "Info",
                    P_.round_dynamic_scale(u, length).cast("double").alias("Value"))


@register("ceil_to_step", _f_sql("ps_load", "SELECT Cust_Part_Number, CAST(CAST(0.05 AS DECIMAL(2,2)) "
                                 "* ceil(" + _U_SQL.format(p="0.8125") + " * 20) AS DOUBLE) AS Value "
                                 "FROM ps_load"))
def ceil_to_step(fx):
    """round up to a multiple of 0.05."""
    u = P_.pct_of(P_.dec("0.8125"), F.col("Gross_Price"))
    return fx.ps_load.select("Cust_Part_Number", P_.ceil_to_nickel(u).cast("double").alias("Value"))


@register("case_searched", _f_sql(
    "ps_load", "SELECT Cust_Part_Number, CAST(CASE WHEN ROUND(" + _U_SQL.format(p="0.8125")
    + ", 2) > 9.99 THEN CAST(0.05 AS DECIMAL(2,2)) * ceil(" + _U_SQL.format(p="0.8125")
    + " * 20) ELSE ROUND(" + _U_SQL.format(p="0.8125") + ", 2) END AS DOUBLE) AS Value FROM ps_load"))
def case_searched(fx):
    """CASE WHEN rounded > 9.99 THEN nickel ceiling ELSE rounded END."""
    u = P_.pct_of(P_.dec("0.8125"), F.col("Gross_Price"))
    return fx.ps_load.select("Cust_Part_Number", P_.ceiling_price(u).cast("double").alias("Value"))


@register("cast_float_numeric", _f_sql("upload_queue", "SELECT Item_Num, CAST(Price_Per_Unit AS "
                                       "DECIMAL(7,2)) AS Value, lower(typeof(CAST(Price_Per_Unit AS "
                                       "DECIMAL(7,2)))) AS ValueType FROM upload_queue"))
def cast_float_numeric(fx):
    """CAST(float AS numeric(7,2)), and its type."""
    value = P_.to_numeric(F.col("Price_Per_Unit"), 7, 2)
    return fx.upload_queue.select("Item_Num", value.alias("Value"), F.typeof(value).alias("ValueType"))


@register("cast_text_number", _f_sql("pack_lookup", "SELECT Basepart, CAST(Info AS DOUBLE) AS InfoFloat, "
                                     "CAST(Info AS DECIMAL(5,2)) AS InfoNumeric FROM pack_lookup"))
def cast_text_number(fx):
    """text pack size -> float and numeric(5,2)."""
    return fx.pack_lookup.select("Basepart", F.col("Info").cast("double").alias("InfoFloat"),
                                 P_.to_numeric(F.col("Info"), 5, 2).alias("InfoNumeric"))


@register("left_substring", _f_sql("price_file", "SELECT BPLITM, substr(BPLITM, 1, 3) AS Brand3, "
                                   "substr(BPLITM, 4, 25) AS From4, substr(BPLITM, 5, 25) AS From5 "
                                   "FROM price_file"))
def left_substring(fx):
    """LEFT(s, 3), SUBSTRING(s, 4, 25), SUBSTRING(s, 5, 25)."""
    c = F.col("BPLITM")
    return fx.price_file.select("BPLITM", F.substring(c, 1, 3).alias("Brand3"),
                                F.substring(c, 4, 25).alias("From4"), F.substring(c, 5, 25).alias("From5"))


@register("right_len", _f_sql("upload_queue", "SELECT Item_Num, right(Item_Num, length(rtrim(Item_Num)) "
                              "- 3) AS Part FROM upload_queue"))
def right_len(fx):
    """RIGHT(s, LEN(s) - 3) (LEN ignores trailing blanks)."""
    return fx.upload_queue.select("Item_Num", T_.strip_prefix(F.col("Item_Num"), 3).alias("Part"))


@register("clean_part_number", _f_sql("comp_feed", "SELECT PARTNO, translate(PARTNO, ' -\\/.', '') "
                                      "AS Clean FROM comp_feed"))
def clean_part_number(fx):
    """strip blank, '-', '\\', '/', '.' from part numbers."""
    return fx.comp_feed.select("PARTNO", T_.clean_part_number(F.col("PARTNO")).alias("Clean"))


@register("digit_prefix_strip", _f_sql(
    "price_file", "SELECT BPLITM, ltrim(substr(BPLITM, 1, 3)) AS Brand, CASE WHEN substr(BPLITM, 4, 1) "
    "IN ('0', ' ', '', '+', '-') THEN rtrim(substr(BPLITM, 5, 25)) WHEN substr(BPLITM, 4, 1) IN ('1', "
    "'2', '3', '4', '5', '6', '7', '8', '9') THEN rtrim(substr(BPLITM, 4, 25)) END AS BasePart, "
    "substr(BPLITM, 4, 1) IN ('0', ' ', '', '+', '-', '1', '2', '3', '4', '5', '6', '7', '8', '9') "
    "AS Valid FROM price_file"))
def digit_prefix_strip(fx):
    """item code -> (brand, base part, valid)."""
    brand, base, valid = T_.item_code_parts(F.col("BPLITM"))
    return fx.price_file.select("BPLITM", brand.alias("Brand"), base.alias("BasePart"),
                                valid.alias("Valid"))


@register("scaled_int_price", _f_sql("price_file", "SELECT BPLITM, CAST(CAST(BPUPRC AS DECIMAL(18,0)) * "
                                     "CAST(0.0001 AS DECIMAL(4,4)) AS DOUBLE) AS Price FROM price_file"))
def scaled_int_price(fx):
    """BPUPRC * .0001 as an exact decimal."""
    return fx.price_file.select("BPLITM", P_.scaled_int_price(F.col("BPUPRC")).cast("double").alias("Price"))


@register("arith", compose(("ps_load", "rules_list"), [],
                           "SELECT d.Cust_Part_Number, CAST(d.Gross_Price * l.Jobber AS DOUBLE) AS "
                           "GrossJobber, CAST(d.Gross_Price - d.Core_Price AS DOUBLE) AS NetOfCore, "
                           "CAST(d.Gross_Price * l.Jobber * l.Dealer AS DOUBLE) AS DealerRaw FROM "
                           "ps_load d JOIN rules_list l ON l.PopCode = trim(d.POP_Code)"))
def arith(fx):
    """decimal * / + - (exact until the final cast)."""
    load = R.landing_trim(fx.ps_load)
    lst = fx.rules_list
    g, j, d = F.col("Gross_Price"), F.col("Jobber"), F.col("Dealer")
    return load.join(lst, load["POP_Code"] == lst["PopCode"]).select(
        "Cust_Part_Number", (g * j).cast("double").alias("GrossJobber"),
        (g - F.col("Core_Price")).cast("double").alias("NetOfCore"),
        (g * j * d).cast("double").alias("DealerRaw"))


@register("date_to_yyyymmdd_int", _f_sql("comp_feed", "SELECT Date_Created, CAST(strftime(Date_Created, "
                                         "'%Y%m%d') AS INTEGER) AS psID FROM comp_feed"))
def date_to_yyyymmdd_int(fx):
    """CONVERT(varchar(8), d, 112) -> int."""
    return fx.comp_feed.select("Date_Created", D_.yyyymmdd_int(F.col("Date_Created")).alias("psID"))


@register("parse_us_date", _f_sql("comp_feed", "SELECT PSDATE, make_date(CAST(split_part(PSDATE, '/', 3) "
                                  "AS INTEGER), CAST(split_part(PSDATE, '/', 1) AS INTEGER), "
                                  "CAST(split_part(PSDATE, '/', 2) AS INTEGER)) AS SheetDate FROM comp_feed"))
def parse_us_date(fx):
    """CONVERT(date, s, 101)."""
    return fx.comp_feed.select("PSDATE", D_.parse_us_date(F.col("PSDATE")).alias("SheetDate"))


@register("timestamp_to_date", _f_sql("retail_import", "SELECT DATE_CREATED, CAST(DATE_CREATED AS DATE) "
                                      "AS ShopDay FROM retail_import"))
def timestamp_to_date(fx):
    """CONVERT(DATE, ts)."""
    return fx.retail_import.select("DATE_CREATED", D_.day_of(F.col("DATE_CREATED")).alias("ShopDay"))
