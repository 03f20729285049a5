"""The five procedures of the reference, each as one Spark job sequence.

Every procedure publishes the tables the reference writes (staging, matrix,
upload queue, registries, enriched feed, last-shop table, comparison, sheet,
pivots, export) through ``publish`` (DataFrame -> DataFrame read back), so a
later step reads the stored table instead of recomputing its lineage, and a
lost executor costs at most the step it was running. With ``sources.runs`` as
``publish`` all tables of a procedure become current at once, and with its
``refresh_groups`` the price matrix is refreshed by price group.

``collation`` (``functions.collation``) is that of every text comparison; by
default text is compared by its bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.functions.collation import collated
from quillprice.operators.constraints import enforce_staging
from quillprice.operators.routines import PricingInputs, landing_trim, market_price_staging
from quillprice.plans import competitor, export, increments, market, pivots, retail
from quillprice.session import materialize

Publish = Callable[[DataFrame, str], DataFrame]
RefreshGroups = Callable[[str, str, DataFrame, DataFrame, Callable[[DataFrame], DataFrame]], DataFrame]


def _under(collation: str | None, publish: Publish, *tables: DataFrame):
    """The tables, and what is published from them, under the collation."""
    return (lambda df, name: publish(collated(df, collation), name), *[collated(t, collation) for t in tables])


def price_sheet_procedure(inp: PricingInputs, matrix: DataFrame, queue: DataFrame,
                          publish: Publish, collation: str | None = None,
                          refresh_groups: RefreshGroups | None = None) -> dict[str, DataFrame]:
    """Load -> nine routines -> net price -> matrix refresh -> upload queue refresh.

    The sheet is parsed once, into the landing table that all routines read; a
    bad row aborts there. Staging is published under its declared NOT NULL and
    length constraints.

    Delete and insert of the matrix both match on the price group, so with
    ``refresh_groups`` (``Run.refresh_groups``) only the groups of this sheet's prices
    are read and written; ``matrix`` then counts where none is kept by groups yet.
    """
    publish, matrix, queue = _under(collation, publish, matrix, queue)
    inp = replace(inp, **{f.name: collated(getattr(inp, f.name), collation) for f in fields(inp)
                          if isinstance(getattr(inp, f.name), DataFrame)})
    inp = replace(inp, load=publish(landing_trim(inp.load), "landing"))
    staging = publish(enforce_staging(market_price_staging(inp)), "temp_price_load")
    if refresh_groups is None:
        matrix = publish(market.market_price_matrix_refresh(matrix, staging), "matrix")
    else:
        matrix = refresh_groups("matrix", "PriceGroup", matrix, staging.select("PriceGroup"),
                                lambda old: market.market_price_matrix_refresh(collated(old, collation), staging))
    return {
        "staging": staging,
        "matrix": matrix,
        "queue": publish(market.upload_queue_refresh(queue, staging, inp.rules_calc), "queue"),
    }


def retail_procedure(feed: DataFrame, brands: DataFrame, parts: DataFrame, price_new: DataFrame,
                     sheets: DataFrame, xref: DataFrame, ranks: DataFrame,
                     publish: Publish, collation: str | None = None) -> dict[str, DataFrame]:
    """Brands -> parts -> feed enrichment -> latest shop -> brand map -> comparison."""
    publish, feed, brands, parts, price_new, sheets, xref, ranks = _under(
        collation, publish, feed, brands, parts, price_new, sheets, xref, ranks)
    brands2 = publish(retail.brand_registry_update(feed, brands), "retail_brand")
    parts2 = publish(retail.part_registry_update(feed, brands2, parts), "retail_parts")
    view = retail.parts_view(brands2, parts2)
    feed2 = publish(retail.enrich_clean_keys(feed, view), "import_retail")
    last_shop = publish(retail.last_shop_summary(feed2, view), "last_shop")
    brand_map = retail.brand_part_map(price_new, sheets, xref, ranks)
    comparison = publish(retail.retail_price_comparison(last_shop, xref, brand_map),
                         "retail_prices")
    return {"brands": brands2, "parts": parts2, "feed": feed2, "last_shop": last_shop,
            "comparison": comparison}


def retail_batch_procedure(batch: DataFrame, state: DataFrame | None, brands: DataFrame, parts: DataFrame,
                           price_new: DataFrame, sheets: DataFrame, xref: DataFrame, ranks: DataFrame,
                           publish: Publish, collation: str | None = None) -> dict[str, DataFrame]:
    """The retail survey for a new batch of the feed: all earlier batches are in ``state`` (None: there are none).

    The registries learn the batch's brands and parts. Latest shop and comparison are those
    of all batches together under these registries; no earlier feed row is read.
    """
    publish, batch, brands, parts, price_new, sheets, xref, ranks = _under(
        collation, publish, batch, brands, parts, price_new, sheets, xref, ranks)
    brands2 = publish(retail.brand_registry_update(batch, brands), "retail_brand")
    parts2 = publish(retail.part_registry_update(batch, brands2, parts), "retail_parts")
    view = retail.parts_view(brands2, parts2)
    added = increments.shop_state(batch)
    states = [added] if state is None else [collated(state, collation), materialize(added, "batch-state")]
    state2 = publish(increments.merge_shop_states(*states), "shop_state")
    last_shop = publish(retail.named_stats(increments.last_shop_stats(state2, view), view), "last_shop")
    comparison = publish(retail.retail_price_comparison(
        last_shop, xref, retail.brand_part_map(price_new, sheets, xref, ranks)), "retail_prices")
    return {"brands": brands2, "parts": parts2, "state": state2, "last_shop": last_shop, "comparison": comparison}


def competitor_procedure(feed: DataFrame, line_map: DataFrame, sheet: DataFrame,
                         publish: Publish, collation: str | None = None,
                         bootstrap: bool = False) -> dict[str, DataFrame]:
    """High-water gate, then upsert of the newer feed rows."""
    publish, feed, line_map, sheet = _under(collation, publish, feed, line_map, sheet)
    return {"sheet": publish(competitor.competitor_incremental_upsert(feed, line_map, sheet, bootstrap),
                             "comp_sheet")}


def competitor_cells_procedure(feed: DataFrame, line_map: DataFrame, sheet: DataFrame, comp_xref: DataFrame,
                               cells: DataFrame | None, publish: Publish, collation: str | None = None,
                               bootstrap: bool = False) -> dict[str, DataFrame]:
    """``competitor_procedure``, and the cells and pivot of the new sheet from those of the old one.

    The pivot then takes the rows that the batch replaced or added, not the sheet. Cells of
    another cross reference, or none, are made from the whole new sheet.
    """
    publish, feed, line_map, sheet, comp_xref = _under(collation, publish, feed, line_map, sheet, comp_xref)
    mark = increments.xref_mark(comp_xref)
    known = None if cells is None else collated(cells, collation).filter(F.col("XrefMark") == mark).drop("XrefMark")
    usable = known is not None and not known.isEmpty()      # empty cells bear no mark
    batch = competitor.gated_batch(feed, line_map, sheet, bootstrap)
    if batch is None:
        sheet2 = publish(sheet.select(*competitor.SHEET_COLUMNS), "comp_sheet")
        cells2 = known if usable else increments.pivot_cells(sheet2, comp_xref)
    else:
        batch = materialize(batch, "competitor-batch")
        sheet2 = publish(competitor.upsert_competitor(sheet, batch), "comp_sheet")
        cells2 = (increments.change_cells(known, *increments.sheet_changes(sheet, batch), comp_xref) if usable
                  else increments.pivot_cells(sheet2, comp_xref))
    cells2 = publish(cells2.withColumn("XrefMark", F.lit(mark)), "comp_cells")
    return {"sheet": sheet2, "cells": cells2,
            "comp_pivot": publish(increments.competitor_price_pivot(cells2), "comp_pivot")}


def pivot_procedure(sheet: DataFrame, comp_xref: DataFrame, comparison: DataFrame,
                    publish: Publish, collation: str | None = None) -> dict[str, DataFrame]:
    """Competitor and retail price pivots."""
    publish, sheet, comp_xref, comparison = _under(collation, publish, sheet, comp_xref, comparison)
    return {"comp_pivot": publish(pivots.competitor_price_pivot(sheet, comp_xref), "comp_pivot"),
            "retail_pivot": publish(pivots.retail_price_pivot(comparison), "retail_pivot")}


def export_procedure(oe: DataFrame, publish: Publish, collation: str | None = None) -> dict[str, DataFrame]:
    """Numbered, tagged OE list."""
    publish, oe = _under(collation, publish, oe)
    return {"export": publish(export.oe_tagged_export(oe), "export")}
