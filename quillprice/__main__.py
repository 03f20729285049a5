"""Run one procedure on stored tables.

    python -m quillprice price-sheet --tables DIR --out DIR --sheet FILE [--load-ts TS]
                                     [--max-errors N]
    python -m quillprice retail      --tables DIR --out DIR [--incremental]
    python -m quillprice competitor  --tables DIR --out DIR [--bootstrap] [--incremental]
    python -m quillprice pivots      --tables DIR --out DIR
    python -m quillprice export      --tables DIR --out DIR
    python -m quillprice seed        --testdata SF_DIR --out DIR

``--tables`` holds one parquet folder per input table, named by role
(``rules_calc``, ``retail_import``, ... see ``TABLES``; layouts in FIXTURES.md
§A). All tables that a procedure publishes become current under ``--out`` at once,
by its manifest (``sources.runs``); a run that fails changes none of them, and a run
under a ``--run-id`` that was committed before does nothing. Tables that a procedure
changes (matrix, upload queue, registries, competitor sheet) go on from the version
published there, the pivots read the competitor sheet and the retail comparison that
were; the folders in ``--tables`` count only where ``--out`` has none. The matrix is
kept by price group, and a run reads and writes the groups of its prices alone.
A sheet with more than ``--max-errors`` bad lines (default 0) aborts the run and all of them are
named; up to that many are left out and published as ``price_sheet_rejects``.
``retail --incremental`` takes ``retail_import`` as a new batch of the feed and merges it
into the published state of the batches before (made from the published feed, if there is
no state yet). ``competitor --incremental`` also publishes the competitor pivot, from
its published cells and the sheet rows that changed.
``--collation`` (such as UTF8_LCASE_RTRIM) is that of all text comparisons.
``seed`` writes such a table folder (and a price sheet file
``price_sheet.tsv``) from the testdata adapters. Run under ``spark-submit``
on a cluster; plain ``python -m`` gives a local session.
"""

from __future__ import annotations

import argparse

from quillprice.operators.routines import PricingInputs
from quillprice.plans import procedures as P
from quillprice.plans.increments import shop_state
from quillprice.session import submitted_session
from quillprice.sources.pricesheet import load_price_sheet
from quillprice.sources.runs import Run, published as current_table

# Input table folders (the reference-shaped tables of FIXTURES.md §A, by role).
TABLES = ("rules_list", "rules_calc", "base_ranks", "tax_pdm0", "tax_pdm1", "tax_setup",
          "price_file", "price_group", "xref", "pack_lookup", "matrix", "upload_queue",
          "retail_import", "brand_registry", "part_registry", "price_new", "price_sheets",
          "comp_feed", "line_map", "comp_sheet", "comp_xref", "oe_list")


def main(argv=None, spark=None) -> None:
    ap = argparse.ArgumentParser(prog="quillprice")
    ap.add_argument("procedure", choices=["price-sheet", "retail", "competitor", "pivots",
                                          "export", "seed"])
    ap.add_argument("--tables")
    ap.add_argument("--out", required=True)
    ap.add_argument("--sheet")
    ap.add_argument("--load-ts")
    ap.add_argument("--bootstrap", action="store_true")
    ap.add_argument("--testdata")
    ap.add_argument("--run-id")
    ap.add_argument("--collation")
    ap.add_argument("--incremental", action="store_true")
    ap.add_argument("--max-errors", type=int, default=0)
    a = ap.parse_args(argv)
    own = spark is None
    spark = spark or submitted_session()
    out = a.out.rstrip("/")

    if a.procedure == "seed":
        from quillprice.sources.fixtures import Fixtures
        fx = Fixtures(spark, a.testdata)
        for name in TABLES:
            getattr(fx, name).write.parquet(f"{out}/{name}")
        from quillprice.sources.pricesheet import write_price_sheet
        write_price_sheet(fx.ps_load, f"{out}/price_sheet.tsv")

    def t(name):
        return spark.read.parquet(f"{a.tables.rstrip('/')}/{name}")

    def published(name, seed=None):
        made = current_table(spark, out, name)
        return t(seed or name) if made is None else made

    run = None if a.procedure == "seed" else Run(spark, out, a.run_id)
    if run is None or run.done:
        pass
    elif a.procedure == "price-sheet":
        load, rejects = load_price_sheet(spark, a.sheet, a.max_errors)
        run.publish(rejects, "price_sheet_rejects")
        inp = PricingInputs(
            load=load, rules_list=t("rules_list"),
            rules_calc=t("rules_calc"), ranks=t("base_ranks"),
            pdm0=t("tax_pdm0"), pdm1=t("tax_pdm1"), setup=t("tax_setup"),
            price_file=t("price_file"), price_group=t("price_group"),
            xref=t("xref"), pack=t("pack_lookup"), load_ts=a.load_ts)
        P.price_sheet_procedure(inp, published("matrix"), published("queue", "upload_queue"), run.publish,
                                a.collation, run.refresh_groups)
    elif a.procedure == "retail":
        feed, state = t("retail_import"), current_table(spark, out, "shop_state")
        tables = (published("retail_brand", "brand_registry"), published("retail_parts", "part_registry"),
                  t("price_new"), t("price_sheets"), t("xref"), t("base_ranks"), run.publish, a.collation)
        if a.incremental:
            before = current_table(spark, out, "import_retail") if state is None else None
            P.retail_batch_procedure(feed, shop_state(before) if before is not None else state, *tables)
        else:
            P.retail_procedure(feed, *tables)
            if state is not None:                    # batches to come go on from this feed
                run.publish(shop_state(feed), "shop_state")
    elif a.procedure == "competitor":
        inputs = t("comp_feed"), t("line_map"), published("comp_sheet")
        cells = current_table(spark, out, "comp_cells")
        if a.incremental:
            P.competitor_cells_procedure(*inputs, t("comp_xref"), cells, run.publish, a.collation, a.bootstrap)
        else:
            P.competitor_procedure(*inputs, run.publish, a.collation, a.bootstrap)
            if cells is not None:                    # none of a sheet before this one may stay
                run.publish(cells.filter("false"), "comp_cells")
    elif a.procedure == "pivots":
        P.pivot_procedure(published("comp_sheet"), t("comp_xref"), published("retail_prices"), run.publish,
                          a.collation)
    elif a.procedure == "export":
        P.export_procedure(t("oe_list"), run.publish, a.collation)
    if run is not None:
        run.commit()
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
