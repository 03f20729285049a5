"""Bench: the reference's five procedures end to end at one scale factor.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. Each procedure writes every table it publishes
(parquet, in a fresh folder under the session's checkpoint folder), so all
rows are computed and stored; nothing is collected to the driver. The
pre-existing tables (feeds, registries, competitor sheet, code tables) are
derived from the testdata and stored before timing starts, as they would
already exist; the price sheet is written as a tab-separated file and the
timed procedure loads it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillprice.operators.routines import PricingInputs  # noqa: E402
from quillprice.plans import procedures as P  # noqa: E402
from quillprice.session import local_session  # noqa: E402
from quillprice.sources.fixtures import LOAD_TS, Fixtures  # noqa: E402
from quillprice.session import scratch_path
from quillprice.sources.pricesheet import publish, read_price_sheet, write_price_sheet  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus=cpus)
    spark.range(1000).selectExpr("sum(id)").collect()            # JVM warm-up
    fx = Fixtures(spark, sf_dir)
    for existing in (fx.retail_import, fx.comp_feed, fx.brand_registry, fx.part_registry,
                     fx.comp_sheet, fx.tax_pdm1, fx.tax_setup, fx.price_sheets, fx.comp_xref):
        existing.count()                                          # pre-existing tables
    root = scratch_path(spark, "bench")
    sheet_file = write_price_sheet(fx.ps_load, f"{root}/price_sheet.tsv")   # the supplier file

    def pub(df, name):
        return publish(df, f"{root}/{name}")

    times, out = {}, {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out.update(fn())
        times[name] = round(time.perf_counter() - t0, 3)

    def price_sheet():
        inp = PricingInputs.from_fixtures(fx, LOAD_TS)
        inp.load = read_price_sheet(spark, sheet_file)            # S01: load the file
        return P.price_sheet_procedure(inp, fx.matrix, fx.upload_queue, pub)

    timed("price_sheet", price_sheet)
    timed("retail_survey", lambda: P.retail_procedure(
        fx.retail_import, fx.brand_registry, fx.part_registry, fx.price_new, fx.price_sheets,
        fx.xref, fx.base_ranks, pub))
    timed("competitor_upsert", lambda: P.competitor_procedure(
        fx.comp_feed, fx.line_map, fx.comp_sheet, pub))
    timed("pivots", lambda: P.pivot_procedure(out["sheet"], fx.comp_xref, out["comparison"], pub))
    timed("oe_export", lambda: P.export_procedure(fx.oe_list, pub))
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "reference_procedures_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
