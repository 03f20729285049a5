"""Physical-plan summary of the headline pipelines (final adaptive plans).

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
Each query is executed (collect) so the report shows the final AQE plan:
shuffles actually run, exchanges reused, broadcast / sort-merge joins,
single-partition exchanges and file scans. Tables that a query writes on its
way (registries, batches, numbered rows) are jobs of their own; their shuffles
are counted from their plans as they were written, and shown beside.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from pyspark.sql.readwriter import DataFrameWriter  # noqa: E402

from quillprice.registry import queries  # noqa: E402
from quillprice.session import local_session  # noqa: E402

KEYS = ["market_price_staging", "market_price_matrix_refresh", "upload_queue_refresh",
        "brand_registry_update", "part_registry_update", "update_enrich_clean_keys",
        "last_shop_summary", "brand_part_map", "retail_price_comparison", "high_water_gate",
        "competitor_incremental_upsert", "competitor_price_pivot", "retail_price_pivot",
        "oe_tagged_export"]


def summarize(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    lines = final.splitlines()
    shuffles = [l for l in lines if re.search(r"\bExchange (hash|range)partitioning", l)
                and "Reused" not in l]
    keys = set()
    for l in shuffles:
        m = re.search(r"(hash|range)partitioning\((.*), \d+\)", l)
        keys.add(re.sub(r"#\d+L?", "", m.group(2) if m else l.strip())[:70])
    keys = sorted(keys)
    return {
        "shuffles": len(shuffles),
        "reused": sum("ReusedExchange" in l for l in lines),
        "broadcast joins": sum("BroadcastHashJoin" in l for l in lines),
        "sort-merge joins": sum("SortMergeJoin" in l for l in lines),
        "single-partition": sum("SinglePartition" in l for l in lines),
        "scans": sum("FileScan" in l for l in lines),
        "python": sum("EvalPython" in l for l in lines),
        "shuffle keys": keys,
    }


WRITTEN: list[int] = []


def note_writes():
    """Count the shuffles of every table that is written from now on."""
    write = DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        plan = self._df._jdf.queryExecution().executedPlan().toString()
        WRITTEN.append(len(re.findall(r"Exchange (?:hash|range)partitioning", plan)))
        return write(self, *args, **kwargs)

    DataFrameWriter.parquet = noted


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    qs = queries()
    print(f"# Final physical plans at {sf_dir}\n")
    note_writes()
    print("| query | tables written before | shuffles in them | shuffles | reused | BHJ | SMJ | "
          "single-partition | scans | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for k in KEYS:
        WRITTEN.clear()
        df = qs[k](spark, sf_dir)
        df.collect()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {k} | {len(WRITTEN)} | {sum(WRITTEN)} | {s['shuffles']} | {s['reused']} | {s['broadcast joins']} | "
              f"{s['sort-merge joins']} | {s['single-partition']} | {s['scans']} | {s['python']} |")
        details.append((k, s["shuffle keys"]))
    print("\n## Shuffle keys\n")
    for k, keys in details:
        print(f"* **{k}**: " + "; ".join(f"`{x}`" for x in keys))


if __name__ == "__main__":
    main()
