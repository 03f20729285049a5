"""OE part list export (X12): globally numbered parts bracketed per manufacturer.

The reference numbers rows with ROW_NUMBER over (Manufacturer, PartNumber),
then walks a cursor over manufacturers inserting an open tag at min(id) - 1
and a close tag at max(id) + 1. Set-based here: one parallel global
numbering (W01), one MIN/MAX aggregate (A08), two projections, a union (U02)
and the final GROUP BY (A01).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.functions import text
from quillprice.functions.collation import union_into
from quillprice.operators.aggregates import min_max_by
from quillprice.operators.windows import global_row_number


def numbered_list(oe: DataFrame) -> DataFrame:
    """(Manufacturer, PartNumber, id) with id = ROW_NUMBER() OVER (ORDER BY both)."""
    return global_row_number(oe.select("Manufacturer", "PartNumber"),
                             ["Manufacturer", "PartNumber"], "id")


def tag_rows(numbered: DataFrame) -> DataFrame:
    """Open/close tag rows per manufacturer.

    A NULL manufacturer matches nothing in the cursor's lookups, so its tag
    rows carry a NULL tag and NULL id (they collapse into one in the final
    GROUP BY), as the reference produces.
    """
    mm = min_max_by(numbered, "Manufacturer", "id")
    m = F.col("Manufacturer")
    known = m.isNotNull()
    opening = mm.select(m, text.tag(True, m).alias("PartNumber"),
                        F.when(known, F.col("MinID") - 1).cast("long").alias("id"))
    closing = mm.select(m, text.tag(False, m).alias("PartNumber"),
                        F.when(known, F.col("MaxID") + 1).cast("long").alias("id"))
    return opening.unionByName(closing)


def oe_tagged_export(oe: DataFrame) -> DataFrame:
    """Body rows + tag rows, distinct. Tag ids overlap neighbours' ids
    (SURVEY Q19); order by (Manufacturer, id) to nest the tags."""
    numbered = numbered_list(oe)
    return union_into(numbered, tag_rows(numbered)).distinct()
