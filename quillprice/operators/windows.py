"""Window operators.

W01 numbers rows in one global order without moving all rows into one task:
a range shuffle sorts the rows into ordered partitions, each partition counts
its rows, and a running sum over those counts (one row per partition, so its
size is bounded by the partition count) gives every partition its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillprice.session import materialize

_PID, _POS, _TIE, _N, _OFF = "__pid", "__pos", "__tie", "__n", "__off"


def _asc(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.asc_nulls_first()


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is one stored table, filtered or projected at most, so that its rows come in a fixed order."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        if not node.deterministic():
            return False
        node = node.children().head()
    return node.nodeName().startswith("LogicalRelation")


def ordered_partitions(df: DataFrame, order_by: list[str],
                       num_partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order_by`` plus a tie-breaker, then stored.

    Adds ``__pid`` (partition index) and ``__pos`` (0-based position in the
    partition). The tie-breaker makes every row's sort key unique, so the
    range boundaries can cut through a hot key or a group of copies.

    The ranged rows are written to the shared checkpoint folder: every later
    read of ``__pid`` and ``__pos`` sees the same stored values, so nothing rests
    on two range shuffles sampling alike or on one being reused. The rows must
    have the same tie-breaker whenever a lost task is run again. Rows of a plain
    scan do, as files are read in their order; other rows come in the order in
    which shuffles deliver them and are stored with their tie-breaker first.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = [_asc(c) for c in order_by] + [F.col(_TIE).asc()]
    tagged = df.withColumn(_TIE, F.monotonically_increasing_id())
    if not is_scan(df):
        tagged = materialize(tagged, "row-number")
    ranged = (tagged.repartitionByRange(n, *ordered)
                    .sortWithinPartitions(*ordered)
                    .withColumn(_PID, F.spark_partition_id())
                    .withColumn(_POS, F.monotonically_increasing_id()
                                - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    return materialize(ranged, "ranged")


def global_row_number(df: DataFrame, order_by: list[str], id_col: str = "id",
                      num_partitions: int | None = None, start=0) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order_by) as bigint, computed in parallel.

    NULLs sort first, as in T-SQL. Rows that tie on every ordering column are
    split across partitions by a per-row tie-breaker, so a hot key or a group
    of identical rows does not land in one task. Tied rows receive
    consecutive numbers in an unspecified order (as ROW_NUMBER does).

    Positions and per-partition counts are read from one stored table
    (``ordered_partitions``), whatever other columns ``df`` has.
    Numbers run from ``start + 1``; ``start`` is an int or a one-column
    DataFrame holding at most one row (e.g. the highest id already used),
    which then enters the running sum as a partition before the first.
    """
    ranged = ordered_partitions(df, order_by, num_partitions)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    if isinstance(start, DataFrame):
        base = start.select(F.lit(-1).alias(_PID),
                            F.coalesce(F.col(start.columns[0]).cast("long"), F.lit(0)).alias(_N))
        counts, start = counts.unionByName(base), 0
    # One row per range partition (plus the start row): the window and the
    # broadcast below are bounded by the partition count, not by the data.
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum(_N).over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_OFF))
    return (ranged.join(F.broadcast(offsets.filter(F.col(_PID) >= 0)), _PID)
                  .withColumn(id_col, (F.col(_OFF) + F.col(_POS) + F.lit(start + 1)).cast("long"))
                  .drop(_PID, _POS, _TIE, _OFF))


def partition_row_number(df: DataFrame, partition_by: list[str], order_by: list[str],
                         rn_col: str = "RN") -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY ... ORDER BY ...)."""
    w = Window.partitionBy(*partition_by).orderBy(*[_asc(c) for c in order_by])
    return df.withColumn(rn_col, F.row_number().over(w).cast("long"))
