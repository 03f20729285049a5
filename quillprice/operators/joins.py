"""Join helpers: the anti/left-join forms the reference writes as LEFT JOIN ... IS NULL,
and a lookup join that stays even under hot keys.

No join is hinted. The rule and code tables are inline ``VALUES`` relations or
stored tables, so the planner knows their bytes and broadcasts them under
``spark.sql.autoBroadcastJoinThreshold``; beyond it, AQE decides from the
sizes at run time and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.session import materialize


def anti_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """LEFT JOIN right ON keys WHERE right.key IS NULL  ==  left_anti.

    Rows of ``left`` with a NULL key never match, so they are kept, as in the
    reference. ``on`` lists (left column, right column) pairs.
    """
    r = right.select(*[F.col(rc).alias(f"__r{i}") for i, (_, rc) in enumerate(on)])
    cond = [left[lc] == r[f"__r{i}"] for i, (lc, _) in enumerate(on)]
    return left.join(r, cond, "left_anti")


def lookup_join(big: DataFrame, lookup: DataFrame, on: list[tuple[str, str]],
                how: str = "left") -> DataFrame:
    """Join a big frame to a lookup that has one row per key, safe for hot keys.

    The lookup is stored first. Its size is then known, so a small one is
    broadcast and the big side does not move. A large one is read back as a
    plain table: both sides of the join are then shuffles of their own, which
    is what AQE needs to split a key (or the NULL keys, which match nothing)
    that holds a large share of the rows, identical rows included.
    ``on`` lists (big column, lookup column) pairs.
    """
    stored = materialize(lookup, "lookup")
    return big.join(stored, [big[b] == stored[k] for b, k in on], how)
