"""Collation of text comparisons.

The server collation of the reference is not known. By default text is compared
by its bytes. With a collation every text column of a procedure's inputs carries
it, and Spark applies it wherever text is compared: join and group keys, DISTINCT,
anti joins, LIKE, MAX and ORDER BY. Stored tables keep it.

Of values that are equal under a collation any one may stand for its group,
as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY = None
#: Ignoring case; ignoring case and trailing blanks (as ``=`` of the usual server collations does).
IGNORE_CASE = "UTF8_LCASE"
IGNORE_CASE_AND_TRAILING_BLANKS = "UTF8_LCASE_RTRIM"


def collated(df: DataFrame, collation: str | None) -> DataFrame:
    """``df`` with every text column under the collation; None leaves it as it is."""
    if collation is None:
        return df
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.collate(F.col(f"`{c}`"), collation).alias(c) if c in text else F.col(f"`{c}`")
                       for c in df.columns])


def union_into(table: DataFrame, added: DataFrame) -> DataFrame:
    """UNION ALL by name; text of ``added`` takes the collations of the table's columns."""
    kinds = {f.name: f.dataType for f in table.schema.fields if isinstance(f.dataType, T.StringType)}
    return table.unionByName(added.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`")
                                            for c in added.columns]))
