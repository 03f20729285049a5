"""Training-data operators: one module each, registered in ``queries``.

Nothing else in the library imports this subpackage.
"""

from quillprice.llm.queries import ORACLE, QUERIES


def queries():
    """Query name -> (spark, sf_dir) -> DataFrame."""
    return dict(QUERIES)


def oracle_sql():
    """Query name -> DuckDB SQL, where SQL can express the operator."""
    return dict(ORACLE)
