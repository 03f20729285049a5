"""The driver contract in __spark_entry__.py."""

import os
import subprocess
import sys

import __spark_entry__ as entry_module
from quillprice import registry
from quillprice.operators.routines import STAGING_NAMES

ROOT = os.path.dirname(os.path.abspath(entry_module.__file__))


def test_entry_runs_the_flagship_on_the_smallest_scale(spark):
    df = entry_module.entry(spark)
    assert df.columns == STAGING_NAMES
    assert df.count() > 0


def test_queries_and_oracle_cover_the_same_keys():
    q, o = entry_module.queries(), entry_module.oracle_sql()
    own = set(registry.queries())
    assert own <= set(q) and own == set(registry.oracle_sql())
    assert own <= set(o) <= set(q)
    assert all(callable(f) for f in q.values())


def test_entry_imports_without_the_optional_part():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['quillprice.llm'] = None; "
            "import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) > 100")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, timeout=120)
