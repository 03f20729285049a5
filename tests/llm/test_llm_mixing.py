"""Mixing to target weights."""

import random
import re
from collections import Counter

import pytest
from conftest import SF_SMALL
from llm_data import CLASHING, no_docs, odd_docs

from quillprice.llm.mixing import document_copies, mix, source_targets
from quillprice.llm.queries import OP1_SQL, op1_mixing
from quillprice.oracle.compare import compare, duckdb_connection


def shared(sizes, weights, most=3):
    """Targets by sharing what is over again and again among the sources below their limit."""
    total, target = sum(sizes), [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    left = float(total)
    while open_:
        each = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if each * weights[i] > most * sizes[i]}
        if not full:
            for i in open_:
                target[i] = each * weights[i]
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= full
    return target


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(5)
    for _ in range(3):
        names = [f"s{i:02d}" for i in range(9)] + [None]
        sizes = [rng.choice([0, 3, 50, 900, 40_000]) for _ in names]
        got = source_targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()
        want = shared(sizes, [i % 3 + 1 for i in range(len(names))])
        assert {r.source: pytest.approx(r.target, abs=1e-6) for r in got} == dict(zip(names, want))
        assert sum(r.target for r in got) == pytest.approx(sum(sizes))


def test_query_equals_sql_and_meets_targets(spark):
    con = duckdb_connection(SF_SMALL)
    got = op1_mixing(spark, SF_SMALL)
    ok, _, _, detail = compare(got, con, OP1_SQL)
    assert ok, detail
    rows = got.collect()
    assert all(r.taken <= 3 * r["size"] for r in rows)
    longest = max(r["size"] for r in rows)
    taken, target = Counter(), {}
    by_id = {r.doc_id: r for r in rows}
    for doc_id, source in con.execute("SELECT doc_id, source FROM documents").fetchall():
        taken[source] += by_id[doc_id].taken
        target[source] = by_id[doc_id].target
    assert all(abs(taken[s] - target[s]) <= 2 * longest for s in target)


@pytest.mark.parametrize("clash", [False, True])
def test_mix_emits_each_document_as_often_as_its_copies(spark, clash):
    docs = odd_docs(spark, clash)
    copies = Counter()
    for r in document_copies(docs, ["doc_id", "text"]).collect():
        copies[r.doc_id, r.text] += r.copies
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and r.copies <= 3
    out = mix(docs)
    assert out.columns == docs.columns and (not clash or set(CLASHING) <= set(out.columns))
    rows = out.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == +copies
    assert not clash or all(r["copies"] == "own copies" for r in rows)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mix(docs.repartition(5)).collect()))


def test_empty_table(spark):
    assert mix(no_docs(spark)).count() == 0


def test_a_hot_source_of_equal_documents_meets_its_target(spark):
    rows = [(i, "w " * 10, "en", "hot", 0) for i in range(900)] + [(1000 + i, "w " * 10, "en", f"s{i}", 0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(8)
    got = document_copies(df, ["doc_id"]).collect()
    by = Counter()
    for r in got:
        by[r.source] += r["size"] * r.copies
    assert all(abs(by[r.source] - r.target) <= 10 for r in got)
