"""Exact dedup by Grace hashing, and line dedup."""

import hashlib
import random
from collections import defaultdict

import pytest
from conftest import SF_SMALL
from llm_data import no_docs, odd_docs

from quillprice.llm.exact_dedup import GraceTable, exact_dedup, exact_groups
from quillprice.llm.line_dedup import remove_boilerplate
from quillprice.llm.queries import OP8_SQL, OP9_SQL, op8_exact_dedup, op9_line_dedup
from quillprice.oracle.compare import compare, duckdb_connection


@pytest.mark.parametrize("query, sql", [(op8_exact_dedup, OP8_SQL), (op9_line_dedup, OP9_SQL)])
def test_query_equals_sql(spark, query, sql):
    ok, _, _, detail = compare(query(spark, SF_SMALL), duckdb_connection(SF_SMALL), sql)
    assert ok, detail


@pytest.mark.parametrize("table_bytes", [1, 2_000, 1 << 20])
@pytest.mark.parametrize("hashed", [lambda c: hash(c), lambda c: hash(c) % 3, lambda c: 0])
def test_grace_table_spills_and_compares_contents(tmp_path, table_bytes, hashed):
    rng = random.Random(1)
    contents = [bytes([rng.randrange(5) for _ in range(rng.randint(0, 4))]) for _ in range(3000)]
    table = GraceTable(lambda a, b: a + b, f"file://{tmp_path}/spill", table_bytes)
    for c in contents:
        table.add(hashed(c), c, 1)
    assert (table.spills is not None) == (table_bytes < 1 << 20)
    got = list(table.groups())
    assert len(got) == len(dict(got)) and dict(got) == {c: contents.count(c) for c in set(contents)}
    assert not any(p.is_file() for p in tmp_path.rglob("*"))


@pytest.mark.parametrize("table_bytes", [1, 1 << 20])
def test_odd_rows(spark, table_bytes):
    docs = odd_docs(spark, clash=True)
    rows = exact_groups(docs, table_bytes).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    want = {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert len(rows) == 12 and all((r.keep_id, r.group_size) == by_sha[r.text_sha256] for r in rows)
    assert sorted((r.doc_id or 0) for r in rows if r.kept) == sorted((k or 0) for k, _ in want.values())
    kept = exact_dedup(docs, table_bytes)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    out = kept.collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 2, 4, 5, 6, 7, 8, 9, 10]
    assert [r.text for r in out if r.doc_id == 4] == [None] and all(r["row"] == "own row" for r in out)
    assert exact_groups(no_docs(spark)).count() == exact_dedup(no_docs(spark)).count() == 0


def test_a_hot_group_reaches_the_shuffle_once_for_each_batch(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = exact_groups(docs).collect()
    assert {r.group_size for r in got} == {1, 2000}
    assert {r.keep_id for r in got if r.group_size == 2000} == {2999}
    from quillprice.llm.exact_dedup import _LOCAL, _collapse
    from pyspark.sql import functions as F
    local = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(_collapse, _LOCAL)
    assert local.filter("first AND text = 'the same text'").count() == 6


def test_lines_on_many_sites_go(spark):
    def text(*lines):
        return "\n".join(lines)
    common, near, few = "a line on very many sites", "版权所有", "a line on only four sites"
    rows = [(i, text(common, f"own words of document {i}", " " + common + "\t\r", "short one", " \t"), f"s{i}") for i in range(40)]
    rows += [(100 + i, text(near, near), f"s{i % 5}") for i in range(15)]
    rows += [(200 + i, text(few, "", few), f"s{i % 4}") for i in range(16)]
    rows += [(300, None, "s1"), (301, "", None), (302, common, None), (302, common, None), (None, common, "s2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = remove_boilerplate(docs.selectExpr("*", "'x' AS n_lines", "'y' AS `row`", "'z' AS __cut"))
    assert got.columns == ["doc_id", "text", "source", "row", "__cut", "n_lines", "n_removed"]
    out = got.collect()
    assert len(out) == len(rows)
    by = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out}
    assert by[3] == ("own words of document 3\n \t", 5, 3)
    assert by[104] == ("", 2, 2) and by[204] == (text(few, "", few), 3, 0)
    assert by[300] == (None, 0, 0) and by[301] == ("", 1, 0) and by[302] == ("", 1, 1) and by[None] == ("", 1, 1)
    assert sum(r.doc_id == 302 for r in out) == 2
    assert remove_boilerplate(no_docs(spark)).count() == 0


def test_a_high_threshold_equals_an_exact_count(spark):
    rows = [(1000 * k + s, f"line {k}\nown {k} {s}", f"site {s}") for k in range(60) for s in range(170 + k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = remove_boilerplate(docs, min_sites=200).groupBy("n_removed").count().collect()
    want = sum(170 + k for k in range(60) if 170 + k >= 200)
    assert {r.n_removed: r["count"] for r in out} == {1: want, 0: len(rows) - want}


def test_a_text_of_very_many_boilerplate_lines_takes_linear_work(spark):
    import time
    text = "\n".join(f"line {i}" for i in range(200_000))
    docs = spark.createDataFrame([(i, text + f"\nown {i}", f"s{i}") for i in range(5)],
                                 "doc_id long, text string, source string")
    began = time.time()
    out = {r.doc_id: (r.text, r.n_removed) for r in remove_boilerplate(docs).collect()}
    assert out == {i: (f"own {i}", 200_000) for i in range(5)}
    assert time.time() - began < 60


def test_bytes_that_are_no_utf8_are_kept(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, b"a\xffb"), (2, b"a\xfeb"), (3, b"a\xffb")], "doc_id long, raw binary")
    docs = docs.select("doc_id", F.col("raw").cast("string").alias("text"))
    kept = exact_dedup(docs).select("doc_id", F.col("text").cast("binary").alias("raw")).collect()
    assert sorted((r.doc_id, bytes(r.raw)) for r in kept) == [(2, b"a\xfeb"), (3, b"a\xffb")]
