"""SimHash near-dedup against brute force."""

import re

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import no_docs, odd_docs

from quillprice.llm import simhash
from quillprice.llm.components import components
from quillprice.llm.queries import op2_simhash
from quillprice.llm.simhash import Trie, fingerprint, linked_leaves, links, near_dedup, near_duplicates, spanning_forest


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(fps, most=3):
    """Component of each id of {id: fingerprint}, by comparing all pairs."""
    found = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= most and found[j] < found[i]:
                    found[i], changed = found[j], True
    return found


@given(st.text(max_size=200))
@settings(max_examples=60, deadline=None)
def test_fingerprint_equals_plain_version(text):
    text = text.encode("utf-8", "replace").decode()
    assert fingerprint(text) == plain_fingerprint(text)


def test_long_fingerprint_is_taken_in_pieces():
    text = " ".join(str(i * i % 977) for i in range(140_000))
    assert fingerprint(text) == plain_fingerprint(text)


def close_keys(seed, n=150):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    near = base.copy()
    for i in range(n):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(b)
    return np.unique(np.concatenate([base, near, np.array([0, 1, 3, 7, 15, 1 << 63], np.uint64)]))


@pytest.mark.parametrize("frontier, leaves", [(1 << 18, 8), (7, 0), (64, 1)])
def test_traversal_finds_each_close_pair_once(monkeypatch, frontier, leaves):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    monkeypatch.setattr(simhash, "LEAVES", leaves)
    keys = close_keys(frontier)
    trie, got = Trie(keys), []
    for i, j in linked_leaves(trie, trie, 3):
        got += zip(i.tolist(), j.tolist())
    want = {(i, j) for i in range(len(keys)) for j in range(i, len(keys)) if int(keys[i] ^ keys[j]).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want


def test_spanning_forest_names_the_smallest():
    links_ = [(np.array([4, 2, 7]), np.array([5, 4, 8])), (np.array([1, 8]), np.array([2, 9]))]
    assert spanning_forest(10, links_).tolist() == [0, 1, 1, 3, 1, 1, 6, 7, 7, 7]


def test_blocks_of_any_size_give_the_same_links(spark):
    keys = close_keys(3)
    hot = np.uint64(0xABC) << np.uint64(52) | np.arange(60, dtype=np.uint64)     # many in one subtree
    keys = np.unique(np.concatenate([keys, hot]))
    fps = {i: int(k) for i, k in enumerate(keys)}
    nodes = spark.createDataFrame([(int(np.int64(np.uint64(k))), i) for i, k in fps.items()], "fp long, id long")
    want = smallest_reachable(fps)
    for block in (8192, 40, 5):
        found = {i: i for i in fps} | {r.node: r.component for r in components(links(nodes, 3, block)).collect()}
        assert found == want, block


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_brute_force(spark):
    import duckdb
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall())
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = smallest_reachable(fps)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in op2_simhash(spark, SF_SMALL).collect()}
    assert got == {i: (fps[i], want[i]) for i in fps}


def test_odd_rows(spark):
    rows = near_duplicates(odd_docs(spark)).collect()
    assert len(rows) == 12
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[3].fingerprint == "0" * 16 and {by[i].component_id for i in (3, 4, 5)} == {3}
    assert {by[i].component_id for i in (1, 2, 9)} == {1} and {by[i].component_id for i in (6, 7)} == {6}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    kept = near_dedup(odd_docs(spark, clash=True))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 8, 8, 10]
    assert kept.columns == odd_docs(spark, clash=True).columns
    assert near_duplicates(no_docs(spark)).count() == near_dedup(no_docs(spark)).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    a, b = "one text of five words", "quite another text that is like no other"
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, None), (4, ""), (4, b + " at all")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in near_dedup(docs).collect() if r.text) == \
        [(1, a), (2, b), (4, b + " at all")]


def test_blocks_are_the_largest_small_subtrees(spark):
    keys = close_keys(5)
    nodes = spark.createDataFrame([(int(np.int64(np.uint64(k))), i) for i, k in enumerate(keys)], "fp long, id long")
    for block in (1, 7, 50, 10_000):
        first, depth = simhash.trie_blocks(nodes, block)
        at = np.searchsorted(first, keys, "right") - 1
        assert np.bincount(at, minlength=len(first)).min() > 0 and np.bincount(at).max() <= block
        for k, d in zip(first.tolist(), depth.tolist()):        # one level up it would be too large
            assert d == 0 or sum(int(x) >> (65 - d) == k >> (65 - d) for x in keys) > block
