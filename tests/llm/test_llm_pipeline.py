"""The corpus pipeline, stage by stage, against plain versions."""

import hashlib
from collections import Counter

import pytest
from conftest import SF_SMALL
from llm_data import CLASHING, no_docs, odd_docs
from test_llm_simhash import plain_fingerprint, smallest_reachable

import corpus_pipeline
from quillprice.llm import bpe
from quillprice.session import materialize

NAMES = ["quality", "exact dedup", "simhash near-dedup", "mixing", "bpe"]


def test_stages_and_registration():
    import __spark_entry__ as entry
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


def test_each_stage_against_its_own_input(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    held = {}
    for name in NAMES:
        before = docs.collect()
        docs = materialize(stages[name](spark, docs, SF_SMALL), "test-stage")
        held[name] = before, docs.collect()
        assert name == "bpe" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    import duckdb
    quality = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_SMALL}/labels.parquet'").fetchall())
    kept = {r.doc_id for r in held["quality"][1]}
    assert set(held["quality"][1]) <= set(held["quality"][0])
    known = [r.doc_id for r in held["quality"][0] if r.doc_id in quality]
    assert sum((i in kept) == quality[i] for i in known) > 0.95 * len(known)

    best = {}
    for r in held["exact dedup"][0]:
        best[r.text] = max(best.get(r.text, r), r, key=lambda x: x.doc_id)
    assert sorted(best.values()) == sorted(held["exact dedup"][1])

    group = smallest_reachable({r.doc_id: plain_fingerprint(r.text) for r in held["simhash near-dedup"][0]})
    assert sorted(r for r in held["simhash near-dedup"][0] if group[r.doc_id] == r.doc_id) == \
        sorted(held["simhash near-dedup"][1])

    before, after = held["mixing"]
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    assert sum(len(r.text.split()) for r in after) == pytest.approx(sum(len(r.text.split()) for r in before), rel=0.2)

    tok = Tokenizer.from_file(bpe.default_path())
    want = Counter()
    for r in held["bpe"][0]:
        ids = tok.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in held["bpe"][1]) == want


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and Counter(rows) == Counter(corpus_pipeline.run(spark, SF_SMALL).collect())


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark, clash=True)
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF_SMALL), "test-odd")
        assert name == "bpe" or out.columns == docs.columns
        if name != "bpe":
            assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHING)
        assert stage(spark, no_docs(spark), SF_SMALL).count() == 0
