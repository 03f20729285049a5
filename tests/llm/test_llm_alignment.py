"""Cross-tokenizer alignment against a plain version that compares byte ranges token by token."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from llm_data import no_docs, odd_docs

from quillprice.llm import alignment
from quillprice.llm.alignment import ByteTokens, PieceTokens, align, containers, default_paths, documents_of, pieces
from quillprice.llm.queries import op12_alignment


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = default_paths()
    plain = Tokenizer.from_file(a)
    plain.encode_special_tokens = True
    return plain, sentencepiece.SentencePieceProcessor(model_file=b), ByteTokens(open(a, "rb").read()), \
        PieceTokens(open(b, "rb").read())


def plain_groups(text, libraries):
    """(A ids, B ids, links, groups) by walking the byte ranges, or nothing."""
    plain, pieces_, a, b = libraries
    if not text:
        return [], [], [], []
    ids = plain.encode(" " + text, add_special_tokens=False).ids, pieces_.encode(text)
    spans = []
    for tokens, table in zip(ids, (a.bytes, b.bytes)):
        if b"".join(table[i] for i in tokens) != (" " + text).encode():
            return [], [], [], []
        at, out = 0, []
        for i in tokens:
            out.append((i, at, at + len(table[i])))
            at += len(table[i])
        spans.append(out)
    links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e] if len(ids[0]) < 400 else \
        sweep(*spans)
    groups, rest = [], [list(s) for s in spans]
    for end in sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]}):
        groups.append("|".join(",".join(str(i) for i, _, e in r if e <= end) for r in rest))
        rest = [[x for x in r if x[2] > end] for r in rest] if len(ids[0]) < 400 else [r[sum(e <= end for *_, e in r[:200]):] for r in rest]
    return *ids, links, groups


def sweep(a, b):
    out, j = [], 0
    for i, s, e in a:
        while j < len(b) and b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            out.append((i, b[k][0]))
            k += 1
    return out


def expected(rows, libraries):
    cut = [(i, *plain_groups(t, libraries)) for i, t in rows]
    count = Counter(p for *_, links, _ in cut for p in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    docs = [(i, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links),
             sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
            for i, a, b, links, groups in cut]
    pairs = {p: (sum(p in links for links in (set(c[3]) for c in cut)), n, n == most[p[1]]) for p, n in count.items()} \
        if len(rows) < 50 else None
    return docs, pairs


ODD = [(1, "hello world"), (1, "hello world"), (2, None), (3, ""), (4, " "), (5, "  two  blanks\n\n\tand tabs \r\n"),
       (6, "<|endoftext|> and <s> </s> <unk> <0x0A>"), (7, "a▁b"), (8, "日本語のテキスト 👩‍👩‍👧 ﬁ é é"), (9, "\x00\x01\x7f"),
       (None, "hello hello hello hello hello"), (10, "don't we'll I'M 12345 67 8.9"), (11, "x" * 3000),
       (12, " " * 1500 + "end"), (13, "ab " * 2000), (14, " nbsp　wide")]


def test_equals_the_plain_version_with_small_pieces_and_blocks(spark, libraries, monkeypatch):
    rng = random.Random(4)
    letters = "ab e'\né中.,1 "
    rows = ODD + [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for i in range(30)]
    want, _ = expected(rows, libraries)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' AS block", "'own' AS pair", "1 AS at")
    docs, _ = align(df.repartition(3), keep_groups=True)
    got = docs.collect()
    assert sorted(((r.doc_id or 0), *tuple(r)[1:8]) for r in got) == sorted(((d[0] or 0), *d[1:]) for d in want)
    assert all((hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "") == r.groups_sha256 for r in got)


def test_pairs_are_counted_by_documents_and_links(spark, libraries):
    rows = [(i, t) for i, (_, t) in enumerate(ODD[:10])]
    docs, pairs = align(spark.createDataFrame(rows, "doc_id long, text string"))
    want, by_pair = expected(rows, libraries)
    assert {(r.a_id, r.b_id): (r.docs, r.links, r.best) for r in pairs.collect()} == by_pair
    assert sum(n for _, n, _ in by_pair.values()) == sum(r.n_links for r in docs.collect())


def test_query_equals_the_plain_version(spark, libraries):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    want, _ = expected(rows, libraries)
    got = [tuple(r) for r in op12_alignment(spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(want)


def test_pieces_have_the_tokens_of_the_whole(libraries):
    plain, pieces_, a, b = libraries
    rows = [t for t, in duckdb.sql(f"SELECT text FROM '{SF_SMALL}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    for text in rows[:60] + [t for _, t in ODD if t]:
        whole = " " + text
        for size in (1, 7, 100):
            parts = list(pieces(text, size)) if size > 1 else alignment._CUT.split(text)
            assert " ".join(parts) == text
            assert sum((a.encode(" " + p) for p in parts), []) == plain.encode(whole, add_special_tokens=False).ids
            assert sum(map(b.encode, parts), []) == pieces_.encode(text)


def test_documents_over_many_chunks_and_small_blocks(spark, libraries, monkeypatch):
    """The work of a task, with limits so low that each applies."""
    rows = [(i, ("some words again and again. " * (1 + i % 7)) + f"own {i}") for i in range(40)]
    want, _ = expected(rows, libraries)
    a, b = libraries[2:]
    for chars in (1 << 20, 40):
        for name, value in (("CHUNK", 60), ("PIECE", 20), ("BLOCK_ENTRIES", 50), ("BLOCK_DOCS", 4096), ("WORDS_CHARS", chars)):
            monkeypatch.setattr(alignment, name, value)
        monkeypatch.setattr(alignment, "pieces", lambda text, f=pieces: f(text, 20))
        words, got, block = alignment.Words(a, b), [], alignment.Block()
        texts = pa.array([t.encode() for _, t in rows], pa.binary())
        runs = list(alignment._chunks(texts))
        assert [lo for lo, _ in runs][1:] == [hi for _, hi in runs][:-1] and runs[-1][1] == len(rows) and len(runs) > 10
        for lo, hi in runs:
            for (i, _), at in zip(rows[lo:hi], alignment._placed([t for _, t in rows[lo:hi]], words)):
                block.add(i, words, at, False)
            if words.size > chars:
                words.clear()
        got = [tuple(d[k] for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")) for d in block.docs]
        assert got == [(*d[:5], d[7]) for d in want]


def test_a_block_that_closes_in_a_chunk_keeps_the_words_of_the_rest(spark, libraries, monkeypatch):
    """Tasks with more distinct words than they keep, blocks that end in the middle of a chunk, and several chunks."""
    rows = [(i, ("some words again and again. " * (1 + i % 7)) + f"own {i}") for i in range(40)] + ODD
    want, _ = expected(rows, libraries)
    monkeypatch.setattr(alignment, "WORDS_CHARS", 40)
    monkeypatch.setattr(alignment, "BLOCK_ENTRIES", 50)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "12")
    try:
        docs, _ = align(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    finally:
        spark.conf.set(size, before)
    assert sorted((r[0] or 0, *tuple(r)[1:]) for r in docs.collect()) == sorted((d[0] or 0, *d[1:]) for d in want)


def test_bitmaps_come_back():
    rng = np.random.default_rng(1)
    key, doc = [], []
    for k, n in ((3, 1), (5, 255), (6, 256), (9, 4096), (12, 7)):
        key += [k] * n
        doc += sorted(rng.choice(4096, n, replace=False).tolist())
    keys, bitmaps = containers(np.array(key), np.array(doc))
    rows, docs = documents_of(bitmaps)
    assert sorted(zip(keys[rows].tolist(), docs.tolist())) == sorted(zip(key, doc))
    assert max(len(x.as_py()) for x in bitmaps) == 512
    keys, bitmaps = containers(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert len(keys) == len(bitmaps) == 0


def test_odd_and_no_rows(spark, libraries):
    docs, _ = align(odd_docs(spark, clash=True))
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    cut = {i: t for i, t in rows if i in (1, 3, 4, 5, 8, 10)}
    got = docs.collect()
    assert len(got) == 12 and sum(r.doc_id == 8 for r in got) == 2
    assert all((r.n_a > 0) == bool(cut[r.doc_id]) for r in got if r.doc_id in cut)
    bad = spark.createDataFrame([(1, b"a\xffb")], "doc_id long, raw binary").selectExpr("doc_id", "CAST(raw AS string) AS text")
    assert [tuple(r) for r in align(bad)[0].collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
    docs, pairs = align(no_docs(spark))
    assert docs.count() == pairs.count() == 0
