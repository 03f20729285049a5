"""BPE encoding and decoding against the tokenizers library."""

import hashlib
import json
import random

import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import no_docs, odd_docs
from tokenizers import Tokenizer

from quillprice.llm import bpe
from quillprice.llm.queries import op4_bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def own():
    with open(bpe.default_path(), encoding="utf-8") as f:
        return bpe.WordBpe(json.load(f), bpe.unicode_tables())


def same(own, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids, text
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


ODD = ["", " ", "Σας ΣΑΣ ΟΔΟΣ", "İstanbul ıI", "é café é", "<|endoftext|>a<|startoftext|> b<|endoftext",
       "a\x1cb\x1fc \x85d\xa0e　f", "'s'T're don't DON'T ''ll", "²³½ⅷ 12ab34", "日本語テスト한국어 ไทย", "👍🏽👨‍👩‍👧 ok",
       "aaaaaaaaaaaaaaaaaaaaaaa aaaa aaaaab", "</w> x</w>", "\u0000�​ zero", "ǅ ǈ ß ẞ ŉ", "-----==== !!!!!!!!!!!!!!",
       "ᫀ̂ ᫀ̂ Ᲊ \U00010d50 \U00013460"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(own, library, text):
    same(own, library, text)


@given(st.text(max_size=80))
@settings(max_examples=150, deadline=None)
def test_any_text(own, library, text):
    same(own, library, text)


def test_words_of_few_letters(own, library):
    rng = random.Random(3)
    for letters in ("ab", "thean", "abcdefghijklmnopqrstuvwxyz", "aeß"):
        same(own, library, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 18))) for _ in range(800)))


def test_small_caches_and_pieces_change_nothing(own, library, monkeypatch):
    text = "the thing then there thereby <|endoftext|> them " * 300
    for name, value in (("PIECE", 64), ("CACHED_WORDS", 4), ("CACHED_PAIRS", 3), ("TRIE_WORDS", 2)):
        monkeypatch.setattr(bpe, name, value)
    own.words.clear()
    same(own, library, text)
    assert "".join(bpe.pieces(text, 50)) == text


def test_shared_prefixes_are_worked_out_once(own, monkeypatch):
    steps = []
    real = bpe.WordBpe._last_token
    monkeypatch.setattr(bpe.WordBpe, "_last_token", lambda *a: steps.append(1) or real(*a))
    own.learn(["zzqxabc", "zzqxabd", "zzqxabde", "zzqx"])
    # inner nodes z zz zzq zzqx zzqxa zzqxab zzqxabd once each, and four word ends
    assert len(steps) == 7 + 4


def test_query_equals_library(spark, library):
    import duckdb
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall())
    for r in op4_bpe(spark, SF_SMALL).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_odd_rows(spark, library):
    docs = odd_docs(spark, clash=True)
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert len(rows) == 12 and rows[0].asDict().keys() == {*docs.columns, "ids", "decoded"}
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256) for r in bpe.digests(docs).collect() if r.doc_id in (3, 4, 5)} == {(0, empty)}
    assert bpe.digests(no_docs(spark)).count() == 0
