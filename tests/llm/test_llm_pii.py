"""Personal data: base spans against the plain patterns, messages against enumeration, and what the field adds."""

import hashlib
import itertools
import random
import re
import time

import duckdb
import numpy as np
import pytest
from conftest import SF_CHECK
from llm_data import no_docs, odd_docs

from quillprice.llm import pii
from quillprice.llm.pii import KINDS, Variables, base_spans, fit, infer, marginals, personal_data
from quillprice.llm.queries import op11_pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            odd = [int(d) for d in digits[::-1]]
            checks = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                      "card": lambda: 14 <= len(digits) <= 19 and
                      sum(odd[::2] + [sum(divmod(2 * d, 10)) for d in odd[1::2]]) % 10 == 0,
                      "phone": lambda: 10 <= len(digits) <= 15}
            if checks[kind]():
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(7)
    for letters in ("a.@-_1 ", "0123456789.- ", "+(1). -2\n", "a@b.c_d+é", "4111 -", "25.60"):
        for _ in range(3000):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
            assert base_spans(text) == plain_spans(text), text
    for text, in duckdb.sql(f"SELECT text FROM '{SF_CHECK}/documents.parquet' WHERE text IS NOT NULL").fetchall():
        assert base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", ["a" * 3_000_000, "1" * 3_000_000, "1." * 1_500_000, "a@" * 1_000_000, "+1" * 1_000_000,
                                  "a@b" * 700_000, "1 " * 1_000_000, "a@b." * 700_000, "+1 ( " * 500_000, "a." * 1_500_000])
def test_very_long_texts_take_linear_time(text):
    began = time.time()
    Variables(text, base_spans(text))
    assert time.time() - began < 120


def enumerated(theta, edges):
    n, total = len(theta), np.zeros_like(theta)
    for labels in itertools.product(range(theta.shape[1]), repeat=n):
        score = sum(theta[i, y] for i, y in enumerate(labels)) + sum(p[labels[i], labels[j]] for i, j, p in edges)
        for i, y in enumerate(labels):
            total[i, y] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("links, close", [([(0, 1), (1, 2), (3, 4)], 1e-3), ([(0, 1), (1, 2), (2, 3), (0, 4)], 1e-3),
                                          ([(0, 1), (1, 2), (2, 3), (3, 4), (0, 3)], 0.08), ([], 1e-9)])
def test_messages_give_the_marginals(links, close):
    rng = np.random.default_rng(3)
    theta = rng.standard_normal((5, 5))
    pair = rng.standard_normal((len(links), 5, 5)) * 0.7
    i, j = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
    got = marginals(theta, i, j, pair.reshape(-1, 5, 5), 200)
    assert np.abs(got - enumerated(theta, [(a, b, p) for (a, b), p in zip(links, pair)])).max() < close


def test_distant_tokens_like_each_other_are_linked():
    text = "call +1 (017) 555-7713 today. Or 555-7713, or Mail a.b@c.org and A.B@C.ORG; v4.0 4.0 555 7713"
    one = Variables(text, base_spans(text))
    by = dict(zip(one.cores, range(len(one.cores))))
    assert one.link[one.cores.index("555-7713", by["(017)"] + 2)] == by["(017)"] + 1
    assert one.link[by["A.B@C.ORG"]] == by["a.b@c.org"]
    assert [KINDS[k - 1] for k in one.observed[:3]] == ["phone"] * 3 and one.observed[3] == 0
    assert one.next_to.tolist()[:4] == [False, True, True, False]


def docs_of(spark):
    """Documents to learn from, and cases that the patterns leave out."""
    rng = random.Random(5)
    rows = duckdb.sql("SELECT doc_id + 10000, text FROM '/root/testdata/sf0.1/documents.parquet' WHERE doc_id < 4000").fetchall()

    def words(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))

    def card():
        while True:
            digits = "".join(rng.choice("0123456789") for _ in range(16))
            if pii.luhn(digits):
                return digits
    rows.append((1000, f"{words(9)} +1 (017) 555-7713 {words(20)} (017) 555-7713 {words(3)} 555-7713."))
    one, two = card(), card()
    rows.append((1001, f"{words(6)} {one} {two} {words(5)}"))
    rows += [(1002, words(40)), (1003, f"{words(5)} 1987 {words(3)} 4.0 {words(2)} 12,500 {words(3)}"), (1004, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows), [one, two]


def test_the_field_adds_what_resembles_a_base_span(spark):
    docs, texts, numbers = docs_of(spark)
    got = {r.doc_id: r for r in personal_data(docs.repartition(3)).collect()}
    assert len(got) == len(texts)
    for i, r in got.items():
        base = [(s.start, KINDS.index(s.kind), s.end) for s in r.base]
        spans = [(s.start, KINDS.index(s.kind), s.end) for s in r.spans]
        assert base == plain_spans(texts[i] or "") and set(base) <= set(spans) and spans == sorted(spans)
        extra = sorted(set(spans) - set(base))
        assert not any(s < e2 and s2 < e for s, _, e in extra for s2, _, e2 in base)
    found = {i: [texts[i][s.start:s.end] for s in r.spans] for i, r in got.items() if texts[i]}
    assert found[1000] == ["+1 (017) 555-7713", "(017) 555-7713", "555-7713"]
    assert found[1001] == numbers and not got[1001].base
    assert found[1002] == found[1003] == [] and not got[1004].spans
    # Of the table's own documents few have more than their base spans, and what is added can be of its kind.
    more = [r for r in got.values() if len(r.spans) > len(r.base)]
    assert len(more) < len(got) / 100
    assert all(pii._possible(KINDS.index(s.kind), texts[r.doc_id][s.start:s.end]) for r in more for s in r.spans if s not in r.base)


def test_query_equals_the_plain_patterns_and_keeps_them(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_CHECK}/documents.parquet'").fetchall())
    rows = op11_pii(spark, SF_CHECK).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_spans(texts[r.doc_id] or "")
        line = [f"{KINDS[k]}:{s}:{e}" for s, k, e in want]
        assert r.base_sha256 == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in want) for i in range(4)]
        assert set(line) <= set(r.spans.split(",")) or not line
    clean = [r for r in rows if not re.search(r"[0-9@]", texts[r.doc_id] or "")]
    assert len(clean) > 100 and all(r.spans == "" for r in clean)


def test_nothing_to_learn_from_adds_nothing(spark):
    docs = spark.createDataFrame([(1, "year 1987 and 5557713"), (2, "")], "doc_id long, text string")
    assert [list(r.spans) for r in personal_data(docs).collect()] == [[], []]
    w = fit(np.zeros((0, pii._FEATURES), np.int64), np.zeros(0, np.int64), np.zeros((0, 5), bool), np.zeros((0, 4), np.int64))
    p = infer([Variables("a 1 b", [])], w)[0]
    assert p.shape == (1, 5)


def test_odd_and_no_rows(spark):
    rows = personal_data(odd_docs(spark, clash=True)).collect()
    assert len(rows) == 12 and not any(r.spans for r in rows)
    bad = spark.createDataFrame([(1, b"\xff 10.0.0.1")], "doc_id long, raw binary").selectExpr("doc_id", "CAST(raw AS string) AS text")
    assert [[tuple(s) for s in r.spans] for r in personal_data(bad).collect()] == [[("ip", 2, 10)]]
    assert personal_data(no_docs(spark)).count() == 0
