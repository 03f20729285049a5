"""Quality classifier and language identification."""

import zlib

import numpy as np
import pytest
from llm_data import no_docs, odd_docs

from quillprice.llm import language, quality
from quillprice.llm.queries import op5_quality, op6_language

SF = "/root/testdata/sf0.01"


def pairs_right(good, bad):
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_quality_of_the_held_out_fold(spark):
    import duckdb
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    rows = op5_quality(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert pairs_right([s for s, y in held if y], [s for s, y in held if not y]) > 0.97
    assert rows == op5_quality(spark, SF).collect() or sorted(rows) == sorted(op5_quality(spark, SF).collect())


def test_labels_of_the_held_out_fold_are_not_seen(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs.withColumn("lang", F.lit("zz")), other)
    assert a.intercept == b.intercept and all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_model_learns_a_pair_that_no_single_feature_shows():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in [(i, j) for i, j, *_ in model.pairs]
    assert np.mean((model.score(x) > 0.5) == y) > 0.95
    # scoring is a sum of table entries
    one = model.intercept + sum(t[np.searchsorted(e, v, "right")] for e, t, v in zip(model.edges, model.tables, x[0]))
    one += sum(t[np.searchsorted(a, x[0, i], "right"), np.searchsorted(b, x[0, j], "right")]
               for i, j, a, b, t in model.pairs)
    assert model.score(x[:1])[0] == pytest.approx(1 / (1 + np.exp(-one)))


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (8, 1, 0), (9, 1, 0), (9, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = odd_docs(spark, clash=True)
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in rows if r.predicted)
    assert quality.classify(no_docs(spark), labels).count() == 0
    unknown = quality.classify(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in unknown} == {(0.5, 1)}


def test_language_of_the_held_out_fold(spark):
    import duckdb
    known = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = op6_language(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == known[r.doc_id] for r in rows if r.held_out]) > 0.98


def test_lang_and_held_out_rows_are_no_inputs(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    a = language.train(docs)
    b = language.train(docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
                           .withColumn("source", F.lit("x")))
    assert a.languages == b.languages and (a.weights == b.weights).all()


@pytest.mark.parametrize("k", [2, 3, 4, 5, 9, 30])
def test_codewords_are_apart(k):
    code = language.codebook(k)
    apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
    assert code.shape[0] == k and min(apart) >= (1 if k == 2 else 2)
    assert all(0 < (column == 1).sum() < k for column in code.T)


def test_language_of_odd_rows(spark):
    docs = odd_docs(spark, clash=True)
    model = language.train(docs)
    out = language.identify(docs, model)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score", "ambiguous"]
    rows = out.collect()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {3, 4, 5}
    assert all(r.score == 0 and r.ambiguous for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows if r.doc_id in (6, 7)} == {"en"}
    assert language.identify_all(no_docs(spark)).count() == 0
    none = language.identify(docs, language.train(docs.filter("lang IS NULL"))).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_a_mixture_is_flagged(spark):
    rows = [(i, "the cat and the dog with that", "en") for i in range(40)]
    rows += [(100 + i, "der hund und die katze nicht", "de") for i in range(40)]
    docs = spark.createDataFrame(rows + [(999, "the und", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs, language.train(docs)).collect()}
    assert got[0].lang_pred == "en" and got[100].lang_pred == "de" and got[999].score < got[0].score
