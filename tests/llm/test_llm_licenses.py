"""License scans: cosine against a plain version, inheritance along paths."""

import math
import re
from collections import Counter

import pytest
from conftest import SF_SMALL
from llm_data import no_docs

from quillprice.llm.licenses import TEMPLATES, scan, template_weights
from quillprice.llm.queries import op7_licenses

MIT = next(t for n, t in TEMPLATES if n == "MIT" and "Permission" in t)
APACHE = next(t for n, t in TEMPLATES if n == "Apache-2.0" and "compliance" in t)


def cosine(text):
    """Best (score, licence) of one passage."""
    rows, idf, other = template_weights()
    c = Counter(re.findall("[a-z0-9]+", text.lower()))
    v = {w: n * idf.get(w, other) for w, n in c.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    dots = Counter()
    for i, name, w, weight in rows:
        dots[i, name] += v.get(w, 0) * weight
    return max((round(d / norm, 6), name) for (_, name), d in dots.items())


def wrap(text, mark="# "):
    words = text.split()
    return "\n".join(mark + " ".join(words[i:i + 12]) for i in range(0, len(words), 12))


FILES = [
    ("LICENSE", MIT), ("a/x.py", "code\n" + wrap(APACHE) + "\nmore code here"), ("a/y.py", "nothing here"),
    ("a/b/COPYING", "Copyright 2020 A. Nobody. All rights reserved.\nplus many words of other text " * 5),
    ("a/b/c/d.py", "code"), ("z.txt", None), (None, "in the root"), ("e/f.py", ""),
    ("e/g.py", "The word copyright stands in this quite ordinary prose about something else."),
    ("a/b/c/e.py", "Released under the MIT License."), ("a/b/c/q.py", "code"), ("a/b/c/q.py", "code"),
    ("p/n.py", "Released under the mit license.\nunrelated words between the two\nLicensed under CC BY-NC 4.0."),
]


def test_files_inherit_from_the_nearest_licensed_directory(spark):
    df = spark.createDataFrame([(p, t, "own", "mine") for p, t in FILES],
                               "path string, text string, license string, dir string").repartition(3)
    out = scan(df)
    assert out.columns == ["path", "dir", "license", "score", "origin", "licensed_from"]
    got = {r.path: (r.license, r.origin, r.licensed_from) for r in out.collect()}
    assert out.count() == len(FILES)
    assert got["LICENSE"] == ("MIT", "own", None) and got["a/x.py"] == ("Apache-2.0", "own", None)
    assert got["a/y.py"] == ("MIT", "inherited", "") and got["z.txt"] == got["e/f.py"] == ("MIT", "inherited", "")
    assert got[None] == ("MIT", "inherited", "") and got["e/g.py"] == ("MIT", "inherited", "")
    assert got["a/b/COPYING"][:2] == ("Proprietary", "own")
    # e.py is a licence file by its share of words, and nearer than COPYING
    assert got["a/b/c/d.py"] == got["a/b/c/q.py"] == ("MIT", "inherited", "a/b/c")
    assert got["p/n.py"][0] == "CC-BY-NC-4.0"                 # equal scores: the smaller name


@pytest.mark.parametrize("text", [
    wrap(APACHE), MIT, "Released under the MIT License.", "Licensed under the Apache License, Version 2.0 by us",
    "This work is licensed under the GNU General Public License, version 2 or 3"])
def test_score_equals_plain_cosine(spark, text):
    row = scan(spark.createDataFrame([("f", text)], "path string, text string")).first()
    score, name = cosine(text)
    assert (row.license, row.score) == (name, pytest.approx(score, abs=2e-6))


def test_no_licence_anywhere(spark):
    files = spark.createDataFrame([("a/b", "text"), ("c", None)], "path string, text string")
    assert {(r.license, r.score, r.origin) for r in scan(files).collect()} == {(None, None, "none")}
    assert scan(no_docs(spark).selectExpr("source AS path", "text")).count() == 0


def test_query_finds_the_notices(spark):
    import duckdb
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall())
    wanted = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
              "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
              "under the GNU General Public License, version 3.": "GPL-3.0"}
    rows = op7_licenses(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        names = {v for k, v in wanted.items() if k in texts[r.doc_id]}
        assert not names or (r.license in names and r.origin == "own")
