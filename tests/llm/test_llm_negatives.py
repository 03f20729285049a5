"""Hard negatives against a plain search of all rows."""

import math

import numpy as np
import pytest
from conftest import SF_CHECK, SF_SMALL

from quillprice.llm import negatives
from quillprice.llm.negatives import mine
from quillprice.llm.queries import OP13_SQL, op13_negatives
from quillprice.oracle.compare import compare, duckdb_connection

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, part string, anchor string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, *["own"] * 4) for i, v, y in rows], SCHEMA).repartition(4)


def brute(rows, step=100):
    good = {}
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = ([math.floor(256 * x) for x in v], (y + 1) % 10 if i % 7 == 0 else y)
        good[i] = min(good.get(i, one), one)
    dim = max((len(v) for v, _ in good.values()), default=0)
    good = {i: (v + [0] * (dim - len(v)), y) for i, (v, y) in good.items()}
    out = []
    for a in sorted(i for i in good if i % step == 0):
        scores = sorted((-sum(x * z for x, z in zip(good[a][0], v)), i, y) for i, (v, y) in good.items() if i != a)
        for s, p, _ in [x for x in scores if x[2] == good[a][1]][:5]:
            fit = [(n, i) for n, i, y in scores if y != good[a][1] and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(fit)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_query_equals_sql(spark, sf):
    ok, _, _, detail = compare(op13_negatives(spark, sf), duckdb_connection(sf), OP13_SQL)
    assert ok, detail


def clustered_rows(seed, n=1500, dim=8, spread=0.15):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((12, dim))
    x = middles[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, dim))
    x *= rng.lognormal(0, 0.7, (n, 1))
    x[rng.integers(0, n, 40)] = x[3]                     # copies
    return [(i, [float(v) for v in x[i]], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("first, piece, step, members, bins", [(8192, 4096, 1024, 256, 512), (40, 16, 8, 2, 32), (200, 64, 16, 4, 512)])
def test_equals_a_plain_search_with_slices_of_any_size(spark, monkeypatch, first, piece, step, members, bins):
    for name, value in (("FIRST", first), ("PIECE", piece), ("STEP", step), ("BINS", bins)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered_rows(5)
    want = brute(rows)
    assert len(want) > 100 and rows_of(mine(frame(spark, rows), members=members)) == want


def test_bounds_end_walks_early(spark, monkeypatch):
    """Where vectors lie in clusters a member is certified long before the end of its list."""
    monkeypatch.setattr(negatives, "FIRST", 100)
    rows, asked = clustered_rows(6, 3000), []
    slices = negatives.Lists.next_bound
    monkeypatch.setattr(negatives.Lists, "next_bound", lambda self, c, k: asked.append((c, k, len(self.sizes[c]))) or
                        slices(self, c, k))
    assert rows_of(mine(frame(spark, rows), members=3)) == brute(rows)
    assert max(k for _, k, _ in asked) <= max(n for *_, n in asked) - 1 and max(n for *_, n in asked) > 2


def test_a_member_leaves_once_the_bound_is_below_its_floor(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 3))
    bound, taken = np.linalg.norm(x, axis=1), []
    monkeypatch.setattr(negatives, "_scores", lambda y, part: taken.append(len(part)) or y @ part.T)
    member = (1000, 0, np.array([5.0, 0, 0]), 5.0, None, 5.0 * np.sort(bound)[-60])
    negatives.walk([member], np.arange(400), np.zeros(400), x, bound, 20)
    assert 0 < len(taken) <= 3


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for dim in (2, 5, 40):
        members, x = rng.standard_normal((30, dim)), rng.standard_normal((200, dim)) * rng.lognormal(0, 2, (200, 1))
        centre = negatives._directions(members.mean(axis=0)[None])
        angle = np.arccos(np.clip(negatives._directions(members) @ centre.T, -1, 1)).max()
        lists = negatives.Lists(centre, np.array([angle]), float(np.linalg.norm(x, axis=1).max()))
        norms = np.linalg.norm(x, axis=1)
        bound = lists.bounds(x, norms)[:, 0]
        for m in members:
            assert (negatives.reach(bound, np.linalg.norm(m)) >= x @ m).all()
        bins = negatives._bin(bound, lists.longest, 512)
        assert all(b <= negatives._top_of_bin(k, lists.longest, 512) for b, k in zip(bound, bins))


def test_odd_vectors_ties_and_copies(spark):
    v, w = [0.5, 0.25, 0.0], [0.5, 0.25, -0.001]
    rows = [(0, v, 1), (100, v, 1), (200, w, 2), (300, [0.0, 0.0, 0.0], 1), (400, [], 3), (500, [-1.0, -0.5, 0.0], 1)]
    rows += [(i, v, i % 3) for i in range(1, 40)] + [(i, w, 2) for i in range(40, 50)]
    rows += [(601, None, 1), (602, v, None), (603, [1.0, None], 1), (604, [float("nan")], 1), (605, [float("inf")], 1),
             (None, v, 1), (700, None, 1), (800, v, None), (51, [0.4], 2), (52, v, 1), (52, w, 2), (52, w, 1),
             (53, [-1e-20, 0.0, 0.0], 1), (54, [3.0, 1.0, 0.0], 2)]
    assert rows_of(mine(frame(spark, rows))) == brute(rows)


def test_very_large_components_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(-9, 9, 3) * 2.0 ** 27 + rng.integers(0, 3, 3)], int(i % 2)) for i in range(0, 400, 5)]
    got, want = rows_of(mine(frame(spark, rows))), brute(rows)
    cut = [(*w[:4], *(max(-2 ** 63, min(2 ** 63 - 1, x)) for x in w[4:])) for w in want]
    assert len(want) > 20 and got == cut


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1), (2, [1.0], 2)], [(100, [1.0], 1)], [(100, [1.0], 1), (1, [1.0], 2)],
                                  [(100, [1.0], 1), (1, [1.0], 1)], [(100, None, 1)]])
def test_few_or_no_rows(spark, rows):
    assert rows_of(mine(frame(spark, rows))) == brute(rows)
