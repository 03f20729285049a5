"""Hard negatives by anchor-clustered shared lists.

For each anchor and each of its positives (the nearest rows of its label) the
nearest rows of other labels whose score lies between ``LOW`` percent of the
positive's and the positive's own, exactly.

1. Anchors are clustered by direction. A cluster knows the largest angle ``t``
   between its centre and a member.
2. For each cluster the candidates are ordered once by an upper bound on their
   score with a member of length 1: their length times the cosine of how much
   further than ``t`` they lie from the centre. The order is kept as a histogram
   of bounds by cluster, which cuts the list into slices of growing size.
3. Every member walks its cluster's list slice by slice. A slice is dealt to tasks
   in pieces, walked there in order of the bound, and left early once the bound
   rules out all that follows. After each slice a member whose worst place still
   open beats the bound of the next slice is done (its answer is certified), and
   a cluster without open members sends nothing more.

The positives are found first, then the negatives, whose windows depend on them.
Bounds carry a slack for rounding, so the result is exact whatever the clusters;
where directions are random, bounds rule out little and a walk ends with the list.

Components are floor(256 x). Scores are exact: sums that could pass 2^53 are taken
with Python integers (up to 38 digits), and a score beyond a long is given as the nearest long.
Rows with a null label or vector, a null or non-finite component or a null vec_id
take no part; zero and empty vectors do, with score 0. Shorter vectors count as
padded with zeros. Of rows with the same vec_id the smallest (vector, label)
counts. Without anchors, positives or negatives there are no rows; an empty table
gives none. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillprice.session import materialize

ANCHOR_STEP, FLIP_STEP, LABELS = 100, 7, 10
POSITIVES, NEGATIVES, LOW = 5, 5, 80
#: Anchors that share a list, clusters at most (a cluster with more anchors is walked in several groups of
#: ``MEMBERS``), and anchors that the centres are learned from.
MEMBERS, CLUSTERS, SAMPLE = 256, 512, 8192
#: Candidates in the first slice of a list, growth of the slices, candidates in a piece, and in a step of the walk.
FIRST, GROWTH, PIECE, STEP = 8192, 4, 4096, 1024
BINS, SEED = 512, 11
_EXACT = 1 << 53
#: A component whose 256-fold is no double counts as not finite.
_FINITE = 2.0 ** 1015
_DIGITS = 10 ** 38 - 1
_LONG = (1 << 63) - 1


# -- rows ------------------------------------------------------------------------

def quantised(vectors: DataFrame) -> tuple[DataFrame, int, str]:
    """Stored rows (vec_id, label, vec, norm) that take part, their dimension, and the type of a component in ``vec``."""
    x = F.col("embedding")
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
             & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < _FINITE)))
    flipped = F.when(F.col("vec_id") % FLIP_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           "embedding")
                   .filter(F.coalesce(sound, F.lit(False)))
                   .select("vec_id", flipped.alias("label"), x.cast("array<double>").alias("q"))
                   .groupBy("vec_id").agg(F.min(F.struct("q", "label")).alias("r")).select("vec_id", "r.q", "r.label"))
    size = rows.agg(F.max(F.size("q")).alias("dim"), F.max(F.array_max(F.transform("q", F.abs))).alias("most")).first()
    dim, most = size["dim"] or 0, 256 * (size["most"] or 0.0) + 1
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"

    @F.pandas_udf("vec binary, norm double")
    def packed(column: pd.Series) -> pd.DataFrame:
        full = [np.pad(np.floor(256 * np.asarray(v, np.float64)), (0, dim - len(v))) + 0.0 for v in column]
        top = [np.abs(v).max(initial=0.0) or 1.0 for v in full]
        return pd.DataFrame({"vec": pd.Series([v.astype(kind).tobytes() for v in full], dtype=object),
                             "norm": [min(t * float(np.linalg.norm(v / t)), 1e308) for v, t in zip(full, top)]})

    stored = rows.select("vec_id", "label", packed("q").alias("p")).select("vec_id", "label", "p.vec", "p.norm")
    return materialize(stored, "negatives-rows"), dim, kind


def _matrix(column, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), dim).astype(np.float64)


def _directions(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, initial=0.0)
    x = x / np.where(top > 0, top, 1)[:, None]
    size = np.linalg.norm(x, axis=1)
    return x / np.where(size > 0, size, 1)[:, None]


def _scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact integer inner products: float64 where every partial sum fits, else Python integers."""
    if not x.size or not y.size:
        return np.zeros((len(x), len(y)))
    if np.abs(x).max() * np.abs(y).max() * x.shape[1] < _EXACT:
        return x @ y.T
    whole = [np.array([[int(v) for v in row] for row in m], object).reshape(m.shape) for m in (x, y)]
    return whole[0] @ whole[1].T


# -- clusters and bounds ---------------------------------------------------------

def centres(anchors: DataFrame, dim: int, kind: str, members: int, most: int) -> np.ndarray:
    """Directions of the cluster centres: spherical k-means on at most ``SAMPLE`` anchors."""
    n = anchors.count()
    taken = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").toPandas()
    x = _directions(_matrix(taken["vec"], dim, kind))
    k = max(1, min(most, math.ceil(n / members), len(x)))
    c = x[np.sort(np.random.default_rng(SEED).permutation(len(x))[:k])]
    for _ in range(8):
        own = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(np.linalg.norm(sums, axis=1)[:, None] > 0, _directions(sums), c)
    return c


def bounds(cosine: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Upper bounds on the cosine with any member, from that with the centre; a slack for rounding is added."""
    angle = np.arccos(np.clip(cosine, -1, 1)) - spread - 1e-7
    return np.minimum(1.0, np.cos(np.clip(angle, 0, np.pi)) + 1e-9)


def _bin(bound: np.ndarray, longest: float, bins: int) -> np.ndarray:
    """Bins of equal width from the largest possible bound (0) down to the smallest (``bins`` - 1)."""
    share = bound / longest if longest else np.zeros_like(bound)
    return np.clip(((1 - share) / 2 * bins).astype(np.int64), 0, bins - 1)


def _top_of_bin(k: int, longest: float, bins: int) -> float:
    """No bound in bin ``k`` or a later one is larger."""
    return longest * (1 - 2 * k / bins) + longest * 1e-9


def reach(bound, norm):
    """Upper bound on the score of a member of length ``norm``, with a slack for rounding."""
    return bound * norm + np.abs(bound * norm) * 1e-9


class Lists:
    """The shared lists: for each cluster its centre, spread, and the bins that make up each slice."""

    def __init__(self, centre: np.ndarray, spread: np.ndarray, longest: float):
        self.centre, self.spread, self.longest, self.bins = centre, spread, longest, BINS
        self.slices, self.sizes = [], []

    def bounds(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return bounds(_directions(x) @ self.centre.T, self.spread) * norm[:, None]

    def cut(self, counts: np.ndarray) -> None:
        """Slices of bins: each at least ``FIRST`` candidates times a power of ``GROWTH``, if so many are left."""
        for row in counts:
            edges, sizes, held, want = [0], [], 0, FIRST
            for k in np.flatnonzero(row).tolist():
                held += int(row[k])
                if held >= want:
                    edges.append(k + 1)
                    sizes.append(held)
                    held, want = 0, want * GROWTH
            if held:
                edges.append(self.bins)
                sizes.append(held)
            self.slices.append(edges)
            self.sizes.append(sizes)

    def next_bound(self, cluster: int, step: int) -> float:
        """The largest bound after slice ``step``; -inf at the end of the list."""
        done = step + 1 >= len(self.sizes[cluster])
        return -math.inf if done else _top_of_bin(self.slices[cluster][step + 1], self.longest, self.bins)


def shared_lists(rows: DataFrame, members: DataFrame, centre: np.ndarray, dim: int, kind: str) -> Lists:
    """Orders all candidates for every cluster: counts by bin of the bound, added up by Spark."""
    spread = np.zeros(len(centre))
    for r in members.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        spread[r["cluster"]] = r["angle"]
    longest = rows.agg(F.max("norm")).first()[0] or 0.0
    lists = Lists(centre, spread, longest)

    def counted(frames):
        total = np.zeros((len(centre), lists.bins), np.int64)
        for f in frames:
            at = _bin(lists.bounds(_matrix(f["vec"], dim, kind), f["norm"].to_numpy()), longest, lists.bins)
            for c in range(len(centre)):
                total[c] += np.bincount(at[:, c], minlength=lists.bins)
        c, k = np.nonzero(total)
        yield pd.DataFrame({"cluster": c, "bin": k, "n": total[c, k]})

    counts = np.zeros((len(centre), lists.bins), np.int64)
    for r in (rows.select("vec", "norm").mapInPandas(counted, "cluster long, bin long, n long")
                  .groupBy("cluster", "bin").agg(F.sum("n").alias("n")).collect()):
        counts[r["cluster"], r["bin"]] = r["n"]
    lists.cut(counts)
    return lists


def clustered(anchors: DataFrame, centre: np.ndarray, dim: int, kind: str, members: int) -> DataFrame:
    """Stored anchors with their cluster, the group of it that they are walked in, and their angle to its centre."""
    def near(frames):
        for f in frames:
            cosine = _directions(_matrix(f["vec"], dim, kind)) @ centre.T
            own = np.argmax(cosine, axis=1)
            # a member without direction has score 0 with everything and widens no cluster
            angle = np.where(f["norm"] > 0, np.arccos(np.clip(cosine[np.arange(len(own)), own], -1, 1)), 0.0)
            yield f.assign(cluster=own, angle=angle)

    found = materialize(anchors.mapInPandas(near, "vec_id long, label long, vec binary, norm double, cluster long, "
                                                  "angle double"), "negatives-anchors")
    sizes = found.groupBy(F.col("cluster").alias("c")).agg(F.ceil(F.count(F.lit(1)) / members).alias("groups"))
    return materialize(found.join(sizes, found["cluster"] == sizes["c"])
                            .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("groups"))).drop("c", "groups"),
                       "negatives-members")


# -- the walk ----------------------------------------------------------------------

def _first(score, ids, most: int):
    """Places of the first ``most`` by score, ties by smaller id."""
    return np.lexsort((ids, -score))[:most] if score.dtype != object else \
        np.array(sorted(range(len(score)), key=lambda i: (-score[i], ids[i]))[:most], np.int64)


def _windows(low: int, positives: list) -> list:
    """(positive id, its score, least score of a negative), for those whose window holds any score."""
    out = []
    for positive, score in positives:
        least = -(-low * score // 100)
        if least <= score:
            out.append((positive, score, least))
    return out


def walk(members: list, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, bound: np.ndarray,
         stride: int) -> list:
    """The best of one piece of a list for each member, as (anchor, positive or None, id, score).

    ``members``: (anchor id, label, vector, norm, places, floor); ``places`` are None where the nearest of the own
    label are looked for, else (positive, score, least); ``floor``: the score that a place must reach.
    """
    order = np.argsort(-bound, kind="stable")
    ids, labels, bound = ids[order], labels[order], bound[order]
    best = [{} for _ in members]
    floors = [m[5] for m in members]
    norms = np.array([m[3] for m in members])
    y = np.stack([m[2] for m in members])
    for lo in range(0, len(ids), stride):
        # Members for whom nothing from here on can matter have left the walk.
        most = reach(bound[lo], norms)
        on = [i for i in range(len(members)) if most[i] >= floors[i]]
        if not on:
            break
        part = slice(lo, lo + stride)
        scores = _scores(y[on], x[order[part]])
        for row, i in zip(scores, on):
            anchor, label, _, _, places, _ = members[i]
            same = labels[part] == label
            if places is None:
                at = np.flatnonzero(same & (ids[part] != anchor) & (row >= floors[i]))
                windows = [(None, math.inf, -math.inf)]
            else:
                at = np.flatnonzero(~same & (row >= floors[i]) & (row <= max(w[1] for w in places)))
                windows = places
            at = at[_first(row[at], ids[part][at], len(at))]
            got, names, need = row[at], ids[part][at], math.inf
            for k, (_, top, least) in enumerate(windows):
                fit = np.flatnonzero((got <= top) & (got >= least))[:NEGATIVES if places is not None else POSITIVES]
                held = best[i].get(k, []) + [(-int(got[j]), int(names[j])) for j in fit]
                wanted = POSITIVES if places is None else NEGATIVES
                best[i][k] = held = sorted(held)[:wanted]
                need = min(need, max(least, -held[-1][0] if len(held) == wanted else -math.inf))
            floors[i] = max(floors[i], need)
    out = []
    for (anchor, _, _, _, places, _), found in zip(members, best):
        for k, held in found.items():
            positive = None if places is None else places[k][0]
            out += [(anchor, positive, name, -score) for score, name in held]
    return out


def _text(value) -> str:
    """A score as decimal text, as it may pass a long; at most 38 digits."""
    return str(max(-_DIGITS, min(_DIGITS, int(value))))


def _walked(spark: SparkSession, rows: DataFrame, members: DataFrame, lists: Lists, dim: int, kind: str, wanted: int,
            low: int, name: str) -> DataFrame:
    """(anchor, positive, found, score as decimal): each member's certified answer.

    ``members``: vec_id, label, vec, norm, cluster, part, places (array of positive and score; null: none yet).
    """
    found, step, stride = None, 0, STEP
    key = ["anchor", "positive"]
    rank = Window.partitionBy(*key).orderBy(F.col("score").desc(), "found")
    open_ = members.withColumn("floor", F.lit(None).cast("decimal(38,0)"))
    while True:
        live = [(r["cluster"], r["part"]) for r in open_.select("cluster", "part").distinct().collect()
                if step < len(lists.sizes[r["cluster"]])]
        if not live:
            break
        ranges = {c: (lists.slices[c][step], lists.slices[c][step + 1], max(1, math.ceil(lists.sizes[c][step] / PIECE)),
                      [p for o, p in live if o == c]) for c in {c for c, _ in live}}

        def dealt(frames, ranges=ranges):
            """The candidates of the slice, to the groups of members that are still walking."""
            for f in frames:
                bound = lists.bounds(_matrix(f["vec"], dim, kind), f["norm"].to_numpy())
                at = _bin(bound, lists.longest, lists.bins)
                ids = f["vec_id"].to_numpy()
                for c, (lo, hi, pieces, parts) in ranges.items():
                    on = np.flatnonzero((at[:, c] >= lo) & (at[:, c] < hi))
                    if not len(on):
                        continue
                    mixed = (ids[on].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                    sent = pd.DataFrame({"cluster": c, "part": 0, "piece": (mixed % np.uint64(pieces)).astype(np.int64),
                                         "vec_id": ids[on], "label": f["label"].to_numpy()[on],
                                         "vec": f["vec"].to_numpy()[on], "bound": bound[on, c]})
                    for part in parts:
                        yield sent.assign(part=part)

        slices = rows.mapInPandas(dealt, "cluster long, part long, piece long, vec_id long, label long, vec binary, "
                                         "bound double")
        # Each group of members meets each piece of its cluster's slice.
        counts = spark.createDataFrame([(c, n - 1) for c, (_, _, n, _) in ranges.items()], "c long, last long")
        walkers = open_.join(counts, open_["cluster"] == counts["c"]).select(
            "cluster", "part", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("piece"), "vec_id", "label", "vec",
            "norm", F.expr("transform(places, p -> p.positive)").alias("place"),
            F.expr("transform(places, p -> CAST(p.score AS string))").alias("place_score"),
            F.col("floor").cast("string").alias("floor"))

        def met(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            group, out = [], []
            for r, y in zip(left.itertuples(index=False), _matrix(left["vec"], dim, kind) if len(right) else []):
                places = None if r.place is None else _windows(low, [(int(p), int(v)) for p, v in zip(r.place, r.place_score)])
                floor = -math.inf if r.floor is None else int(r.floor)
                if places is None:
                    group.append((int(r.vec_id), r.label, y, r.norm, None, floor))
                elif places:
                    group.append((int(r.vec_id), r.label, y, r.norm, places, max(floor, min(w[2] for w in places))))
            if group:
                ids, labels, bound = (right[c].to_numpy() for c in ("vec_id", "label", "bound"))
                out = walk(group, ids, labels, _matrix(right["vec"], dim, kind), bound, stride)
            return pd.DataFrame({"anchor": pd.Series([o[0] for o in out], dtype="int64"),
                                 "positive": pd.Series([o[1] for o in out], dtype="Int64"),
                                 "found": pd.Series([o[2] for o in out], dtype="int64"),
                                 "score": pd.Series([_text(o[3]) for o in out], dtype=object)})

        best = (walkers.groupBy("cluster", "part", "piece").cogroup(slices.groupBy("cluster", "part", "piece"))
                       .applyInPandas(met, "anchor long, positive long, found long, score string")
                       .withColumn("score", F.col("score").cast("decimal(38,0)")))
        both = best if found is None else found.unionByName(best)
        found = materialize(both.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= wanted).drop("r"),
                            f"{name}-{step}")
        # Certified: the last place of every list beats all that follows in the member's list.
        last = found.groupBy(*key).agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
        last = last.select("anchor", "positive", F.when(F.col("n") >= wanted, F.col("score")).alias("last"))
        if name == "positives":
            floors = last.select(F.col("anchor").alias("a"), F.col("last").alias("new"))
            known = open_.drop("floor").join(floors, F.col("vec_id") == F.col("a"), "left")
        else:
            asked = open_.drop("floor").select("*", F.explode("places").alias("p"))
            least = F.ceil(F.col("p.score") * low / 100).cast("decimal(38,0)")
            possible = F.col("p.score") >= 0          # below zero a window is empty
            met_ = asked.join(last, (F.col("vec_id") == F.col("anchor")) & (F.col("p.positive") == F.col("positive")), "left")
            floors = (met_.filter(possible).groupBy(F.col("vec_id").alias("a"))
                          .agg(F.min(F.greatest(least, F.col("last"))).alias("new")))
            known = open_.drop("floor").join(floors, F.col("vec_id") == F.col("a"), "inner")
        nexts = spark.createDataFrame([(int(c), float(lists.next_bound(c, step))) for c in range(len(lists.sizes))],
                                      "nc long, reach double")
        most = F.col("reach") * F.col("norm") + F.abs(F.col("reach") * F.col("norm")) * 1e-9
        still = (known.join(nexts, F.col("cluster") == F.col("nc"))
                      .filter((F.col("reach") > F.lit(float("-inf")))
                              & (F.col("new").isNull() | (most >= F.col("new").cast("double")))))
        open_ = materialize(still.withColumn("floor", F.col("new")).drop("a", "new", "nc", "reach"), f"{name}-open-{step}")
        step += 1
    return found


def mine(vectors: DataFrame, step: int = ANCHOR_STEP, low: int = LOW, members: int = MEMBERS,
         clusters: int = CLUSTERS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                     "positive_score long, negative_score long")
    rows, dim, kind = quantised(vectors)
    anchors = rows.filter(F.col("vec_id") % step == 0)
    if not anchors.take(1):
        return none
    centre = centres(anchors, dim, kind, members, clusters)
    owned = clustered(anchors, centre, dim, kind, members)
    lists = shared_lists(rows, owned, centre, dim, kind)
    bare = owned.drop("angle").withColumn(
        "places", F.lit(None).cast("array<struct<positive:bigint,score:decimal(38,0)>>"))
    positives = _walked(spark, rows, bare, lists, dim, kind, POSITIVES, low, "positives")
    listed = positives.groupBy("anchor").agg(F.collect_list(F.struct(F.col("found").alias("positive"), "score")).alias("places"))
    asking = materialize(owned.drop("angle").join(listed, F.col("vec_id") == F.col("anchor")).drop("anchor"), "negatives-asked")
    if not asking.take(1):
        return none
    found = _walked(spark, rows, asking, lists, dim, kind, NEGATIVES, low, "negatives")
    order = Window.partitionBy("anchor", "positive").orderBy(F.col("score").desc(), "found")
    own = positives.select(F.col("anchor").alias("pa"), F.col("found").alias("pf"), F.col("score").alias("ps"))

    def as_long(c):
        return F.least(F.greatest(F.col(c), F.lit(-_LONG - 1).cast("decimal(38,0)")),
                       F.lit(_LONG).cast("decimal(38,0)")).cast("long")

    return (found.withColumn("rank", F.row_number().over(order).cast("int"))
                 .join(own, (F.col("anchor") == F.col("pa")) & (F.col("positive") == F.col("pf")))
                 .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                         F.col("found").alias("negative_id"), as_long("ps").alias("positive_score"),
                         as_long("score").alias("negative_score")))
