"""SimHash near-dedup: a binary trie self-join over the fingerprints.

Fingerprints. A-Z are lower-cased, words are runs without ASCII white space,
and every shingle of ``shingle`` words (a shorter text is one shingle; no word:
fingerprint zero) is hashed by XXH64 with seed 42. A bit is 1 if it is set in
over half of the hashes.

Join. The distinct fingerprints form a binary trie. Pairs of its nodes are
traversed together from the root; the error of a pair grows by one where the
two nodes take different bits, and a pair beyond ``max_bits`` is pruned with
all that is below it. The traversal has two halves:

* The top of the trie is cut into blocks, the largest subtrees of at most
  ``block`` fingerprints (counted and chosen by Spark, eight levels a round). Pairs of
  blocks within the error are found by traversing the block table.
* Each surviving pair of blocks is one group of a Spark shuffle, in which the
  traversal goes on down to the leaves. A group holds two blocks at most.
  It returns a spanning forest of the links it found, not the links.

Groups of linked fingerprints are the connected components over all forests.

Null text counts as empty; empty texts have fingerprint zero and are linked
like any other. A row without doc_id has a fingerprint but no component. Rows
with the same doc_id are one document for each fingerprint. An empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillprice.llm.common import text_or_empty
from quillprice.llm.components import components
from quillprice.session import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 8192
ROUND_BITS = 8
#: Node pairs taken at once, and leaf pairs below which two nodes are compared outright.
FRONTIER = 1 << 18
LEAVES = 8
_MASK = (1 << 64) - 1


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(SEED))
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        part = np.fromiter(hashes, ">u8", min(1 << 16, n - start))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), content (hash of the text)."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), simhash(text_or_empty()).alias("fp"),
                       F.xxhash64(text_or_empty()).alias("content"))


# -- the trie traversal --------------------------------------------------------

class Trie:
    """A binary trie as its sorted leaves: a node is a range of them.

    ``depths``: a leaf stands for the first so many bits of its key (64 if absent).
    """

    def __init__(self, keys: np.ndarray, depths: np.ndarray | None = None):
        self.keys, self.depths, self._at = keys, depths, (-1, None)

    def split(self, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
        """Where the leaves with bit 1 at ``level`` begin, for each node."""
        if self._at[0] != level:
            ones = (self.keys >> np.uint64(63 - level)) & np.uint64(1)
            self._at = level, np.concatenate([[0], np.cumsum(ones, dtype=np.int64)])
        sums = self._at[1]
        return hi - (sums[hi] - sums[lo])

    def ended(self, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
        """Nodes that are a leaf whose bits end before ``level``."""
        return np.zeros(len(lo), bool) if self.depths is None else (hi - lo == 1) & (self.depths[lo] <= level)


def linked_leaves(a: Trie, b: Trie, max_bits: int, levels: int = 64):
    """Yield (indices in a, indices in b) of leaves within ``max_bits`` over their common bits.

    For ``a is b`` each unordered pair comes once, a leaf with itself included.
    Node pairs are held on a stack in pieces of ``FRONTIER``, so memory does not
    grow with the number of pairs.
    """
    same = a is b
    start = [np.array([x], np.int64) for x in (0, len(a.keys), 0, len(b.keys), 0)]
    stack = [(0, start)] if len(a.keys) and len(b.keys) else []
    while stack:
        level, (alo, ahi, blo, bhi, err) = stack.pop()
        if len(alo) > FRONTIER:
            stack += [(level, [x[i:i + FRONTIER] for x in (alo, ahi, blo, bhi, err)])
                      for i in range(0, len(alo), FRONTIER)]
            continue
        small = (ahi - alo) * (bhi - blo) <= LEAVES
        if small.any():
            yield from _compare(a, b, alo[small], ahi[small], blo[small], bhi[small], max_bits, same, levels)
            alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if level == levels:
            # same bits to the end: every leaf of one node is linked to every leaf of the other
            for i in range(len(alo)):
                yield from _compare(a, b, alo[i:i + 1], ahi[i:i + 1], blo[i:i + 1], bhi[i:i + 1],
                                    max_bits, same, levels)
            continue
        if not len(alo):
            continue
        amid, bmid = a.split(alo, ahi, level), b.split(blo, bhi, level)
        a_end, b_end = a.ended(alo, ahi, level), b.ended(blo, bhi, level)
        twin = same & (alo == blo) & (ahi == bhi)
        found = []
        for abit in (0, 1):
            for bbit in (0, 1):
                lo1, hi1 = (amid, ahi) if abit else (alo, amid)
                lo2, hi2 = (bmid, bhi) if bbit else (blo, bmid)
                free = a_end | b_end
                e = err + (abit != bbit) * ~free
                keep = (lo1 < hi1) & (lo2 < hi2) & (e <= max_bits)
                if abit > bbit:
                    keep &= ~twin
                found.append([x[keep] for x in (lo1, hi1, lo2, hi2, e)])
        stack.append((level + 1, [np.concatenate(x) for x in zip(*found)]))


def _compare(a, b, alo, ahi, blo, bhi, max_bits, same, levels):
    """All leaf pairs of the given node pairs, compared in full, in pieces."""
    counts = (ahi - alo) * (bhi - blo)
    ends = np.cumsum(counts)
    for first in range(0, int(ends[-1]) if len(ends) else 0, FRONTIER):
        at = np.arange(first, min(first + FRONTIER, int(ends[-1])))
        node = np.searchsorted(ends, at, "right")
        within = at - (ends[node] - counts[node])
        width = (bhi - blo)[node]
        i, j = alo[node] + within // width, blo[node] + within % width
        bits = np.full(len(i), levels, np.int64)
        for trie, k in ((a, i), (b, j)):
            if trie.depths is not None:
                bits = np.minimum(bits, trie.depths[k])
        differ = a.keys[i] ^ b.keys[j]
        differ = np.where(bits == 0, np.uint64(0), differ >> (64 - np.maximum(bits, 1)).astype(np.uint64))
        keep = np.bitwise_count(differ) <= max_bits
        if same:
            keep &= i <= j
        if keep.any():
            yield i[keep], j[keep]


def spanning_forest(n: int, links) -> np.ndarray:
    """The smallest index that each of ``n`` leaves reaches over the links (pairs of index arrays)."""
    root = np.arange(n)
    for i, j in links:
        while True:
            while (up := root[root]).tobytes() != root.tobytes():
                root = up
            u, v = root[i], root[j]
            open_ = u != v
            if not open_.any():
                break
            i, j, u, v = i[open_], j[open_], u[open_], v[open_]
            np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
    return root


# -- Spark jobs ----------------------------------------------------------------

def trie_blocks(nodes: DataFrame, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(first key, depth) of the largest subtrees of at most ``block`` fingerprints.

    Spark counts the fingerprints below each node, ``ROUND_BITS`` levels a round
    and only below nodes that are still too large, and picks the blocks among
    the nodes of those levels; the driver gets one row for each block.
    """
    ready, heavy, depth = [], None, 0
    while depth < 64:
        cells = nodes
        if heavy is not None:
            cells = nodes.join(heavy, F.shiftrightunsigned("fp", 64 - depth) == F.col("heavy"), "left_semi")
        depth += ROUND_BITS
        counts = materialize(cells.groupBy(F.shiftrightunsigned("fp", 64 - depth).alias("cell"))
                                  .agg(F.count(F.lit(1)).alias("n")), "trie-counts")
        # All nodes of this round with their counts, then by parent: under a node that is too large, a child that
        # is small enough is a block.
        level = F.explode(F.sequence(F.lit(depth - ROUND_BITS + 1), F.lit(depth))).alias("level")
        small = (counts.select("cell", "n", level)
                       .groupBy("level", F.expr(f"shiftrightunsigned(cell, {depth} - level)").alias("node"))
                       .agg(F.sum("n").alias("n"))
                       .groupBy("level", F.shiftrightunsigned("node", 1))
                       .agg(F.sum("n").alias("all"), F.collect_list(F.struct("node", "n")).alias("children"))
                       .filter(F.col("all") > block).select("level", F.explode("children").alias("c"))
                       .filter((F.col("c.n") <= block) | (F.col("level") == 64)).select("level", "c.node"))
        if depth == ROUND_BITS and (counts.agg(F.sum("n")).first()[0] or 0) <= block:
            return np.zeros(min(1, counts.count()), np.uint64), np.zeros(min(1, counts.count()), np.int64)
        ready += [(int(r["node"]) << (64 - r["level"]) & _MASK, r["level"]) for r in small.collect()]
        heavy = counts.filter(F.col("n") > block).select(F.col("cell").alias("heavy"))
        if not heavy.take(1):
            break
    ready.sort()
    return np.array([k for k, _ in ready], np.uint64), np.array([d for _, d in ready], np.int64)


def _pairs_of_blocks(spark: SparkSession, keys: np.ndarray, depths: np.ndarray, max_bits: int) -> DataFrame:
    """(block, pair): the pairs of blocks within the error; both blocks of a pair have a row."""
    shared = spark.sparkContext.broadcast((keys, depths))
    step = max(1, -(-len(keys) // 64))

    def pairs(frames):
        k, d = shared.value
        whole = Trie(k, d)
        for frame in frames:
            for first in frame["id"]:
                mine = Trie(k[first:first + step], d[first:first + step])
                for i, j in linked_leaves(mine, whole, max_bits, int(d.max(initial=0))):
                    i = i + first
                    i, j = i[i <= j], j[i <= j]
                    pair = i * len(k) + j
                    yield pd.DataFrame({"block": np.concatenate([i, j[i < j]]),
                                        "pair": np.concatenate([pair, pair[i < j]])})

    return spark.range(0, len(keys), step).mapInPandas(pairs, "block long, pair long")


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): a spanning forest over the ids of linked nodes (``fp`` distinct, ``id``)."""
    spark = nodes.sparkSession
    keys, depths = trie_blocks(nodes, block)
    shared = spark.sparkContext.broadcast(keys)

    def packed(frames):
        """Runs of fingerprints of one block, sorted within each."""
        for frame in frames:
            if not len(frame):
                continue
            fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
            at = np.searchsorted(shared.value, fp, "right") - 1
            order = np.argsort(at, kind="stable")
            cuts = np.flatnonzero(np.diff(at[order])) + 1
            runs = np.split(order, cuts)
            yield pd.DataFrame({"block": [int(at[r[0]]) for r in runs],
                                "fps": [fp[r].tobytes() for r in runs],
                                "ids": [frame["id"].to_numpy(np.int64)[r].tobytes() for r in runs]})

    # Sorted as unsigned numbers, so that a partition holds few blocks.
    unsigned = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))
    chunks = nodes.repartitionByRange(unsigned).mapInPandas(packed, "block long, fps binary, ids binary")
    n = max(1, len(keys))

    def join(key, frame):
        a, b = divmod(int(key[0]), n)
        sides = []
        for side in dict.fromkeys((a, b)):
            rows = frame[frame["block"] == side]
            fps = np.frombuffer(b"".join(rows["fps"]), np.uint64)
            order = np.argsort(fps, kind="stable")
            sides.append((fps[order], np.frombuffer(b"".join(rows["ids"]), np.int64)[order]))
        (fa, ia), (fb, ib) = sides[0], sides[-1]
        left = Trie(fa)
        if a == b:
            ids, found = ia, linked_leaves(left, left, max_bits)
        else:
            ids = np.concatenate([ia, ib])
            found = ((i, j + len(ia)) for i, j in linked_leaves(left, Trie(fb), max_bits))
        root = spanning_forest(len(ids), found)
        member = np.flatnonzero(root != np.arange(len(ids)))
        return pd.DataFrame({"a": ids[member], "b": ids[root[member]]})

    pairs = _pairs_of_blocks(spark, keys, depths, max_bits)
    return (chunks.join(pairs, "block").groupBy("pair")
                  .applyInPandas(join, "a long, b long"))


def _grouped(docs: DataFrame, shingle: int, max_bits: int, block: int) -> DataFrame:
    """doc_id, fp, content, component of every row."""
    own = materialize(fingerprints(docs, shingle), "simhash")
    nodes = materialize(own.filter("doc_id IS NOT NULL").groupBy("fp")
                           .agg(F.min("doc_id").alias("id")), "simhash-nodes")
    # Parts of one component that meet only through documents of one fingerprint are one node already.
    forest = components(links(nodes, max_bits, block))
    named = materialize(
        nodes.join(forest, nodes["id"] == forest["node"], "left")
             .select(F.col("fp").alias("__fp"), F.coalesce("component", "id").alias("component")), "simhash-named")
    return (own.join(named, own["fp"] == named["__fp"], "left")
               .select("doc_id", "fp", "content", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    return (_grouped(docs, shingle, max_bits, block)
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("component").alias("component_id")))


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` with the document of the smallest doc_id of each component.

    Rows without doc_id stay. Rows that share a doc_id but not a text are judged
    each by its own text.
    """
    dropped = materialize(_grouped(docs.select("doc_id", "text"), shingle, max_bits, block)
                          .filter("doc_id <> component")
                          .select(F.col("doc_id").alias("__dropped"), F.col("content").alias("__content"))
                          .dropDuplicates(), "simhash-dropped")
    return docs.join(dropped, (docs["doc_id"] == dropped["__dropped"])
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == dropped["__content"]), "left_anti")
