"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes, a blank and the text, into tokens A and B.
Offsets where tokens of both end cut them into groups; an A and a B token whose
byte ranges overlap are linked, and a pair of ids is scored by the corpus-wide
number of links that hold it.

1. Documents are numbered within blocks of at most ``BLOCK_DOCS``. For each pair
   of ids a block holds a compressed bitmap of its documents (a sorted array of
   numbers, or plain bits where they are fewer bytes), and multiplicity planes:
   plane k is the bitmap of the documents whose number of further links of the
   pair has bit k.
2. Spark merges the bitmaps by pair. Blocks hold different documents, so OR-ing
   their bitmaps side by side adds popcounts: the bitmap's is the pair's document
   count, and the planes' popcounts, weighted by 2^k, are added for its links.
   The best count of each B id follows from the counts by pair.
3. Postings return scores: each pair's bitmaps take its count back to their
   blocks, where a document sums the scores of the pairs whose bitmaps hold it.

Only bitmaps, ids and counts are shuffled; a pair that every document holds is one
small row a block, before and after the merge. A block is closed at
``BLOCK_ENTRIES`` (pair, document) entries, so groups are bounded. Within a task
each distinct word (a part of the text between blanks at which tokens of both
kinds always end) is encoded and aligned once.

Null, empty and undecodable texts, and texts whose joined A or B bytes differ
from a blank and the text, have no tokens: zeros and an empty digest. Repeated
rows and doc_ids are documents of their own; null doc_ids are kept; an empty table
gives no rows; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.session import materialize

PIECE = 1 << 18
#: Bytes of text worked out at once.
CHUNK = 2 << 20
BLOCK_DOCS = 4096
BLOCK_ENTRIES = 1 << 20
_DOC_BITS, _ID_BITS = 12, 20
_DENSE = BLOCK_DOCS // 8
#: Longer runs of one kind of character go to the library whose work on them stays in proportion.
_LONG = re.compile(r"\S{400}|\s{400}")
#: Where tokens of both kinds always end: at a blank between two characters that are no white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters of distinct words that a task keeps aligned.
WORDS_CHARS = 8 << 20


def default_paths() -> tuple[str, str]:
    """The public vocabularies A (byte-level) and B (pieces with byte fallback)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- the two tokenizers ----------------------------------------------------------

class ByteTokens:
    """A: a byte-level vocabulary file of the ``tokenizers`` library."""

    def __init__(self, spec: bytes):
        import tiktoken
        from tokenizers import Tokenizer
        self.plain = Tokenizer.from_str(spec.decode())
        self.plain.encode_special_tokens = True
        self.plain.no_truncation()
        self.plain.no_padding()
        spec = json.loads(spec)
        ids, special = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = sorted({*range(256)} - {*printable})
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        self.bytes = [b""] * (max(max(ids.values(), default=0), *(t["id"] for t in spec["added_tokens"]), 0) + 1)
        for token, i in ids.items():
            if token not in special:
                self.bytes[i] = bytes(byte_of[c] for c in token)
        # Where ids rise in the order of the merges, they are ranks, and the faster library gives the same tokens.
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        ordered = [ids[m] for m in merges]
        self.fast = None
        kind = spec["pre_tokenizer"]
        if ordered == sorted(set(ordered)) and kind == {"type": "ByteLevel", "add_prefix_space": False,
                                                        "trim_offsets": True, "use_regex": True}:
            import public_tokenizers
            self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
                b: i for i, b in enumerate(self.bytes) if b})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or _LONG.search(text):
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokens:
    """B: a ``sentencepiece`` model; it puts a blank before the text itself."""

    def __init__(self, proto: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [b"" if self.model.is_control(i) or self.model.is_unknown(i) else
                      bytes([int(name[1:-1], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
                      for i, name in enumerate(names)]
        #: no token goes on over a blank that follows something else
        self.cut_at_blanks = not any("▁" in name.lstrip("▁") for name in names)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


@lru_cache(maxsize=2)
def _tokenizers(a: bytes, b: bytes) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(a), PieceTokens(b)


def pieces(text: str, size: int = PIECE):
    """``text`` in parts of about ``size`` characters, cut at blanks between two other characters (left out)."""
    start = 0
    while start + size < len(text):
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.end()
    yield text[start:]


# -- words: each distinct one is encoded and aligned once ----------------------------

class Words:
    """Alignment of a blank and a word, for each distinct word added.

    ``sound``: both encodings give the word's bytes back; ``groups``: its groups as text;
    ``totals``: tokens of A, of B, groups, links; ``links``: the pairs of all words in order.
    """

    def __init__(self, a: ByteTokens, b: PieceTokens):
        self.a, self.b = a, b
        self.len_a, self.len_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        self.clear()

    def clear(self) -> None:
        self.at, self.size, self.groups = {}, 0, []
        self._sound, self._totals, self._links = [], [], []

    def add(self, words) -> None:
        """Takes in new words."""
        sound, ids_a, ids_b = [], [], []
        for word in words:
            self.at[word] = len(self.at)
            self.size += len(word)
            piece = " " + word
            data, x, y = piece.encode(), self.a.encode(piece), self.b.encode(word)
            good = (b"".join([self.a.bytes[i] for i in x]) == data) and (b"".join([self.b.bytes[i] for i in y]) == data)
            sound.append(good)
            ids_a.append(x if good else [])
            ids_b.append(y if good else [])
        if sound:
            self._align(ids_a, ids_b)
            self._sound.append(np.array(sound))

    def _align(self, ids_a: list, ids_b: list) -> None:
        n = len(ids_a)
        a, b = (np.array(list(chain.from_iterable(x)), np.int64) for x in (ids_a, ids_b))
        of_a, of_b = (np.repeat(np.arange(n), [len(i) for i in x]) for x in (ids_a, ids_b))
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # An overlap of two tokens holds no other end, so each distinct end closes exactly one link.
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        if not len(ends):
            common, of = np.zeros(0, bool), np.zeros(0, np.int64)
        else:
            common, of = (end_a[at_a] == ends) & (end_b[at_b] == ends), of_a[at_a]
        self._links.append(a[at_a] << _ID_BITS | b[at_b])
        self._totals.append(np.stack([np.bincount(x, minlength=n) for x in (of_a, of_b, of[common], of)], axis=1))
        # Cut points of the groups in the tokens of A and of B; a word's groups are a run of all.
        cut_a, cut_b = at_a[common] + 1, at_b[common] + 1
        name_a, name_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        spelled, lo_a, lo_b = [], 0, 0
        for hi_a, hi_b in zip(cut_a.tolist(), cut_b.tolist()):
            spelled.append(f"{','.join(name_a[lo_a:hi_a])}|{','.join(name_b[lo_b:hi_b])}")
            lo_a, lo_b = hi_a, hi_b
        stops = np.cumsum(np.bincount(of[common], minlength=n)).tolist()
        self.groups += [";".join(spelled[lo:hi]) for lo, hi in zip([0, *stops], stops)]

    def packed(self) -> None:
        """Joins what was added, so that it can be looked up by word."""
        if len(self._sound) > 1:
            self._sound, self._totals, self._links = ([np.concatenate(x)] for x in (self._sound, self._totals, self._links))
        self.sound, self.totals, self.links = (x[0] if x else None for x in (self._sound, self._totals, self._links))


# -- bitmaps -------------------------------------------------------------------

def containers(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(distinct keys, a compressed bitmap of the documents of each); rows sorted by key and document.

    A bitmap of fewer than ``_DENSE / 2`` documents is their numbers in two bytes each, else one bit each.
    """
    first = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    dense = count >= _DENSE // 2
    offsets = np.concatenate([[0], np.cumsum(np.where(dense, _DENSE, 2 * count))])
    out = np.zeros(int(offsets[-1]), np.uint8)
    run = np.repeat(np.arange(len(first)), count)
    sparse = ~dense[run]
    at = offsets[run[sparse]] + 2 * (np.arange(len(key)) - first[run])[sparse]
    out[at], out[at + 1] = doc[sparse] & 255, doc[sparse] >> 8
    bits = ~sparse
    np.bitwise_or.at(out, offsets[run[bits]] + (doc[bits] >> 3), (1 << (doc[bits] & 7)).astype(np.uint8))
    return key[first], pa.Array.from_buffers(pa.binary(), len(first), [
        None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])


def documents_of(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row of the bitmap, document) of every document in the bitmaps."""
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int32, len(bitmaps) + 1, 4 * bitmaps.offset).astype(np.int64)
    data = np.frombuffer(bitmaps.buffers()[2] or b"", np.uint8)
    size = np.diff(offsets)
    dense = size == _DENSE
    count = np.where(dense, 0, size // 2)
    rows = np.repeat(np.arange(len(size)), count)
    at = offsets[rows] + 2 * (np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count))
    docs = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8
    if dense.any():
        which = np.flatnonzero(dense)
        bits = np.unpackbits(data[offsets[which][:, None] + np.arange(_DENSE)], axis=1, bitorder="little")
        i, d = np.nonzero(bits)
        rows, docs = np.concatenate([rows, which[i]]), np.concatenate([docs, d])
    return rows, docs


def popcount(bitmap: str):
    """Number of documents in a compressed bitmap."""
    size = F.octet_length(bitmap)
    return F.when(size == _DENSE, F.bitmap_count(bitmap)).otherwise((size / 2).cast("long"))


class Block:
    """Bitmaps and planes of the pairs of up to ``BLOCK_DOCS`` documents."""

    def __init__(self):
        self.docs, self.of, self.words, self.counts, self.entries = [], [], [], [], 0

    def add(self, doc_id, words: Words, at: np.ndarray, keep_groups: bool) -> None:
        """A document as its words in order (their places in ``words``)."""
        one = {"doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "groups": None}
        if len(at) and words.sound[at].all():
            distinct, counts = np.unique(at, return_counts=True)
            totals = counts @ words.totals[distinct]
            one |= dict(zip(("n_a", "n_b", "n_groups", "n_links"), totals.tolist()))
            sha, spelled = hashlib.sha256(), []
            for lo in range(0, len(at), 1 << 16):
                part = ";".join([words.groups[i] for i in at[lo:lo + (1 << 16)].tolist()])
                sha.update((";" * (lo > 0) + part).encode())
                if keep_groups:
                    spelled.append(part)
            one |= {"groups_sha256": sha.hexdigest(), "groups": ";".join(spelled) if keep_groups else None}
            self.of.append(np.full(len(distinct), len(self.docs)))
            self.words.append(distinct)
            self.counts.append(counts)
            self.entries += int(words.totals[distinct, 3].sum())
        self.docs.append(one)

    def postings(self, words: Words):
        """Yield (plane, pairs, bitmaps); plane -1 is the documents themselves."""
        if not self.of:
            return
        doc, word, count = (np.concatenate(x) for x in (self.of, self.words, self.counts))
        starts = np.cumsum(words.totals[:, 3]) - words.totals[:, 3]
        n = words.totals[word, 3]
        at = np.repeat(starts[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        keys, counts = words.links[at] << _DOC_BITS | np.repeat(doc, n), np.repeat(count, n)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])     # a pair in several words of a document
        keys, further = keys[first], np.add.reduceat(counts, first) - 1
        pair, doc = keys >> _DOC_BITS, keys & (BLOCK_DOCS - 1)
        yield -1, *containers(pair, doc)
        for k in range(int(further.max()).bit_length()):
            on = (further >> k & 1).astype(bool)
            yield k, *containers(pair[on], doc[on])


# -- Spark jobs ------------------------------------------------------------------

_STORED = ("block long, at int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "groups string, pair long, plane int, bitmap binary")
_COLUMNS = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                      ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                      ("groups_sha256", pa.string()), ("groups", pa.string()), ("pair", pa.int64()),
                      ("plane", pa.int32()), ("bitmap", pa.binary())])


def _table(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _COLUMNS], schema=_COLUMNS)


def encoded(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False) -> DataFrame:
    """Stored rows of two kinds: one for each document, and one for each bitmap of a pair in a block."""
    with open(path_a, "rb") as a, open(path_b, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))

    def work(batches):
        from pyspark import TaskContext
        words, block = Words(*_tokenizers(*files.value)), Block()
        number = TaskContext.get().partitionId() << 32

        def close():
            nonlocal block, number
            out, n = block.docs, len(block.docs)
            if n:
                own = {f.name: pa.array([d[f.name] for d in out], f.type) for f in _COLUMNS
                       if f.name not in ("block", "at", "pair", "plane", "bitmap")}
                yield _table(n, block=pa.array([number] * n, pa.int64()), at=pa.array(range(n), pa.int32()), **own)
                for plane, pairs, bitmaps in block.postings(words):
                    m = len(pairs)
                    yield _table(m, block=pa.array(np.full(m, number)), pair=pa.array(pairs),
                                 plane=pa.array(np.full(m, plane, np.int32)), bitmap=bitmaps)
            number, block = number + 1, Block()

        for batch in batches:
            for first, last in _chunks(batch.column(1)):
                ids = batch.column(0)[first:last].to_pylist()
                texts = [_decoded(x) for x in batch.column(1)[first:last].to_pylist()]
                for doc_id, at in zip(ids, _placed(texts, words)):
                    block.add(doc_id, words, at, keep_groups)
                    if len(block.docs) == BLOCK_DOCS or block.entries >= BLOCK_ENTRIES:
                        yield from close()
                # Blocks and the rest of a chunk hold places in ``words``, so these go only between chunks.
                if words.size > WORDS_CHARS:
                    yield from close()
                    words.clear()
        yield from close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(work, _STORED), "alignment")


def _chunks(texts: pa.Array):
    """(first, last) of runs of rows with about ``CHUNK`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(ends):
        last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + CHUNK)) + 1
        yield first, min(last, len(ends))
        first = last


def _decoded(raw: bytes | None) -> str:
    """The text; empty if it is null or no UTF-8, as it then has no tokens."""
    try:
        return (raw or b"").decode()
    except UnicodeDecodeError:
        return ""


def _placed(texts: list[str], words: Words) -> list[np.ndarray]:
    """The places of each text's words; words not met before are added."""
    whole = not words.b.cut_at_blanks
    cut = [[] if not t else [[t]] if whole else [_CUT.split(t)] if len(t) <= PIECE else None for t in texts]
    words.add(dict.fromkeys(w for parts in cut if parts for w in parts[0] if w not in words.at))
    out = []
    for text, parts in zip(texts, cut):
        places = []
        # A very long text is never held as a whole list of words.
        for part in parts if parts is not None else map(_CUT.split, pieces(text)):
            if parts is None:
                words.add(dict.fromkeys(w for w in part if w not in words.at))
            places.append(np.fromiter(map(words.at.__getitem__, part), np.int64, len(part)))
        out.append(np.concatenate(places) if places else np.zeros(0, np.int64))
    words.packed()
    return out


def pair_scores(stored: DataFrame) -> DataFrame:
    """pair, docs, links, best of every pair of ids in the stored bitmaps; ``best``: no pair of its B id has more links."""
    n = popcount("bitmap")
    counts = materialize(
        stored.filter("pair IS NOT NULL").groupBy("pair")
              .agg(F.sum(F.when(F.col("plane") < 0, n)).alias("docs"),
                   F.sum(n * F.expr("shiftleft(1L, greatest(plane, 0))")).alias("links")), "pair-counts")
    most = (counts.groupBy(F.col("pair").bitwiseAND(F.lit((1 << _ID_BITS) - 1)).alias("b"))
                  .agg(F.max("links").alias("most")))
    return (counts.join(most, counts["pair"].bitwiseAND(F.lit((1 << _ID_BITS) - 1)) == most["b"])
                  .select("pair", "docs", "links", (F.col("links") == F.col("most")).alias("best")))


def named_pairs(scores: DataFrame) -> DataFrame:
    """a_id, b_id, docs, links, best."""
    return scores.select(F.shiftright("pair", _ID_BITS).cast("int").alias("a_id"),
                         F.col("pair").bitwiseAND(F.lit((1 << _ID_BITS) - 1)).cast("int").alias("b_id"),
                         "docs", "links", "best")


_ANSWER = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string, groups string")


def _returned(docs: pa.Table, postings: pa.Table) -> pa.Table:
    """The documents of one block with the scores that their pairs' bitmaps return."""
    best, total = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
    for part in postings.combine_chunks().to_batches():
        rows, doc = documents_of(part.column("bitmap"))
        weight = np.left_shift(np.int64(1), np.maximum(part.column("plane").to_numpy(), 0).astype(np.int64))
        np.add.at(total, doc, (weight * part.column("links").to_numpy())[rows])
        np.add.at(best, doc, (weight * part.column("best").to_numpy(zero_copy_only=False))[rows])
    at = docs.column("at").to_numpy()
    return pa.table({**{c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                     "n_best": best[at], "count_sum": total[at],
                     "groups_sha256": docs.column("groups_sha256"), "groups": docs.column("groups")})


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
          keep_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the best of its B id),
    count_sum (pair counts over the links), groups_sha256, and groups (``a1,a2|b1;a3|b2``) if asked for.
    pairs: a_id, b_id, docs, links, best.
    """
    a, b = default_paths()
    stored = encoded(docs, path_a or a, path_b or b, keep_groups)
    scores = materialize(pair_scores(stored), "pair-scores")
    posts = (stored.filter("pair IS NOT NULL")
                   .select(F.col("block").alias("in_block"), F.col("pair").alias("of"), "plane", "bitmap")
                   .join(scores.hint("merge"), F.col("of") == F.col("pair")).select("in_block", "plane", "bitmap", "links", "best"))
    owners = stored.filter("pair IS NULL").drop("pair", "plane", "bitmap")
    out = owners.groupBy("block").cogroup(posts.groupBy("in_block")).applyInArrow(_returned, _ANSWER)
    return (out if keep_groups else out.drop("groups")), named_pairs(scores)
