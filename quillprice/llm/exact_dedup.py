"""Exact deduplication by Grace hashing.

1. Every Arrow batch of rows is collapsed on the executor that read it: rows of
   one content become one representative, so a hot group of copies sends one
   text per batch through the shuffle and not one per row.
2. Representatives are dealt by content hash (the Spark shuffle is the first
   level of partitioning).
3. Each partition goes through ``GraceTable``: an open-addressing table that
   compares complete contents. When it holds more than ``table_bytes`` of
   distinct content, the rows are split by the next hash bits into spill files
   in the shared folder, and each file is taken in the same way, recursively.

Null text counts as empty. Of equal texts the row with the largest doc_id
stays (null is smallest); of repeated rows with that doc_id exactly one stays.
An empty table gives no rows. A text is compared and kept as its bytes, also
where these are no UTF-8. Other columns, whatever their names, are carried
by ``exact_dedup`` as they are and not looked at by ``exact_groups``.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.llm.common import shared_uri, text_or_empty
from quillprice.session import materialize

TABLE_BYTES = 64 << 20
SPILL_BITS = 4
_MASK = (1 << 64) - 1


class GraceTable:
    """Groups (hash, content, entry) records by complete content within bounded memory.

    ``merge(a, b)`` folds two entries of one content; ``size(entry)`` is its bytes.
    """

    def __init__(self, merge, spill_dir: str, table_bytes: int = TABLE_BYTES, level: int = 0):
        self.merge, self.spill_dir, self.table_bytes, self.level = merge, spill_dir, table_bytes, level
        self.slots = np.full(1024, -1, np.int64)
        self.hashes, self.contents, self.entries, self.held = [], [], [], 0
        self.spills = None

    def _find(self, h: int, content: bytes) -> tuple[int, int]:
        """(slot, row) of the content; row is -1 where the slot is free."""
        mask = len(self.slots) - 1
        at = (h ^ (h >> 32)) & mask
        while (row := int(self.slots[at])) >= 0:
            if self.hashes[row] == h and self.contents[row] == content:
                return at, row
            at = (at + 1) & mask
        return at, -1

    def _grow(self):
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        for row, h in enumerate(self.hashes):
            mask = len(self.slots) - 1
            at = (h ^ (h >> 32)) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = row

    def add(self, h: int, content: bytes, entry) -> None:
        h &= _MASK
        at, row = self._find(h, content)
        if row >= 0:
            self.entries[row] = self.merge(self.entries[row], entry)
        elif self.spills is not None:
            self._spill(h, content, entry)
        else:
            self.slots[at] = len(self.hashes)
            self.hashes.append(h)
            self.contents.append(content)
            self.entries.append(entry)
            self.held += len(content) + 200
            if 2 * len(self.hashes) > len(self.slots):
                self._grow()
            if self.held > self.table_bytes and (self.level + 1) * SPILL_BITS <= 64 and len(self.hashes) > 1:
                self.spills = {}

    def _spill(self, h: int, content: bytes, entry) -> None:
        part = (h >> (64 - (self.level + 1) * SPILL_BITS)) & ((1 << SPILL_BITS) - 1)
        if part not in self.spills:
            where, path = pafs.FileSystem.from_uri(f"{self.spill_dir}/{uuid.uuid4().hex}")
            where.create_dir(path.rpartition("/")[0], recursive=True)
            self.spills[part] = (where, path, where.open_output_stream(path))
        pickle.dump((h, content, entry), self.spills[part][2], protocol=5)

    def groups(self):
        """(content, entry) of each distinct content, resident ones first, then each spill file."""
        yield from zip(self.contents, self.entries)
        self.hashes, self.contents, self.entries, self.slots = [], [], [], self.slots[:0]
        spills, self.spills = self.spills or {}, None
        for part in list(spills):
            where, path, out = spills.pop(part)
            out.close()
            below = GraceTable(self.merge, self.spill_dir, self.table_bytes, self.level + 1)
            with where.open_input_stream(path) as lines:
                reader = pickle.Unpickler(lines)
                while True:
                    try:
                        below.add(*reader.load())
                    except EOFError:
                        break
            where.delete_file(path)
            yield from below.groups()


def _id_key(doc_id):
    return (doc_id is not None, doc_id or 0)


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


# -- membership: one row per document ----------------------------------------

_LOCAL = ("rep long, doc_id long, first boolean, h long, text string, n long")


def _collapse(batches):
    """Rows of each batch -> one member row per document, with the text on one of each content."""
    from pyspark import TaskContext
    base = TaskContext.get().partitionId() << 36
    seq = 0
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        seen: dict[bytes, list[int]] = {}
        for i, content in enumerate(_bytes(batch.column("text"))):
            seen.setdefault(content, []).append(i)
        n = batch.num_rows
        rep, first, count = [0] * n, [False] * n, [None] * n
        for rows in seen.values():
            best = max(rows, key=lambda i: (*_id_key(ids[i]), -i))
            for i in rows:
                rep[i] = base + seq
            first[best], count[best] = True, len(rows)
            seq += 1
        chosen = pa.array(first)
        none = pa.scalar(None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep, pa.int64()), batch.column("doc_id"), chosen,
             pc.if_else(chosen, batch.column("h"), none.cast(pa.int64())),
             pc.if_else(chosen, batch.column("text"), none.cast(batch.column("text").type)),
             pa.array(count, pa.int64())],
            names=["rep", "doc_id", "first", "h", "text", "n"])


def _merge_reps(a, b):
    """Entry: (best doc_id, its representative, rows, representatives)."""
    best = max(a, b, key=lambda e: (*_id_key(e[0]), -e[1]))
    a[3].extend(b[3])
    return best[0], best[1], a[2] + b[2], a[3]


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    The collapsed rows are stored once; members then take their group's answer
    from their representative, a key that only one batch of rows shares.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    local = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                                    F.xxhash64(text).alias("h"))
                            .mapInArrow(_collapse, _LOCAL), "exact-local")
    spill_dir = shared_uri(spark, "grace")

    def resolve(batches):
        table = GraceTable(_merge_reps, spill_dir, table_bytes)
        for batch in batches:
            for h, content, rep, doc_id, n in zip(
                    batch.column("h").to_pylist(), _bytes(batch.column("text")), batch.column("rep").to_pylist(),
                    batch.column("doc_id").to_pylist(), batch.column("n").to_pylist()):
                table.add(h, content, (doc_id, rep, n, [rep]))
        rows = []
        for content, (doc_id, winner, n, reps) in table.groups():
            sha = hashlib.sha256(content).hexdigest()
            rows += [(rep, doc_id, winner, n, sha) for rep in reps]
            if len(rows) >= 20_000:
                yield _record(rows, answer)
                rows = []
        if rows:
            yield _record(rows, answer)

    answer = pa.schema([("r", pa.int64()), ("keep_id", pa.int64()), ("winner", pa.int64()),
                        ("group_size", pa.int64()), ("text_sha256", pa.string())])
    answers = (local.filter("first").select("h", "text", "rep", "doc_id", "n").repartition("h")
                    .mapInArrow(resolve, "r long, keep_id long, winner long, group_size long, text_sha256 string"))
    members = local.select("rep", "doc_id", "first")
    return (members.join(answers, members["rep"] == answers["r"])
                   .select("doc_id", "keep_id", "group_size",
                           (F.col("first") & (F.col("rep") == F.col("winner"))).alias("kept"), "text_sha256"))


def _record(rows, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# -- the rows that stay -------------------------------------------------------

def _better(a, b):
    """Entry: (doc_id, one-row record batch as bytes)."""
    if _id_key(a[0]) != _id_key(b[0]):
        return max(a, b, key=lambda e: _id_key(e[0]))
    return min(a, b, key=lambda e: e[1])


def exact_dedup(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    spark = docs.sparkSession
    columns = docs.columns
    spill_dir = shared_uri(spark, "grace")
    # All columns but the text travel as one packed row, so that any types go through.
    packed = docs.select(
        F.col("doc_id").cast("long").alias("id"), text_or_empty().cast("binary").alias("content"),
        F.xxhash64(text_or_empty()).alias("h"),
        F.struct(docs["text"].isNull().alias("null"),
                 *[docs[c].alias(f"c{i}") for i, c in enumerate(columns) if c != "text"]).alias("row"))

    def collapse(batches):
        for batch in batches:
            ids = batch.column("id").to_pylist()
            best: dict[bytes, int] = {}
            for i, content in enumerate(_bytes(batch.column("content"))):
                j = best.setdefault(content, i)
                if _id_key(ids[i]) > _id_key(ids[j]):
                    best[content] = i
            yield batch.take(pa.array(sorted(best.values()), pa.int64()))

    def resolve(batches):
        table, schema = GraceTable(_better, spill_dir, table_bytes), None
        for batch in batches:
            schema = batch.schema
            for h, content, doc_id, row in zip(batch.column("h").to_pylist(), _bytes(batch.column("content")),
                                               batch.column("id").to_pylist(), batch.column("row").to_pylist()):
                table.add(h, content, (doc_id, pickle.dumps(row)))
        rows, held = [], 0
        for content, (doc_id, row) in table.groups():
            rows.append((doc_id, content, 0, pickle.loads(row)))
            held += len(content)
            if len(rows) >= 5_000 or held > 16 << 20:
                yield _record(rows, schema)
                rows, held = [], 0
        if rows:
            yield _record(rows, schema)

    kept = (packed.mapInArrow(collapse, packed.schema).repartition("h").mapInArrow(resolve, packed.schema))
    out = [F.when(~F.col("row.null"), F.col("content").cast("string")).alias("text") if c == "text"
           else F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)]
    return kept.select(*out)
