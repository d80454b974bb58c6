"""Exact dedup by Grace hashing.

Records are partitioned by hash into buckets on disk (Spark's shuffle files), each
bucket is read into an open-addressing table that compares complete contents, and
what a table can't hold is partitioned again by the next hash, until every bucket
fits.  Copies within one batch are merged before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.text import add_columns, text_bytes
from affinis.plans import stage

# Bytes of distinct content that one table holds, and bytes of text merged before the shuffle.
TABLE_BYTES = 32 << 20
BATCH_BYTES = 32 << 20
# What an entry takes besides its content.
ENTRY_BYTES = 200

LOCAL = "digest BINARY, size BIGINT, rep BIGINT, n BIGINT, top BIGINT, best BOOLEAN"
ROUND = "rep BIGINT, keep_id BIGINT, group_size BIGINT, lead BOOLEAN, digest BINARY, size BIGINT, n BIGINT, top BIGINT, text STRING"


class Table:
    """Open addressing with linear probing over entries; two keys are one if all their bytes are equal."""

    def __init__(self) -> None:
        self.slots = [-1] * 64
        self.tags: list[int] = []
        self.keys: list[bytes] = []

    def find(self, digest: bytes, key: bytes) -> int:
        """Entry of ``key``, or -1."""
        tag = int.from_bytes(digest[-8:], "little")
        mask = len(self.slots) - 1
        at = tag & mask
        while (entry := self.slots[at]) >= 0:
            if self.tags[entry] == tag and self.keys[entry] == key:
                return entry
            at = at + 1 & mask
        return -1

    def add(self, digest: bytes, key: bytes) -> int:
        """New entry for a key that isn't there."""
        self.tags.append(int.from_bytes(digest[-8:], "little"))
        self.keys.append(key)
        if 3 * len(self.keys) > 2 * len(self.slots):
            self.slots = [-1] * (4 * len(self.slots))
            for entry in range(len(self.keys)):
                self._place(entry)
        else:
            self._place(len(self.keys) - 1)
        return len(self.keys) - 1

    def _place(self, entry: int) -> None:
        mask = len(self.slots) - 1
        at = self.tags[entry] & mask
        while self.slots[at] >= 0:
            at = at + 1 & mask
        self.slots[at] = entry


def higher(a: int | None, b: int | None) -> bool:
    """Whether id ``a`` is above ``b``; a null id is below all others."""
    return a is not None and (b is None or a > b)


def _merge_batches():
    """Mark each batch's first row of every content as its representative, with count and largest id."""
    made = TaskContext.get().partitionId() << 33

    def merge(texts: pa.Array, ids: pa.Array) -> list:
        nonlocal made
        data, offsets = text_bytes(texts)
        raw, table = data.tobytes().lower(), Table()
        digests, sizes, entries, first, count, best = [], [], [], [], [], []
        ids = ids.to_pylist()
        for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            key = raw[a:b]
            digest = sha256(key).digest()
            entry = table.find(digest, key)
            if entry < 0:
                entry = table.add(digest, key)
                first.append(row)
                count.append(0)
                best.append(row)
            count[entry] += 1
            if higher(ids[row], ids[best[entry]]):
                best[entry] = row
            digests.append(digest)
            sizes.append(b - a)
            entries.append(entry)
        n, top, lead = [None] * len(ids), [None] * len(ids), [False] * len(ids)
        for entry, row in enumerate(first):
            n[row], top[row] = count[entry], ids[best[entry]]
            lead[best[entry]] = True
        reps = [made + entry for entry in entries]
        made += len(first)
        return [digests, sizes, reps, n, top, lead]

    return merge


def _merge_buckets(table_bytes: int):
    """Groups of each bucket's records, and the records that found no room in its table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rep", "keep_id", "group_size", "lead", "digest", "size", "n", "top", "text"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), *[pa.int64()] * 3, pa.string()]
        bucket, table, groups, held = None, Table(), [], 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def results() -> Iterator[pa.RecordBatch]:
            rows = []
            for total, top, lead, reps in groups:
                for rep in reps:
                    rows.append((rep, top, total, rep == lead, None, None, None, None, None))
                    if len(rows) == 10_000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)

        for batch in batches:
            spilled = []
            for of, digest, size, rep, n, top, text in zip(*(c.to_pylist() for c in batch.columns)):
                if of != bucket:
                    yield from results()
                    bucket, table, groups, held = of, Table(), [], 0
                key = (text or "").encode().lower()
                entry = table.find(digest, key)
                if entry < 0 and held and held + size + ENTRY_BYTES > table_bytes:
                    spilled.append((None, None, None, None, digest, size, n, top, text, rep))
                    continue
                if entry < 0:
                    table.add(digest, key)
                    held += size + ENTRY_BYTES
                    groups.append([n, top, rep, [rep]])
                    continue
                group = groups[entry]
                group[0] += n
                if higher(top, group[1]) or top == group[1] and rep < group[2]:
                    group[1], group[2] = top, rep
                group[3].append(rep)
            if spilled:
                yield batch_of([(r[9], *r[1:9]) for r in spilled])
        yield from results()

    return run


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest id stays, one of them where that row
    is repeated; a null id is below all others.  ``text_sha256`` is the lower-case
    hex hash of the lower-cased UTF-8 text.  An empty table gives an empty table.
    New columns replace those of the same name, as do the operator's own (those
    of ``LOCAL``).  Stages its input and each round, so it runs jobs when called.
    """
    names = [c for c in docs.columns if c not in ("keep_id", "group_size", "kept", "text_sha256")]
    rows = stage(add_columns(docs.select(names), [text, doc_id], _merge_batches, LOCAL, BATCH_BYTES))
    names = [c for c in names if c in rows.columns and c not in LOCAL.split()[::2]]
    left = rows.filter("n is not null").select("digest", "size", "rep", "n", "top", F.col(text).alias("text"))
    rounds = []
    while True:
        held = left.agg(F.sum(F.col("size") + ENTRY_BYTES)).first()[0]
        if not held and rounds:
            break
        buckets = 1 + 2 * (held or 0) // table_bytes
        bucket = F.pmod(F.xxhash64("digest", F.lit(len(rounds))), F.lit(buckets))
        dealt = left.select(bucket.alias("bucket"), "digest", "size", "rep", "n", "top", "text")
        dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
        done = stage(dealt.mapInArrow(_merge_buckets(table_bytes), ROUND))
        rounds.append(done.filter("group_size is not null").select("rep", "keep_id", "group_size", "lead"))
        left = done.filter("group_size is null").select("digest", "size", "rep", "n", "top", "text")
    groups = reduce(DataFrame.unionAll, rounds)
    return rows.join(groups, "rep").select(
        *names,
        "keep_id",
        "group_size",
        (F.col("best") & F.col("lead")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: the row that stays of its copies, their number, and the hash of their text."""
    return exact_groups(docs.select("doc_id", "text")).drop("text")
