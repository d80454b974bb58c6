"""Whole Arrow text columns: bytes, words and word hashes as arrays, and maps over documents.

A null text counts as empty.  Nothing here looks at more than one Arrow batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

# Bytes hashed at a time, and bytes of the documents worked on together; a longer document is worked on alone.
SLICE = 1 << 20
GROUP = 4 << 20
BATCH = 8 << 20
# A sum of powers modulo 2 ** 64 tells long spans of few different bytes apart badly; longer words are named by a digest.
LONG_WORD = 64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    """Words of some texts in order: byte spans, hashes, and the first word of each text (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Table of the bytes within ``ranges``, ends included."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all 64 bits (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n."""
    known = _powers.get(base)
    if known is None or known.size < n:
        known = np.full(max(n, SLICE + 1), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 2 * SLICE:
            _powers[base] = known
    return known[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial sums of all prefixes of ``data``, the empty one first."""
    sums = np.zeros(data.size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, data.size), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of the bytes behind ``sums``; equal bytes give equal hashes."""
    inverse = powers(_INVERSE, sums.size)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column end to end, and the offsets of its rows."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int = GROUP) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ``limit`` bytes; a longer row is a range of its own."""
    at, rows = 0, offsets.size - 1
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(rows, max(at + 1, to))
        yield at, to
        at = to


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    found = span_hashes(prefix_hashes(data), starts, ends)
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        found[k] = int.from_bytes(blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return found


def find_words(
    data: np.ndarray,
    offsets: np.ndarray,
    table: np.ndarray,
    lower: bool = True,
    cut: Callable[[np.ndarray], np.ndarray] | None = None,
    hashed: bool = True,
) -> Words:
    """Runs of the bytes in ``table``, never across rows, with the hashes of their (lower-cased) bytes.

    Words of more than ``LONG_WORD`` bytes are hashed by a cryptographic digest.
    Without ``hashed`` all hashes are 0.  ``cut`` marks the bytes of an array, but the first, at which a new word starts inside a run.
    """
    starts, ends, hashes, at = [], [], [], 0
    while at < data.size:
        to = min(data.size, at + SLICE)
        if to < data.size:
            gaps = np.flatnonzero(~table[data[at:to]])
            if gaps.size:
                to = at + int(gaps[-1]) + 1
            else:
                gaps = np.flatnonzero(~table[data[to:]])
                to = to + int(gaps[0]) if gaps.size else data.size
        part = data[at:to]
        inside = table[part]
        limits = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to)] - at
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[limits] = inside[limits]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        before = limits[limits > 0] - 1
        last[before] = inside[before]
        if cut is not None:
            marks = cut(part)
            first[1:] |= marks
            last[:-1] |= marks
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(_word_hashes(LOWER[part] if lower else part, s, e) if hashed else np.zeros(s.size, np.uint64))
        at = to
    if not starts:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(offsets.size, np.int64))
    found = [np.concatenate(x) for x in (starts, ends, hashes)]
    return Words(*found, np.searchsorted(found[0], offsets))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes."""
    n = hashes.size - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = total * np.uint64(_BASE) + hashes[k : k + n]
    return mix(total)


def owner(first: np.ndarray) -> np.ndarray:
    """Row of each element, given the first element of each row (one more at the end)."""
    return np.repeat(np.arange(first.size - 1), np.diff(first))


def fields(spec: str) -> list[StructField]:
    return list(StructType.fromDDL(spec).fields)


def add_columns(
    docs: DataFrame, inputs: list[str], make: Callable[[], Callable[..., list]], spec: str, limit: int = GROUP
) -> DataFrame:
    """``docs`` with the columns of DDL ``spec`` that a function of some of its columns gives.

    ``make`` runs once in each task and returns that function, from the Arrow
    arrays of ``inputs`` (the text first) to one list or array for each new
    column; it is called with rows of up to ``limit`` bytes of text.  New columns
    replace those of the same name.  Rows stay in their tasks and order.
    """
    new = fields(spec)
    names = [c for c in docs.columns if c not in {f.name for f in new}]
    schema = StructType([*(docs.schema[c] for c in names), *new])
    at = [docs.columns.index(c) for c in inputs]
    keep = [docs.columns.index(c) for c in names]
    columns = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [to_arrow_type(f.dataType) for f in new]
        apply = make()
        for batch in batches:
            _, offsets = text_bytes(batch.column(at[0]))
            for a, b in row_groups(offsets, limit):
                part = batch.slice(a, b - a)
                made = apply(*(part.column(k) for k in at))
                made = [v if isinstance(v, pa.Array) else pa.array(v, kind) for v, kind in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *made], names=columns)

    return docs.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand Python workers batches of up to ``BATCH`` of bytes, unless the session asks for smaller ones.

    Several workers share an executor's memory, and lists made from a batch take a multiple of it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(name).strip().lower()).groups()
    if not 0 < int(number) << 10 * " kmgt".index(unit or " ") <= BATCH:
        spark.conf.set(name, str(BATCH))


def positional(docs: DataFrame) -> DataFrame:
    """The same rows with columns c0, c1, ... so that no added column clashes; undo with ``toDF(*docs.columns)``."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def read(spark, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def held_out(doc_id: str = "doc_id"):
    """True for the third of documents that learning leaves out: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
