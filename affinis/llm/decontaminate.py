"""Benchmark decontamination: a broadcast set of test n-grams, scanned for in every training text.

A word is a run of digits, letters a-z (A-Z lower-cased) and bytes from 0x80.  A
window is ``width`` consecutive words of an item, or a whole item of fewer.
Hashes only propose hits; each is verified against the words of its windows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.text import add_columns, byte_class, find_words, owner, text_bytes, window_hashes

WIDTH = 10
# Most bytes of benchmark text broadcast at once; a larger benchmark is scanned for in blocks.
BLOCK_BYTES = 16 << 20

WORD = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
SPEC = "n_words BIGINT, n_hit BIGINT, items ARRAY<STRING>, spans ARRAY<STRUCT<start: BIGINT, end: BIGINT>>"


class Windows:
    """All windows of some benchmark items, by width and hash, with a bit table that most words miss."""

    def __init__(self, items: list[tuple[str, bytes]], width: int) -> None:
        self.by_width: dict[int, dict[int, list[tuple[list[bytes], set[str]]]]] = defaultdict(dict)
        for item, text in items:
            data = np.frombuffer(text, np.uint8)
            words = find_words(data, np.array([0, data.size]), WORD)
            if not words.starts.size:
                continue
            n = min(width, words.starts.size)
            spelled = [text[a:b].lower() for a, b in zip(words.starts, words.ends)]
            for at, h in enumerate(window_hashes(words.hashes, n).tolist()):
                same = self.by_width[n].setdefault(h, [])
                key = spelled[at : at + n]
                for known, owners in same:
                    if known == key:
                        owners.add(item)
                        break
                else:
                    same.append((key, {item}))
        self.bits = {}
        for n, table in self.by_width.items():
            self.bits[n] = np.zeros(1 << 20, bool)
            self.bits[n][np.fromiter(table, np.uint64, len(table)) >> np.uint64(44)] = True

    def scan(self, text: pa.Array, items: pa.Array | None = None, spans: pa.Array | None = None) -> list:
        """Columns of ``SPEC`` for a text column, adding to the items and spans of an earlier scan.

        Spans are byte spans from the first to the last of consecutive hit words.
        """
        data, offsets = text_bytes(text)
        words = find_words(data, offsets, WORD)
        count = np.diff(words.first)
        row_of = owner(words.first)
        hit = np.zeros(words.starts.size + 1, np.int32)
        met = [set(x) for x in items.to_pylist()] if items is not None else [set() for _ in count]
        for row, known in enumerate(spans.to_pylist() if spans is not None else ()):
            for span in known:
                hit[np.searchsorted(words.starts, offsets[row] + span["start"])] += 1
                hit[np.searchsorted(words.ends, offsets[row] + span["end"]) + 1] -= 1
        for n, table in self.by_width.items():
            hashes = window_hashes(words.hashes, n)
            near = np.flatnonzero(self.bits[n][hashes >> np.uint64(44)])
            near = near[row_of[near] == row_of[near + n - 1]]
            for at, h in zip(near.tolist(), hashes[near].tolist()):
                for key, owners in table.get(h, ()):
                    if key == [
                        data[words.starts[i] : words.ends[i]].tobytes().lower() for i in range(at, at + n)
                    ]:
                        hit[at] += 1
                        hit[at + n] -= 1
                        met[row_of[at]] |= owners
        hit = np.cumsum(hit)[:-1] > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = total[words.first[1:]] - total[words.first[:-1]]
        found = [[] for _ in count]
        for row in np.flatnonzero(n_hit):
            a, b = words.first[row], words.first[row + 1]
            edge = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
            for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                start, end = words.starts[a + s] - offsets[row], words.ends[a + e - 1] - offsets[row]
                found[row].append({"start": int(start), "end": int(end)})
        return [count, n_hit, [sorted(x) for x in met], found]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted as strings) and byte ``spans`` of hit words.

    The items come to the driver in blocks of up to ``block_bytes`` of text
    (a longer item is a block of its own), and each block is broadcast and
    scanned for.  A benchmark of one block takes one pass over the documents and
    no shuffle; each further block is a further pass that adds to the same
    columns, so no executor holds more than one block at a time.

    Null texts have no words, items with a null id count as ''.  Repeated rows
    of either side change nothing for other rows; an empty benchmark hits
    nothing.  New columns replace those of the same name.  Reads the benchmark.
    """
    context = docs.sparkSession.sparkContext
    found, inputs = docs, [text]
    for block in list(_blocks(benchmark, item, block_bytes)) or [[]]:
        shared = context.broadcast(block)
        found = add_columns(found, inputs, lambda shared=shared: Windows(shared.value, width).scan, SPEC)
        inputs = [text, "items", "spans"]
    return found


def _blocks(benchmark: DataFrame, item: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text")
    )
    block, size = [], 0
    for row in rows.toLocalIterator():
        data = row.text.encode()
        if block and size + len(data) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.item, data))
        size += len(data)
    if block:
        yield block


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Texts without their hit spans, taken from the result of ``find_contamination``; other columns stay."""

    def cut(texts: pa.Array, spans: pa.Array) -> list:
        made = []
        for value, cuts in zip(texts.to_pylist(), spans.to_pylist()):
            data = None if value is None else value.encode()
            for span in reversed(cuts):
                data = data[: span["start"]] + data[span["end"] :]
            made.append(None if data is None else data.decode())
        return [made]

    names = found.columns
    return add_columns(found, [text, "spans"], lambda: cut, f"`{text}` STRING").select(*names)


def remove_documents(found: DataFrame) -> DataFrame:
    """Documents without any hit, taken from the result of ``find_contamination``."""
    return found.filter("n_hit = 0")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: counts of words, hit words and items, and the hash of the items' ids."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
