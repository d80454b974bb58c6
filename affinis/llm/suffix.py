"""Suffix-array dedup: every string of ``length`` bytes that also starts elsewhere is removed.

Each window of that many bytes belongs to one anchor, the gram with the smallest hash
in it, so equal windows have equal anchors at equal places.  Only windows of anchors
that occur more than once can repeat.  Their surroundings are brought together by
anchor and sorted as suffixes in two stages: suffixes smaller than their successors are
sorted directly, the rest are induced from them by bucket scans; windows whose
common prefix with a neighbour is ``length`` repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.text import mix, prefix_hashes, row_groups, small_batches, span_hashes, text_bytes
from affinis.plans import stage
from affinis.plans.skew import lookup_join

LENGTH = 400
GRAM = 32
# Window starts scanned at a time.
SCAN = 1 << 21
# Bytes sorted together; an anchor with more is taken window by window.
SORTED_BYTES = 1 << 20
ANCHOR_BYTES = 3 << 20
ID = 16

RUN = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("low", "<u4"), ("high", "<u4"), ("tid", f"V{ID}")])


def window_runs(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows with one anchor: hashes of anchor and of all their bytes, first and last start.

    The anchor is the leftmost of the grams of a window with the smallest 40 bits of hash.
    """
    found = []
    for at in range(0, data.size - length + 1, SCAN):
        part = data[at : at + SCAN + length - 1]
        sums = prefix_hashes(part)
        place = np.arange(part.size - gram + 1)
        hashes = span_hashes(sums, place, place + gram)
        keys = (hashes >> np.uint64(24) << np.uint64(24)) | place.astype(np.uint64)
        width = length - gram + 1
        best = _sliding_min(keys, width) & np.uint64((1 << 24) - 1)
        low = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
        high = np.append(low[1:], best.size) - 1
        found.append((hashes[best[low].astype(np.int64)], span_hashes(sums, low, high + length), low + at, high + at))
    if not found:
        return tuple(np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(column) for column in zip(*found))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima towards both ends of blocks of that width."""
    n = values.size
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    before = np.minimum.accumulate(square, axis=1).ravel()
    after = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def smaller_than_next(symbols: np.ndarray) -> np.ndarray:
    """Whether the suffix at each position is smaller than the one after it; a 0 is smaller than all."""
    differs = np.flatnonzero(np.append(symbols[1:] != symbols[:-1], True))
    following = np.repeat(differs, np.diff(differs, prepend=-1))
    return (symbols < np.append(symbols[1:], 257)[following]) | (symbols == 0)


def sort_suffixes(symbols: np.ndarray, chosen: np.ndarray, smaller: np.ndarray, depth: int) -> np.ndarray:
    """The ``chosen`` positions in the order of their suffixes, to ``depth`` symbols.

    ``symbols`` are 1 to 256, and 0 after each string and at the end.  With every
    position but a 0 that is larger than its successor, the next one is chosen too.
    """
    induced = np.zeros(symbols.size, bool)
    induced[chosen] = ~smaller[chosen]

    # By the first seven symbols, then equal ones by the rest.
    direct = chosen[smaller[chosen]]
    padded = np.append(symbols, np.zeros(7, symbols.dtype))
    lead = np.zeros(direct.size, np.int64)
    for k in range(7):
        lead = lead << 9 | padded[direct + k]
    order = np.argsort(lead, kind="stable")
    direct, lead = direct[order], lead[order]
    new = np.flatnonzero(np.diff(lead, prepend=-1))
    stop = np.flatnonzero(symbols == 0)
    ends = np.minimum(stop[np.searchsorted(stop, direct)], direct + depth)
    raw = (symbols - 1).astype(np.uint8).tobytes()
    for a, b in zip(new.tolist(), np.append(new[1:], direct.size).tolist()):
        if b - a > 1:
            part = zip(direct[a:b].tolist(), ends[a:b].tolist())
            direct[a:b] = [i for _, i in sorted((raw[i + 7 : end], i) for i, end in part)]
    limits = np.searchsorted(symbols[direct], np.arange(258))

    order: list[np.ndarray] = []
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    for symbol in range(257):
        bucket = [np.concatenate(waiting[symbol])] if waiting[symbol] else []
        while bucket and bucket[-1].size:
            before = bucket[-1] - 1
            bucket.append(before[induced[before] & (symbols[before] == symbol)])
        bucket.append(direct[limits[symbol] : limits[symbol + 1]])
        done = np.concatenate(bucket)
        order.append(done)
        before = done[done > 0] - 1
        before = before[induced[before] & (symbols[before] > symbol)]
        before = before[np.argsort(symbols[before], kind="stable")]
        heads = symbols[before]
        starts = np.flatnonzero(np.diff(heads.astype(np.int64), prepend=-1))
        for a, b in zip(starts, np.append(starts[1:], before.size)):
            waiting[heads[a]].append(before[a:b])
    return np.concatenate(order)


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, whether each of its windows of ``length`` bytes is also another of all these windows."""
    sizes = np.array([len(c) for c in contexts])
    symbols = np.frombuffer(b"".join(c + b"\0" for c in contexts), np.uint8).astype(np.uint16) + np.uint16(1)
    first = np.cumsum(sizes + 1) - sizes - 1
    symbols[first + sizes] = 0
    count = sizes - length + 1
    place = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    window = np.zeros(symbols.size, bool)
    window[place] = True
    # A window that is larger than its successor is induced from it, up to the next smaller one.
    smaller = smaller_than_next(symbols)
    stops = np.flatnonzero(smaller)
    last = first + count - 1
    ends = stops[np.searchsorted(stops, last)]
    more = ends - last
    extra = np.repeat(last + 1 - (np.cumsum(more) - more), more) + np.arange(more.sum())
    chosen = window.copy()
    chosen[extra] = True
    order = sort_suffixes(symbols, np.flatnonzero(chosen), smaller, length)
    order = order[window[order]]
    same = np.flatnonzero(_common_prefix(symbols, order[:-1], order[1:], length))
    repeated = np.zeros(symbols.size, bool)
    repeated[order[same]] = True
    repeated[order[same + 1]] = True
    return [repeated[a : a + n] for a, n in zip(first, count)]


def _common_prefix(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffixes at ``left`` and ``right`` have ``length`` symbols in common."""
    words = np.ndarray((symbols.size - 3,), "<u8", np.ascontiguousarray(symbols), strides=(2,))
    alive = np.arange(left.size)
    steps = [*range(0, length - 3, 4), max(0, length - 4)]
    for step in steps:
        if length < 4:
            break
        alive = alive[words[left[alive] + step] == words[right[alive] + step]]
    for step in range(length if length < 4 else 0):
        alive = alive[symbols[left[alive] + step] == symbols[right[alive] + step]]
    same = np.zeros(left.size, bool)
    same[alive] = True
    return same


def _text_id(text: bytes) -> bytes:
    return sha256(text).digest()[:ID]


def distinct_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[bytes, np.ndarray]]:
    """Distinct texts of each group of rows, by id."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(0))
        for a, b in row_groups(offsets):
            data, part = text_bytes(batch.column(0).slice(a, b - a))
            found: dict[bytes, np.ndarray] = {}
            for start, end in zip(part[:-1].tolist(), part[1:].tolist()):
                found.setdefault(_text_id(data[start:end].tobytes()), data[start:end])
            yield found


def _messages(length: int, gram: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of all distinct texts, packed into one row for each bucket of anchors."""
    for texts in distinct_texts(batches):
        parts = []
        for tid, text in texts.items():
            anchor, context, low, high = window_runs(text, length, gram)
            rows = np.zeros(anchor.size, RUN)
            rows["anchor"], rows["context"], rows["low"], rows["high"] = anchor, context, low, high
            rows["tid"] = np.void(tid)
            parts.append(rows)
        rows = np.concatenate(parts) if parts else np.zeros(0, RUN)
        bucket = (mix(rows["anchor"]) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        order = np.argsort(bucket, kind="stable")
        at, first = np.unique(bucket[order], return_index=True)
        rows = rows[order]
        limits = [*first.tolist(), rows.size]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at.astype(np.int32)),
                pa.array([rows[a:b].tobytes() for a, b in zip(limits, limits[1:])], pa.binary()),
            ],
            names=["bucket", "runs"],
        )


# Role of a run: its context is sorted, or taken window by window, or isn't needed.
SORT, WINDOWS, NONE = 1, 2, 0
HIT = "tid BINARY, low BIGINT, high BIGINT, anchor BIGINT, whole BOOLEAN, role INT"


def _hits(length: int, anchor_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of anchors that occur more than once.

    Runs with all their bytes in common repeat as a whole.  Where an anchor has
    different contexts, one run of each has to be compared with the others.
    """

    def hits(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = np.frombuffer(b"".join(parts), RUN)
        rows = rows[np.lexsort((rows["low"], rank_ids(rows["tid"]), rows["high"] - rows["low"], rows["context"], rows["anchor"]))]

        def new(*columns: str) -> np.ndarray:
            changed = np.ones(rows.size, bool)
            changed[1:] = False
            for c in columns:
                values = rows["high"] - rows["low"] if c == "size" else rows[c]
                changed[1:] |= values[1:] != values[:-1]
            return changed

        rows = rows[new("anchor", "context", "size", "tid", "low")]
        anchor, context = np.cumsum(new("anchor")) - 1, new("anchor", "context", "size")
        in_context = np.bincount(np.cumsum(context) - 1)[np.cumsum(context) - 1]
        contexts = np.bincount(anchor[context], minlength=0 if not rows.size else anchor[-1] + 1)[anchor]
        weight = np.bincount(anchor[context], (rows["high"] - rows["low"] + length)[context])[anchor]
        whole = in_context > 1
        role = np.where(context & (contexts > 1), np.where(weight > anchor_bytes, WINDOWS, SORT), NONE)
        kept = np.flatnonzero(whole | (role != NONE))
        for a in range(0, kept.size, 50_000):
            part = kept[a : a + 50_000]
            chosen = rows[part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bytes(t) for t in chosen["tid"].tolist()], pa.binary()),
                    pa.array(chosen["low"].astype(np.int64)),
                    pa.array(chosen["high"].astype(np.int64)),
                    pa.array(np.ascontiguousarray(chosen["anchor"]).view(np.int64)),
                    pa.array(whole[part]),
                    pa.array(role[part].astype(np.int32)),
                ],
                names=["tid", "low", "high", "anchor", "whole", "role"],
            )

    bucket, parts = None, []
    for batch in batches:
        for of, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if of != bucket and parts:
                yield from hits(parts)
                parts = []
            bucket = of
            parts.append(runs)
    if parts:
        yield from hits(parts)


def rank_ids(ids: np.ndarray) -> np.ndarray:
    """Numbers that are equal for equal ids."""
    halves = np.frombuffer(np.ascontiguousarray(ids).tobytes(), "<u8").reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.zeros(order.size, np.int64)
    new[1:] = (halves[order[1:]] != halves[order[:-1]]).any(1)
    rank = np.empty(order.size, np.int64)
    rank[order] = np.cumsum(new)
    return rank


def distinct_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts in distinct_texts(batches):
        columns = [pa.array(list(texts), pa.binary()), pa.array([t.tobytes() for t in texts.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["tid", "data"])


def _contexts(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the runs that have to be compared."""
    names = ["anchor", "tid", "low", "whole", "role", "bytes"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
    for batch in batches:
        for tid, data, runs in zip(*(c.to_pylist() for c in batch.columns)):
            rows = [
                (r["anchor"], tid, r["low"], r["whole"], r["role"], data[r["low"] : r["high"] + length])
                for r in runs
                if r["role"] != NONE
            ]
            for a in range(0, len(rows), 1000):
                columns = zip(*rows[a : a + 1000])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _marks(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), ()]
    kinds = [pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["tid", "low", "high"])


def _sorted_marks(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows among contexts that come anchor by anchor; whole anchors are sorted together."""
    held, size, anchor = [], 0, None

    def marks() -> pa.RecordBatch:
        found = []
        for (tid, low, whole, _), repeated in zip(held, repeated_starts([h[3] for h in held], length)):
            if not whole:
                edge = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
                for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                    found.append((tid, low + int(a), low + int(b) - 1))
        return _marks(found)

    for batch in batches:
        for of, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if of != anchor and size > SORTED_BYTES:
                yield marks()
                held, size = [], 0
            anchor = of
            held.append(row)
            size += len(row[3])
    if held:
        yield marks()


def _windows(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of some contexts, with two hashes of its bytes."""
    for batch in batches:
        for tid, low, data in zip(*(c.to_pylist() for c in batch.columns)):
            raw = np.frombuffer(data, np.uint8)
            start = np.arange(raw.size - length + 1)
            one = span_hashes(prefix_hashes(raw), start, start + length)
            two = span_hashes(prefix_hashes(np.bitwise_xor(raw, np.uint8(0x5A))), start, start + length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array([tid] * start.size, pa.binary()), pa.array(start + low)],
                names=["one", "two", "tid", "low"],
            )


def _removed(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes of their marked windows."""
    for batch in batches:
        out = []
        for tid, data, marks in zip(*(c.to_pylist() for c in batch.columns)):
            cover = np.zeros(len(data) + 1, np.int32)
            low, high = np.array([m["low"] for m in marks]), np.array([m["high"] for m in marks])
            np.add.at(cover, low, 1)
            np.add.at(cover, high + length, -1)
            gone = np.cumsum(cover)[:-1] > 0
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
            out.append((tid, int(gone.sum()), spans, kept))
        columns = list(zip(*out)) if out else [()] * 4
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["tid", "n_removed", "n_spans", "kept"]
        )


def describe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        digests = [sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
        columns = [batch.column(0), pa.array(np.diff(offsets)), pa.array([d[:ID] for d in digests], pa.binary())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary())], names=["doc_id", "n", "tid", "sha"])


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row of ``docs``.

    Removes each byte covered by a string of ``length`` bytes that also starts at
    another place of the same or another document, judged on the whole input;
    ``n_spans`` counts maximal removed runs, ``kept`` holds the remaining bytes and
    is null where nothing was removed.  A null text counts as empty; texts shorter
    than ``length`` lose nothing.  Repeated rows are copies of each other, whatever
    their ids.  An empty table gives an empty table; other columns are not read.
    Stages intermediates, so it runs jobs when called.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = stage(docs.mapInArrow(describe_rows, "doc_id BIGINT, n BIGINT, tid BINARY, sha BINARY"))
    buckets = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    messages = docs.select("text").mapInArrow(partial(_messages, length, gram, buckets), "bucket INT, runs BINARY")
    dealt = messages.repartition("bucket").sortWithinPartitions("bucket")
    hits = stage(dealt.mapInArrow(partial(_hits, length, anchor_bytes), HIT))

    # The texts that have hits, once each.
    runs = hits.groupBy("tid").agg(F.collect_list(F.struct("low", "high", "anchor", "whole", "role")).alias("runs"))
    texts = docs.select("text").mapInArrow(distinct_rows, "tid BINARY, data BINARY")
    texts = stage(texts.groupBy("tid").agg(F.first("data").alias("data")).join(runs, "tid"))
    contexts = texts.mapInArrow(
        partial(_contexts, length), "anchor BIGINT, tid BINARY, low BIGINT, whole BOOLEAN, role INT, bytes BINARY"
    )
    compared = contexts.filter(F.col("role") == SORT).select("anchor", "tid", "low", "whole", "bytes")
    compared = compared.repartition("anchor").sortWithinPartitions("anchor")
    mark = "tid BINARY, low BIGINT, high BIGINT"
    marks = hits.filter("whole").select("tid", "low", "high").unionAll(
        compared.mapInArrow(partial(_sorted_marks, length), mark)
    )
    if not hits.filter(F.col("role") == WINDOWS).isEmpty():
        large = contexts.filter(F.col("role") == WINDOWS).select("tid", "low", "bytes")
        windows = stage(large.mapInArrow(partial(_windows, length), "one BIGINT, two BIGINT, tid BINARY, low BIGINT"))
        several = windows.groupBy("one", "two").agg(F.count("*").alias("n")).filter("n > 1").select("one", "two")
        again = windows.join(several, ["one", "two"], "left_semi")
        marks = marks.unionAll(again.select("tid", "low", F.col("low").alias("high")))
    marks = marks.groupBy("tid").agg(F.collect_list(F.struct("low", "high")).alias("marks"))
    done = texts.select("tid", "data").join(marks, "tid").select("tid", "data", "marks")
    done = done.mapInArrow(partial(_removed, length), "tid BINARY, n_removed BIGINT, n_spans BIGINT, kept BINARY")

    # A text with copies goes as a whole.
    copies = rows.groupBy("tid").agg(F.count("*").alias("copies"))
    named = copies.join(done, "tid", "left")
    every = lookup_join(rows, named, ["tid"], counted=rows.select("tid"))
    whole = (F.col("copies") > 1) & (F.col("n") >= length)
    some = F.coalesce(F.col("n_removed"), F.lit(0)) > 0
    kept = F.when(whole, F.lit(b"")).when(some, F.col("kept"))
    return every.select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.coalesce(F.sha2(kept, 256), F.lower(F.hex("sha"))).alias("kept_sha256"),
        kept.alias("kept"),
    )


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, and the hash of what is left."""
    return remove_repeats(docs).drop("kept")
