"""N-gram Jaccard join: parity sketches joined block by block, then verified.

A document's set holds its distinct shingles.  Each shingle is XORed into one block of
a sketch, so the number of differing blocks is at most the symmetric difference of
two sets.  Sets whose larger one has up to ``hi`` shingles can link only if they differ
in ``d = 2 * hi // 9`` shingles at most; with more than ``d`` blocks one must agree, and
one that is not empty where either set fills more than ``d`` of them.  Blocks are
joined per band of sizes, candidates are thinned by the Hamming distance of a second
sketch of single bits, and what is left is verified on the sets.

Very frequent shingles would make very large groups, so blocks are made without them;
a set that fills too few blocks that way takes part with all its shingles as well.
Within a group, only one member is compared with all others.  Then each member is
compared with the nearest one that the links found so far leave in another component,
and last all are that are still apart and may be close enough.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.components import components
from affinis.llm.text import byte_class, find_words, mix, row_groups, small_batches, text_bytes, window_hashes
from affinis.plans import stage
from affinis.plans.skew import lookup_join

WIDTH = 5
# Link when 100 * intersection >= 80 * union; the bounds below are for this value.
PERCENT = 80
# A shingle in more than this share of the documents is left out of the blocks, up to so many of them.
FREQUENT_SHARE = 0.002
FREQUENT_SHINGLES = 100_000
# Ids of sets broadcast to a scan; more are joined.
BROADCAST_IDS = 1_000_000
# Bytes of the sketches that tell which sets are near each other.
SHORT = 64
# Pairs of one group whose distances are taken at once.
TILE = 256
# Members of one part of an open group; each two parts of a larger group meet in a task.
PART = 2_000
# Pairs a task holds before it hands them on.
HELD = 100_000

WORD = ~byte_class([(0x09, 0x0D), (0x20, 0x20)])
ID = 12


class Band(NamedTuple):
    number: int
    low: int
    high: int

    @property
    def differences(self) -> int:
        return 2 * self.high // 9

    @property
    def blocks(self) -> int:
        return max(self.differences + 1, -(-12 * self.low // 25))


def bands_of(size: int) -> list[Band]:
    """Bands a set takes part in: its own, as the larger one, and the next if it reaches there as the smaller one."""
    number, low, high = 0, 1, 4
    while high < size:
        number, low, high = number + 1, high + 1, 3 * (high + 1) // 2
    own = Band(number, low, high)
    following = Band(number + 1, high + 1, 3 * (high + 1) // 2)
    return [own, following] if 5 * size // 4 >= following.low else [own]


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text; a text of fewer words has one, of none no shingle."""
    data, offsets = text_bytes(texts)
    words = find_words(data, offsets, WORD)
    whole = window_hashes(words.hashes, width)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= width:
            yield np.unique(whole[a : b - width + 1])
        else:
            yield window_hashes(words.hashes[a:b], b - a) if b > a else whole[:0]


def set_id(shingles: np.ndarray) -> bytes:
    return sha256(shingles.tobytes()).digest()[:ID]


def bit_sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles that hash to each of 2 to 4 bits a shingle (a power of two, 64 at least)."""
    bits = max(64, 1 << int(2 * shingles.size - 1).bit_length())
    at = (shingles * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits) & 1).tobytes()


def fold(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch folded to fewer bits; parities of the same shingles."""
    while sketch.shape[-1] > size:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def block_keys(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Keys of which linked sets share one at least: a hash of band, block and the block's XOR."""
    rare = shingles
    if frequent.size:
        at = np.minimum(np.searchsorted(frequent, shingles), frequent.size - 1)
        rare = shingles[frequent[at] != shingles]
    keys = []

    def fill(band: Band, level: int, members: np.ndarray) -> np.ndarray:
        block = ((members >> np.uint64(32)) * np.uint64(band.blocks) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(block, prepend=-1))
        value = np.bitwise_xor.reduceat(mix(members), first) if first.size else members
        keys.append(_keys(band, level, block[first], value))
        return block[first]

    for band in bands_of(shingles.size):
        if fill(band, 0, rare).size <= band.differences:
            filled = fill(band, 1, shingles)
            if filled.size <= band.differences:
                empty = np.setdiff1d(np.arange(band.blocks), filled)
                keys.append(_keys(band, 1, empty, np.zeros(empty.size, np.uint64)))
    return np.concatenate(keys)


def _keys(band: Band, level: int, block: np.ndarray, value: np.ndarray) -> np.ndarray:
    spot = block.astype(np.uint64) + np.uint64(((2 * band.number + level) << 32) + 1)
    return mix(value + mix(spot))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, id and bit sketch of each document's set; and shingles frequent among the documents of a batch."""
    names = ["doc_id", "n", "sid", "sketch", "half", "short", "shingle", "seen"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4, pa.int64(), pa.int64()]
    for batch in batches:
        _, offsets = text_bytes(batch.column(1))
        for a, b in row_groups(offsets):
            sets = list(shingle_sets(batch.column(1).slice(a, b - a)))
            n = [s.size for s in sets]
            columns = [batch.column(0).slice(a, b - a), n, [set_id(s) if s.size else None for s in sets]]
            sketches = [bit_sketch(s) if s.size else None for s in sets]
            half, short = (
                [s and fold(np.frombuffer(s, np.uint8), max(SHORT, len(s) // 2) if whole else SHORT).tobytes() for s in sketches]
                for whole in (True, False)
            )
            columns += [sketches, half, short, [None] * len(n), [None] * len(n)]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )
            value, count = np.unique(np.concatenate(sets), return_counts=True)
            often = count >= max(4, FREQUENT_SHARE * len(n))
            none = [None] * int(often.sum())
            columns = [none, none, none, none, none, none, value[often].view(np.int64), count[often]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _frequent(described: DataFrame, documents: int) -> np.ndarray:
    """The most frequent shingles, a bounded number of them. They steer the plan; the links don't depend on them."""
    counted = described.filter("seen is not null").groupBy("shingle").agg(F.sum("seen").alias("seen"))
    counted = counted.filter(F.col("seen") >= FREQUENT_SHARE * documents)
    top = counted.orderBy(F.desc("seen"), "shingle").limit(FREQUENT_SHINGLES).toPandas()
    return np.sort(top["shingle"].to_numpy(np.int64).view(np.uint64))


def _messages(frequent, buckets: int):
    """Keys and set ids of many documents packed into one row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_bytes(batch.column(0))
            for a, b in row_groups(offsets):
                seen, keys, ids, count = set(), [], [], []
                for shingles in shingle_sets(batch.column(0).slice(a, b - a)):
                    if not shingles.size or (sid := set_id(shingles)) in seen:
                        continue
                    seen.add(sid)
                    found = block_keys(shingles, frequent.value)
                    keys.append(found)
                    ids.append(sid)
                    count.append(found.size)
                if not keys:
                    continue
                key = np.concatenate(keys)
                sid = np.repeat(np.array(ids, f"V{ID}"), count)
                bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                at, first = np.unique(bucket[order], return_index=True)
                # Five bytes tell the keys of a bucket apart but for a few, which verification removes.
                low = key[order].view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                sid = sid[order].tobytes()
                limits = [*first.tolist(), key.size]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(at, pa.int32()),
                        pa.array([low[5 * x : 5 * y] for x, y in zip(limits, limits[1:])], pa.binary()),
                        pa.array([sid[ID * x : ID * y] for x, y in zip(limits, limits[1:])], pa.binary()),
                    ],
                    names=["bucket", "keys", "sids"],
                )

    return run


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each key that several sets have and the first of them, the group named by a hash of all members."""
    bucket, keys, sids = None, [], []

    def groups() -> Iterator[pa.RecordBatch]:
        low = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 5)
        key = np.zeros((low.shape[0], 8), np.uint8)
        key[:, :5] = low
        key, raw = key.view(np.uint64).ravel(), np.frombuffer(b"".join(sids), np.uint8).reshape(-1, ID)
        order = np.argsort(key, kind="stable")
        key, raw = key[order], raw[order]
        shared = np.concatenate([[False], key[1:] == key[:-1], [False]])
        shared = shared[1:] | shared[:-1]
        key, raw = key[shared], raw[shared]
        if not key.size:
            return
        own = np.frombuffer(np.ascontiguousarray(raw[:, :8]).tobytes(), np.uint64)
        tail = np.frombuffer(np.ascontiguousarray(raw[:, 8:]).tobytes(), np.uint32)
        order = np.lexsort((tail, own, key))
        key, own, tail, raw = key[order], own[order], tail[order], raw[order]
        new = np.ones(key.size, bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1]) | (tail[1:] != tail[:-1])
        key, own, raw = key[new], own[new], raw[new]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, key.size))
        name = np.repeat(np.add.reduceat(mix(own), first), size)
        several = np.repeat(size > 1, size)
        lead = raw[np.repeat(first, size)][several].tobytes()
        name, raw = name[several], raw[several].tobytes()
        for a in range(0, name.size, 50_000):
            b = min(name.size, a + 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(name[a:b].view(np.int64)),
                    pa.array([raw[ID * k : ID * k + ID] for k in range(a, b)], pa.binary()),
                    pa.array([lead[ID * k : ID * k + ID] for k in range(a, b)], pa.binary()),
                ],
                names=["grp", "sid", "lead"],
            )

    for batch in batches:
        for of, k, s in zip(*(c.to_pylist() for c in batch.columns)):
            if of != bucket and keys:
                yield from groups()
                keys, sids = [], []
            bucket = of
            keys.append(k)
            sids.append(s)
    if keys:
        yield from groups()


def _near(
    left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hamming distance of sketches of one width, and whether linked sets of these sizes can be as far apart."""
    distance = np.bitwise_count(left ^ right).sum(-1, dtype=np.int64)
    fits = 5 * np.minimum(n_left, n_right) >= 4 * np.maximum(n_left, n_right)
    return distance, fits & (9 * distance <= n_left + n_right)


def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches are close enough."""
    for batch in batches:
        a, b, na, nb, sa, sb = (c.to_pylist() for c in batch.columns)
        kept = []
        for k in range(len(a)):
            x, y = np.frombuffer(sa[k], np.uint8), np.frombuffer(sb[k], np.uint8)
            size = min(x.size, y.size)
            if _near(fold(x, size), fold(y, size), np.int64(na[k]), np.int64(nb[k]))[1]:
                kept.append(k)
        yield batch.take(pa.array(kept, pa.int32())).select(["a", "b"])


def _open_groups(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``grp, sid, root`` of the groups whose members are in several components."""
    known = members.select("grp", "sid").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    ends = known.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return known.join(ends.filter("low <> high").select("grp"), "grp", "left_semi").select("grp", "sid", "root")


def _cells(groups: DataFrame, part: int) -> DataFrame:
    """``groups`` with ``x, y, own``: members dealt into parts, every two of which (and each by itself) are a cell."""
    sizes = groups.groupBy("grp").agg(F.ceil(F.count("*") / part).alias("parts"))
    dealt = groups.join(sizes, "grp").withColumn("own", F.expr("pmod(xxhash64(sid), parts)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    return dealt.select("*", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))


def _open_pairs(nearest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Close pairs of a cell's members in different components, all or each member's nearest.

    Rows (grp, x, y, own, sid, root, n, sketch) come cell by cell; members of one part are compared in
    the part's own cell.  Pairs that a task meets again soon are left out.
    """

    def pairs(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        if len({r[2] for r in rows}) < 2:
            return
        size = min(len(r[4]) for r in rows)
        wide = defaultdict(list)
        for row in rows:
            wide[len(row[4])].append(row)
        rows = [row for part in wide.values() for row in part]
        sketch = np.concatenate(
            [fold(np.array([np.frombuffer(r[4], np.uint8) for r in part]), size) for part in wide.values()]
        )
        n, own = np.array([r[3] for r in rows]), np.array([r[0] for r in rows])
        mixed = own.min() < own.max()
        index: dict[bytes, int] = {}
        root = np.array([index.setdefault(r[2], len(index)) for r in rows])
        for a in range(0, len(rows), TILE):
            best, partner = np.full(len(rows[a : a + TILE]), np.inf), np.zeros(len(rows[a : a + TILE]), np.int64)
            for b in range(0 if nearest else a, len(rows), TILE):
                x, y = slice(a, a + TILE), slice(b, b + TILE)
                distance, close = _near(sketch[x, None], sketch[None, y], n[x, None], n[None, y])
                close &= root[x, None] != root[None, y]
                if mixed:
                    close &= own[x, None] != own[None, y]
                if nearest:
                    distance = np.where(close, distance, np.inf)
                    least = distance.min(1)
                    partner = np.where(least < best, b + distance.argmin(1), partner)
                    best = np.minimum(best, least)
                    continue
                for i, j in np.argwhere(close):
                    if a + i < b + j:
                        yield tuple(sorted((rows[a + i][1], rows[b + j][1])))
            for i in np.flatnonzero(best < np.inf):
                yield tuple(sorted((rows[a + i][1], rows[partner[i]][1])))

    def packed(found: set[tuple[bytes, bytes]]) -> pa.RecordBatch:
        sides = [pa.array([pair[k] for pair in found], pa.binary()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(sides, names=["a", "b"])

    def cells() -> Iterator[list[tuple]]:
        cell, rows = None, []
        for batch in batches:
            for grp, x, y, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (grp, x, y) != cell:
                    yield rows
                    cell, rows = (grp, x, y), []
                rows.append(tuple(row))
        yield rows

    found = set()
    for rows in cells():
        for pair in pairs(rows):
            found.add(pair)
            if len(found) > HELD:
                yield packed(found)
                found = set()
    yield packed(found)


def _sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """``sid, shingles`` of the sets named in ``needed``; runs a job that counts them."""
    few = needed.count() <= BROADCAST_IDS
    ids = {bytes(row[0]) for row in needed.collect()} if few else set()
    wanted = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_bytes(batch.column(0))
            for a, b in row_groups(offsets):
                found = {set_id(s): s.tobytes() for s in shingle_sets(batch.column(0).slice(a, b - a)) if s.size}
                kept = [k for k in found if not few or k in wanted.value]
                columns = [pa.array(kept, pa.binary()), pa.array([found[k] for k in kept], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["sid", "shingles"])

    sets = docs.select("text").mapInArrow(run, "sid BINARY, shingles BINARY")
    if not few:
        sets = sets.join(needed, "sid", "left_semi")
    return sets.groupBy("sid").agg(F.first("shingles").alias("shingles"))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for k, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = np.intersect1d(x, y, assume_unique=True).size
            if 100 * common >= PERCENT * (x.size + y.size - common):
                kept.append(k)
        yield batch.take(pa.array(kept, pa.int32())).select(["a", "b"])


def _verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    needed = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select(F.col("b").alias("sid"))).distinct()
    sets = stage(_sets(docs, needed))
    x = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return stage(both.mapInArrow(_verified, "a BINARY, b BINARY"))


def linked_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: int = PART) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Words are runs of bytes other than white space (A-Z lower-cased), shingles
    five words; a text of fewer words is one shingle, a null, empty or blank one
    has none and links with nothing.  Equal texts and equal sets link, repeated
    rows too.  ``component_id`` is the smallest id reachable by links; null ids
    count only where a component has no other.  Sets are compared by 64-bit
    hashes of their shingles.  An empty table gives an empty table; other columns
    are not read.  A group that links leave open is compared in cells of two parts of
    about ``part`` members.  Stages intermediates, so it runs jobs when called.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    described = stage(
        docs.mapInArrow(
            _describe,
            "doc_id BIGINT, n BIGINT, sid BINARY, sketch BINARY, half BINARY, short BINARY, shingle BIGINT, seen BIGINT",
        )
    )
    rows = described.filter("n is not null")
    sets = rows.filter("n > 0").groupBy("sid").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.first("half").alias("half"), F.first("short").alias("short"),
    )
    frequent = spark.sparkContext.broadcast(_frequent(described, rows.count()))
    buckets = 8 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    messages = docs.select("text").mapInArrow(_messages(frequent, buckets), "bucket INT, keys BINARY, sids BINARY")
    dealt = messages.repartition("bucket").sortWithinPartitions("bucket")
    # Groups of the same members are one from here on.
    members = stage(dealt.mapInArrow(_shared_keys, "grp BIGINT, sid BINARY, lead BINARY").distinct())

    # One member of each group against all others.
    pairs = members.filter("sid <> lead").select(F.least("sid", "lead").alias("a"), F.greatest("sid", "lead").alias("b"))
    pairs = pairs.distinct()
    sketches = stage(sets.select("sid", "n", "sketch", "half", "short").join(members.select("sid").distinct(), "sid", "left_semi"))

    def near(pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sketches are close enough."""
        for side in ("a", "b"):
            own = sketches.select(F.col("sid").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}"))
            pairs = pairs.join(own, side)
        return pairs.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_near_pairs, "a BINARY, b BINARY")

    first = stage(near(pairs))
    links = _verify(first, docs)

    # The others, where a group still has members of several components.
    done = first
    roots = stage(components(links)).withColumnRenamed("node", "sid")
    groups = members
    for nearest in (True, False):
        # Groups of one component are settled before sketches are looked up.
        groups = stage(_open_groups(groups, roots))
        if groups.isEmpty():
            break
        # A short sketch is enough to tell which is near, and half of one leaves few pairs for the whole.
        known = sketches.select("sid", "n", F.col("short" if nearest else "half").alias("sketch"))
        cells = _cells(groups, part).join(known, "sid").select("grp", "x", "y", "own", "sid", "root", "n", "sketch")
        cells = cells.repartition("grp", "x", "y").sortWithinPartitions("grp", "x", "y")
        pairs = cells.mapInArrow(partial(_open_pairs, nearest), "a BINARY, b BINARY").distinct()
        pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stage(pairs if nearest else near(pairs))
        if not pairs.isEmpty():
            done, links = done.unionAll(pairs), links.unionAll(_verify(pairs, docs))
            roots = stage(components(links)).withColumnRenamed("node", "sid")

    placed = stage(sets.select("sid", "least").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid")))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("sid", "component_id")
    some = lookup_join(rows.filter("n > 0").select("doc_id", "n", "sid"), named, ["sid"])
    some = some.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.unionAll(rows.filter("n = 0").select("doc_id", F.col("n"), F.col("doc_id")))
