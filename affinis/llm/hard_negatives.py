"""Hard negatives: the rows of other labels that score highest within a window below a positive's score.

Scores are inner products of whole-numbered vectors.  Augmented by one component,
``sqrt(M**2 - |x|**2)`` with ``M`` the largest norm, all rows lie on one sphere, where a
row's angle to an anchor (whose own added component is 0) gives its score.  Angles are a
metric, so a node of a cover tree whose rows all lie within an angle of its center bounds
their scores from both sides.

Rows are dealt to the nearest of some sample rows, and each cell, in shards of bounded
size, becomes one cover tree: a row of a staged table with packed vectors.  Anchors go to the
cells that their bounds leave open, nearest cells first and the others only where they
still can matter, stream past the tree of each task, and descend it level by level.
Nodes outside all windows are skipped, the best leaves are read first, and every row of a leaf
that stays open is scored exactly.  No row that could be among the results is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.text import small_batches, text_bytes
from affinis.plans import stage
from affinis.plans.skew import partitions

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
SCALE = 256
# Bytes of the vectors of one tree, rows of a leaf, children of a node, and sample rows that cells are formed around.
SHARD_BYTES = 16 << 20
LEAF = 64
FANOUT = 16
CELLS = 2048
# Each level's covering radius is at most this part of the one above, unless a node has FANOUT children before.
SHRINK = 0.5
# Anchors searched together, and leaves that each reads before its threshold cuts others off.
TOGETHER = 512
FIRST_LEAVES = 4
# Bounds are widened by this part of the largest score for the rounding of angles.
SLACK = 1e-6

NONE = -(1 << 62)


def whole_numbers(vector: str, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component as BIGINTs; null where the vector or a component is null or not finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


class Tree(NamedTuple):
    """A cover tree: rows in leaf order, and nodes level by level with the span of rows below each."""

    vectors: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    centers: np.ndarray
    angles: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    parents: np.ndarray
    leaves: np.ndarray


def _angles(scores: np.ndarray, norms: np.ndarray | float, largest: float) -> np.ndarray:
    scale = np.asarray(norms * largest, float)
    return np.arccos(np.clip(scores / np.where(scale > 0, scale, 1.0), -1.0, 1.0))


def _spread_centers(points: np.ndarray, radius: float, fanout: int) -> tuple[np.ndarray, np.ndarray]:
    """Centers, each the point farthest from those before, until all lie within ``radius`` of one; and each point's center."""
    centers, near = [0], points @ points[0]
    which = np.zeros(len(points), np.int64)
    while len(centers) < fanout:
        far = int(near.argmin())
        if np.arccos(np.clip(near[far], -1.0, 1.0)) <= radius or near[far] >= 1.0:
            break
        own = points @ points[far]
        closer = own > near
        which[closer] = len(centers)
        near = np.maximum(near, own)
        centers.append(far)
    which[centers] = np.arange(len(centers))
    return np.array(centers), which


def build_tree(vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, largest: float, leaf: int = LEAF) -> Tree:
    """Tree over the rows; ``largest`` is at least their largest norm."""
    values = vectors.astype(float)
    height = np.sqrt(np.maximum(0.0, largest**2 - (values**2).sum(1)))
    points = np.concatenate([values, height[:, None]], 1) / (largest or 1.0)
    if not largest:
        points[:, -1] = 1.0
    order = np.arange(len(ids))
    nodes: list[tuple[int, int, int, int, float]] = []
    # (rows from, to, parent, center): the next level's nodes; each is measured, then split around new centers.
    level = [(0, len(ids), -1, 0)]
    leaves = []
    while level:
        below = []
        for a, b, parent, center in level:
            inside = points[order[a:b]]
            angle = float(np.arccos(np.clip((inside @ points[center]).min(), -1.0, 1.0))) + 1e-7
            at = len(nodes)
            nodes.append((a, b, parent, center, angle))
            if b - a > leaf:
                # The center comes first, so that it is the center of one child too.
                first = int(np.flatnonzero(order[a:b] == center)[0])
                order[[a, a + first]] = order[[a + first, a]]
                centers, which = _spread_centers(points[order[a:b]], angle * SHRINK, FANOUT)
                if len(centers) > 1:
                    chosen = order[a:b][centers]
                    order[a:b] = order[a:b][np.argsort(which, kind="stable")]
                    limits = a + np.concatenate([[0], np.cumsum(np.bincount(which))])
                    below += [(int(s), int(e), at, int(c)) for s, e, c in zip(limits, limits[1:], chosen)]
                    continue
            leaves.append(at)
        level = below
    begins, ends, parents, centers, angles = (np.array(x) for x in zip(*nodes))
    return Tree(
        vectors[order], labels[order], ids[order], vectors[centers], angles, begins, ends, parents, np.array(leaves)
    )


class Wanted(NamedTuple):
    """Anchors searched together: vectors, labels, ids, and per window the lowest and highest score and the threshold."""

    vectors: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray


def _bounds(tree_centers: np.ndarray, tree_angles: np.ndarray, w: Wanted, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score that each node's rows can have, by anchor and node."""
    norms = np.sqrt((w.vectors.astype(float) ** 2).sum(1))[:, None]
    angle = _angles(w.vectors.astype(float) @ tree_centers.astype(float).T, norms, largest)
    scale, slack = norms * largest, SLACK * norms * largest + 0.5
    highest = scale * np.cos(np.maximum(0.0, angle - tree_angles)) + slack
    lowest = scale * np.cos(np.minimum(np.pi, angle + tree_angles)) - slack
    return lowest, highest


def _open(lowest: np.ndarray, highest: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which nodes can hold a row within a window of their anchor and at its threshold or above."""
    found = np.zeros(lowest.shape, bool)
    for k in range(low.shape[1]):
        found |= (highest >= np.maximum(low[:, k], least[:, k])[:, None]) & (lowest <= high[:, k][:, None])
    return found


def _kind(*vectors: np.ndarray) -> type:
    """A type that holds all inner products of these vectors exactly."""
    sizes = [float(np.abs(v).max(initial=0)) for v in vectors]
    total = max(v.shape[1] for v in vectors) * sizes[0] * sizes[-1]
    return np.float32 if total < 2**24 else np.float64 if total < 2**53 else object


def _products(a: np.ndarray, b: np.ndarray, kind: type) -> np.ndarray:
    found = a.astype(kind) @ b.astype(kind).T
    if kind is object and found.size and max(abs(int(found.max())), abs(int(found.min()))) >= 1 << 62:
        raise ValueError("scores of more than 62 bits")
    return found.astype(np.int64)


class _Found:
    """The best rows of each anchor and window so far."""

    def __init__(self, w: Wanted, k: int) -> None:
        self.k, self.windows = k, w.low.shape[1]
        self.least = w.least.copy()
        none = np.zeros(0, np.int64)
        self.best = [none, none, none]

    def add(self, anchor: np.ndarray, window: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        """Keep the first ``k`` of each anchor and window by score, equal ones by id; raise full windows' thresholds."""
        group, score, row_id = (
            np.concatenate([old, new]) for old, new in zip(self.best, (anchor * self.windows + window, score, row_id))
        )
        order = np.lexsort((row_id, -score, group))
        group, score, row_id = group[order], score[order], row_id[order]
        first = np.searchsorted(group, group)
        keep = np.arange(group.size) - first < self.k
        last = np.arange(group.size) - first == self.k - 1
        flat = self.least.reshape(-1)
        flat[group[last]] = np.maximum(flat[group[last]], score[last])
        self.best = [group[keep], score[keep], row_id[keep]]


def search_tree(tree: Tree, w: Wanted, k: int, same: bool, largest: float) -> tuple[np.ndarray, ...]:
    """Per anchor and window the first ``k`` rows: arrays of anchor (its place), window, score, row id.

    Rows have the anchor's label if ``same``, and are never the anchor itself, else another label.
    """
    lowest, highest = _bounds(tree.centers, tree.angles, w, largest)
    can = _open(lowest, highest, w.low, w.high, w.least)
    # Level by level: a node counts only below open ones, and its bounds are no wider than theirs.
    for node in range(1, tree.parents.size):
        can[:, node] &= can[:, tree.parents[node]]
    open_leaves, best = can[:, tree.leaves], highest[:, tree.leaves]
    found, kind = _Found(w, k), _kind(w.vectors, tree.vectors)

    def read(pairs: np.ndarray) -> None:
        made: list[list[np.ndarray]] = [[], [], [], []]
        for leaf in np.flatnonzero(pairs.any(0)):
            who = np.flatnonzero(pairs[:, leaf])
            a, b = tree.begins[tree.leaves[leaf]], tree.ends[tree.leaves[leaf]]
            scores = _products(w.vectors[who], tree.vectors[a:b], kind)
            fits = (tree.labels[a:b] == w.labels[who][:, None]) == same
            if same:
                fits &= tree.ids[a:b] != w.ids[who][:, None]
            for j in range(w.low.shape[1]):
                least = np.maximum(w.low[who, j], found.least[who, j])[:, None]
                x, y = np.nonzero(fits & (scores >= least) & (scores <= w.high[who, j][:, None]))
                for column, values in zip(made, (who[x], np.full(x.size, j), scores[x, y], tree.ids[a:b][y])):
                    column.append(values)
        if made[0]:
            found.add(*(np.concatenate(column) for column in made))

    # The best leaves of each anchor first, then all others that are still open.
    first = np.zeros(open_leaves.shape, bool)
    order = np.argsort(np.where(open_leaves, -best, np.inf), axis=1, kind="stable")[:, :FIRST_LEAVES]
    np.put_along_axis(first, order, True, 1)
    read(first & open_leaves)
    still = _open(lowest[:, tree.leaves], best, w.low, w.high, found.least)
    read(open_leaves & ~first & still)
    group, score, row_id = found.best
    return group // found.windows, group % found.windows, score, row_id


# Packed forms.  A vector is BINARY of little-endian 16-bit numbers where all fit, else of 64-bit ones.


def _pack(vectors: np.ndarray, kind: str) -> list[bytes]:
    return [v.tobytes() for v in np.ascontiguousarray(vectors, kind)]


def _unpack(column: pa.Array, kind: str, size: int) -> np.ndarray:
    return text_bytes(column)[0].view(kind).astype(np.int64).reshape(len(column), size)


def _tree_bytes(tree: Tree, kind: str) -> bytes:
    head = np.array([len(tree.ids), len(tree.begins), len(tree.leaves)], "<i8")
    parts = [head, tree.ids.astype("<i8"), tree.labels.astype("<i8")]
    parts += [x.astype("<i8") for x in (tree.begins, tree.ends, tree.parents, tree.leaves)]
    parts += [tree.angles.astype("<f8"), tree.centers.astype(kind), tree.vectors.astype(kind)]
    return b"".join(x.tobytes() for x in parts)


def _tree(data: bytes, kind: str, size: int) -> Tree:
    at = 0

    def take(count: int, dtype: str) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, dtype, count, at)
        at += found.nbytes
        return found

    rows, nodes, leaves = (int(x) for x in take(3, "<i8"))
    ids, labels = take(rows, "<i8"), take(rows, "<i8")
    begins, ends, parents = (take(nodes, "<i8") for _ in range(3))
    leaves, angles = take(leaves, "<i8"), take(nodes, "<f8")
    centers = take(nodes * size, kind).reshape(nodes, size)
    vectors = take(rows * size, kind).reshape(rows, size)
    return Tree(vectors, labels, ids, centers, angles, begins, ends, parents, leaves)


class Space(NamedTuple):
    """What all rows have in common: components, their packed type, the largest norm, and cells with their radii."""

    size: int
    kind: str
    largest: float
    centers: np.ndarray
    angles: np.ndarray
    shards: np.ndarray


def _prepared(rows: DataFrame, scale: int) -> tuple[DataFrame, int, str, float]:
    """``vec_id, label, v`` of the rows that take part, staged with packed vectors; components, type, largest norm."""
    whole = stage(
        rows.select(
            F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
            whole_numbers("vector", scale).alias("q"),
        ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL")
        .groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("first")).select("vec_id", "first.*")
    )
    norm = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    most = F.array_max(F.transform("q", lambda x: F.abs(x)))
    size, largest, biggest = whole.agg(F.max(F.size("q")), F.max(norm), F.max(most)).first()
    size, largest = int(size or 0), float(np.sqrt(largest or 0.0)) * (1 + 1e-12)
    kind = "<i2" if (biggest or 0) < 1 << 15 else "<i8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = batch.column(2)
            lengths = q.value_lengths().to_numpy(zero_copy_only=False)
            vectors = np.zeros((len(q), size), np.int64)
            vectors[np.arange(size) < lengths[:, None]] = q.flatten().to_numpy()
            packed = pa.array(_pack(vectors, kind), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["vec_id", "label", "v"])

    return stage(whole.mapInArrow(run, "vec_id BIGINT, label BIGINT, v BINARY")), size, kind, largest


def _nearest(vectors: np.ndarray, centers: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """The center at the smallest angle to each augmented vector, and that angle."""
    a, b = vectors.astype(float), centers.astype(float)
    height = [np.sqrt(np.maximum(0.0, largest**2 - (x**2).sum(1))) for x in (a, b)]
    products = a @ b.T + np.outer(*height)
    cell = products.argmax(1)
    return cell, _angles(products[np.arange(cell.size), cell], largest, largest)


def _index(points: DataFrame, size: int, kind: str, largest: float, cells: int | None) -> tuple[DataFrame, Space]:
    """Trees over all rows as ``shard, cell, tree`` (staged), and the cells' centers and radii.

    Cells are formed around a sample of rows: at most ``CELLS``, those of smallest hash; every row is in a tree.
    """
    spark = points.sparkSession
    count = points.count()
    wanted = max(partitions(spark), -(-count * max(1, size) * np.dtype(kind).itemsize // SHARD_BYTES))
    wanted = min(cells or CELLS, wanted)
    sample = points.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(wanted).collect()
    centers = _unpack(pa.array([bytes(r.v) for r in sample], pa.binary()), kind, size)
    shared = spark.sparkContext.broadcast((centers, largest))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, most = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                cell, angle = _nearest(_unpack(part.column(2), kind, size), known, most)
                columns = [*part.columns, pa.array(cell, pa.int32()), pa.array(angle)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "v", "cell", "angle"])

    dealt = stage(points.mapInArrow(deal, "vec_id BIGINT, label BIGINT, v BINARY, cell INT, angle DOUBLE"))
    # One row a cell, at most CELLS.
    radii, shards = np.zeros(len(centers)), np.ones(len(centers), np.int64)
    per_shard = max(1, SHARD_BYTES // (max(1, size) * np.dtype(kind).itemsize))
    for row in dealt.groupBy("cell").agg(F.max("angle").alias("angle"), F.count("*").alias("n")).collect():
        radii[row.cell], shards[row.cell] = row.angle, -(-row.n // per_shard)
    space = Space(size, kind, largest, centers, radii + 1e-9, shards)
    counts = F.array(*[F.lit(int(n)) for n in shards]) if len(shards) else F.array(F.lit(1))
    spot = F.pmod(F.xxhash64("vec_id"), F.get(counts, F.col("cell"))).cast("int")

    def grow(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        columns = {n: table.column(n).combine_chunks() for n in ("vec_id", "label", "v")}
        vectors = _unpack(columns["v"], kind, size)
        tree = build_tree(vectors, columns["label"].to_numpy(), columns["vec_id"].to_numpy(), largest)
        keys = {n: table.column(n).slice(0, 1).to_pylist() for n in ("cell", "shard")}
        return pa.table({**{n: pa.array(v, pa.int32()) for n, v in keys.items()}, "tree": [_tree_bytes(tree, kind)]})

    trees = dealt.withColumn("shard", spot).select("cell", "shard", "vec_id", "label", "v").groupBy("cell", "shard")
    return stage(trees.applyInArrow(grow, "cell INT, shard INT, tree BINARY")), space


def _hundredth(value: Column) -> Column:
    """``floor(value / 100)`` as a BIGINT, of a DECIMAL."""
    return F.call_function("div", value - F.pmod(value, F.lit(100)), F.lit(100))


# An anchor with its windows, each with the score of its k-th row so far where it has that many.
ANCHOR = "anchor BIGINT, label BIGINT, v BINARY, low ARRAY<BIGINT>, high ARRAY<BIGINT>, least ARRAY<BIGINT>"
_NAMES = ["anchor", "label", "v", "low", "high", "least"]


def _wanted(part: pa.RecordBatch, s: Space) -> Wanted:
    """Anchors of one batch; all have the same number of windows, shorter lists are filled with windows that hold nothing."""
    low, high, least = (part.column(k) for k in (3, 4, 5))
    lengths = low.value_lengths().to_numpy(zero_copy_only=False)
    full = np.arange(int(lengths.max(initial=0))) < lengths[:, None]
    windows = []
    for column, empty in ((low, -NONE), (high, NONE), (least, -NONE)):
        values = np.full(full.shape, empty, np.int64)
        values[full] = column.flatten().to_numpy()
        windows.append(values)
    vectors = _unpack(part.column(2), s.kind, s.size)
    return Wanted(vectors, part.column(1).to_numpy(), part.column(0).to_numpy(), *windows)


def _routed(anchors: DataFrame, shared, wave: int) -> DataFrame:
    """Anchors once for each tree of each cell that is open to them, with ``cell, shard, near``.

    Wave 0 takes the square root of the number of cells, the nearest ones, wave 1 the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Space = shared.value
        first = int(np.ceil(np.sqrt(len(s.centers))))
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                w = _wanted(part, s)
                lowest, highest = _bounds(s.centers, s.angles, w, s.largest)
                can = _open(lowest, highest, w.low, w.high, w.least)
                order = np.argsort(np.argsort(-highest, axis=1, kind="stable"), axis=1)
                can &= (order < first) == (wave == 0)
                who, cell = np.nonzero(can)
                copies = s.shards[cell]
                who, cell = np.repeat(who, copies), np.repeat(cell, copies)
                shard = np.arange(who.size) - np.repeat(np.cumsum(copies) - copies, copies)
                for a in range(0, who.size, 4 * TOGETHER):
                    rows = part.take(pa.array(who[a : a + 4 * TOGETHER]))
                    extra = [pa.array(x[a : a + 4 * TOGETHER], pa.int32()) for x in (cell, shard)]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *extra], names=[*_NAMES, "cell", "shard"])

    return anchors.select(*_NAMES).mapInArrow(run, f"{ANCHOR}, cell INT, shard INT")


FOUND = "anchor BIGINT, slot INT, score BIGINT, vec_id BIGINT"


def _visited(routed: DataFrame, trees: DataFrame, shared, k: int, same: bool) -> DataFrame:
    """What each anchor finds in each tree it is sent to.

    A task gets its trees one after the other, each before its anchors, which stream past it.
    """
    blank = {"label": "bigint", "v": "binary", **{n: "array<bigint>" for n in ("low", "high", "least")}}
    first = trees.select(
        "cell", "shard", F.lit(None).cast("bigint").alias("anchor"),
        *[F.lit(None).cast(t).alias(n) for n, t in blank.items()], "tree",
    )
    second = routed.select("cell", "shard", *_NAMES, F.lit(None).cast("binary").alias("tree"))
    rows = first.unionAll(second)
    tasks = partitions(trees.sparkSession)
    sorted_rows = rows.repartition(tasks, "cell", "shard").sortWithinPartitions("cell", "shard", F.col("tree").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Space = shared.value
        tree = spot = None
        for batch in batches:
            is_tree = batch.column("tree").is_valid().to_numpy(zero_copy_only=False)
            spots = [batch.column(n).to_numpy() for n in ("cell", "shard")]
            new = np.ones(batch.num_rows, bool)
            new[1:] = is_tree[1:] | is_tree[:-1] | (spots[0][1:] != spots[0][:-1]) | (spots[1][1:] != spots[1][:-1])
            limits = np.append(np.flatnonzero(new), batch.num_rows).tolist()
            for a, b in zip(limits, limits[1:]):
                if is_tree[a]:
                    tree, spot = _tree(batch.column("tree")[a].as_py(), s.kind, s.size), (spots[0][a], spots[1][a])
                    continue
                if spot != (spots[0][a], spots[1][a]):
                    # No row fell into this shard.
                    continue
                for at in range(a, b, TOGETHER):
                    part = batch.slice(at, min(TOGETHER, b - at)).select(_NAMES)
                    w = _wanted(part, s)
                    who, slot, score, row_id = search_tree(tree, w, k, same, s.largest)
                    columns = [pa.array(w.ids[who]), pa.array(slot, pa.int32()), pa.array(score), pa.array(row_id)]
                    yield pa.RecordBatch.from_arrays(columns, names=["anchor", "slot", "score", "vec_id"])

    return sorted_rows.mapInArrow(run, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(anchors: DataFrame, trees: DataFrame, shared, k: int, same: bool) -> DataFrame:
    """``anchor, slot, rank, score, vec_id``: the first ``k`` rows in each window of each anchor, staged."""
    # Thresholds of the second wave: the score of the k-th row of each window that has as many.
    near = stage(_first(_visited(_routed(anchors, shared, 0), trees, shared, k, same), k))
    full = F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("reached")
    reached = near.filter(F.col("rank") == k).groupBy("anchor").agg(full)
    plain = [c for c in _NAMES if c != "least"]
    least = F.transform("low", lambda x, i: F.coalesce(F.try_element_at("reached", i), F.lit(NONE)))
    narrowed = anchors.select(*plain).join(reached, "anchor", "left").select(*plain, least.alias("least"))
    far = _visited(_routed(narrowed, shared, 1), trees, shared, k, same)
    return stage(_first(near.select("anchor", "slot", "score", "vec_id").unionAll(far), k))


def mine(
    rows: DataFrame,
    anchors: Column,
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    cells: int | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchors`` holds.

    Scores are inner products of ``floor(scale * x)``; higher ones come first,
    equal ones by smaller ``vec_id``.  An anchor's positives are its first
    ``positives`` other rows of its label; for each, the first ``negatives`` rows
    of another label are returned whose score is from ``low`` to ``high`` percent
    of the positive's.  No such row, no result row.

    ``rows`` has ``vec_id``, ``label`` and ``vector``, other columns are not read.  Rows with
    a null in one of them or a null or infinite component or NaN take no part; shorter
    vectors count as filled with zeros; of rows with one id, that of the smallest
    label and vector takes part.  ``anchors`` is a condition on ``vec_id`` and
    ``label``.  An empty table gives no rows.  Runs jobs when called.
    """
    spark = rows.sparkSession
    small_batches(spark)
    points, size, kind, largest = _prepared(rows.select("vec_id", "label", F.col(vector).alias("vector")), scale)
    # Of rows that agree in vector and label only the first can be among the results of any anchor.
    alike = Window.partitionBy("v", "label").orderBy("vec_id")
    first = points.withColumn("place", F.row_number().over(alike))
    kept = stage(first.filter(F.col("place") <= max(positives + 1, negatives)).drop("place"))
    trees, space = _index(kept, size, kind, largest, cells)
    shared = spark.sparkContext.broadcast(space)
    one = {"low": NONE, "high": -NONE, "least": NONE}
    chosen = stage(
        points.filter(anchors).select(
            F.col("vec_id").alias("anchor"), "label", "v", *[F.array(F.lit(x)).alias(n) for n, x in one.items()]
        )
    )
    near = _search(chosen, trees, shared, positives, True)
    # Slots of the windows are the ranks of the positives.
    in_order = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score")))
    by_anchor = near.groupBy("anchor").agg(in_order.alias("p"))
    windowed = chosen.join(by_anchor, "anchor").select(
        *["anchor", "label", "v"],
        F.transform("p", lambda p: -_hundredth(p["score"].cast("decimal(20,0)") * F.lit(-low))).alias("low"),
        F.transform("p", lambda p: _hundredth(p["score"].cast("decimal(20,0)") * F.lit(high))).alias("high"),
        F.transform("p", lambda p: F.lit(NONE)).alias("least"),
    )
    found = _search(stage(windowed), trees, shared, negatives, False)
    pairs = near.select(
        "anchor",
        (F.col("rank") - 1).alias("slot"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return found.join(pairs, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def digest(rows: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth row, with every seventh label changed first."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    given = rows.select("vec_id", changed.alias("label"), "embedding")
    return mine(given, F.col("vec_id") % 100 == 0)
