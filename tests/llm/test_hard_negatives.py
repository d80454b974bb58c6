import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.llm import hard_negatives as h

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def brute(rows, every=1, positives=5, negatives=10, low=30, high=90, scale=256):
    """The contract, pair by pair, in whole numbers."""
    points = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        own = (label, [int(np.floor(scale * float(np.float32(x)))) for x in v])
        points[i] = min(points.get(i, own), own)
    size = max((len(v) for _, v in points.values()), default=0)
    points = {i: (label, v + [0] * (size - len(v))) for i, (label, v) in points.items()}
    out = []
    for a, (label, v) in points.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in points.items() if i != a)
        for p, pos, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(a, pos, rank + 1, i, -p, -s) for rank, (s, i, _) in enumerate(fits)]
    return sorted(out)


def vectors(seed, n, dims=8, labels=4, clusters=6):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, dims))
    own = centers[rng.integers(0, clusters, n)] + 0.4 * rng.normal(size=(n, dims))
    own /= np.linalg.norm(own, axis=1)[:, None] * rng.uniform(0.5, 2, n)[:, None]
    return [(i, v.astype(np.float32).tolist(), int(rng.integers(0, labels))) for i, v in enumerate(own)]


def mined(spark, rows, every=1, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in h.mine(df, F.col("vec_id") % every == 0, **more).collect())


@pytest.mark.parametrize("cells", [1, 3, 40])
def test_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(h, "SHARD_BYTES", 2000)
    monkeypatch.setattr(h, "LEAF", 4)
    rows = vectors(cells, 700)
    expected = brute(rows, 7)
    assert len(expected) > 500 and mined(spark, rows, 7, cells=cells) == expected


def test_copies_ties_and_odd_rows(spark):
    rows = vectors(5, 60, dims=3)
    same = [0.5, 0.25, -0.125]
    rows += [(1000 + i, same, i % 3) for i in range(90)]
    rows += [(7, rows[7][1], rows[7][2])] * 2 + [(8, [9.0, 9.0, 9.0], -1)]
    rows += [(2001, None, 1), (2002, [1.0, None, 0.0], 1), (2003, [float("nan"), 0.0, 0.0], 1), (2004, [float("inf"), 0.0, 0.0], 2)]
    rows += [(2005, [0.1, 0.2, 0.3], None), (None, [0.1, 0.2, 0.3], 1), (2006, [], 1), (2007, [1.0], 2), (2008, [0.0, 0.0, 0.0], 0)]
    assert mined(spark, rows) == brute(rows)


def test_large_components_and_other_settings(spark):
    rows = [(i, [x * 1e6 for x in v], label) for i, v, label in vectors(9, 80)]
    settings = {"positives": 2, "negatives": 3, "low": -50, "high": 100}
    assert mined(spark, rows, 2, **settings) == brute(rows, 2, **settings)


def test_empty_table_and_other_columns(spark):
    assert mined(spark, []) == []
    rows = vectors(2, 40)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "2 AS cell", "3 AS anchor", "'x' AS tree")
    changed = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert sorted(tuple(r) for r in h.digest(df).collect()) == brute(changed, 100)


def test_nodes_bound_the_scores_of_their_rows():
    rng = np.random.default_rng(3)
    points = rng.integers(-50, 50, (500, 6))
    largest = float(np.sqrt((points**2).sum(1).max()))
    tree = h.build_tree(points, np.zeros(500, np.int64), np.arange(500), largest, leaf=8)
    assert sorted(tree.ids.tolist()) == list(range(500)) and len(tree.leaves) > 20
    wide = np.full((20, 1), -h.NONE)
    w = h.Wanted(rng.integers(-80, 80, (20, 6)), np.zeros(20), np.arange(20), -wide, wide, -wide)
    lowest, highest = h._bounds(tree.centers, tree.angles, w, largest)
    for node, (a, b) in enumerate(zip(tree.begins, tree.ends)):
        scores = w.vectors @ tree.vectors[a:b].T
        assert (scores >= lowest[:, [node]]).all() and (scores <= highest[:, [node]]).all()


def test_far_leaves_are_not_read(monkeypatch):
    """Well separated clusters: most rows are never scored."""
    rng = np.random.default_rng(1)
    directions = np.eye(16)[rng.integers(0, 16, 4000)] + 0.02 * rng.normal(size=(4000, 16))
    points = np.floor(256 * directions / np.linalg.norm(directions, axis=1)[:, None]).astype(np.int64)
    largest = float(np.sqrt((points**2).sum(1).max()))
    tree = h.build_tree(points, np.arange(4000) % 2, np.arange(4000), largest)
    read, plain = [], h._products
    monkeypatch.setattr(h, "_products", lambda a, b, kind: read.append(len(a) * len(b)) or plain(a, b, kind))
    wide = np.full((50, 1), -h.NONE)
    w = h.Wanted(points[:50], np.zeros(50), np.arange(50), -wide, wide, -wide)
    who, _, score, ids = h.search_tree(tree, w, 5, True, largest)
    for k in range(50):
        own = sorted((-int(s), i) for i, s in enumerate(points @ points[k]) if i % 2 == 0 and i != k)[:5]
        assert list(zip((-score[who == k]).tolist(), ids[who == k].tolist())) == own
    assert sum(read) < 0.3 * 50 * 4000
