import random
import re

import numpy as np
import pytest

from affinis.llm import jaccard as j
from affinis.llm.components import components

from .data import WORDS, by_id, frame, passage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return sorted(((i, len(sets[x]), least.get(find(x))) for x, (i, _) in enumerate(rows)), key=str)


def edited(text, rng, share):
    return " ".join(w if rng.random() > share else rng.choice(WORDS) + str(rng.randrange(10**6)) for w in text.split())


def cases():
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one Two"), (5, "ONE two"), (6, "a b c d e"), (7, "a b c d e f")]
    hot = passage(77, 60)
    for size in (5, 8, 13, 20, 47, 90, 200, 450, 1000):
        for group in range(4):
            base = passage(size * 10 + group, size)
            for k in range(6):
                rows.append((10_000 - len(rows), edited(base, rng, rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05]))))
            rows.append((10_000 - len(rows), base + " " + passage(rng.random(), size // 6 + 1)))
            rows.append((10_000 - len(rows), hot + " " + base))
    rows += [(20_000 + k, hot + " " + passage(900 + k, rng.choice([3, 10, 15, 60, 240]))) for k in range(60)]
    rows += [(30_000 + k, edited(passage(3, 300), rng, 0.01)) for k in range(60)]
    rows += [(40_000 + k % 3, "copies " * 7) for k in range(50)]
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("share", [0.002, 0.02, 2])
def test_equals_brute_force(spark, monkeypatch, share):
    """Few or many frequent shingles change the plan, not the components."""
    monkeypatch.setattr(j, "FREQUENT_SHARE", share)
    rows = cases()
    assert found(j.linked_groups(frame(spark, rows).repartition(7))) == brute(rows)


def test_open_groups_in_cells_of_few_members(spark, monkeypatch):
    """Every two parts of an open group meet, and pairs are handed on a few at a time."""
    monkeypatch.setattr(j, "FREQUENT_SHARE", 2)
    monkeypatch.setattr(j, "HELD", 3)
    rows = cases()
    assert found(j.linked_groups(frame(spark, rows).repartition(3), part=5)) == brute(rows)


def test_cells_hold_every_two_members(spark):
    groups = spark.createDataFrame([(g, b"%d" % k, b"r") for g, n in ((1, 40), (2, 3)) for k in range(n)], "grp INT, sid BINARY, root BINARY")
    cells = {}
    for r in j._cells(groups, 8).collect():
        cells.setdefault((r.grp, r.x, r.y), []).append((bytes(r.sid), r.own))
    for g, n in ((1, 40), (2, 3)):
        met = [
            tuple(sorted((a, b)))
            for (grp, x, y), rows in cells.items() if grp == g
            for k, (a, p) in enumerate(rows) for b, q in rows[:k] if x == y or p != q
        ]
        assert len(met) == len(set(met)) == n * (n - 1) // 2
    assert len({x for g, x, _ in cells if g == 1}) == 5


def test_ids_beyond_the_broadcast_bound_are_joined(spark, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST_IDS", 0)
    rows = cases()[:120]
    assert found(j.linked_groups(frame(spark, rows))) == brute(rows)


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    none = np.zeros(0, np.uint64)
    for _ in range(3000):
        n = int(rng.integers(1, 80))
        whole = np.unique(rng.integers(0, 2**64, n, np.uint64))
        x = whole[rng.random(whole.size) > rng.choice([0, 0.05, 0.1])]
        y = whole[rng.random(whole.size) > rng.choice([0, 0.05, 0.1])]
        common = np.intersect1d(x, y).size
        if common and 100 * common >= 80 * (x.size + y.size - common):
            frequent = np.sort(rng.choice(whole, rng.integers(0, whole.size)))
            for left_out in (none, frequent):
                assert np.intersect1d(j.block_keys(x, left_out), j.block_keys(y, left_out)).size
            sketches = [np.frombuffer(j.bit_sketch(s), np.uint8) for s in (x, y)]
            size = min(s.size for s in sketches)
            distance = np.bitwise_count(j.fold(sketches[0], size) ^ j.fold(sketches[1], size)).sum()
            assert distance <= x.size + y.size - 2 * common <= (x.size + y.size) // 9


def test_null_ids_and_long_texts(spark):
    long = passage(1, 120_000)
    rows = [(None, "a b c"), (None, "a b c"), (7, "x"), (None, "X"), (9, long), (8, long + " end"), (3, "word" * 300_000), (3, "y")]
    assert found(j.linked_groups(frame(spark, rows))) == brute(rows)


def test_empty_table_and_other_columns(spark):
    assert j.linked_groups(frame(spark, [])).count() == 0
    docs = frame(spark, [(1, "a", "x", 3)], ", sid STRING, n INT")
    assert found(j.linked_groups(docs)) == [(1, 1, 1)]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    links += [(500, 500), (7, 6)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    df = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    assert sorted(map(tuple, components(df).collect())) == sorted((x, find(x)) for x in root)
    assert components(df.limit(0)).count() == 0


def test_half_of_a_sketch_leaves_no_near_pair_out():
    rng = np.random.default_rng(12)
    for n in (5, 80, 700):
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        y = np.concatenate([x[n // 6 :], rng.integers(0, 2**63, n // 9).astype(np.uint64)])
        whole = [np.frombuffer(j.bit_sketch(s), np.uint8) for s in (x, y)]
        size = min(w.size for w in whole)
        half = [j.fold(w, max(j.SHORT, w.size // 2)) for w in whole]
        least = min(h.size for h in half)
        near = [j._near(j.fold(a, k), j.fold(b, k), np.int64(x.size), np.int64(y.size)) for (a, b), k in ((whole, size), (half, least))]
        assert near[1][0] <= near[0][0] and (near[1][1] or not near[0][1])


def test_sketches_of_open_groups_are_half_as_long(spark, monkeypatch):
    described = []
    whole = j.stage
    monkeypatch.setattr(j, "stage", lambda df: described.append(whole(df)) or described[-1])
    j.linked_groups(frame(spark, [(k, passage(k, 300)) for k in range(3)]))
    assert all(len(r.half) == max(j.SHORT, len(r.sketch) // 2) for r in described[0].filter("n > 0").collect())
