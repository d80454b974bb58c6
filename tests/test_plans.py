import random
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from affinis.plans import pair_join, spread, split_join, stage
from affinis.plans.skew import hot_cells, lookup_join
from affinis.plans.staging import CLEANUP, shared_folder

from .conftest import tuples


@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_split_join_is_a_join(spark, limit):
    rng = random.Random(1)
    left = [(0 if rng.random() < 0.4 else rng.randint(1, 9), n) for n in range(120)] + [(0, 5), (None, 3)]
    right = [(0 if rng.random() < 0.4 else rng.randint(1, 12), n) for n in range(90)] + [(None, 4)]
    a = spark.createDataFrame(left, "k BIGINT, x BIGINT")
    b = spark.createDataFrame(right, "k BIGINT, y BIGINT")
    expected = sorted((k, x, y) for k, x in left for q, y in right if k == q and k is not None)
    assert tuples(split_join(a, b, ["k"], limit), "k", "x", "y") == expected


@pytest.mark.parametrize("limit", [1, 4, None])
def test_pair_join_gives_each_pair_once(spark, limit):
    rows = [(i % 3, i, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "k BIGINT, id BIGINT, v DOUBLE")
    expected = sorted((k, i, j, float(i), float(j)) for k, i, _ in rows for q, j, _ in rows if k == q and i < j)
    got = pair_join(df, ["k"], payload={"v": ("v1", "v2")}, limit=limit)
    assert tuples(got, "k", "id1", "id2", "v1", "v2") == expected


def test_lookup_join_splits_the_left_side(spark, small_tasks):
    left = spark.createDataFrame([(0, n) for n in range(40)] + [(1, 1)], "k BIGINT, x BIGINT")
    right = spark.createDataFrame([(0, 10), (1, 11), (2, 12)], "k BIGINT, y BIGINT")
    expected = sorted([(0, n, 10) for n in range(40)] + [(1, 1, 11)])
    assert tuples(lookup_join(left, right, ["k"], limit=3), "k", "x", "y") == expected


def test_stage_and_spread(spark):
    df = spark.range(100).coalesce(1)
    assert spread(df).rdd.getNumPartitions() == 4
    staged = stage(df.selectExpr("id", "id * 2 AS twice"))
    assert tuples(staged, "id", "twice") == [(n, 2 * n) for n in range(100)]
    assert spread(spark.range(0, 100, 1, 9)).rdd.getNumPartitions() == 9


def test_staging_removes_its_shuffle_files_and_keeps_the_setting(spark):
    def shuffles():
        return set(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split())

    before, own = shuffles(), spark.conf.get(CLEANUP)
    staged = stage(spark.range(0, 1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert spark.conf.get(CLEANUP) == own
    deadline = time.monotonic() + 20
    while [f for f in shuffles() - before if "shuffle_" in f] and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not [f for f in shuffles() - before if "shuffle_" in f]
    assert staged.count() == 7
    with pytest.raises(Exception, match="no good"):
        stage(spark.range(1).select(F.raise_error(F.lit("no good")).cast("int").alias("x")))
    assert spark.conf.get(CLEANUP) == own


def test_a_cluster_must_name_a_shared_folder():
    def session(configured, on_context=None):
        conf = SimpleNamespace(get=lambda name, default: configured)
        context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: on_context)
        return SimpleNamespace(conf=conf, sparkContext=context)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(None))
    assert shared_folder(session("hdfs:///checkpoints")) == "hdfs:///checkpoints"
    assert shared_folder(session(None, "hdfs:///set")) == "hdfs:///set"


@pytest.mark.parametrize("counts", [[(5, 5)] * 100, [(1, 1)] * 50 + [(300, 2)], [(40, 40), (900, 1), (1, 900), (3, 3)]])
def test_hot_groups_are_fewer_than_tasks_and_cells_bounded(spark, counts):
    """Whatever the counts, with no limit but the average."""
    rows = [(k, left, right) for k, (left, right) in enumerate(counts)]
    sizes = spark.createDataFrame(rows, "k BIGINT, l BIGINT, r BIGINT")
    cells = hot_cells(sizes, ["k"], 1)
    work = {k: left * right + left + right for k, left, right in rows}
    budget = max(1, sum(work.values()) // 4)
    hot = {} if cells is None else {c.k: c for c in cells.collect()}
    assert set(hot) == {k for k, w in work.items() if w > budget} and len(hot) <= 4
    for k, left, right in rows:
        if k in hot:
            a, b = -(-left // hot[k]["_rows"]), -(-right // hot[k]["_cols"])
            assert a * b + a + b <= 2 * budget + 4
