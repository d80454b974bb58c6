"""Equi-joins that split hot groups into a grid of bounded cells.

A group with ``l`` left and ``r`` right rows makes ``l * r`` rows out of one
shuffle partition.  A group is hot when it reads and makes more rows than an
average task does, and more than the limit; so there are never more hot groups
than tasks, and their list can always be broadcast, before any shuffle by their
key.  A hot group becomes a grid of ``rows x cols`` cells of an average task's
rows: a left row is placed in one grid row and copied along it, a right row
likewise along its column, so every (left, right) combination meets in exactly
one cell.  Nothing is dropped, and the split changes the plan only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.plans.staging import stage

# Rows that a group may read and make in one cell whatever the average.
GROUP_LIMIT = 1_000_000


def partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def average(spark: SparkSession, total: int) -> int:
    """Rows of an average task."""
    return total // partitions(spark)


def by_key(df: DataFrame, on: list[str]) -> DataFrame:
    """Hash-partitioned on ``on`` into as many partitions as the session has for shuffles.

    For joins that make far more rows than they read: Spark would merge small
    input partitions, and with them the tasks that make the rows.
    """
    return df.repartition(partitions(df.sparkSession), *on)


def _work() -> Column:
    """Rows a group reads and makes, as a double: products of counts may pass 64 bits."""
    left, right = F.col("l").cast("double"), F.col("r").cast("double")
    return left * right + left + right


def _hot(sizes: DataFrame, limit: int) -> tuple[DataFrame | None, float, int]:
    """The groups of ``sizes`` (with ``l``, ``r``) that need splitting, staged, or None; the rows of a cell; those of all."""
    total, most = sizes.agg(F.sum(_work()), F.max(_work())).first()
    total = int(total or 0)
    budget = max(float(limit), float(average(sizes.sparkSession, total)))
    if most is None or most <= budget:
        return None, budget, total
    return stage(sizes.filter(_work() > budget)), budget, total


def group_work(rows: DataFrame, on: list[str], limit: int) -> tuple[DataFrame | None, int]:
    """``hot_groups``, and the rows that all groups read and make when each is paired with itself."""
    sizes = rows.groupBy(*on).agg(F.count("*").alias("l")).withColumn("r", F.col("l"))
    found, _, total = _hot(sizes, limit)
    return None if found is None else F.broadcast(found.select(*on, F.col("l").alias("_n"))), total


def hot_groups(rows: DataFrame, on: list[str], limit: int) -> DataFrame | None:
    """Groups of ``on`` too large to be paired within one task, as ``on..., _n``, or None.

    At most as many as there are tasks, with a hint to broadcast them.  Runs a counting job.
    """
    return group_work(rows, on, limit)[0]


def large_groups(rows: DataFrame, on: list[str], limit: int) -> DataFrame | None:
    """Groups of ``on`` with more rows than ``limit`` and an average task, as ``on..., _n``, or None.

    Fewer than there are tasks, with a hint to broadcast them.  Runs a counting job.
    """
    sizes = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    total, most = sizes.agg(F.sum("_n"), F.max("_n")).first()
    budget = max(limit, average(rows.sparkSession, total or 0))
    if most is None or most <= budget:
        return None
    return F.broadcast(stage(sizes.filter(F.col("_n") > budget)))


def hot_cells(sizes: DataFrame, on: list[str], limit: int) -> DataFrame | None:
    """Groups to be split as ``on..., _rows, _cols``, or None; runs a counting job.

    ``sizes`` has ``on..., l, r``, the rows of each group per side.
    """
    hot, budget, _ = _hot(sizes, limit)
    if hot is None:
        return None
    side = max(1.0, budget**0.5 - 1)
    left, right = F.col("l"), F.col("r")
    # A short side is not cut, so the other is cut into pieces whose rows and products fill a cell.
    rows = F.when(right <= side, F.ceil(_work() / budget)).when(left <= side, 1).otherwise(F.ceil(left / side))
    cols = F.when(right <= side, 1).when(left <= side, F.ceil(_work() / budget)).otherwise(F.ceil(right / side))
    cells = hot.select(*on, F.least(rows, left).alias("_rows"), F.least(cols, right).alias("_cols"))
    return F.broadcast(cells.withColumns({c: F.greatest(c, F.lit(1)).cast("bigint") for c in ("_rows", "_cols")}))


def grid_join(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame | None) -> DataFrame:
    """Inner join with the groups of ``hot`` split into cells."""
    if hot is None:
        return left.join(right, on)

    def place(side: DataFrame, own: str, own_size: str, other: str, other_size: str) -> DataFrame:
        payload = [F.col(c) for c in side.columns if c not in on]
        spot = F.pmod(F.xxhash64(*payload), F.coalesce(F.col(own_size), F.lit(1)))
        copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other_size), F.lit(1)) - 1)
        return side.join(hot, on, "left").select(*side.columns, spot.alias(own), F.explode(copies).alias(other))

    cell = [*on, "_row", "_col"]
    placed_left = by_key(place(left, "_row", "_rows", "_col", "_cols"), cell)
    placed_right = by_key(place(right, "_col", "_cols", "_row", "_rows"), cell)
    return placed_left.join(placed_right, cell).drop("_row", "_col")


def split_join(left: DataFrame, right: DataFrame, on: list[str], limit: int = GROUP_LIMIT) -> DataFrame:
    """Inner join on ``on`` with hot groups of either side split.

    Other column names of the two sides must differ.  Runs one counting job.
    """
    tagged = left.select(*on, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(*on, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    sizes = tagged.groupBy(*on).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return grid_join(left, right, on, hot_cells(sizes.filter("l > 0 and r > 0"), on, limit))


def lookup_join(
    left: DataFrame, right: DataFrame, on: list[str], limit: int = GROUP_LIMIT, counted: DataFrame | None = None
) -> DataFrame:
    """``split_join`` for a right side with one row per ``on``; only the left side is counted.

    ``counted`` is a frame with the same ``on`` values as ``left`` that is cheaper to read.
    """
    rows = left if counted is None else counted
    sizes = rows.groupBy(*on).agg(F.count("*").alias("l"), F.lit(1).cast("bigint").alias("r"))
    return grid_join(left, right, on, hot_cells(sizes, on, limit))


def pair_join(
    rows: DataFrame,
    on: list[str],
    id_column: str = "id",
    payload: dict[str, tuple[str, str]] | None = None,
    limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """Ordered pairs ``id1 < id2`` of rows that agree on ``on``.

    ``payload`` maps a column to its names on the first and second side; ``on``
    is kept in the output.  Hot groups are split, which takes one counting job;
    ``limit=None`` skips it where the groups are known to be within bounds.
    """
    payload = payload or {}
    rows = rows.select(*on, id_column, *payload)
    hot = None
    if limit is not None:
        sizes = rows.groupBy(*on).agg(F.count("*").alias("l")).withColumn("r", F.col("l"))
        hot = hot_cells(sizes, on, limit)
    if hot is None:
        # Both sides read one shuffle.
        rows = by_key(rows, on)
    left, right = (
        rows.select(*on, F.col(id_column).alias(f"id{s + 1}"), *[F.col(c).alias(n[s]) for c, n in payload.items()])
        for s in (0, 1)
    )
    return grid_join(left, right, on, hot).filter("id1 < id2")


def every_pair(rows: DataFrame, block_rows: int) -> DataFrame:
    """Every two rows once: ``s1, s2`` (their ``id``, in either order) and the other columns with ``_1`` and ``_2``.

    Rows are dealt into blocks of ``block_rows`` or more, and every two blocks are
    a cell.  No block is sent to more cells than the root of twice the tasks,
    so rows moved grow with the rows.  Give staged rows; runs a counting job.
    """
    most = math.ceil((2 * partitions(rows.sparkSession)) ** 0.5)
    blocks = max(1, min(most, -(-rows.count() // block_rows)))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))

    def side(number: int, ends: tuple[Column, Column]) -> DataFrame:
        columns = [F.col(c).alias(f"{c}_{number}") for c in rows.columns if c != "id"]
        at = rows.withColumn("block", block).withColumn("other", F.explode(numbers))
        at = at.filter(ends[0] <= ends[1]).select(ends[0].alias("p"), ends[1].alias("q"), F.col("id").alias(f"s{number}"), *columns)
        return by_key(at, ["p", "q"])

    one = side(1, (F.col("block"), F.col("other")))
    two = side(2, (F.col("other"), F.col("block"))).hint("shuffle_hash")
    # Every pair of a cell of two blocks once, of a cell of one block in one order.
    wanted = (F.col("p") < F.col("q")) | (F.col("s1") < F.col("s2"))
    return one.join(two, ["p", "q"]).filter(wanted).drop("p", "q")
