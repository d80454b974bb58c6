"""Pearson weights between users (or items) over what both rated."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.plans.skew import GROUP_LIMIT, by_key, group_work, pair_join, partitions, split_join
from affinis.plans.staging import stage

# Weights of rounding errors only, in centred sums.
TOLERANCE = 1e-12
# Fewer common ratings than this give no weight.
MIN_SUPPORT = 2
# Pair rows that one task adds up, few enough for its sums to stay in memory.
TASK_PAIRS = 1_000_000
# More tasks than this make too many shuffle blocks.
MOST_TASKS = 10_000

_SUMS = ["n", "sx", "sy", "sxy", "sxx", "syy"]
_MOMENTS = ["n", "mx", "my", "cxy", "cxx", "cyy"]


class Statistic(NamedTuple):
    """What is kept of the common ratings of a pair: ``of`` rows ``id1, id2, x, y``, and ``merged`` partial results."""

    of: Callable[[DataFrame], DataFrame]
    merged: Callable[[DataFrame], DataFrame]


def _terms(pairs: DataFrame) -> DataFrame:
    """``id1, id2`` and the summands of one common feature rated ``x`` and ``y``."""
    x, y = F.col("x"), F.col("y")
    return pairs.select(
        "id1",
        "id2",
        F.lit(1).cast("bigint").alias("n"),
        x.alias("sx"),
        y.alias("sy"),
        (x * y).alias("sxy"),
        (x * x).alias("sxx"),
        (y * y).alias("syy"),
    )


def _total(terms: DataFrame) -> DataFrame:
    return terms.groupBy("id1", "id2").agg(*[F.sum(c).alias(c) for c in _SUMS])


def _moments(pairs: DataFrame) -> DataFrame:
    """``id1, id2``, the number, the means and the centred sums of products of the common ratings.

    Spark's moment aggregates update and merge these by differences from
    running means, so nothing cancels however far ratings are from zero.
    """
    n = F.count("*")
    return pairs.groupBy("id1", "id2").agg(
        n.alias("n"),
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        (F.covar_pop("x", "y") * n).alias("cxy"),
        (F.var_pop("x") * n).alias("cxx"),
        (F.var_pop("y") * n).alias("cyy"),
    )


def _pooled(a: Column, b: Column) -> Column:
    """Moments of two groups of ratings together."""
    n = a["n"] + b["n"]
    dx, dy = b["mx"] - a["mx"], b["my"] - a["my"]
    part = b["n"] / n
    apart = a["n"] * part
    return F.struct(
        n.alias("n"),
        (a["mx"] + dx * part).alias("mx"),
        (a["my"] + dy * part).alias("my"),
        (a["cxy"] + b["cxy"] + dx * dy * apart).alias("cxy"),
        (a["cxx"] + b["cxx"] + dx * dx * apart).alias("cxx"),
        (a["cyy"] + b["cyy"] + dy * dy * apart).alias("cyy"),
    )


def _merged_moments(states: DataFrame) -> DataFrame:
    """Partial moments of each pair, of which there are few, put together two by two in a fixed order."""
    listed = F.array_sort(F.collect_list(F.struct(*_MOMENTS)))
    grouped = states.groupBy("id1", "id2").agg(listed.alias("parts"))
    rest = F.slice("parts", F.lit(2), F.size("parts"))
    return grouped.select("id1", "id2", F.aggregate(rest, F.get("parts", F.lit(0)), _pooled).alias("m")).select(
        "id1", "id2", "m.*"
    )


def _turned(columns: list[str]) -> list[Column]:
    """The columns of a ``Statistic`` with ``id1 < id2``, where the two sides may have come the other way round."""
    other = {"id1": "id2", "id2": "id1"}
    other |= {c: c.translate(str.maketrans("xy", "yx")) for c in columns if c not in ("sxy", "cxy", *other)}
    wrong = F.col("id1") > F.col("id2")
    return [F.when(wrong, F.col(other.get(c, c))).otherwise(F.col(c)).alias(c) for c in columns]


SUMS = Statistic(lambda pairs: _total(_terms(pairs)), _total)
MOMENTS = Statistic(_moments, _merged_moments)


def _rows(ratings: DataFrame, entity: str, feature: str) -> DataFrame:
    """``id, f, r`` of the ratings that have a value."""
    rows = ratings.select(F.col(entity).alias("id"), F.col(feature).alias("f"), F.col("rating").alias("r"))
    return rows.dropna()


class Coded(NamedTuple):
    """Ratings as short as they can be: ``rows`` of them, the ``arrays`` that a list of ids and ratings is moved as, and the
    id and rating in an entry of these."""

    rows: DataFrame
    arrays: dict[str, Callable[[Column], Column]]
    id: Callable[[Column], Column]
    r: Callable[[Column], Column]


def _short(rows: DataFrame) -> Coded:
    """``rows`` with ids as ints and ratings as floats where these hold every value.

    Ids of 24 bits and whole or half ratings of up to 127 make one int together; others are apart, as
    an array of structs takes several times the bytes of two arrays.
    """
    kinds = dict(rows.dtypes)
    ids, values = kinds["id"] == "bigint", kinds["r"] == "double"
    bound, most = 2**31 - 1, 2**24 - 1
    fits, packs = ([F.every(F.col("id").between(*b)) if ids else F.lit(False) for b in ((-bound, bound), (0, most))])
    twice = F.col("r") * 2
    exact = F.every(F.col("r").cast("float").cast("double") == F.col("r")) if values else F.lit(False)
    halves = F.every(twice.between(0, 254) & (F.floor(twice) == twice)) if values else F.lit(False)
    small, single, packed, coded = rows.agg(fits, exact, packs, halves).first()
    columns = {"id": F.col("id").cast("int")} if small else {}
    columns |= {"r": F.col("r").cast("float")} if single else {}
    rows = rows.withColumns(columns) if columns else rows
    if packed and coded:
        return Coded(
            rows,
            {"l": lambda e: F.shiftleft(e["id"], 8).bitwiseOR((e["r"] * 2).cast("int"))},
            lambda e: F.shiftrightunsigned(e, 8).cast(kinds["id"]),
            lambda e: e.bitwiseAND(F.lit(255)).cast(kinds["r"]) / 2,
        )
    return Coded(
        rows,
        {"l": lambda e: e["id"], "m": lambda e: e["r"]},
        lambda e: e["l"].cast(kinds["id"]),
        lambda e: e["m"].cast(kinds["r"]),
    )


def _packed_sums(rows: DataFrame, work: int, statistic: Statistic) -> DataFrame:
    """``statistic`` of all pairs in rows ``id, f, r`` whose groups of ``f`` fit in a task.

    A pair belongs to its side with fewer ratings.  Each feature sends every
    entity one row with the entities after it in that order, as an array, and
    their pairs are written out and added up behind that one shuffle; partial
    sums of pairs, which seldom meet twice in one task, are never moved.  So an
    entity that all have in common receives only those with as many ratings.
    """
    degrees = rows.groupBy("id").agg(F.count("*").cast("int").alias("d"))
    short = _short(rows)
    ranked = short.rows.join(degrees.withColumn("id", F.col("id").cast(dict(short.rows.dtypes)["id"])), "id")
    lists = by_key(ranked, ["f"]).groupBy("f").agg(F.array_sort(F.collect_list(F.struct("d", "id", "r"))).alias("l"))
    names = list(short.arrays)
    lists = lists.filter(F.size("l") > 1).select(*[F.transform("l", entry).alias(name) for name, entry in short.arrays.items()])
    entries = F.arrays_zip(*names) if len(names) > 1 else F.col("l")
    later = [F.slice(name, F.col("at") + 2, F.size(name)).alias(name) for name in names]
    packed = lists.select(*names, F.posexplode(entries).alias("at", "one")).filter(F.col("at") + 1 < F.size("l"))
    packed = packed.select(short.id(F.col("one")).alias("id1"), short.r(F.col("one")).alias("x"), *later)
    tasks = max(partitions(rows.sparkSession), min(work // 2 // TASK_PAIRS, MOST_TASKS))
    dealt = packed.repartition(tasks, "id1").select("id1", "x", F.explode(entries).alias("other"))
    pairs = dealt.select("id1", short.id(F.col("other")).alias("id2"), "x", short.r(F.col("other")).alias("y"))
    return statistic.of(pairs.filter("id1 <> id2"))


def co_rating_sums(
    ratings: DataFrame,
    entity: str,
    feature: str,
    min_support: int = MIN_SUPPORT,
    limit: int = GROUP_LIMIT,
    statistic: Statistic = SUMS,
) -> DataFrame:
    """``id1, id2, n`` and rating sums of all entity pairs with ``n >= min_support`` (at least 2).

    ``statistic`` says what is kept of the ratings: ``SUMS`` of products, or ``MOMENTS`` around the means.

    An inverted index on ``feature``, whose groups are paired where their pairs
    are added up (see ``_packed_sums``).  Ratings without a value count for nothing.
    Runs two counting jobs.
    Features whose pairs exceed ``limit`` and an average task are
    hot, and most pairs of their raters have nothing else in common.  So each
    entity leaves its most common hot feature out of the join: two entities
    that share two features still meet in one of them (both rank features alike,
    so they never leave out two different common ones).  The ratings left out are
    then looked up for the pairs that met.  With one hot feature none of its
    pairs is generated by itself; with several, a pair that meets in a hot
    feature shares at least that one, and the groups are split into cells.
    """
    if min_support < 2:
        raise ValueError("min_support must be at least 2")
    rows = _rows(ratings, entity, feature)
    hot, work = group_work(rows, ["f"], limit)
    if hot is None:
        met = _packed_sums(rows, work, statistic).filter(F.col("n") >= min_support)
        return met.select(*_turned(met.columns))

    common = rows.join(hot, "f")
    left_out = common.groupBy("id").agg(F.max(F.struct("_n", "f", "r")).alias("top")).select("id", "top.f", "top.r")
    indexed = rows.join(left_out.select("id", "f"), ["id", "f"], "left_anti")
    common_indexed = common.join(left_out.select("id", "f"), ["id", "f"], "left_anti")

    met = stage(statistic.of(pair_join(indexed, ["f"], "id", {"r": ("x", "y")}, limit)))
    pairs = met.select("id1", "id2")

    def side(frame: DataFrame, number: int, value: str) -> DataFrame:
        return frame.select(F.col("id").alias(f"id{number}"), "f", F.col("r").alias(value))

    # A feature left out by id1 (kept or left out by id2), then one left out by id2 only.
    # Each id has left out one at most, so both are lookups of single rows.
    first = pairs.join(side(left_out, 1, "x"), "id1").join(side(common, 2, "y"), ["id2", "f"])
    second = pairs.join(side(left_out, 2, "y"), "id2").join(side(common_indexed, 1, "x"), ["id1", "f"])
    looked_up = statistic.of(first.select("id1", "id2", "x", "y").unionByName(second.select("id1", "id2", "x", "y")))
    return statistic.merged(met.unionByName(looked_up)).filter(F.col("n") >= min_support)


def co_rating_sums_of(
    pairs: DataFrame,
    ratings: DataFrame,
    entity: str,
    feature: str,
    min_support: int = MIN_SUPPORT,
    limit: int = GROUP_LIMIT,
    statistic: Statistic = SUMS,
) -> DataFrame:
    """The sums of ``co_rating_sums`` for given pairs ``id1 < id2`` only.

    Goes from each pair to the ratings of its side with fewer of them, and looks
    these up on the other side.  The rows made are bounded by the pairs times the
    ratings of their smaller side; nothing is paired that was not asked for.
    Sides that many pairs share are split into cells.  Runs one counting job.
    """
    rows = _rows(ratings, entity, feature)
    sizes = rows.groupBy("id").agg(F.count("*").alias("n"))
    known = pairs.select("id1", "id2")
    for side in ("1", "2"):
        known = known.join(sizes.select(F.col("id").alias(f"id{side}"), F.col("n").alias(f"n{side}")), f"id{side}")
    swap = F.col("n1") > F.col("n2")
    oriented = known.select(
        F.when(swap, F.col("id2")).otherwise(F.col("id1")).alias("small"),
        F.when(swap, F.col("id1")).otherwise(F.col("id2")).alias("large"),
    )
    of_small = rows.select(F.col("id").alias("small"), "f", F.col("r").alias("rs"))
    of_large = rows.select(F.col("id").alias("large"), "f", F.col("r").alias("rl"))
    met = split_join(stage(oriented), of_small, ["small"], limit).join(of_large, ["large", "f"])
    turned = F.col("small") < F.col("large")
    terms = met.select(
        F.least("small", "large").alias("id1"),
        F.greatest("small", "large").alias("id2"),
        F.when(turned, F.col("rs")).otherwise(F.col("rl")).alias("x"),
        F.when(turned, F.col("rl")).otherwise(F.col("rs")).alias("y"),
    )
    return statistic.of(terms).filter(F.col("n") >= min_support)


def co_rated_pairs(ratings: DataFrame, entity: str, feature: str, min_support: int = MIN_SUPPORT) -> DataFrame:
    """``id1, id2, n``: pairs with at least ``min_support`` features in common."""
    return co_rating_sums(ratings, entity, feature, min_support).select("id1", "id2", "n")


def pearson(sums: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """``id1, id2, n, w`` from co-rating sums; pairs with weight 0 or a constant side are left out.

    Means are those of the common ratings.  The sums of whole or half-star
    ratings are exact, so the tests against zero are too.  They cancel for
    ratings far from zero or of many digits: use ``centred_pearson`` there.
    """
    n = F.col("n").cast("double")
    cov = n * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    floor_x, floor_y = n * F.col("sxx") * tolerance, n * F.col("syy") * tolerance
    moments = {"cov": cov, "vx": vx, "vy": vy, "fx": floor_x, "fy": floor_y}
    return (
        sums.select("id1", "id2", "n", *[value.alias(name) for name, value in moments.items()])
        .filter("vx > fx and vy > fy and abs(cov) > sqrt(fx * fy)")
        .select("id1", "id2", "n", (F.col("cov") / F.sqrt(F.col("vx") * F.col("vy"))).alias("w"))
    )


def centred_pearson(moments: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``id1, id2, n, w`` from co-rating moments, for any real ratings.

    Pairs whose weight is not above ``tolerance``, or with a constant side, are
    left out.  Infinite and NaN ratings give none.
    """
    w = F.col("cxy") / (F.sqrt("cxx") * F.sqrt("cyy"))
    real = moments.filter("cxx > 0 and cyy > 0 and cxx < double('infinity') and cyy < double('infinity')")
    return real.select("id1", "id2", "n", w.alias("w")).filter(F.abs("w") > tolerance)


def _weights(
    rows: Callable[[Statistic], DataFrame], tolerance: float, centred: bool
) -> DataFrame:
    return centred_pearson(rows(MOMENTS), max(tolerance, TOLERANCE)) if centred else pearson(rows(SUMS), tolerance)


def user_pearson(
    ratings: DataFrame,
    min_support: int = MIN_SUPPORT,
    limit: int = GROUP_LIMIT,
    tolerance: float = 0.0,
    centred: bool = False,
) -> DataFrame:
    """Weights of all user pairs; ``centred`` for ratings that are not whole or half numbers."""
    return _weights(
        lambda kept: co_rating_sums(ratings, "user", "item", min_support, limit, kept), tolerance, centred
    )


def item_pearson(
    ratings: DataFrame,
    min_support: int = MIN_SUPPORT,
    limit: int = GROUP_LIMIT,
    tolerance: float = 0.0,
    centred: bool = False,
) -> DataFrame:
    """Weights of all item pairs; ``centred`` for ratings that are not whole or half numbers."""
    return _weights(
        lambda kept: co_rating_sums(ratings, "item", "user", min_support, limit, kept), tolerance, centred
    )


def item_pearson_of(
    pairs: DataFrame,
    ratings: DataFrame,
    min_support: int = MIN_SUPPORT,
    limit: int = GROUP_LIMIT,
    tolerance: float = 0.0,
    centred: bool = False,
) -> DataFrame:
    """Weights of given item pairs, such as LSH candidates; ``centred`` as in ``item_pearson``."""
    return _weights(
        lambda kept: co_rating_sums_of(pairs, ratings, "item", "user", min_support, limit, kept), tolerance, centred
    )
