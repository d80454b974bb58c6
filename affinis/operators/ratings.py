"""Ratings ``(user, item, rating)``: one row per pair, hold-out removal, means, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.hashing import element_hash
from affinis.plans.skew import by_key

# Rows that a set is spread over.
SET_PARTS = 16


def one_rating_per_pair(ratings: DataFrame) -> DataFrame:
    """Keep the highest rating where a user rated an item more than once."""
    return ratings.groupBy("user", "item").agg(F.max("rating").alias("rating"))


def train_minus_test(ratings: DataFrame, test: DataFrame) -> DataFrame:
    """Ratings whose (user, item) pair is not in the test set, whatever its rating."""
    return ratings.join(test.select("user", "item"), ["user", "item"], "left_anti")


def mean_rating(ratings: DataFrame, entity: str) -> DataFrame:
    """``id, n, mean`` per user or item (``entity`` names the column)."""
    return ratings.groupBy(F.col(entity).alias("id")).agg(
        F.count("*").alias("n"), F.avg("rating").alias("mean")
    )


def element_sets(ratings: DataFrame, entity: str, element: str, parts: int = SET_PARTS) -> DataFrame:
    """Set of ``element`` per ``entity``: ``id, part, n, elements`` (sorted).

    Every set is spread over ``parts`` rows by a hash of the member, less those
    without one, whatever its size; ``n`` counts the members of the whole set.
    For sets of very many members ask for more parts.  Rows are dealt by set and
    part before they are packed, and each row is packed once.
    """
    members = ratings.select(F.col(entity).alias("id"), F.col(element).alias("e")).filter("id is not null")
    part = F.pmod(element_hash(F.col("e")), F.lit(parts)).alias("part")
    dealt = by_key(members.select("id", "e", part), ["id", "part"])
    sets = dealt.groupBy("id", "part").agg(F.array_sort(F.collect_set("e")).alias("elements"))
    n = F.sum(F.size("elements")).over(Window.partitionBy("id"))
    return sets.select("id", "part", n.alias("n"), "elements")


def element_bags(ratings: DataFrame, entity: str, element: str, parts: int = SET_PARTS) -> DataFrame:
    """Bag of ``element`` per ``entity``: ``id, part, n, elements, counts``, the elements sorted, each with its count.

    As ``element_sets``, but repeated rows count: ``n`` is the size of the
    whole bag.  Repeats are counted before the shuffle, so an element
    that occurs a million times is one entry.  Rows without an entity or element
    are left out.
    """
    members = ratings.select(F.col(entity).alias("id"), F.col(element).alias("e")).dropna()
    counts = members.groupBy("id", "e").agg(F.count("*").alias("c"))
    part = F.pmod(element_hash(F.col("e")), F.lit(parts)).alias("part")
    dealt = by_key(counts.select("id", "e", "c", part), ["id", "part"])
    packed = F.array_sort(F.collect_list(F.struct("e", "c"))).alias("bag")
    bags = dealt.groupBy("id", "part").agg(packed, F.sum("c").alias("c"))
    found = bags.withColumn("n", F.sum("c").over(Window.partitionBy("id")))
    return found.select("id", "part", "n", F.col("bag.e").alias("elements"), F.col("bag.c").alias("counts"))
