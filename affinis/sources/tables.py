"""Ratings and sets derived from an order database (orders, line items, parts, documents)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.functions.text import word_runs, word_shingles
from affinis.operators.jaccard import distinct_members
from affinis.operators.ratings import one_rating_per_pair
from affinis.plans.skew import by_key
from affinis.plans.staging import spread

# Orders from this day on are the hold-out.
HOLDOUT_FROM = "2000-12-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _ordered_lines(spark: SparkSession, folder: str, since: str | None = None) -> DataFrame:
    orders = table(spark, folder, "orders")
    if since:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp"))
    lines = table(spark, folder, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _rating() -> Column:
    """Quantities 1..50 as ratings 1..5."""
    return (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double")


def ratings(spark: SparkSession, folder: str, item: str = "l_partkey", since: str | None = None) -> DataFrame:
    """``user, item, rating``: customers rate the parts (or suppliers) they ordered.

    A customer's rating of an item is the highest of their orders, so the
    ratings of recent orders (``since``) also occur among all ratings,
    possibly with another value.
    """
    rows = _ordered_lines(spark, folder, since).select(
        F.col("o_custkey").alias("user"), F.col(item).alias("item"), _rating().alias("rating")
    )
    return one_rating_per_pair(rows)


def holdout(spark: SparkSession, folder: str, item: str = "l_partkey") -> DataFrame:
    return ratings(spark, folder, item, HOLDOUT_FROM)


def ordered_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """``user, item``: customer and supplier of every order line."""
    return _ordered_lines(spark, folder).select(F.col("o_custkey").alias("user"), F.col("l_suppkey").alias("item"))


def customers_of_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """``id`` = supplier, ``element`` = customer."""
    return distinct_members(_ordered_lines(spark, folder), "l_suppkey", "o_custkey")


def markets_of_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """``id`` = supplier, ``element`` = nation of the customer and brand of the part, as one number."""
    lines = _ordered_lines(spark, folder)
    customers = table(spark, folder, "customer")
    parts = table(spark, folder, "part")
    rows = lines.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    brand = F.substring_index("p_brand", "#", -1).cast("bigint")
    market = F.col("c_nationkey") * 1000 + brand
    return distinct_members(rows.select("l_suppkey", market.alias("market")), "l_suppkey", "market")


def document_shingles(spark: SparkSession, folder: str) -> DataFrame:
    """``id`` = document, ``element`` = run of three words."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return word_shingles(spread(documents), "doc_id", "text")


def document_runs(spark: SparkSession, folder: str) -> DataFrame:
    """``id`` = document, ``element`` = run of three words, as often as it occurs.

    Whole texts are dealt by document, which moves less than their runs would.
    """
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return word_runs(by_key(documents, ["doc_id"]), "doc_id", "text")


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """``user, item, rating``: the highest price a customer paid to a supplier, a million above zero.

    Real-valued ratings far from zero, whose sums of products cancel.
    """
    price = (F.col("l_extendedprice").cast("double") + 1e6).alias("rating")
    rows = _ordered_lines(spark, folder).select(F.col("o_custkey").alias("user"), F.col("l_suppkey").alias("item"), price)
    return one_rating_per_pair(rows)
