"""Rating prediction from neighbour weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.plans.skew import GROUP_LIMIT, grid_join, hot_cells
from affinis.plans.staging import stage


def both_directions(weights: DataFrame) -> DataFrame:
    """``pivot, neighbour, w`` with each pair both ways, in one pass."""
    ways = F.array(
        F.struct(F.col("id1").alias("pivot"), F.col("id2").alias("neighbour")),
        F.struct(F.col("id2").alias("pivot"), F.col("id1").alias("neighbour")),
    )
    return weights.select(F.inline(ways), "w")


def neighbour_sums(
    targets: DataFrame, rated: DataFrame, weights: DataFrame, limit: int = GROUP_LIMIT
) -> DataFrame:
    """``pivot, context, num, den, n`` over neighbours of the pivot that have a value in the context.

    ``targets``: distinct ``pivot, context``; ``rated``: ``neighbour, context,
    value``; ``weights``: ``pivot, neighbour, w``.  Each target takes the
    cheaper of two ways: through the values in its context, or through the
    neighbours of its pivot.  A popular context or a pivot with many
    neighbours is thus never multiplied out against the other side.
    Runs a staging and two counting jobs; give staged inputs.
    """
    in_context = rated.groupBy("context").agg(F.count("*").alias("values"))
    of_pivot = weights.groupBy("pivot").agg(F.count("*").alias("neighbours"))
    routed = stage(targets.join(in_context, "context").join(of_pivot, "pivot"))
    columns = ["pivot", "context", "value", "w"]

    def fan_out(way: DataFrame, side: DataFrame, key: str, size: str) -> DataFrame:
        sizes = way.groupBy(key).agg(F.count("*").alias("l"), F.first(size).alias("r"))
        return grid_join(way.select("pivot", "context"), side, [key], hot_cells(sizes, [key], limit))

    by_context = fan_out(routed.filter("values <= neighbours"), rated, "context", "values")
    by_pivot = fan_out(routed.filter("values > neighbours"), weights, "pivot", "neighbours")
    met = (
        by_context.join(weights, ["pivot", "neighbour"])
        .select(*columns)
        .unionByName(by_pivot.join(rated, ["neighbour", "context"]).select(*columns))
    )
    return met.groupBy("pivot", "context").agg(
        F.sum(F.col("value") * F.col("w")).alias("num"),
        F.sum(F.abs("w")).alias("den"),
        F.count("*").alias("n"),
    )


def _global_mean(ratings: DataFrame):
    return ratings.agg(F.avg("rating")).scalar()


def _means(ratings: DataFrame, entity: str, name: str) -> DataFrame:
    return ratings.groupBy(entity).agg(F.avg("rating").alias(name))


def _finish(targets: DataFrame, sums: DataFrame | None, train: DataFrame, entity: str, scored) -> DataFrame:
    """Join sums and means to the targets and fall back where there is no neighbour."""
    known = targets.join(_means(train, entity, "mean"), entity, "left")
    if sums is None:
        known = known.withColumns({"score": F.lit(None).cast("double"), "neighbours": F.lit(0).cast("bigint")})
    else:
        known = known.join(sums, ["user", "item"], "left").withColumns(
            {"score": scored, "neighbours": F.coalesce("n", F.lit(0))}
        )
    return known.select(
        "user",
        "item",
        F.coalesce("score", "mean", _global_mean(train)).alias("prediction"),
        F.col("neighbours").alias("n_neighbours"),
        F.when(F.col("score").isNotNull(), "none")
        .when(F.col("mean").isNotNull(), f"{entity}_mean")
        .otherwise("global_mean")
        .alias("fallback"),
    )


def predict_user_based(
    train: DataFrame, targets: DataFrame, weights: DataFrame, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Mean of the user plus the weighted deviations of the item's other raters from their own means.

    ``weights``: user pairs ``id1, id2, w``.  Output ``user, item, prediction,
    n_neighbours, fallback``; without a neighbour the user's mean, for
    an unknown user the global mean.  Neighbours are the users who rated the
    target item, and a weight counts from either side of its pair.
    """
    targets = targets.select("user", "item").distinct()
    centred = train.join(_means(train, "user", "mean"), "user").select(
        F.col("user").alias("neighbour"),
        F.col("item").alias("context"),
        (F.col("rating") - F.col("mean")).alias("value"),
    )
    sums = neighbour_sums(
        targets.select(F.col("user").alias("pivot"), F.col("item").alias("context")),
        centred,
        both_directions(weights),
        limit,
    ).withColumnsRenamed({"pivot": "user", "context": "item"})
    return _finish(targets, sums, train, "user", F.col("mean") + F.try_divide("num", "den"))


def predict_item_based(
    train: DataFrame, targets: DataFrame, weights: DataFrame, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Weighted mean of the user's ratings of items similar to the target.

    ``weights``: item pairs ``id1, id2, w``, all or those of LSH candidates.
    Negative weights count in the numerator with their sign, so predictions can
    leave the rating scale; they are not clipped here.  Without a
    neighbour the item's mean, for an unknown item the global mean.
    """
    targets = targets.select("user", "item").distinct()
    rated = train.select(
        F.col("item").alias("neighbour"), F.col("user").alias("context"), F.col("rating").alias("value")
    )
    sums = neighbour_sums(
        targets.select(F.col("item").alias("pivot"), F.col("user").alias("context")),
        rated,
        both_directions(weights),
        limit,
    ).withColumnsRenamed({"pivot": "item", "context": "user"})
    return _finish(targets, sums, train, "item", F.try_divide("num", "den"))


def predict_mean(train: DataFrame, targets: DataFrame, entity: str) -> DataFrame:
    """The fallback alone: mean of the user or item (``entity``), else the global mean."""
    return _finish(targets.select("user", "item").distinct(), None, train, entity, None)
