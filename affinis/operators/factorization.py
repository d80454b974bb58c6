"""Matrix factorisation by alternating least squares, and corrections of its scores."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.plans.staging import shared_folder

# Fixed values of the model.
RANK = 2
ITERATIONS = 10
REGULARISATION = 0.36
SEED = 4

LOWEST, HIGHEST = 1.0, 5.0
# Part of the model, as the start values are drawn per block; raise it for a cluster of more cores.
BLOCKS = 10


def fit_als(
    train: DataFrame,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    regularisation: float = REGULARISATION,
    blocks: int = BLOCKS,
    seed: int = SEED,
) -> ALSModel:
    """Explicit-feedback ALS.  Ids must fit a 32-bit integer.

    The factors start from random values per block, so results depend on
    ``blocks``; it is a constant and follows neither from the data nor from the cluster.
    """
    shared_folder(train.sparkSession)
    als = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=regularisation,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        seed=seed,
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        coldStartStrategy="drop",
        checkpointInterval=5,
    )
    return als.fit(train)


def normal_equation_residuals(
    model: ALSModel, train: DataFrame, regularisation: float = REGULARISATION
) -> DataFrame:
    """``user, n, residual``: how far each user's factors are from solving their own least squares.

    Training ends with the users, so given the item factors each user's solve
    ``sum(y (y.x - r)) + regularisation * n * x = 0`` over their ``n`` ratings.
    ``residual`` is the largest absolute value of a component, relative to the
    sum of ``|r y|``; 0 but for rounding.
    """
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    known = train.join(items, "item").join(users, "user")
    product = F.zip_with("x", "y", lambda a, b: a.cast("double") * b.cast("double"))
    dot = F.aggregate(product, F.lit(0.0), lambda total, value: total + value)
    terms = known.select("user", "rating", "x", "y", (dot - F.col("rating")).alias("error"))
    sums = terms.groupBy("user", "x").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(F.col("error") * F.col("y")[k]) for k in range(model.rank)]).alias("gradient"),
        F.array(*[F.sum(F.abs(F.col("rating") * F.col("y")[k])) for k in range(model.rank)]).alias("size"),
    )
    penalty = F.transform("x", lambda v: v.cast("double") * F.col("n") * regularisation)
    left = F.zip_with(F.zip_with("gradient", penalty, lambda a, b: F.abs(a + b)), "size", F.try_divide)
    return sums.select("user", "n", F.array_max(left).alias("residual"))


def als_predictions(model: ALSModel, targets: DataFrame) -> DataFrame:
    """``user, item, prediction`` of distinct targets; pairs the model does not know drop out."""
    scored = model.transform(targets.select("user", "item").distinct())
    return scored.select("user", "item", F.col("prediction").cast("double").alias("prediction"))


def scale_to_range(predictions: DataFrame, lowest: float = LOWEST, highest: float = HIGHEST) -> DataFrame:
    """Stretch the scored set linearly onto ``[lowest, highest]``.

    When all predictions are equal there is nothing to stretch and each becomes
    the midpoint.
    """
    bounds = predictions.agg(F.struct(F.min("prediction").alias("lo"), F.max("prediction").alias("hi")))
    share = F.try_divide(
        F.col("prediction") - F.col("bounds.lo"), F.col("bounds.hi") - F.col("bounds.lo")
    )
    scaled = F.coalesce(share * (highest - lowest) + lowest, F.lit((lowest + highest) / 2))
    others = [c for c in predictions.columns if c != "prediction"]
    return predictions.withColumn("bounds", bounds.scalar()).select(*others, scaled.alias("prediction"))


def fill_with_user_mean(predictions: DataFrame, targets: DataFrame) -> DataFrame:
    """Add the targets without a prediction, scored with the mean prediction of their user.

    Targets of users without any prediction stay out.
    """
    predictions = predictions.select("user", "item", "prediction")
    missing = targets.select("user", "item").distinct().join(predictions, ["user", "item"], "left_anti")
    means = predictions.groupBy("user").agg(F.avg("prediction").alias("prediction"))
    return predictions.unionByName(missing.join(means, "user"))


def replace_outliers(predictions: DataFrame, lowest: float = 0.0, highest: float = HIGHEST) -> DataFrame:
    """Predictions outside ``[lowest, highest]`` become the mean of all predictions."""
    mean = predictions.agg(F.avg("prediction")).scalar()
    value = F.col("prediction")
    inside = F.when(value.between(lowest, highest), value).otherwise(mean)
    others = [c for c in predictions.columns if c != "prediction"]
    return predictions.select(*others, inside.alias("prediction"))
