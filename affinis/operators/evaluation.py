"""Error of predictions against a hold-out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Fixed buckets of the absolute error.
BUCKETS = ["[0,1)", "[1,2)", "[2,3)", "[3,4)", "[4,5]", ">5"]
# Errors are rounded to this many digits before they are put in a bucket.
ERROR_DIGITS = 9


def errors(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Predictions that have a true rating, with ``error``; NaN predictions count as missing."""
    actual = truth.select("user", "item", "rating")
    joined = predictions.join(actual, ["user", "item"])
    error = F.nanvl(F.col("prediction") - F.col("rating"), F.lit(None))
    return joined.withColumn("error", error)


def _bucket_counts() -> list[Column]:
    size = F.round(F.abs("error"), ERROR_DIGITS)
    edges = [
        size < 1,
        (size >= 1) & (size < 2),
        (size >= 2) & (size < 3),
        (size >= 3) & (size < 4),
        (size >= 4) & (size <= 5),
        size > 5,
    ]
    return [F.count_if(F.coalesce(edge, F.lit(False))).alias(f"b{i}") for i, edge in enumerate(edges)]


def rating_error_histogram(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """``bucket, n``: six rows, counted in one pass."""
    counts = errors(predictions, truth).agg(*_bucket_counts())
    rows = [F.struct(F.lit(name).alias("bucket"), F.col(f"b{i}").alias("n")) for i, name in enumerate(BUCKETS)]
    return counts.select(F.inline(F.array(*rows)))


def _error_summary() -> list[Column]:
    mse = F.avg(F.col("error") * F.col("error"))
    return [F.count("error").alias("n"), mse.alias("mse"), F.sqrt(mse).alias("rmse")]


def rating_rmse(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """One row ``n, mse, rmse``; without any error to average, 0 and nulls."""
    return errors(predictions, truth).agg(*_error_summary())


def rating_error_report(predictions: dict[str, DataFrame], truth: DataFrame) -> DataFrame:
    """``method, n, rmse, b0..b5`` for several named predictions, joined to the truth once."""
    tagged = [
        p.select(F.lit(method).alias("method"), "user", "item", "prediction") for method, p in predictions.items()
    ]
    every = reduce(DataFrame.unionByName, tagged)
    summary = errors(every, truth).groupBy("method").agg(*_error_summary(), *_bucket_counts())
    return summary.drop("mse")


def write_with_report(predictions: dict[str, DataFrame], truth: DataFrame, path: str) -> DataFrame:
    """Write the predictions that have a true rating and report their errors from the same pass.

    The table has ``method, user, item, prediction, rating, error``; the report is that of
    ``rating_error_report``.  Its metrics are observed while the rows are written,
    so nothing is computed or read again; one record comes to the driver.
    """
    methods = list(predictions)
    tagged = [predictions[m].select(F.lit(m).alias("method"), "user", "item", "prediction") for m in methods]
    rows = errors(reduce(DataFrame.unionByName, tagged), truth)
    size = F.round(F.abs("error"), ERROR_DIGITS)
    # The six edges as one number of the bucket, null without an error.
    bucket = F.when(size < 1, 0).when(size < 2, 1).when(size < 3, 2).when(size < 4, 3).when(size <= 5, 4).when(size > 5, 5)
    metrics = []
    for i, method in enumerate(methods):
        own = F.col("method") == method
        metrics.append(F.count(F.when(own, F.col("error"))).alias(f"n_{i}"))
        metrics.append(F.avg(F.when(own, F.col("error") * F.col("error"))).alias(f"mse_{i}"))
        metrics.append(F.count_if(own).alias(f"rows_{i}"))
        metrics += [F.count_if(own & F.coalesce(bucket == b, F.lit(False))).alias(f"b{b}_{i}") for b in range(len(BUCKETS))]
    seen = Observation()
    rows.observe(seen, *metrics).write.parquet(path)
    found = seen.get
    report = [
        (m, found[f"n_{i}"], None if found[f"mse_{i}"] is None else found[f"mse_{i}"] ** 0.5)
        + tuple(found[f"b{b}_{i}"] for b in range(len(BUCKETS)))
        for i, m in enumerate(methods)
        if found[f"rows_{i}"]
    ]
    counts = ", ".join(f"b{b} BIGINT" for b in range(len(BUCKETS)))
    return truth.sparkSession.createDataFrame(report, f"method STRING, n BIGINT, rmse DOUBLE, {counts}")
