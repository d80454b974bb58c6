"""One query per operator: ``(spark, folder) -> DataFrame``.

Inputs that a query reads several times are staged first.  Doubles are rounded
to six digits and arrays written as text in the last projection only, to be
comparable across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.operators import evaluation, factorization, jaccard, minhash, neighbours, predict
from affinis.operators import ratings as rating_ops
from affinis.plans import stage
from affinis.plans.staging import shared_folder
from affinis.sources import addressable, csv, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def comparable(df: DataFrame) -> DataFrame:
    def show(name: str, kind: str):
        if kind == "double":
            return (F.round(name, 6) + F.lit(0.0)).alias(name)
        if kind.startswith("array"):
            return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)
        if kind == "int":
            return F.col(name).cast("bigint").alias(name)
        return F.col(name)

    return df.select(*[show(name, kind) for name, kind in df.dtypes])


def _split(spark: SparkSession, folder: str, item: str = "l_partkey") -> tuple[DataFrame, DataFrame]:
    """Train and test ratings, staged."""
    test = stage(tables.holdout(spark, folder, item))
    return stage(rating_ops.train_minus_test(tables.ratings(spark, folder, item), test)), test


def _sets(train: DataFrame) -> DataFrame:
    return train.select(F.col("item").alias("id"), F.col("user").alias("element"))


# Ratings


@query
def ratings(spark, folder):
    return comparable(tables.ratings(spark, folder))


@query
def ratings_from_csv(spark, folder):
    path = f"{shared_folder(spark)}/ratings-{uuid.uuid4().hex}"
    lines = tables.ratings(spark, folder).select(
        F.col("user").alias("userID"), F.col("item").alias("productID"), "rating", F.lit(0).alias("time")
    )
    lines.write.option("header", True).csv(path)
    return comparable(csv.read_ratings(spark, path, extra_columns=1))


@query
def ratings_from_three_columns(spark, folder):
    path = f"{shared_folder(spark)}/ratings-{uuid.uuid4().hex}"
    lines = tables.holdout(spark, folder).select(F.col("user").alias("userID"), F.col("item").alias("productID"), "rating")
    lines.write.option("header", True).csv(path)
    return comparable(csv.read_ratings(spark, path))


@query
def ratings_without_header_lines(spark, folder):
    """Every file has a header line, and each is dropped by the text in it."""
    path = f"{shared_folder(spark)}/ratings-{uuid.uuid4().hex}"
    lines = tables.ratings(spark, folder).select(
        F.col("user").alias("userID"), F.col("item").alias("productID"), "rating", F.lit(0).alias("time")
    )
    lines.write.option("header", True).csv(path)
    return comparable(csv.read_ratings(spark, path, extra_columns=1, skip_lines_with="userID"))


@query
def ratings_apart(spark, folder):
    """Ratings from lines of which some are bad: good rows and bad lines, each with its reason."""
    path = f"{shared_folder(spark)}/ratings-{uuid.uuid4().hex}"
    whole = F.concat_ws(",", "user", "item", "rating", F.lit("0"))
    line = F.when(F.col("item") % 50 == 0, F.concat_ws(",", "user", "item"))
    line = line.when(F.col("item") % 50 == 1, F.concat_ws(",", F.lit(""), "item", "rating", F.lit("0")))
    line = line.when(F.col("item") % 50 == 2, F.concat_ws(",", "user", F.lit("item"), "rating", F.lit("0")))
    tables.ratings(spark, folder).select(line.otherwise(whole)).write.text(path)
    found = csv.read_ratings_apart(spark, path, extra_columns=1, header=False)
    good = found.good.select(F.lit("good").alias("kind"), F.concat_ws(",", "user", "item").alias("value"))
    return good.unionAll(found.bad.select("reason", "value"))


@query
def ratings_apart_counts(spark, folder):
    path = f"{shared_folder(spark)}/ratings-{uuid.uuid4().hex}"
    line = F.when(F.col("item") % 50 == 0, F.concat_ws(",", "user", "item"))
    tables.ratings(spark, folder).select(line.otherwise(F.concat_ws(",", "user", "item", "rating"))).write.text(path)
    return spark.createDataFrame([csv.read_ratings_apart(spark, path, header=False).counts])


@query
def known_pairs(spark, folder):
    """Customers and the suppliers they ordered from, as pairs of numbers in a file."""
    path = f"{shared_folder(spark)}/pairs-{uuid.uuid4().hex}"
    pairs = tables.customers_of_suppliers(spark, folder).select(F.col("element").alias("a"), F.col("id").alias("b"))
    pairs.write.option("header", True).csv(path)
    return comparable(csv.read_pairs(spark, path))


@query
def train_minus_test(spark, folder):
    test = tables.holdout(spark, folder)
    return comparable(rating_ops.train_minus_test(tables.ratings(spark, folder), test))


@query
def user_mean(spark, folder):
    return comparable(rating_ops.mean_rating(tables.ratings(spark, folder), "user"))


@query
def item_mean(spark, folder):
    return comparable(rating_ops.mean_rating(tables.ratings(spark, folder), "item"))


@query
def user_item_sets(spark, folder):
    return comparable(rating_ops.element_sets(stage(tables.ratings(spark, folder)), "user", "item"))


@query
def item_user_sets(spark, folder):
    return comparable(rating_ops.element_sets(stage(tables.ratings(spark, folder)), "item", "user"))


@query
def item_user_bags(spark, folder):
    """Suppliers with the customers of each order line: repeats count."""
    orders = stage(tables.ordered_pairs(spark, folder))
    return comparable(rating_ops.element_bags(orders, "item", "user"))


# Set similarity


def _supplier_signatures(spark, folder):
    return minhash.signatures(tables.customers_of_suppliers(spark, folder))


@query
def minhash_signatures(spark, folder):
    return comparable(minhash.signature_rows(_supplier_signatures(spark, folder)))


@query
def lsh_buckets(spark, folder):
    return comparable(minhash.lsh_buckets(minhash.bands(_supplier_signatures(spark, folder))))


@query
def lsh_candidates(spark, folder):
    return comparable(minhash.lsh_candidates(_supplier_signatures(spark, folder)))


@query
def lsh_bucket_sets(spark, folder):
    """How many different sets of each size share a bucket; each is paired once."""
    banded = stage(minhash.bands(minhash.signatures(tables.markets_of_suppliers(spark, folder))))
    return comparable(minhash.distinct_buckets(banded).groupBy("n").agg(F.count("*").alias("sets")))


@query
def minhash_bin_signatures(spark, folder):
    """One hash and a bin for each value, empty bins filled from others."""
    sets = tables.customers_of_suppliers(spark, folder)
    return comparable(minhash.signature_rows(minhash.signatures(sets, method=minhash.BINS)))


@query
def similar_items_bins(spark, folder):
    sets = stage(tables.markets_of_suppliers(spark, folder))
    found = jaccard.similar_sets(sets, method=minhash.BINS)
    return comparable(found.select("id1", "id2", "jaccard"))


@query
def jaccard_verified(spark, folder):
    sets = stage(tables.customers_of_suppliers(spark, folder))
    candidates = stage(minhash.lsh_candidates(minhash.signatures(sets)))
    return comparable(jaccard.jaccard_verified(candidates, sets))


@query
def similar_items_jaccard(spark, folder):
    sets = stage(tables.markets_of_suppliers(spark, folder))
    return comparable(jaccard.similar_sets(sets).select("id1", "id2", "jaccard"))


@query
def similar_documents_jaccard(spark, folder):
    sets = stage(tables.document_shingles(spark, folder))
    return comparable(jaccard.similar_sets(sets).select("id1", "id2", "jaccard"))


@query
def exact_jaccard_pairs(spark, folder):
    sets = stage(tables.markets_of_suppliers(spark, folder))
    return comparable(jaccard.exact_jaccard_pairs(sets))


@query
def exact_document_pairs(spark, folder):
    sets = stage(tables.document_shingles(spark, folder), "zstd")
    return comparable(jaccard.exact_jaccard_pairs(sets))


@query
def exact_bag_pairs(spark, folder):
    """Documents as bags of shingles: repeats count."""
    return comparable(jaccard.exact_bag_pairs(tables.document_runs(spark, folder)))


@query
def lsh_quality(spark, folder):
    sets = stage(tables.markets_of_suppliers(spark, folder))
    return comparable(jaccard.join_quality(jaccard.similar_sets(sets), jaccard.exact_jaccard_pairs(sets)))


@query
def lsh_candidate_quality(spark, folder):
    """Of the candidates, the share that reaches the threshold; of the pairs that do, the share among them."""
    sets = stage(tables.markets_of_suppliers(spark, folder))
    candidates = stage(minhash.lsh_candidates(minhash.signatures(sets)))
    return comparable(jaccard.join_quality(candidates, jaccard.exact_jaccard_pairs(sets)))


# Neighbour weights


@query
def co_rated_user_pairs(spark, folder):
    train, _ = _split(spark, folder)
    return comparable(neighbours.co_rated_pairs(train, "user", "item"))


@query
def user_pearson(spark, folder):
    train, _ = _split(spark, folder)
    return comparable(neighbours.user_pearson(train))


@query
def item_pearson(spark, folder):
    train, _ = _split(spark, folder)
    return comparable(neighbours.item_pearson(train))


@query
def item_pearson_centred(spark, folder):
    """Weights of suppliers by prices, whose sums of products would cancel."""
    return comparable(neighbours.item_pearson(stage(tables.prices(spark, folder)), centred=True))


def _lsh_weights(train: DataFrame) -> DataFrame:
    candidates = stage(minhash.lsh_candidates(minhash.signatures(_sets(train))))
    return neighbours.item_pearson_of(candidates, train)


@query
def item_pearson_lsh(spark, folder):
    train, _ = _split(spark, folder, "l_suppkey")
    return comparable(_lsh_weights(train))


# Predictions


def _user_based(train: DataFrame, test: DataFrame) -> DataFrame:
    return predict.predict_user_based(train, test, stage(neighbours.user_pearson(train)))


def _item_based(train: DataFrame, test: DataFrame) -> DataFrame:
    return predict.predict_item_based(train, test, stage(neighbours.item_pearson(train)))


@query
def predict_user_based(spark, folder):
    return comparable(_user_based(*_split(spark, folder)))


@query
def predict_item_based(spark, folder):
    return comparable(_item_based(*_split(spark, folder)))


@query
def predict_item_based_lsh(spark, folder):
    train, test = _split(spark, folder, "l_suppkey")
    return comparable(predict.predict_item_based(train, test, stage(_lsh_weights(train))))


@query
def predict_user_mean(spark, folder):
    train, test = _split(spark, folder)
    return comparable(predict.predict_mean(train, test, "user"))


@query
def predict_item_mean(spark, folder):
    train, test = _split(spark, folder)
    return comparable(predict.predict_mean(train, test, "item"))


@query
def write_sorted(spark, folder):
    train, test = _split(spark, folder)
    path = f"{shared_folder(spark)}/predictions-{uuid.uuid4().hex}"
    predictions = predict.predict_mean(train, test, "item").select("user", "item", "prediction")
    csv.write_sorted(predictions, path, ["user", "item"])
    return comparable(spark.read.schema("user BIGINT, item BIGINT, prediction DOUBLE").csv(path))


@query
def write_addressable(spark, folder):
    """Predictions in one sorted output, read back range by range."""
    train, test = _split(spark, folder)
    path = f"{shared_folder(spark)}/predictions-{uuid.uuid4().hex}"
    predictions = predict.predict_mean(train, test, "item").select("user", "item", "prediction")
    addressable.write_addressable(predictions, path, ["user", "item"])
    low, middle, high = ((), (400, 1000)), ((400, 1001), (900,)), ((901,), ())
    parts = [addressable.read_range(spark, path, *bounds) for bounds in (low, middle, high)]
    return comparable(parts[0].unionAll(parts[1]).unionAll(parts[2]))


# Matrix factorisation and corrections of predictions


def _als(spark, folder) -> tuple[DataFrame, DataFrame]:
    train, test = _split(spark, folder)
    return stage(factorization.als_predictions(factorization.fit_als(train), test)), test


@query
def als_scored_pairs(spark, folder):
    """The targets that the model scores."""
    return comparable(_als(spark, folder)[0].select("user", "item"))


@query
def als_scaled_bounds(spark, folder):
    scaled = factorization.scale_to_range(_als(spark, folder)[0])
    bounds = [F.min("prediction").alias("lowest"), F.max("prediction").alias("highest")]
    return comparable(scaled.agg(F.count("*").alias("n"), *bounds))


@query
def als_report_counts(spark, folder):
    return als_error_report(spark, folder).select("method", "n")


@query
def als_normal_equations(spark, folder):
    """Users of the model, and those whose factors don't solve their own least squares."""
    train, _ = _split(spark, folder)
    left = factorization.normal_equation_residuals(factorization.fit_als(train), train)
    wrong = F.count_if(F.coalesce(F.col("residual") > 1e-3, F.lit(True)))
    return left.agg(F.count("*").alias("users"), wrong.alias("violations"))


@query
def als_predictions(spark, folder):
    return comparable(_als(spark, folder)[0])


@query
def als_predictions_scaled(spark, folder):
    return comparable(factorization.scale_to_range(_als(spark, folder)[0]))


@query
def als_cold_start_filled(spark, folder):
    return comparable(factorization.fill_with_user_mean(*_als(spark, folder)))


@query
def als_error_report(spark, folder):
    predictions, test = _als(spark, folder)
    methods = {"als": predictions, "als_scaled": factorization.scale_to_range(predictions)}
    return comparable(evaluation.rating_error_report(methods, test))


@query
def predictions_scaled(spark, folder):
    predictions = stage(_item_based(*_split(spark, folder)).select("user", "item", "prediction"))
    return comparable(factorization.scale_to_range(predictions))


@query
def cold_start_filled(spark, folder):
    train, test = _split(spark, folder)
    known = _item_based(train, test).filter(F.col("n_neighbours") > 0)
    return comparable(factorization.fill_with_user_mean(stage(known), test))


@query
def clip_outliers_to_mean(spark, folder):
    predictions = stage(_item_based(*_split(spark, folder)).select("user", "item", "prediction"))
    return comparable(factorization.replace_outliers(predictions))


# Evaluation


@query
def rating_error_histogram(spark, folder):
    train, test = _split(spark, folder)
    return comparable(evaluation.rating_error_histogram(_item_based(train, test), test))


@query
def rating_rmse(spark, folder):
    train, test = _split(spark, folder)
    return comparable(evaluation.rating_rmse(_item_based(train, test), test))


@query
def rating_error_report(spark, folder):
    train, test = _split(spark, folder)
    methods = {
        "item_based": _item_based(train, test),
        "item_mean": predict.predict_mean(train, test, "item"),
        "user_based": _user_based(train, test),
        "user_mean": predict.predict_mean(train, test, "user"),
    }
    return comparable(evaluation.rating_error_report(methods, test))


@query
def observed_error_report(spark, folder):
    """The report of two methods, from the pass that writes their predictions."""
    train, test = _split(spark, folder)
    methods = {"item_based": _item_based(train, test), "item_mean": predict.predict_mean(train, test, "item")}
    path = f"{shared_folder(spark)}/predictions-{uuid.uuid4().hex}"
    return comparable(evaluation.write_with_report(methods, test, path))
