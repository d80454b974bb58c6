import math

import pytest

from affinis.operators import evaluation as E
from affinis.operators import factorization as A
from affinis.operators.predict import predict_mean

from .conftest import tuples


@pytest.fixture
def predictions(spark):
    def make(rows):
        return spark.createDataFrame(rows, "user BIGINT, item BIGINT, prediction DOUBLE")

    return make


def test_histogram_edges(predictions, ratings):
    errors = [0.0, 0.5, 1.0, 2.0, 3.0, 4.0, 5.0, 5.1, -1.0, math.nan]
    pred = predictions([(1, i, 3.0 + e) for i, e in enumerate(errors)] + [(9, 9, 1.0)])
    truth = ratings([(1, i, 3.0) for i in range(len(errors))])
    assert [tuple(r) for r in E.rating_error_histogram(pred, truth).collect()] == [
        ("[0,1)", 2), ("[1,2)", 2), ("[2,3)", 1), ("[3,4)", 1), ("[4,5]", 2), (">5", 1)
    ]
    summary = E.rating_rmse(pred, truth).first()
    squares = [e * e for e in errors if e == e]
    assert summary.n == 9 and summary.mse == pytest.approx(sum(squares) / 9)
    assert summary.rmse == pytest.approx(math.sqrt(sum(squares) / 9))


def test_rounding_does_not_move_an_error_across_an_edge(predictions, ratings):
    pred = predictions([(1, 1, 1.1 + 0.1 + 0.1)])  # 1.3000000000000003
    counts = {r.bucket: r.n for r in E.rating_error_histogram(pred, ratings([(1, 1, 0.3)])).collect()}
    assert counts["[1,2)"] == 1


def test_nothing_to_compare(predictions, ratings):
    pred, truth = predictions([]), ratings([(1, 1, 2.0)])
    assert tuple(E.rating_rmse(pred, truth).first()) == (0, None, None)
    assert [r.n for r in E.rating_error_histogram(pred, truth).collect()] == [0] * 6


def test_report_has_one_row_per_method(predictions, ratings):
    truth = ratings([(1, 1, 2.0), (1, 2, 4.0)])
    report = E.rating_error_report(
        {"good": predictions([(1, 1, 2.0), (1, 2, 4.0)]), "bad": predictions([(1, 1, 8.0)])}, truth
    )
    got = {r.method: r for r in report.collect()}
    assert (got["good"].n, got["good"].rmse, got["good"].b0) == (2, 0.0, 2)
    assert (got["bad"].n, got["bad"].rmse, got["bad"].b5) == (1, 6.0, 1)


def test_scaling(predictions):
    df = predictions([(1, 1, 2.0), (1, 2, 3.0), (2, 1, 4.0)])
    assert tuples(A.scale_to_range(df), "user", "item", "prediction") == [(1, 1, 1.0), (1, 2, 3.0), (2, 1, 5.0)]
    assert tuples(A.scale_to_range(predictions([(1, 1, 2.0), (1, 2, 2.0)])), "prediction") == [(3.0,), (3.0,)]
    assert A.scale_to_range(predictions([])).count() == 0


def test_cold_targets_take_the_mean_of_their_user(spark, predictions):
    df = predictions([(1, 1, 2.0), (1, 2, 4.0), (2, 1, 5.0)])
    targets = spark.createDataFrame([(1, 1), (1, 3), (1, 3), (2, 1), (7, 1)], "user BIGINT, item BIGINT")
    assert tuples(A.fill_with_user_mean(df, targets), "user", "item", "prediction") == [
        (1, 1, 2.0), (1, 2, 4.0), (1, 3, 3.0), (2, 1, 5.0)
    ]


def test_outliers_take_the_mean(predictions):
    df = predictions([(1, 1, 7.0), (1, 2, -1.0), (1, 3, 5.0), (1, 4, 0.0)])
    assert tuples(A.replace_outliers(df), "item", "prediction") == [(1, 2.75), (2, 2.75), (3, 5.0), (4, 0.0)]


def test_als_is_repeatable_and_learns(ratings):
    rows = [(u, i, float(1 + (u + i) % 2 * 4)) for u in range(20) for i in range(20) if (u * 7 + i * 3) % 5]
    train = ratings(rows)
    left = [(u, i, float(1 + (u + i) % 2 * 4)) for u in range(20) for i in range(20) if not (u * 7 + i * 3) % 5]
    targets = ratings(left)
    cold = targets.union(ratings([(99, 1, 3.0), (1, 99, 3.0)]))
    model = A.fit_als(train, blocks=2)
    scored = A.als_predictions(model, cold)
    first = tuples(scored, "user", "item", "prediction")
    assert len(first) == targets.count()  # unknown users and items drop out
    again = A.als_predictions(A.fit_als(train.repartition(5), blocks=2), cold.repartition(3))
    assert [p[:2] for p in first] == [p[:2] for p in tuples(again, "user", "item", "prediction")]
    assert [p[2] for p in first] == pytest.approx([p[2] for p in tuples(again, "user", "item", "prediction")])
    scaled = [p[0] for p in tuples(A.scale_to_range(scored), "prediction")]
    assert (min(scaled), max(scaled)) == pytest.approx((1.0, 5.0))
    als = E.rating_rmse(scored, targets).first().rmse
    assert als < E.rating_rmse(predict_mean(train, targets, "item"), targets).first().rmse


def test_report_from_the_pass_that_writes(spark, ratings, tmp_path):
    truth = ratings([(1, 1, 3.0), (1, 2, 5.0), (2, 1, 1.0), (3, 3, 2.0)])
    schema = "user BIGINT, item BIGINT, prediction DOUBLE"
    one = spark.createDataFrame([(1, 1, 3.5), (1, 2, 0.0), (2, 1, 1.0), (9, 9, 1.0), (3, 3, float("nan"))], schema)
    two = spark.createDataFrame([(1, 1, None), (3, 3, 9.5)], schema)
    none = one.limit(0)
    methods = {"one": one, "two": two, "none": none}
    path = str(tmp_path / "out")
    report = E.write_with_report(methods, truth, path)
    columns = ["method", "n", "rmse", *[f"b{i}" for i in range(6)]]
    assert tuples(report, *columns) == tuples(E.rating_error_report(methods, truth), *columns)
    assert spark.read.parquet(path).count() == 6
