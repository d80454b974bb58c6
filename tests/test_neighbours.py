import random
import re

import pytest

from affinis.operators.neighbours import (
    co_rated_pairs,
    co_rating_sums,
    co_rating_sums_of,
    item_pearson,
    item_pearson_of,
    pearson,
    user_pearson,
)
from affinis.operators.predict import predict_item_based, predict_mean, predict_user_based

from . import brute
from .conftest import tuples


def random_ratings(seed, users=25, items=20, share=0.35, hot=(0, 1, 2)):
    """Random ratings in which a few items are rated by nearly everyone and user 0 rates nearly all."""
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        for i in range(items):
            p = 0.9 if i in hot or u == 0 else share
            if rng.random() < p:
                rows.append((u, i, float(rng.randint(1, 5))))
    return rows


def as_weights(df):
    return {(r.id1, r.id2): (r.n, r.w) for r in df.collect()}


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for key, (n, value) in expected.items():
        assert found[key][0] == n
        assert found[key][1] == pytest.approx(value, abs=1e-9)


def test_proportional_and_inverse_users(ratings):
    rows = [(u, i, float(r)) for u, rs in {1: (1, 2, 3), 2: (2, 4, 6), 3: (3, 2, 1)}.items() for i, r in enumerate(rs)]
    assert as_weights(user_pearson(ratings(rows))) == {(1, 2): (3, 1.0), (1, 3): (3, -1.0), (2, 3): (3, -1.0)}


def test_constant_or_uncorrelated_or_single_gives_no_weight(ratings):
    constant = [(1, 0, 3.0), (1, 1, 3.0), (2, 0, 1.0), (2, 1, 5.0)]
    uncorrelated = [(1, 0, 1.0), (1, 1, 2.0), (1, 2, 1.0), (2, 0, 1.0), (2, 1, 1.0), (2, 2, 1.0)]
    zero = [(u, i, float(r)) for u, rs in ((1, (1, 2, 1, 2)), (2, (1, 1, 2, 2))) for i, r in enumerate(rs)]
    single = [(1, 0, 1.0), (2, 0, 2.0), (1, 1, 4.0), (2, 2, 4.0)]
    for rows in (constant, uncorrelated, zero, single, []):
        assert user_pearson(ratings(rows)).count() == 0


@pytest.mark.parametrize("limit", [1, 8, 20, 10_000])
@pytest.mark.parametrize("entity,feature", [("user", "item"), ("item", "user")])
def test_weights_with_and_without_hot_features(ratings, limit, entity, feature):
    rows = random_ratings(7)
    df = ratings(rows)
    sums = co_rating_sums(df, entity, feature, limit=limit)
    assert {(r.id1, r.id2): r.n for r in sums.collect()} == brute.co_rated(rows, entity, feature)
    assert_same(as_weights(pearson(sums)), brute.weights(rows, entity, feature))


def test_one_hot_item_alone_makes_no_pairs(ratings, small_tasks):
    rows = [(u, 0, float(1 + u % 5)) for u in range(60)] + [(u, 1 + u % 20, float(1 + u % 3)) for u in range(60)]
    found = co_rating_sums(ratings(rows), "user", "item", limit=10)
    assert {(r.id1, r.id2): r.n for r in found.collect()} == brute.co_rated(rows, "user", "item")


@pytest.mark.parametrize("limit", [1, 10_000])
def test_ratings_without_a_value_count_for_nothing(spark, ratings, limit):
    rows = [(u, i, float(1 + u * i % 5)) for u in (1, 2, 3) for i in range(6)]
    holes = rows + [(1, 9, None), (2, 9, 4.0), (3, 9, None), (1, 10, 2.0), (2, 10, None)]
    expected = as_weights(user_pearson(ratings(rows), limit=limit))
    assert as_weights(user_pearson(ratings(holes), limit=limit)) == expected
    pairs = spark.createDataFrame([(0, 1), (1, 2), (2, 9)], "id1 BIGINT, id2 BIGINT")
    one = item_pearson_of(pairs, ratings(rows), limit=limit)
    assert as_weights(item_pearson_of(pairs, ratings(holes), limit=limit)) == as_weights(one)


def test_given_pairs_make_no_more_rows_than_their_smaller_sides(spark, ratings):
    """A hot user and a hot item: rows out of the first join are bounded by pairs x ratings of the smaller item."""
    rows = [(u, 0, float(1 + u % 5)) for u in range(200)] + [(0, i, float(1 + i % 5)) for i in range(1, 200)]
    rows += [(u, i, float(1 + (u + i) % 5)) for u in range(1, 20) for i in (1, 2, 3)]
    pairs = spark.createDataFrame([(0, 1), (1, 2), (2, 150), (0, 160)], "id1 BIGINT, id2 BIGINT")
    found = co_rating_sums_of(pairs, ratings(rows), "item", "user")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "small" in plan and "Join Inner, ((f" not in plan
    raters = {i: sum(1 for _, j, _ in rows if j == i) for _, i, _ in rows}
    counted = {(r.id1, r.id2): r.n for r in found.collect()}
    expected = {p: n for p, n in brute.co_rated(rows, "item", "user").items() if p in {(0, 1), (1, 2), (2, 150), (0, 160)}}
    assert counted == expected
    assert all(n <= min(raters[a], raters[b]) for (a, b), n in counted.items())


@pytest.mark.parametrize("limit", [1, 4, 10, 10_000])
def test_weights_of_given_pairs(spark, ratings, limit):
    rows = random_ratings(11)
    expected = brute.weights(rows, "item", "user")
    wanted = [pair for k, pair in enumerate(sorted(expected)) if k % 3] + [(100, 101)]
    pairs = spark.createDataFrame(wanted, "id1 BIGINT, id2 BIGINT")
    found = as_weights(item_pearson_of(pairs, ratings(rows), limit=limit))
    assert_same(found, {p: w for p, w in expected.items() if p in set(wanted)})


def test_support_below_two_is_refused(ratings):
    with pytest.raises(ValueError):
        co_rating_sums(ratings([]), "user", "item", min_support=1)
    rows = random_ratings(3)
    three = {p: n for p, n in brute.co_rated(rows, "user", "item").items() if n >= 3}
    assert {(r.id1, r.id2): r.n for r in co_rated_pairs(ratings(rows), "user", "item", 3).collect()} == three


def test_tolerance_drops_rounding_noise(ratings):
    rows = [(1, i, 0.1) for i in range(3)] + [(2, i, 0.1 * (i + 1)) for i in range(3)]
    assert pearson(co_rating_sums(ratings(rows), "user", "item"), tolerance=1e-12).count() == 0
    assert user_pearson(ratings(rows), tolerance=1e-12).count() == 0


@pytest.mark.parametrize("limit", [1, 4, 10_000])
def test_predictions(spark, ratings, limit):
    rows = random_ratings(5)
    known = {(u, i) for u, i, _ in rows}
    targets = [(u, i) for u in range(26) for i in range(21) if (u, i) not in known][:120]
    wanted = spark.createDataFrame(targets + targets[:5], "user BIGINT, item BIGINT")
    train = ratings(rows)

    user_weights, item_weights = user_pearson(train, limit=limit), item_pearson(train, limit=limit)
    cases = [
        (predict_user_based(train, wanted, user_weights, limit), brute.user_based, "user", "item"),
        (predict_item_based(train, wanted, item_weights, limit), brute.item_based, "item", "user"),
    ]
    overall = brute.mean(r for _, _, r in rows)
    for found, reference, entity, feature in cases:
        near = reference(rows, targets, brute.weights(rows, entity, feature))
        means = {k: brute.mean(v.values()) for k, v in brute.by(rows, entity, feature).items()}
        got = {(r.user, r.item): r for r in found.collect()}
        assert len(got) == found.count() == len(set(targets))
        for u, i in targets:
            row, own = got[u, i], u if entity == "user" else i
            if (u, i) in near:
                assert (row.fallback, row.n_neighbours) == ("none", near[u, i][1])
                assert row.prediction == pytest.approx(near[u, i][0], abs=1e-9)
            else:
                expected = means.get(own, overall)
                assert row.fallback == (f"{entity}_mean" if own in means else "global_mean")
                assert row.n_neighbours == 0 and row.prediction == pytest.approx(expected)


def test_weights_count_from_either_side_and_repeats_do_not(spark, ratings):
    rows = [(1, 0, 1.0), (1, 1, 5.0), (2, 0, 2.0), (2, 1, 4.0), (2, 2, 5.0), (3, 0, 5.0), (3, 1, 1.0), (3, 3, 4.0)]
    train = ratings(rows)
    weights = user_pearson(train)
    # Users 1 and 3 are the outer ends of the pairs (1, 2) and (2, 3).
    targets = spark.createDataFrame([(1, 2), (3, 2), (2, 3)], "user BIGINT, item BIGINT")
    found = {(r.user, r.item): r.n_neighbours for r in predict_user_based(train, targets, weights).collect()}
    assert found == {(1, 2): 1, (3, 2): 1, (2, 3): 1}


def test_empty_train_and_targets(spark, ratings):
    empty = ratings([])
    none = user_pearson(empty)
    targets = spark.createDataFrame([(1, 1)], "user BIGINT, item BIGINT")
    assert tuples(predict_user_based(empty, targets, none), "user", "item", "prediction") == [(1, 1, None)]
    full = ratings([(1, 1, 2.0)])
    assert predict_item_based(full, targets.limit(0), none).count() == 0
    assert tuples(predict_mean(full, targets, "user"), "prediction", "fallback") == [(2.0, "user_mean")]


def test_same_result_under_any_partitioning(ratings):
    df = ratings(random_ratings(2))
    one = tuples(user_pearson(df.coalesce(1)), "id1", "id2", "n", "w")
    assert one == tuples(user_pearson(df.repartition(7)), "id1", "id2", "n", "w")


def centred_weights(rows):
    """Two-pass Pearson weights of users by exact fractions."""
    from fractions import Fraction

    by_user = {}
    for u, i, r in rows:
        by_user.setdefault(u, {})[i] = Fraction(r)
    expected = {}
    for a in by_user:
        for b in by_user:
            both = sorted(by_user[a].keys() & by_user[b].keys())
            if a >= b or len(both) < 2:
                continue
            x, y = ([by_user[u][i] for i in both] for u in (a, b))
            mx, my = sum(x) / len(x), sum(y) / len(y)
            cxy = sum((p - mx) * (q - my) for p, q in zip(x, y))
            cxx, cyy = sum((p - mx) ** 2 for p in x), sum((q - my) ** 2 for q in y)
            if cxx and cyy and cxy:
                expected[a, b] = (len(both), float(cxy) / (float(cxx) ** 0.5 * float(cyy) ** 0.5))
    return expected


@pytest.mark.parametrize("limit", [1, 20, 10_000])
def test_centred_weights_of_ratings_far_from_zero(ratings, limit):
    rng = random.Random(3)
    rows = [(u, i, 1e7 + rng.random()) for u, i, _ in random_ratings(5)]
    expected = centred_weights(rows)
    found = as_weights(user_pearson(ratings(rows), limit=limit, centred=True))
    assert found.keys() == expected.keys()
    assert all(found[k][0] == n and found[k][1] == pytest.approx(w, abs=1e-5) for k, (n, w) in expected.items())
    sums = as_weights(user_pearson(ratings(rows), limit=limit))
    assert any(k not in sums or abs(sums[k][1] - w) > 0.1 for k, (_, w) in expected.items())


def test_centred_weights_of_whole_ratings_are_those_of_the_sums(ratings):
    df = ratings(random_ratings(11))
    assert_same(as_weights(item_pearson(df, centred=True)), as_weights(item_pearson(df)))
    pairs = item_pearson(df).select("id1", "id2")
    assert_same(as_weights(item_pearson_of(pairs, df, centred=True)), as_weights(item_pearson_of(pairs, df)))


def test_centred_weights_of_odd_ratings(ratings):
    rows = [(1, 0, 0.1), (1, 1, 0.1), (1, 2, 0.1), (2, 0, 1.0), (2, 1, 5.0), (2, 2, 7.0)]
    assert user_pearson(ratings(rows), centred=True).count() == 0
    rows += [(3, 0, float("inf")), (3, 1, 1.0), (4, 0, float("nan")), (4, 1, 2.0), (5, 0, None), (5, 1, 1.0)]
    assert user_pearson(ratings(rows), centred=True).count() == 0
    assert user_pearson(ratings([]), centred=True).count() == 0


def test_sums_of_pairs_are_not_moved(ratings):
    """Pairs are made behind the last shuffle, where their sums stay."""
    for centred in (False, True):
        plan = item_pearson(ratings(random_ratings(3)), centred=centred)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(id1" in plan
        assert "id1#" in plan and not re.search(r"Exchange hashpartitioning\(id1#\d+\w*, id2", plan)


@pytest.mark.parametrize("shift", [0, 2**31 - 10, -(2**40)])
@pytest.mark.parametrize("share", [0.0, 0.1])
def test_ids_and_ratings_of_any_size(ratings, shift, share):
    """Also ids beyond 32 bits and ratings that no float holds."""
    plain = random_ratings(11)
    rows = [(u + shift, i - shift, r + share) for u, i, r in plain]
    expected = {(a + shift, b + shift): w for (a, b), w in as_weights(user_pearson(ratings(plain))).items()}
    assert expected
    assert_same(as_weights(user_pearson(ratings(rows), centred=True)), expected)


def test_repeated_ratings_count_each_and_never_pair_with_themselves(ratings):
    rows = [(1, 1, 1.0), (1, 1, 2.0), (1, 2, 5.0), (2, 1, 3.0), (2, 2, 4.0), (2, 2, 4.0)]
    got = {(r.id1, r.id2): tuple(r)[2:] for r in co_rating_sums(ratings(rows), "user", "item").collect()}
    assert got == {(1, 2): (4, 13.0, 14.0, 49.0, 55.0, 50.0)}


@pytest.mark.parametrize(
    "id,rating,coded",
    [(900, 0.0, True), (2**24 - 1, 127.0, True), (2**24, 3.5, False), (-1, 3.5, False), (900, 127.5, False), (900, 0.25, False)],
)
def test_common_ratings_are_one_number_each(ratings, id, rating, coded):
    """Ids of 24 bits and half ratings go as one int, others as they are; sums are the same."""
    rows = [(u, i, r) for u, i, r in random_ratings(7) if u not in (id, 0)] + [(id, 1, rating), (id, 2, 2.5), (0, 1, 0.5), (0, 2, 4.0)]
    sums = co_rating_sums(ratings(rows), "user", "item")
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert ("shiftleft" in plan) == coded
    kept, expected = {(u, i): r for u, i, r in rows}, {}
    assert len(kept) == len(rows)
    for (u, i), x in kept.items():
        for v in {v for v, j in kept if j == i and v > u}:
            y, s = kept[v, i], expected.setdefault((u, v), [0] * 6)
            expected[u, v] = [a + b for a, b in zip(s, (1, x, y, x * y, x * x, y * y))]
    assert {tuple(r)[:2]: list(tuple(r)[2:]) for r in sums.collect()} == {k: s for k, s in expected.items() if s[0] > 1}


def test_real_ratings_are_moved_as_two_arrays(ratings):
    from affinis.operators import neighbours as N

    for value, kinds in ((0.5, ["array<int>"]), (0.1, ["array<int>", "array<double>"])):
        short = N._short(N._rows(ratings([(1, 1, value), (2, 1, 4.0)]), "item", "user"))
        listed = short.rows.groupBy("f").agg(N.F.collect_list(N.F.struct("id", "r")).alias("l"))
        moved = listed.select(*[N.F.transform("l", entry).alias(name) for name, entry in short.arrays.items()])
        assert [kind for _, kind in moved.dtypes] == kinds
