import math
import random

import numpy as np
import pandas as pd
import pytest

from affinis.llm import labels as lb
from affinis.llm import quality as q
from affinis.llm.text import read
from tests.conftest import SF

from .data import by_id, frame, passage


def make_labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


ROWS = [(k, passage(k, 20)) for k in range(40)] + [(100 + k, "junk " * 20 + passage(k, 5)) for k in range(20)]
ROWS += [(200, None), (201, ""), (202, "?!"), (None, "a b"), (5, ROWS[5][1])]
LABELS = [(k, 1, 0) for k in range(30)] + [(k, 0, 0) for k in range(100, 110)] + [(None, 1, 0), (30, None, 0), (31, 1, 1)]


def test_weights_by_hand(spark):
    """Counts of every feature in the target rows and in all rows, by a plain loop."""
    docs = frame(spark, ROWS).repartition(3)
    target = set(range(30))
    raw, good, each = np.zeros(q.BUCKETS), np.zeros(q.BUCKETS), {}
    import pyarrow as pa

    for doc_id, text in ROWS:
        found = q.features(pa.array([text], pa.string())).buckets
        each[doc_id] = found
        np.add.at(raw, found, 1)
        if doc_id in target:
            np.add.at(good, found, 1)
    ratio = np.log((good + 1) / (good + 1).sum()) - np.log((raw + 1) / (raw + 1).sum())
    result = by_id(q.resample(docs, make_labels(spark, LABELS), k=20), "n_features", "log_weight")
    for doc_id, (n, weight) in result.items():
        assert n == each[doc_id].size
        assert weight is None if not n else math.isclose(weight, ratio[each[doc_id]].sum(), abs_tol=1e-9)


def test_features_do_not_cross_texts():
    import pyarrow as pa

    both = q.features(pa.array(["a B", None, "b c"], pa.string()))
    assert np.bincount(both.rows).tolist() == [3, 0, 3]
    alone = q.features(pa.array(["a b"], pa.string())).buckets
    assert sorted(both.buckets[both.rows == 0]) == sorted(alone)


@pytest.mark.parametrize("k", [0, 1, 10, 61, 1000])
def test_top_k(spark, k):
    result = q.resample(frame(spark, ROWS), make_labels(spark, LABELS), k=k).toPandas()
    weighted = result.dropna(subset="log_weight").sort_values("noisy_weight", ascending=False)
    # The repeated row has the key of its first occurrence.
    cut = weighted.noisy_weight.iloc[min(k, len(weighted)) - 1] if k else np.inf
    assert result.kept.tolist() == (result.noisy_weight >= cut).tolist()
    assert k <= result.kept.sum() <= k + 1 or k > len(weighted)


def test_kth_largest(spark):
    rng = random.Random(1)
    values = [rng.randrange(-(10**15), 10**15) for _ in range(200)] + [7] * 50 + [None] * 3
    keys = spark.createDataFrame([(v,) for v in values], "key BIGINT")
    ranked = sorted((v for v in values if v is not None), reverse=True)
    for k in (1, 2, 100, 125, 249, 250):
        assert q.kth_largest(keys, "key", k) == ranked[k - 1]
    assert q.kth_largest(keys, "key", 251) is None and q.kth_largest(keys.limit(0), "key", 1) is None


def test_noise_samples_in_proportion(spark):
    """Rows of equal weight are drawn alike often over many seeds."""
    docs = frame(spark, [(k, "same text") for k in range(8)])
    empty = make_labels(spark, [])
    drawn = [r.doc_id for seed in range(40) for r in q.resample(docs, empty, k=2, seed=seed).filter("kept").collect()]
    assert len(drawn) == 80 and pd.Series(drawn).value_counts().reindex(range(8), fill_value=0).min() >= 3


def test_clean_documents_are_preferred(spark):
    labels = read(spark, SF, "labels")
    result = q.digest(read(spark, SF, "documents"), labels).join(labels, "doc_id").toPandas()
    clean = (result.quality == 1) & (result.toxic == 0)
    assert result[clean].kept.mean() > 0.85 > result[~clean].kept.mean()


def test_edges(spark):
    docs = frame(spark, ROWS).selectExpr("doc_id", "text", "1 AS kept")
    assert q.resample(docs, make_labels(spark, LABELS)).columns == ["doc_id", "text", "n_features", "log_weight", "noisy_weight", "kept"]
    assert q.digest(frame(spark, []), make_labels(spark, LABELS)).count() == 0
    assert lb.target_ids(make_labels(spark, LABELS), 7).size == 7 and lb.share(make_labels(spark, [])) == 1
