"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

A document is a bag of the hashes of its words and word pairs.  Its weight is the ratio
of its probabilities under the model of the target texts and that of all texts; rows
are sampled without replacement in proportion to their weights, by the largest sums
of log-weight and Gumbel noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.labels import SAMPLE, among, share, target_ids
from affinis.llm.text import add_columns, byte_class, find_words, owner, row_groups, text_bytes, window_hashes
from affinis.plans import stage

BUCKETS = 1 << 16
# Added to every bucket's count in both models.
SMOOTHING = 1.0
# Bins of one round of the search for the k-th key, and keys per unit of log-weight.
BINS = 4096
UNIT = 1 << 24

WORD = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


class Features(NamedTuple):
    buckets: np.ndarray
    rows: np.ndarray


def features(texts: pa.Array) -> Features:
    """Buckets of all words and word pairs of some texts, with the row each comes from."""
    words = find_words(*text_bytes(texts), WORD)
    row = owner(words.first)
    pairs = window_hashes(words.hashes, 2)
    inside = row[1:] == row[:-1]
    hashes = np.concatenate([words.hashes, pairs[inside]])
    return Features((hashes >> np.uint64(48)).astype(np.int64), np.concatenate([row, row[1:][inside]]))


def learn(docs: DataFrame, target: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log-ratio of target and raw probability of each bucket.

    The raw model counts all of ``docs`` (doc_id, text), the target model the rows
    whose id is in ``target``.  Each task sends one row a bucket, the driver gets
    as many.
    """
    shared = docs.sparkSession.sparkContext.broadcast(target)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, chosen = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in row_groups(offsets):
                found = features(batch.column(1).slice(a, b - a))
                raw += np.bincount(found.buckets, minlength=BUCKETS)
                good = among(batch.column(0).slice(a, b - a), shared.value)
                chosen += np.bincount(found.buckets[good[found.rows]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        columns = [pa.array(some.astype(np.int32)), pa.array(raw[some]), pa.array(chosen[some])]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "raw", "target"])

    counted = docs.select("doc_id", "text").mapInArrow(count, "bucket INT, raw BIGINT, target BIGINT")
    total = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    models = []
    for name in ("target", "raw"):
        counts = np.full(BUCKETS, smoothing)
        counts[total["bucket"]] += total[name]
        models.append(np.log(counts / counts.sum()))
    return models[0] - models[1]


def weigh(docs: DataFrame, ratio: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``n_features`` and ``log_weight``, the sum of its features' log-ratios; null without features."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(texts: pa.Array) -> list:
        found = features(texts)
        n = np.bincount(found.rows, minlength=len(texts))
        weight = np.bincount(found.rows, shared.value[found.buckets], minlength=len(texts))
        return [n, pa.array(weight, mask=n == 0)]

    return add_columns(docs, [text], lambda: score, "n_features BIGINT, log_weight DOUBLE")


def kth_largest(keys: DataFrame, key: str, k: int) -> int | None:
    """The k-th largest of a BIGINT column (nulls left out), or None where there are fewer; by counts of bins.

    Each round is one aggregation to at most ``BINS`` rows, and narrows the range to one bin.
    """
    keys = keys.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if k < 1 or n < k:
        return None
    while low < high:
        width = (high - low) // BINS + 1
        bins = keys.filter(F.col("key").between(low, high)).groupBy(F.expr(f"(key - ({low}L)) div {width}L").alias("bin"))
        for place, count in sorted(((r[0], r[1]) for r in bins.count().collect()), reverse=True):
            if count >= k:
                low, high = low + place * width, min(high, low + (place + 1) * width - 1)
                break
            k -= count
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` with ``n_features``, ``log_weight``, ``noisy_weight`` and ``kept``.

    Samples ``k`` rows without replacement; by default as many as there would be
    if ``docs`` had the labelled rows' share of quality 1 and not toxic.  The noise
    follows from seed and id alone, so rows of one id and text have one fate: all
    of those with the last key stay, also beyond ``k``.  Texts without a word have
    null weights and are never kept.  Without target rows nothing is known and all
    weights compare an even model with the raw one.  Fitted on ``sample`` labelled
    rows and all texts.  Stages weights, so it runs jobs when called.
    """
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ratio = learn(plain, target_ids(labels, sample))
    known = [c for c in docs.columns if c not in ("n_features", "log_weight", "noisy_weight", "kept")]
    uniform = (F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    found = weigh(docs.select(known), ratio, text).withColumn("noisy_weight", F.col("log_weight") - F.log(-F.log(uniform)))
    found = stage(found)
    key = F.round(F.col("noisy_weight") * UNIT).cast("bigint")
    if k is None:
        k = round(share(labels) * found.count())
    last = kth_largest(found.select(key.alias("key")), "key", k)
    kept = F.coalesce(key >= last, F.lit(False)) if last is not None else F.col("log_weight").isNotNull() & F.lit(k > 0)
    return found.withColumn("kept", kept)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: its features, weights and whether it is in the sample."""
    return resample(docs.select("doc_id", "text"), labels).drop("text")
