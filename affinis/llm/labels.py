"""Documents that labels call good, as the target of models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most labelled documents that a target model is fitted on, by hash of the id.
SAMPLE = 20_000


def good_ids(labels: DataFrame) -> DataFrame:
    """``doc_id``: all documents of quality 1 that aren't toxic, once each.

    Rows with a null id or quality are left out, a null ``toxic`` counts as 0.
    """
    return labels.filter("doc_id is not null and quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct()


def target_ids(labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Ascending ids of up to ``sample`` of ``good_ids``."""
    chosen = good_ids(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()
    return np.sort(chosen["doc_id"].to_numpy(np.int64))


def marked(docs: DataFrame, target: DataFrame | np.ndarray) -> DataFrame:
    """``docs`` with ``good``: whether ``doc_id`` is in ``target``, distinct ids as rows or as an array; a null never is.

    Ids are joined, never broadcast, as they grow with the documents.
    """
    if isinstance(target, np.ndarray):
        target = docs.sparkSession.createDataFrame([(int(i),) for i in target], "doc_id BIGINT")
    found = target.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(True).alias("good"))
    return docs.join(found.hint("merge"), "doc_id", "left").withColumn("good", F.coalesce("good", F.lit(False)))


def share(labels: DataFrame) -> float:
    """Share of quality 1 and not toxic among the rows with a quality; 1 where there are none."""
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1.0).otherwise(0.0)
    found = labels.filter("quality is not null").agg(F.avg(good)).first()[0]
    return 1.0 if found is None else found


def among(ids: pa.Array, chosen: np.ndarray) -> np.ndarray:
    """Whether each id is one of ``chosen`` (ascending); a null never is."""
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    known = np.asarray(ids.is_valid())
    if not chosen.size:
        return np.zeros(values.size, bool)
    at = np.minimum(np.searchsorted(chosen, values), chosen.size - 1)
    return known & (chosen[at] == values)
