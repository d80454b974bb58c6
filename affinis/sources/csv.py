"""Ratings in comma-separated text, and the sorted text sink."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from affinis.plans.staging import stage

# Column order of the files is fixed: user, item, rating, then columns nobody reads.
RATING_SCHEMA = "user BIGINT, item BIGINT, rating DOUBLE"


def read_ratings(
    spark: SparkSession,
    path: str,
    extra_columns: int = 0,
    header: bool = True,
    skip_lines_with: str | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read ``user,item,rating[,extra...]`` lines as ``user, item, rating``.

    ``header`` drops the first line of every file.  ``skip_lines_with`` drops
    each line that contains the text instead, wherever it stands, for inputs
    whose header may be repeated.  ``extra_columns`` says how many trailing
    columns follow the rating; they are not parsed.  A line is malformed if it has
    more or fewer fields, a field that is no number, or an empty one of the three:
    ``FAILFAST`` raises on it, ``DROPMALFORMED`` drops it, and ``PERMISSIVE`` gives
    nulls for what can't be read.
    """
    if mode not in ("FAILFAST", "PERMISSIVE", "DROPMALFORMED"):
        raise ValueError(f"unknown mode {mode}")
    schema = RATING_SCHEMA + "".join(f", _extra{i} STRING" for i in range(extra_columns)) + ", _malformed STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    if skip_lines_with is None:
        # All columns are parsed, as the fields of a line are only counted then.
        reader = spark.read.schema(schema).options(header=header, columnPruning=False, **options)
        rows = reader.csv(path)
    else:
        lines = spark.read.text(path).filter(~F.col("value").contains(skip_lines_with))
        rows = lines.select(F.from_csv("value", schema, options).alias("row")).select("row.*")
    return _checked(rows, ["user", "item", "rating"], mode)


def _checked(rows: DataFrame, required: list[str], mode: str) -> DataFrame:
    """``required`` columns of parsed rows, malformed ones treated as ``mode`` says."""
    if mode == "PERMISSIVE":
        return rows.select(*required)
    bad = F.col("_malformed").isNotNull()
    for name in required:
        bad |= F.col(name).isNull()
    if mode == "DROPMALFORMED":
        return rows.filter(~bad).select(*required)
    line = F.coalesce("_malformed", F.concat_ws(",", *required))
    error = F.raise_error(F.concat(F.lit("malformed line: "), line))
    return rows.select(*[F.when(bad, error.cast(rows.schema[c].dataType)).otherwise(F.col(c)).alias(c) for c in required])


class Quarantine(NamedTuple):
    """Good rows, bad lines and how many there are of each."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def read_ratings_apart(spark: SparkSession, path: str, extra_columns: int = 0, header: bool = True) -> Quarantine:
    """``read_ratings`` that keeps the lines it can't use: ``good`` has ``user, item, rating``.

    ``bad`` has ``file, line, reason, value``: the file, the place of the line among
    the file's lines (without header and blank lines, from 1), ``fields`` for too many,
    too few or unreadable fields or ``empty`` for an empty one of the three,
    and the line, of an ``empty`` one only the fields that are read.  ``counts`` are ``lines``, ``good``, ``bad``.
    The input is parsed once: one job writes what it gives to a staged table and
    counts as it goes, and good and bad rows are read from there.
    """
    required = ["user", "item", "rating"]
    schema = RATING_SCHEMA + "".join(f", _extra{i} STRING" for i in range(extra_columns)) + ", _malformed STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed", "columnPruning": False}
    rows = spark.read.schema(schema).options(header=header, **options).csv(path)
    empty = F.lit(False)
    for name in required:
        empty |= F.col(name).isNull()
    reason = F.when(F.col("_malformed").isNotNull(), "fields").when(empty, "empty")
    fields = F.array_join(F.transform(F.array(*[F.col(c).cast("string") for c in required]), lambda x: F.coalesce(x, F.lit(""))), ",")
    told = rows.select(
        *required,
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.coalesce("_malformed", fields)).alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    seen = Observation()
    count = F.count("*")
    parsed = stage(told.observe(seen, count.alias("lines"), F.count("reason").alias("bad")))
    blocks = parsed.groupBy("file", "start").agg(F.min("place").alias("first"), count.alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    line = (F.col("before") + F.col("place") - F.col("first") + 1).alias("line")
    bad = parsed.filter("reason IS NOT NULL").join(blocks, ["file", "start"]).select("file", line, "reason", "value")
    counts = seen.get
    counts = {"lines": counts["lines"], "good": counts["lines"] - counts["bad"], "bad": counts["bad"]}
    return Quarantine(parsed.filter("reason IS NULL").select(*required), bad, counts)


def read_pairs(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Known pairs ``a,b`` in either order as distinct ``id1 < id2``, such as a ground truth; malformed lines raise."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed", "columnPruning": False}
    rows = spark.read.schema("a BIGINT, b BIGINT, _malformed STRING").options(header=header, **options).csv(path)
    rows = _checked(rows, ["a", "b"], "FAILFAST")
    return rows.filter("a <> b").select(F.least("a", "b").alias("id1"), F.greatest("a", "b").alias("id2")).distinct()


def write_sorted(df: DataFrame, path: str, keys: list[str], header: bool = False) -> None:
    """Write ``df`` as CSV in total order of ``keys``.

    ``orderBy`` range-partitions, so the files read in name order are one
    sorted sequence; nothing passes through a single task.
    """
    df.orderBy(*keys).write.option("header", header).csv(path)
