"""Small documents with the hard cases: nulls, empty and long texts, ties, repeats, clashing names."""

import random

WORDS = "the of and to in is that for with as on was it be by at from or an are this".split()


def passage(seed, n, words=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(["", "s", "ed", "ing"]) + str(rng.randrange(30)) for _ in range(n))


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING" + more)


def by_id(df, *columns):
    return {row[0]: tuple(row[1:]) for row in df.select("doc_id", *columns).collect()}
