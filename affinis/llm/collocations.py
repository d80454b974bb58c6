"""Phrases whose words meet more often than chance, per language.

Every position of a text starts one window of up to ``LONGEST`` words of its piece,
padded where the piece ends.  Only these windows are counted; ROLLUP sums their counts
over ever shorter prefixes, which gives the count of every phrase, because each
occurrence of a phrase is the prefix of exactly one window.

Before that, passes find the words, pairs and longer runs of words that are frequent
enough to be part of a frequent phrase at all; a window ends before the first that is
not.  What these passes know are hashes in tables of bits of bounded size.  Hashes that
are equal can only keep a window longer than needed: counts are made of the words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.text import LOWER, Words, byte_class, find_words, mix, owner, row_groups, small_batches, text_bytes
from affinis.plans import stage
from affinis.plans.skew import lookup_join

LONGEST = 5
LEAST = 100
TOP = 2000
# Bytes of text whose windows are counted together in a task.
GROUP_BYTES = 8 << 20
# Bits of the largest table of hashes (32 MB); one page of Spark's bitmaps has 32,768 bits.
TABLE_BITS = 28
PAGE_BITS = 15
# Bits of the hashes of runs, and different runs that a task counts before it hands them on.
HASH_BITS = 40
COUNTED = 2_000_000
# Runs of up to so many words are looked for before windows are made.
KNOWN = 5

BREAK = byte_class([(0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?")])
WORD = ~(BREAK | byte_class([(0x09, 0x09), (0x20, 0x20)]))
NO_LANGUAGE = "und"


class Tokens(NamedTuple):
    """Words of some texts: exact codes into ``words``, hashes with their language, and which have a next word."""

    words: pa.Array
    codes: np.ndarray
    languages: pa.Array
    language: np.ndarray
    hashes: np.ndarray
    followed: np.ndarray


def _word_array(data: np.ndarray, found: Words) -> pa.Array:
    """The lower-cased words as strings; they are the bytes of ``WORD``, end to end."""
    joined = LOWER[data[WORD[data]]]
    offsets = np.zeros(found.starts.size + 1, np.int64)
    np.cumsum(found.ends - found.starts, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(found.starts.size, pa.py_buffer(offsets), pa.py_buffer(joined))


def tokens(text: pa.Array, lang: pa.Array) -> Tokens:
    data, offsets = text_bytes(text)
    found = find_words(data, offsets, WORD)
    coded = _word_array(data, found).dictionary_encode()
    langs = lang.fill_null(NO_LANGUAGE).dictionary_encode()
    row = owner(found.first)
    language = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
    piece = np.searchsorted(np.flatnonzero(BREAK[data]), found.starts)
    followed = np.zeros(row.size, bool)
    followed[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    hashes = mix(found.hashes ^ _salts(langs.dictionary)[language])
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Tokens(coded.dictionary, codes, langs.dictionary, language, hashes, followed)


def run_hashes(t: Tokens, width: int) -> np.ndarray:
    """Hash of each word with the ``width - 1`` after it; not to be used where the text ends before that."""
    found = t.hashes
    for k in range(1, width):
        found = mix(found * np.uint64(0x9E3779B97F4A7C15) + np.roll(t.hashes, -k))
    return found


def _together(goes_on: np.ndarray, steps: int) -> np.ndarray:
    """Where ``goes_on`` holds for ``steps`` places in a row."""
    found = goes_on.copy()
    for k in range(1, steps):
        found[: found.size - k] &= goes_on[k:]
        found[max(0, found.size - k) :] = False
    return found


def _token_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    """Tokens of groups of texts, from batches of text and lang."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(0))
        for a, b in row_groups(offsets, GROUP_BYTES):
            t = tokens(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a))
            if t.codes.size:
                yield t


def _each_group(docs: DataFrame, make: Callable[[], Callable[[Tokens], dict[str, object]]], schema: str) -> DataFrame:
    """Rows that a function makes of the tokens of each group of texts; ``docs`` has text and lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for t in _token_groups(batches):
            yield pa.RecordBatch.from_pydict(apply(t))

    return docs.mapInArrow(run, schema)


def _text(array: pa.Array, at: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    return array.take(pa.array(at, pa.int64(), mask=missing)).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, f`` of every word, counted by groups of texts first."""

    def make():
        def apply(t: Tokens) -> dict[str, object]:
            keys, n = np.unique(t.language * len(t.words) + t.codes, return_counts=True)
            lang, word = np.divmod(keys, len(t.words))
            return {"lang": _text(t.languages, lang), "word": _text(t.words, word), "f": pa.array(n, pa.int64())}

        return apply

    counted = _each_group(docs, make, "lang STRING, word STRING, f BIGINT")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


class BitTable(NamedTuple):
    """A set of hashes by their first ``bits`` bits; it may hold more than was put in."""

    bits: int
    table: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.bits)).view(np.int64)
        return (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bit_table(hashes: DataFrame, count: int, most: int = TABLE_BITS) -> BitTable:
    """Table of the ``count`` values of column ``h``, of ``HASH_BITS`` bits: about 16 bits for each, 2 ** ``most`` at most.

    Spark fills the pages; the driver only puts them side by side.
    """
    bits = min(most, max(PAGE_BITS, (16 * max(1, count)).bit_length()))
    at = F.shiftright("h", HASH_BITS - bits)
    pages = hashes.groupBy(F.shiftright(at, PAGE_BITS).alias("page")).agg(
        F.bitmap_construct_agg(F.pmod(at, F.lit(1 << PAGE_BITS))).alias("bitmap")
    )
    table = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (PAGE_BITS - 3)
    for row in pages.collect():
        table[row.page * size : (row.page + 1) * size] = np.frombuffer(row.bitmap, np.uint8)
    return BitTable(bits, table)


def _salts(languages: pa.Array) -> np.ndarray:
    """A hash for each language, 0 for that of an empty name."""
    names = find_words(*text_bytes(languages), np.ones(256, bool), lower=False)
    salts = np.zeros(len(languages), np.uint64)
    salts[owner(names.first)] = names.hashes
    return salts


def _hashed(words: DataFrame) -> DataFrame:
    """Column ``h``: the hashes that ``tokens`` gives ``lang, word``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find_words(*text_bytes(batch.column(1)), np.ones(256, bool), lower=False)
            h = mix(found.hashes ^ _salts(batch.column(0)))
            yield pa.RecordBatch.from_pydict({"h": pa.array((h >> np.uint64(64 - HASH_BITS)).view(np.int64))})

    return words.select("lang", "word").mapInArrow(run, "h BIGINT")


def _possible(t: Tokens, known: list[BitTable]) -> np.ndarray:
    """Where a run of ``len(known) + 1`` words starts of which all shorter runs may be frequent.

    ``known`` has the tables of frequent words, pairs and so on.
    """
    width = len(known) + 1
    possible = _together(t.followed, width - 1)
    for k, table in enumerate(known):
        at = np.flatnonzero(possible)
        for i in range(width - k):
            hashes = run_hashes(t, k + 1) if i == 0 else hashes
            at = at[table.has(hashes[at + i])]
        possible = np.zeros(possible.size, bool)
        possible[at] = True
    return possible


def frequent_runs(docs: DataFrame, known: list[BitTable], least: int) -> DataFrame:
    """Hashes ``h`` of all runs of ``len(known) + 1`` words that occur ``least`` times or more (and of few others).

    Runs are counted in the tasks before the shuffle, ``COUNTED`` different ones at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        h, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return h, np.bincount(where, np.concatenate([p[1] for p in parts]), h.size).astype(np.int64)

    def rows(h: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, h.size, COUNTED // 8):
            part = slice(a, a + COUNTED // 8)
            yield pa.RecordBatch.from_pydict({"h": pa.array(h[part].view(np.int64)), "n": pa.array(n[part])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for t in _token_groups(batches):
            found = run_hashes(t, len(shared.value) + 1)[_possible(t, shared.value)]
            parts.append(np.unique(found >> np.uint64(64 - HASH_BITS), return_counts=True))
            if sum(p[0].size for p in parts) > COUNTED:
                parts = [merged(parts)]
                if parts[0][0].size > COUNTED // 2:
                    yield from rows(*parts.pop())
        if parts:
            yield from rows(*merged(parts))

    counted = docs.mapInArrow(run, "h BIGINT, n BIGINT").groupBy("h").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least).select("h")


def windows(docs: DataFrame, known: list[BitTable], longest: int) -> DataFrame:
    """``lang, w1 ... , n``: how often each window of two words or more starts a position; shorter ones end in nulls.

    A window ends with its piece, after ``longest`` words or before the word that
    ends a run which is not in its table of ``known``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)
    columns = [f"w{k + 1}" for k in range(longest)]

    def lead_windows(t: Tokens, known: list[BitTable]) -> pa.Table:
        # Where runs of two words, three and so on may be frequent; the last holds for longer ones step by step.
        runs = [_possible(t, known[:k]) & known[k].has(run_hashes(t, k + 1)) for k in range(1, len(known))]
        at = np.flatnonzero(runs[0])
        lead, inside = {"lang": t.language[at], "w1": t.codes[at]}, np.ones(at.size, bool)
        for k in range(1, longest):
            width = min(k, len(runs))
            inside &= runs[width - 1][np.minimum(at + k - width, t.codes.size - 1)]
            lead[columns[k]] = np.where(inside, t.codes[np.minimum(at + k, t.codes.size - 1)], -1)
        table = pa.table(lead).group_by(list(lead), use_threads=False).aggregate([([], "count_all")])
        made = {name: table.column(name).to_numpy() for name in lead}
        out = {"lang": _text(t.languages, made["lang"])}
        out |= {name: _text(t.words, made[name].clip(0), made[name] < 0) for name in columns}
        return pa.table(out | {"n": table.column("count_all").cast(pa.int64())})

    def merged(parts: list[pa.Table]) -> pa.Table:
        whole = pa.concat_tables(parts).group_by(["lang", *columns], use_threads=False)
        return whole.aggregate([("n", "sum")]).rename_columns(["lang", *columns, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for t in _token_groups(batches):
            parts.append(lead_windows(t, shared.value))
            if sum(p.num_rows for p in parts) > COUNTED // 8:
                parts = [merged(parts)]
                if parts[0].num_rows > COUNTED // 16:
                    yield from parts.pop().to_batches(COUNTED // 32)
        if parts:
            yield from merged(parts).to_batches(COUNTED // 32)

    schema = "lang STRING, " + ", ".join(f"{name} STRING" for name in columns) + ", n BIGINT"
    counted = docs.mapInArrow(run, schema)
    return counted.groupBy("lang", *columns).agg(F.sum("n").alias("n"))


def phrase_counts(counted: DataFrame, longest: int, least: int) -> DataFrame:
    """``lang, words, a`` of every phrase of two words or more that occurs ``least`` times, from its windows.

    One ROLLUP: each set of columns is a prefix of the windows.  A prefix that
    ends in padding is no phrase; the shorter prefix has its count.
    """
    rest = [f"w{k + 1}" for k in range(2, longest)]
    rolled = counted.select(F.struct("lang", "w1", "w2").alias("lead"), *rest, "n").rollup("lead", *rest).agg(
        F.sum("n").alias("a"), F.grouping_id().alias("gid")
    )
    # gid has one bit a column, set where the column is summed over: 0 is the whole window.
    last = [(0, rest[-1])] if rest else []
    last += [((1 << k) - 1, rest[-1 - k]) for k in range(1, len(rest))]
    padded = F.lit(False)
    for gid, name in last:
        padded = padded | ((F.col("gid") == gid) & F.col(name).isNull())
    found = rolled.filter((F.col("a") >= least) & (F.col("gid") < (1 << len(rest))) & F.col("lead").isNotNull() & ~padded)
    whole = F.array_compact(F.array("lead.w1", "lead.w2", *rest))
    return found.select("lead.lang", whole.alias("words"), "a")


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def _named(parts: DataFrame, phrase: str, count: str) -> DataFrame:
    return parts.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(count))


def _scores(found: DataFrame, parts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of each phrase at its worst cut.

    ``found`` has ``n`` of its language, ``parts`` the count ``f`` of every phrase and word that a cut can leave.
    """
    cuts = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cut = found.select("lang", "words", "phrase", "a", "n", cuts).select(
        "lang",
        "phrase",
        "a",
        "n",
        "k",
        _joined(F.slice("words", F.lit(1), F.col("k"))).alias("left"),
        _joined(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))).alias("right"),
    )
    # Frequent words are parts of very many phrases: both lookups split them.
    cut = lookup_join(cut, _named(parts, "left", "l"), ["lang", "left"])
    cut = lookup_join(cut, _named(parts, "right", "r"), ["lang", "right"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    exact = cut.withColumns({f"{c}_": kind for c, kind in wide.items()})
    score = F.expr("(CAST(1000 AS DECIMAL(5,0)) * (a_ * n_)) DIV (l_ * r_)")
    worst = exact.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("worst")
    )
    return worst.select("lang", "phrase", *[f"worst.{c}" for c in ("a", "l", "r", "n", "score")])


def _not_inside(found: DataFrame, percent: int) -> DataFrame:
    """``lang, phrase`` of the phrases that lie in no longer one with at least ``percent`` of their count."""
    size = F.size("words")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.greatest(size - 1, F.lit(2))),
            lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: _joined(F.slice("words", i, m))),
        )
    )
    inner = found.filter(size > 2).select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    own = found.select("lang", "phrase", F.lit(None).cast("bigint").alias("longer"), "a")
    both = own.unionByName(inner.withColumn("a", F.lit(None).cast("bigint")))
    kept = both.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("longer").alias("longer"))
    inside = F.coalesce(F.lit(100) * F.col("longer") >= F.lit(percent) * F.col("a"), F.lit(False))
    return kept.filter(F.col("a").isNotNull() & ~inside).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    percent: int = 100,
) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of all phrases of 2 to ``longest`` words that occur ``least`` times.

    ``n`` counts the words of the language, ``a`` the phrase; the cut of the phrase
    with the lowest ``floor(1000 * a * n / (l * r))`` gives ``l``, ``r`` and
    ``score``, the first one among equals.  Phrases inside a longer one with
    ``percent`` of their count or more are left out.  All counts are exact and
    cover all texts.  A null text has no words, a null language is ``und``;
    repeated rows count again, an empty table gives no rows, other columns are
    not read.  A word may be as long as a text.  Runs jobs when called.
    """
    if longest < 3 or least < 1:
        raise ValueError("windows of three words or more and counts of one or more, please")
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    word = F.when(F.col("f") >= least, F.col("word")).alias("word")
    every = stage(word_counts(texts).groupBy("lang", word).agg(F.sum("f").alias("f")))
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = every.filter("word IS NOT NULL")
    known = [bit_table(_hashed(frequent), frequent.count())]
    while len(known) < min(KNOWN, longest):
        runs = stage(frequent_runs(texts, known, least))
        known.append(bit_table(runs, runs.count()))
    counted = windows(texts, known, longest)
    found = stage(phrase_counts(counted, longest, least).withColumn("phrase", _joined(F.col("words"))))
    parts = frequent.select("lang", F.col("word").alias("phrase"), "f").unionAll(found.select("lang", "phrase", "a"))
    scored = _scores(lookup_join(found, totals, ["lang"]), parts)
    return scored.join(_not_inside(found, percent), ["lang", "phrase"], "left_semi")


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, ...``: the first ``top`` phrases of each language by score, count and phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame) -> DataFrame:
    """The first 2,000 phrases of each language."""
    return best(collocations(docs.select("text", "lang")))
