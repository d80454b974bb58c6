"""LM scoring by cross-entropy difference: two matched bigram models over one vocabulary.

The vocabulary holds every word of all documents, or on demand the most frequent ones;
any other word is one shared unknown word.  Bigrams of groups of texts are dealt packed
into buckets by their word, where they are counted, scored and summed by text; only those
sums return to the groups.  A small vocabulary has a dense table.  A target model is counted on documents that labels call good, a
background model on all documents, both smoothed alike.  A document's score is the
mean of its tokens' losses under the target model less those under the background.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.labels import good_ids, marked, target_ids
from affinis.llm.text import (
    add_columns, byte_class, find_words, mix, owner, positional, row_groups, small_batches, text_bytes,
)
from affinis.plans import stage
from affinis.plans.skew import lookup_join

# Distinct words a task holds before it hands them on.
HELD = 500_000
# Weight of the word model in a bigram's probability, in tokens.
PRIOR = 100.0

WORD = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each word hash in a task's documents, some groups of rows at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> pa.RecordBatch:
        words, place = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        count = np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(count)], names=["word", "n"])

    for batch in batches:
        _, offsets = text_bytes(batch.column(0))
        for a, b in row_groups(offsets):
            words = find_words(*text_bytes(batch.column(0).slice(a, b - a)), WORD)
            held.append(np.unique(words.hashes, return_counts=True))
            if sum(w.size for w, _ in held) > 2_000_000:
                yield merged()
                held = []
    if held:
        yield merged()


def _flags(good: pa.Array) -> np.ndarray:
    return good.to_numpy(zero_copy_only=False)


def learn_vocabulary(docs: DataFrame, size: int) -> np.ndarray:
    """Ascending hashes of the ``size`` most frequent words of all of ``docs``; ties by hash."""
    counted = docs.select("text").mapInArrow(_count_words, "word BIGINT, n BIGINT")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return np.sort(counted.toPandas()["word"].to_numpy(np.int64).view(np.uint64))


def bigrams(texts: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous word, word and row of every token; 0 is an unknown word, the last number the start of a text."""
    words = find_words(*text_bytes(texts), WORD)
    number = np.zeros(words.hashes.size, np.int64)
    if vocabulary.size:
        at = np.minimum(np.searchsorted(vocabulary, words.hashes), vocabulary.size - 1)
        number = np.where(vocabulary[at] == words.hashes, at + 1, 0)
    before = np.roll(number, 1)
    before[words.first[:-1][np.diff(words.first) > 0]] = vocabulary.size + 1
    return before, number, owner(words.first)


def learn(
    docs: DataFrame, target: DataFrame | np.ndarray, vocabulary: np.ndarray, prior: float = PRIOR
) -> np.ndarray:
    """Losses of the target and the background model, by previous word and word.

    The background counts all of ``docs`` (doc_id, text), the target the rows whose
    id is in ``target``.  Tasks and driver hold a square of the vocabulary.
    """
    n = vocabulary.size + 1
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        cells = np.zeros((2, (n + 1) * n), np.int64)
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in row_groups(offsets):
                before, word, row = bigrams(batch.column(1).slice(a, b - a), vocabulary)
                good = _flags(batch.column(0).slice(a, b - a))[row]
                cell = before * n + word
                cells[0] += np.bincount(cell[good], minlength=cells.shape[1])
                cells[1] += np.bincount(cell, minlength=cells.shape[1])
        some = np.flatnonzero(cells[1])
        columns = [pa.array(some), pa.array(cells[0][some]), pa.array(cells[1][some])]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "target", "background"])

    counted = marked(docs.select("doc_id", "text"), target).select("good", "text")
    counted = counted.mapInArrow(count, "cell BIGINT, target BIGINT, background BIGINT")
    total = counted.groupBy("cell").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    total, losses = total.toPandas(), []
    for name in ("target", "background"):
        cells = np.zeros((n + 1) * n)
        cells[total["cell"]] = total[name]
        cells = cells.reshape(n + 1, n)
        single = (cells.sum(0) + 1) / (cells.sum() + n)
        losses.append(-np.log((cells + prior * single) / (cells.sum(1, keepdims=True) + prior)))
    return np.array(losses)


def score(docs: DataFrame, losses: np.ndarray, vocabulary: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``target_loss``, ``background_loss`` (means) and ``difference``; null without tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((losses, vocabulary))

    def apply(texts: pa.Array) -> list:
        losses, vocabulary = shared.value
        before, word, row = bigrams(texts, vocabulary)
        n = np.bincount(row, minlength=len(texts))
        means = [np.bincount(row, m[before, word], minlength=len(texts)) / np.maximum(n, 1) for m in losses]
        return [n, *(pa.array(v, mask=n == 0) for v in (*means, means[0] - means[1]))]

    spec = "n_tokens BIGINT, target_loss DOUBLE, background_loss DOUBLE, difference DOUBLE"
    return add_columns(docs, [text], lambda: apply, spec)


# The word before a text's first.
START = np.uint64(0x5354415254)
# Bigrams of texts in a bucket, on average.
BUCKET = 500_000
# Losses are whole multiples of 1 / SCALE, so that sums do not depend on their order.
SCALE = float(1 << 24)
MODELS = ("target", "background")


class Totals(NamedTuple):
    """Tokens and texts with words of both models, number of words and buckets, and the hot words (ascending hashes).

    ``count`` and ``head`` are occurrences of hot words, all and those with a next word, by model.
    """

    tokens: tuple[int, int]
    texts: tuple[int, int]
    size: int
    buckets: int
    hot: np.ndarray
    count: np.ndarray
    head: np.ndarray


def _hashed_bigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of previous word and word, and row, of every token."""
    words = find_words(*text_bytes(texts), WORD)
    before = np.roll(words.hashes, 1)
    before[words.first[:-1][np.diff(words.first) > 0]] = START
    return before, words.hashes, owner(words.first)


def _ends(row: np.ndarray) -> np.ndarray:
    """Place of the last token of each row that has tokens."""
    return np.flatnonzero(np.diff(row, append=-1) != 0)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys``, ascending, and the sums of the rows of ``values`` (columns are keys; whole numbers)."""
    keys, place = np.unique(keys, return_inverse=True)
    sums = [np.bincount(place, v, minlength=keys.size).astype(np.int64) for v in values]
    return keys, np.array(sums).reshape(len(values), keys.size)


def count_words(docs: DataFrame) -> DataFrame:
    """``word, target, background, target_end, background_end``: occurrences of every word, all and as a text's last.

    The target counts the rows of ``docs`` (text, good) that are good.
    """
    names = [*MODELS, *(f"{m}_end" for m in MODELS)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            words, sums = _sums(np.concatenate([w for w, _ in held]), np.concatenate([n for _, n in held], axis=1))
            columns = [pa.array(words.view(np.int64)), *(pa.array(n) for n in sums)]
            return pa.RecordBatch.from_arrays(columns, names=["word", *names])

        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in row_groups(offsets):
                _, words, row = _hashed_bigrams(batch.column(1).slice(a, b - a))
                good = _flags(batch.column(0).slice(a, b - a))[row]
                end = np.zeros(row.size, bool)
                end[_ends(row)] = True
                held.append(_sums(words, np.array([good, np.ones(row.size, bool), good & end, end])))
                if sum(w.size for w, _ in held) > HELD:
                    yield packed()
                    held = []
        if held:
            yield packed()

    counted = docs.select("good", "text").mapInArrow(count, ", ".join(f"{c} BIGINT" for c in ["word", *names]))
    return counted.groupBy("word").agg(*(F.sum(c).alias(c) for c in names))


def totals(words: DataFrame, bucket: int = BUCKET) -> Totals:
    """Totals of ``count_words``; a word of more than a bucket's tokens is hot, so there are no more than buckets."""
    columns = words.columns[1:]
    size, *sums = words.agg(F.count("*"), *(F.coalesce(F.sum(c), F.lit(0)) for c in columns)).first()
    hot = words.filter(F.col("background") > bucket).toPandas()
    hashes = hot["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    count, end = (hot[names].to_numpy(np.int64).T[:, order] for names in (columns[:2], columns[2:]))
    return Totals(tuple(sums[:2]), tuple(sums[2:]), size, sums[1] // bucket + 1, hashes[order], count, count - end)


def _find(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in ascending ``keys`` and whether it is there."""
    if not keys.size:
        return np.zeros(values.size, np.int64), np.zeros(values.size, bool)
    at = np.minimum(np.searchsorted(keys, values), keys.size - 1)
    return at, keys[at] == values


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays byte by byte of their items, which shuffle files compress well."""
    return b"".join(
        [np.array([a.size for a in arrays], np.int64).tobytes()]
        + [np.ascontiguousarray(a.view(np.uint8).reshape(a.size, a.itemsize).T).tobytes() for a in arrays]
    )


def _unpack(data: bytes, kinds: list[type]) -> list[np.ndarray]:
    data = np.frombuffer(data, np.uint8)
    sizes, at, arrays = data[: 8 * len(kinds)].view(np.int64), 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds):
        width = np.dtype(kind).itemsize
        part = data[at : at + size * width].reshape(width, size)
        arrays.append(np.ascontiguousarray(part.T).reshape(-1).view(kind))
        at += size * width
    return arrays


# Words and the bigrams of each; previous words; for each bigram its previous word, counts of both models and number
# of texts; texts and how often each has the bigram; last words, their counts of both models, and their texts.
ENTRIES = [np.uint64, np.uint32, np.uint64, np.uint32, np.int64, np.int64, np.uint32, np.uint32, np.uint32]
ENTRIES += [np.uint64, np.int64, np.int64, np.uint32]
SUMS = [np.uint32, np.int64, np.int64]
BLOBS = "grp BIGINT, bucket BIGINT, kind INT, data BINARY"


def _share(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash; buckets are ranges of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pack_group(texts: pa.Array, copies: np.ndarray, good: np.ndarray, t: Totals) -> tuple[np.ndarray, list]:
    """Tokens of each of some different texts, and their bigrams as (bucket, bytes)."""
    before, words, row = _hashed_bigrams(texts)
    n_tokens = np.bincount(row, minlength=len(texts))
    if not row.size:
        return n_tokens, []
    last = _ends(row)
    known, word = np.unique(words, return_inverse=True)
    prior = np.roll(word, 1)
    prior[before == START] = known.size
    # Distinct (word, previous word, text) in one number: a group's bytes bound their product to 63 bits.
    key = (word * (known.size + 1) + prior) * len(texts) + row
    key = np.sort(key)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(first, append=key.size)
    key, row_of = np.divmod(key[first], len(texts))
    word_of, prior_of = np.divmod(key, known.size + 1)
    names = np.append(known, START)
    # All bigrams of a word share a bucket, those of a hot word are dealt by the previous word.
    bucket = _share(known, t.buckets)[word_of]
    _, hot = _find(known, t.hot)
    hot = np.flatnonzero(hot[word_of])
    bucket[hot] = _share(mix(names[prior_of[hot]] ^ mix(known[word_of[hot]])), t.buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, row_of, word_of, prior_of, n = (a[order] for a in (bucket, row_of, word_of, prior_of, n))
    end_bucket = _share(words[last], t.buckets)
    order = np.argsort(end_bucket, kind="stable")
    last, end_bucket = last[order], end_bucket[order]
    blobs = []
    for k in np.union1d(bucket, end_bucket).tolist():
        a, b = np.searchsorted(bucket, [k, k + 1])
        r, w, p, m = row_of[a:b], word_of[a:b], prior_of[a:b], n[a:b]
        fresh = np.flatnonzero((np.diff(w, prepend=-1) != 0) | (np.diff(p, prepend=-1) != 0))
        w, p = w[fresh], p[fresh]
        heads = np.flatnonzero(np.diff(w, prepend=-1))
        priors, place = np.unique(p, return_inverse=True)
        sums = [np.add.reduceat(m * v[r], fresh) if fresh.size else m for v in (good, copies)]
        a, b = np.searchsorted(end_bucket, [k, k + 1])
        ends = last[a:b]
        arrays = [
            known[w[heads]], np.diff(heads, append=w.size), names[priors], place, *sums,
            np.diff(fresh, append=r.size), r, m,
            words[ends], good[row[ends]], copies[row[ends]], row[ends],
        ]
        blobs.append((k, _pack([np.asarray(v).astype(kind) for v, kind in zip(arrays, ENTRIES)])))
    return n_tokens, blobs


def packed_bigrams(docs: DataFrame, t: Totals) -> DataFrame:
    """Bigrams of ``docs`` (good, text, tid) by bucket, and one row of each group with its different texts (kind 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        # Rows of a task keep their order, so a task run again gives its groups the same numbers.
        grp = TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in row_groups(offsets):
                part = batch.slice(a, b - a)
                tids = part.column(2).dictionary_encode()
                place = tids.indices.to_numpy(zero_copy_only=False)
                _, first = np.unique(place, return_index=True)
                copies = np.bincount(place)
                good = np.bincount(place, _flags(part.column(0))).astype(np.int64)
                n_tokens, blobs = _pack_group(part.column(1).take(pa.array(first)), copies, good, t)
                digests, _ = text_bytes(tids.dictionary)
                yield _blobs([(grp, grp % t.buckets, 0, _pack([digests.copy(), n_tokens.astype(np.int64)]))])
                for k, data in blobs:
                    yield _blobs([(grp, k, 1, data)])
                grp += 1

    return docs.select("good", "text", "tid").mapInArrow(run, BLOBS)


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.int32(), pa.binary()
    columns = [pa.array(list(v), kind) for v, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["grp", "bucket", "kind", "data"])


def _word_values(words: np.ndarray, count: np.ndarray, end: np.ndarray, t: Totals) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of ascending ``words`` in each model, all and before another word; hot ones as known."""
    head = count - end
    at, hot = _find(words, t.hot)
    count[:, hot], head[:, hot] = t.count[:, at[hot]], t.head[:, at[hot]]
    return count, head


def bucket_sums(blobs: list[bytes], t: Totals, prior: float = PRIOR) -> list[bytes]:
    """For each packed part of one bucket its texts with the sums of their losses, in whole units.

    The loss of a bigram is the log of the previous word's count less that of its own
    smoothed count.  The former is added at the previous word's own bucket: once for
    each of its occurrences but those that end a text.
    """
    parts = [_unpack(data, ENTRIES) for data in blobs]
    words, priors, ends = (np.unique(np.concatenate([p[k] for p in parts]), return_inverse=True) for k in (0, 2, 9))
    known = np.union1d(words[0], ends[0])
    # Numbers of words and previous words over the whole bucket.
    word = np.searchsorted(known, words[0])[words[1]]
    end = np.searchsorted(known, ends[0])[ends[1]]
    n_priors = [p[2].size for p in parts]
    shift = np.repeat(np.cumsum([0, *n_priors[:-1]]), [p[3].size for p in parts])
    before = priors[1][np.concatenate([p[3] for p in parts]).astype(np.int64) + shift]
    word = np.repeat(word, np.concatenate([p[1] for p in parts]).astype(np.int64))
    counts = np.array([np.concatenate([p[k] for p in parts]) for k in (4, 5)])
    single = np.array([np.bincount(word, c, minlength=known.size) for c in counts])
    final = np.array([np.bincount(end, np.concatenate([p[k] for p in parts]), minlength=known.size) for k in (10, 11)])
    single, head = _word_values(known, single, final, t)
    key, place = np.unique(word * max(priors[0].size, 1) + before, return_inverse=True)
    value, heads = np.zeros((2, place.size)), np.log(head + prior)
    word_of = key // max(priors[0].size, 1)
    for m in range(2):
        base = (single[m] + 1) / (t.tokens[m] + t.size + 1)
        pair = np.bincount(place, counts[m], minlength=key.size)
        value[m] = np.rint(SCALE * (heads[m][word_of] - np.log(pair + prior * base[word_of])))[place]
    heads = np.rint(SCALE * heads)
    found, a, e = [], 0, 0
    for p in parts:
        b, f = a + p[3].size, e + p[9].size
        texts = np.concatenate([p[7], p[12]])
        each = [np.append(np.repeat(v[a:b], p[6]) * p[8], -h[end[e:f]]) for v, h in zip(value, heads)]
        texts, sums = _sums(texts, np.array(each))
        found.append(_pack([texts.astype(np.uint32), *sums]))
        a, e = b, f
    return found


def text_losses(packed: DataFrame, t: Totals, prior: float = PRIOR) -> DataFrame:
    """``tid, n, target, background`` of every text in each of its groups: tokens and summed losses in whole units."""
    shared = packed.sparkSession.sparkContext.broadcast(t)

    def deal(table: pa.Table) -> pa.Table:
        whole = pc.equal(table["kind"], 0)
        texts, rows = table.filter(whole), table.filter(pc.invert(whole))
        if rows.num_rows:
            data = bucket_sums(rows["data"].to_pylist(), shared.value, prior)
            rows = rows.set_column(3, "data", pa.array(data, pa.binary()))
        return pa.concat_tables([texts, rows])

    def merge(table: pa.Table) -> pa.Table:
        t = shared.value
        whole = pc.equal(table["kind"], 0)
        digests, n = _unpack(table.filter(whole)["data"][0].as_py(), [np.uint8, np.int64])
        # Every text's first token follows the start.
        sums = np.array([(n > 0) * np.rint(SCALE * np.log(texts + prior)).astype(np.int64) for texts in t.texts])
        for data in table.filter(pc.invert(whole))["data"]:
            texts, *values = _unpack(data.as_py(), SUMS)
            sums[:, texts] += np.array(values)
        tids = [d.tobytes() for d in digests.reshape(n.size, -1)]
        columns = [pa.array(tids, pa.binary()), pa.array(n), *(pa.array(v) for v in sums)]
        return pa.Table.from_arrays(columns, names=["tid", "n", *MODELS])

    dealt = packed.groupBy("bucket").applyInArrow(deal, BLOBS)
    return dealt.groupBy("grp").applyInArrow(merge, "tid BINARY, n BIGINT, target BIGINT, background BIGINT")


def score_all(docs: DataFrame, means: DataFrame, text: str = "text") -> DataFrame:
    """``score`` by a table of ``tid`` and those columns, one row for each text."""
    new = ["n_tokens", *(f"{m}_loss" for m in MODELS), "difference"]
    kept = [c for c in docs.columns if c not in new]
    at = kept.index(text)
    rows = positional(docs.select(*kept))
    tid = _tid(f"c{at}")
    joined = lookup_join(rows.withColumn("tid", tid), means, ["tid"], counted=rows.select(tid.alias("tid")))
    return joined.select(*rows.columns, *new).toDF(*kept, *new)


def _tid(text: str) -> Column:
    """What tells texts apart; a null is an empty text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def cross_entropy_difference(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int | None = None,
    sample: int | None = None, bucket: int = BUCKET,
) -> DataFrame:
    """``docs`` with the columns of ``score``; lower differences are more like the target.

    Vocabulary and background are counted on all texts, the target model on all rows
    that labels call good, or on up to ``sample`` of them.  The vocabulary has all words, or the ``size`` most frequent.  Null and wordless texts have null losses; without
    target rows every word is equally likely in the target model.  Repeated rows
    count each time and score alike.  New columns replace those of the same name.
    ``bucket`` is the number of bigrams of texts in a task.  Runs jobs when called, and
    stages intermediates unless there is a ``size``.
    """
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    target = good_ids(labels) if sample is None else target_ids(labels, sample)
    if size is None:
        small_batches(docs.sparkSession)
        # Two passes read the same rows in the same order.
        plain = stage(marked(plain, target).select("good", "text"), "zstd")
        known = totals(stage(count_words(plain), "zstd"), bucket)
        sums = text_losses(packed_bigrams(plain.withColumn("tid", _tid("text")), known), known)
        # Copies in other groups have the same sums.
        sums = sums.groupBy("tid").agg(F.max("n").alias("n_tokens"), *(F.max(m).alias(m) for m in MODELS))
        each = [F.try_divide(F.col(m) / SCALE, "n_tokens").alias(f"{m}_loss") for m in MODELS]
        means = sums.select("tid", "n_tokens", *each)
        means = stage(means.withColumn("difference", F.col("target_loss") - F.col("background_loss")))
        return score_all(docs, means, text)
    vocabulary = learn_vocabulary(plain, size)
    return score(docs, learn(plain, target, vocabulary), vocabulary, text)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: tokens, mean losses of both models and their difference."""
    return cross_entropy_difference(docs.select("doc_id", "text"), labels).drop("text")
