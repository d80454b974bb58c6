import math
import re
from collections import Counter

import numpy as np
import pytest

from affinis.llm import cross_entropy as c
from affinis.llm.text import read
from tests.conftest import SF

from .data import by_id, frame, passage
from .test_quality import make_labels

ROWS = [(k, passage(k, 30)) for k in range(30)] + [(40, None), (41, " "), (42, "The the THE the"), (None, "a, b"), (3, passage(3, 30))]
LABELS = [(k, 1, 0) for k in range(12)] + [(15, 0, 0), (16, 1, 1), (None, 1, 0)]
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


@pytest.mark.parametrize("size", [0, 5, 1000])
def test_losses_by_hand(spark, size):
    docs = frame(spark, ROWS).repartition(3)
    all_words = Counter(w for _, t in ROWS for w in words(t))
    vocabulary = c.learn_vocabulary(docs, size)
    assert vocabulary.size == min(size, len(all_words))
    # The known words, by hash; ties in frequency may fall either way.
    data = {w: c.find_words(np.frombuffer(w, np.uint8), np.array([0, len(w)]), c.WORD).hashes[0] for w in all_words}
    known = {w for w, h in data.items() if h in set(vocabulary.tolist())}
    least = min((all_words[w] for w in known), default=0)
    assert all(n <= least for w, n in all_words.items() if w not in known) or not known

    def numbers(text):
        return [w if w in known else "" for w in words(text)]

    n = vocabulary.size + 1
    models = []
    for rows in ([r for r in ROWS if r[0] in set(range(12))], ROWS):
        single = Counter(w for _, t in rows for w in numbers(t))
        pairs = Counter(p for _, t in rows for p in zip(["^", *numbers(t)], numbers(t)))
        heads = Counter(p for _, t in rows for p in ["^", *numbers(t)][: len(numbers(t))])
        models.append((single, pairs, heads))
    found = by_id(c.cross_entropy_difference(docs, make_labels(spark, LABELS), size=size), "n_tokens", "target_loss", "background_loss", "difference")
    for doc_id, text in ROWS:
        tokens, losses = numbers(text), []
        for single, pairs, heads in models:
            total = 0
            for p, w in zip(["^", *tokens], tokens):
                base = (single[w] + 1) / (sum(single.values()) + n)
                total -= math.log((pairs[p, w] + c.PRIOR * base) / (heads[p] + c.PRIOR))
            losses.append(total / len(tokens) if tokens else None)
        got = found[doc_id]
        assert got[0] == len(tokens)
        if tokens:
            assert np.allclose(got[1:], [*losses, losses[0] - losses[1]])
        else:
            assert got[1:] == (None, None, None)


def test_each_row_of_a_model_sums_to_one(spark):
    docs = frame(spark, ROWS)
    vocabulary = c.learn_vocabulary(docs, 50)
    losses = c.learn(docs, np.arange(12), vocabulary)
    assert np.allclose(np.exp(-losses).sum(2), 1)


def test_clean_documents_score_lower(spark):
    labels = read(spark, SF, "labels")
    found = c.digest(read(spark, SF, "documents"), labels).join(labels, "doc_id").toPandas()
    clean = (found.quality == 1) & (found.toxic == 0)
    assert found[clean].difference.median() < found[~clean].difference.median()


def test_edges(spark):
    labels = make_labels(spark, LABELS)
    assert c.digest(frame(spark, []), labels).count() == 0
    assert by_id(c.digest(frame(spark, ROWS[:3]), make_labels(spark, [])), "n_tokens")[0] == (30,)
    docs = frame(spark, ROWS).selectExpr("doc_id", "text", "1 AS n_tokens", "'x' AS more")
    assert c.cross_entropy_difference(docs, labels).columns[:3] == ["doc_id", "text", "more"]


def test_all_words_count(spark):
    """More words than any small vocabulary holds; each has losses of its own."""
    rows = ROWS + [(100 + k, " ".join("rare%d" % (40 * k + i) for i in range(40))) for k in range(60)]
    rows += [(200, "rare1 rare2 rare3"), (201, "rare1 rare5 rare9")]
    docs, labels = frame(spark, rows).repartition(3), make_labels(spark, LABELS + [(100, 1, 0)])
    columns = "n_tokens", "target_loss", "background_loss", "difference"
    found = by_id(c.digest(docs, labels), *columns)
    dense = by_id(c.cross_entropy_difference(docs, labels, size=len({w for _, t in rows for w in words(t)})), *columns)
    assert found.keys() == dense.keys()
    for k, row in found.items():
        assert row[0] == dense[k][0]
        assert row[1:] == dense[k][1:] == (None, None, None) if row[0] == 0 else np.allclose(row[1:], dense[k][1:])
    assert abs(found[200][3] - found[201][3]) > 1e-6


@pytest.mark.parametrize("bucket", [50, 7])
def test_hot_words_and_bigrams(spark, bucket):
    """One bigram in a third of all texts, many buckets, copies in several groups: as with a dense table."""
    rows = ROWS + [(100 + k, f"hot pair {passage(k % 40, 12)} hot pair") for k in range(60)]
    rows += [(300 + k, "hot " * 30) for k in range(5)] + [(400 + k, "same text " * 3) for k in range(9)]
    docs, labels = frame(spark, rows).repartition(4), make_labels(spark, LABELS + [(100, 1, 0), (300, 1, 0), (401, 1, 0)])
    columns = "n_tokens", "target_loss", "background_loss", "difference"
    size = len({w for _, t in rows for w in words(t)})
    found = by_id(c.cross_entropy_difference(docs, labels, bucket=bucket), *columns)
    dense = by_id(c.cross_entropy_difference(docs, labels, size=size), *columns)
    assert found.keys() == dense.keys()
    for k, row in found.items():
        assert row[0] == dense[k][0]
        assert row[1:] == dense[k][1:] == (None, None, None) if row[0] == 0 else np.allclose(row[1:], dense[k][1:])


def test_long_words_of_equal_sums(spark):
    """Words whose sums of powers are equal modulo 2 ** 64 are two words."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    one, other = ("".join("ab"[b ^ x] for b in bits) for x in (0, 1))
    docs = frame(spark, [(1, f"x {one}"), (2, f"x {other}"), (3, f"y {one}")])
    found = by_id(c.cross_entropy_difference(docs, make_labels(spark, [(1, 1, 0)])), "difference")
    assert abs(found[1][0] - found[2][0]) > 1e-6


def test_packed_arrays_return(spark):
    arrays = [np.array([1, 1 << 60], np.uint64), np.array([], np.uint32), np.array([-5, 7], np.int64)]
    for a, b in zip(arrays, c._unpack(c._pack(arrays), [a.dtype.type for a in arrays])):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()


@pytest.mark.parametrize("size", [None, 50])
def test_every_labelled_document_counts(spark, size):
    """Far more good labels than any sample holds: those of the documents all count."""
    docs = frame(spark, ROWS).repartition(3)
    own = spark.createDataFrame([(k, 1, 0) for k in range(30)], "doc_id BIGINT, quality INT, toxic INT")
    more = spark.range(1000, 91_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    columns = "n_tokens", "target_loss", "background_loss", "difference"
    alone = by_id(c.cross_entropy_difference(docs, own, size=size), *columns)
    assert by_id(c.cross_entropy_difference(docs, own.unionAll(more), size=size), *columns) == alone
    some = by_id(c.cross_entropy_difference(docs, own, size=size, sample=5), *columns)
    assert some[20][1] > alone[20][1]
