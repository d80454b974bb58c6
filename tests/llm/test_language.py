import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinis.llm import language as g
from affinis.llm.text import held_out, read

from tests.conftest import SF
from .data import by_id, frame

PIECES = g.load_pieces(public_tokenizers.path(g.PIECES))


def toy():
    """Three languages with random probabilities over the whole vocabulary."""
    p = np.random.default_rng(1).random((PIECES.hashes.size + 1, 3))
    p[-1] = 0
    return g.Model(["a", "b", "c"], PIECES, p / p.sum(0))


def number(piece):
    sums = g.prefix_hashes(np.frombuffer(piece, np.uint8))
    return int(PIECES.number(g.span_hashes(sums, np.array([0]), np.array([len(piece)])))[0])


def all_segmentations(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        n = number(word[:k])
        if n < PIECES.hashes.size:
            yield from ([n, *rest] for rest in all_segmentations(word[k:]))


@pytest.mark.parametrize("word", [b" a", b" there", " für".encode(), b" xqzt"])
def test_forward_sums_all_segmentations(word):
    model = toy()
    expected = np.log(sum(np.prod(model.probability[s], axis=0) for s in all_segmentations(word)))
    rows = np.frombuffer(word, np.uint8).reshape(1, -1)
    assert np.allclose(g.forward(rows, model)[0], expected)
    assert np.allclose(g.forward_long(word, model), expected)


def test_expected_counts():
    p = toy().probability[:, 0]
    word = b" there"
    ways = [(s, np.prod(p[s])) for s in all_segmentations(word)]
    expected = np.zeros(p.size)
    for s, weight in ways:
        np.add.at(expected, s, 2 * weight / sum(w for _, w in ways))
    found = g.expected_counts(np.frombuffer(word, np.uint8).reshape(1, -1), np.array([2.0]), PIECES, p)
    assert np.allclose(found, expected)


def test_long_words_and_batches():
    texts = ["a" * 20_000 + " b", "the " * 50_000, None, "", "12 ,;", "—", "É", "the of"]
    model = toy()
    together = g.Scorer(model).score(pa.array(texts, pa.string()))
    alone = [g.Scorer(model).score(pa.array([t], pa.string())) for t in texts]
    assert together[0] == [x[0][0] for x in alone] and np.allclose(together[1], [x[1][0] for x in alone])
    assert [lang == "und" for lang in together[0]] == [False, False, True, True, True, True, False, False]


def test_held_out_accuracy(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text", "lang")
    found = g.digest(docs).join(docs, "doc_id").collect()
    out = [r for r in found if r.held_out and r.lang_pred != "und"]
    assert len(found) == docs.count() and len(out) > 30
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_documents_are_not_read(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text", "lang").limit(60)
    changed = docs.withColumn("lang", F.when(held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert by_id(g.digest(docs), "lang_pred", "score") == by_id(g.digest(changed), "lang_pred", "score")


def test_hard_rows(spark):
    rows = [(1, "the of and", "en"), (2, "le la des", "fr"), (2, "le la des", "fr"), (3, None, "en"), (4, "", None), (None, "the", "xx"), (6, "!", "en")]
    docs = frame(spark, rows, ", lang STRING").repartition(3)
    found = g.digest(docs)
    assert found.count() == len(rows)
    assert by_id(found, "lang_pred")[None][0] in ("en", "fr") and by_id(found, "lang_pred")[6] == ("und",)
    assert g.digest(docs.limit(0)).count() == 0
    assert by_id(g.digest(docs.filter("lang is null")), "lang_pred", "score") == {4: ("und", 0.0)}
    clash = docs.withColumnRenamed("lang", "lang_pred")
    assert g.identify(clash, toy()).columns == ["doc_id", "text", "lang_pred", "score"]


def test_expected_counts_of_long_words():
    probability = toy().probability[:, 0]
    word = b" internationalisation"
    rows = np.frombuffer(word, np.uint8).reshape(1, -1)
    assert np.allclose(
        g.expected_long(word, 3.0, PIECES, probability), g.expected_counts(rows, np.array([3.0]), PIECES, probability)
    )
    # Every byte of a long word lies in one piece.
    sizes = g.expected_long(b" " + "日本語の文章".encode() * 200, 1.0, PIECES, probability)
    assert np.isfinite(sizes).all() and sizes.sum() > 3600 / PIECES.longest


def test_languages_without_spaces_are_learned(spark):
    rows = [(k, "日本語の文章には空白がありません。単語は続けて書かれます。" + "漢字と仮名" * (k + 1), "ja") for k in range(5)]
    rows += [(10 + k, "the words of this text are short and apart", "en") for k in range(5)]
    model = g.learn(frame(spark, rows, ", lang STRING"))
    assert model.languages == ["en", "ja"]
    docs = frame(spark, [(1, "空白がありません。漢字と仮名で書かれます。日本語の文章です。"), (2, "short words of a text")])
    assert by_id(g.identify(docs, model), "lang_pred") == {1: ("ja",), 2: ("en",)}


@pytest.mark.parametrize("size", [1, 30, 40, 41, 60])
def test_words_of_unlikely_pieces_have_a_score(size):
    """Probabilities far below those of a large sample: sums over 40 bytes are below the least number."""
    model = toy()
    tiny = g.Model(model.languages, model.pieces, model.probability * 1e-9)
    word = b"q\xc3\xa9" * 20
    word = word[:size]
    short = g.forward(np.frombuffer(word, np.uint8)[None], tiny)[0]
    assert np.isfinite(short).all() and np.allclose(short, g.forward_long(word, tiny))
    counts = g.expected_counts(np.frombuffer(word, np.uint8)[None], np.ones(1), tiny.pieces, tiny.probability[:, 0])
    assert np.isfinite(counts).all() and np.allclose(counts, g.expected_long(word, 1.0, tiny.pieces, tiny.probability[:, 0]))
