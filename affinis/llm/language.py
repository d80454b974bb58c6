"""Language ID: piece probabilities per language, and texts scored over all their segmentations.

A word is a run of letters a-z (A-Z lower-cased) and bytes from 0x80, with a mark in
front.  Its probability in a language is the sum, over all ways to cut it into pieces
of a fixed public vocabulary or single bytes, of the products of the pieces'
probabilities (forward algorithm).  A text's is the product over its words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm.text import (
    LOWER, Words, add_columns, byte_class, find_words, held_out, prefix_hashes, span_hashes, text_bytes,
)

PIECES = "piece_bpe_32k.model"
# Documents per language that the probabilities are learned from, by hash of the id.
SAMPLE = 1000
ROUNDS = 3
# Added to every expected count, so that no piece is impossible.
SMOOTHING = 0.1
# Words of up to this many bytes are scored together; longer ones one by one.
SHORT = 40
# Words remembered by a task.
REMEMBERED = 400_000

LETTERS = byte_class([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
MARK = b" "


class Pieces(NamedTuple):
    """Hashes of the vocabulary's pieces in ascending order; a piece's number is its place."""

    hashes: np.ndarray
    longest: int

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of hashed strings, ``len(hashes)`` for those that are no piece."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == self.hashes.size] = 0
        return np.where(self.hashes[at] == hashes, at, self.hashes.size)


class Model(NamedTuple):
    languages: list[str]
    pieces: Pieces
    # One row per piece and a last one of zeros, one column per language.
    probability: np.ndarray


def load_pieces(path: str) -> Pieces:
    """Lower-cased pieces of a sentencepiece model, its word mark as MARK, and all single bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            known.add(model.id_to_piece(i).replace("▁", " ").encode().lower())
    known -= {b""}
    text = np.frombuffer(b"".join(sorted(known)), np.uint8)
    size = np.array([len(p) for p in sorted(known)])
    ends = np.cumsum(size)
    return Pieces(np.unique(span_hashes(prefix_hashes(text), ends - size, ends)), int(size.max()))


def _lattice(words: np.ndarray, pieces: Pieces):
    """Arcs of words of one length (rows of bytes): pairs (start, end) with the pieces' numbers, by end."""
    n, size = words.shape
    sums = prefix_hashes(words.ravel())
    base = np.arange(n) * size
    for end in range(1, size + 1):
        for start in range(max(0, end - pieces.longest), end):
            yield start, end, pieces.number(span_hashes(sums, base + start, base + end))


def _byte_scale(probability: np.ndarray, size: int) -> float:
    """What each byte of words of ``size`` bytes is multiplied by, so that no sum over them becomes 0 or infinite.

    1 where the least probable piece for every byte is far from that; else
    halfway (in logarithms) between that piece and 1.
    """
    least = probability[:-1].min(initial=1.0)
    return 1.0 if least <= 0 or size * np.log(least) > -600 else float(least**-0.5)


def forward(words: np.ndarray, model: Model) -> np.ndarray:
    """Log-probability of each word (rows of bytes, one length) in each language."""
    n, size = words.shape
    alpha = np.zeros((size + 1, n, len(model.languages)))
    alpha[0], scale = 1, _byte_scale(model.probability, size)
    for start, end, piece in _lattice(words, model.pieces):
        arc = model.probability[piece]
        alpha[end] += alpha[start] * (arc if scale == 1 else arc * scale ** (end - start))
    return np.log(alpha[size]) - size * np.log(scale)


def forward_long(word: bytes, model: Model) -> np.ndarray:
    """The same for one word of any length, rescaled on the way; memory of a few positions."""
    data = np.frombuffer(word, np.uint8)
    sums, longest = prefix_hashes(data), model.pieces.longest
    recent, total = [np.ones(len(model.languages))], np.zeros(len(model.languages))
    for end in range(1, data.size + 1):
        starts = np.arange(end - len(recent), end)
        piece = model.pieces.number(span_hashes(sums, starts, np.full(starts.size, end)))
        value = (np.array(recent) * model.probability[piece]).sum(0)
        recent = [r / value for r in recent[-(longest - 1) :]] + [np.ones_like(value)]
        total += np.log(value)
    return total


def expected_counts(words: np.ndarray, weight: np.ndarray, pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Expected number of each piece over all segmentations of weighted words of one length (forward-backward)."""
    n, size = words.shape
    arcs = list(_lattice(words, pieces))
    alpha, beta = np.zeros((size + 1, n)), np.zeros((size + 1, n))
    alpha[0], beta[size], scale = 1, 1, _byte_scale(probability, size)
    powers = scale ** np.arange(min(size, pieces.longest) + 1)
    for start, end, piece in arcs:
        alpha[end] += alpha[start] * probability[piece] * powers[end - start]
    for start, end, piece in sorted(arcs, key=lambda arc: -arc[0]):
        beta[start] += beta[end] * probability[piece] * powers[end - start]
    counts = np.zeros(pieces.hashes.size + 1)
    for start, end, piece in arcs:
        # Divided first: the two sums together may pass the range of a number.
        share = alpha[start] / alpha[size] * beta[end] * probability[piece] * powers[end - start]
        counts += np.bincount(piece, weight * share, minlength=counts.size)
    return counts


def expected_long(word: bytes, weight: float, pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """The same for one word of any length, with logarithms of the sums; memory of some numbers a byte."""
    data = np.frombuffer(word, np.uint8)
    sums, size = prefix_hashes(data), data.size
    alpha, beta = np.zeros(size + 1), np.zeros(size + 1)
    for end in range(1, size + 1):
        starts = np.arange(max(0, end - pieces.longest), end)
        piece = pieces.number(span_hashes(sums, starts, np.full(starts.size, end)))
        alpha[end] = alpha[end - 1] + np.log((np.exp(alpha[starts] - alpha[end - 1]) * probability[piece]).sum())
    counts = np.zeros(pieces.hashes.size + 1)
    for start in range(size - 1, -1, -1):
        ends = np.arange(start + 1, min(size, start + pieces.longest) + 1)
        piece = pieces.number(span_hashes(sums, np.full(ends.size, start), ends))
        value = np.exp(beta[ends] - beta[start + 1]) * probability[piece]
        beta[start] = beta[start + 1] + np.log(value.sum())
        np.add.at(counts, piece, weight * value * np.exp(alpha[start] + beta[start + 1] - alpha[size]))
    return counts


def by_length(words: list[bytes]):
    """Indices and byte rows of the words of each length up to SHORT."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes[sizes <= SHORT]):
        index = np.flatnonzero(sizes == size)
        yield index, np.frombuffer(b"".join(words[i] for i in index), np.uint8).reshape(-1, size)


def _spell(data: np.ndarray, start: int, end: int) -> bytes:
    return MARK + LOWER[data[start:end]].tobytes()


def _count_words(batches):
    """Words of each language with their counts, one batch at a time."""
    for batch in batches:
        found: dict[tuple[str, bytes], int] = {}
        for lang, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
            data, offsets = text_bytes(pa.array([texts.as_py()], pa.string()))
            words = find_words(data, offsets, LETTERS)
            for a, b in zip(words.starts.tolist(), words.ends.tolist()):
                key = lang, _spell(data, a, b)
                found[key] = found.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in found], pa.string()),
                pa.array([k[1] for k in found], pa.binary()),
                pa.array(found.values(), pa.int64()),
            ],
            names=["lang", "word", "n"],
        )


def learn(labelled: DataFrame, path: str | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each ``lang`` of ``labelled`` (doc_id, text, lang), by expectation maximisation.

    Learns from up to ``sample`` whole documents a language, those with the lowest
    hash of the id, ranked among an expected four times as many; rows with a null
    in any of the columns are left out.  What comes to the driver is bounded by
    languages times pieces.  Runs jobs.
    """
    spark = labelled.sparkSession
    pieces = load_pieces(path or public_tokenizers.path(PIECES))
    order = Window.partitionBy("lang").orderBy("u", "doc_id")
    rows = labelled.filter("text is not null and lang is not null and doc_id is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    uniform = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    low = rows.select("lang", "doc_id", uniform.alias("u")).join(F.broadcast(counts), "lang")
    low = low.filter(F.col("u") * F.col("n") < 4 * sample).select("lang", "doc_id", "u").distinct()
    chosen = low.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= sample).select("lang", "doc_id")
    words = rows.join(F.broadcast(chosen), ["lang", "doc_id"], "left_semi").select("lang", "text")
    words = words.mapInArrow(_count_words, "lang STRING, word BINARY, n BIGINT")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).cache()
    languages = sorted(row[0] for row in words.select("lang").distinct().collect())
    size = pieces.hashes.size
    probability = np.full((size + 1, len(languages)), 1 / size)
    probability[size] = 0
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((pieces, languages, probability))

        def count(frames, shared=shared):
            pieces, languages, probability = shared.value
            total = np.zeros((len(languages), probability.shape[0]))
            for frame in frames:
                for lang, part in frame.groupby("lang"):
                    k, weight = languages.index(lang), part["n"].to_numpy(float)
                    spelt = [bytes(w) for w in part["word"]]
                    for index, rows in by_length(spelt):
                        total[k] += expected_counts(rows, weight[index], pieces, probability[:, k])
                    for word, n in zip(spelt, weight):
                        if len(word) > SHORT:
                            total[k] += expected_long(word, n, pieces, probability[:, k])
            k, piece = np.nonzero(total)
            yield pd.DataFrame({"k": k, "piece": piece, "n": total[k, piece]})

        counted = words.mapInPandas(count, "k INT, piece INT, n DOUBLE").groupBy("k", "piece").agg(F.sum("n").alias("n"))
        expected = np.zeros_like(probability)
        found = counted.toPandas()
        expected[found["piece"], found["k"]] = found["n"].round(6)
        expected[:size] += SMOOTHING
        expected[size] = 0
        probability = expected / expected.sum(0)
    words.unpersist()
    return Model(languages, pieces, probability)


class Scorer:
    """Language and score of whole texts; remembers the words it has seen."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.rows: dict[bytes, int] = {}
        self.known = np.zeros((1024, len(model.languages)))

    def _look_up(self, words: list[bytes]) -> np.ndarray:
        """Row of each word in ``known``, scoring those not met before."""
        if len(self.rows) > REMEMBERED:
            self.rows = {}
        new = [w for w in words if w not in self.rows]
        at = len(self.rows)
        self.rows.update(zip(new, range(at, at + len(new))))
        if at + len(new) > len(self.known):
            grown = np.zeros((2 * (at + len(new)), self.known.shape[1]))
            grown[:at] = self.known[:at]
            self.known = grown
        for index, rows in by_length(new):
            self.known[at + index] = forward(rows, self.model)
        for k, word in enumerate(new):
            if len(word) > SHORT:
                self.known[at + k] = forward_long(word, self.model)
        return np.array([self.rows[w] for w in words], np.int64)

    def score(self, texts: pa.Array) -> list:
        data, offsets = text_bytes(texts)
        found = find_words(data, offsets, LETTERS)
        _, some, which = np.unique(found.hashes, return_index=True, return_inverse=True)
        rows = self._look_up([_spell(data, found.starts[i], found.ends[i]) for i in some])
        each = np.concatenate([self.known[rows][which], np.zeros((1, self.known.shape[1]))])
        names, scores = [], []
        has = np.diff(found.first) > 0
        sums = np.add.reduceat(each, found.first[:-1]) if len(texts) else each
        for k, known in enumerate(has.tolist()):
            if not known or not self.model.languages or not self._letters(data, found, k):
                names.append("und")
                scores.append(0.0)
                continue
            part = np.exp(sums[k] - sums[k].max())
            best = int(part.argmax())
            names.append(self.model.languages[best])
            scores.append(float(part[best] / part.sum()))
        return [names, scores]

    def _letters(self, data: np.ndarray, found: Words, k: int) -> bool:
        """Whether the k-th text has a letter; bytes from 0x80 may be other signs."""
        a, b = found.starts[found.first[k]], found.ends[found.first[k + 1] - 1]
        part = data[a:b]
        if (LETTERS[part] & (part < 128)).any():
            return True
        return any(c.isalpha() for c in part.tobytes().decode("utf-8", "ignore"))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language among the model's.

    Null, empty and letterless texts, and all texts where the model knows no
    language, are ``und`` with score 0.  Ties go to the first language in order.
    Reads whole texts, in place; new columns replace those of the same name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, [text], lambda: Scorer(shared.value).score, "lang_pred STRING, score DOUBLE")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: whether it was held out, and the language learned from the others."""
    model = learn(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
