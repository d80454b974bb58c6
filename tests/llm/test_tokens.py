import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from affinis.llm import tokens as t
from affinis.llm.text import read
from tests.conftest import SF

from .data import frame, passage

PATH = public_tokenizers.path(t.VOCABULARY)
HARD = [
    None, "", " \n", "The end.It's  a,b;c:d!e? 3.14 x'S don't we'll", "é, É. naïve Été! été?", "H̱ ẖ İ. Å,",
    "日本語。テスト 1２３  x y\x1cz\x85w", "<|endoftext|> x<|startoftext|>.y", "...a. ,b'.'s !'t", "≠ ≮ .̸ a.̸", "Σας ΣΑΣ. ΟΔΟΣ, K K",
    "word" * 5000, passage(1, 3000), "#hash @you (x) [y] {z} \"q\" a_b c-d/e\\f ‍﻿",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_words_alone_give_the_ids_of_whole_texts(spark, library):
    texts = HARD + [r.text for r in read(spark, SF, "documents").limit(80).collect()]
    rng = random.Random(2)
    signs = "aZé.,'s !̱́日3\n_- "
    texts += ["".join(rng.choice(signs) for _ in range(40)) for _ in range(400)]
    encoder = t.Encoder(open(PATH, encoding="utf-8").read())
    for part in (texts, texts[::-1]):
        ids, ends = encoder.encode(pa.array(part, pa.string()), t.END)
        for text, a, b in zip(part, [0, *ends], ends):
            assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids + [t.END], text


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 5000])
def test_segments_give_any_id_back(size):
    rng = np.random.default_rng(size)
    ids = rng.integers(0, [200, 300, 70_000, 2**32], (size, 4), np.uint64).astype(np.uint32)[:, :].ravel()[:size]
    segment = t.Segment(t.write_segment([5, None, 7], np.array([0, size // 2, size]), ids))
    assert segment.ids().tolist() == ids.tolist() == [segment[k] for k in range(size)]
    assert [(i, s, len(v)) for i, s, v in segment.documents()] == [(5, 0, 0), (None, 0, size // 2), (7, size // 2, size - size // 2)]


@pytest.mark.parametrize("segment_ids", [1, 300, t.SEGMENT_IDS])
def test_round_trip(spark, library, tmp_path, segment_ids):
    rows = [(3 * k % 17 - 4, text) for k, text in enumerate(HARD)] + [(None, "null"), (40, "tie"), (40, "tie"), (40, "other tie")]
    t.write_tokens(frame(spark, rows).repartition(3), str(tmp_path / "t"), segment_ids=segment_ids)
    found = t.read_tokens(spark, str(tmp_path / "t")).collect()
    found.sort(key=lambda r: r.start)
    coded = [(i, library.encode(x or "", add_special_tokens=False).ids + [t.END]) for i, x in rows]
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in found]
    assert sorted(got, key=str) == sorted(coded, key=str)
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: -99 if i is None else i)
    assert [r.start for r in found] == np.cumsum([0, *(len(ids) for _, ids in got)])[:-1].tolist()


def test_digest(spark, library):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    expected, start = [], 0
    for doc_id, text in sorted(rows):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [t.END], "<u4")
        expected.append((doc_id, start, ids.size, zlib.crc32(ids.tobytes())))
        start += ids.size
    docs = frame(spark, rows).selectExpr("doc_id", "text", "1 AS start", "text AS segment")
    assert sorted(map(tuple, t.digest(docs).collect())) == expected


def test_empty_table(spark):
    assert t.digest(frame(spark, [])).count() == 0
