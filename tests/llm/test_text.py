import re

import numpy as np
import pyarrow as pa
import pytest

from affinis.llm import text as t

from .data import frame

WORD = t.byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_words_of_slices_are_those_of_whole_texts(monkeypatch, size):
    monkeypatch.setattr(t, "SLICE", size)
    texts = ["ab Cd", None, "", "x" * 300, " y", "z" * 50 + "  é1 " * 30, "end", "end"]
    data, offsets = t.text_bytes(pa.array(texts, pa.string()))
    words = t.find_words(data, offsets, WORD)
    for k, text in enumerate(texts):
        found = re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())
        spans = range(words.first[k], words.first[k + 1])
        assert [data[words.starts[i] : words.ends[i]].tobytes() for i in spans] == found
    hashes = {}
    for i in range(words.starts.size):
        word = data[words.starts[i] : words.ends[i]].tobytes().lower()
        assert hashes.setdefault(word, words.hashes[i]) == words.hashes[i]
    assert len(set(hashes.values())) == len(hashes)


def test_row_groups_cover_all_rows():
    offsets = np.array([0, 5, 5, 30, 31, 32, 60])
    assert list(t.row_groups(offsets, 10)) == [(0, 2), (2, 3), (3, 5), (5, 6)]
    assert list(t.row_groups(np.array([0]), 10)) == []


def test_batches_are_made_smaller_but_never_larger(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for before, after in (("64m", str(t.BATCH)), ("99999kb", str(t.BATCH)), ("1m", "1m")):
        spark.conf.set(name, before)
        t.small_batches(spark)
        assert spark.conf.get(name) == after
    spark.conf.unset(name)


def test_added_columns_replace_those_of_the_same_name(spark):
    docs = frame(spark, [(1, "a", 5), (2, None, 6)], ", n INT")
    found = t.add_columns(docs, ["text"], lambda: lambda texts: [[len(x or "") for x in texts.to_pylist()]], "n BIGINT")
    assert sorted(map(tuple, found.collect())) == [(1, "a", 1), (2, None, 0)]
    assert t.positional(docs).columns == ["c0", "c1", "c2"]


def twins():
    """Two different words of 1,024 letters whose sums of powers modulo 2 ** 64 are equal for every odd base."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_long_words_of_equal_sums_have_other_hashes():
    one, other = twins()
    data, offsets = t.text_bytes(pa.array([one, other, one]))
    sums = t.span_hashes(t.prefix_hashes(data), offsets[:-1], offsets[1:])
    assert sums[0] == sums[1]
    hashes = t.find_words(data, offsets, WORD).hashes
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_words_of_equal_sums_in_the_operators(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from affinis.llm import cross_entropy, jaccard, tokens

    one, other = twins()
    path = public_tokenizers.path(tokens.VOCABULARY)
    encoder, library = tokens.Encoder(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    ids, ends = encoder.encode(pa.array([one, other]), tokens.END)
    for text, a, b in zip((one, other), [0, *ends], ends):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids + [tokens.END]
    rows = [(1, f"w {one} x y z v"), (2, f"w {other} x y z v"), (3, f"w {one} x y z v")]
    found = {r.doc_id: r.component_id for r in jaccard.linked_groups(frame(spark, rows)).collect()}
    assert found == {1: 1, 2: 2, 3: 1}
    _, hashes, _ = cross_entropy._hashed_bigrams(pa.array([one, other]))
    assert hashes[0] != hashes[1]
