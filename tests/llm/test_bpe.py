import base64
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from affinis.llm import bpe

from .data import by_id, frame, passage

RANKS = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
TEXTS = [
    None,
    "",
    " ",
    "It's  a\n\n test.   naïve　日本語 1234567 !!?? ́x 's'S\x1c\x85 end  ",
    passage(1, 500) + " \n " + passage(2, 40),
    " " * 1000 + "a",
    "\n" * 777,
]


@pytest.fixture(scope="module")
def coder():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.mark.parametrize("piece", [1, 7, 100, 1 << 16])
def test_pieces_change_nothing(coder, piece):
    codec = bpe.Codec(RANKS, piece=piece)
    for text in TEXTS[1:]:
        assert codec.encode(text).tolist() == coder.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_long_runs_without_boundaries():
    codec = bpe.Codec(RANKS)
    for text in ["x" + " " * 3_000_000 + "a", "ab" * 400_000, passage(3, 200_000)]:
        assert codec.decode(codec.encode(text)) == text.encode()
    # The whole run but its last space is one match; the last one belongs to the word.
    ids = codec.encode("x" + " " * 1_000_000 + "a").tolist()
    assert ids[-1] == RANKS[b" a"]


def test_merges_by_rank():
    """Each match merged by hand, lowest rank first."""

    def merge(word):
        parts = [bytes([b]) for b in word]
        while True:
            ranked = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in RANKS]
            if not ranked:
                return [RANKS[p] for p in parts]
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    text = TEXTS[4]
    expected = [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in merge(m.encode())]
    assert bpe.Codec(RANKS).encode(text).tolist() == expected


def test_digest(spark, coder):
    rows = list(enumerate(TEXTS)) + [(None, "a b"), (4, TEXTS[4])]
    found = bpe.digest(frame(spark, rows))
    assert found.count() == len(rows)
    for doc_id, values in by_id(found, "n_tokens", "ids_sha256", "decoded_sha256").items():
        text = "a b" if doc_id is None else TEXTS[doc_id] or ""
        ids = np.array(coder.encode_ordinary(text), "<u4")
        assert values == (ids.size, sha256(ids.tobytes()).hexdigest(), sha256(text.encode()).hexdigest())
    assert bpe.digest(frame(spark, [])).count() == 0


def test_other_columns_stay(spark):
    docs = frame(spark, [(1, "a", "kept", "replaced")], ", more STRING, ids STRING")
    row = bpe.encode(docs).collect()[0]
    assert row.more == "kept" and bytes(row.ids) == np.array([RANKS[b"a"]], "<u4").tobytes()


def test_rank_file_is_a_parameter(spark, tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([255 - i])) + b" %d" % i for i in range(256)))
    row = bpe.encode(frame(spark, [(1, "ab")]), ranks=str(path)).collect()[0]
    assert np.frombuffer(row.ids, "<u4").tolist() == [255 - 97, 255 - 98]
