import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from affinis.llm import pieces as p
from affinis.llm.text import read, text_bytes
from tests.conftest import SF

from .data import frame, passage

HARD = [
    None, "", " ", "   ", "▁", "a▁b", " ▁ ", "▁▁x▁", "ﬁ①　x  yz ", "  lead", "trail  ", "日本語テスト", "👩‍👩‍👧 ok",
    "\x00\x01a", "á ȩ́", "\n\n x\t\t", "<s> </s> <unk> <0x41>", "²³½ﬀﬃ ㌔㍉ ｶﾞｷﾞ", "12345 67", "x" * 5000, "ab " * 3000,
    "Ａ　Ｂ", "﷽ ﷺ a", "\u0000", "​", "’tis “so” – it’s",
]


def model(rule=None, normalizer=None, **trainer):
    """The public model, with another compiled character map or other settings."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path(p.MODEL), "rb") as file:
        proto.ParseFromString(file.read())
    if rule:
        other = sentencepiece_model_pb2.ModelProto()
        other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = other.normalizer_spec.precompiled_charsmap
    for name, value in (normalizer or {}).items():
        setattr(proto.normalizer_spec, name, value)
    for name, value in trainer.items():
        setattr(proto.trainer_spec, name, value)
    if not proto.trainer_spec.byte_fallback:
        kept = [x for x in proto.pieces if x.type != p.BYTE]
        del proto.pieces[:]
        proto.pieces.extend(kept)
    return proto.SerializeToString()


SQUEEZE = {"remove_extra_whitespaces": True}
MODELS = {
    "as it is": {},
    "map": {"rule": "nfkc"},
    "map and squeezed": {"rule": "nmt_nfkc", "normalizer": SQUEEZE},
    "mark behind": {"rule": "nfkc", "normalizer": SQUEEZE, "treat_whitespace_as_suffix": True},
    "plain spaces": {"rule": "nfkc_cf", "normalizer": {"escape_whitespaces": False}},
    "no mark": {"rule": "nmt_nfkc_cf", "normalizer": {"add_dummy_prefix": False}},
    "no bytes": {"rule": "nfkc", "byte_fallback": False},
}


def texts():
    rng = random.Random(4)
    signs = list("ab 　 ﬁ①é́Ａ▁\n'日本¨​")
    return HARD + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(1500)] + [passage(3, 300)]


@pytest.mark.parametrize("name", MODELS)
def test_ids_and_spans_are_those_of_the_library(name):
    made = model(**MODELS[name])
    coder, library = p.Coder(made), sentencepiece.SentencePieceProcessor(model_proto=made)
    ids, first, begins, ends = coder.encode(*text_bytes(pa.array(texts())))
    for k, text in enumerate(texts()):
        a, b = first[k], first[k + 1]
        proto = library.encode(text or "", return_type="proto")
        assert ids[a:b].tolist() == library.encode(text or ""), repr(text)
        spans = list(zip(begins[a:b].tolist(), ends[a:b].tolist()))
        assert spans == [(x.begin, x.end) for x in proto.pieces], repr(text)


def test_longest_prefixes_of_the_map():
    made = model("nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(made)
    chars = p.CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    data = "ﬃe\u0301x\u00e9".encode()
    array = np.frombuffer(data, np.uint8)
    starts = np.flatnonzero((array & 0xC0) != 0x80)
    length, value = chars.longest(array, starts, np.full(starts.size, array.size))
    found = [bytes(chars.strings[v : v + chars.sizes[v]]).decode() for v, n in zip(value, length) if n]
    assert found == ["ffi", "\u00e9"] and length.tolist() == [3, 3, 0, 0, 0]


def test_query(spark):
    rows = [(k, text) for k, text in enumerate(HARD)] + [(None, "x y"), (3, "tie"), (3, "tie")]
    rows += [(r.doc_id + 1000, r.text) for r in read(spark, SF, "documents").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(p.MODEL))
    expected = []
    for i, text in rows:
        ids = library.encode(text or "")
        hashed = [sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        expected.append((i, len(ids), *hashed))
    df = frame(spark, rows).selectExpr("*", "1 AS ids", "2 AS decoded", "3 AS n_tokens").repartition(3)
    got = p.digest(df).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected, key=str)


def test_columns_stay_and_spans_cut_the_text(spark):
    rows = [(1, "Hello, wörld  again"), (2, None), (3, "")]
    df = frame(spark, rows).selectExpr("*", "'own' AS begins", "doc_id AS other")
    found = p.decode(p.encode(df)).collect()
    assert [(r.doc_id, r.other, r.text) for r in found] == [(i, i, text) for i, text in rows]
    r = found[0]
    spans = list(zip(np.frombuffer(r.begins, "<u4").tolist(), np.frombuffer(r.ends, "<u4").tolist()))
    raw = r.text.encode()
    assert b"".join(raw[a:b] for a, b in spans) == raw and r.decoded == r.text
    assert [len(x.ids) for x in found[1:]] == [0, 0] and [x.decoded for x in found[1:]] == ["", ""]
    assert p.digest(frame(spark, [])).count() == 0


def test_models_with_symbols_of_their_user_are_refused():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model())
    proto.pieces[300].type = p.USER_DEFINED
    with pytest.raises(ValueError):
        p.Coder(proto.SerializeToString())
