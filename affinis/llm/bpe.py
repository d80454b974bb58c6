"""Byte-level BPE with a local rank file: encoding of whole texts and raw-byte decoding."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.text import add_columns, text_bytes

RANKS = "byte_bpe_50k.tiktoken"
# A text is given to the library in pieces of about this many characters.
PIECE = 1 << 16

# A white space after one of these characters always starts a match of the pattern, so cutting there is safe.
_SAFE = regex.compile(r"(?<=[0-9A-Za-z.,;:!?])(?=[ \n])")
# The pattern's classes, with the white space of the library spelled out.
_SPACE = r"\t-\r \x85\xa0  -     　"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Codec:
    """Ids of texts and bytes of ids, by given ranks and split pattern, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, piece: int = PIECE) -> None:
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        spelled = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
        self.matches = regex.compile(spelled)
        self.piece = piece

    def pieces(self, text: str) -> Iterator[str]:
        """The text cut at safe boundaries; a piece stays longer than asked where it has none."""
        at = 0
        while len(text) - at > self.piece:
            cut = _SAFE.search(text, at + self.piece)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str) -> np.ndarray:
        ids: list[int] = []
        for piece in self.pieces(text):
            if len(piece) <= 4 * self.piece:
                ids += self.coder.encode_ordinary(piece)
            else:
                # The library's own matching runs out of stack on such pieces.
                for match in self.matches.finditer(piece):
                    ids += self.coder._encode_single_piece(match[0])
        return np.array(ids, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self.coder.decode_bytes(ids.tolist())


def encode(docs: DataFrame, text: str = "text", ranks: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the little-endian unsigned 32-bit ids of its whole texts as BINARY.

    A null or empty text has no ids.  ``ranks`` is the path of a rank file, read
    on the driver and broadcast (a fixed vocabulary).  Rows stay in place.
    """
    table = load_ranks(ranks or public_tokenizers.path(RANKS))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def make():
        codec = Codec(shared.value)
        return lambda texts: [[codec.encode(t or "").tobytes() for t in texts.to_pylist()]]

    return add_columns(docs, [text], make, "ids BINARY")


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the raw bytes of its ``ids``; null ids give no bytes."""
    table = load_ranks(ranks or public_tokenizers.path(RANKS))
    shared = encoded.sparkSession.sparkContext.broadcast(table)

    def make():
        codec = Codec(shared.value)

        def apply(column: pa.Array) -> list:
            data, offsets = text_bytes(column)
            return [[codec.decode(data[a:b].view("<u4")) for a, b in zip(offsets[:-1], offsets[1:])]]

        return apply

    return add_columns(encoded, ["ids"], make, "decoded BINARY")


def digest(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """One row per document: number of ids, hash of the ids, hash of the bytes decoded from them."""
    coded = decode(encode(docs.select("doc_id", "text"), ranks=ranks).select("doc_id", "ids"), ranks)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
