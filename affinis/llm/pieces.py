"""SentencePiece ids of whole texts with the original bytes that each piece stands for, and their decoding.

A text is normalised here, by the longest prefixes that the model's compiled character
map knows, and each byte of the result remembers the byte of the text it comes from.
The library then encodes the normalised text with a copy of the model that changes
nothing more, and the byte lengths of its pieces lead back to spans of the text.

The normalised text is cut where no piece of the vocabulary holds the two characters
around the cut, so that no merge can cross it; equal parts of a group of texts are
encoded once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from affinis.llm.text import add_columns, small_batches, text_bytes

MODEL = "piece_bpe_32k.model"
# Bytes of text whose equal parts are encoded once.
GROUP_BYTES = 4 << 20

_SPACE = 0x20
_ESCAPED = "▁".encode()
# Kinds of pieces in a model file: fixed values of its format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """Longest prefixes and what they become, from the compiled map of a model: a double-array trie and strings."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4) if size else np.zeros(0, "<u4")
        self.strings = np.frombuffer(blob[4 + size :], np.uint8)
        ends = np.flatnonzero(self.strings == 0)
        # Length of the string that starts at each place.
        self.sizes = ends[np.searchsorted(ends, np.arange(self.strings.size))] - np.arange(self.strings.size)

    def longest(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of ``data`` the length of its longest known prefix (0: none) and where its string starts."""
        length, value = np.zeros(starts.size, np.int64), np.zeros(starts.size, np.int64)
        if not self.units.size:
            return length, value

        def offset(unit: np.ndarray) -> np.ndarray:
            return (unit >> 10) << ((unit & (1 << 9)) >> 6)

        units = self.units.astype(np.int64)
        live, deep = np.arange(starts.size), 0
        node = np.full(starts.size, offset(units[:1])[0])
        while live.size:
            more = starts[live] + deep < ends[live]
            live, node = live[more], node[more]
            key = data[starts[live] + deep].astype(np.int64)
            node = node ^ key
            unit = units[node]
            fits = (unit & ((1 << 31) | 0xFF)) == key
            live, node, unit = live[fits], node[fits], unit[fits]
            node = node ^ offset(unit)
            leaf = (unit >> 8) & 1 == 1
            deep += 1
            length[live[leaf]] = deep
            value[live[leaf]] = units[node[leaf]] & 0x7FFFFFFF
        return length, value


class Normalised(NamedTuple):
    """Bytes of some texts end to end, an escaped space as one plain space.

    ``first`` has the first byte of each text (one more at the end), ``source`` the
    place in its text that each byte comes from, ``after`` the place behind the last
    one of each text, ``marked`` which texts get the model's own space.
    """

    data: np.ndarray
    first: np.ndarray
    source: np.ndarray
    after: np.ndarray
    marked: np.ndarray


class Coder:
    """Ids, spans and decoded texts by one model."""

    def __init__(self, model: bytes) -> None:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        if any(p.type == USER_DEFINED for p in proto.pieces):
            raise ValueError("models with symbols of their user are not supported")
        self.bytewise = proto.trainer_spec.byte_fallback
        self.lengths = np.array([1 if p.type == BYTE else self._size(p.piece) for p in proto.pieces])
        self.joined = self._joined([p.piece for p in proto.pieces if p.type == NORMAL])
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        spec.precompiled_charsmap = b""
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def _size(self, piece: str) -> int:
        """Bytes of a piece, an escaped space as one."""
        return len((piece.replace("▁", " ") if self.escape else piece).encode())

    def _joined(self, pieces: list[str]) -> np.ndarray:
        """Whether a piece may hold one byte directly before another, an escaped space as a plain one.

        Where the model has no bytes to fall back to, unknown characters in a row
        are one id, so only spaces are told apart from what is before them.
        """
        table = np.zeros((256, 256), bool)
        table[:, : _SPACE if not self.bytewise else 0] = True
        table[:, _SPACE + 1 if not self.bytewise else 256 :] = True
        for piece in pieces:
            chars = [c.encode() for c in (piece.replace("▁", " ") if self.escape else piece)]
            for x, y in zip(chars, chars[1:]):
                table[x[-1], y[0]] = True
        return table

    def normalise(self, data: np.ndarray, offsets: np.ndarray) -> Normalised:
        """Longest prefixes of the character map replaced, white space squeezed if the model asks for it.

        The space that the model puts before (or behind) a text is not part of it yet.
        """
        rows, after = np.diff(offsets).astype(np.int32), np.diff(offsets).astype(np.int32)
        if not self.map.units.size and not self.squeeze:
            places = np.arange(data.size, dtype=np.int32)
            places = np.maximum.accumulate(np.where((data & 0xC0) == 0x80, 0, places)) if data.size else places
            source = places - np.repeat(offsets[:-1].astype(np.int32), rows)
            keep = self._without_escaped(data, np.ones(data.size, bool))
            return self._kept(data, source, np.asarray(offsets), keep, after, rows > 0)
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        row = np.searchsorted(offsets, starts, "right") - 1
        sizes = np.diff(np.append(starts, data.size))
        length, value = self.map.longest(data, starts, offsets[row + 1])
        free = self._free(starts, sizes, length)
        starts, row, sizes, length, value = (x[free] for x in (starts, row, sizes, length, value))
        known = length > 0
        made = np.where(known, self.map.sizes[value] if self.map.strings.size else 0, sizes)
        first_made = np.concatenate([[0], np.cumsum(made)])
        chunk = np.repeat(np.arange(starts.size), made)
        inside = np.arange(first_made[-1]) - first_made[chunk]
        out = np.zeros(chunk.size, np.uint8)
        own = ~known[chunk]
        out[own] = data[(starts[chunk] + inside)[own]]
        out[~own] = self.map.strings[(value[chunk] + inside)[~own]]
        source = starts[chunk] - offsets[row[chunk]]
        first = np.searchsorted(row[chunk], np.arange(rows.size + 1))
        keep, marked = np.ones(out.size, bool), rows > 0
        if self.squeeze:
            keep = self._squeezed(out, chunk, row, made, first_made)
            for r in range(rows.size):
                end = self._end(out, keep, first[r], first[r + 1])
                if end < first[r + 1] and keep[end : first[r + 1]].any():
                    after[r] = source[end + int(keep[end : first[r + 1]].argmax())]
                    keep[end : first[r + 1]] = False
            if self.suffix:
                blank = made == 1
                blank[blank] = out[first_made[:-1][blank]] == _SPACE
                marked = np.bincount(row[~blank], minlength=rows.size) > 0
            else:
                marked = np.bincount(row[chunk][keep], minlength=rows.size) > 0
        return self._kept(out, source, first, self._without_escaped(out, keep), after, marked)

    def _without_escaped(self, out: np.ndarray, keep: np.ndarray) -> np.ndarray:
        """Escaped spaces of the text itself become plain ones: first byte a space, the others not kept."""
        self._plain = out
        if not self.escape or not (out == _ESCAPED[0]).any():
            return keep
        at = np.flatnonzero((out[:-2] == _ESCAPED[0]) & (out[1:-1] == _ESCAPED[1]) & (out[2:] == _ESCAPED[2]))
        if at.size:
            self._plain = out.copy()
            self._plain[at] = _SPACE
            keep = keep.copy()
            keep[at + 1] = keep[at + 2] = False
        return keep

    def _kept(self, out, source, first, keep, after, marked) -> Normalised:
        out = self._plain
        if not keep.all():
            before = np.concatenate([[0], np.cumsum(keep)])
            out, source, first = out[keep], source[keep], before[first]
        return Normalised(out, first, source, after, marked)

    def _free(self, starts: np.ndarray, sizes: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Which characters no earlier prefix has taken, from left to right."""
        free, at = np.ones(starts.size, bool), -1
        for i in np.flatnonzero(length > sizes):
            if starts[i] >= at:
                at = starts[i] + length[i]
                free[i + 1 : np.searchsorted(starts, at)] = False
        return free

    def _squeezed(self, out, chunk, row, made, first_made) -> np.ndarray:
        """All bytes but the leading spaces of what follows a space or starts a text."""
        space = out == _SPACE
        other = np.maximum.accumulate(np.where(space, -1, np.arange(out.size))) if out.size else chunk
        leading = space & (other < first_made[chunk])
        full = np.flatnonzero(made > 0)
        follows = np.zeros(made.size, bool)
        if full.size:
            ends = out[first_made[full + 1] - 1] == _SPACE
            follows[full[0]] = True
            follows[full[1:]] = ends[:-1] | (row[full[1:]] != row[full[:-1]])
        return ~(leading & follows[chunk])

    def _end(self, out: np.ndarray, keep: np.ndarray, a: int, b: int) -> int:
        """The place behind the last kept byte of a text that is no space, plain or escaped."""
        while b > a:
            if not keep[b - 1] or out[b - 1] == _SPACE:
                b -= 1
            elif self.escape and b - a >= 3 and out[b - 3 : b].tobytes() == _ESCAPED:
                b -= 3
            else:
                break
        return b

    def _with_mark(self, n: Normalised) -> Normalised:
        """With one space before (or behind) every text that the model marks."""
        if not self.prefix:
            return n
        rows = np.flatnonzero(n.marked)
        where = (n.first[1:] if self.suffix else n.first[:-1])[rows]
        if self.suffix:
            source = n.after[rows]
        else:
            known = n.first[rows] < n.first[rows + 1]
            source = np.zeros(rows.size, n.source.dtype)
            source[known] = n.source[n.first[rows[known]]]
        at = where + np.arange(rows.size)
        data, places = np.empty(n.data.size + rows.size, np.uint8), np.empty(n.data.size + rows.size, n.source.dtype)
        old = np.ones(data.size, bool)
        old[at] = False
        data[at], places[at] = _SPACE, source
        data[old], places[old] = n.data, n.source
        return Normalised(data, n.first + np.concatenate([[0], np.cumsum(n.marked)]), places, n.after, n.marked)

    def parts(self, n: Normalised) -> np.ndarray:
        """First byte of each part that can be encoded on its own."""
        cut = (n.data & 0xC0) != 0x80
        cut[1:] &= ~self.joined.reshape(-1)[(n.data[:-1].astype(np.uint16) << 8) | n.data[1:]]
        cut[n.first[:-1][np.diff(n.first) > 0]] = True
        return np.flatnonzero(cut)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, first id of each text (one more at the end), first and end byte of each id in its text."""
        n = self._with_mark(self.normalise(data, offsets))
        none = np.zeros(0, np.int64)
        if not n.data.size:
            return none, np.zeros(n.first.size, np.int64), none, none
        starts = self.parts(n)
        limits = pa.py_buffer(np.append(starts, n.data.size))
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), starts.size, [None, limits, pa.py_buffer(n.data)])
        coded = parts.dictionary_encode()
        which = coded.indices.to_numpy()
        words = coded.dictionary.to_pylist()
        if self.escape:
            words = [w.replace(b" ", _ESCAPED) for w in words]
        found = self.plain.encode(words, num_threads=1)
        per = np.fromiter(map(len, found), np.int32, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(per.sum()))
        if self.bytewise:
            sizes = self.lengths[flat]
        else:
            names = self.plain.encode(words, out_type=str, num_threads=1)
            sizes = np.fromiter(map(self._size, chain.from_iterable(names)), np.int64, flat.size)
        counts = per[which]
        behind = np.cumsum(counts, dtype=np.int64)
        place = np.repeat((np.cumsum(per) - per)[which] - (behind - counts), counts) + np.arange(behind[-1])
        ids, sizes = flat[place], sizes[place]
        reach = np.cumsum(sizes)
        if reach[-1] != n.data.size:
            raise ValueError("pieces and normalised bytes differ in length; texts must be valid UTF-8")
        first = np.concatenate([[0], behind])[np.searchsorted(starts, n.first)]
        begins, ends = n.source[reach - sizes], n.source[np.minimum(reach, n.data.size - 1)]
        full = first[1:] > first[:-1]
        ends[first[1:][full] - 1] = n.after[full]
        return ids, first, begins, ends

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def _coder(model: bytes) -> Coder:
    """One coder for each worker process and model."""
    return Coder(model)


def _model(docs: DataFrame, path: str | None):
    """The model file (a fixed vocabulary), read on the driver and broadcast."""
    with open(path or public_tokenizers.path(MODEL), "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _binaries(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """One binary value a row, of the little-endian numbers ``first[row]`` to ``first[row + 1]``."""
    values = np.ascontiguousarray(values)
    offsets = (first * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), first.size - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def encode(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with BINARY ``ids``, ``begins``, ``ends``: unsigned 32-bit ids and the bytes of the text they span.

    Ids are those of the sentencepiece library for ``model`` (the path of a model
    file) without begin or end ids and without sampling.  A piece spans the bytes of the text
    from its first byte's source to the next piece's; what was dropped between two pieces belongs to the earlier
    one, and of several pieces of one replaced character only the last spans it.
    A null or empty text has no ids.  Rows stay in place; columns of these names
    are replaced, others kept.  Texts must be valid UTF-8.
    """
    shared = _model(docs, model)
    small_batches(docs.sparkSession)

    def make():
        def apply(texts: pa.Array) -> list:
            ids, first, begins, ends = _coder(shared.value).encode(*text_bytes(texts))
            return [_binaries(x.astype("<u4"), first) for x in (ids, begins, ends)]

        return apply

    return add_columns(docs, [text], make, "ids BINARY, begins BINARY, ends BINARY", GROUP_BYTES)


def decode(encoded: DataFrame, model: str | None = None, id_text: bool = False) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids`` as the library gives it; null ids give an empty one.

    ``id_text`` asks for a column of that name too: the ids in decimals with commas between them.
    """
    shared = _model(encoded, model)

    def make():
        names: list[str] = []

        def apply(column: pa.Array) -> list:
            data, offsets = text_bytes(column)
            values = data.view("<u4") if data.size else data
            ids = [values[a // 4 : b // 4].tolist() for a, b in zip(offsets, offsets[1:])]
            decoded = _coder(shared.value).decode(ids)
            if not id_text:
                return [decoded]
            names.extend(map(str, range(len(names), int(values.max(initial=0)) + 1)))
            return [decoded, [",".join([names[i] for i in row]) for row in ids]]

        return apply

    return add_columns(encoded, ["ids"], make, "decoded STRING" + (", id_text STRING" if id_text else ""))


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per document: number of ids, hash of the ids, hash of the text decoded from them, hash of the spans."""
    coded = encode(docs.select("doc_id", "text"), model=model)
    spans = F.sha2(F.concat("begins", "ends"), 256)
    kept = coded.select("doc_id", "ids", spans.alias("spans_sha256"))
    return decode(kept, model, id_text=True).select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("id_text", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "spans_sha256",
    )
