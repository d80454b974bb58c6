"""Token ids in directly addressable codes.

An id is cut into chunks of eight bits.  The lowest chunks of all ids form level 0; a
bitmap marks the ids that go on, whose next chunks form level 1, and so on.  A rank
directory counts the marks before each block of a bitmap, so the place of an id's next
chunk is found without decoding anything else.

A token file is a Parquet table of segments in id order, written and committed by
Spark.  A segment is one value of bytes, all numbers little-endian:

    magic "DAC1", uint32 documents, uint64 ids, uint32 levels,
    int64 id of each document, uint8 1 where that id is null, uint64 end of each document,
    per level: uint64 chunks, the chunks, the bitmap, the rank directory (uint32).
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from affinis.llm.text import byte_class, find_words, row_groups, small_batches, text_bytes
from affinis.plans.staging import shared_folder

# Spark runs a task on each core, so the library need not start threads of its own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "word_bpe_49k.json"
END = 2
# Ids in a segment before it is closed after a document.
SEGMENT_IDS = 1 << 16
# Bits of a bitmap that one entry of its rank directory covers.
BLOCK = 512
# Words remembered by a worker process, words given to the library at once, and bytes of text worked on together.
REMEMBERED = 300_000
BATCH_WORDS = 2_000
GROUP_BYTES = 4 << 20

MAGIC = b"DAC1"
FILE = "part INT, seq INT, start BIGINT, n_ids BIGINT, segment BINARY"
DOCUMENT = "doc_id BIGINT, start BIGINT, ids BINARY"

SPACE = byte_class([(0x09, 0x0D), (0x20, 0x20)])
ALPHANUMERIC = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)])
STOPS = byte_class([(b, b) for b in b".,;:!?"])


def _cut(data: np.ndarray) -> np.ndarray:
    """A stop after a letter or digit always starts a new token, and nothing is composed across it."""
    return STOPS[data[1:]] & ALPHANUMERIC[data[:-1]]


class Encoder:
    """Ids of texts by a vocabulary of the tokenizers library, whose tokens don't cross the cuts made here.

    Each distinct word is given to the library once, and remembered; words are
    told apart by all their bytes.
    """

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _ids(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words; those of plain letters are one piece to the library and go to its model at once."""
        found: list[list[int] | None] = [None] * len(words)
        others = []
        for k, word in enumerate(words):
            if word.isalpha():
                found[k] = [t.id for t in self.tokenizer.model.tokenize(word.decode())]
            else:
                others.append(k)
        for a in range(0, len(others), BATCH_WORDS):
            part = others[a : a + BATCH_WORDS]
            coded = self.tokenizer.encode_batch([words[k].decode() for k in part], add_special_tokens=False)
            for k, one in zip(part, coded):
                found[k] = one.ids
        return found

    def _learn(self, words: list[bytes]) -> None:
        ids = self._ids(words)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        at, used = len(self.known), self.used + int(sizes.sum())
        while at + len(ids) > self.starts.size:
            self.starts, self.sizes = np.resize(self.starts, 2 * self.starts.size), np.resize(self.sizes, 2 * self.sizes.size)
        while used > self.ids.size:
            self.ids = np.resize(self.ids, 2 * self.ids.size)
        self.ids[self.used : used] = np.fromiter(chain.from_iterable(ids), np.uint32, used - self.used)
        self.starts[at : at + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[at : at + len(ids)] = sizes
        self.known.update(zip(words, range(at, at + len(ids))))
        self.used = used

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``end``, and the end of each text among them."""
        data, offsets = text_bytes(texts)
        words = find_words(data, offsets, ~SPACE, lower=False, cut=_cut, hashed=False)
        # The words, end to end, are all bytes but the white space; Arrow compares them whole.
        limits = np.zeros(words.starts.size + 1, np.int64)
        np.cumsum(words.ends - words.starts, out=limits[1:])
        buffers = [None, pa.py_buffer(limits), pa.py_buffer(data[~SPACE[data]])]
        coded = pa.Array.from_buffers(pa.large_binary(), words.starts.size, buffers).dictionary_encode()
        which, spelled = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        # The vocabulary is of lower case; other letters than A-Z may not be composed alike in both cases.
        spelled = [w.lower() if w.isascii() else w for w in spelled]
        if len(self.known) > REMEMBERED:
            self._forget()
        new = [w for w in dict.fromkeys(spelled) if w not in self.known]
        if new:
            self._learn(new)
        row = np.fromiter(map(self.known.__getitem__, spelled), np.int64, len(spelled))[which]
        # The end of a text is one more word, the last of each.
        at = words.first[1:]
        starts = np.insert(self.starts[row], at, self.used)
        sizes = np.insert(self.sizes[row], at, 1)
        stored = np.append(self.ids[: self.used], np.uint32(end))
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if ends.size else 0
        ids = stored[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]
        return ids, ends[at + np.arange(at.size)]


_encoders: dict[str, Encoder] = {}


def encoder_of(vocabulary: str) -> Encoder:
    """The encoder of a worker process, kept from task to task with the words it knows."""
    if vocabulary not in _encoders:
        _encoders.clear()
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def write_segment(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment of documents with the given ids, document k ending before ``ends[k]``."""
    levels, left = [], ids.astype(np.uint32)
    while left.size:
        more = left > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, more.size, BLOCK), dtype=np.uint32)
        ranks = np.cumsum(blocks, dtype=np.uint32) - blocks
        parts = (struct.pack("<Q", left.size), (left & 0xFF).astype(np.uint8).tobytes(), bits.tobytes())
        levels.append(b"".join(parts) + ranks.astype("<u4").tobytes())
        left = left[more] >> np.uint32(8)
    head = MAGIC + struct.pack("<IQI", len(doc_ids), ids.size, len(levels))
    nulls = np.array([i is None for i in doc_ids], np.uint8)
    names = np.array([i or 0 for i in doc_ids], "<i8")
    return b"".join([head, names.tobytes(), nulls.tobytes(), ends.astype("<u8").tobytes(), *levels])


class Segment:
    """Reads a segment without copying it."""

    def __init__(self, data: bytes) -> None:
        data = memoryview(data)
        if data[:4] != MAGIC:
            raise ValueError("not a token segment")
        documents, self.n_ids, levels = struct.unpack_from("<IQI", data, 4)
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        names, nulls = take("<i8", documents), take("u1", documents)
        self.doc_ids = [None if null else int(i) for i, null in zip(names, nulls)]
        self.ends = take("<u8", documents).astype(np.int64)
        self.levels = []
        for _ in range(levels):
            count = int(take("<u8", 1)[0])
            self.levels.append((take("u1", count), take("u1", -(-count // 8)), take("<u4", -(-count // BLOCK))))

    def __getitem__(self, place: int) -> int:
        """The id at one place, from one chunk and one rank a level."""
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[place]) << 8 * level
            if not bits[place >> 3] >> (place & 7) & 1:
                break
            first = place // BLOCK * (BLOCK // 8)
            before = int(np.bitwise_count(bits[first : place >> 3]).sum())
            rest = int(bits[place >> 3]) & (1 << (place & 7)) - 1
            place = int(ranks[place // BLOCK]) + before + rest.bit_count()
        return value

    def ids(self) -> np.ndarray:
        """All ids."""
        values: np.ndarray | None = None
        for chunks, bits, _ in reversed(self.levels):
            own = chunks.astype(np.uint32)
            if values is not None:
                own[np.unpackbits(bits, count=own.size, bitorder="little").astype(bool)] |= values << np.uint32(8)
            values = own
        return np.zeros(0, np.uint32) if values is None else values

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, first place and ids of each document."""
        ids, start = self.ids(), 0
        for doc_id, end in zip(self.doc_ids, self.ends.tolist()):
            yield doc_id, start, ids[start:end]
            start = end


def _write(encoder: Callable[[], Encoder], end: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(), TaskContext.get().partitionId()
        seq = start = held = 0
        names, ids, sizes = [], [], []

        def segment() -> pa.RecordBatch:
            nonlocal seq, start, held, names, ids, sizes
            data = write_segment(names, np.cumsum(np.concatenate(sizes)), np.concatenate(ids))
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.array([data], pa.binary()),
                ],
                names=["part", "seq", "start", "n_ids", "segment"],
            )
            seq, start, held = seq + 1, start + held, 0
            names, ids, sizes = [], [], []
            return row

        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in row_groups(offsets, GROUP_BYTES):
                coded, ends = own.encode(batch.column(1).slice(a, b - a), end)
                doc_ids = batch.column(0).slice(a, b - a).to_pylist()
                done = row = 0
                while row < len(doc_ids):
                    # Up to the first document with which the segment is full.
                    to = int(np.searchsorted(ends, done + segment_ids - held)) + 1
                    to = min(to, len(doc_ids))
                    names += doc_ids[row:to]
                    sizes.append(np.diff(ends[row:to], prepend=done))
                    ids.append(coded[done : ends[to - 1]])
                    held += int(ends[to - 1]) - done
                    done, row = int(ends[to - 1]), to
                    if held >= segment_ids:
                        yield segment()
        if names:
            yield segment()

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end: int = END,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode whole texts and write them as token files in ascending order of id.

    A null text counts as empty and has the end id alone.  Null ids come first;
    rows of one id follow a hash of their text, and may be split between files.
    ``vocabulary`` is the path of a file of the tokenizers library, read on the
    driver and broadcast (a fixed vocabulary).  An empty table gives no segment.
    """
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    rows.mapInArrow(_write(lambda: encoder_of(shared.value), end, segment_ids), FILE).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of the documents in token files; ``start`` counts the ids of all before.

    One count per file comes to the driver.
    """
    files = spark.read.schema(FILE).parquet(path)
    counts = sorted(tuple(row) for row in files.groupBy("part").agg(F.sum("n_ids")).collect())
    before = dict(zip([c[0] for c in counts], np.cumsum([0, *(c[1] for c in counts)]).tolist()))
    shared = spark.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, data in zip(*(batch.column(k) for k in range(3))):
                first = shared.value[part.as_py()] + start.as_py()
                found = list(Segment(data.as_buffer()).documents())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d[0] for d in found], pa.int64()),
                        pa.array([first + d[1] for d in found], pa.int64()),
                        pa.array([d[2].astype("<u4").tobytes() for d in found], pa.binary()),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    return files.select("part", "start", "segment").mapInArrow(run, DOCUMENT)


def digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document from the files read back: place, number and checksum of its ids."""
    path = f"{shared_folder(docs.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, vocabulary=vocabulary)
    read = read_tokens(docs.sparkSession, path)
    return read.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
