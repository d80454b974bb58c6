import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from affinis.llm import suffix as s

from .data import frame, passage


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(t), int(gone.sum()), spans, sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.drop("kept").collect()), key=str)


def cases():
    rng = random.Random(3)
    shared = [passage(50 + k, n) for k, n in enumerate((8, 12, 30, 60, 200))]
    rows = [(1, None), (2, ""), (3, "é" * 500), (4, "ab" * 700), (5, shared[4]), (5, shared[4]), (6, "x" + shared[4][:399])]
    for k in range(80):
        parts = [rng.choice(shared) if rng.random() < 0.4 else passage(rng.random(), rng.randrange(5, 90)) for _ in range(rng.randrange(1, 6))]
        rows.append((100 + k, (" " if k % 2 else "\n").join(parts)))
    base = passage(9, 400)
    for k in range(30):
        words = base.split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(400)] = "edit%d" % rng.randrange(999)
        rows.append((300 + k, " ".join(words)))
    return rows


def test_suffixes_in_order():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 40, 300):
        for alphabet in (1, 2, 5, 256):
            text = rng.integers(1, alphabet + 1, n).astype(np.uint16)
            symbols = np.append(text, 0).astype(np.uint16)
            order = s.sort_suffixes(symbols, np.arange(n + 1), s.smaller_than_next(symbols), n + 1)
            assert order.tolist() == sorted(range(n + 1), key=lambda i: symbols[i:].tolist())


@pytest.mark.parametrize("length", [1, 3, 5, 20])
def test_repeated_starts(length):
    rng = random.Random(length)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(length, 60))) for _ in range(rng.randrange(1, 6))]
        count = Counter(t[i : i + length] for t in strings for i in range(len(t) - length + 1))
        expected = [[count[t[i : i + length]] > 1 for i in range(len(t) - length + 1)] for t in strings]
        assert [r.tolist() for r in s.repeated_starts(strings, length)] == expected


def test_runs_cover_all_windows(monkeypatch):
    monkeypatch.setattr(s, "SCAN", 700)
    data = np.frombuffer(passage(1, 900).encode(), np.uint8)
    _, _, low, high = s.window_runs(data, 400, 32)
    assert [p for a, b in zip(low, high) for p in range(a, b + 1)] == list(range(data.size - 399))


@pytest.mark.parametrize("length,gram,anchor_bytes", [(400, 32, s.ANCHOR_BYTES), (400, 32, 0), (60, 8, s.ANCHOR_BYTES)])
def test_equals_brute_force(spark, length, gram, anchor_bytes):
    """Also with every anchor taken window by window."""
    rows = cases()
    docs = frame(spark, rows).repartition(5)
    assert found(s.remove_repeats(docs, length=length, gram=gram, anchor_bytes=anchor_bytes)) == brute(rows, length)


def test_small_sorts_and_scans(spark, monkeypatch):
    monkeypatch.setattr(s, "SORTED_BYTES", 2000)
    monkeypatch.setattr(s, "SCAN", 501)
    rows = cases()
    assert found(s.remove_repeats(frame(spark, rows))) == brute(rows, 400)


def test_long_texts_null_ids_and_names(spark):
    long = passage(1, 60_000)
    rows = [(None, long), (7, "start " + long[5000:9000]), (None, "z" * 399), (None, "z" * 399), (8, "q" * 100_000)]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "1 AS n", "text AS tid")
    result = {r.n_bytes: r for r in s.remove_repeats(docs).collect()}
    assert result[len(long)].n_removed == 4000 and result[4006].n_removed == 4000 and result[4006].n_spans == 1
    assert bytes(result[4006].kept) == b"start " and result[399].n_removed == 0
    assert result[100_000].n_removed == 100_000
    assert s.digest(frame(spark, [])).count() == 0
