import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from affinis.llm import collocations as c

from .data import frame

COLUMNS = ["lang", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=5, least=100, percent=100):
    """The contract, phrase by phrase."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in found.items():
            for m in range(2, len(p)):
                inside |= {q for i in range(len(p) - m + 1) if 100 * a >= percent * found[q := p[i : i + m]]}
        for p, a in found.items():
            if p not in inside:
                score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                out.append((lang, " ".join(p), a, f[p[:k]], f[p[k:]], sizes[lang], score))
    return sorted(out)


def texts(seed, count):
    """Phrases of all lengths in a few languages, with every kind of break between and within them."""
    rng = random.Random(seed)
    words = ["the", "Of", "a.b", "x", "été", "ÉTÉ", "in to", "to", "日本", "y" * 300]
    fixed = ["new york city hall now", "in view of", "once upon a time there was", "bon jour", "x x x"]
    rows = []
    for _ in range(count):
        parts = [rng.choice(fixed) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(0, 30))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "? "]) for p in parts)
        rows.append((text, rng.choice(["en", "fr", None])))
    return rows


def documents(spark, rows):
    return spark.createDataFrame(rows, "text STRING, lang STRING")


@pytest.mark.parametrize("longest,least,percent", [(5, 10, 100), (3, 2, 60), (5, 40, 90), (6, 3, 100)])
def test_equals_brute_force(spark, longest, least, percent):
    rows = texts(longest + least, 300) + [(None, "en"), ("", None), (" \t. ,", "fr")]
    got = sorted(tuple(r) for r in c.collocations(documents(spark, rows), "text", "lang", longest, least, percent).collect())
    expected = brute(rows, longest, least, percent)
    assert len(expected) > 5 and got == expected


def test_query_on_repeated_rows_and_other_columns(spark):
    rows = [("Once upon a time. once UPON a time", "en")] * 60 + [("bon jour", None)] * 120
    df = documents(spark, rows).selectExpr("*", "1 AS f", "'x' AS phrase", "2 AS n", "3 AS w1", "4 AS words")
    got = sorted(tuple(r) for r in c.digest(df).select("rank", *COLUMNS).collect())
    assert got == sorted([(1, *brute(rows)[0]), (1, *brute(rows)[1])])


def test_ranks_break_ties_by_count_and_bytes(spark):
    rows = [("en", "b c", 5, 5, 5, 9, 7), ("en", "é x", 6, 5, 5, 9, 7), ("en", "a z", 5, 5, 5, 9, 7), ("fr", "z z", 1, 1, 1, 1, 1)]
    found = spark.createDataFrame(rows, "lang STRING, phrase STRING, a BIGINT, l BIGINT, r BIGINT, n BIGINT, score BIGINT")
    got = {(r.lang, r.rank): r.phrase for r in c.best(found, 2).collect()}
    assert got == {("en", 1): "é x", ("en", 2): "a z", ("fr", 1): "z z"}


def test_small_tables_of_bits_only_keep_more(spark, monkeypatch):
    """With tables of one page and hashes that meet often, windows stay longer and counts the same."""
    monkeypatch.setattr(c, "TABLE_BITS", 15)
    monkeypatch.setattr(c, "HASH_BITS", 16)
    monkeypatch.setattr(c, "COUNTED", 64)
    monkeypatch.setattr(c, "GROUP_BYTES", 500)
    rows = texts(9, 200)
    assert sorted(tuple(r) for r in c.collocations(documents(spark, rows), least=8).collect()) == brute(rows, least=8)


def test_empty_table(spark):
    assert c.digest(documents(spark, []).limit(0)).count() == 0
    assert c.digest(frame(spark, [(1, None, None)], ", lang STRING")).count() == 0


def test_products_beyond_64_bits(spark):
    big = 4 * 10**12
    found = spark.createDataFrame([("en", ["a", "b"], "a b", big, 5 * big)], "lang STRING, words ARRAY<STRING>, phrase STRING, a BIGINT, n BIGINT")
    parts = spark.createDataFrame([("en", "a", big), ("en", "b", big + 1)], "lang STRING, phrase STRING, f BIGINT")
    row = c._scores(found, parts).first()
    assert row.score == 1000 * big * 5 * big // (big * (big + 1))


def test_words_of_one_text_end_to_end():
    t = c.tokens(pa.array(["One two, Three", None, "four"]), pa.array(["en", "en", None]))
    assert t.words.take(pa.array(t.codes)).to_pylist() == ["one", "two", "three", "four"]
    assert t.followed.tolist() == [True, False, False, False]
    assert t.languages.take(pa.array(t.language)).to_pylist() == ["en", "en", "en", "und"]
    assert np.unique(t.hashes).size == 4
    with pytest.raises(ValueError):
        c.collocations(None, longest=2)
