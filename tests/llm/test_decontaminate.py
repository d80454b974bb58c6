import re
from hashlib import sha256

from affinis.llm import decontaminate as d

from .data import by_id, frame, passage

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, width=10):
    out = {}
    for doc_id, text in docs:
        w, hit, met = words(text), set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(width, len(v))
            for i in range(len(v) - n + 1 if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit |= set(range(j, j + n))
                        met.add("" if item is None else str(item))
        key = sha256(",".join(sorted(met)).encode()).hexdigest()
        out[doc_id] = (len(w), len(hit), len(met), key, bool(hit))
    return out


ITEMS = [(1, passage(1, 30)), (2, passage(2, 10)), (10, "Été, 3 Words"), (3, passage(1, 30)), (4, None), (5, ""), (6, "..."), (None, passage(7, 12))]
DOCS = [
    (1, None),
    (2, ""),
    (3, "?! ."),
    (4, passage(9, 300)),
    (5, passage(9, 50) + "\n" + passage(1, 30).upper() + " -- " + passage(8, 40)),
    (6, " ".join(passage(1, 30).split()[5:17])),
    (7, " ".join(passage(1, 30).split()[5:14])),
    (8, "x été 3 words, Été\t3 WORDS"),
    (9, passage(2, 10) + passage(2, 10)),
    (10, passage(11, 3000) + " " + passage(7, 12)),
    (11, "a" * 3_000_000 + " " + passage(2, 10)),
]
COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id BIGINT, text STRING")


def test_equals_brute_force(spark):
    assert by_id(d.digest(frame(spark, DOCS), benchmark(spark)), *COLUMNS) == brute(DOCS, ITEMS)


def test_blocks_change_nothing(spark):
    docs, items = frame(spark, DOCS), benchmark(spark)
    whole = d.find_contamination(docs, items)
    parts = d.find_contamination(docs, items, block_bytes=200)
    columns = ("n_words", "n_hit", "items", "spans")
    assert by_id(whole, *columns) == by_id(parts, *columns)


def test_rows_and_names_stay(spark):
    docs = frame(spark, [(4, DOCS[4][1], 1, "x")] * 3 + [(None, None, None, None)], ", n_hit INT, items STRING")
    found = d.find_contamination(docs.select("doc_id", "text"), benchmark(spark))
    assert found.count() == 4 and found.filter("n_hit > 0").count() == 3
    assert d.find_contamination(docs, benchmark(spark)).columns == ["doc_id", "text", "n_words", "n_hit", "items", "spans"]


def test_removal(spark):
    found = d.find_contamination(frame(spark, DOCS), benchmark(spark))
    left = by_id(d.remove_spans(found), "text")
    again = by_id(d.digest(frame(spark, [(i, t[0]) for i, t in left.items()]), benchmark(spark, ITEMS[:2])), "n_hit")
    assert all(v == (0,) for v in again.values())
    assert left[4] == (DOCS[3][1],) and left[1] == (None,)
    assert set(by_id(d.remove_documents(found), "text")) == {1, 2, 3, 4, 7, 9}


def test_empty_tables(spark):
    assert d.digest(frame(spark, []), benchmark(spark)).count() == 0
    assert by_id(d.digest(frame(spark, DOCS), benchmark(spark, [])), "n_hit")[5] == (0,)
