from collections import defaultdict
from hashlib import sha256

import pytest

from affinis.llm import exact

from .data import by_id, frame, passage


def norm(text):
    return (text or "").encode().lower()


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[norm(text)].append(doc_id)
    return {
        i: (max(groups[norm(t)]), len(groups[norm(t)]), i == max(groups[norm(t)]), sha256(norm(t)).hexdigest())
        for i, t in rows
    }


ROWS = [(1, None), (2, ""), (3, "Abc É"), (4, "aBC É"), (5, "abc é"), (6, " abc É"), (7, passage(1, 50_000))]
ROWS += [(8, ROWS[-1][1].upper())] + [(100 + i, "the same " + "x" * (i % 3)) for i in range(300)]
ROWS += [(1000 + i, passage(i % 90, 30 + i % 7)) for i in range(400)]
COLUMNS = ("keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("table_bytes", [1, 3000, exact.TABLE_BYTES])
def test_equals_brute_force(spark, table_bytes):
    """Tables of a few entries go through many rounds and give the same groups."""
    rows = ROWS if table_bytes > 1 else ROWS[:20]
    docs = frame(spark, rows).repartition(5)
    assert by_id(exact.exact_groups(docs, table_bytes=table_bytes), *COLUMNS) == brute(rows)


def test_table_compares_contents():
    table = exact.Table()
    same = b"\0" * 32
    entries = [table.add(same, b"%d" % i) for i in range(500)]
    assert [table.find(same, b"%d" % i) for i in range(500)] == entries
    assert table.find(same, b"500") == -1


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a")] * 4 + [(None, "a"), (None, None), (None, ""), (3, "b"), (3, "c")]
    found = exact.exact_groups(frame(spark, rows).repartition(4)).collect()
    assert len(found) == len(rows)
    kept = [(r.doc_id, r.text) for r in found if r.kept]
    assert sorted(kept, key=str)[:3] == [(3, "b"), (3, "c"), (5, "a")] and len(kept) == 4
    assert {(r.text, r.keep_id, r.group_size) for r in found} == {
        ("a", 5, 5), ("b", 3, 1), ("c", 3, 1), (None, None, 2), ("", None, 2)
    }


def test_names(spark):
    docs = frame(spark, [(1, "a", "x", True)], ", lang STRING, kept BOOLEAN")
    row = exact.exact_groups(docs).collect()[0].asDict()
    assert row["lang"] == "x" and row["kept"] and row["keep_id"] == 1


def test_empty_table(spark):
    assert exact.digest(frame(spark, [])).count() == 0
