import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from affinis.llm import bpe, exact, language
from affinis.llm.text import held_out

from .data import passage
from .test_bpe import RANKS
from .test_decontaminate import brute as hits
from .test_exact import norm
from .test_jaccard import brute as groups
from .test_jaccard import edited


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with extra columns named like the operators' own, and a benchmark."""
    rng = random.Random(4)
    item = passage(70, 30)
    texts = [passage(k, rng.randrange(20, 200)) for k in range(60)]
    texts += [texts[1].upper(), texts[2], None, "", "12 34", item + " " + passage(80, 60), passage(81, 9) + " " + item]
    texts += [edited(texts[k], rng, 0.01) for k in range(10) for _ in range(3)]
    rows = [(500 - k, t, "en" if k % 3 else None, k, True, "x") for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, None, None, None, None, None), (None, texts[5], None, 1, None, None)]
    path = tmp_path_factory.mktemp("corpus")
    schema = "doc_id BIGINT, text STRING, lang STRING, row INT, kept BOOLEAN, c0 STRING"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    items = [(1, item), (None, None), (2, passage(71, 12))]
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(f"{path}/benchmark.parquet")
    return str(path), items


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_each_stage_equals_brute_force(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = docs.columns

    model = language.learn(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    kept = p.recognised(spark, docs, path)
    assert kept.columns == names
    expected = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert model.languages == ["en"] and rows_of(kept) == sorted(map(tuple, expected), key=str)

    docs = spark.createDataFrame(expected, kept.schema).coalesce(2)
    kept = p.without_copies(spark, docs, path)
    best = {}
    for r in expected:
        key = norm(r.text)
        if key not in best or exact.higher(r.doc_id, best[key].doc_id):
            best[key] = r
    assert rows_of(kept) == sorted(map(tuple, best.values()), key=str)

    before = list(best.values()) + [best[norm(expected[0].text)]] * 2
    docs = spark.createDataFrame(before, kept.schema).coalesce(2)
    kept = p.without_near_copies(spark, docs, path)
    component = groups([(k, r.text) for k, r in enumerate(before)])
    chosen = {}
    for k, _, c in component:
        key = (before[k].doc_id is None, before[k].doc_id, k)
        if c not in chosen or key < chosen[c]:
            chosen[c] = key
    left = [before[key[2]] for key in chosen.values()]
    assert len(left) < len(before) - 10 and rows_of(kept) == sorted(map(tuple, left), key=str)

    docs = spark.createDataFrame(left, kept.schema)
    kept = p.without_benchmark(spark, docs, path)
    hit = [hits([(0, r.text)], items)[0][-1] for r in left]
    assert any(hit) and rows_of(kept) == sorted((tuple(r) for r, h in zip(left, hit) if not h), key=str)

    codec = bpe.Codec(RANKS)
    for r in p.encoded(spark, kept, path).join(kept.select("doc_id", "text"), "doc_id").collect():
        assert bytes(r.ids) == codec.encode(r.text).tobytes() and r.n_tokens == len(r.ids) // 4
        assert r.decoded_sha256 == sha256(r.text.encode()).hexdigest()


def test_run_is_all_stages(spark, folder):
    path, _ = folder
    result = p.run(spark, path).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert [name for name, _ in p.STAGES] == ["language", "exact_dedup", "jaccard_join", "decontaminate", "byte_bpe"]
    assert len({r.doc_id for r in result}) == len(result) > 50
    for r in result:
        assert np.frombuffer(r.ids, "<u4").tolist() == bpe.Codec(RANKS).encode(texts[r.doc_id]).tolist()


def test_empty_tables(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, function in p.STAGES:
        assert function(spark, docs, path).count() == 0


def test_without_labels_texts_with_letters_stay(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    kept = p.recognised(spark, docs, path)
    assert kept.count() == docs.filter("text rlike '\\\\p{L}'").count() > 0
