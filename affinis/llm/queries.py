"""The operators applied to whole tables of a test folder, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from affinis.llm import (
    bpe, collocations, cross_entropy, decontaminate, exact, hard_negatives, jaccard, language, passages, pieces, quality,
    suffix, tokens,
)
from affinis.llm.text import read


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.digest(read(spark, folder, "documents"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.digest(read(spark, folder, "documents"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.digest(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.digest(read(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.digest(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked_groups(read(spark, folder, "documents"))


def op7_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.digest(read(spark, folder, "documents"))


def op8_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    return cross_entropy.digest(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.digest(read(spark, folder, "documents"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(read(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.digest(read(spark, folder, "embeddings"))


def op12_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest(read(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.digest(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language": op2_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_token_files": op4_token_files,
    "op5_quality": op5_quality,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_passages": op7_passages,
    "op8_cross_entropy": op8_cross_entropy,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_pieces": op12_pieces,
    "op13_collocations": op13_collocations,
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op1_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256({LOWER}) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY {LOWER})""",
    "op11_hard_negatives": """
        WITH points AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                list_dot_product(a.v, b.v)::BIGINT AS score
            FROM points a JOIN points b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id,
            row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
            vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
            AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
    "op13_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        texts AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces),
        places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
        spans AS (SELECT lang, w[i:i + k - 1] AS p FROM places, range(1, 6) AS ks(k) WHERE i + k - 1 <= len(w)),
        f AS (SELECT lang, p, count(*)::HUGEINT AS f FROM spans GROUP BY ALL),
        sizes AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE len(p) = 1 GROUP BY lang),
        found AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= 100),
        cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM found),
        scored AS (
            SELECT c.lang, c.p, c.a, x.f AS l, y.f AS r, n, k, (1000 * c.a * n) // (x.f * y.f) AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:]
            JOIN sizes s ON s.lang = c.lang),
        worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
        starts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS i FROM found WHERE len(p) > 2),
        inner_spans AS (
            SELECT lang, p[i:i + m - 1] AS p, a FROM starts, range(2, 5) AS ms(m) WHERE m < len(p) AND i + m - 1 <= len(p)),
        covers AS (SELECT lang, p, max(a) AS most FROM inner_spans GROUP BY ALL),
        named AS (
            SELECT w.*, array_to_string(w.p, ' ') AS phrase FROM worst w LEFT JOIN covers v ON v.lang = w.lang AND v.p = w.p
            WHERE v.most IS NULL OR 100 * v.most < 100 * w.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
            a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM named QUALIFY rank <= 2000""",
}
