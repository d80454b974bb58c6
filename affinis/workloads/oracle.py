"""The results of ``queries`` in plain SQL over the same tables, for comparison.

Written from the definitions, without the plans of the operators: sets are
compared by a plain self-join, weights by a plain self-join and aggregate.
"""

from __future__ import annotations

# Written out here and not imported, so that a change of the operators' settings shows.
PRIME = 2147483647
HALF = 268435456
NUM_HASHES = 600
ROWS_PER_BAND = 4
SEED = 42
SET_PARTS = 16
HOLDOUT_FROM = "2000-12-01"

ORACLE: dict[str, str] = {}


def _with(*steps: str) -> str:
    return "WITH " + ",\n".join(steps) + "\n"


def _rated(name: str, item: str, where: str = "") -> str:
    return f"""{name} AS (
    SELECT o_custkey AS "user", {item} AS item, CAST(max(1 + floor((l_quantity - 1) / 10)) AS DOUBLE) AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey {where} GROUP BY o_custkey, {item})"""


def _split(item: str = "l_partkey") -> str:
    return ",\n".join(
        [
            _rated("ratings", item),
            _rated("test", item, f"WHERE o_orderdate >= TIMESTAMP '{HOLDOUT_FROM} 00:00:00'"),
            """train AS (SELECT r."user", r.item, r.rating FROM ratings r WHERE NOT EXISTS (
    SELECT 1 FROM test t WHERE t."user" = r."user" AND t.item = r.item))""",
        ]
    )


RATINGS = _rated("ratings", "l_partkey")
TRAIN = _split()
SUPPLIER_TRAIN = _split("l_suppkey")


def _r(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {name}"


# Ratings

ORACLE["ratings"] = ORACLE["ratings_from_csv"] = _with(RATINGS) + 'SELECT "user", item, rating FROM ratings'
ORACLE["ratings_without_header_lines"] = ORACLE["ratings"]
ORACLE["ratings_from_three_columns"] = _with(TRAIN) + 'SELECT "user", item, rating FROM test'
ORACLE["train_minus_test"] = _with(TRAIN) + 'SELECT "user", item, rating FROM train'

for _entity, _other in (("user", "item"), ("item", "user")):
    ORACLE[f"{_entity}_mean"] = (
        _with(RATINGS)
        + f'SELECT "{_entity}" AS id, count(*) AS n, {_r("avg(rating)", "mean")} FROM ratings GROUP BY "{_entity}"'
    )
    ORACLE[f"{_entity}_{_other}_sets"] = (
        _with(
            RATINGS,
            f"""members AS (SELECT "{_entity}" AS id, "{_other}" AS e, count(*) OVER (PARTITION BY "{_entity}") AS n,
    ('0x' || substr(md5(CAST("{_other}" AS VARCHAR)), 1, 7))::BIGINT % {SET_PARTS} AS part FROM ratings)""",
        )
        + "SELECT id, part, n, string_agg(CAST(e AS VARCHAR), ',' ORDER BY e) AS elements"
        + " FROM members GROUP BY id, part, n"
    )

ORACLE["ratings_apart"] = (
    _with(RATINGS)
    + """SELECT CASE WHEN item % 50 IN (0, 2) THEN 'fields' WHEN item % 50 = 1 THEN 'empty' ELSE 'good' END AS kind,
    CASE item % 50 WHEN 0 THEN concat_ws(',', "user", item) WHEN 1 THEN concat_ws(',', '', item, rating)
        WHEN 2 THEN concat_ws(',', "user", 'item', rating, 0) ELSE concat_ws(',', "user", item) END AS value
    FROM ratings"""
)
ORACLE["ratings_apart_counts"] = (
    _with(RATINGS)
    + "SELECT count(*) AS lines, count(*) FILTER (WHERE item % 50 <> 0) AS good,"
    + " count(*) FILTER (WHERE item % 50 = 0) AS bad FROM ratings"
)

ORACLE["item_user_bags"] = f"""WITH counts AS (SELECT l_suppkey AS id, o_custkey AS e, count(*) AS c,
        ('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 7))::BIGINT % {SET_PARTS} AS part
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
sizes AS (SELECT id, CAST(sum(c) AS BIGINT) AS n FROM counts GROUP BY id)
SELECT id, part, n, string_agg(CAST(e AS VARCHAR), ',' ORDER BY e) AS elements,
    string_agg(CAST(c AS VARCHAR), ',' ORDER BY e) AS counts
FROM counts JOIN sizes USING (id) GROUP BY id, part, n"""

# Set similarity

ORACLE["known_pairs"] = """SELECT DISTINCT least(o_custkey, l_suppkey) AS id1, greatest(o_custkey, l_suppkey) AS id2
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey <> l_suppkey"""
SUPPLIER_CUSTOMERS = """sets AS (SELECT DISTINCT l_suppkey AS id, o_custkey AS element
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SUPPLIER_MARKETS = """sets AS (
    SELECT DISTINCT l_suppkey AS id, c_nationkey * 1000 + CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS element
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""
SHINGLES = r"""texts AS (
    SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w
    FROM documents),
places AS (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM texts WHERE len(w) >= 3),
sets AS (SELECT DISTINCT id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS element FROM places
    UNION ALL SELECT id, array_to_string(w, ' ') FROM texts WHERE len(w) IN (1, 2))"""
TRAIN_SETS = 'sets AS (SELECT item AS id, "user" AS element FROM train)'

MINHASH = f"""coefficients AS (
    SELECT k, 1 + ('0x' || substr(md5('{SEED}a' || k), 1, 8))::BIGINT % {PRIME - 1} AS a,
        ('0x' || substr(md5('{SEED}b' || k), 1, 8))::BIGINT % {PRIME} AS b,
        1 + ('0x' || substr(md5('{SEED}c' || k), 1, 8))::BIGINT % {PRIME - 1} AS c
    FROM range({NUM_HASHES}) AS r(k)),
hashed AS (SELECT id, ('0x' || substr(md5(CAST(element AS VARCHAR)), 1, 7))::BIGINT AS x,
    ('0x' || substr(md5(CAST(element AS VARCHAR)), 8, 7))::BIGINT AS y FROM sets),
minima AS (SELECT id, k, min(((a * x + c * y + b) % {PRIME}) * {HALF} + y) AS h
    FROM hashed, coefficients GROUP BY id, k),
banded AS (SELECT id, k // {ROWS_PER_BAND} AS band, string_agg(CAST(h AS VARCHAR), ',' ORDER BY k) AS sig
    FROM minima GROUP BY id, k // {ROWS_PER_BAND})"""
CANDIDATES = """candidates AS (SELECT DISTINCT a.id AS id1, b.id AS id2
    FROM banded a JOIN banded b ON a.band = b.band AND a.sig = b.sig AND a.id < b.id)"""
OVERLAP = """sizes AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
overlap AS (SELECT a.id AS id1, b.id AS id2, count(*) AS inter
    FROM sets a JOIN sets b ON a.element = b.element AND a.id < b.id GROUP BY a.id, b.id),
compared AS (SELECT id1, id2, inter, x.n + y.n - inter AS uni,
    CAST(inter AS DOUBLE) / CAST(x.n + y.n - inter AS DOUBLE) AS jaccard
    FROM overlap JOIN sizes x ON x.id = id1 JOIN sizes y ON y.id = id2)"""

ORACLE["minhash_signatures"] = (
    _with(SUPPLIER_CUSTOMERS, MINHASH) + "SELECT id, CAST(k AS BIGINT) AS k, CAST(h AS BIGINT) AS h FROM minima"
)
ORACLE["lsh_buckets"] = (
    _with(SUPPLIER_CUSTOMERS, MINHASH)
    + "SELECT CAST(band AS BIGINT) AS band, sig, count(*) AS n FROM banded GROUP BY band, sig HAVING count(*) > 1"
)
ORACLE["lsh_bucket_sets"] = (
    _with(
        SUPPLIER_MARKETS,
        MINHASH,
        "shared AS (SELECT count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM banded GROUP BY band, sig)",
    )
    + "SELECT n, count(DISTINCT ids) AS sets FROM shared WHERE n > 1 GROUP BY n"
)
# One hash; bin i of 600 takes, where empty, the first filled one of (start + t * step) modulo the prime 601.
BIN_PRIME = 601
BINS = f"""draws AS (
    SELECT i, 1 + ('0x' || substr(md5('{SEED + 1}a' || i), 1, 8))::BIGINT % {PRIME - 1} AS a,
        ('0x' || substr(md5('{SEED + 1}b' || i), 1, 8))::BIGINT % {PRIME} AS b FROM range({NUM_HASHES}) AS r(i)),
orders AS (SELECT i, t, (b % {BIN_PRIME} + t * (1 + a % {BIN_PRIME - 1})) % {BIN_PRIME} AS j
    FROM draws, range({BIN_PRIME}) AS ts(t)),
one AS (SELECT 1 + ('0x' || substr(md5('{SEED}a0'), 1, 8))::BIGINT % {PRIME - 1} AS a,
    ('0x' || substr(md5('{SEED}b0'), 1, 8))::BIGINT % {PRIME} AS b,
    1 + ('0x' || substr(md5('{SEED}c0'), 1, 8))::BIGINT % {PRIME - 1} AS c),
hashed AS (SELECT id, ('0x' || substr(md5(CAST(element AS VARCHAR)), 1, 7))::BIGINT AS x,
    ('0x' || substr(md5(CAST(element AS VARCHAR)), 8, 7))::BIGINT AS y FROM sets),
filled AS (SELECT id, v % {NUM_HASHES} AS j, min(v * {HALF} + y) AS h
    FROM (SELECT id, y, (a * x + c * y + b) % {PRIME} AS v FROM hashed, one) GROUP BY ALL),
minima AS (SELECT id, i AS k, arg_min(h, CASE WHEN i = j THEN -1 ELSE t END) AS h FROM filled JOIN orders USING (j) GROUP BY id, i),
banded AS (SELECT id, k // {ROWS_PER_BAND} AS band, string_agg(CAST(h AS VARCHAR), ',' ORDER BY k) AS sig
    FROM minima GROUP BY id, k // {ROWS_PER_BAND})"""
ORACLE["minhash_bin_signatures"] = (
    _with(SUPPLIER_CUSTOMERS, BINS) + "SELECT id, CAST(k AS BIGINT) AS k, CAST(h AS BIGINT) AS h FROM minima"
)
ORACLE["lsh_candidates"] = _with(SUPPLIER_CUSTOMERS, MINHASH, CANDIDATES) + "SELECT id1, id2 FROM candidates"
ORACLE["jaccard_verified"] = (
    _with(SUPPLIER_CUSTOMERS, MINHASH, CANDIDATES, OVERLAP)
    + f"SELECT id1, id2, inter, uni, {_r('jaccard', 'jaccard')} FROM compared JOIN candidates USING (id1, id2)"
)
_SIMILAR = (
    f"SELECT id1, id2, {_r('jaccard', 'jaccard')} FROM compared JOIN candidates USING (id1, id2) WHERE jaccard >= 0.5"
)
ORACLE["similar_items_jaccard"] = _with(SUPPLIER_MARKETS, MINHASH, CANDIDATES, OVERLAP) + _SIMILAR
ORACLE["similar_items_bins"] = _with(SUPPLIER_MARKETS, BINS, CANDIDATES, OVERLAP) + _SIMILAR
ORACLE["similar_documents_jaccard"] = _with(SHINGLES, MINHASH, CANDIDATES, OVERLAP) + _SIMILAR
_EXACT = f"SELECT id1, id2, inter, uni, {_r('jaccard', 'jaccard')} FROM compared WHERE jaccard >= 0.5"
ORACLE["exact_jaccard_pairs"] = _with(SUPPLIER_MARKETS, OVERLAP) + _EXACT
ORACLE["exact_document_pairs"] = _with(SHINGLES, OVERLAP) + _EXACT
BAGS = SHINGLES.replace("SELECT DISTINCT id, w[i]", "SELECT id, w[i]").replace("sets AS", "runs AS") + """,
bags AS (SELECT id, element, count(*) AS c FROM runs GROUP BY ALL),
totals AS (SELECT id, sum(c) AS n FROM bags GROUP BY id),
met AS (SELECT a.id AS id1, b.id AS id2, CAST(sum(least(a.c, b.c)) AS BIGINT) AS inter
    FROM bags a JOIN bags b ON a.element = b.element AND a.id < b.id GROUP BY a.id, b.id),
compared AS (SELECT id1, id2, inter, CAST(x.n + y.n - inter AS BIGINT) AS uni,
    CAST(inter AS DOUBLE) / CAST(x.n + y.n - inter AS DOUBLE) AS jaccard
    FROM met JOIN totals x ON x.id = id1 JOIN totals y ON y.id = id2)"""
ORACLE["exact_bag_pairs"] = _with(BAGS) + _EXACT
ORACLE["lsh_quality"] = (
    _with(
        SUPPLIER_MARKETS,
        MINHASH,
        CANDIDATES,
        OVERLAP,
        "truth AS (SELECT id1, id2 FROM compared WHERE jaccard >= 0.5)",
        "found AS (SELECT id1, id2 FROM truth JOIN candidates USING (id1, id2))",
        """counts AS (SELECT (SELECT count(*) FROM found) AS found, (SELECT count(*) FROM truth) AS truth,
    (SELECT count(*) FROM found JOIN truth USING (id1, id2)) AS true_positives)""",
    )
    + f"""SELECT found, truth, true_positives,
    {_r("CAST(true_positives AS DOUBLE) / nullif(found, 0)", "precision")},
    {_r("CAST(true_positives AS DOUBLE) / nullif(truth, 0)", "recall")} FROM counts"""
)

ORACLE["lsh_candidate_quality"] = ORACLE["lsh_quality"].replace(
    "found AS (SELECT id1, id2 FROM truth JOIN candidates USING (id1, id2))", "found AS (SELECT * FROM candidates)"
)

# Neighbour weights


def _weights(entity: str, feature: str, among: str = "") -> str:
    return f"""sums AS (SELECT a."{entity}" AS id1, b."{entity}" AS id2, count(*) AS n, sum(a.rating) AS sx,
    sum(b.rating) AS sy, sum(a.rating * b.rating) AS sxy, sum(a.rating * a.rating) AS sxx,
    sum(b.rating * b.rating) AS syy
    FROM train a JOIN train b ON a."{feature}" = b."{feature}" AND a."{entity}" < b."{entity}" {among}
    GROUP BY a."{entity}", b."{entity}" HAVING count(*) >= 2),
weights AS (SELECT id1, id2, n, (n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)) AS w
    FROM sums WHERE n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0 AND n * sxy - sx * sy <> 0),
ways AS (SELECT id1 AS p, id2 AS q, w FROM weights UNION ALL SELECT id2, id1, w FROM weights)"""


AMONG = 'JOIN candidates c ON c.id1 = a.item AND c.id2 = b.item'
USER_WEIGHTS = _weights("user", "item")
ITEM_WEIGHTS = _weights("item", "user")
LSH_WEIGHTS = ",\n".join([SUPPLIER_TRAIN, TRAIN_SETS, MINHASH, CANDIDATES, _weights("item", "user", AMONG)])
_WEIGHTS = f"SELECT id1, id2, n, {_r('w', 'w')} FROM weights"

ORACLE["co_rated_user_pairs"] = _with(TRAIN, USER_WEIGHTS) + "SELECT id1, id2, n FROM sums"
ORACLE["user_pearson"] = _with(TRAIN, USER_WEIGHTS) + _WEIGHTS
ORACLE["item_pearson"] = _with(TRAIN, ITEM_WEIGHTS) + _WEIGHTS
ORACLE["item_pearson_lsh"] = _with(LSH_WEIGHTS) + _WEIGHTS

PRICES = """rated AS (SELECT o_custkey AS "user", l_suppkey AS item, max(CAST(l_extendedprice AS DOUBLE) + 1e6) AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
common AS (SELECT a.item AS id1, b.item AS id2, a.rating AS x, b.rating AS y FROM rated a JOIN rated b
    ON a."user" = b."user" AND a.item < b.item),
means AS (SELECT id1, id2, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM common GROUP BY ALL HAVING count(*) >= 2),
sums AS (SELECT id1, id2, any_value(n) AS n, sum((x - mx) * (y - my)) AS cxy, sum((x - mx) * (x - mx)) AS cxx,
    sum((y - my) * (y - my)) AS cyy FROM common JOIN means USING (id1, id2) GROUP BY id1, id2)"""
ORACLE["item_pearson_centred"] = (
    _with(PRICES)
    + f"SELECT id1, id2, n, {_r('cxy / (sqrt(cxx) * sqrt(cyy))', 'w')} FROM sums WHERE cxx > 0 AND cyy > 0"
    + " AND abs(cxy / (sqrt(cxx) * sqrt(cyy))) > 1e-12"
)

# Predictions


def _predictions(name: str, entity: str, near: str) -> str:
    """``near`` selects user, item, score, n where there is a neighbour."""
    return f"""{name}_near AS ({near}),
{name}_means AS (SELECT "{entity}" AS id, avg(rating) AS mean FROM train GROUP BY "{entity}"),
{name} AS (SELECT t."user", t.item,
    coalesce({{score}}, m.mean, (SELECT avg(rating) FROM train)) AS prediction,
    coalesce(s.n, 0) AS n_neighbours,
    CASE WHEN s.n IS NOT NULL THEN 'none' WHEN m.mean IS NOT NULL THEN '{entity}_mean'
        ELSE 'global_mean' END AS fallback
    FROM test t LEFT JOIN {name}_near s ON s."user" = t."user" AND s.item = t.item
    LEFT JOIN {name}_means m ON m.id = t."{entity}")"""


USER_BASED = _predictions(
    "user_based",
    "user",
    """SELECT t."user", t.item, sum((r.rating - m.mean) * w) / sum(abs(w)) AS score, count(*) AS n
    FROM test t JOIN ways ON p = t."user" JOIN train r ON r."user" = q AND r.item = t.item
    JOIN (SELECT "user" AS id, avg(rating) AS mean FROM train GROUP BY "user") m ON m.id = r."user"
    GROUP BY t."user", t.item""",
).format(score="m.mean + s.score")
ITEM_BASED = _predictions(
    "item_based",
    "item",
    """SELECT t."user", t.item, sum(r.rating * w) / sum(abs(w)) AS score, count(*) AS n
    FROM test t JOIN ways ON p = t.item JOIN train r ON r.item = q AND r."user" = t."user"
    GROUP BY t."user", t.item""",
).format(score="s.score")
_NONE = 'SELECT "user", item, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS BIGINT) AS n FROM test WHERE false'
USER_MEAN = _predictions("user_mean", "user", _NONE).format(score="s.score")
ITEM_MEAN = _predictions("item_mean", "item", _NONE).format(score="s.score")


def _show(name: str) -> str:
    return f'SELECT "user", item, {_r("prediction", "prediction")}, n_neighbours, fallback FROM {name}'


ORACLE["predict_user_based"] = _with(TRAIN, USER_WEIGHTS, USER_BASED) + _show("user_based")
ORACLE["predict_item_based"] = _with(TRAIN, ITEM_WEIGHTS, ITEM_BASED) + _show("item_based")
ORACLE["predict_item_based_lsh"] = _with(LSH_WEIGHTS, ITEM_BASED) + _show("item_based")
ORACLE["predict_user_mean"] = _with(TRAIN, USER_MEAN) + _show("user_mean")
ORACLE["predict_item_mean"] = _with(TRAIN, ITEM_MEAN) + _show("item_mean")
ORACLE["write_sorted"] = (
    _with(TRAIN, ITEM_MEAN) + f'SELECT "user", item, {_r("prediction", "prediction")} FROM item_mean'
)
ORACLE["write_addressable"] = ORACLE["write_sorted"]

# Matrix factorisation: what holds for any factors

SCORED = """scored AS (SELECT t."user", t.item FROM test t
    WHERE t."user" IN (SELECT "user" FROM train) AND t.item IN (SELECT item FROM train))"""
ORACLE["als_scored_pairs"] = _with(TRAIN, SCORED) + 'SELECT "user", item FROM scored'
ORACLE["als_scaled_bounds"] = (
    _with(TRAIN, SCORED)
    + "SELECT count(*) AS n, CAST(1 AS DOUBLE) AS lowest, CAST(5 AS DOUBLE) AS highest FROM scored"
)
ORACLE["als_report_counts"] = (
    _with(TRAIN, SCORED)
    + "SELECT method, (SELECT count(*) FROM scored) AS n FROM (VALUES ('als'), ('als_scaled')) AS methods(method)"
)
ORACLE["als_normal_equations"] = (
    _with(TRAIN) + 'SELECT count(DISTINCT "user") AS users, CAST(0 AS BIGINT) AS violations FROM train'
)

# Corrections of predictions

_ITEM_BASED = (TRAIN, ITEM_WEIGHTS, ITEM_BASED)
ORACLE["predictions_scaled"] = (
    _with(*_ITEM_BASED, "bounds AS (SELECT min(prediction) AS lo, max(prediction) AS hi FROM item_based)")
    + f"""SELECT "user", item, {_r("coalesce((prediction - lo) / nullif(hi - lo, 0) * 4 + 1, 3.0)", "prediction")}
    FROM item_based, bounds"""
)
ORACLE["cold_start_filled"] = (
    _with(
        *_ITEM_BASED,
        'known AS (SELECT "user", item, prediction FROM item_based WHERE n_neighbours > 0)',
        """filled AS (SELECT * FROM known UNION ALL
    SELECT t."user", t.item, m.mean FROM test t
    JOIN (SELECT "user", avg(prediction) AS mean FROM known GROUP BY "user") m ON m."user" = t."user"
    WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k."user" = t."user" AND k.item = t.item))""",
    )
    + f'SELECT "user", item, {_r("prediction", "prediction")} FROM filled'
)
_CLIPPED = "CASE WHEN prediction BETWEEN 0 AND 5 THEN prediction ELSE (SELECT avg(prediction) FROM item_based) END"
ORACLE["clip_outliers_to_mean"] = (
    _with(*_ITEM_BASED) + f'SELECT "user", item, {_r(_CLIPPED, "prediction")} FROM item_based'
)

# Evaluation

BUCKETS = ["e < 1", "e >= 1 AND e < 2", "e >= 2 AND e < 3", "e >= 3 AND e < 4", "e >= 4 AND e <= 5", "e > 5"]
_LABELS = ["[0,1)", "[1,2)", "[2,3)", "[3,4)", "[4,5]", ">5"]


def _errors(name: str) -> str:
    return f"""SELECT '{name}' AS method, p.prediction - t.rating AS d, round(abs(p.prediction - t.rating), 9) AS e
    FROM {name} p JOIN test t ON t."user" = p."user" AND t.item = p.item"""


_ITEM_ERRORS = (*_ITEM_BASED, f"errors AS ({_errors('item_based')})")
ORACLE["rating_error_histogram"] = _with(*_ITEM_ERRORS) + " UNION ALL ".join(
    f"SELECT '{label}' AS bucket, count(*) AS n FROM errors WHERE {bucket}"
    for label, bucket in zip(_LABELS, BUCKETS, strict=True)
)
ORACLE["rating_rmse"] = (
    _with(*_ITEM_ERRORS)
    + f"SELECT count(*) AS n, {_r('avg(d * d)', 'mse')}, {_r('sqrt(avg(d * d))', 'rmse')} FROM errors"
)
_METHODS = ["item_based", "item_mean", "user_based", "user_mean"]
ORACLE["rating_error_report"] = (
    _with(
        TRAIN,
        ITEM_WEIGHTS,
        ITEM_BASED,
        ITEM_MEAN,
        USER_MEAN,
        USER_WEIGHTS.replace("sums AS", "user_sums AS").replace("FROM sums", "FROM user_sums")
        .replace("weights AS", "user_weights AS").replace("FROM weights", "FROM user_weights")
        .replace("ways AS", "user_ways AS"),
        USER_BASED.replace("JOIN ways", "JOIN user_ways"),
        "errors AS (" + " UNION ALL ".join(_errors(m) for m in _METHODS) + ")",
    )
    + f"SELECT method, count(*) AS n, {_r('sqrt(avg(d * d))', 'rmse')}, "
    + ", ".join(f"count(*) FILTER (WHERE {bucket}) AS b{i}" for i, bucket in enumerate(BUCKETS))
    + " FROM errors GROUP BY method"
)
_OBSERVED = ["item_based", "item_mean"]
ORACLE["observed_error_report"] = (
    _with(
        *_ITEM_BASED,
        ITEM_MEAN,
        "errors AS (" + " UNION ALL ".join(_errors(m) for m in _OBSERVED) + ")",
    )
    + f"SELECT method, count(*) AS n, {_r('sqrt(avg(d * d))', 'rmse')}, "
    + ", ".join(f"count(*) FILTER (WHERE {bucket}) AS b{i}" for i, bucket in enumerate(BUCKETS))
    + " FROM errors GROUP BY method"
)
