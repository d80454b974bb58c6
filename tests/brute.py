"""The definitions in plain Python, for small data."""

from itertools import combinations
from math import sqrt


def by(rows, key, feature):
    out = {}
    for user, item, rating in rows:
        row = {"user": user, "item": item}
        out.setdefault(row[key], {})[row[feature]] = rating
    return out


def weights(rows, entity, feature):
    """``{(id1, id2): (n, w)}`` with two-pass Pearson over what both rated."""
    rated = by(rows, entity, feature)
    out = {}
    for a, b in combinations(sorted(rated), 2):
        both = sorted(set(rated[a]) & set(rated[b]))
        if len(both) < 2:
            continue
        x = [rated[a][f] for f in both]
        y = [rated[b][f] for f in both]
        mx, my = sum(x) / len(x), sum(y) / len(y)
        if len(set(x)) == 1 or len(set(y)) == 1:
            continue
        cov = sum((p - mx) * (q - my) for p, q in zip(x, y, strict=True))
        w = cov / sqrt(sum((p - mx) ** 2 for p in x) * sum((q - my) ** 2 for q in y))
        if abs(w) > 1e-12:
            out[a, b] = (len(both), w)
    return out


def co_rated(rows, entity, feature):
    rated = by(rows, entity, feature)
    counts = {(a, b): len(set(rated[a]) & set(rated[b])) for a, b in combinations(sorted(rated), 2)}
    return {pair: n for pair, n in counts.items() if n >= 2}


def mean(values):
    values = list(values)
    return sum(values) / len(values)


def user_based(rows, targets, weight):
    users, items = by(rows, "user", "item"), by(rows, "item", "user")
    out = {}
    for u, i in targets:
        near = [(v, weight.get((min(u, v), max(u, v)))) for v in items.get(i, {}) if v != u]
        near = [(v, w[1]) for v, w in near if w]
        if near:
            num = sum((users[v][i] - mean(users[v].values())) * w for v, w in near)
            out[u, i] = (mean(users[u].values()) + num / sum(abs(w) for _, w in near), len(near))
    return out


def item_based(rows, targets, weight):
    users = by(rows, "user", "item")
    out = {}
    for u, i in targets:
        near = [(j, weight.get((min(i, j), max(i, j)))) for j in users.get(u, {}) if j != i]
        near = [(j, w[1]) for j, w in near if w]
        if near:
            out[u, i] = (sum(users[u][j] * w for j, w in near) / sum(abs(w) for _, w in near), len(near))
    return out


def jaccard(members, threshold):
    """``{(id1, id2): (inter, uni)}`` of pairs that reach the threshold."""
    out = {}
    for a, b in combinations(sorted(members), 2):
        inter, uni = len(members[a] & members[b]), len(members[a] | members[b])
        if inter and inter / uni >= threshold - 1e-12:
            out[a, b] = (inter, uni)
    return out
