"""Centroid clustering and lexical search against brute force, with edge cases."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from fieldsignal.llm import clusters, lexical


def plain_clusters(rows, count=clusters.CENTROIDS, rounds=clusters.ROUNDS):
    kept = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cents = [list(v) for _, v in sorted(kept, key=key)[:count]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for k in range(len(cents)):
            mine = [v for (_, v), c in zip(kept, own) if c == k]
            if mine:
                cents[k] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in out)
    return sorted(
        (str(i), c, d, sum(e for _, e, x in out if x == c), total, list(map(str, cents[c]))) for i, d, c in out
    )


def as_rows(df):
    return sorted((str(r["vec_id"]), *list(r)[1:]) for r in df.collect())


VECTORS = "vec_id long, embedding array<double>"


def test_clusters_equal_brute_force_with_ties_repeats_and_unusable_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.2, (6, 64))
    rows = [(k, [float(np.float32(x)) for x in base[k % 6] + rng.normal(0, 0.05, 64)]) for k in range(150)]
    rows += [(200 + k, rows[0][1]) for k in range(40)]  # a common vector
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, [0.0] * 64)]
    rows += [(300, None), (301, []), (302, [0.1] * 63), (303, [0.1] * 65), (304, [None] + [0.1] * 63)]
    rows += [(305, [float("nan")] + [0.1] * 63), (306, [float("inf")] + [0.1] * 63), (307, [-0.0] * 64)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS cluster", "2 AS distance", "'x' AS centroid")
    assert as_rows(clusters.cluster(df.repartition(7))) == plain_clusters(rows)


@pytest.mark.parametrize("rows", [[], [(1, [0.5] * 64)], [(k, [float(k)] * 64) for k in range(5)]])
def test_clusters_of_few_vectors(spark, rows):
    assert as_rows(clusters.cluster(spark.createDataFrame(rows, VECTORS))) == plain_clusters(rows)


def test_clusters_of_large_components_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.integers(-30_000, 30_000, 64) * 10.0 + 0.3]) for k in range(60)]
    assert as_rows(clusters.cluster(spark.createDataFrame(rows, VECTORS))) == plain_clusters(rows)


def test_progressive_search_finds_the_first_nearest_centroid():
    rng = np.random.default_rng(7)
    vectors, cents = rng.integers(-3, 3, (500, 64)), rng.integers(-3, 3, (16, 64))
    cents[9] = cents[4]
    vectors[:30] = cents[4]
    distances = ((vectors[:, None] - cents[None]) ** 2).sum(axis=2)
    own, least = clusters.nearest(vectors, cents)
    assert (own == distances.argmin(axis=1)).all() and (least == distances.min(axis=1)).all()
    assert (clusters.transform(vectors) ** 2).sum() == 64 * (vectors**2).sum()


def plain_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, top=lexical.TOP):
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(plain_terms(t))
    out = []
    for i, terms in queries.items():
        scored = []
        for d, c, n in counted:
            m = 50 + (50 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms if t in c
            )
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(i, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


DOCS = [
    (1, "The cat sat on the mat"), (2, "the THE the"), (3, None), (4, ""), (5, "... !!"), (6, "cat-cat_cat 42"),
    (7, "the cats sat"), (8, "béta Ж日 İx K mat "), (None, "cat mat"), (10, "cat mat"),
    (9, "cat mat"), (9, "cat mat"), (11, "sat\0mat\nsat " * 3000),
]
ITEMS = [
    (1, "Cat, the mat?"), (2, None), (3, ""), (4, "absent words"), (5, "42 BÉTA béta"), (None, "sat"),
    (6, "Ж日"), (7, "cat"), (7, "the the"), (8, "mat  K"),
]


@pytest.mark.parametrize("top", [1, 3, 50])
def test_search_equals_brute_force(spark, monkeypatch, top):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 3)  # several blocks
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS rank", "3 AS item_id")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS term", "2 AS terms")
    found = lexical.search(docs.repartition(5), items, top)
    assert sorted(map(tuple, found.collect()), key=str) == plain_search(DOCS, ITEMS, top)


def test_search_in_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.where("text IS NULL"), items).collect() == []


def test_best_keeps_ties_by_id_over_many_cuts():
    rng = np.random.default_rng(3)
    best, rows = lexical.Best(4, 5), []
    for start in range(0, 600, 20):
        scores = rng.integers(0, 6, (4, 20))
        docs = [int(x) for x in rng.permutation(20) + start]
        rows += [(i, -int(scores[i, k]), docs[k]) for i in range(4) for k in range(20) if scores[i, k]]
        best.add(scores, docs)
        best.cut()
    rows.sort()
    expected = [r for i in range(4) for r in [x for x in rows if x[0] == i][:5]]
    assert list(zip(best.item.tolist(), (-best.score).tolist(), best.doc)) == expected
