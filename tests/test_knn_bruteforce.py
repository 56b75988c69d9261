"""Exact kNN against a brute-force dense ranking on random integer ratings.

The brute force ranks *every* other user (zero similarities included) by
rounded similarity, descending, ties by smaller id — the original local
algorithm — and keeps the non-zero ones among the first k.
"""

import math

import numpy as np
import pytest

from nearrate.operators import predictors as pr
from nearrate.sources import RATING_SCHEMA


def brute_neighbours(rows, k):
    users = sorted({u for u, _, _ in rows})
    by_user = {u: {i: r for uu, i, r in rows if uu == u} for u in users}
    mean = {u: sum(v.values()) / len(v) for u, v in by_user.items()}

    def scale(x, a):
        return 5 - a if x > a else (a - 1 if x < a else 1.0)

    dev = {u: {i: (r - mean[u]) / scale(r, mean[u]) for i, r in v.items()}
           for u, v in by_user.items()}
    norm = {u: math.sqrt(sum(d * d for d in v.values())) for u, v in dev.items()}

    def cos(a, b):
        if norm[a] == 0 or norm[b] == 0:
            return 0.0
        s = sum(dev[a][i] * dev[b][i] for i in dev[a].keys() & dev[b].keys())
        return round(s / (norm[a] * norm[b]), 12)

    out = {}
    for u in users:
        ranked = sorted(((cos(u, v), v) for v in users if v != u), key=lambda t: (-t[0], t[1]))
        for rank, (s, v) in enumerate(ranked[:k], start=1):
            if s != 0:
                out[(u, v)] = (round(s, 9), rank)
    return out


@pytest.mark.parametrize("seed,k", [(1, 3), (2, 5), (3, 8), (4, 2)])
def test_exact_knn_matches_dense_ranking(spark, seed, k):
    rng = np.random.default_rng(seed)
    rows = {}
    for u in range(1, 19):
        for i in rng.choice(np.arange(1, 9), size=int(rng.integers(2, 6)), replace=False):
            rows[(u, int(i))] = float(rng.integers(1, 6))
    rows = [(u, i, r) for (u, i), r in rows.items()]
    train = spark.createDataFrame(rows, RATING_SCHEMA)
    got = {(r.user_id, r.other_id): (round(r.sim, 9), r.rank)
           for r in pr.knn_neighbours(train, k).collect()}
    assert got == brute_neighbours(rows, k)


def brute_recommend(rows, targets, k, n):
    users = sorted({u for u, _, _ in rows})
    items = sorted({i for _, i, _ in rows})
    by_user = {u: {i: r for uu, i, r in rows if uu == u} for u in users}
    mean = {u: sum(v.values()) / len(v) for u, v in by_user.items()}

    def scale(x, a):
        return 5 - a if x > a else (a - 1 if x < a else 1.0)

    dev = {u: {i: (r - mean[u]) / scale(r, mean[u]) for i, r in v.items()}
           for u, v in by_user.items()}
    nb = brute_neighbours(rows, k)
    out = {}
    for u in targets:
        mine = [(v, s) for (uu, v), (s, _) in nb.items() if uu == u]
        preds = []
        for i in items:
            if i in by_user[u]:
                continue
            num = sum(s * dev[v][i] for v, s in mine if i in dev[v])
            den = sum(abs(s) for v, s in mine if i in dev[v])
            d = num / den if den else 0.0
            a = mean[u]
            preds.append((round(a + d * scale(a + d, a), 12), i))
        preds.sort(key=lambda t: (-t[0], t[1]))
        for rank, (p, i) in enumerate(preds[:n], start=1):
            out[(u, rank)] = (i, round(p, 9))
    return out


@pytest.mark.parametrize("seed,k,n", [(5, 3, 3), (6, 2, 4), (7, 6, 2)])
def test_recommend_matches_full_grid(spark, seed, k, n):
    from nearrate.operators import recommend as rc
    rng = np.random.default_rng(seed)
    rows = {}
    for u in range(1, 16):
        for i in rng.choice(np.arange(1, 13), size=int(rng.integers(2, 7)), replace=False):
            rows[(u, int(i))] = float(rng.integers(1, 6))
    rows = [(u, i, r) for (u, i), r in rows.items()]
    train = spark.createDataFrame(rows, RATING_SCHEMA)
    targets = [1, 4, 9]
    tdf = spark.createDataFrame([(t,) for t in targets], "user_id long")
    got = {(r.user_id, r.rank): (r.item_id, r.pred)
           for r in rc.recommend(train, tdf, k, n).collect()}
    want = brute_recommend(rows, targets, k, n)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key][0] == want[key][0]
        assert got[key][1] == pytest.approx(want[key][1], abs=1e-8)


def brute_buckets(users, p, r, seed):
    import hashlib
    out = {}
    for u in users:
        keys = sorted((hashlib.md5(f"{seed}:{u}:{b}".encode()).hexdigest(), b) for b in range(p))
        out[u] = {b for _, b in keys[:r]}
    return out


@pytest.mark.parametrize("seed,k,p,r", [(8, 3, 4, 2), (9, 5, 5, 2), (10, 2, 3, 1)])
def test_approximate_neighbours_brute(spark, seed, k, p, r):
    from nearrate.operators import buckets as bk
    rng = np.random.default_rng(seed)
    rows = {}
    for u in range(1, 21):
        for i in rng.choice(np.arange(1, 10), size=int(rng.integers(2, 6)), replace=False):
            rows[(u, int(i))] = float(rng.integers(1, 6))
    rows = [(u, i, rt) for (u, i), rt in rows.items()]
    train = spark.createDataFrame(rows, RATING_SCHEMA)
    users = sorted({u for u, _, _ in rows})
    bks = brute_buckets(users, p, r, 1337)
    got_b = {(x.user_id, x.bucket) for x in bk.user_buckets(train, p, r, 1337).collect()}
    assert got_b == {(u, b) for u, bs in bks.items() for b in bs}
    full = brute_neighbours(rows, len(users))          # all non-zero pairs with sims
    want = {}
    for u in users:
        cands = sorted(((s, v) for (uu, v), (s, _) in full.items()
                        if uu == u and s > 0 and bks[u] & bks[v]), key=lambda t: (-t[0], t[1]))
        for rank, (s, v) in enumerate(cands[:k], start=1):
            want[(u, v)] = (s, rank)
    got = {(x.user_id, x.other_id): (round(x.sim, 9), x.rank)
           for x in bk.approximate_neighbours(train, k, p, r, 1337).collect()}
    assert got == want


def popular_rows(seed, users=40, items=30):
    """Ratings in which a few items have most raters."""
    rng = np.random.default_rng(seed)
    weight = 1 / np.arange(1, items + 1)
    rows = {}
    for u in range(1, users + 1):
        for i in rng.choice(items, size=int(rng.integers(3, 12)), replace=False, p=weight / weight.sum()):
            rows[(u, int(i) + 1)] = float(rng.integers(1, 6))
    return [(u, i, r) for (u, i), r in rows.items()]


@pytest.mark.parametrize("seed,k,frequent,probe", [(1, 2, 6, 6), (2, 1, 3, 20), (3, 3, 8, 8), (4, 1, 12, 40), (5, 30, 6, 6)])
def test_cut_frequent_items_lose_no_neighbour(spark, seed, k, frequent, probe):
    from nearrate.operators import neighbours as nb
    rows = popular_rows(seed)
    train = spark.createDataFrame(rows, RATING_SCHEMA)
    got = {(r.user_id, r.other_id): (round(r.sim, 9), r.rank)
           for r in nb.cosine_neighbours(train, k, frequent=frequent, probe=probe).collect()}
    assert got == brute_neighbours(rows, k)


def test_frequent_items_are_cut(spark):
    """Near copies on rare items give high thresholds: the popular item, rated by
    all, is then cut for them, and its pairs are not made."""
    from pyspark.sql import functions as F

    from nearrate.operators import neighbours as nb
    from nearrate.operators import similarity as sm
    rows = [(u, 1, 3.0 + u % 2) for u in range(1, 81)]
    for u in range(1, 81):
        pair = 100 * ((u + 1) // 2)
        rows += [(u, pair + j, float(1 + 4 * (j % 2))) for j in range(8)]
    train = spark.createDataFrame(rows, RATING_SCHEMA)
    raters = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("raters"))
    rui = sm.unit_vectors(train)
    cut = nb._cut(rui, raters, None, 1, 10, 10)
    assert {(r.user_id, r.item_id) for r in cut.collect()} == {(u, 1) for u in range(1, 81)}
    made = nb._survivors(rui, cut, 0.0)
    assert made.count() == 80  # of 80 * 79 directions that share the popular item
    got = {(r.user_id, r.other_id): (round(r.sim, 9), r.rank) for r in nb.cosine_neighbours(train, 1, frequent=10, probe=10).collect()}
    assert got == brute_neighbours(rows, 1)


def test_requested_similarities_equal_the_tables(spark):
    from nearrate.operators import neighbours as nb
    from nearrate.operators import similarity as sm
    rows = popular_rows(7)
    train = spark.createDataFrame(rows, RATING_SCHEMA)
    asked = [(u, v) for u in range(1, 41, 3) for v in range(1, 45, 4)] + [(1, 1), (1, 5), (1, 5)]
    pairs = spark.createDataFrame(asked, "user_id long, other_id long")
    for table, some in ((sm.cosine_similarity(train), sm.asked_cosines(train, sm.unordered(pairs))),
                        (sm.jaccard_similarity(train), sm.asked_jaccards(train, sm.unordered(pairs)))):
        want = {(r.user_id, r.other_id): r.sim for r in table.collect() if r.user_id < r.other_id and ((r.user_id, r.other_id) in asked or (r.other_id, r.user_id) in asked)}
        assert {(r.user_id, r.other_id): pytest.approx(r.sim, abs=1e-11) for r in some.collect()} == want
    near = brute_neighbours(rows, 3)
    got = sorted((r.user_id, r.other_id, round(r.sim, 9)) for r in nb.knn_similarity_of(train, pairs, 3).collect())
    assert got == sorted((u, v, near.get((u, v), (0.0,))[0]) for u, v in asked)


def test_local_top_k_then_merge_equals_brute_force(spark):
    from nearrate.operators import buckets as bk
    rows = popular_rows(9)
    train = spark.createDataFrame(rows, RATING_SCHEMA)
    spread = [(u, b) for u in range(1, 41) for b in ((u * 7) % 4, (u * 5 + 1) % 4)]
    buckets = spark.createDataFrame(sorted(set(spread)), "user_id long, bucket int")
    held = set(spread)
    full = {key: s for key, (s, _) in brute_neighbours(rows, 39).items() if s > 0}
    lists = {}
    for b in range(4):
        for u in {u for u, c in held if c == b}:
            near = sorted((-s, v) for (x, v), s in full.items() if x == u and (v, b) in held)[:2]
            lists.update({(b, u, v): (-s, i + 1) for i, (s, v) in enumerate(near)})
    got = {(r.bucket, r.user_id, r.other_id): (round(r.sim, 9), r.rank) for r in bk.bucket_neighbours(train, buckets, 2).collect()}
    assert got == lists
    best = {}
    for u in range(1, 41):
        near = sorted({(-s, v) for (b, x, v), (s, _) in lists.items() if x == u})[:2]
        best.update({(u, v): (-s, i + 1) for i, (s, v) in enumerate(near)})
    got = {(r.user_id, r.other_id): (round(r.sim, 9), r.rank) for r in bk.approximate_neighbours(train, 2, 4, 2, buckets=buckets).collect()}
    assert got == best


def test_candidates_in_blocks(spark):
    from nearrate.operators import recommend as rc
    rows = popular_rows(11)
    train = spark.createDataFrame(rows, RATING_SCHEMA)
    targets = spark.createDataFrame([(1,), (2,), (2,), (99,)], "user_id long")
    rated, items = {(u, i) for u, i, _ in rows}, {i for _, i, _ in rows}
    want = sorted((u, i) for u in (1, 2, 99) for i in items if (u, i) not in rated)
    for size in (1, 4, 4096):
        assert sorted(map(tuple, rc.candidates(train, targets, size).collect())) == want
    assert rc.candidates(train.limit(0), targets).count() == 0
