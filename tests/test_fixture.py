"""Every operator family on the hand fixture with known answers."""

import pytest
from pyspark.sql import functions as F

from nearrate.operators import buckets as bk
from nearrate.operators import evaluate as ev
from nearrate.operators import features as fx
from nearrate.operators import neighbours as nb
from nearrate.operators import predictors as pr
from nearrate.operators import similarity as sm

A = pytest.approx


def preds_in_order(df, test):
    got = {(r.user_id, r.item_id): r.pred for r in df.collect()}
    return [got[(u, i)] for u, i, _ in test]


def test_means(tiny):
    tr, _, _ = tiny
    assert fx.global_mean(tr).first()[0] == A(3.5)
    um = {r.user_id: r.user_mean for r in fx.user_means(tr).collect()}
    assert [um[u] for u in range(1, 7)] == A([4.0, 3.666667, 3.0, 3.0, 3.5, 3.666667], abs=1e-6)
    im = {r.item_id: r.item_mean for r in fx.item_means(tr).collect()}
    assert [im[i] for i in range(1, 7)] == A([3.25, 3.75, 2.666667, 4.0, 3.5, 5.0], abs=1e-6)
    idev = {r.item_id: r.item_dev for r in fx.item_mean_deviation(tr).collect()}
    assert [idev[i] for i in range(1, 7)] == A([0.0625, 0.260417, -0.333333, 0.5, 0.2, 1.0], abs=1e-6)
    norms = {r.user_id: r.norm for r in fx.user_norms(fx.deviations(tr)).collect()}
    assert [norms[u] for u in range(1, 7)] == A([1.054093, 1.205456, 1.414214, 0.0, 1.16619,
                                                 1.732051], abs=1e-6)


def test_cosine_and_jaccard(tiny):
    tr, _, _ = tiny
    cos = {(r.user_id, r.other_id): r.sim for r in sm.cosine_half(tr).collect()}
    cos = {tuple(sorted(k)): v for k, v in cos.items()}
    assert cos == A({(1, 2): 0.360704, (1, 3): -0.223607, (1, 6): -0.730297, (2, 3): -0.366618,
                     (2, 6): -0.419079, (3, 6): 0.408248, (5, 6): -0.297044}, abs=1e-6)
    jac = {tuple(sorted((r.user_id, r.other_id))): r.sim for r in sm.jaccard_half(tr).collect()}
    assert jac == A({(1, 2): 0.5, (1, 3): 0.5, (1, 4): 0.666667, (1, 6): 0.5, (2, 3): 0.5,
                     (2, 4): 0.25, (2, 6): 0.5, (3, 4): 0.25, (3, 6): 0.2, (4, 6): 0.25,
                     (5, 6): 0.25}, abs=1e-6)
    full = sm.cosine_similarity(tr)
    assert full.count() == 14
    assert full.where(F.col("user_id") == F.col("other_id")).count() == 0


EXPECTED = {
    "global": ([3.5] * 8, 0.875),
    "user": ([4.0, 3.666667, 3.0, 3.5, 3.0, 3.666667, 3.5, 4.0], 1.041667),
    "item": ([4.0, 2.666667, 3.25, 3.25, 3.75, 5.0, 3.25, 3.5], 0.895833),
    "baseline": ([4.5, 2.777778, 3.125, 3.5, 3.520833, 5.0, 3.5, 4.0], 1.078993),
    "cosine": ([4.617315, 4.338754, 1.550768, 3.5, 3.0, 1.0, 3.5, 4.0], 1.550663),
    "jaccard": ([4.5, 2.6, 3.586207, 3.5, 3.171569, 5.0, 3.5, 4.0], 1.042778),
    "unit": ([4.5, 2.777778, 3.125, 3.5, 3.520833, 5.0, 3.5, 4.0], 1.078993),
}

PRED = {
    "global": pr.predict_global, "user": pr.predict_user_mean, "item": pr.predict_item_mean,
    "baseline": pr.predict_baseline,
    "cosine": lambda tr, te: pr.predict_personalized(tr, te, "cosine"),
    "jaccard": lambda tr, te: pr.predict_personalized(tr, te, "jaccard"),
    "unit": lambda tr, te: pr.predict_personalized(tr, te, "unit"),
}


@pytest.mark.parametrize("name", list(EXPECTED))
def test_predictors(tiny, name):
    tr, te, test = tiny
    out = PRED[name](tr, te)
    preds, mae = EXPECTED[name]
    assert preds_in_order(out, test) == A(preds, abs=1e-6)
    assert ev.mae(out).first()[0] == A(mae, abs=1e-6)


KNN = {
    1: ([5.0, 3.666667, 1.0, 3.5, 3.0, 3.666667, 3.5, 4.0], 1.416667),
    2: ([5.0, 3.666667, 1.0, 3.5, 3.0, 3.666667, 3.5, 4.0], 1.416667),
    4: ([4.617315, 4.338754, 1.0, 3.5, 3.0, 1.0, 3.5, 4.0], 1.619509),
    5: ([4.617315, 4.338754, 1.550768, 5.0, 3.0, 1.0, 3.5, 4.0], 1.613163),
}


@pytest.mark.parametrize("k", list(KNN))
def test_knn(tiny, k):
    tr, te, test = tiny
    out = pr.predict_knn(tr, te, k)
    preds, mae = KNN[k]
    assert preds_in_order(out, test) == A(preds, abs=1e-6)
    assert ev.mae(out).first()[0] == A(mae, abs=1e-6)


def test_knn_sweep_matches_single(tiny):
    tr, te, test = tiny
    out = pr.predict_knn_sweep(tr, te, [1, 2, 4, 5])
    m = {r.k: r.mae for r in out.groupBy("k").agg(F.avg(F.abs(F.col("pred") - F.col("rating")))
                                                  .alias("mae")).collect()}
    assert m == A({k: v[1] for k, v in KNN.items()}, abs=1e-6)


def test_neighbour_ranks(tiny):
    tr, _, _ = tiny
    got = {(r.user_id, r.other_id): r.rank for r in pr.knn_neighbours(tr, 5).collect()}
    # Non-zero neighbours with their ranks (zero-similarity users hold ranks).
    assert got == {(1, 2): 1, (1, 3): 4, (1, 6): 5, (2, 1): 1, (2, 3): 4, (2, 6): 5,
                   (3, 6): 1, (3, 1): 4, (3, 2): 5, (5, 6): 5,
                   (6, 3): 1, (6, 5): 3, (6, 2): 4, (6, 1): 5}


def test_buckets_and_approx(tiny):
    tr, te, test = tiny
    b = {(r.user_id, r.bucket) for r in bk.user_buckets(tr, 3, 2, 1337).collect()}
    assert b == {(1, 0), (1, 1), (2, 1), (2, 2), (3, 0), (3, 1), (4, 0), (4, 2), (5, 1), (5, 2),
                 (6, 0), (6, 2)}
    ap = bk.approximate_neighbours(tr, 2, 3, 2, 1337)
    assert {(r.user_id, r.other_id) for r in ap.collect()} == {(1, 2), (2, 1), (3, 6), (6, 3)}
    out = pr.predict_knn(tr, te, 2, neighbours=ap)
    assert preds_in_order(out, test) == A(KNN[2][0], abs=1e-6)


def test_cosine_lookup_matches_table(spark, tiny):
    tr, _, _ = tiny
    pairs = spark.createDataFrame([(1, 2), (2, 1), (1, 4), (3, 3), (5, 6), (1, 9)],
                                  "user_id long, other_id long")
    got = {(r.user_id, r.other_id): r.sim for r in sm.cosine_lookup(tr, pairs).collect()}
    assert got == A({(1, 2): 0.360704, (2, 1): 0.360704, (1, 4): 0.0, (3, 3): 1.0,
                     (5, 6): -0.297044, (1, 9): 0.0}, abs=1e-6)


def test_hot_items_in_blocks_give_same_answers(tiny, monkeypatch):
    """One row per block: every item counts as hot and is dealt over cells."""
    from nearrate.operators import products
    monkeypatch.setattr(products, "BLOCK_ROWS", 1)
    tr, te, test = tiny
    test_cosine_and_jaccard(tiny)
    for name in ("cosine", "jaccard"):
        out = PRED[name](tr, te)
        assert preds_in_order(out, test) == A(EXPECTED[name][0], abs=1e-6)
    for k in (2, 5):
        out = pr.predict_knn(tr, te, k)
        assert preds_in_order(out, test) == A(KNN[k][0], abs=1e-6)
    ap = bk.approximate_neighbours(tr, 2, 3, 2, 1337)
    assert {(r.user_id, r.other_id) for r in ap.collect()} == {(1, 2), (2, 1), (3, 6), (6, 3)}


def test_half_star_bounds(spark):
    """The scale bounds are parameters; out-of-range ratings fail loudly."""
    from nearrate.sources import RATING_SCHEMA
    rows = [(1, 1, 0.5), (1, 2, 1.0), (1, 3, 1.5), (2, 1, 1.0), (2, 2, 1.0), (2, 3, 1.0),
            (3, 1, 5.0), (3, 2, 0.5)]
    df = spark.createDataFrame(rows, RATING_SCHEMA)
    dev = {(r.user_id, r.item_id): r.dev for r in sm.fx.deviations(df, lo=0.5).collect()}
    assert all(-1.0 <= v <= 1.0 for v in dev.values())
    assert dev[(1, 1)] == A(-1.0)
    # User 2's mean is 1.0; with lo = 1 a rating of 0.5 for a user with mean 1
    # would divide by zero: add one such row and expect an error, not infinity.
    bad = spark.createDataFrame([(4, 1, 0.5), (4, 2, 1.5)], RATING_SCHEMA)  # mean 1.0
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sm.fx.deviations(bad, lo=1.0).collect()
    ok = {r.item_id: r.dev for r in sm.fx.deviations(bad, lo=0.5).collect()}
    assert ok == A({1: -1.0, 2: 0.125})


def test_mean_family_matches_separate_predictors(tiny):
    tr, te, test = tiny
    fam = pr.predict_mean_family(tr, te)
    for name in ("global", "user", "item", "baseline"):
        got = {(r.user_id, r.item_id): r[f"pred_{name}"] for r in fam.collect()}
        assert [got[(u, i)] for u, i, _ in test] == A(EXPECTED[name][0], abs=1e-6)
    maes = {r.method: r.mae for r in ev.mae_mean_family(tr, te).collect()}
    assert maes == A({k: EXPECTED[k][1] for k in ("global", "user", "item", "baseline")}, abs=1e-6)


def test_unknown_similarity_rejected(tiny):
    tr, te, _ = tiny
    with pytest.raises(ValueError):
        pr.predict_personalized(tr, te, "pearson")


def test_bucket_similarity_materialised(tiny):
    tr, _, _ = tiny
    b = bk.user_buckets(tr, 3, 2, 1337)
    got = {(r.user_id, r.other_id): r.sim for r in bk.bucket_similarity(tr, b).collect()}
    assert got == A({(1, 2): 0.360704, (2, 1): 0.360704, (3, 6): 0.408248, (6, 3): 0.408248},
                    abs=1e-6)


def test_sets_and_lists_are_whole_and_in_chunks(spark):
    from nearrate.operators import features as fx
    rows = [(1, i, float(i % 5)) for i in range(500)] + [(2, 7, 3.0), (2, 7, 3.0), (3, 9, 1.0)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    sets = fx.member_sets(df, "user_id", rows=20).collect()
    got = sorted((r["user_id"], i) for r in sets for i in r["elements"])
    assert got == sorted({(u, i) for u, i, _ in rows})
    assert max(len(r["elements"]) for r in sets) < 60 and sum(r["user_id"] == 1 for r in sets) > 15
    assert all(list(r["elements"]) == sorted(r["elements"]) for r in sets)
    for key, k in (("user_id", 0), ("item_id", 1)):
        lists = fx.rating_chunks(df, key, rows=20).collect()
        assert sorted((r[key], *e) for r in lists for e in r["elements"]) == sorted((x[k], x[1 - k], x[2]) for x in rows)
    assert fx.member_sets(df.limit(0)).count() == 0
