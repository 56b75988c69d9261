"""Invariants on ratings derived from the driver's smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from nearrate.operators import buckets as bk
from nearrate.operators import evaluate as ev
from nearrate.operators import predictors as pr
from nearrate.plans.catalog import data

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


@pytest.fixture(scope="module")
def split(spark):
    _, train, test = data(spark, SF)
    return train, test


def _preds(df):
    return {(r.user_id, r.item_id): r.pred for r in df.collect()}


def test_unit_personalized_equals_baseline(split):
    train, test = split
    unit = pr.predict_personalized(train, test, "unit", sim=None)
    # Explicit unit weights through the general route give the same numbers.
    users = train.select("user_id").distinct()
    ones = (users.alias("a").join(users.alias("b"), F.col("a.user_id") != F.col("b.user_id"))
            .select(F.col("a.user_id").alias("user_id"), F.col("b.user_id").alias("other_id"),
                    F.lit(1.0).alias("sim")))
    general = pr.predict_personalized(train, test, "unit", sim=ones)
    base = pr.predict_baseline(train, test)
    a, b, c = _preds(unit), _preds(general), _preds(base)
    assert a.keys() == b.keys() == c.keys()
    assert all(abs(a[k] - c[k]) < 1e-9 and abs(b[k] - c[k]) < 1e-9 for k in a)


def test_knn_all_neighbours_equals_personalized_cosine(split):
    train, test = split
    n = train.select("user_id").distinct().count()
    knn = _preds(pr.predict_knn(train, test, n - 1))
    cos = _preds(pr.predict_personalized(train, test, "cosine"))
    g = train.agg(F.avg("rating")).first()[0]
    means = {r.user_id: r.m for r in train.groupBy("user_id").agg(F.avg("rating").alias("m"))
             .collect()}
    for k in knn:
        if means.get(k[0]) is not None and means[k[0]] != g:
            assert abs(knn[k] - cos[k]) < 1e-9


def test_no_self_neighbour_and_ranks(split):
    train, _ = split
    nb = pr.knn_neighbours(train, 10)
    assert nb.where(F.col("user_id") == F.col("other_id")).count() == 0
    assert nb.where((F.col("rank") < 1) | (F.col("rank") > 10)).count() == 0


def test_approx_with_all_buckets_equals_exact(split):
    train, _ = split
    exact = {(r.user_id, r.other_id) for r in pr.knn_neighbours(train, 10).collect()}
    full = {(r.user_id, r.other_id) for r in
            bk.approximate_neighbours(train, 10, partitions=3, replication=3).collect()}
    assert full == exact


def test_approx_neighbours_share_a_bucket(split):
    train, _ = split
    b = bk.user_buckets(train, 10, 2, 1337)
    ap = bk.approximate_neighbours(train, 10, 10, 2, 1337, buckets=b)
    shared = (ap.join(b, "user_id")
              .join(b.select(F.col("user_id").alias("other_id"), "bucket"), ["other_id", "bucket"])
              .select("user_id", "other_id").distinct())
    assert shared.count() == ap.count()
    assert ap.where(F.col("sim") <= 0).count() == 0


@pytest.mark.parametrize("name", ["baseline", "cosine", "jaccard", "knn"])
def test_predictions_within_scale(split, name):
    train, test = split
    fn = {"baseline": lambda: pr.predict_baseline(train, test),
          "cosine": lambda: pr.predict_personalized(train, test, "cosine"),
          "jaccard": lambda: pr.predict_personalized(train, test, "jaccard"),
          "knn": lambda: pr.predict_knn(train, test, 30)}[name]
    out = fn()
    bad = out.where((F.col("pred") < 1 - 1e-9) | (F.col("pred") > 5 + 1e-9)).count()
    assert bad == 0
    assert ev.mae(out).first()[0] is not None
