"""Golden values of the original test-suite on MovieLens 100K (split u2).

Skipped unless $NEARRATE_ML100K names a folder holding u2.base and u2.test.
Fixed values: expected results published with the original tests, tolerance 1e-4.
"""

import os

import pytest

from nearrate.operators import evaluate as ev
from nearrate.operators import features as fx
from nearrate.operators import predictors as pr
from nearrate.operators import similarity as sm
from nearrate.sources import load_ratings

ML = os.environ.get("NEARRATE_ML100K", "")
pytestmark = pytest.mark.skipif(
    not (ML and os.path.exists(os.path.join(ML, "u2.base"))), reason="MovieLens 100K absent")

# Fixed values (MAE on u2.test, and point values), as published.
GOLDEN_MAE = {
    "global": 0.9489, "user": 0.8383, "item": 0.8206, "baseline": 0.7604,
    "unit": 0.7604, "cosine": 0.7372, "jaccard": 0.7556, "knn10": 0.8287,
}


@pytest.fixture(scope="module")
def ml(spark):
    return (load_ratings(spark, os.path.join(ML, "u2.base")),
            load_ratings(spark, os.path.join(ML, "u2.test")))


def test_means(ml):
    train, _ = ml
    assert fx.global_mean(train).first()[0] == pytest.approx(3.5264625, abs=1e-4)
    assert fx.one_user_mean(train, 1).first()["user_mean"] == pytest.approx(3.6330, abs=1e-4)
    assert fx.one_item_mean(train, 1).first()["item_mean"] == pytest.approx(3.8882, abs=1e-4)


@pytest.mark.parametrize("name", list(GOLDEN_MAE))
def test_mae(ml, name):
    train, test = ml
    fn = {"global": pr.predict_global, "user": pr.predict_user_mean,
          "item": pr.predict_item_mean, "baseline": pr.predict_baseline,
          "unit": lambda a, b: pr.predict_personalized(a, b, "unit"),
          "cosine": lambda a, b: pr.predict_personalized(a, b, "cosine"),
          "jaccard": lambda a, b: pr.predict_personalized(a, b, "jaccard"),
          "knn10": lambda a, b: pr.predict_knn(a, b, 10)}[name]
    assert ev.mae(fn(train, test)).first()[0] == pytest.approx(GOLDEN_MAE[name], abs=1e-4)


def test_cosine_pair(ml, spark):
    train, _ = ml
    pairs = spark.createDataFrame([(1, 2)], "user_id long, other_id long")
    got = sm.lookup(sm.cosine_similarity(train), pairs).first()["sim"]
    assert got == pytest.approx(0.0730, abs=1e-4)
