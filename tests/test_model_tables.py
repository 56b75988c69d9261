"""Set operations, updates, stored ratings, and the contract of a supplied similarity."""
import re

import pytest
from pyspark.errors import PySparkException

from nearrate.operators import features as fx
from nearrate.operators import predictors as pr
from nearrate.operators import similarity as sm
from nearrate.operators import updates as up
from nearrate.operators.sets import set_operations
from nearrate.sources import RATING_SCHEMA
from nearrate.sources.stored import store_ratings


@pytest.mark.parametrize("width", [1, 3, 1024])
def test_set_operations(spark, width):
    sets = {1: {1, 2, 5, 9, -4}, 2: {2, 9, 10, 3000}, 3: {7}}
    ratings = spark.createDataFrame([(u, i, 3.0) for u, s in sets.items() for i in s] + [(1, 2, 3.0)], RATING_SCHEMA)
    asked = [(1, 2), (2, 1), (1, 3), (3, 99), (98, 99), (1, 1), (1, 2)]
    made = set_operations(ratings, spark.createDataFrame(asked, "user_id long, other_id long"), width).collect()
    got = {p: ([], []) for p in set(asked)}
    for r in sorted(made, key=lambda r: r.piece):
        got[r.user_id, r.other_id][0].extend(r.both)
        got[r.user_id, r.other_id][1].extend(r.either)
        assert len(r.either) <= width
    assert got == {(u, v): (sorted(sets.get(u, set()) & sets.get(v, set())), sorted(sets.get(u, set()) | sets.get(v, set()))) for u, v in asked}


def test_update_equals_a_fit_from_scratch(spark, tiny):
    train, test, _ = tiny
    new = test.where("user_id <> 4").select("user_id", "item_id", "rating")  # known and unknown users and items
    got, want = up.append(up.fit(train), new), up.fit(train.unionByName(new))
    table = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.collect())
    assert table(got.user_means()) == table(want.user_means())
    assert table(got.item_facts()) == table(want.item_facts())
    assert table(got.cosines) == table(want.cosines)
    means = {r.user_id: r.user_mean for r in fx.user_means(train.unionByName(new)).collect()}
    assert {r.user_id: r.user_mean for r in got.user_means().collect()} == pytest.approx(means)
    # a second batch goes onto the first
    more = spark.createDataFrame([(4, 2, 1.0), (77, 78, 2.0)], RATING_SCHEMA)
    again, whole = up.append(got, more), up.fit(train.unionByName(new).unionByName(more))
    assert table(again.item_facts()) == table(whole.item_facts()) and table(again.cosines) == table(whole.cosines)


def test_stored_ratings_read_one_bucket(spark, tiny):
    train = tiny[0]
    for key, mean in (("user_id", fx.one_user_mean), ("item_id", fx.one_item_mean)):
        kept = store_ratings(train, key, 8)
        plan = kept.mean(2)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SelectedBucketsCount: 1 out of 8", plan)
        for value in (1, 2, 6, 99):
            assert kept.mean(value).collect() == mean(train, value).collect()
        kept.drop()
        assert not spark.catalog.tableExists(kept.name)


GOOD = [(1, 2, 0.5), (2, 1, 0.5), (1, 3, -0.25), (3, 1, -0.25)]


def test_a_good_supplied_similarity_passes(spark):
    sim = spark.createDataFrame(GOOD, "user_id long, other_id long, sim double")
    assert sorted(map(tuple, sm.checked(sim).collect())) == sorted(GOOD)
    assert sm.checked(sim.limit(0)).count() == 0


@pytest.mark.parametrize("more, message", [
    ([(4, 4, 1.0)], "paired with itself"), ([(4, 4, 1.0), (4, 4, 1.0)], "paired with itself"), ([(5, 6, 0.1)], "once in each direction"),
    ([(1, 2, 0.5)], "once in each direction"), ([(5, 6, 0.1), (5, 6, 0.1)], "once in each direction"), ([(5, 6, 0.1), (6, 5, 0.2)], "directions differ"),
    ([(5, 6, 0.0), (6, 5, 0.0)], "zero"), ([(5, 6, 1 / 3), (6, 5, 1 / 3)], "not rounded"), ([(5, 6, None), (6, 5, None)], "missing"),
    ([(5, 6, 0.1), (6, 5, None)], "missing"), ([(5, 6, float("nan")), (6, 5, float("nan"))], "missing"), ([(5, 6, float("inf")), (6, 5, float("inf"))], "missing"),
    ([(None, 6, 0.1), (6, None, 0.1)], "id is missing")])
def test_a_wrong_supplied_similarity_fails(spark, more, message):
    sim = spark.createDataFrame(GOOD + more, "user_id long, other_id long, sim double")
    with pytest.raises(PySparkException, match=message):
        sm.checked(sim).collect()


def test_predictors_check_a_supplied_function(spark, tiny):
    train, test, _ = tiny
    half = lambda tr, lo, hi: sm.jaccard_half(tr)
    with pytest.raises(PySparkException, match="once in each direction"):
        pr.predict_personalized(train, test, half).collect()
    with pytest.raises(PySparkException, match="once in each direction"):
        pr.knn_neighbours(train, 3, similarity=half).collect()
    whole = lambda tr, lo, hi: sm.jaccard_similarity(tr)
    key = lambda df: sorted((r.user_id, r.item_id, round(r.pred, 9)) for r in df.select("user_id", "item_id", "pred").collect())
    assert key(pr.predict_personalized(train, test, whole)) == key(pr.predict_personalized(train, test, "jaccard"))
    assert pr.knn_neighbours(train, 3, similarity=whole).orderBy("user_id", "rank").collect() == pr.knn_neighbours(train, 3, similarity="jaccard").orderBy("user_id", "rank").collect()


def test_update_moves_old_cosines_only_for_many_touched_users(spark, tiny, monkeypatch):
    train, _, _ = tiny
    new = spark.createDataFrame([(7, 1, 4.0), (7, 3, 2.0), (1, 5, 1.0)], RATING_SCHEMA)
    made = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (1 << 20, 0):
            monkeypatch.setattr(up, "BROADCAST_USERS", most)
            cosines = up.append(up.fit(train), new).cosines
            sent = re.findall(r"BroadcastHashJoin[^\n]*LeftAnti", cosines._jdf.queryExecution().executedPlan().toString())
            made.append((len(sent) >= 2, sorted((r.user_id, r.other_id, round(r.sim, 9)) for r in cosines.collect())))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [m[0] for m in made] == [True, False] and made[0][1] == made[1][1]
