"""Recommendation on the hand fixture."""

from pyspark.sql import functions as F

from nearrate.operators import recommend as rc


def test_top3_knn2(spark, tiny):
    tr, _, _ = tiny
    targets = spark.createDataFrame([(1,), (5,)], "user_id bigint")
    got = {(r.user_id, r.rank): (r.item_id, round(r.pred, 6))
           for r in rc.recommend(tr, targets, k=2, n=3).collect()}
    assert got == {(1, 1): (4, 5.0), (1, 2): (5, 4.0), (1, 3): (6, 4.0),
                   (5, 1): (1, 3.5), (5, 2): (2, 3.5), (5, 3): (3, 3.5)}


def test_candidates_exclude_rated(spark, tiny):
    tr, _, _ = tiny
    c = {(r.user_id, r.item_id) for r in rc.candidates(tr, tr.where("user_id in (1, 5)")).collect()}
    assert c == {(1, 4), (1, 5), (1, 6), (5, 1), (5, 2), (5, 3), (5, 4)}


def test_add_ratings_and_names(spark, tiny):
    tr, _, _ = tiny
    new = spark.createDataFrame([(7, 1, 5.0), (7, 2, 1.0)], "user_id bigint, item_id bigint, rating double")
    both = rc.add_ratings(tr, new)
    assert both.count() == tr.count() + 2
    names = spark.createDataFrame([(4, "four"), (5, "five")], "item_id bigint, name string")
    targets = spark.createDataFrame([(1,)], "user_id bigint")
    out = rc.with_names(rc.recommend(tr, targets, k=2, n=2), names)
    assert {(r.item_id, r.name) for r in out.collect()} == {(4, "four"), (5, "five")}


def test_dense_index(spark):
    df = spark.createDataFrame([(x,) for x in [30, 10, 20, 10, 50, 40]], "item_id bigint")
    from nearrate.operators.indexing import dense_index
    got = sorted((r.item_id, r.idx) for r in dense_index(df, "item_id").collect())
    assert got == [(10, 1), (20, 2), (30, 3), (40, 4), (50, 5)]


def test_recommend_with_any_predictor(spark, tiny):
    from nearrate.operators import predictors as pr
    tr, _, _ = tiny
    targets = tr.where("user_id in (1, 5)")
    scored = sorted(((r.user_id, -round(r.pred, 12), r.item_id) for r in pr.predict_baseline(tr, rc.candidates(tr, targets)).collect()))
    want = {(u, i) for u in (1, 5) for _, i in [(p, i) for v, p, i in scored if v == u][:2]}
    got = rc.recommend_with(tr, targets, pr.predict_baseline, n=2).collect()
    assert {(r.user_id, r.item_id) for r in got} == want and {r["rank"] for r in got} == {1, 2}


def test_kept_tables_are_released(spark, tiny):
    from nearrate.keep import keep, releasing
    tr, _, _ = tiny
    outside = keep(tr.where("rating > 2"))
    with releasing():
        inside = keep(tr.where("rating > 3"))
        assert rc.recommend(tr, tr.where("user_id = 1"), k=2, n=2).count() == 2
        assert inside.storageLevel.useMemory
    assert not inside.storageLevel.useMemory and outside.storageLevel.useMemory
    outside.unpersist()


def test_approximate_neighbours_of_targets_alone(spark):
    """The rows of the target users, whether buckets are given, made or hold everyone."""
    import random
    from nearrate.operators import buckets as bk
    from nearrate.operators.products import blocked_join
    rnd = random.Random(5)
    pairs = {(rnd.randrange(60), rnd.randrange(25)) for _ in range(500)}
    train = spark.createDataFrame([(u, i, float(rnd.randint(1, 5))) for u, i in sorted(pairs)], "user_id bigint, item_id bigint, rating double")
    targets = spark.createDataFrame([(3,), (8,), (41,), (3,), (900,)], "user_id bigint")

    def rows(df):
        return sorted(tuple(r) for r in df.select("user_id", "other_id", F.round("sim", 9), "rank").collect())

    for partitions, replication in ((4, 2), (3, 3)):
        every = rows(bk.approximate_neighbours(train, 6, partitions, replication))
        some = rows(bk.approximate_neighbours(train, 6, partitions, replication, targets=targets))
        assert some and some == [r for r in every if r[0] in (3, 8, 41)]
    left = spark.createDataFrame([(b, 1, x) for b in (0, 1) for x in (7, 8)], "g int, item_id bigint, x int")
    right = spark.createDataFrame([(b, 1, y) for b in (1, 2) for y in range(5)], "g int, item_id bigint, y int")
    met = blocked_join(left, right, "item_id", "y", block_rows=2, group=("g",))
    assert sorted((r.g, r.x, r.y) for r in met.collect()) == [(1, x, y) for x in (7, 8) for y in range(5)]
