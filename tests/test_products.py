"""Pairs are summed where they are sent: not shuffled as rows, the same at any dealing."""
import re

import pytest
from pyspark.sql import functions as F

from nearrate.operators import buckets as bk
from nearrate.operators import features as fx
from nearrate.operators import predictors as pr
from nearrate.operators import products
from nearrate.operators import similarity as sm


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pair_exchanges(df):
    return re.findall(r"Exchange hashpartitioning\([^)]*(?:other_id|_groupingexpression)[^)]*\)", plan(df))


def test_pairs_are_not_shuffled_as_rows(spark, tiny):
    train, test, _ = tiny
    assert not pair_exchanges(sm.cosine_half(train)) and not pair_exchanges(sm.jaccard_half(train))
    assert not pair_exchanges(pr.knn_neighbours(train, 2, similarity="jaccard"))
    assert not pair_exchanges(bk.bucket_neighbours(train, bk.user_buckets(train, 4, 2), 2))
    for kind in ("cosine", "jaccard"):
        assert not pair_exchanges(pr.predict_personalized(train, test, kind))


@pytest.mark.parametrize("block, key, task", [(1, 1, 1), (2, 3, 2), (2048, 2, 1)])
def test_same_results_however_pairs_are_dealt(spark, tiny, monkeypatch, block, key, task):
    train, test, _ = tiny
    made = lambda: [sorted(tuple(round(x, 9) for x in r) for r in df.collect()) for df in (
        sm.cosine_similarity(train), sm.jaccard_similarity(train), sm.jaccard_rows(train), pr.knn_neighbours(train, 2), pr.knn_neighbours(train, 2, similarity="jaccard"),
        *[pr.predict_personalized(train, test, k).select("user_id", "item_id", "pred") for k in ("cosine", "jaccard")])]
    want = made()
    monkeypatch.setattr(products, "BLOCK_ROWS", block)
    monkeypatch.setattr(products, "KEY_PAIRS", key)
    monkeypatch.setattr(products, "TASK_PAIRS", task)
    assert made() == want


def test_similarities_of_the_same_requests_share_one_product(spark, tiny, monkeypatch):
    train, test, _ = tiny
    sizes, made = products._sizes, []
    monkeypatch.setattr(products, "_sizes", lambda *a: made.append(1) or sizes(*a))
    asked = pr.asked_deviations(train, fx.deviations(train), test, ("cosine", "jaccard"))
    assert len(made) == 1
    rows = lambda df: sorted((r.user_id, r.item_id, round(r.pred, 9)) for r in df.collect())
    for kind in ("unit", "cosine", "jaccard"):
        assert rows(pr.predict_personalized(train, test, kind, asked=asked)) == rows(pr.predict_personalized(train, test, kind))


@pytest.mark.parametrize("shift, factor", [(-10**15, 1), (-3, 1 << 31), (7, -(1 << 40))])
def test_ids_of_any_size_and_distance(spark, tiny, shift, factor):
    train, test, _ = tiny
    moved = lambda df, *ids: df.select(*[(F.col(c) * factor + shift).alias(c) if c in ids else c for c in df.columns])
    back = lambda df: sorted(tuple(round((r[c] - shift) / factor if c in ("user_id", "other_id") else r[c], 9) for c in df.columns) for r in df.collect())
    plain = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.collect())
    far = moved(train, "user_id")
    assert back(sm.cosine_similarity(far)) == plain(sm.cosine_similarity(train))
    assert back(sm.jaccard_rows(far)) == plain(sm.jaccard_rows(train))
    for kind in ("cosine", "jaccard"):
        got, want = (pr.predict_personalized(a, b, kind).select("user_id", "item_id", "pred") for a, b in ((far, moved(test, "user_id")), (train, test)))
        assert back(got) == plain(want)


@pytest.mark.parametrize("block, key", [(2048, 1 << 22), (1, 1), (2, 3)])
def test_requests_take_raters_to_the_neighbours_as_lists(spark, tiny, monkeypatch, block, key):
    train, test, _ = tiny
    dev, near = fx.deviations(train), pr.knn_neighbours(train, 3).where(F.col("rank") <= 3)
    rows = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.select("user_id", "item_id", "num", "den").collect())
    want = rows(pr.weighted_deviation(near.select("user_id", "other_id", "sim"), dev, test))
    monkeypatch.setattr(products, "BLOCK_ROWS", block)
    monkeypatch.setattr(products, "KEY_PAIRS", key)
    made = pr.neighbour_deviation(near, dev, test)
    assert want and rows(made) == want
    assert not pair_exchanges(pr.predict_knn(train, test, 3, neighbours=near))
    none = pr.neighbour_deviation(near, dev.limit(0), test)
    assert none.count() == 0 and pr.neighbour_deviation(near.limit(0), dev, test).count() == 0


def test_sums_are_rounded_once(spark, tiny):
    """Which sums count is told without rounding, exactly as rounded they would."""
    import math
    from nearrate.functions import counts_sim, positive_sim, round_sim
    from nearrate.operators import buckets as bk, neighbours as nb, similarity as sm
    half = 5e-13
    values = [half, -half, math.nextafter(half, 0), -math.nextafter(half, 0), math.nextafter(half, 1), 4.9e-13, 1e-12, 1.5e-12, 0.0, -0.0, 1e-300, 0.25,
              -1.0, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", (round_sim("x") != 0).alias("some"), counts_sim("x").alias("counts"), (round_sim("x") > 0).alias("above"), positive_sim("x").alias("positive")).collect()
    assert all(r.some == r.counts and r.above == r.positive for r in got), got
    train, _, _ = tiny
    buckets = bk.user_buckets(train, 3, 2)
    for df, most in ((sm.cosine_half(train), 1), (sm.jaccard_half(train), 1), (nb.cosine_neighbours(train, 1), 1), (bk.bucket_neighbours(train, buckets, 2), 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
        assert plan.count("round(") <= most, plan


@pytest.mark.parametrize("block, key, task, factor", [(2048, 1 << 22, 1 << 20, 1), (3, 4, 500, 1), (2048, 1 << 22, 300, -(1 << 40))])
def test_near_pairs_are_exact_and_lose_none(spark, monkeypatch, block, key, task, factor):
    """A byte for a value, then whole values for the pairs left: equal sums, ties at the k-th and all."""
    import random
    from collections import defaultdict
    rng, k = random.Random(5), 3
    rows = [(u, i, rng.choice([-0.9, -0.3001, 0.3, 0.3001, 0.30015, 1.0])) for u in range(40) for i in rng.sample(range(25), 6)]
    rows += [(100 + u, i, 0.5) for u in range(6) for i in (3, 4)]  # ties
    sums = defaultdict(float)
    for u, i, x in rows:
        for v, j, y in rows:
            if i == j and u != v:
                sums[u, v] += x * y
    want = {}
    for u in {u for u, _ in sums}:
        mine = sorted((s for (a, _), s in sums.items() if a == u and s > 1e-9), reverse=True)
        least = mine[min(k, len(mine)) - 1] if mine else 2
        want |= {(a, v): s for (a, v), s in sums.items() if a == u and s >= least - 1e-9 and s > 1e-9}
    monkeypatch.setattr(products, "BLOCK_ROWS", block)
    monkeypatch.setattr(products, "KEY_PAIRS", key)
    monkeypatch.setattr(products, "TASK_PAIRS", task)
    df = spark.createDataFrame([(u * factor + 7, i, x) for u, i, x in rows], "user_id long, item_id long, x double")
    made = [((r.user_id - 7) // factor, (r.other_id - 7) // factor, r.x) for r in products.near_pairs(df, "user_id", "item_id", "x", k).collect()]
    got = {(u, v): s for u, v, s in made}
    assert len(got) == len(made) and set(want) <= set(got)
    assert len(got) < len(sums) / 2 or key < 100  # a hot key's places have bounds of their own
    assert all(s == pytest.approx(sums[p]) for p, s in got.items())
    assert products.near_pairs(df.limit(0), "user_id", "item_id", "x", k).count() == 0


def test_neighbours_move_a_byte_for_a_value(spark, monkeypatch):
    """Where a user meets far more others than k, no list of whole values goes to it."""
    from nearrate.operators import neighbours as nb
    train = spark.range(3000).select((F.col("id") % 300).alias("user_id"), (F.xxhash64("id") % 40 + 50).alias("item_id"), (F.abs(F.xxhash64("id", F.lit(3))) % 5 + 1).cast("double").alias("rating"))
    train = train.dropDuplicates(["user_id", "item_id"])
    monkeypatch.setattr(nb, "NEAR_OF_MET", 0)
    monkeypatch.setattr(nb, "reaching_below_zero", lambda train, k, n: train.select("user_id").limit(0))
    made = nb.cosine_neighbours(train, 2)
    assert "MapInArrow" in plan(made)
    near = sorted((r.user_id, r.other_id, r.rank, round(r.sim, 9)) for r in made.collect())
    monkeypatch.setattr(nb, "NEAR_OF_MET", 1 << 20)
    assert near == sorted((r.user_id, r.other_id, r.rank, round(r.sim, 9)) for r in nb.cosine_neighbours(train, 2).collect()) and len(near) > 500


def test_requests_for_few_neighbours_move_ids_alone(spark, tiny, monkeypatch):
    train, test, _ = tiny
    dev, near = fx.deviations(train), pr.knn_neighbours(train, 3)
    rows = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.select("user_id", "item_id", "num", "den").collect())
    lists = lambda df: [x for x in plan(df).split("\n") if "collect_list" in x and "dev" in x]
    whole = pr.neighbour_deviation(near, dev, test)
    assert lists(whole) and lists(pr.neighbour_deviation(near, dev, test, k=1 << 20))
    monkeypatch.setattr(products, "NEAR_OF_MET", 0)
    for block, key in ((2048, 1 << 22), (1, 1)):
        monkeypatch.setattr(products, "BLOCK_ROWS", block)
        monkeypatch.setattr(products, "KEY_PAIRS", key)
        bare = pr.neighbour_deviation(near, dev, test, k=3)
        assert not lists(bare) and rows(bare) == rows(whole) != []
