"""Recommendation (R1-R4): top-n unseen items per target user by kNN prediction.

Only items some neighbour rated can move a prediction away from the user's
mean; every other unseen item predicts exactly the mean. So the candidates are
(a) the "evidence" items, from the sparse product neighbours × deviations, and
(b) per user the n smallest unseen item ids outside the evidence, found with
a dense item index. The full users × items candidate grid is never built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from nearrate.functions import SIM_DIGITS, combine
from nearrate.keep import keep
from nearrate.operators import features as fx
from nearrate.operators.products import blocked_join
from nearrate.operators.indexing import dense_index
from nearrate.operators.neighbours import target_neighbours

#: Items of one block of the targets' grid.
BLOCK_ITEMS = 4096


def add_ratings(ratings: DataFrame, new: DataFrame) -> DataFrame:
    """Bag union of new users' ratings into the data."""
    return ratings.unionByName(new.select("user_id", "item_id", "rating"))


def candidates(ratings: DataFrame, targets: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """R2: (user_id, item_id) of every distinct item a target user has not rated.

    That is targets times items by definition, so the caller bounds the targets.
    The items are dealt over blocks of about ``block_items`` by hash, each target
    goes to every block, and they meet on the block's number."""
    items = keep(ratings.select("item_id").distinct())
    blocks = items.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_items), F.lit(1)).cast("int")).scalar()
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id"), blocks).cast("int"))
    every = targets.select("user_id").distinct().withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return (every.join(dealt, "block").select("user_id", "item_id")
            .join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti"))


def recommend(train: DataFrame, targets: DataFrame, k: int = 300, n: int = 3,
              lo: float = 1.0, hi: float = 5.0, neighbours: DataFrame | None = None) -> DataFrame:
    """(user_id, item_id, pred, rank) — the n unseen items with the highest
    kNN prediction for each target user; ties go to the smaller item id.
    ``neighbours`` (user_id, other_id, sim), such as approximate ones, replace
    the exact k nearest."""
    targets = keep(targets.select("user_id").distinct())
    dev = keep(fx.deviations(train, lo, hi))   # (user, item, rating, user_mean, dev)
    if neighbours is None:
        neighbours = target_neighbours(train, targets, k, lo, hi, keep(fx.preprocessed(dev)))
    nbrs = keep(neighbours.join(targets, "user_id", "left_semi"))
    theirs = dev.select(F.col("user_id").alias("other_id"), "item_id", "dev")
    ev = (blocked_join(nbrs.select("user_id", "other_id", "sim"), theirs, "other_id", "item_id").groupBy("user_id", "item_id")
          .agg(F.sum(F.col("sim") * F.col("dev")).alias("num"), F.sum(F.abs("sim")).alias("den")))
    mine = dev.join(targets, "user_id")
    rated = mine.select("user_id", "item_id")
    evidence = keep(ev.join(rated, ["user_id", "item_id"], "left_anti"))
    means = mine.select("user_id", "user_mean").distinct()
    wdev = F.when(F.col("den") != 0, F.col("num") / F.col("den")).otherwise(F.lit(0.0))
    scored = (evidence.join(means, "user_id")
              .select("user_id", "item_id", combine("user_mean", wdev, lo, hi).alias("pred")))

    # Fillers: the n smallest item ids outside rated ∪ evidence, at the user mean.
    idx = dense_index(dev, "item_id")
    # Before the j-th free index stand as many seen ones as have fewer than j free
    # indexes before them, so it is j plus their number.
    seen = rated.unionByName(evidence.select("user_id", "item_id")).distinct().join(idx, "item_id")
    free = F.col("idx") - F.row_number().over(Window.partitionBy("user_id").orderBy("idx"))
    before = seen.withColumn("free", free).groupBy("user_id").agg(
        *[F.count_if(F.col("free") < j).alias(f"before{j}") for j in range(1, n + 1)])
    places = F.array(*[F.coalesce(F.col(f"before{j}"), F.lit(0)) + j for j in range(1, n + 1)])
    fillers = (means.join(before, "user_id", "left").select("user_id", "user_mean", F.explode(places).alias("idx"))
               .join(idx, "idx").select("user_id", "item_id", F.col("user_mean").alias("pred")))

    return _best(scored.unionByName(fillers), n)


def _best(predicted: DataFrame, n: int) -> DataFrame:
    best = Window.partitionBy("user_id").orderBy(F.desc(F.round("pred", SIM_DIGITS)), "item_id")
    return predicted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def recommend_with(train: DataFrame, targets: DataFrame, predictor, n: int = 3) -> DataFrame:
    """R3 with any predictor (U2): ``predictor(train, pairs)`` adds ``pred`` to the
    target users' unseen items; (user_id, item_id, pred, rank) of the n best. All
    candidates are scored, so the caller bounds the number of targets."""
    predicted = predictor(train, candidates(train, targets)).select("user_id", "item_id", "pred")
    return _best(predicted, n)


def with_names(recs: DataFrame, names: DataFrame) -> DataFrame:
    """Attach item names (left join on the item dimension)."""
    return recs.join(names.select("item_id", "name"), "item_id", "left")
