"""Means, deviations and norms.

All aggregates are plain ``groupBy``/``agg`` so Spark combines map-side; means
are joined back as DataFrames (Spark broadcasts them at run time only when AQE
measures them small), and the global mean enters row expressions as a scalar
subquery, never through a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nearrate.functions import normalized_deviation
from nearrate.operators.products import in_chunks, own_exchange

#: About so many elements are in one array of a set or list.
CHUNK_ROWS = 1024


def global_mean(ratings: DataFrame) -> DataFrame:
    """A1: one row, ``global_mean`` (NULL on empty input)."""
    return ratings.agg(F.avg("rating").alias("global_mean"))


def global_mean_col(ratings: DataFrame) -> Column:
    """A1 as a scalar-subquery column usable inside any projection."""
    return global_mean(ratings).scalar()


def user_means(ratings: DataFrame) -> DataFrame:
    """A2: (user_id, user_mean)."""
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("user_mean"))


def item_means(ratings: DataFrame) -> DataFrame:
    """A3: (item_id, item_mean)."""
    return ratings.groupBy("item_id").agg(F.avg("rating").alias("item_mean"))


def one_user_mean(ratings: DataFrame, user_id: int) -> DataFrame:
    """A4: mean of one user (NULL if the user has no rating)."""
    return (ratings.where(F.col("user_id") == user_id)
            .agg(F.lit(user_id).cast("bigint").alias("user_id"), F.avg("rating").alias("user_mean")))


def one_item_mean(ratings: DataFrame, item_id: int) -> DataFrame:
    """A5: mean of one item (NULL if the item has no rating)."""
    return (ratings.where(F.col("item_id") == item_id)
            .agg(F.lit(item_id).cast("bigint").alias("item_id"), F.avg("rating").alias("item_mean")))


def rating_stats(ratings: DataFrame, key: str = "user_id") -> DataFrame:
    """Count, mean and population std per key; empty groups read 0."""
    return ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.avg("rating"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.stddev_pop("rating"), F.lit(0.0)).alias("std_pop"))


def with_user_mean(ratings: DataFrame, means: DataFrame | None = None,
                   fallback: Column | None = None) -> DataFrame:
    """Attach ``user_mean`` (E5): left join on user means, unknown users take
    ``fallback`` (the global mean of the training set)."""
    if means is None:
        means = user_means(ratings)
    out = ratings.join(means, "user_id", "left")
    if fallback is not None:
        out = out.withColumn("user_mean", F.coalesce(F.col("user_mean"), fallback))
    return out


def deviations(train: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """V1: (user_id, item_id, rating, user_mean, dev) for every training rating.

    Every training user has a mean, so the join to user means is inner and the
    global-mean fallback of E2 never fires here.
    """
    return (train.join(own_exchange(user_means(train), "user_id"), "user_id")
            .withColumn("dev", normalized_deviation("rating", "user_mean", lo, hi)))


def item_mean_deviation(train: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """(item_id, item_dev) = mean normalized deviation per item."""
    return deviations(train, lo, hi).groupBy("item_id").agg(F.avg("dev").alias("item_dev"))


def user_norms(dev: DataFrame) -> DataFrame:
    """(user_id, norm) = L2 norm of a user's deviations."""
    return dev.groupBy("user_id").agg(F.sqrt(F.sum(F.col("dev") * F.col("dev"))).alias("norm"))


def preprocessed(dev: DataFrame, *more: str) -> DataFrame:
    """V2: (user_id, item_id, rui) = deviation / user norm; users with norm 0
    (all ratings equal to their mean) are dropped, they have similarity 0 with
    everyone. ``more``: columns of ``dev`` to be kept."""
    return (dev.join(own_exchange(user_norms(dev).where(F.col("norm") > 0), "user_id"), "user_id")
            .select("user_id", "item_id", (F.col("dev") / F.col("norm")).alias("rui"), *more))


def items_per_user(ratings: DataFrame) -> DataFrame:
    """Facts of each user's distinct item set (n_items, min_item, max_item)."""
    return ratings.groupBy("user_id").agg(
        F.countDistinct("item_id").alias("n_items"),
        F.min("item_id").alias("min_item"), F.max("item_id").alias("max_item"))


def users_per_item(ratings: DataFrame) -> DataFrame:
    """Facts of each item's distinct rater set (n_users, min_user, max_user)."""
    return ratings.groupBy("item_id").agg(
        F.countDistinct("user_id").alias("n_users"),
        F.min("user_id").alias("min_user"), F.max("user_id").alias("max_user"))


def rating_lists(ratings: DataFrame, key: str = "user_id") -> DataFrame:
    """The ratings of each key summarised as (n, rating_sum)."""
    return ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                                    F.sum("rating").alias("rating_sum"))


def _other(key: str) -> str:
    return "item_id" if key == "user_id" else "user_id"


def member_sets(ratings: DataFrame, key: str = "user_id", rows: int = CHUNK_ROWS) -> DataFrame:
    """A10 (key user_id) and A11 (key item_id): (key, chunk, elements), the
    distinct items of each user or users of each item, whole, in arrays of about
    ``rows``: a hot key is never collected into one row."""
    other = _other(key)
    return in_chunks(ratings.select(key, other).distinct(), key, other, other, rows)


def rating_chunks(ratings: DataFrame, key: str = "user_id", rows: int = CHUNK_ROWS) -> DataFrame:
    """(key, chunk, elements), all ratings of each user or item as
    (other id, rating), in arrays of about ``rows``; repeated ratings stay."""
    other = _other(key)
    return in_chunks(ratings.select(key, other, "rating"), key, other, F.struct(other, "rating"), rows)
