"""User-user similarities (V3-V8).

Tables are (user_id, other_id, sim) with both directions, no self pair, and
only non-zero similarities rounded to ``SIM_DIGITS`` (an absent pair reads 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nearrate.functions import counts_sim, round_sim
from nearrate.keep import keep
from nearrate.operators import features as fx
from nearrate.operators.products import asked_pair_sums, pair_sums


def mirror(half: DataFrame) -> DataFrame:
    """Both directions of an unordered pair table, in one pass (an explode of
    the two orientations, so the input is computed once, not once per branch
    of a union)."""
    both = F.explode(F.array(
        F.struct(F.col("user_id").alias("u"), F.col("other_id").alias("v")),
        F.struct(F.col("other_id").alias("u"), F.col("user_id").alias("v")))).alias("p")
    return half.select(both, "sim").select(F.col("p.u").alias("user_id"),
                                           F.col("p.v").alias("other_id"), "sim")


def unit_vectors(train: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """V2 kept: products read these rows several times."""
    return keep(fx.preprocessed(fx.deviations(train, lo, hi)))


def cosine_half(train: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """V3/V4/V5: adjusted cosine of each unordered co-rating pair.

    Deviations are divided by the user's norm first (V2), so the cosine is a
    dot product over shared items."""
    dots = pair_sums(unit_vectors(train, lo, hi), "user_id", "item_id", "rui")
    return dots.where(counts_sim("rui")).select("user_id", "other_id", round_sim("rui").alias("sim"))


def cosine_similarity(train: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    return mirror(cosine_half(train, lo, hi))


def jaccard_half(train: DataFrame) -> DataFrame:
    """V6: |A ∩ B| / |A ∪ B| of rated-item sets, for pairs with a shared item.
    The set sizes travel with the rows, so nothing is joined after the product."""
    inter = pair_sums(keep(_set_rows(train)), "user_id", "item_id", "one", carry="n")
    return _jaccard_of(inter)


def jaccard_rows(train: DataFrame) -> DataFrame:
    """Both directions of ``jaccard_half``, each with its first user: to be ranked."""
    return _jaccard_of(pair_sums(keep(_set_rows(train)), "user_id", "item_id", "one", carry="n", both=True))


def _set_rows(train: DataFrame) -> DataFrame:
    counts = train.groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return (train.join(fx.own_exchange(counts, "user_id"), "user_id")
            .select("user_id", "item_id", F.lit(1.0).alias("one"), "n"))


def _jaccard_of(inter: DataFrame) -> DataFrame:
    sim = F.col("one") / (F.col("n_u") + F.col("n_v") - F.col("one"))
    return inter.where(counts_sim(sim)).select("user_id", "other_id", round_sim(sim).alias("sim"))


def unordered(pairs: DataFrame) -> DataFrame:
    """The pairs of two users, the smaller id first."""
    two = pairs.where(F.col("user_id") != F.col("other_id"))
    return two.select(F.least("user_id", "other_id").alias("user_id"), F.greatest("user_id", "other_id").alias("other_id"))


def asked_cosines(train: DataFrame, pairs: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """The non-zero adjusted cosines of requested pairs alone, smaller id first."""
    return asked_sums(unit_vectors(train, lo, hi), pairs)


def asked_sums(rui: DataFrame, pairs: DataFrame) -> DataFrame:
    """``asked_cosines`` from unit vectors."""
    dots = asked_pair_sums(rui, unordered(pairs), "user_id", "item_id", "rui")
    return dots.where(counts_sim("rui")).select("user_id", "other_id", round_sim("rui").alias("sim"))


def asked_jaccards(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """The Jaccard similarities of requested pairs alone, smaller id first."""
    return _jaccard_of(asked_pair_sums(keep(_set_rows(train)), unordered(pairs), "user_id", "item_id", "one", carry="n"))


def attach(pairs: DataFrame, half: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of ``pairs`` with ``sim`` from a table of pairs, smaller id first."""
    known = half.select(F.col("user_id").alias("_lo"), F.col("other_id").alias("_hi"), "sim")
    keyed = pairs.withColumn("_lo", F.least("user_id", "other_id")).withColumn("_hi", F.greatest("user_id", "other_id"))
    return keyed.join(known, ["_lo", "_hi"], how).drop("_lo", "_hi")


def jaccard_similarity(train: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    return mirror(jaccard_half(train))


def unit_similarity(pairs: DataFrame) -> DataFrame:
    """V7: constant similarity 1 for every requested (user_id, other_id) pair."""
    return pairs.withColumn("sim", F.lit(1.0))


def lookup(sim: DataFrame, pairs: DataFrame, self_sim=1.0) -> DataFrame:
    """V8: similarity of requested (user_id, other_id) pairs, 0 when absent;
    a self pair reads ``self_sim``."""
    found = pairs.join(sim, ["user_id", "other_id"], "left")
    return found.withColumn(
        "sim", F.when(F.col("user_id") == F.col("other_id"), F.lit(self_sim) if isinstance(self_sim, float) else self_sim)
                .otherwise(F.coalesce(F.col("sim"), F.lit(0.0))))


def cosine_lookup(train: DataFrame, pairs: DataFrame, lo: float = 1.0,
                  hi: float = 5.0) -> DataFrame:
    """V8 without the all-pairs table: the cosine of each requested
    (user_id, other_id) pair, from the items of the two users alone (0 when
    they share no item or a norm is 0, 1 for a self pair)."""
    found = attach(pairs, asked_cosines(train, pairs, lo, hi), "left")
    return found.withColumn("sim", F.when(F.col("user_id") == F.col("other_id"), F.lit(1.0))
                            .otherwise(F.coalesce(F.col("sim"), F.lit(0.0))))


def checked(sim: DataFrame) -> DataFrame:
    """A supplied similarity table as it was given, checked on the way."""
    return mirror(checked_half(sim))


def checked_half(sim: DataFrame) -> DataFrame:
    """``checked``, the smaller id of each pair first. The job
    fails, naming the pair, if one has a missing id, is a self pair, does not stand
    exactly once in each direction, has a similarity that is missing, not finite,
    zero, not rounded to SIM_DIGITS places or different in the two directions."""
    given = sim.select("user_id", "other_id", F.col("sim").cast("double").alias("sim"))
    one = (given.groupBy(F.least("user_id", "other_id").alias("a"), F.greatest("user_id", "other_id").alias("b"))
           .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("user_id") < F.col("other_id")).alias("forward"), F.count("sim").alias("known"),
                F.count_if(F.col("user_id").isNull() | F.col("other_id").isNull()).alias("lost"), F.min("sim").alias("low"), F.max("sim").alias("sim")))
    finite = F.abs("sim") < F.lit(float("inf"))
    wrong = (F.when(F.col("lost") > 0, "an id is missing")
             .when(F.col("a") == F.col("b"), "a user is paired with itself")
             .when((F.col("n") != 2) | (F.col("forward") != 1), "it must stand once in each direction")
             .when((F.col("known") != 2) | F.isnan("sim") | ~finite, "its similarity is missing or not finite")
             .when(F.col("low") != F.col("sim"), "its directions differ")
             .when(F.col("sim") == 0, "zero must be left out")
             .when(round_sim("sim") != F.col("sim"), "it is not rounded"))
    place = F.concat(F.lit("supplied similarity of "), F.coalesce(F.col("a").cast("string"), F.lit("null")), F.lit(" and "),
                     F.coalesce(F.col("b").cast("string"), F.lit("null")), F.lit(": "))
    value = F.when(wrong.isNull(), F.col("sim")).otherwise(F.raise_error(F.concat(place, wrong)).cast("double"))
    return one.select(F.col("a").alias("user_id"), F.col("b").alias("other_id"), value.alias("sim"))
