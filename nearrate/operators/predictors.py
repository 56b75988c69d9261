"""Predictors.

A predictor is a function ``(train, pairs, ...) -> DataFrame``: it returns
``pairs`` (any columns, at least user_id and item_id) with a ``pred`` column
added. Nothing is fitted on the driver; the "model" is the lazy plan over
``train``, and callers persist intermediate tables when they score many times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nearrate.functions import combine, round_sim
from nearrate.keep import keep
from nearrate.operators import features as fx
from nearrate.operators.products import asked_members, asked_products, blocked_join


def predict_global(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """The global mean for every pair."""
    return pairs.withColumn("pred", fx.global_mean_col(train))


def predict_user_mean(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """The user's mean, the global mean for unknown users."""
    g = fx.global_mean_col(train)
    return (pairs.join(fx.own_exchange(fx.user_means(train), "user_id"), "user_id", "left")
            .withColumn("pred", F.coalesce(F.col("user_mean"), g)).drop("user_mean"))


def predict_item_mean(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """The item's mean, the global mean for unknown items."""
    g = fx.global_mean_col(train)
    return (pairs.join(fx.own_exchange(fx.item_means(train), "item_id"), "item_id", "left")
            .withColumn("pred", F.coalesce(F.col("item_mean"), g)).drop("item_mean"))


def _finish(pairs_with: DataFrame, dev_col: str, shortcut: bool, g,
            lo: float, hi: float) -> DataFrame:
    """Shared tail of P4/P5/P7: combine the user mean and a deviation.

    ``shortcut`` (P4, P5): a user whose mean equals the global mean, or an
    unknown user, gets the global mean. Without it (P7) only an unknown user
    does.
    """
    um = F.col("user_mean")
    dev = F.coalesce(F.col(dev_col), F.lit(0.0))
    if shortcut:
        known = F.coalesce(um, g)
        pred = F.when(known == g, g).otherwise(combine(known, dev, lo, hi))
    else:
        pred = F.when(um.isNull(), g).otherwise(combine(um, dev, lo, hi))
    return pairs_with.withColumn("pred", pred).drop("user_mean", dev_col)


def predict_baseline(train: DataFrame, pairs: DataFrame, lo: float = 1.0,
                     hi: float = 5.0) -> DataFrame:
    """User mean moved by the item's mean normalized deviation."""
    g = fx.global_mean_col(train)
    p = (pairs.join(fx.own_exchange(fx.user_means(train), "user_id"), "user_id", "left")
         .join(fx.own_exchange(fx.item_mean_deviation(train, lo, hi), "item_id"), "item_id", "left"))
    return _finish(p, "item_dev", True, g, lo, hi)


# ---------------------------------------------------------------- similarity-weighted
def weighted_deviation(weights, dev: DataFrame, pairs: DataFrame, group: str | None = None) -> DataFrame:
    """P6 core: for each requested (user_id, item_id), the sums over users v
    with weight ``sim`` = w(user, v) who rated the item of w * dev(v, item)
    (``num``) and |w| (``den``); split by the integer column ``group`` of
    ``weights`` when given. ``weights`` is a table (user_id, other_id, sim), or a
    function from requested (user_id, other_id) rows to those with ``sim``.

    Requests meet the raters of their item first (a hot item's raters in
    blocks), then the weights: one plan for any size.
    """
    mask = pairs.select("user_id", "item_id").distinct()
    raters = dev.select("item_id", F.col("user_id").alias("other_id"), "dev")
    met = blocked_join(mask, raters, "item_id", "other_id").where(F.col("user_id") != F.col("other_id"))
    weighted = weights(met) if callable(weights) else met.join(weights, ["user_id", "other_id"])
    return _summed(weighted, [group] if group else [])


def neighbour_deviation(neighbours: DataFrame, dev: DataFrame, pairs: DataFrame, group: str | None = None, k: int | None = None) -> DataFrame:
    """``weighted_deviation`` by a table of neighbours, few of each user and each once:
    requests take the raters of their item to their user's neighbours
    (``products.asked_members``), and no row for each request and rater is shuffled.
    ``k``: the most neighbours of a user, if known."""
    more = ["sim", *([group] if group else [])]
    mask = keep(pairs.select("user_id", "item_id").distinct())
    rows = dev.select("user_id", "item_id", "dev")
    others = neighbours.where(F.col("user_id") != F.col("other_id")).select("user_id", "other_id", *more)
    return _summed(asked_members(rows, mask, others, "dev", more, per_user=k), more[1:])


def _summed(weighted: DataFrame, group: list[str]) -> DataFrame:
    return (weighted.groupBy("user_id", "item_id", *group)
            .agg(F.sum(F.col("sim") * F.col("dev")).alias("num"), F.sum(F.abs("sim")).alias("den")))


def _ratio(num: str, den: str):
    n, d = F.coalesce(F.col(num), F.lit(0.0)), F.coalesce(F.col(den), F.lit(0.0))
    return F.when(d != 0, n / d).otherwise(F.lit(0.0))


def similarity_function(similarity):
    """A similarity by name, or any function ``(ratings, lo, hi) -> (user_id,
    other_id, sim)``, whose table is checked (``similarity.checked``)."""
    from nearrate.operators import similarity as sm
    known = {"cosine": sm.cosine_similarity, "jaccard": sm.jaccard_similarity}
    if callable(similarity):
        return lambda train, lo, hi: sm.checked(similarity(train, lo, hi))
    return known[_known(similarity)]


def _known(similarity) -> str:
    if similarity not in ("unit", "cosine", "jaccard"):
        raise ValueError(f"similarity must be unit, cosine, jaccard or a function, not {similarity!r}")
    return similarity


#: A named similarity from the products of two users' columns.
_ASKED = {
    "cosine": lambda u, v, shared: round_sim(F.sum(u["rui"] * v["rui"]).over(shared)),
    "jaccard": lambda u, v, shared: round_sim(F.count(v["n"]).over(shared) / (F.max(u["n"]).over(shared) + F.max(v["n"]).over(shared) - F.count(v["n"]).over(shared))),
}


def asked_deviations(train: DataFrame, dev: DataFrame, pairs: DataFrame, kinds) -> DataFrame:
    """``weighted_deviation`` by one or more of the similarities "cosine" and
    "jaccard", with those of the requested (user, rater) rows alone: (user_id,
    item_id, num_<kind>, den_<kind>, ...), of one product of pairs for all kinds."""
    rows, columns = dev.select("user_id", "item_id", F.col("dev").alias("fact")), []
    if "cosine" in kinds:  # a user with norm 0 has cosine 0 with everyone
        norms = fx.own_exchange(fx.user_norms(dev), "user_id")
        rows = rows.join(norms, "user_id").withColumn("rui", F.when(F.col("norm") > 0, F.col("fact") / F.col("norm")).otherwise(F.lit(0.0))).drop("norm")
        columns.append("rui")
    if "jaccard" in kinds:
        counts = train.groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
        rows = rows.join(fx.own_exchange(counts, "user_id"), "user_id")
        columns.append("n")
    found = asked_products(rows, pairs, "item_id", columns, {k: _ASKED[k] for k in kinds})
    return found.groupBy("user_id", "item_id").agg(*[c for k in kinds for c in (
        F.sum(F.col(k) * F.col("fact")).alias(f"num_{k}"), F.sum(F.abs(k)).alias(f"den_{k}"))])


def _asked_deviation(train: DataFrame, dev: DataFrame, pairs: DataFrame, similarity, lo: float, hi: float) -> DataFrame:
    """``weighted_deviation`` with similarities of the requested (user, rater) rows
    alone: a named one is computed for those, a function's table is checked and joined."""
    from nearrate.operators import similarity as sm
    if not callable(similarity):
        _known(similarity)
    if similarity == "unit":
        return weighted_deviation(sm.unit_similarity, dev, pairs)
    if callable(similarity):
        half = sm.checked_half(similarity(train, lo, hi))
        return weighted_deviation(lambda met: sm.attach(met, half), dev, pairs)
    return _of_kind(asked_deviations(train, dev, pairs, (similarity,)), similarity)


def _of_kind(asked: DataFrame, kind: str) -> DataFrame:
    return asked.select("user_id", "item_id", F.col(f"num_{kind}").alias("num"), F.col(f"den_{kind}").alias("den"))


def predict_personalized(train: DataFrame, pairs: DataFrame, similarity="cosine",
                         sim: DataFrame | None = None, lo: float = 1.0,
                         hi: float = 5.0, asked: DataFrame | None = None) -> DataFrame:
    """P5: baseline whose item deviation is the similarity-weighted mean
    deviation of all users who rated the item (the user itself included with
    weight 1 when it rated the item in train).

    ``similarity`` is "unit", "cosine", "jaccard" or a function from ratings to
    (user_id, other_id, sim); ``sim`` optionally supplies that table, without
    self pairs; ``asked`` the ``asked_deviations`` of these pairs, when several
    named similarities are wanted."""
    g = fx.global_mean_col(train)
    dev = keep(fx.deviations(train, lo, hi))
    if sim is not None:
        wd = weighted_deviation(sim, dev, pairs)
    elif asked is not None and similarity != "unit":
        wd = _of_kind(asked, _known(similarity))
    else:
        wd = _asked_deviation(train, dev, pairs, similarity, lo, hi)
    own = dev.select("user_id", "item_id", F.col("dev").alias("self_dev"))
    p = (pairs.join(fx.own_exchange(fx.user_means(train), "user_id"), "user_id", "left")
         .join(wd, ["user_id", "item_id"], "left")
         .join(own, ["user_id", "item_id"], "left"))
    num = F.coalesce(F.col("num"), F.lit(0.0)) + F.coalesce(F.col("self_dev"), F.lit(0.0))
    den = F.coalesce(F.col("den"), F.lit(0.0)) + F.when(F.col("self_dev").isNotNull(), 1.0) \
        .otherwise(0.0)
    p = p.withColumn("wdev", F.when(den != 0, num / den).otherwise(F.lit(0.0)))
    return _finish(p.drop("num", "den", "self_dev"), "wdev", True, g, lo, hi)


def knn_neighbours(train: DataFrame, k: int, lo: float = 1.0, hi: float = 5.0,
                   similarity="cosine", dev: DataFrame | None = None) -> DataFrame:
    """K4: exact k nearest neighbours by a similarity (adjusted cosine). ``dev``:
    the deviations of ``train``, when they are there."""
    from nearrate.operators import neighbours as nb
    from nearrate.operators import similarity as sm
    if similarity == "cosine":
        return nb.cosine_neighbours(train, k, lo, hi, dev=dev)
    if similarity == "jaccard":
        return nb.top_k_positive(sm.jaccard_rows(train), k)  # never negative
    sim = similarity_function(similarity)(train, lo, hi)
    return nb.top_k(sim, k, train.agg(F.countDistinct("user_id")).scalar())


def predict_knn(train: DataFrame, pairs: DataFrame, k: int,
                neighbours: DataFrame | None = None, lo: float = 1.0,
                hi: float = 5.0) -> DataFrame:
    """P7/P8/P9 (and P10 when given approximate ``neighbours``): user mean moved
    by the weighted deviation over the k nearest neighbours who rated the item;
    an unknown user gets the global mean."""
    dev = keep(fx.deviations(train, lo, hi))
    if neighbours is None:
        neighbours = knn_neighbours(train, k, lo, hi, dev=dev)
    g = fx.global_mean_col(train)
    wd = neighbour_deviation(neighbours, dev, pairs, k=k)
    p = (pairs.join(fx.own_exchange(fx.user_means(train), "user_id"), "user_id", "left")
         .join(wd, ["user_id", "item_id"], "left")
         .withColumn("wdev", _ratio("num", "den")).drop("num", "den"))
    return _finish(p, "wdev", False, g, lo, hi)


def predict_knn_sweep(train: DataFrame, pairs: DataFrame, ks: list[int],
                      neighbours: DataFrame | None = None, lo: float = 1.0,
                      hi: float = 5.0) -> DataFrame:
    """kNN predictions for several k at once: pairs × ks with column ``k``.

    Neighbours are ranked once at max(ks) (or given, with a ``rank`` column).
    Each neighbour falls in the bucket of the smallest k that includes it; the
    sums are made per bucket, and each k adds up the buckets up to its own
    (at most len(ks) of a pair).
    """
    ks = sorted(set(int(k) for k in ks))
    dev = keep(fx.deviations(train, lo, hi))
    nbrs = neighbours if neighbours is not None else knn_neighbours(train, max(ks), lo, hi, dev=dev)
    bucket = F.lit(len(ks) - 1)
    for j in range(len(ks) - 2, -1, -1):
        bucket = F.when(F.col("rank") <= ks[j], F.lit(j)).otherwise(bucket)
    weights = nbrs.select("user_id", "other_id", "sim", bucket.alias("kb"))
    wd = neighbour_deviation(weights, dev, pairs, group="kb", k=max(ks))
    sums = wd.groupBy("user_id", "item_id").agg(F.sort_array(F.collect_list(F.struct("kb", "num", "den"))).alias("sums"))
    g = fx.global_mean_col(train)
    p = (pairs.join(fx.own_exchange(fx.user_means(train), "user_id"), "user_id", "left")
         .join(sums, ["user_id", "item_id"], "left")  # each k is made of its row, after all joins
         .select("*", F.posexplode(F.array(*[F.lit(k) for k in ks])).alias("upto", "k")))

    def added(field):
        return F.aggregate(F.filter("sums", lambda x: x["kb"] <= F.col("upto")), F.lit(0.0), lambda acc, x: acc + x[field])

    p = p.withColumn("num", added("num")).withColumn("den", added("den"))
    p = p.withColumn("wdev", _ratio("num", "den")).drop("num", "den", "sums", "upto")
    return _finish(p, "wdev", False, g, lo, hi)


def predict_mean_family(train: DataFrame, pairs: DataFrame, lo: float = 1.0,
                        hi: float = 5.0) -> DataFrame:
    """P1-P4 in one pass: ``pairs`` with pred_global, pred_user, pred_item and
    pred_baseline, sharing the means joins instead of repeating them."""
    item = fx.deviations(train, lo, hi).groupBy("item_id").agg(F.avg("rating").alias("item_mean"), F.avg("dev").alias("item_dev"))
    g = fx.global_mean_col(train)
    p = (pairs.join(fx.own_exchange(fx.user_means(train), "user_id"), "user_id", "left")
         .join(fx.own_exchange(item, "item_id"), "item_id", "left"))
    known = F.coalesce(F.col("user_mean"), g)
    dev = F.coalesce(F.col("item_dev"), F.lit(0.0))
    return (p.withColumn("pred_global", g)
            .withColumn("pred_user", known)
            .withColumn("pred_item", F.coalesce(F.col("item_mean"), g))
            .withColumn("pred_baseline", F.when(known == g, g).otherwise(combine(known, dev, lo, hi)))
            .drop("user_mean", "item_mean", "item_dev"))
