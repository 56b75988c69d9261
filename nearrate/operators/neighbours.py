"""k nearest neighbours (K1-K5).

Ranking follows the original local algorithm, which ranks *every* other user:
users with similarity 0 (absent from the similarity table) sit between the
positive and the negative ones. Among N users a positive neighbour's rank is
its place from the top; a negative one's is N minus its place from the bottom,
so the zeros need no count. Zero-similarity neighbours add nothing to any
weighted sum, so they are never materialised. Ties: larger rounded similarity
first, then smaller ``other_id``.

``cosine_neighbours`` finds them without ranking the whole pair table: see there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from nearrate.functions import positive_sim, round_sim
from nearrate.keep import keep
from nearrate.operators import features as fx
from nearrate.operators import similarity as sm
from nearrate.operators.products import BLOCK_ROWS, NEAR_OF_MET, blocked_join, near_pairs, own_exchange, pair_sums

#: An item with more raters is frequent; the thresholds come from items with few.
FREQUENT_RATERS = BLOCK_ROWS
PROBE_RATERS = 32
#: Room for the rounding of sums of products of unit vectors.
SLACK = 1e-9


def _ordered():
    return Window.partitionBy("user_id").orderBy(F.desc("sim"), F.asc("other_id"))


def _positive(sim: DataFrame, k: int) -> DataFrame:
    """The k largest positive ones of each user: limited before the shuffle."""
    return _best(sim.where(F.col("sim") > 0), k)


def _best(sim: DataFrame, k: int) -> DataFrame:
    return (sim.withColumn("rn", F.row_number().over(_ordered())).where(F.col("rn") <= k)
            .select("user_id", "other_id", "sim", F.col("rn").cast("int").alias("rank")))


def _negative(sim: DataFrame, k: int, n_users) -> DataFrame:
    """The negative ones that rank within k, from the bottom."""
    last = Window.partitionBy("user_id").orderBy(F.asc("sim"), F.desc("other_id"))
    rank = (F.lit(n_users) if isinstance(n_users, int) else n_users) - F.row_number().over(last)
    return (sim.where(F.col("sim") < 0).withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
            .select("user_id", "other_id", "sim", "rank"))


def top_k(sim: DataFrame, k: int, n_users) -> DataFrame:
    """K1/K2/K3/K4 of a given similarity table: (user_id, other_id, sim, rank)
    with rank <= k. ``n_users``: number of distinct users in train (a number or a
    Column, such as a scalar subquery)."""
    sim = keep(sim)  # read from both ends
    return _positive(sim, k).unionByName(_negative(sim, k, n_users))


def top_k_positive(sim: DataFrame, k: int) -> DataFrame:
    """Top k among positive similarities only (approximate neighbours, X5)."""
    return _positive(sim, k)


def _sizes(train: DataFrame) -> tuple[int, int, int, int]:
    """Users, most items of a user, most raters of an item, products of raters (one row each)."""
    users = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.max("n")).first()
    n = F.col("n")
    items = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max(n), F.sum(n * (n - 1))).first()
    return users[0], users[1] or 0, items[0] or 0, items[1] or 0


def reaching_below_zero(train: DataFrame, k: int, n_users: int) -> DataFrame:
    """(user_id): the users who rate together with so many others, by the raters of
    their items, that a negative one could rank within k: only if fewer than k
    are not negative. All others need no negative similarity."""
    raters = train.groupBy("item_id").agg((F.count(F.lit(1)) - 1).alias("others"))
    met = train.join(own_exchange(raters, "item_id"), "item_id").groupBy("user_id").agg(F.sum("others").alias("met"))
    return met.where(F.col("met") > n_users - 1 - k).select("user_id")


def _cut(rui: DataFrame, raters: DataFrame, whole: DataFrame | None, k: int, frequent: int, probe: int):
    """Rows of ``rui`` that are not needed to find a user's candidates, and each
    such user's threshold ``least``.

    Threshold: the k-th best exact cosine among 2k candidates met on items of at
    most ``probe`` raters. With the user's frequent items in order of frequency,
    the norm of the first ones is a bound on what all of them can add for
    anyone; as long as it is under the threshold they are cut: a user met on
    them alone cannot be among the k nearest."""
    mine = rui.join(raters.where(F.col("raters") > frequent), "item_id")
    users = mine.select("user_id").distinct()
    users = keep(users.join(whole, "user_id", "left_anti") if whole is not None else users)
    few = keep(rui.join(raters.where(F.col("raters") <= probe).select("item_id"), "item_id", "left_semi"))
    theirs = few.select("item_id", F.col("user_id").alias("other_id"), F.col("rui").alias("rui_o"))
    part = (few.join(users, "user_id", "left_semi").join(theirs, "item_id").where(F.col("user_id") != F.col("other_id"))
            .groupBy("user_id", "other_id").agg(F.sum(F.col("rui") * F.col("rui_o")).alias("sim")))
    tried = keep(_positive(part, 2 * k).select("user_id", "other_id"))
    exact = sm.attach(tried, sm.asked_sums(rui, tried))
    least = exact.withColumn("n", F.row_number().over(_ordered())).where((F.col("n") == k) & (F.col("sim") > 0)).select("user_id", F.col("sim").alias("least"))
    down = Window.partitionBy("user_id").orderBy(F.desc("raters"), "item_id")
    norm = F.sqrt(F.sum(F.col("rui") * F.col("rui")).over(down))
    return keep(mine.join(own_exchange(least, "user_id"), "user_id").withColumn("norm", norm)
                .where(F.col("norm") < F.col("least") - SLACK).select("user_id", "item_id", "rui", "norm", "least"))


def cosine_neighbours(train: DataFrame, k: int, lo: float = 1.0, hi: float = 5.0,
                      frequent: int = FREQUENT_RATERS, probe: int = PROBE_RATERS,
                      dev: DataFrame | None = None) -> DataFrame:
    """K1-K4 for the adjusted cosine, without a stored or ranked pair table.

    One product of pairs. Where items have more than ``frequent`` raters, their
    rows are cut for the users who provably find their k nearest without them
    (``_cut``), and two cut rows never meet; such an item then costs raters times
    the users who do need it, not raters squared. What the product leaves out of
    a pair is bounded by the norms of the cut rows of both: a direction whose
    sum plus bound is under the user's threshold goes, before any shuffle by
    user, and only the survivors get the cut part added. Ranks below zero are
    looked for only where counts of raters allow them (``reaching_below_zero``)."""
    n_users, most_items, most_raters, products = _sizes(train)
    rui = sm.unit_vectors(train, lo, hi) if dev is None else keep(fx.preprocessed(dev))
    whole = None
    if most_items * max(most_raters - 1, 0) > n_users - 1 - k:
        whole = keep(reaching_below_zero(train, k, n_users))
        whole = None if whole.isEmpty() else whole
    if most_raters <= frequent:  # no item is frequent: nothing to cut
        if whole is None and k * NEAR_OF_MET * n_users <= products:  # few of those met: bounds first
            dots = near_pairs(rui, "user_id", "item_id", "rui", k)
        else:
            dots = pair_sums(rui, "user_id", "item_id", "rui", both=True)  # ranked where they are summed
        if whole is None:
            dots = dots.where(positive_sim("rui"))
        sim = dots.select("user_id", "other_id", round_sim("rui").alias("sim"))
    else:
        raters = keep(train.groupBy("item_id").agg(F.count(F.lit(1)).alias("raters")))
        sim = _survivors(rui, _cut(rui, raters, whole, k, frequent, probe), 0.0 if whole is None else -2.0)
    if whole is None:
        return _best(sim, k) if most_raters <= frequent else _positive(sim, k)
    sim = keep(sim)
    return _positive(sim, k).unionByName(_negative(sim.join(whole, "user_id", "left_semi"), k, n_users))


def _survivors(rui: DataFrame, cut: DataFrame, least: float) -> DataFrame:
    """(user_id, other_id, sim): the exact cosines of all directions whose bound
    reaches the user's threshold; ``least`` is that of users without cut rows."""
    about = cut.groupBy("user_id").agg(F.struct(F.max("norm").alias("norm"), F.first("least").alias("least")).alias("about"))
    rows = (rui.join(cut.select("user_id", "item_id", F.lit(True).alias("cut")), ["user_id", "item_id"], "left")
            .join(own_exchange(about, "user_id"), "user_id", "left")
            .withColumn("about", F.coalesce("about", F.struct(F.lit(0.0).alias("norm"), F.lit(least).alias("least"))))
            .withColumn("cut", F.coalesce("cut", F.lit(False))))
    dots = pair_sums(rows, "user_id", "item_id", "rui", carry="about", apart="cut")
    rest = (F.col("about_u.norm") * F.col("about_v.norm")).alias("rest")
    ways = F.explode(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v"), F.col(f"{a}.least").alias("least"))
                               for u, v, a in (("user_id", "other_id", "about_u"), ("other_id", "user_id", "about_v"))])).alias("p")
    both = dots.select(ways, "rui", rest).select(F.col("p.u").alias("user_id"), F.col("p.v").alias("other_id"), "p.least", "rui", "rest")
    open_ = keep(both.where(F.col("rui") + F.col("rest") >= F.col("least") - SLACK).drop("least"))
    left = cut.select("user_id", "item_id", F.col("rui").alias("x"))
    right = cut.select(F.col("user_id").alias("other_id"), "item_id", F.col("rui").alias("y"))
    more = (blocked_join(open_.where(F.col("rest") > 0).select("user_id", "other_id"), left, "user_id", "item_id").join(right, ["other_id", "item_id"])
            .groupBy("user_id", "other_id").agg(F.sum(F.col("x") * F.col("y")).alias("more")))
    whole = F.col("rui") + F.coalesce(F.col("more"), F.lit(0.0))
    return (open_.join(more, ["user_id", "other_id"], "left").select("user_id", "other_id", round_sim(whole).alias("sim"))
            .where(F.col("sim") != 0))


def target_neighbours(train: DataFrame, targets: DataFrame, k: int, lo: float = 1.0,
                      hi: float = 5.0, rui: DataFrame | None = None) -> DataFrame:
    """K1 of the target users only: the cosine row of a target is the product of
    its unit vector with everyone's."""
    rui = rui if rui is not None else sm.unit_vectors(train, lo, hi)
    mine = rui.join(targets.select("user_id").distinct(), "user_id")
    others = rui.select("item_id", F.col("user_id").alias("other_id"), F.col("rui").alias("rui_o"))
    dots = (blocked_join(mine, others, "item_id", "other_id").groupBy("user_id", "other_id")
            .agg(F.sum(F.col("rui") * F.col("rui_o")).alias("dot")))
    sim = (dots.where(F.col("user_id") != F.col("other_id"))
           .select("user_id", "other_id", round_sim("dot").alias("sim"))
           .where(F.col("sim") != 0))
    return top_k(sim, k, train.agg(F.countDistinct("user_id")).scalar())


def knn_similarity(neighbours: DataFrame, pairs: DataFrame) -> DataFrame:
    """K5 from a neighbour table: similarity of (user_id, other_id) if other is
    among the user's k nearest, else 0."""
    return (pairs.join(neighbours.select("user_id", "other_id", "sim"),
                       ["user_id", "other_id"], "left")
            .withColumn("sim", F.coalesce(F.col("sim"), F.lit(0.0))))


def knn_similarity_of(train: DataFrame, pairs: DataFrame, k: int, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """K5 driven by the requests: their own cosines first; neighbours are found
    only for users with a requested pair whose cosine is not 0."""
    rui = sm.unit_vectors(train, lo, hi)
    known = sm.attach(pairs.select("user_id", "other_id").distinct(), sm.asked_sums(rui, pairs))
    return knn_similarity(target_neighbours(train, known, k, lo, hi, rui), pairs)
