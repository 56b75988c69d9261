"""Set operations on users' item sets (R5): the sets themselves, in pieces.

A user's set is cut into pieces of the same ranges of item ids for everybody, so
a piece holds at most ``PIECE_ITEMS`` items however large the set is, and the
pieces of two users that cover the same range meet alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nearrate.keep import keep

PIECE_ITEMS = 1024


def set_pieces(ratings: DataFrame, width: int = PIECE_ITEMS) -> DataFrame:
    """(user_id, piece, items): the distinct items of a user with ids from
    ``piece * width`` on, ascending, less than ``width`` ids apart."""
    piece = F.floor(F.col("item_id") / width).cast("long").alias("piece")
    return (ratings.select("user_id", piece, "item_id").distinct()
            .groupBy("user_id", "piece").agg(F.sort_array(F.collect_list("item_id")).alias("items")))


def set_operations(ratings: DataFrame, pairs: DataFrame, width: int = PIECE_ITEMS) -> DataFrame:
    """(user_id, other_id, piece, both, either): intersection and union of the two
    users' item sets, piece by piece, for each distinct requested pair. A piece in
    which neither has an item gives no row; an unknown user's set is empty."""
    pieces, asked = keep(set_pieces(ratings, width)), pairs.select("user_id", "other_id").distinct()
    mine = asked.join(pieces.withColumnRenamed("items", "mine"), "user_id")
    theirs = asked.join(pieces.select(F.col("user_id").alias("other_id"), "piece", F.col("items").alias("theirs")), "other_id")
    none = F.array().cast("array<bigint>")
    a, b = (F.coalesce(F.col(c), none) for c in ("mine", "theirs"))
    return (mine.join(theirs, ["user_id", "other_id", "piece"], "full")
            .select("user_id", "other_id", "piece", F.array_intersect(a, b).alias("both"), F.array_sort(F.array_union(a, b)).alias("either")))
