"""Rating sources (S1-S6) and the rating contract: (user_id, item_id, rating).

Contract: ``user_id`` and ``item_id`` are BIGINT, ``rating`` is DOUBLE, no
nulls, and (user_id, item_id) is unique (``dedupe`` enforces it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RATING_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("item_id", T.LongType(), False),
    T.StructField("rating", T.DoubleType(), False),
])


def parse_ratings(lines: DataFrame, sep: str = "\t", dedupe_pairs: bool = False) -> DataFrame:
    """Ratings from lines of text, the column ``value``.

    ``sep`` is a regular expression, as the field splitter of the original
    programs. Fields are trimmed; lines whose first field is not an integer
    (headers, blank lines) are skipped; fields after the third are ignored.
    A first field that is an integer too large for BIGINT, and a bad item or
    rating field, fail the job (ANSI cast); they are not skipped. With
    ``dedupe_pairs`` a repeated (user, item) keeps one row (``dedupe``).
    """
    parts = F.split(F.col("value"), sep)
    field = lambda i: F.trim(F.get(parts, F.lit(i)))
    kept = lines.where(field(0).rlike("^[+-]?[0-9]+$"))
    out = kept.select(field(0).cast("bigint").alias("user_id"), field(1).cast("bigint").alias("item_id"),
                      field(2).cast("double").alias("rating"))
    return dedupe(out) if dedupe_pairs else out


def load_ratings(spark: SparkSession, path: str, sep: str = "\t",
                 dedupe_pairs: bool = False) -> DataFrame:
    """Delimited ratings file, see ``parse_ratings``."""
    return parse_ratings(spark.read.text(path), sep, dedupe_pairs)


_PERSONAL_SCHEMA = "item_id string, name string, rating string"


def _personal_fields(df: DataFrame) -> DataFrame:
    """Every field is trimmed before it is cast; an empty rating is missing."""
    rating = F.nullif(F.trim("rating"), F.lit("")).cast("double")
    return df.select(F.trim("item_id").cast("bigint").alias("item_id"), F.trim("name").alias("name"), rating.alias("rating"))


def _personal_csv(spark: SparkSession, path: str) -> DataFrame:
    return _personal_fields(spark.read.option("header", True).option("mode", "PERMISSIVE")
                            .schema(_PERSONAL_SCHEMA).csv(path))


def parse_personal(lines: DataFrame) -> DataFrame:
    """(item_id, name, rating) from lines ``id,name[,rating]``, the column
    ``value``; the header line is the one that starts with ``id``."""
    row = F.from_csv("value", _PERSONAL_SCHEMA)
    return _personal_fields(lines.where(~F.trim("value").startswith("id") & (F.trim("value") != "")).select(row.alias("r")).select("r.*"))


def personal_ratings(fields: DataFrame, user_id: int = 944) -> DataFrame:
    """A missing rating reads as 0 and zero ratings are dropped; every row
    belongs to ``user_id``."""
    return (fields.select(F.lit(user_id).cast("bigint").alias("user_id"), "item_id",
                          F.coalesce(F.col("rating"), F.lit(0.0)).alias("rating"))
            .where(F.col("rating") != 0.0))


def load_personal(spark: SparkSession, path: str, user_id: int = 944) -> DataFrame:
    """Personal ratings CSV ``id,name[,rating]``."""
    return personal_ratings(_personal_csv(spark, path), user_id)


def load_item_names(spark: SparkSession, path: str) -> DataFrame:
    """Item names from the same CSV (S6): (item_id, name)."""
    return _personal_csv(spark, path).select("item_id", "name")


def ratings_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings derived from the order tables: a customer rates a part by the
    quantity of the latest line that bought it, bucketed into 1..5.

    "Latest" is the greatest (o_orderdate, l_orderkey, l_linenumber,
    l_quantity). It is found with a ``max(struct)`` aggregate rather than a
    window, so Spark combines map-side and a hot (customer, part) group never
    lands whole in one task.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    latest = (joined
              .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
              .agg(F.max(F.struct("o_orderdate", "l_orderkey", "l_linenumber", "l_quantity"))
                   .alias("last")))
    return latest.select(
        "user_id", "item_id",
        (F.lit(1) + F.floor((F.col("last.l_quantity") - 1) / 10)).cast("double").alias("rating"))


def split_train_test(ratings: DataFrame, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Deterministic hash split: test = (31*user + 17*item) mod folds == 0."""
    key = (F.col("user_id") * 31 + F.col("item_id") * 17) % folds
    return ratings.where(key != 0), ratings.where(key == 0)


def dedupe(ratings: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One row per (user_id, item_id): the row with the greatest ``order_by``
    (default: the rating itself). An aggregate, so it combines map-side."""
    order_by = order_by or ["rating"]
    keys = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)]
    best = F.max(F.struct(*keys, F.col("rating").alias("value"))).alias("best")
    return (ratings.groupBy("user_id", "item_id").agg(best)
            .select("user_id", "item_id", F.col("best.value").alias("rating")))


def new_user_ratings(spark: SparkSession, user_id: int,
                     rated: list[tuple[int, float]]) -> DataFrame:
    """A new user's ratings as a DataFrame (input to R1)."""
    rows = [(int(user_id), int(i), float(r)) for i, r in rated]
    return spark.createDataFrame(rows, RATING_SCHEMA)
