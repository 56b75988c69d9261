"""Ratings kept as tables for single-key questions (A4, A5).

A table bucketed and sorted by a key answers for one key from one bucket: the
scan prunes the others' files, and row groups within by their bounds."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from nearrate.session import checkpoint_dir

BUCKETS = 32


@dataclass
class StoredRatings:
    spark: SparkSession
    name: str
    key: str

    def rows(self, value: int) -> DataFrame:
        """The ratings of one key."""
        return self.spark.table(self.name).where(F.col(self.key) == value)

    def mean(self, value: int) -> DataFrame:
        """One row: the key and its mean rating, NULL without ratings."""
        name = self.key.removesuffix("_id") + "_mean"
        one = self.rows(value).groupBy(self.key).agg(F.avg("rating").alias("m"))  # by its key: a scan of its bucket
        return one.agg(F.lit(value).cast("bigint").alias(self.key), F.max("m").alias(name))

    def drop(self) -> None:
        """Forget the table; its files stay in the shared folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def store_ratings(ratings: DataFrame, key: str = "user_id", buckets: int = BUCKETS, name: str | None = None) -> StoredRatings:
    """Write ratings as a table bucketed by ``key``, in the shared folder. They are
    dealt by the same hash first, so each bucket is one file."""
    spark = ratings.sparkSession
    name = name or f"ratings_by_{key}_{uuid.uuid4().hex[:12]}"
    (ratings.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return StoredRatings(spark, name, key)
