"""Shared helpers of the training-data operators: word columns, row keys and
intermediate tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Characters between words, and the two kinds of words (Java regular expressions).
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A derived side is broadcast only if it was written and counted and has no more rows.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. A
    local master without that setting gets a temporary one; a cluster must
    name it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="nearrate-llm-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once,
    lineage cut, and its size known to the planner."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` (a written table) marked for broadcast if its counted rows allow
    it; beyond that the planner's shuffled join is used."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column, pattern: str) -> Column:
    """All words of a text, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def remainder(doc_id: Column, m: int) -> Column:
    """crc32(doc_id as text) mod m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m


def packed(docs: DataFrame, *columns) -> DataFrame:
    """Each row whole in ``row_``, beside the given columns: helper columns can
    then clash with none of the caller's. ``unpacked`` brings the rows back."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row_"), *columns)


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row_.*")


def byte_list(column) -> list:
    """An Arrow string column as a list of bytes (None for null)."""
    import pyarrow as pa
    return column.cast(pa.large_binary()).to_pylist()


def own_exchange(df: DataFrame, column: str) -> DataFrame:
    """``df``, aggregated by a long column, laid out anew for a join on it: with
    an exchange of its own on both sides, adaptive execution can split a hot key."""
    return df.withColumn(column, F.col(column).bitwiseXOR(F.lit(0).cast("long")))
