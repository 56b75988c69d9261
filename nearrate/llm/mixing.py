"""Mixing sources to target weights (operator 1), DataFrame functions only.

Sources get targets by weight under a cap (water filling), and targets become
whole blocks of ``block`` words by Sainte-Lague apportionment: seat s of a
party with v votes has the quotient v / (2 s - 1), and the highest quotients
win. It is applied twice: blocks to sources, then each source's blocks to its
shards, so each shard has an integer quota. A shard is a set of documents
chosen by hash, laid end to end in seeded order and cut into blocks; a seeded
permutation of the block numbers says which blocks are taken, and how often.

No seat is ever a row except near the threshold: with S parties and N seats
the divisors V / (N - S/2) and V / (N + S/2) bracket the final one, so only
about 2 S seats are ranked, whatever N is.

Defined cases: null text has size 0; a null source is a source of its own, the
last; a null doc_id is hashed like any other value; an empty table gives no
rows; equal rows are separate documents; columns other than doc_id, text and
source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from nearrate.llm.common import SPACES, WORD, packed, saved, unpacked

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 20
#: Primes above 2^30, multipliers of the block permutations.
PRIMES = (1073741827, 1073741831, 1073741833, 1073741839, 1073741843)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) -> also (source_no, target): weights repeat over
    the sources in code point order, null last. ``share`` of all words is dealt
    by weight; a source stops at ``cap`` times its size, the excess is dealt
    again. The common level is the highest one met when the sources are filled
    in the order of cap / weight."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = (sources.withColumn("source_no", F.row_number().over(order).cast("int"))
         .withColumn("w", F.element_at(w, (F.col("source_no") - 1) % len(weights) + 1))
         .withColumn("most", F.col("source_size") * F.lit(float(cap))))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("w"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    gone = F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - full) / (F.sum("w").over(everything) - gone)
    return (s.withColumn("level", level)
            .withColumn("target", F.least("most", F.max("level").over(everything) * F.col("w")))
            .drop("w", "most", "level"))


def apportion(parties: DataFrame, group: list[str], key: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Lague: add ``quota``, the seats of each party out of its group's
    ``seats``. Equal quotients go to the smaller key."""
    of = Window.partitionBy(*group)
    n, v, total = F.col(seats).cast("double"), F.col(votes).cast("double"), F.col("v_all")
    some = (total > 0) & (n > 0)
    p = parties.withColumn("v_all", F.sum(votes).over(of).cast("double")).withColumn("parties", F.count(F.lit(1)).over(of))
    # one seat of slack on either side against rounding
    low = F.floor(v * F.greatest(n - F.col("parties") / 2, F.lit(0.0)) / total + 0.5) - 1
    high = F.floor(v * (n + F.col("parties") / 2) / total + 0.5) + 1
    p = (p.withColumn("low", F.when(some, F.greatest(low, F.lit(0))).otherwise(F.lit(0)).cast("long"))
         .withColumn("high", F.when(some & (v > 0), high).otherwise(F.lit(0)).cast("long"))
         .withColumn("open", F.col(seats) - F.sum("low").over(of)))
    ranked = (p.where(F.col("high") > F.col("low"))
              .select(*group, key, "open", "v_all", F.col(votes).alias("v"), F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("seat"))
              .withColumn("place", F.row_number().over(of.orderBy(F.desc(F.col("v") / (2 * F.col("seat") - 1)), key, "seat")))
              .where(F.col("place") <= F.col("open"))
              .groupBy(*group, key).agg(F.count(F.lit(1)).alias("won")))
    return (p.join(ranked, [*group, key], "left")
            .withColumn("quota", F.col("low") + F.coalesce(F.col("won"), F.lit(0)))
            .drop("v_all", "parties", "low", "high", "open", "won"))


def plan_mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0,
             block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, key (hash of the text), source, size, source_size,
    target, whole (times that the whole document is taken), first (its first
    word's place in the shard), picked (block numbers taken once more), taken.
    A block is taken at most ceil(cap) times."""
    limit = int(-(-cap // 1))
    sized = saved(docs.select("doc_id", "source", F.xxhash64("text").alias("key"), n_words(F.col("text")).alias("size")), "mix-sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")
    sources = (apportion(sources.withColumn("seats", blocks).withColumn("all", F.lit(0)), ["all"], "source_no", "target", "seats")
               .withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)))
               .select("source", "source_no", "source_size", "target", F.col("quota").alias("source_quota"), "shards"))
    sources = saved(sources, "mix-sources")
    placed = (sized.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
              .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "key"), F.col("shards"))))
    shards = (placed.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota")))
    shards = (apportion(shards, ["source_no"], "shard", "shard_size", "source_quota")
              .withColumn("n_blocks", F.ceil(F.col("shard_size") / block))
              .withColumn("quota", F.least(F.col("quota"), F.col("n_blocks") * limit))
              .select("source_no", "shard", "n_blocks", "quota"))
    line = (Window.partitionBy("source_no", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "key"), "doc_id", "key")
            .rowsBetween(Window.unboundedPreceding, -1))
    laid = (placed.withColumn("first", F.coalesce(F.sum("size").over(line), F.lit(0)).cast("long"))
            .join(saved(shards, "mix-shards"), ["source_no", "shard"]))
    h = F.xxhash64(F.lit(seed + 2), "source_no", "shard")
    prime = F.element_at(F.array(*[F.lit(p) for p in PRIMES]), (F.pmod(h, F.lit(len(PRIMES))) + 1).cast("int"))
    n, rest, at = F.col("n_blocks"), F.pmod(F.col("quota"), F.greatest(F.col("n_blocks"), F.lit(1))), F.col("first")
    chosen = F.filter(F.sequence(F.floor(at / block), F.floor((at + F.col("size") - 1) / block)),
                      lambda j: F.pmod(F.pmod(prime, n) * j + F.pmod(h, n), n) < rest)
    laid = (laid.withColumn("whole", F.when(n > 0, F.floor(F.col("quota") / n)).otherwise(F.lit(0)).cast("int"))
            .withColumn("picked", F.when(F.col("size") > 0, chosen).otherwise(F.array().cast("array<bigint>"))))
    part = F.aggregate("picked", F.lit(0).cast("long"), lambda acc, j: acc + F.least((j + 1) * block, at + F.col("size")) - F.greatest(j * block, at))
    return (laid.withColumn("taken", F.col("whole") * F.col("size") + part)
            .select("doc_id", "key", "source", "size", "source_size", "target", "taken", "whole", "first", "picked"))


def mix_texts(docs: DataFrame, block: int = BLOCK_WORDS, **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per copy taken of
    a document; a copy that lacks blocks holds the words of its own blocks. Rows
    with equal doc_id, text and source are all taken like the first of them in the
    shard."""
    plan = plan_mix(docs, block=block, **how)
    mine = (plan.where(F.col("size") > 0).groupBy(F.col("doc_id").alias("m_id"), F.col("key").alias("m_key"), F.col("source").alias("m_source"))
            .agg(F.min(F.struct("first", "whole", "picked", "size")).alias("m")))
    mine = mine.select("m_id", "m_key", "m_source", F.col("m.whole").alias("m_whole"), F.col("m.first").alias("m_first"),
                       F.col("m.picked").alias("m_picked"), F.col("m.size").alias("m_size"))
    pieces = F.regexp_extract_all("text", F.lit(f"{WORD}{SPACES}*"), F.lit(0))
    at, size = F.col("m_first"), F.col("m_size")
    # bound to a lambda's variable, the pieces are cut once for a document, not once for a block
    cut = F.transform(F.array(pieces), lambda p: F.array_join(F.flatten(F.transform("m_picked", lambda j: F.slice(
        p, (F.greatest(j * block, at) - at + 1).cast("int"),
        (F.least((j + 1) * block, at + size) - F.greatest(j * block, at)).cast("int")))), ""))
    part = F.when(F.size("m_picked") > 0, cut).otherwise(F.array().cast("array<string>"))
    copies = F.concat(F.array_repeat(F.col("text"), F.col("m_whole")), part)
    joined = packed(docs, "doc_id", "text", "source", F.xxhash64("text").alias("m_hash")).join(
        mine, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("m_hash") == F.col("m_key")) & F.col("source").eqNullSafe(F.col("m_source")))
    out = joined.select("row_", F.explode(copies).alias("t_")).withColumn("row_", F.col("row_").withField("text", F.col("t_")))
    if "n_chars" in docs.columns:
        out = out.withColumn("row_", F.col("row_").withField("n_chars", F.length("t_").cast(docs.schema["n_chars"].dataType)))
    return unpacked(out)


def mixed(docs: DataFrame) -> DataFrame:
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))
