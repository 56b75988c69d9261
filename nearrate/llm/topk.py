"""Exact top-k search by integer inner product (operator 2).

Vectors are quantised, floor(scale * x). Queries and candidates are dealt into
blocks by row hash and a cell (query block, candidate block) is one task group;
both sides of a cell have a bounded number of rows. Within a cell the
candidates are pruned from coarse to fine: a vector cut into segments has a
mean m and a deviation d (norm of the centred segment) per segment, and

    q . c  <=  sum over segments of  len * m_q * m_c + d_q * d_c

which is the segment lower bound on the distance, written for the inner
product. Levels halve the segments; pairs whose bound is under the query's
k-th best exact score so far are dropped, and survivors get exact integer
scores. Each cell returns at most k rows per query; a window keeps the best.

Defined cases: a null vector, or one with null or non-finite components, and a
row with a null id take no part; vectors of unequal length compare as if padded
with zeros; repeated ids are separate rows (a query skips only itself); fewer
than k candidates give fewer rows; equal scores go to the smaller id. Finite
components so large that an inner product could leave 64 bits (in size, the
number of components times the square of the largest one reaches 2^63) fail
with an error, as they do in SQL.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from nearrate.llm.common import saved

QUERY_ROWS, CANDIDATE_ROWS = 2048, 16384
LEVELS = (1, 4, 16)
RESULT = "query_id long, q_row int, vec_id long, c_row int, score long"


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, row, v): ``row`` numbers repeated ids, v is array<long>."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine
    largest = F.array_max(F.transform("embedding", lambda x: F.abs(F.floor(x.cast("double") * scale).cast("double"))))
    wide = F.size("embedding") * largest * largest >= F.lit(2.0**63)
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    v = F.when(wide, F.raise_error(F.lit("components too large for integer scores of 64 bits")).cast("array<bigint>")).otherwise(v)
    number = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.xxhash64("v")))
    return vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).withColumn("row", number)


def segment_stats(m: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(length) times the mean, and the centred norm, of each segment."""
    cuts = np.linspace(0, m.shape[1], min(segments, m.shape[1]) + 1).astype(int)
    means, devs = [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = m[:, a:b]
        mean = part.mean(1)
        means.append(mean * np.sqrt(b - a))
        devs.append(np.sqrt(np.maximum(((part - mean[:, None]) ** 2).sum(1), 0)))
    return np.stack(means, 1), np.stack(devs, 1)


def best_in_cell(q: np.ndarray, c: np.ndarray, same, k: int, step: int = 2048):
    """Indexes (query, candidate) and exact scores of the k best of each query.
    ``c`` must be in id order; ``same`` lists (query, candidate) pairs to skip."""
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    stats = [(*segment_stats(qf, s), *segment_stats(cf, s)) for s in LEVELS]
    q_norm, c_norm = np.sqrt((qf**2).sum(1)), np.sqrt((cf**2).sum(1))
    own = {}
    for i, j in same:
        own.setdefault(i, set()).add(j)
    floor = np.full(len(q), -np.inf)
    top_s, top_c = np.full((len(q), k), np.iinfo(np.int64).min), np.full((len(q), k), -1, np.int64)
    for lo in range(0, len(c), step):
        hi = min(lo + step, len(c))
        skip = np.zeros((len(q), hi - lo), bool)
        for i, js in own.items():
            for j in js:
                if lo <= j < hi:
                    skip[i, j - lo] = True
        alive = ~skip
        for qm, qd, cm, cd in stats:
            rows = np.flatnonzero(alive.any(1))
            if not len(rows):
                break
            bound = qm[rows] @ cm[lo:hi].T + qd[rows] @ cd[lo:hi].T
            bound += 1e-9 * np.outer(q_norm[rows], c_norm[lo:hi]) + 1e-6  # rounding, also where terms cancel
            alive[rows] &= bound >= floor[rows, None]
            if np.isinf(floor[rows]).any() and len(rows):
                # no threshold yet: score the k candidates with the best bounds
                for i, b in zip(rows, bound, strict=True):
                    if np.isinf(floor[i]):
                        pick = np.argpartition(np.where(skip[i], -np.inf, b), max(len(b) - k, 0))[-k:]
                        pick = pick[~skip[i][pick]]
                        if len(pick) == k:
                            floor[i] = (c[lo + pick] * q[i]).sum(1).min()
                alive[rows] &= bound >= floor[rows, None]
        qi, ci = np.nonzero(alive)
        scores = np.empty(len(qi), np.int64)
        for a in range(0, len(qi), 1 << 16):
            b = slice(a, a + (1 << 16))
            scores[b] = (q[qi[b]] * c[lo + ci[b]]).sum(1)
        begin = np.searchsorted(qi, np.arange(len(q) + 1))
        for i in np.flatnonzero(np.diff(begin)):
            part = slice(begin[i], begin[i + 1])
            s = np.concatenate((top_s[i][top_c[i] >= 0], scores[part]))
            j = np.concatenate((top_c[i][top_c[i] >= 0], ci[part] + lo))
            keep = np.lexsort((j, -s))[:k]
            top_s[i, : len(keep)], top_c[i, : len(keep)] = s[keep], j[keep]
            if len(keep) == k:
                floor[i] = max(floor[i], s[keep[-1]])
    qi, place = np.nonzero(top_c >= 0)
    return qi, top_c[qi, place], top_s[qi, place]


def _matrix(values, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Both sides (vec_id, row, v) -> query_id, q_row, rank, vec_id, score."""
    n_q, n_c = queries.count(), candidates.count()
    q_blocks, c_blocks = -(-n_q // QUERY_ROWS) or 1, -(-n_c // CANDIDATE_ROWS) or 1

    def block(n):
        return F.pmod(F.xxhash64("vec_id", "row"), F.lit(n)).cast("int")

    def spread(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("qb", block(q_blocks)).withColumn("cb", spread(c_blocks))
    right = candidates.withColumn("cb", block(c_blocks)).withColumn("qb", spread(q_blocks))

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in ("query_id", "q_row", "vec_id", "c_row", "score")})
        c = c.sort_values(["vec_id", "row"], ignore_index=True)
        width = max(q["v"].map(len).max(), c["v"].map(len).max(), 1)
        where = {key: j for j, key in enumerate(zip(c["vec_id"], c["row"], strict=True))}
        same = [(i, where[key]) for i, key in enumerate(zip(q["vec_id"], q["row"], strict=True)) if key in where]
        qi, ci, s = best_in_cell(_matrix(q["v"], width), _matrix(c["v"], width), same, k)
        return pd.DataFrame({"query_id": q["vec_id"].to_numpy()[qi], "q_row": q["row"].to_numpy()[qi],
                             "vec_id": c["vec_id"].to_numpy()[ci], "c_row": c["row"].to_numpy()[ci], "score": s})

    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(cell, RESULT)
    best = Window.partitionBy("query_id", "q_row").orderBy(F.desc("score"), "vec_id", "c_row")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "q_row", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def search(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by ``every``."""
    v = saved(quantised(vectors, scale), "vectors")
    return top_k(v.where(F.col("vec_id") % every == 0), v, k).drop("q_row")
