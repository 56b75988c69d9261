"""SQL text for the oracle side. Written independently of the DataFrame code,
from the formulas, so that a mistake in one is not copied into the other."""

from __future__ import annotations

RATINGS_CTE = """
ratings AS (
  SELECT user_id, item_id, rating FROM (
    SELECT o_custkey AS user_id, l_partkey AS item_id,
           CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating,
           row_number() OVER (PARTITION BY o_custkey, l_partkey
             ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
  WHERE rn = 1),
train AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 5 <> 0),
test  AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 5 = 0)"""


def scale(x: str, a: str) -> str:
    return f"(CASE WHEN ({x}) > ({a}) THEN 5 - ({a}) WHEN ({x}) < ({a}) THEN ({a}) - 1 ELSE 1 END)"


def combine(a: str, d: str) -> str:
    return f"(({a}) + ({d}) * {scale(f'({a}) + ({d})', a)})"


MEANS_CTE = f"""
g AS (SELECT avg(rating) AS g FROM train),
um AS (SELECT user_id, avg(rating) AS um FROM train GROUP BY user_id),
im AS (SELECT item_id, avg(rating) AS im FROM train GROUP BY item_id),
dev AS (SELECT t.user_id, t.item_id, t.rating, um.um,
               (t.rating - um.um) / {scale('t.rating', 'um.um')} AS dev
        FROM train t JOIN um ON t.user_id = um.user_id),
idev AS (SELECT item_id, avg(dev) AS item_dev FROM dev GROUP BY item_id),
norms AS (SELECT user_id, sqrt(sum(dev * dev)) AS norm FROM dev GROUP BY user_id),
rui AS (SELECT d.user_id, d.item_id, d.dev / n.norm AS rui
        FROM dev d JOIN norms n ON d.user_id = n.user_id WHERE n.norm > 0)"""

# Unordered co-rated pairs and their cosine, rounded, zeros dropped; then both
# directions.
COSINE_CTE = """
cos_half AS (SELECT a.user_id AS u, b.user_id AS v, round(sum(a.rui * b.rui), 12) AS sim
             FROM rui a JOIN rui b ON a.item_id = b.item_id AND a.user_id < b.user_id
             GROUP BY a.user_id, b.user_id),
cos AS (SELECT u AS user_id, v AS other_id, sim FROM cos_half WHERE sim <> 0
        UNION ALL SELECT v, u, sim FROM cos_half WHERE sim <> 0)"""

JACCARD_CTE = """
ucnt AS (SELECT user_id, count(*) AS n FROM train GROUP BY user_id),
inter AS (SELECT a.user_id AS u, b.user_id AS v, count(*) AS c
          FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id < b.user_id
          GROUP BY a.user_id, b.user_id),
jac_half AS (SELECT i.u, i.v, round(CAST(i.c AS DOUBLE) / (x.n + y.n - i.c), 12) AS sim
             FROM inter i JOIN ucnt x ON i.u = x.user_id JOIN ucnt y ON i.v = y.user_id),
jac AS (SELECT u AS user_id, v AS other_id, sim FROM jac_half WHERE sim <> 0
        UNION ALL SELECT v, u, sim FROM jac_half WHERE sim <> 0)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in (RATINGS_CTE,) + ctes) + "\n"

NEIGHBOURS_CTE = """
nusers AS (SELECT count(DISTINCT user_id) AS n FROM train),
ranked AS (SELECT user_id, other_id, sim,
                  row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, other_id) AS rn,
                  count(*) OVER (PARTITION BY user_id) AS stored
           FROM cos),
nb AS (SELECT user_id, other_id, sim,
              CASE WHEN sim > 0 THEN rn ELSE rn + (nusers.n - 1 - stored) END AS rank
       FROM ranked CROSS JOIN nusers)"""


def weighted(sim_table: str, pairs: str = "test", extra_on: str = "") -> str:
    """Σ w·dev and Σ|w| over users with a weight who rated the item."""
    return f"""
wsum AS (SELECT p.user_id, p.item_id, sum(w.sim * d.dev) AS num, sum(abs(w.sim)) AS den
         FROM {pairs} p JOIN {sim_table} w ON w.user_id = p.user_id {extra_on}
         JOIN dev d ON d.user_id = w.other_id AND d.item_id = p.item_id
         GROUP BY p.user_id, p.item_id)"""


def buckets_cte(p: int, r: int, seed: int) -> str:
    return f"""
ub AS (SELECT user_id, CAST(bucket AS BIGINT) AS bucket FROM (
         SELECT u.user_id, b.bucket,
                row_number() OVER (PARTITION BY u.user_id ORDER BY
                  md5(concat_ws(':', '{seed}', CAST(u.user_id AS VARCHAR), CAST(b.bucket AS VARCHAR))),
                  b.bucket) AS r
         FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN range(0, {p}) b(bucket)) t
       WHERE r <= {r}),
shared AS (SELECT DISTINCT a.user_id AS u, b.user_id AS v FROM ub a JOIN ub b
           ON a.bucket = b.bucket AND a.user_id <> b.user_id),
apos AS (SELECT c.user_id, c.other_id, c.sim FROM cos c JOIN shared s
         ON c.user_id = s.u AND c.other_id = s.v WHERE c.sim > 0),
anb AS (SELECT user_id, other_id, sim,
               row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, other_id) AS rank
        FROM apos)"""
