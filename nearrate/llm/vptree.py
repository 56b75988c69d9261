"""Approximate nearest neighbours by cosine (operator 11): vantage-point trees.

Vectors are compared by the Euclidean distance of their unit vectors, a metric
that falls as the cosine rises. A coarse tree, fitted on a bounded sample
(SAMPLE_BYTES), deals all vectors by their distances to its vantage points to
cells; the rows of a cell are split by hash into shards of bounded size, and
each shard is a vantage-point tree of its own: a point, the median of the
distances to it, and the rows inside and outside that radius, down to leaves.

By the triangle inequality nothing beyond a radius is nearer to a query than
the difference of its distance and the radius. A branch is left out when

    factor * lower bound  >  distance of the query's worst kept neighbour,

so a factor of one is exact, and a larger one prunes more and may miss some.
The same rule leaves out whole cells: a query is answered first in its own
cell, and with the distance found there it visits only the cells that the rule
keeps. The tests measure the recall against brute force.

Equal vectors are one point with its smallest ids (keep + 1 of them: the best
``keep`` rows, and the query's own), so a crowd of copies costs one row a
shard; equal queries are searched once. Scores are cosines in double precision
of the original vectors, scaled by powers of two against overflow.

Defined cases: a null or zero vector, one with null or non-finite components,
and a row with a null id take no part; vectors of unequal length compare as if
padded with zeros; repeated ids are separate rows (a query skips only itself);
fewer than k candidates give fewer rows; equal scores go to the smaller id;
empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from nearrate.llm.common import saved

#: Bounds: of the sample, of a shard's vectors, of a block of queries.
SAMPLE_BYTES, SHARD_BYTES, BLOCK_BYTES = 4 << 20, 4 << 20, 1 << 20
CELLS, LEAF = 64, 48
STEP, PAIRS = 512, 1 << 18
#: Pruning factor of the query: see the README for the recall measured.
FACTOR = 1.25
SALT_ROWS = 4096
SLACK = 1e-6
FOUND = "point long, vec_id long, rid long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(rid, vec_id, v): the rows that take part, v as doubles, rid a row number."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine & F.exists("embedding", lambda x: x != 0))
    v = F.transform("embedding", lambda x: x.cast("double"))
    return vectors.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(ok).select("rid", "vec_id", v.alias("v"))


def scaled(rows: list, width: int) -> np.ndarray:
    """Vectors as a matrix, each times a power of two that brings its largest
    component to [0.5, 1); cut or padded with zeros to ``width``."""
    if rows and len(set(map(len, rows))) == 1:
        m = np.array(rows, np.float64)
        m = np.ldexp(m, -np.frexp(np.abs(m).max(1))[1][:, None])[:, :width]
        return np.ascontiguousarray(np.pad(m, ((0, 0), (0, width - m.shape[1]))))
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i] = scaled([r], width)[0]
    return out


def norms(rows: list) -> np.ndarray:
    """Norms of the scaled vectors, whole."""
    if len(set(map(len, rows))) == 1:
        s = scaled(rows, len(rows[0]))
        return np.sqrt((s * s).sum(1))
    return np.array([norms([r])[0] for r in rows])


def units(rows: list, width: int | None = None) -> np.ndarray:
    width = max(map(len, rows), default=1) if width is None else width
    return scaled(rows, width) / norms(rows)[:, None]


def distances(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of rows that may be cut (a cut query is nearer to no point)."""
    n = min(q.shape[1], c.shape[1])
    return np.sqrt(np.maximum(2 - 2 * (q[:, :n] @ c[:, :n].T), 0))


class Tree:
    """Nodes in arrays: vantage row, radius, and the rows of a leaf. Rows are kept
    in the order of the leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 11):
        self.points, self.rng = points, np.random.default_rng(seed)
        self.vantage, self.radius, self.inner, self.outer, self.first, self.last = [], [], [], [], [], []
        self.order: list[np.ndarray] = []
        self.held = 0
        self.build(np.arange(len(points)), leaf)
        self.order = np.concatenate(self.order) if self.order else np.zeros(0, np.int64)

    def build(self, rows: np.ndarray, leaf: int) -> int:
        node = len(self.vantage)
        for x in (self.vantage, self.inner, self.outer, self.first, self.last):
            x.append(-1)
        self.radius.append(0.0)
        d = far = None
        if len(rows) > leaf:
            at = int(self.rng.choice(rows))
            d = distances(self.points[rows], self.points[at : at + 1])[:, 0]
            radius = float(np.median(d))
            far = d > radius
        # a branch must leave its sibling a part: else the rows stay together
        if far is None or min(far.sum(), len(far) - far.sum()) * 32 < len(far):
            self.first[node], self.last[node] = self.held, self.held + len(rows)
            self.order.append(rows)
            self.held += len(rows)
            return node
        self.vantage[node], self.radius[node] = at, radius
        self.inner[node] = self.build(rows[~far], leaf)
        self.outer[node] = self.build(rows[far], leaf)
        return node

    def leaf_of(self, q: np.ndarray) -> np.ndarray:
        """The leaf on whose side of every radius a query lies."""
        node = np.zeros(len(q), np.int64)
        todo = [(0, np.arange(len(q)))]
        while todo:
            at, rows = todo.pop()
            if self.vantage[at] < 0:
                node[rows] = at
            elif len(rows):
                v = self.vantage[at]
                far = distances(q[rows], self.points[v : v + 1])[:, 0] > self.radius[at]
                todo += [(self.inner[at], rows[~far]), (self.outer[at], rows[far])]
        return node

    def visit(self, q: np.ndarray, worst: np.ndarray, factor: float):
        """Yields (leaf, query rows) for all leaves that the rule keeps; ``worst``
        may fall while the caller works through them."""
        todo = [(0, np.arange(len(q)), np.zeros(len(q)))]
        while todo:
            at, rows, low = todo.pop()
            keep = factor * (low - SLACK) <= worst[rows]
            rows, low = rows[keep], low[keep]
            if not len(rows):
                continue
            v = self.vantage[at]
            if v < 0:
                yield at, rows
                continue
            d = distances(q[rows], self.points[v : v + 1])[:, 0] - self.radius[at]
            todo.append((self.outer[at], rows, np.maximum(low, -d)))
            todo.append((self.inner[at], rows, np.maximum(low, d)))


def cosines(q: list, c: list, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Exact scores of pairs of original vectors, each summed by itself."""
    width = min(max(map(len, q), default=1), max(map(len, c), default=1))
    a, b, na, nb = scaled(q, width), scaled(c, width), norms(q), norms(c)
    out = np.empty(len(qi))
    for i in range(0, len(qi), PAIRS):
        x, y = qi[i : i + PAIRS], ci[i : i + PAIRS]
        out[i : i + PAIRS] = (a[x] * b[y]).sum(1) / (na[x] * nb[y])
    return out


def search_tree(tree: Tree, q: np.ndarray, worst: np.ndarray, keep: int, factor: float, score):
    """(query, point, score) of the ``keep`` best points of each query, as far as
    the rule finds them. ``worst``: the distance of its keep-th best row so far;
    ``score`` gives exact scores; equal ones go to the earlier point."""
    worst = worst.copy()
    nearest = np.repeat(worst[:, None], keep, 1)
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    new: list[tuple] = []

    def cut():
        qi, ci, d = (np.concatenate([x[i] for x in new]) if new else np.zeros(0, np.int64) for i in range(3))
        good = d <= worst[qi] + SLACK
        qi, ci = qi[good], ci[good]
        all_q, all_c, all_s = (np.concatenate(x) for x in zip(held, (qi, ci, score(qi, ci)), strict=True))
        order = np.lexsort((all_c, -all_s, all_q))
        all_q = all_q[order]
        place = np.arange(len(all_q)) - np.searchsorted(all_q, all_q)
        order, all_q = order[place < keep], all_q[place < keep]
        held[:] = all_q, all_c[order], all_s[order]
        new.clear()

    def scan(node, rows):
        for first in range(tree.first[node], tree.last[node], STEP):
            points = tree.order[first : min(first + STEP, tree.last[node])]
            d = distances(q[rows], tree.points[points])
            a, b = np.nonzero(d <= worst[rows][:, None] + SLACK)
            new.append((rows[a], points[b], d[a, b]))
            nearest[rows] = np.sort(np.partition(np.concatenate((nearest[rows], d), 1), keep - 1, 1)[:, :keep], 1)
            worst[rows] = np.minimum(worst[rows], nearest[rows, -1])
            if sum(len(x[0]) for x in new) > PAIRS:
                cut()

    home = tree.leaf_of(q)
    for node in np.unique(home):
        scan(node, np.flatnonzero(home == node))
    for node, rows in tree.visit(q, worst, factor):
        rows = rows[home[rows] != node]
        if len(rows):
            scan(node, rows)
    cut()
    return held


class Router:
    """The coarse tree, small enough to travel with each task."""

    def __init__(self, sample: list, cells: int):
        width = max(map(len, sample), default=1)
        points = units(sample, width) if sample else np.zeros((0, width))
        self.tree = Tree(points, max(-(-len(points) // max(cells, 1)), 1))
        used = [v for v in self.tree.vantage if v >= 0]
        place = {v: i for i, v in enumerate(dict.fromkeys(used))}
        self.tree.points = points[list(place)] if place else points[:0]
        self.tree.vantage = [place[v] if v >= 0 else -1 for v in self.tree.vantage]
        self.tree.order = self.tree.order[:0]

    def cell(self, vectors: list) -> np.ndarray:
        return self.tree.leaf_of(units(vectors, self.width())) if len(vectors) else np.zeros(0, np.int64)

    def cells(self, vectors: list, worst: np.ndarray, factor: float):
        for node, rows in self.tree.visit(units(vectors, self.width()), worst, factor):
            for r in rows:
                yield int(r), node

    def width(self) -> int:
        return self.tree.points.shape[1]


class Index:
    """``points``: (cell, kind, part, point, v, vec_ids, rids) - the distinct vectors by
    shard; ``router``: the coarse tree; ``keep``: ids held of equal vectors."""

    def __init__(self, points: DataFrame, parts: DataFrame, router: Router, keep: int):
        self.points, self.parts, self.router, self.keep = points, parts, router, keep


def pairs_of(ids):
    return [F.transform(ids, lambda x: x[c]).alias(f"{c}s") for c in ("vec_id", "rid")]


def distinct(rows: DataFrame, keep: int) -> DataFrame:
    """(point, v, vec_ids, rids): each vector once, with its ``keep`` smallest
    (vec_id, rid)."""
    first = Window.partitionBy("v").orderBy("vec_id", "rid")
    some = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= keep)  # limited before the shuffle
    ids = F.array_sort(F.collect_list(F.struct("vec_id", "rid"))).alias("ids")
    return some.groupBy("v").agg(ids).select(F.col("ids")[0]["rid"].alias("point"), "v", *pairs_of("ids"))


def in_cells(rows: DataFrame, router: Router) -> DataFrame:
    """``rows`` with the cell of each vector, and its kind: the power of two its
    length reaches, so that a long vector widens no shard of short ones."""
    def task(batches):
        import pyarrow as pa
        for b in batches:
            cell = router.cell(b.column("v").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64())], names=[*b.schema.names, "cell"])

    kind = F.ceil(F.log2(F.size("v").cast("double"))).cast("int")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(task, f"{fields}, cell long").withColumn("kind", kind)


def build(vectors: DataFrame, k: int, cells: int | None = None) -> Index:
    """Index all rows of ``usable`` vectors for searches of up to ``k`` neighbours."""
    points = saved(distinct(vectors, k + 1), "points")
    about = points.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v")).alias("size"), F.max(F.size("v")).alias("width")).first()
    n, width = about["n"], about["width"] or 1
    sample = points.orderBy(F.xxhash64("point"), "point").limit(max(SAMPLE_BYTES // (8 * width), 16)).select("v")
    if cells is None:
        cells = min(CELLS, -(-8 * (about["size"] or 0) // SHARD_BYTES) or 1)
    router = Router([r["v"] for r in sample.collect()], cells)  # at most SAMPLE_BYTES
    placed = saved(in_cells(points, router), "placed")
    # cells and kinds are few (cells times the powers of two), whatever the rows
    parts = placed.groupBy("cell", "kind").agg(F.ceil(F.count(F.lit(1)) * F.pow(F.lit(2.0), F.col("kind")) * 8 / SHARD_BYTES).cast("int").alias("parts"))
    parts = saved(parts, "shards")
    shards = placed.join(F.broadcast(parts), ["cell", "kind"]).withColumn("part", F.pmod(F.xxhash64("point"), F.col("parts")).cast("int")).drop("parts")
    return Index(saved(shards, "index"), parts, router, k + 1)


def visited(index: Index, queries: DataFrame, factor: float) -> DataFrame:
    """``queries`` (point, v, worst, own) once for each cell kept but their own."""
    router = index.router

    def task(batches):
        import pyarrow as pa
        for b in batches:
            worst, own = (b.column(c).to_numpy(zero_copy_only=False) for c in ("worst", "own"))
            found = [(r, c) for r, c in router.cells(b.column("v").to_pylist(), worst, factor) if c != own[r]] if b.num_rows else []
            at = pa.array([r for r, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in ("point", "v", "worst")), pa.array([c for _, c in found], pa.int64())],
                                             names=["point", "v", "worst", "cell"])

    return queries.select("point", "v", "worst", "own").mapInArrow(task, "point long, v array<double>, worst double, cell long")


def in_shards(index: Index, queries: DataFrame, factor: float) -> DataFrame:
    """FOUND: the rows that the shards of the queries' cells hold near them.
    ``queries``: (point, v, worst, cell); the search of a cell is dealt by shard
    and by block of queries."""
    keep = index.keep
    width = queries.agg(F.max(F.size("v"))).first()[0] or 1
    blocks = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) * (8 * width) / BLOCK_BYTES).cast("int").alias("blocks"))
    shards = index.parts.join(F.broadcast(blocks), "cell")  # a row a cell
    dealt = (queries.join(F.broadcast(shards), "cell")
             .select("cell", "kind", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "point", "v", "worst"))
    sides = (index.points.join(F.broadcast(blocks), "cell")
             .select("cell", "kind", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "part", "point", "v", "vec_ids", "rids"))
    key = ["cell", "kind", "block", "part"]

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"point": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "rid": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(q) or not len(c):
            return empty
        c = c.assign(first=c["vec_ids"].str[0], row=c["rids"].str[0]).sort_values(["first", "row"], ignore_index=True)
        qs, cs = list(q["v"]), list(c["v"])
        tree = Tree(units(cs))
        qi, ci, score = search_tree(tree, units(qs, tree.points.shape[1]), q["worst"].to_numpy(np.float64), keep, factor, lambda a, b: cosines(qs, cs, a, b))
        out = pd.DataFrame({"point": q["point"].to_numpy()[qi], "vec_id": c["vec_ids"].to_numpy()[ci], "rid": c["rids"].to_numpy()[ci], "score": score})
        out = out.explode(["vec_id", "rid"]).sort_values(["point", "score", "vec_id", "rid"], ascending=[True, False, True, True])
        return out.groupby("point", sort=False).head(keep).astype({"vec_id": "int64", "rid": "int64"})

    return dealt.groupBy(*key).cogroup(sides.groupBy(*key)).applyInPandas(cell, FOUND)


def best(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("point").orderBy(F.desc("score"), "vec_id", "rid")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)


def nearest(index: Index, queries: DataFrame, factor: float = FACTOR) -> DataFrame:
    """FOUND and n: of each distinct query vector (point, v) the best rows."""
    keep = index.keep
    none = F.lit(float("inf"))  # no distance is known yet
    home = saved(in_cells(queries.select("point", "v", none.alias("worst")), index.router).drop("kind"), "query-cells")
    first = saved(best(in_shards(index, home, factor), keep), "own-cells")
    # a cosine s is a distance of sqrt(2 - 2 s)
    near = F.sqrt(F.greatest(F.lit(2.0) - 2 * F.col("score"), F.lit(0.0)))
    known = first.where(F.col("n") == keep).select("point", near.alias("near"))
    asked = home.drop("worst").withColumnRenamed("cell", "own").join(known, "point", "left").withColumn("worst", F.coalesce("near", none))
    rest = in_shards(index, saved(visited(index, asked, factor), "other-cells"), factor)
    return best(first.drop("n").unionByName(rest), keep)


def search(vectors: DataFrame, every: int = 50, k: int = 5, factor: float = FACTOR) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by ``every``; candidates: all
    other rows. query_id, rank, vec_id, score."""
    rows = saved(usable(vectors), "vectors")
    index = build(rows, k)
    asked = rows.where(F.col("vec_id") % every == 0)
    # copies of one query vector are many rows: its answer is spread over as many
    # salts as they need, so that the rows meet it evenly
    crowd = asked.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    points = saved(index.points.select("point", "v").join(crowd, "v"), "query-points")
    salt = F.pmod(F.xxhash64("rid"), F.col("salts")).cast("int").alias("salt")
    of = asked.join(points.withColumnRenamed("v", "u"), F.col("v") == F.col("u")).select("rid", F.col("vec_id").alias("query_id"), "point", salt)
    lists = (nearest(index, points.select("point", "v"), factor)
             .groupBy("point").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "rid", "score"))).alias("near"))
             .join(points.select("point", "salts"), "point").select("point", "near", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    others = F.filter("near", lambda x: x["rid"] != F.col("rid"))
    return (of.join(lists, ["point", "salt"])
            .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "x"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")))
