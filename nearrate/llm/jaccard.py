"""N-gram Jaccard join (operator 8) with a token-group matrix.

Documents are sets of word shingles; two link when 100 * shared >= 85 * union.
Equal sets are one class, compared once. Tokens (63-bit shingle hashes) are ordered,
rare ones first: those of the low part of the hash range, which are counted over
all classes, by their frequency, then the rest of the range by hash. Of a pair that links, the larger set holds a common
token among its first a - ceil(0.85 a) + 1 and the smaller one among its first
b - ceil(1.7 b / 1.85) + 1 (prefix filters).

Classes that share first tokens are partitioned into groups by their most
frequent counted token, large groups further by class. The matrix stores, for each group, the
union of its members' first tokens with the members' sizes. A query class's
overlap with a group is bounded from its own first tokens found in that union. One
found token lets the bound reach the threshold, so it reduces to the prefix and
size filters; the groups that pass them are opened: the members' and
the queries' texts meet in one task, members as an index, queries streaming
past it, and the exact overlaps decide. A group's queries are dealt over several
tasks when there are many. An opened group returns counts of links and a spanning
forest of them, never all pairs; components are found on those edges by
alternating star contraction.

Words: A-Z lower-cased, split at ASCII white space.

Defined cases: null and empty texts have no shingles and link with nothing; with
fewer words than a shingle the whole sequence is the one shingle; a null doc_id
links like any other but names no component, unless all are null; equal rows are
separate documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from nearrate.llm.common import BROADCAST_ROWS, WORD, byte_list, own_exchange, packed, saved, unpacked
from nearrate.llm.text import Runs, chunks, mix, word_hashes

SHINGLE, PERCENT = 4, 85
LOW = int(0.3 * 2**63)
GROUP_MEMBERS, GROUP_TOKENS, TASK_QUERIES = 512, 250_000, 1024
#: Numbers of one table of an opened group.
CELLS = 1 << 19


def shingle_sets(texts: list[bytes | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and the offsets."""
    words, offsets = word_hashes(texts, lower=True)
    runs, n = Runs(words), np.diff(offsets)
    text = np.repeat(np.arange(len(texts)), n)
    start = np.arange(max(len(words) - k + 1, 0))
    start = start[text[start] == text[start + k - 1]] if len(start) else start
    short = np.flatnonzero((n > 0) & (n < k))
    h = np.concatenate([runs(start, k), mix(runs(offsets[short], n[short]) + n[short].astype(np.uint64))]) >> np.uint64(1)
    owner = np.concatenate([text[start], short]) if len(words) else short
    order = np.lexsort((h, owner))
    h, owner = h[order].astype(np.int64), owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(texts) + 1))


def probe_length(n, percent: int = PERCENT):
    return n - (n * percent + 99) // 100 + 1


def index_length(n, percent: int = PERCENT):
    whole = 100 + percent
    return n - (2 * percent * n + whole - 1) // whole + 1


def sketches(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n, two hashes of the set, key (hash of the text), low: the tokens
    of the low range, or as many more as the prefix filter needs."""
    def task(batches):
        import pyarrow as pa
        for b in batches:
            texts = byte_list(b.column("text"))
            for i, j in chunks(texts):
                h, at = shingle_sets(texts[i:j], k)
                n = np.diff(at)
                total = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h.astype(np.uint64) ^ np.uint64(c)))))[at] for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                one, two = (np.diff(x).view(np.int64) for x in total)
                low = np.concatenate(([0], np.cumsum(h < LOW)))
                low = low[at[1:]] - low[at[:-1]]
                keep = np.minimum(n, np.maximum(low, probe_length(n, percent)))
                inside = np.arange(len(h)) - np.repeat(at[:-1], n) < np.repeat(keep, n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(keep))), pa.int32()), pa.array(h[inside]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("rid").slice(i, j - i), b.column("doc_id").slice(i, j - i), b.column("key").slice(i, j - i), pa.array(n), pa.array(one), pa.array(two), pa.array(low), lists],
                    names=["rid", "doc_id", "key", "n", "one", "two", "n_low", "low"])

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    return rows.mapInArrow(task, "rid long, doc_id long, key long, n long, one long, two long, n_low long, low array<bigint>")


def first_tokens(classes: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """(node, n, head, token, place, index): of each class, the tokens within its
    prefix that another class counted as well. ``tokens``: (node, rank, token)."""
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    held = tokens.join(own_exchange(shared, "token"), "token").withColumn("low", F.col("token") < LOW)
    of = Window.partitionBy("node")
    # tokens that no other class has come first, and need no row here
    turn = F.sum(F.col("low").cast("long")).over(of.orderBy("count", "token").rowsBetween(Window.unboundedPreceding, 0))
    held = (held.withColumn("turn", turn).withColumn("shared_low", F.sum(F.col("low").cast("long")).over(of))
            .withColumn("head", F.max(F.struct("count", "token")).over(of)["token"])
            .join(classes.select("node", "n", "n_low"), "node"))
    place = F.when(F.col("low"), F.col("n_low") - F.col("shared_low") + F.col("turn") - 1).otherwise(F.col("rank"))
    whole = 100 + percent
    probe = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    index = F.col("n") - F.ceil(F.col("n") * (2 * percent) / whole) + 1
    return (held.withColumn("place", place).where(F.col("place") < probe)
            .select("node", "n", "head", "token", "place", (F.col("place") < index).alias("index")))


def grouped(firsts: DataFrame) -> DataFrame:
    """(node, n, gid): the group of each class that has a shared first token, by
    its most frequent counted token: that of a cluster of near copies is in
    nearly all of them. A group holds bounded numbers of members and tokens."""
    head = firsts.groupBy("node").agg(F.first("head").alias("head"), F.first("n").alias("n"))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / GROUP_MEMBERS, F.sum("n") / GROUP_TOKENS))
    sizes = head.groupBy("head").agg(parts.alias("parts"))
    return (head.join(own_exchange(sizes, "head"), "head")
            .select("node", "n", F.xxhash64("head", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("gid")))


def candidates(firsts: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(node, gid, n): the groups with a member of fitting size that a class shares
    a first token with."""
    matrix = (firsts.where("index").join(groups.select("node", "gid"), "node").groupBy("token", "gid")
              .agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("members"), F.min("node").alias("one")))
    q, m = firsts.alias("q"), matrix.alias("m")
    sizes = (F.col("m.least") <= F.col("q.n")) & (F.col("m.most") * 100 >= F.col("q.n") * percent)
    other = (F.col("m.members") > 1) | (F.col("m.one") != F.col("q.node"))
    found = q.join(m, (F.col("q.token") == F.col("m.token")) & sizes & other)
    return found.groupBy("q.node", "m.gid").agg(F.first("q.n").alias("n"))


def qualifying(pairs: DataFrame, groups: DataFrame, lows: DataFrame, percent: int) -> DataFrame:
    """The candidate (node, gid) whose overlap bound reaches the need: the class's
    low tokens found in the union of the members' ones, and all its others.
    ``lows``: (node, n_low, low), each class's tokens of the low range."""
    token = F.explode(F.slice("low", 1, F.greatest("n_low", F.lit(1)).cast("int"))).alias("token")
    asked_groups = pairs.select("gid").distinct()
    union = (groups.join(asked_groups, "gid", "left_semi").join(lows.where("n_low > 0"), "node").select("gid", token).distinct())
    asked = pairs.join(lows.where("n_low > 0"), "node").select("node", "gid", token)
    found = asked.join(union, ["gid", "token"], "left_semi").groupBy("node", "gid").agg(F.count(F.lit(1)).alias("found"))
    bound = F.coalesce("found", F.lit(0)) + F.col("n") - F.col("n_low")
    return (pairs.join(lows.select("node", "n_low"), "node").join(found, ["node", "gid"], "left")
            .where(bound >= F.ceil(F.col("n") * percent / 100)).select("node", "gid"))


def opened(pairs: DataFrame, groups: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Compare queries and members exactly: (node, other, links) - an edge of a
    spanning forest (other, or null) or a number of linked documents."""
    about = texts.join(classes.select("node", "n", "mult"), "node")
    many = pairs.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / TASK_QUERIES).cast("int").alias("parts"))
    members = (groups.select("node", "gid").join(many, "gid").join(about, "node")
               .select("gid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), "node", "n", "mult", "text"))
    queries = (pairs.join(own_exchange(many, "gid"), "gid").join(about, "node")
               .select("gid", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "node", "n", "mult", "text"))
    cells = members.unionByName(queries).repartition("gid", "part").sortWithinPartitions("gid", "part", "role", "node")

    def task(batches):
        import pyarrow as pa
        group, held = None, []

        def rows(out):
            if out:
                a, b, c = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["node", "other", "links"])

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("gid", "part", "role", "node", "n", "mult")]
            texts, i = byte_list(b.column("text")), 0
            while i < len(texts):
                at = (cols[0][i], cols[1][i])
                if group is None or group.at != at:
                    if group is not None:
                        yield from rows(group.close())
                    group = Group(at, k, percent)
                j = i
                while j < len(texts) and (cols[0][j], cols[1][j]) == at:
                    j += 1
                for role in (0, 1):
                    some = [x for x in range(i, j) if cols[2][x] == role]
                    if some:
                        part = [texts[x] for x in some], *([c[x] for x in some] for c in cols[3:])
                        held = group.members(*part) if role == 0 else group.queries(*part)
                        yield from rows(held or [])
                i = j
        if group is not None:
            yield from rows(group.close())

    return cells.mapInArrow(task, "node long, other long, links long")


class Group:
    """One opened group: its members' tokens as an index."""

    def __init__(self, at, k: int, percent: int):
        self.at, self.k, self.percent = at, k, percent
        self.parts, self.index = [], None

    def members(self, texts, node, n, mult):
        self.parts.append((texts, node, n, mult))

    def build(self):
        h, owner, node, n, mult, base = [], [], [], [], [], 0
        for texts, a, b, c in self.parts:
            tokens, at = shingle_sets(texts, self.k)
            h.append(tokens)
            owner.append(np.repeat(np.arange(base, base + len(texts)), np.diff(at)))
            node, n, mult, base = node + a, n + b, mult + c, base + len(texts)
        h, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (h, owner))
        order = np.argsort(h, kind="stable")
        self.index, self.owner = h[order], owner[order]
        self.node, self.n, self.mult = (np.array(x, np.int64) for x in (node, n, mult))
        self.links, self.root = np.zeros(base, np.int64), np.arange(base)
        self.parts = []

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def pieces(self, texts):
        """Ranges of queries whose texts and table of shared counts are bounded."""
        rows = max(CELLS // max(len(self.node), 1), 1)
        for i, j in chunks(texts, 1 << 17):
            for a in range(i, j, rows):
                yield a, min(a + rows, j)

    def queries(self, texts, node, n_, mult):
        if self.index is None:
            self.build()
        out, most = [], len(self.node)
        if not most:
            return out
        for i, j in self.pieces(texts):
            tokens, at = shingle_sets(texts[i:j], self.k)
            left, right = np.searchsorted(self.index, tokens, "left"), np.searchsorted(self.index, tokens, "right")
            count, query = right - left, np.repeat(np.arange(j - i), np.diff(at))
            shared = np.zeros((j - i) * most, np.int64)
            # a token that many members hold meets them all: a bounded number at once
            ends = np.cumsum(count)
            cut = np.searchsorted(ends, np.arange(CELLS, int(ends[-1]) if len(ends) else 0, CELLS)) + 1
            for a, b in zip([0, *cut], [*cut, len(count)], strict=True):
                n = count[a:b]
                place = np.repeat(left[a:b] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                shared += np.bincount(np.repeat(query[a:b], n) * most + self.owner[place], minlength=len(shared))
            shared = shared.reshape(j - i, most)
            nq, mq, wq = (np.array(x[i:j], np.int64)[:, None] for x in (n_, node, mult))
            smaller = (self.n < nq) | ((self.n == nq) & (self.node < mq))
            linked = smaller & (shared > 0) & ((100 + self.percent) * shared >= self.percent * (nq + self.n))
            self.links += (linked * wq).sum(0)
            for x in np.flatnonzero(linked.any(1)):
                mine = np.flatnonzero(linked[x])
                out.append((node[i + x], int(self.node[mine[0]]), int(self.mult[mine].sum())))
                a = self.find(mine[0])
                for y in mine[1:]:
                    b = self.find(y)
                    if a != b:
                        out.append((int(self.node[y]), int(self.node[mine[0]]), 0))
                        self.root[b] = a
        return out

    def close(self):
        if self.index is None:
            return []
        return [(int(self.node[i]), None, int(self.links[i])) for i in np.flatnonzero(self.links)]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge (u, v) reaches,
    by alternating large-star and small-star steps until only stars are left."""
    e = saved(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(own_exchange(least, "u"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.where("u != v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        with_m = large.join(own_exchange(least, "u"), "u")
        pairs = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p")
        e = saved(with_m.select(pairs).select("p.u", "p.v").where("u != v").distinct(), "small-star")
        inner = e.join(e.select(F.col("u").alias("x")).distinct(), F.col("v") == F.col("x"), "left_semi")
        counts = e.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("u")).first()
        if counts["n"] == counts["u"] and inner.isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def join(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """rid-free result: doc_id, key, n_shingles, component_id, n_links."""
    return rooted(docs, k, percent).drop("root")


def rooted(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The result of ``join`` with root: the node that names a component whatever
    the ids in it, null without shingles. Equal keys have equal roots."""
    rows = saved(sketches(docs, k, percent), "sketches")
    full = rows.where("n > 0")
    classes = full.groupBy("one", "two").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.count(F.lit(1)).alias("mult"),
                                             F.first("n").alias("n"), F.first("n_low").alias("n_low"), F.min("rid").alias("node"))
    classes = saved(classes, "classes")
    ids = classes.select(F.col("node").alias("rid"))
    ids = F.broadcast(ids) if classes.count() <= BROADCAST_ROWS else ids
    tokens = rows.select("rid", "low").join(ids, "rid", "left_semi").select(F.col("rid").alias("node"), F.posexplode("low").alias("rank", "token"))
    firsts = saved(first_tokens(classes, tokens, percent), "first-tokens")
    groups = saved(grouped(firsts), "groups")
    tried = saved(candidates(firsts, groups, percent), "candidate-groups")
    asked = saved(tried.select("node").unionByName(groups.join(tried.select("gid").distinct(), "gid", "left_semi").select("node")).distinct(), "asked")
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    lows = rows.select(F.col("rid").alias("node"), "n_low", "low").join(asked, "node", "left_semi")
    pairs = saved(qualifying(tried, groups, lows, percent), "open-groups")

    gids = pairs.select("gid").distinct()
    involved = saved(pairs.select("node").unionByName(groups.join(gids, "gid").select("node")).distinct()
                     .join(classes.select("node", "key"), "node"), "involved")
    texts = docs.select(F.xxhash64("text").alias("key"), "text")
    side = F.broadcast(involved) if involved.count() <= BROADCAST_ROWS else involved
    texts = saved(texts.join(side, "key").dropDuplicates(["node"]).select("node", "text"), "class-texts")
    found = saved(opened(pairs, groups, classes, texts, k, percent), "links")
    parts = components(found.where(F.col("other").isNotNull()).select(F.col("node").alias("u"), F.col("other").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))

    slim = classes.select("one", "two", "doc_id", "mult", "node").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = slim.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = slim.join(own_exchange(least, "root"), "root").join(links, "node", "left").select(
        "one", "two", "root", "component_id", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    side = rows.select("doc_id", "key", "n", "one", "two")
    a, b = side.alias("a"), of.alias("b")
    return a.join(b, (F.col("a.one") == F.col("b.one")) & (F.col("a.two") == F.col("b.two")) & (F.col("a.n") > 0), "left").select(
        "a.doc_id", "a.key", F.col("a.n").alias("n_shingles"), F.coalesce("b.component_id", "a.doc_id").alias("component_id"),
        F.coalesce("b.links", F.lit(0)).cast("long").alias("n_links"), "b.root")


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, unchanged: the one with the smallest id (a
    null id comes last), then the smallest hash of its text, then of its row.
    Documents without shingles all stay, and so do unlinked ones of equal ids."""
    found = rooted(docs, k, percent).where("root IS NOT NULL")
    stay = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("s"))
    stay = stay.select(F.col("s.doc_id").alias("s_id"), F.col("s.key").alias("s_key"))
    rows = packed(docs, F.col("doc_id").alias("i_"), F.xxhash64("text").alias("k_"), F.coalesce(F.col("text"), F.lit("")).rlike(WORD).alias("any_"))
    first = Window.partitionBy("i_", "k_").orderBy(F.xxhash64("row_"))
    kept = rows.where("any_").join(stay, F.col("i_").eqNullSafe(F.col("s_id")) & (F.col("k_") == F.col("s_key")), "left_semi")
    kept = kept.withColumn("n_", F.row_number().over(first)).where("n_ = 1")
    return unpacked(kept.select("row_").unionByName(rows.where("NOT any_").select("row_")))


#: DuckDB: all pairs that share a shingle, and the components by recursion.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n u ON u.r = x JOIN n v ON v.r = y WHERE 100 * i >= 85 * (u.n + v.n - i)),
c AS (SELECT r, r AS o FROM d UNION SELECT c.r, l.y FROM c JOIN l ON l.x = c.o),
m AS (SELECT c.r, min(d.doc_id) AS component_id FROM c JOIN d ON d.r = c.o GROUP BY c.r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, (SELECT count(*) FROM l WHERE l.x = d.r)::BIGINT AS n_links
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""
