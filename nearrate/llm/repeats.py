"""Substring deduplication (operator 4) with prefix-partitioned suffix trees.

A suffix is a window of ``LENGTH`` words; the question is which windows start in
a document with a smaller id as well.

1. Suffixes are split by prefixes, words that they must share: the prefix of a
   window is the smallest fingerprint of ``PREFIX`` consecutive words in it, so
   equal windows have equal prefixes and neighbouring windows mostly the same
   one. Prefixes are counted over all documents; one that stands in a single
   document has no inner node and is dropped.
2. Consecutive windows under one shared prefix form a branch, whose label is the
   run of words that they span. Equal branches are merged into one with the
   smallest document (aggregated before the shuffle, so thousands of copies
   cost one row per task).
3. The suffixes of the distinct branches under each prefix are counted. Up to
   ``GROUP`` of them are a group, which one task can hold; under a prefix with
   more, all are cut again by a prefix of twice the length, and so on. What is
   still too many under a prefix of almost the whole window is joined as a
   table of nodes of depth ``LENGTH``, which needs no group at all.
4. Each group's suffix tree is built top-down: its suffixes are split by their
   next words, edge by edge, and a node whose leaves lie in one document is
   closed, as no repeat is below it. Nodes that are open at depth ``LENGTH`` are
   the repeats; their leaves outside the smallest document are marked, and
   runs of marked neighbours are the maximal repeats.

A group never has more than ``GROUP`` suffixes, however common its words are;
everything else is aggregates that combine on the map side and joins that
adaptive execution can split. Words and edges are compared by 64-bit
fingerprints.

Defined cases: null text has no words; a document of fewer than ``LENGTH`` words
is kept whole; a row with a null doc_id is kept whole and no source of others;
rows with equal ids do not remove each other's words; a repeat inside one
document is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from nearrate.llm.common import BROADCAST_ROWS, byte_list, own_exchange, saved
from nearrate.llm.text import Runs, chunks, mix, sliding_min, word_hashes

LENGTH, PREFIX = 50, 12
#: Suffixes that one task holds as a tree (about 100 bytes each), and windows in one branch.
GROUP, BRANCH = 16384, 512


def window_prefixes(words: np.ndarray, offsets: np.ndarray, length: int, prefix: int):
    """Starts of all windows that lie in one text, the text's number, the
    window's prefix, and the fingerprints."""
    runs = Runs(words)
    if len(words) < length:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), runs
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.arange(len(words) - length + 1)
    inside = text[start] == text[start + length - 1]
    least = sliding_min(runs(np.arange(len(words) - prefix + 1), prefix), length - prefix + 1)
    return start[inside], text[start[inside]], least[inside], runs


def prefixes(docs: DataFrame, length: int, prefix: int) -> DataFrame:
    """(prefix, doc_id): the prefixes of the windows of each document."""
    def task(batches):
        import pyarrow as pa
        for b in batches:
            texts, ids = byte_list(b.column("text")), b.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j in chunks(texts):
                _, text, least, _ = window_prefixes(*word_hashes(texts[i:j]), length, prefix)
                new = np.ones(len(least), bool)
                new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(least[new].view(np.int64)), pa.array(ids[i:j][text[new]], pa.int64())], names=["prefix", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(task, "prefix long, doc_id long")


def cut_branches(start: np.ndarray, text: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where branches begin among the windows, and their numbers of windows:
    neighbours under one prefix, at most ``BRANCH`` of them."""
    cut = np.ones(len(start), bool)
    cut[1:] = (start[1:] != start[:-1] + 1) | (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(cut)
    rank = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
    begin = np.flatnonzero(rank % BRANCH == 0)
    return begin, np.diff(np.append(begin, len(start)))


def word_lists(words: np.ndarray, first: np.ndarray, count: np.ndarray):
    """An Arrow array of lists: ``count`` words from ``first`` on."""
    import pyarrow as pa
    ends = np.concatenate(([0], np.cumsum(count)))
    flat = np.repeat(first - ends[:-1], count) + np.arange(ends[-1])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(words[flat].view(np.int64)))


def branches(docs: DataFrame, length: int, prefix: int) -> DataFrame:
    """``docs`` with an array ``shared`` of prefixes -> the branches under those
    prefixes: label, prefix, doc_id, key, first (start of its first suffix),
    words (hashes of the words that its suffixes span)."""
    def task(batches):
        import pyarrow as pa
        for b in batches:
            texts, ids, keys = byte_list(b.column("text")), b.column("doc_id").to_numpy(), b.column("key").to_numpy()
            shared = b.column("shared")
            for i, j in chunks(texts):
                words, offsets = word_hashes(texts[i:j])
                start, text, least, runs = window_prefixes(words, offsets, length, prefix)
                some = shared.slice(i, j - i)
                mine = np.asarray(some.flatten()).view(np.uint64)
                # (text, prefix) pairs of both sides, compared as one mixed number each
                owner = np.repeat(np.arange(j - i), np.diff(np.asarray(some.offsets)))
                live = np.isin(mix(least + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                               mix(mine + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                start, text, least = start[live], text[live], least[live]
                if not len(start):
                    continue
                begin, size = cut_branches(start, text, least)
                rank = np.arange(len(start)) - np.repeat(begin, size)
                label = mix(np.add.reduceat(mix(runs(start, length) ^ mix(rank.astype(np.uint64))), begin) + size.astype(np.uint64))
                of = text[begin]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label.view(np.int64)), pa.array(least[begin].view(np.int64)), pa.array(ids[i:j][of], pa.int64()),
                     pa.array(keys[i:j][of], pa.int64()), pa.array((start[begin] - offsets[of]).astype(np.int32)),
                     word_lists(words, start[begin], size + length - 1)], names=["label", "prefix", "doc_id", "key", "first", "words"])

    return docs.select("doc_id", "key", "text", "shared").mapInArrow(
        task, "label long, prefix long, doc_id long, key long, first int, words array<bigint>")


PARTS = "label long, base int, least long, prefix long, words array<bigint>"


def lengthened(parts: DataFrame, length: int, prefix: int) -> DataFrame:
    """Parts of branches (``PARTS``), cut again by prefixes of ``prefix`` words."""
    def task(batches):
        import pyarrow as pa
        for b in batches:
            offsets, words = list_column(b.column("words"))
            start, text, least, _ = window_prefixes(words, offsets, length, prefix)
            begin, size = cut_branches(start, text, least)
            of = text[begin]
            yield pa.RecordBatch.from_arrays(
                [b.column("label").take(pa.array(of)), pa.array((b.column("base").to_numpy()[of] + start[begin] - offsets[of]).astype(np.int32)),
                 b.column("least").take(pa.array(of)), pa.array(least[begin].view(np.int64)), word_lists(words, start[begin], size + length - 1)],
                names=["label", "base", "least", "prefix", "words"])

    return parts.select("label", "base", "least", "prefix", "words").mapInArrow(task, PARTS)


def list_column(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of an Arrow list column of word hashes."""
    offsets = np.asarray(column.offsets).astype(np.int64)
    return offsets - offsets[0], np.asarray(column.flatten()).view(np.uint64)


def open_nodes(group: np.ndarray, least: np.ndarray, offsets: np.ndarray, words: np.ndarray, length: int):
    """The suffix trees of whole groups. Part i belongs to ``group[i]``, stands
    in document ``least[i]`` and spans words[offsets[i]:offsets[i + 1]]. Returns the
    suffixes (part, offset in it) that end in a node of depth ``length`` whose
    smallest document is another one."""
    size = np.maximum(np.diff(offsets) - length + 1, 0)
    part = np.repeat(np.arange(len(group)), size)
    off = np.arange(len(part)) - np.repeat(np.cumsum(size) - size, size)
    node, at, doc = group[part], offsets[part] + off, least[part]
    runs, depth, edge = Runs(words), 0, 2
    lowest = doc
    while len(part) and depth < length:
        edge = min(edge, length - depth)
        label = runs(at + depth, edge)
        order = np.lexsort((label, node))
        node, label, part, off, at, doc = (x[order] for x in (node, label, part, off, at, doc))
        new = np.ones(len(node), bool)
        new[1:] = (node[1:] != node[:-1]) | (label[1:] != label[:-1])
        begin = np.flatnonzero(new)
        node = np.cumsum(new)
        low, high = np.minimum.reduceat(doc, begin), np.maximum.reduceat(doc, begin)
        alive = (low < high)[node - 1]
        lowest = low[node - 1][alive]
        node, part, off, at, doc = (x[alive] for x in (node, part, off, at, doc))
        depth, edge = depth + edge, edge * 2
    later = doc > lowest
    return part[later], off[later]


def trees(groups: DataFrame, length: int) -> DataFrame:
    """Parts in whole groups -> (label, offs), the marked suffixes of a branch."""
    def task(batches):
        import pyarrow as pa
        held = None
        for b in _then_none(batches):
            if b is not None:
                b = pa.Table.from_batches([b])
                held = b if held is None else pa.concat_tables([held, b])
            if held is None:
                continue
            prefix = held.column("prefix").to_numpy()
            # the last group may go on in the next batch
            whole = held.num_rows if b is None else int(np.searchsorted(prefix, prefix[-1])) if len(prefix) else 0
            done, held = held.slice(0, whole).combine_chunks(), held.slice(whole)
            for i, j in _slices(prefix[:whole]):
                now = done.slice(i, j - i)
                offsets, words = list_column(now.column("words").combine_chunks())
                least, label, base = (now.column(n).to_numpy() for n in ("least", "label", "base"))
                part, off = open_nodes(prefix[i:j], least, offsets, words, length)
                order = np.lexsort((off, part))
                part, off = part[order], off[order]
                mine, begin = np.unique(part, return_index=True)
                ends = np.append(begin, len(part))
                offs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((base[part] + off).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(label[mine]), offs], names=["label", "offs"])

    return groups.select("label", "base", "least", "prefix", "words").mapInArrow(task, "label long, offs array<int>")


def _then_none(batches):
    yield from batches
    yield None


def _slices(prefix: np.ndarray, rows: int = 512):
    """Ranges of about ``rows`` rows that do not cut a group."""
    i = 0
    while i < len(prefix):
        j = min(i + rows, len(prefix))
        j = int(np.searchsorted(prefix, prefix[j - 1], side="right"))
        yield i, j
        i = j


def deepest(parts: DataFrame, length: int) -> DataFrame:
    """Parts under prefixes that stay too common -> (label, offs), from a table of
    nodes of depth ``length``: an aggregate and a join, no group."""
    def task(batches):
        import pyarrow as pa
        for b in batches:
            offsets, words = list_column(b.column("words"))
            start, text, _, runs = window_prefixes(words, offsets, length, length)
            yield pa.RecordBatch.from_arrays(
                [b.column("label").take(pa.array(text)), pa.array((b.column("base").to_numpy()[text] + start - offsets[text]).astype(np.int32)),
                 b.column("least").take(pa.array(text)), pa.array(runs(start, length).view(np.int64))], names=["label", "off", "least", "node"])

    leaves = parts.select("label", "base", "least", "words").mapInArrow(task, "label long, off int, least long, node long")
    inner = leaves.groupBy("node").agg(F.min("least").alias("a"), F.max("least").alias("b")).where("a < b").select("node", "a")
    return (leaves.join(own_exchange(inner, "node"), "node").where(F.col("least") > F.col("a"))
            .groupBy("label").agg(F.collect_set("off").alias("offs")))


def sized_groups(parts: DataFrame, length: int) -> DataFrame:
    """Parts under prefixes of several documents, with ``n``, the prefix's suffixes."""
    windows = (F.size("words") - F.lit(length - 1)).cast("long")
    sizes = (parts.groupBy("prefix").agg(F.sum(windows).alias("n"), F.min("least").alias("a"), F.max("least").alias("b"))
             .where("a < b").select("prefix", "n"))
    return parts.join(own_exchange(sizes, "prefix"), "prefix")


def marked(parts: DataFrame, length: int, prefix: int, group: int) -> DataFrame:
    """(label, offs): the suffixes of distinct branches that another branch of a
    smaller document has too."""
    found = None
    while True:
        sized = saved(sized_groups(parts, length), "groups")
        mine = trees(sized.where(F.col("n") <= group).repartition("prefix").sortWithinPartitions("prefix"), length)
        found = mine if found is None else found.unionByName(mine)
        parts, prefix = sized.where(F.col("n") > group), 2 * prefix
        if parts.isEmpty():
            break
        if prefix >= length:
            found = found.unionByName(deepest(parts, length))
            break
        parts = saved(lengthened(parts, length, prefix), "lengthened")
    return found.groupBy("label").agg(F.sort_array(F.flatten(F.collect_list("offs"))).alias("offs"))


def repeated_suffixes(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """(doc_id, key, starts): runs (first, n) of the suffixes of a document that
    also start in one with a smaller id. ``key`` is a hash of the text."""
    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = saved(prefixes(known, length, prefix), "prefixes")
    shared = (found.groupBy("prefix").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("prefix"))
    per_doc = (found.join(own_exchange(shared, "prefix"), "prefix").groupBy("doc_id").agg(F.collect_set("prefix").alias("shared")))
    per_doc = saved(per_doc, "shared-prefixes")
    source = known
    if per_doc.count() <= BROADCAST_ROWS:  # only their texts are moved then
        source = known.join(F.broadcast(per_doc.select("doc_id")), "doc_id", "left_semi")
    source = source.withColumn("key", F.xxhash64("text")).join(per_doc, "doc_id")
    leaves = saved(branches(source, length, prefix), "branches")

    merged = leaves.groupBy("label").agg(F.min(F.struct("doc_id", "prefix", "words")).alias("m"))
    parts = saved(merged.select("label", F.lit(0).alias("base"), F.col("m.doc_id").alias("least"), "m.prefix", "m.words"), "distinct-branches")
    again = marked(parts, length, prefix, group)
    marks = own_exchange(parts.select("label", "least").join(again, "label", "left"), "label")
    slim = leaves.select("label", "doc_id", "key", "first", (F.size("words") - F.lit(length - 1)).alias("size"))
    runs = F.when(F.col("doc_id") > F.col("least"), F.array(F.struct(F.col("first"), F.col("size").alias("n")))).otherwise(
        F.transform("offs", lambda o: F.struct((F.col("first") + o).alias("first"), F.lit(1).alias("n"))))
    return (slim.join(marks, "label").select("doc_id", "key", runs.alias("runs")).where(F.size("runs") > 0)
            .groupBy("doc_id", "key").agg(F.flatten(F.collect_list("runs")).alias("starts")))


def covered(n: int, first: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Which of n words lie in a window that starts in one of the runs."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(first + count + length - 1, n), -1)
    return np.cumsum(edge[:n]) > 0


def deduplicate(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, texts: bool = True, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if ``texts``, kept: the words
    that stay, joined by one space."""
    marks = saved(repeated_suffixes(docs, length, prefix, group), "repeats")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))
    marks = marks.withColumnsRenamed({"doc_id": "m_id", "key": "m_key"})
    here = (F.col("doc_id") == F.col("m_id")) & (F.col("key") == F.col("m_key"))
    n = marks.count()
    if n <= BROADCAST_ROWS:  # texts without a mark stay where they are
        ids = F.broadcast(marks.select("m_id", "m_key"))
        touched = rows.join(ids, here, "left_semi").join(marks, here).select("doc_id", "text", "starts")
        rest = rows.join(ids, here, "left_anti").select("doc_id", "text", F.lit(None).cast(marks.schema["starts"].dataType).alias("starts"))
        rows = touched.unionByName(rest)
    else:
        rows = rows.join(marks, here, "left").select("doc_id", "text", "starts")

    def task(batches):
        import pyarrow as pa
        for b in batches:
            out = []
            for text, runs in zip(byte_list(b.column("text")), b.column("starts"), strict=True):
                words = (text or b"").split()
                kept = words
                if runs.is_valid:
                    r = runs.values
                    drop = covered(len(words), np.asarray(r.field("first")), np.asarray(r.field("n")), length)
                    kept = [words[i] for i in np.flatnonzero(~drop)]
                kept_text = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(kept_text).hexdigest(), kept_text if texts else None))
            n, gone, sha, kept = zip(*out, strict=True) if out else ((), (), (), ())
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary()).cast(pa.string())] * texts, names=names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * texts
    return rows.mapInArrow(task, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)


#: DuckDB: all windows as word lists.
SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS s FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s),
gone AS (SELECT r, list_distinct(flatten(list(range(i, i + 50)))) AS p FROM g JOIN f USING (s) WHERE doc_id > first GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN p IS NULL THEN w ELSE list_where(w, list_transform(range(1, len(w) + 1), lambda i: NOT list_contains(p, i))) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""
