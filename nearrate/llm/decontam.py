"""Benchmark decontamination (operator 3), DataFrame functions only.

A positional inverted index of the training documents answers phrase queries.
Test items are cut into windows; the corpus frequencies of all test terms are
counted, and each window is searched from its rarest terms: the posting lists
of its two rarest terms, shifted by their offsets, are intersected on (document,
start), and the survivors are compared with the document's words at that place.
The lists meet within ``SLOP`` words, so the survivors give proximity matches too:
places where the rarest term stands and each term of the window is found within
``SLOP`` words of its own place (an exact phrase is one of them).
Only lists that some window searches by are stored: a frequent word's list is
never read, whatever its length.

Words: A-Z lower-cased, runs of letters, digits and non-ASCII characters.

Defined cases: a null or empty text has no words and no hits; an item with
fewer words than a window is one window, one without words none; a null item_id
marks words as hit but is not named; equal rows get equal results; an empty
documents table gives no rows; an empty benchmark gives no hits; columns other
than doc_id, text and item_id are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nearrate.llm.common import TERM, lower_ascii, packed, saved, small, unpacked, words

WINDOW = 10
SLOP = 5


def terms(text: Column) -> Column:
    return words(lower_ascii(text), TERM)


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(wid, items, wwords): each distinct window once, with the ids of its items."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), terms(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    return (w.select("item", F.explode(F.transform(starts, lambda i: F.slice("all", i, window))).alias("wwords"))
            .groupBy("wwords").agg(F.collect_set("item").alias("items"))
            .withColumn("wid", F.monotonically_increasing_id()))


def keyed(docs: DataFrame) -> DataFrame:
    """Document id and a hash of the text: rows equal in both have equal hits."""
    return docs.select("doc_id", F.xxhash64("text").alias("key"), "text")


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Corpus frequency of each term of ``vocabulary`` (a written table)."""
    return (docs.select(F.explode(terms(F.col("text"))).alias("term")).join(small(vocabulary), "term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows whose terms all occur, with (term, offset) of the two rarest."""
    by_term = windows.select("wid", F.posexplode("wwords").alias("offset", "term"))
    order = F.sort_array(F.collect_list(F.struct("n", "term", "offset")))
    listed = by_term.join(counts, "term").groupBy("wid").agg(order.alias("o"))
    two = listed.join(windows.select("wid", F.size("wwords").alias("len")), "wid").where(F.size("o") == F.col("len"))
    first, second = F.col("o")[0], F.get("o", F.lit(1))
    return two.select("wid", first["term"].alias("term1"), first["offset"].alias("off1"),
                      second["term"].alias("term2"), second["offset"].alias("off2"))


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The index: (term, doc_id, key, pos) for the terms of ``vocabulary``, a
    written table. The empty term stands at the end of every document, so its
    position is the number of words."""
    d = keyed(docs)
    every = F.concat(terms(F.col("text")), F.array(F.lit("")))
    return d.select("doc_id", "key", F.posexplode(every).alias("pos", "term")).join(small(vocabulary), "term")


def same_doc(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.key") == F.col(f"{b}.key"))


def candidates(index: DataFrame, windows: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc_id, key, wid, start, exact): proximity matches - the second rarest
    term stands within ``slop`` words of its place beside the rarest one - and
    whether the shifted lists meet exactly."""
    first = (index.withColumnRenamed("term", "term1").join(windows, "term1")
             .select("doc_id", "key", "wid", (F.col("pos") - F.col("off1")).alias("start"), "term2", "off2")
             .where(F.col("start") >= 0))
    alone = first.where(F.col("term2").isNull()).select("doc_id", "key", "wid", "start", F.lit(True).alias("exact"))
    # positions meet in blocks: a repeated term is compared with its neighbourhood alone
    width = 4 * max(slop, 1)
    due = F.col("start") + F.col("off2")
    reach = F.sequence(F.floor((due - slop) / width), F.floor((due + slop) / width))
    a = first.where(F.col("term2").isNotNull()).withColumn("place", F.explode(reach)).alias("a")
    b = index.withColumn("place", F.floor(F.col("pos") / width)).alias("b")
    off = F.col("b.pos") - F.col("a.start") - F.col("a.off2")
    meet = same_doc("a", "b") & (F.col("a.term2") == F.col("b.term")) & (F.col("a.place") == F.col("b.place"))
    both = (a.join(b, meet & (F.abs(off) <= slop))
            .groupBy("a.doc_id", "a.key", "a.wid", "a.start").agg(F.max(off == 0).alias("exact")))
    return both.unionByName(alone)


def within(all_words: Column, wwords: Column, start: Column, slop: int) -> Column:
    """Each word of a window stands within ``slop`` words of its place."""
    def there(w, j):
        low = F.greatest(start + j - slop, F.lit(0))
        return F.array_contains(F.slice(all_words, low + 1, F.greatest(start + j + slop + 1 - low, F.lit(0))), w)
    return F.forall(F.transform(wwords, there), lambda x: x)


def phrase_hits(docs: DataFrame, found: DataFrame, windows: DataFrame, slop: int = SLOP) -> DataFrame:
    """Compare each candidate with the document's words: doc_id, key, hits
    (start, end, items), n_near. ``found`` is a written table."""
    per_doc = (found.join(windows.select("wid", "wwords", "items"), "wid").groupBy("doc_id", "key")
               .agg(F.collect_set(F.struct("start", "wwords", "items")).alias("tried")))
    ids = saved(found.select("doc_id", "key").distinct(), "candidate-docs")
    # only candidates' texts are moved, however many they are
    d = keyed(docs).alias("d").join(small(ids).alias("i"), same_doc("d", "i"), "left_semi")
    d = d.dropDuplicates(["doc_id", "key"]).withColumn("all", terms(F.col("text"))).drop("text")
    at = lambda c: F.slice(F.col("all"), c["start"] + 1, F.size(c["wwords"]))
    real = F.filter("tried", lambda c: at(c) == c["wwords"])
    near = F.filter("tried", lambda c: within(F.col("all"), c["wwords"], c["start"], slop))
    shaped = F.sort_array(F.transform(real, lambda c: F.struct(
        c["start"].alias("start"), (c["start"] + F.size(c["wwords"])).alias("end"), c["items"].alias("items"))))
    return (per_doc.alias("p").join(d.alias("d"), same_doc("p", "d")).select("p.*", "d.all")
            .select("doc_id", "key", F.size(near).alias("n_near"), shaped.alias("hits")))


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """doc_id, key, n_words, hits, n_near: one row per document."""
    windows = saved(test_windows(benchmark, window), "test-windows")
    vocabulary = saved(windows.select(F.explode("wwords").alias("term")).distinct(), "test-terms")
    rare = saved(rarest(windows, term_counts(docs, vocabulary)), "rarest-terms")
    searched = (rare.select(F.col("term1").alias("term")).unionByName(rare.select(F.col("term2").alias("term")))
                .where(F.col("term").isNotNull()).unionByName(docs.sparkSession.createDataFrame([("",)], "term string")).distinct())
    index = saved(postings(docs, saved(searched, "searched-terms")), "postings")
    found = saved(candidates(index.where(F.col("term") != ""), rare, slop), "candidates")
    hits = phrase_hits(docs, found, windows, slop)
    ends = index.where(F.col("term") == "").select("doc_id", "key", F.col("pos").alias("n_words"))
    return ends.alias("e").join(hits.alias("h"), same_doc("e", "h"), "left").select("e.doc_id", "e.key", "e.n_words", "h.hits", "h.n_near")


def report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    r = search(docs, benchmark, **how)
    hits = F.coalesce("hits", F.array().cast(r.schema["hits"].dataType))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("hits", zero, lambda a, h: F.struct(
        F.greatest(a["end"], h["end"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(a["end"], h["start"]))).alias("n")))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    return (r.withColumn("hits", hits).withColumn("n_hit", covered["n"].cast("long")).withColumn("ids", items)
            .select("doc_id", "key", F.col("n_words").cast("long").alias("n_words"), "n_hit",
                    F.size("ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"),
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")))


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without a hit, unchanged."""
    bad = report(docs, benchmark, **how).where("contaminated").select(F.col("doc_id").alias("b_id"), F.col("key").alias("b_key")).distinct()
    rows = packed(docs, F.col("doc_id").alias("i_"), F.xxhash64("text").alias("k_"))
    return unpacked(rows.join(bad, F.col("i_").eqNullSafe(F.col("b_id")) & (F.col("k_") == F.col("b_key")), "left_anti"))


#: DuckDB: the same from plain word lists and joins on whole windows.
SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
spot AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
hit AS (SELECT DISTINCT spot.r, spot.i, spot.n, item_id FROM spot JOIN win ON win.n = spot.n AND win.s = array_to_string(spot.w[spot.i:spot.i + spot.n - 1], ' ')),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
cnt AS (SELECT t, count(*) AS c FROM (SELECT unnest(w) AS t FROM d) GROUP BY t),
rare AS (SELECT s, n, min({'c': c, 't': t, 'o': o}) AS f FROM (SELECT DISTINCT s, n, unnest(string_split(s, ' ')) AS t, unnest(range(0, n)) AS o FROM win) JOIN cnt USING (t) GROUP BY s, n HAVING count(*) = n),
spots AS (SELECT r, p - f.o AS b, string_split(s, ' ') AS v FROM (SELECT r, unnest(w) AS t, unnest(range(0, len(w))) AS p FROM d) AS x JOIN rare ON x.t = f.t WHERE p >= f.o),
near AS (SELECT r, count(*) AS n_near FROM spots JOIN d USING (r) WHERE list_bool_and(list_transform(range(0, len(v)), lambda j: list_contains(w[greatest(b + j - 5, 0) + 1:b + j + 6], v[j + 1]))) GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY r)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN pos USING (r) LEFT JOIN it USING (r) LEFT JOIN near USING (r)
"""
