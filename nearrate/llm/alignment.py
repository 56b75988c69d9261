"""Cross-tokenizer alignment (operator 12) with an identity-map fast path.

Every text is encoded by two tokenizers, A (byte-level BPE, on space + text) and
B (sentencepiece, which adds the space). Byte offsets where tokens of both end cut
them into groups, and each group links its last A token with its last B token,
whose byte ranges end together.

``aligned`` encodes the texts once and writes, per document, its links as
numbers. A precomputed array takes every A id to the B id of the same bytes;
groups of one A and one B token that it maps exactly are counted per A id, in a
vector as long as A's vocabulary. Only the other, irregular links are counted
as pairs, through a shuffle (``pair_counts``). ``scored`` reads a document's
exact links and its frequent pairs (each above 1 / FREQUENT of all irregular
links, so at most FREQUENT of them) from arrays; the rest, of which no pair is
hot, meet their counts in a join.

Texts are encoded by segments, cut at single spaces between other characters,
where both tokenizers cut as well; that is read from the files (A: byte level
with its own pattern, no normaliser; B: identity normaliser, added space, no
piece with a space after another character), else a segment is a whole text. Segments
met before are taken from a bounded table of the task, which keeps the ones met most.

Defined cases: null and empty texts, and those whose joined tokens differ from
space + text, have no tokens, groups or links, and an empty digest; a null
doc_id stays null; repeated ids and equal rows are documents of their own;
ties for a B id's highest count all count as best; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, functions as F

from nearrate.llm.common import byte_list, own_exchange, saved
from nearrate.llm.text import chunks
from nearrate.llm.tokens_out import byte_letters

KNOWN_SEGMENTS, KNOWN_BYTES = 250_000, 16 << 20
FREQUENT = 100_000
HELD_PAIRS = 1 << 20
#: A pair is A id << SHIFT | B id.
SHIFT = 32
CUT = re.compile(r"(?<=\S) (?=\S)")
LINKS = ("rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "same array<int>, same_n array<int>, odd array<bigint>, odd_n array<int>")


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        byte = {c: b for b, c in byte_letters().items()}
        self.size_a, self.size_b = max(self.a.get_vocab().values()) + 1, self.b.get_piece_size()
        self.bytes_a: list[bytes] = [b""] * self.size_a
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # of several B ids with the same bytes, a piece goes before a single byte
        of = {}
        for i in sorted(range(self.size_b), key=lambda i: (self.b.is_byte(i), i)):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                of.setdefault(self.bytes_b[i], i)
        self.same = np.array([of.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        self.cuts = self.plain_a(path_a) and self.plain_b(pieces)

    def plain_a(self, path: str) -> bool:
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        before, model = made["pre_tokenizer"] or {}, self.a.model
        return (made["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                and not before.get("add_prefix_space") and type(model).__name__ == "BPE"
                and not any(t.get("lstrip") or t.get("rstrip") or not t["special"] for t in made["added_tokens"]))

    def plain_b(self, pieces: list[str]) -> bool:
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        rule = model.normalizer_spec
        ordinary = [p for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        return (model.trainer_spec.model_type == model.trainer_spec.BPE and not rule.precompiled_charsmap and rule.add_dummy_prefix
                and not rule.remove_extra_whitespaces and rule.escape_whitespaces
                and not model.trainer_spec.treat_whitespace_as_suffix
                and not any(re.search("[^▁]▁", p) for p in ordinary))


class Aligner:
    """Segments of text as numbers: counts, group text and links of each."""

    def __init__(self, path_a: str, path_b: str):
        self.v = Vocabularies(path_a, path_b)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in v], np.int64) for v in (self.v.bytes_a, self.v.bytes_b))
        # how an id is written: inside its part of a group, at its end, at the segment's end
        self.text_a, self.text_b = (np.array([f"{i}{c}" for i in range(n) for c in ends], object)
                                    for n, ends in ((self.v.size_a, ",|"), (self.v.size_b, ",;\n")))
        self.known: dict[str, int] = {}
        self.groups: list[str | None] = []  # None: the bytes differ
        self.facts = np.zeros((3, 0), np.int64)  # numbers of A tokens, B tokens and groups
        self.first, self.links = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.used, self.size = np.zeros(0, np.int64), 0

    def forget(self) -> None:
        """Keep the segments met most, half of the table at most."""
        least = max(2, int(np.median(self.used)) + 1)
        stay = np.flatnonzero(self.used >= least)
        names = list(self.known)
        names, self.groups = [names[i] for i in stay], [self.groups[i] for i in stay]
        if sum(map(len, names)) * 2 > KNOWN_BYTES:
            stay, names, self.groups = stay[:0], [], []
        self.known = {x: i for i, x in enumerate(names)}
        count = np.diff(self.first)[stay]
        at = np.repeat(self.first[stay] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        self.links, self.first = self.links[at], np.concatenate(([0], np.cumsum(count)))
        self.facts, self.used = self.facts[:, stay], np.ones(len(stay), np.int64)
        self.size = sum(map(len, names))

    def learn(self, new: list[str]) -> None:
        spaced = [" " + s for s in new]
        codes_a = [e.ids for e in self.v.a.encode_batch_fast(spaced, add_special_tokens=False)]
        codes_b = self.v.b.encode(new, num_threads=1)
        good = range(len(new))
        if not self.equal(spaced, codes_a, codes_b):
            good = [i for i in good if self.equal(spaced[i : i + 1], codes_a[i : i + 1], codes_b[i : i + 1])]
            kept = set(good)
            codes_a, codes_b = ([x if i in kept else [] for i, x in enumerate(c)] for c in (codes_a, codes_b))
        facts, groups, links, count = self.align(codes_a, codes_b)
        for i, s in enumerate(new):
            self.known[s] = len(self.known)
        self.groups += groups
        self.size += sum(map(len, new))
        self.facts = np.concatenate((self.facts, facts), 1)
        self.links = np.concatenate((self.links, links))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(count)))
        self.used = np.concatenate((self.used, np.zeros(len(new), np.int64)))

    def equal(self, spaced: list[str], codes_a: list, codes_b: list) -> bool:
        """Whether the tokens of each segment join to space + segment."""
        want, a, b = [s.encode() for s in spaced], self.v.bytes_a, self.v.bytes_b
        joined_a, joined_b = (b"".join([v[i] for c in codes for i in c]) for v, codes in ((a, codes_a), (b, codes_b)))
        if not joined_a == joined_b == b"".join(want):
            return False
        sizes = np.array([len(x) for x in want])
        return all((np.bincount(np.repeat(np.arange(len(codes)), [len(c) for c in codes]), v[np.fromiter((i for c in codes for i in c), np.int64)], len(codes)) == sizes).all()
                   for v, codes in ((self.sizes_a, codes_a), (self.sizes_b, codes_b)))

    def align(self, codes_a: list, codes_b: list):
        """All segments at once: their numbers of tokens and groups, the text of
        the groups (None without tokens), the links and how many each has."""
        n_a, n_b = (np.array([len(c) for c in codes], np.int64) for codes in (codes_a, codes_b))
        a, b = (np.fromiter((i for c in codes for i in c), np.int64) for codes in (codes_a, codes_b))
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        owner = np.repeat(np.arange(len(n_a)), n_a)[last_a]
        x, y = a[last_a], b[last_b]
        exact = (size_a == 1) & (size_b == 1) & (self.v.same[x] == y)
        links = np.where(exact, -1 - x, x << SHIFT | y)
        # the groups as text: the A ids of a group, then its B ids
        group_a, group_b = (np.repeat(np.arange(len(ends)), n) for n in (size_a, size_b))
        before_a, before_b = last_a + 1, last_b + 1 - size_b
        out = np.empty(len(a) + len(b), object)
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[last_a] = end_b[last_b] = 1
        end_b[np.cumsum(n_b)[n_b > 0] - 1] = 2
        out[np.arange(len(a)) + before_b[group_a]] = self.text_a[2 * a + end_a]
        out[np.arange(len(b)) + before_a[group_b]] = self.text_b[3 * b + end_b]
        texts = iter("".join(out.tolist()).split("\n"))
        groups = [next(texts) if n else None for n in n_a.tolist()]
        n_groups = np.bincount(owner, minlength=len(n_a)).astype(np.int64)
        return np.stack((n_a, n_b, n_groups)), groups, links, n_groups

    def segments(self, text: bytes | None) -> list[str] | None:
        """None: without tokens."""
        try:
            s = (text or b"").decode()
        except UnicodeDecodeError:
            return None
        return (CUT.split(s) if self.v.cuts else [s]) if s else None

    def __call__(self, texts: list[bytes | None]):
        """n_a, n_b, n_groups and digest of each text; then flat arrays of links
        and the text of each: exact ones as -1 - A id, others as pairs."""
        if len(self.groups) > KNOWN_SEGMENTS or self.size > KNOWN_BYTES:
            self.forget()
        cut = [self.segments(t) for t in texts]
        new = dict.fromkeys(s for c in cut if c for s in c if s not in self.known)
        if new:
            self.learn(list(new))
        places = [[self.known[s] for s in c] if c else [] for c in cut]
        digests = []
        for x, place in enumerate(places):
            parts = [self.groups[i] for i in place]
            if None in parts:
                places[x], parts = [], []
            digests.append(hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else "")
        n = np.array([len(p) for p in places], np.int64)
        flat = np.fromiter(chain.from_iterable(places), np.int64, int(n.sum()))
        self.used += np.bincount(flat, minlength=len(self.used))
        text = np.repeat(np.arange(len(texts)), n)
        n_a, n_b, n_groups = (np.bincount(text, x[flat], len(texts)).astype(np.int64) for x in self.facts)
        count = np.diff(self.first)[flat]
        at = np.repeat(self.first[flat] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        return n_a, n_b, n_groups, digests, self.links[at], np.repeat(text, count)


def lists(values: np.ndarray, owner: np.ndarray, n: int, kind, counts: np.ndarray):
    """Arrow lists, one of ``n`` per owner (ascending), of values and of counts."""
    import pyarrow as pa
    offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind)), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's counts, digest, and distinct links with their numbers:
    ``same``, exact ones by A id, and ``odd``, the irregular pairs."""
    def task(batches):
        import pyarrow as pa
        work = Aligner(path_a, path_b)
        for b in batches:
            texts = byte_list(b.column("text"))
            for i, j in chunks(texts):
                n = j - i
                n_a, n_b, groups, digests, links, owner = work(texts[i:j])
                order = np.lexsort((links, owner))
                links, owner = links[order], owner[order]
                new = np.ones(len(links), bool)
                new[1:] = (links[1:] != links[:-1]) | (owner[1:] != owner[:-1])
                times = np.diff(np.append(np.flatnonzero(new), len(links)))
                total = np.bincount(owner, minlength=n).astype(np.int64)
                links, owner = links[new], owner[new]
                exact = links < 0
                same, same_n = lists(-1 - links[exact], owner[exact], n, pa.int32(), times[exact])
                odd, odd_n = lists(links[~exact], owner[~exact], n, pa.int64(), times[~exact])
                yield pa.RecordBatch.from_arrays(
                    [b.column("rid").slice(i, n), b.column("doc_id").slice(i, n), pa.array(n_a), pa.array(n_b), pa.array(groups), pa.array(total),
                     pa.array(digests, pa.string()), same, same_n, odd, odd_n], names=[f.split()[0] for f in LINKS.split(", ")])

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(task, LINKS)


def flat_list(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def list_owner(column) -> np.ndarray:
    return np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))


def exact_counts(links: DataFrame, size: int) -> np.ndarray:
    """How often each A id is linked exactly: a vector per task, added up. The
    result has as many numbers as A's vocabulary."""
    def task(batches):
        import pyarrow as pa
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(flat_list(b.column("same")), flat_list(b.column("same_n")), size).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["id", "n"])

    out = np.zeros(size, np.int64)
    for r in links.select("same", "same_n").mapInArrow(task, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n) of the irregular links, added up per task before the shuffle."""
    def task(batches):
        import pyarrow as pa
        parts, size = [], 0

        def added():
            pair = np.concatenate([p for p, _ in parts]) if parts else np.zeros(0, np.int64)
            n = np.concatenate([c for _, c in parts]) if parts else pair
            pair, at = np.unique(pair, return_inverse=True)
            return pair, np.bincount(at, n, len(pair)).astype(np.int64)

        def batch(pair, n):
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

        for b in batches:
            parts.append((flat_list(b.column("odd")), flat_list(b.column("odd_n"))))
            size += len(parts[-1][0])
            if size > HELD_PAIRS:
                parts = [added()]
                size = len(parts[0][0])
                if size > HELD_PAIRS // 2:
                    yield batch(*parts.pop())
                    size = 0
        yield batch(*added())

    return links.select("odd", "odd_n").mapInArrow(task, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def scored(links: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """n_best and count_sum of each document, from corpus-wide counts of links.
    ``links``: the written rows of ``aligned``."""
    exact = exact_counts(links, vocabularies.size_a)
    pairs = saved(pair_counts(links), "pair-counts")
    to_b = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    best = np.zeros(vocabularies.size_b, np.int64)
    np.maximum.at(best, vocabularies.same[exact > 0], exact[exact > 0])
    for r in pairs.groupBy(to_b.alias("b")).agg(F.max("n").alias("n")).collect():  # at most B's vocabulary
        best[r["b"]] = max(best[r["b"]], r["n"])
    total = pairs.agg(F.sum("n")).first()[0] or 0
    frequent = sorted(tuple(r) for r in pairs.where(F.col("n") * FREQUENT >= total).select("pair", "n").collect())  # at most FREQUENT
    code, times = (np.array([r[i] for r in frequent], np.int64) for i in (0, 1))
    same = vocabularies.same

    def task(batches):
        import pyarrow as pa
        for b in batches:
            n = b.num_rows
            ids, k, owner = flat_list(b.column("same")), flat_list(b.column("same_n")), list_owner(b.column("same"))
            odd, odd_k, odd_owner = flat_list(b.column("odd")), flat_list(b.column("odd_n")), list_owner(b.column("odd"))
            at = np.searchsorted(code, odd)
            found = at < len(code)
            found[found] = code[at[found]] == odd[found]
            count = np.concatenate((exact[ids], times[at[found]]))
            target = np.concatenate((best[same[ids]], best[odd[found] & ((1 << SHIFT) - 1)]))
            weight, of = np.concatenate((k, odd_k[found])), np.concatenate((owner, odd_owner[found]))
            n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(n_best, of, weight * (count == target))
            np.add.at(count_sum, of, weight * count)
            rare, rare_n = lists(odd[~found], odd_owner[~found], n, pa.int64(), odd_k[~found])
            columns = [b.column(c) for c in ("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_best), pa.array(count_sum), rare, rare_n],
                                             names=["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "rare", "rare_n"])

    facts = "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    part = saved(links.mapInArrow(task, facts + ", rare array<bigint>, rare_n array<int>"), "alignment")
    # rare pairs: none is hot, so their join on the pair is even
    rare = (part.where(F.size("rare") > 0).select("rid", F.explode(F.arrays_zip("rare", "rare_n")).alias("r"))
            .select("rid", F.col("r.rare").alias("pair"), F.col("r.rare_n").alias("k")))
    counts = pairs.where(F.col("n") * FREQUENT < total)
    peaks = links.sparkSession.createDataFrame([(int(i), int(best[i])) for i in np.flatnonzero(best)], "b long, top long")
    known = counts.join(F.broadcast(peaks), to_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("top"))
    sums = (rare.join(known, "pair").groupBy("rid")
            .agg(F.sum(F.when(F.col("top"), F.col("k")).otherwise(0)).alias("more_best"), F.sum(F.col("k") * F.col("n")).alias("more_sum")))
    return (part.drop("rare", "rare_n").join(own_exchange(sums, "rid"), "rid", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256"))


def report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document, from one pass of both tokenizers."""
    return scored(saved(aligned(docs, path_a, path_b), "links"), Vocabularies(path_a, path_b))
