"""Toxicity (operator 6): a weighted lexicon matched by Aho-Corasick.

Text is folded first: lower case, homoglyphs and digit substitutions to one
letter (1, l, | and i are one class), everything but letters to a space. The
lexicon - whole words, and stems that begin a word - is learned from labelled
documents by log odds (documents with the entry, toxic against clean), each with
its weight; matches inside an exception phrase do not count, and a word counts
once, by its heaviest entry. A document's weight, its number of matches and both
per number of words go through a logistic curve fitted on the same documents.

The lexicon is learned from at most ``TRAIN_DOCS`` labelled documents of either
label (by a hash of doc_id): entries of ``LEAST_DOCS`` toxic documents whose log odds
stay high with ``CONFIDENCE`` standard errors taken off, at most ``ENTRIES``, those
of the highest such bound; every whole text of the table is scored.

Defined cases: null and empty text have no matches and the score of such a text;
without labelled toxic documents the lexicon is empty and all scores are 0;
repeated labels of a document count as toxic if one does; an empty table gives no
rows; equal texts have equal scores; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from nearrate.llm.common import byte_list, remainder

TRAIN_DOCS = 6000
ENTRIES = 5000
#: Documents that an entry needs, and standard errors taken off its log odds.
LEAST_DOCS, CONFIDENCE = 3, 1.64
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.3
#: Characters that stand for a letter (Cyrillic, Greek, full width, digits, signs).
LOOKS_LIKE = {
    "a": "аɑα@4", "b": "8ЬВ", "c": "сϲ", "d": "ԁ", "e": "е3ҽε", "g": "9ɡ", "h": "һ", "i": "іιl1|!ӏ", "j": "ј", "k": "κк", "n": "п",
    "o": "оο0σ", "p": "рρ", "r": "г", "s": "ѕ5$", "t": "7τт", "u": "υ", "v": "ν", "w": "ԝ", "x": "хχ", "y": "уγ", "z": "2ʐ",
}
#: Phrases in which a match is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "idiot proof", "stupid simple", "scum line", "pathetic fallacy")
# texts are lower-cased first, so a capital's entry stands for its small letter too
FOLD = {ord(y): ord(k) for k, xs in LOOKS_LIKE.items() for x in xs if x != "!" for y in (x, x.lower())}
LETTERS = re.compile(r"[^\W\d_]+")


def fold(text: str) -> list[str]:
    """The folded words of a text."""
    return LETTERS.findall(text.lower().translate(FOLD))


def entries_of(ws: set[str]) -> set[str]:
    """Lexicon entries that a document could have: ' word ' and ' stem'."""
    out = {f" {w} " for w in ws}
    for n in STEMS:
        out.update(" " + w[:n] for w in ws if len(w) > n)
    return out


class Scorer:
    def __init__(self, weights: dict[str, float], curve: list[float] | None = None, exceptions=EXCEPTIONS):
        self.weights, self.curve, self.exceptions, self.machine = weights, curve, exceptions, None

    def build(self):
        import ahocorasick
        m = ahocorasick.Automaton()
        for e, w in self.weights.items():
            m.add_word(e, (len(e), w, False))
        for phrase in self.exceptions:
            e = " " + " ".join(fold(phrase)) + " "
            m.add_word(e, (len(e), 0.0, True))
        m.make_automaton()
        self.machine = m

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        if self.machine is None:
            self.build()
        ws = fold(text or "")
        n = max(len(ws), 1)
        best, free = {}, []
        for end, (size, weight, harmless) in self.machine.iter(" " + " ".join(ws) + " "):
            begin = end - size + 1
            if harmless:
                free.append((begin, end))
            elif weight > best.get(begin, 0.0):
                best[begin] = weight
        for a, b in free:
            for at in [x for x in best if a <= x < b]:
                del best[at]
        total = sum(best.values())
        return math.log1p(total), math.log1p(len(best)), math.log1p(100 * total / n), math.log1p(100 * len(best) / n)

    def score(self, text: str | None) -> float:
        if self.curve is None:
            return 0.0
        z = self.curve[-1] + sum(a * b for a, b in zip(self.curve, self.features(text), strict=False))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def labelled(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, text) of the training rows, about ``per_label`` for either
    label by a hash threshold, and the counts over all training rows."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    part = F.when(F.col("toxic") == 1, F.lit(min(1.0, per_label / max(total.get(1, 0), 1)))).otherwise(F.lit(min(1.0, per_label / max(total.get(0, 0), 1))))
    some = known.where(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 20)) < part * (1 << 20))
    # about 2 * per_label ids, whatever the table's size
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id"), total


def fit(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> Scorer:
    some, total = labelled(docs, labels, per_label)
    if not total.get(1):
        return Scorer({})

    def count(batches):
        import pyarrow as pa
        n, c = Counter(), (Counter(), Counter())
        for b in batches:
            for text, toxic in zip(byte_list(b.column("text")), b.column("toxic").to_pylist(), strict=True):
                n[toxic] += 1
                c[toxic].update(entries_of(set(fold((text or b"").decode()))))
        both = [k for k in c[1]]  # an entry of clean documents alone cannot enter the lexicon
        rows = [("", n[1], n[0]), *((k, c[1][k], c[0][k]) for k in both)]
        rows += [(k, 0, v) for k, v in c[0].items() if k not in c[1]]
        for a in range(0, len(rows), 50_000):
            part = rows[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*part, strict=True)], names=["entry", "bad", "good"])

    counted = some.mapInArrow(count, "entry string, bad long, good long").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counted = counted.persist()
    head = counted.where("entry = ''").first()
    if head is None:
        counted.unpersist()
        return Scorer({})
    n_bad, n_good = head["bad"], head["good"]
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    sure = F.col("odds") - CONFIDENCE * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    chosen = (counted.where((F.col("entry") != "") & (F.col("bad") >= LEAST_DOCS)).withColumn("odds", odds).withColumn("sure", sure)
              .where((F.col("odds") > 3) & (F.col("sure") > 1)).orderBy(F.desc("sure"), "entry").limit(ENTRIES).collect())
    counted.unpersist()
    scorer = Scorer({r["entry"]: float(r["odds"]) for r in chosen})

    def features(batches):
        import pyarrow as pa
        for b in batches:
            f = [scorer.features((t or b"").decode()) for t in byte_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.list_(pa.float64())), b.column("toxic").cast(pa.int64())], names=["f", "y"])

    rows = some.mapInArrow(features, "f array<double>, y long").collect()
    rows = sorted((tuple(r["f"]), r["y"]) for r in rows)
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    w = np.where(y == 1, total.get(1, 0) / max(y.sum(), 1), total.get(0, 0) / max((1 - y).sum(), 1))
    return Scorer(scorer.weights, curve(x, y, w))


def curve(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Weighted logistic regression by Newton steps; the last is the constant."""
    a = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(a.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (p - y)) + ridge * np.append(beta[:-1], 0)
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + ridge * np.diag([1.0] * (a.shape[1] - 1) + [1e-6])
        beta -= np.linalg.solve(hess, grad)
    return [float(b) for b in beta]


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, score of every row."""
    def task(batches):
        import pyarrow as pa
        for b in batches:
            s = [scorer.score((t or b"").decode()) for t in byte_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, score double")


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = score(docs, fit(docs, labels))
    return s.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
