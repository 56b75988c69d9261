"""Language identification (operator 5): a byte convolutional network.

Bytes go through filters of several widths, each filter keeps its maximum over
a fixed-length window, and a softmax over those maxima gives the language. It is
trained in numpy, with Adam, on a bounded sample of labelled documents
(``TRAIN_DOCS``, the smallest by a hash of doc_id, the same number for every
language; of each, ``TRAIN_WINDOWS`` windows spread over the whole text), and applied to all windows of every whole text in Arrow batches; a
document's probabilities are the mean of its windows' log probabilities.

A filter of width w over one-hot bytes is a sum of w table rows; for scoring the
tables of two neighbouring bytes are added beforehand.

Defined cases: null text and text without a letter get ``und`` and score 0, as
does every text when no labelled row with text exists; with one learned language it is
always that; ties go to the smaller language name; equal texts get equal
results; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from nearrate.llm.common import byte_list, packed, remainder, unpacked

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
TRAIN_DOCS = 1500
TRAIN_WINDOWS = 4
UNKNOWN = "und"


def spread_windows(text: bytes, most: int = TRAIN_WINDOWS, window: int = WINDOW) -> list[bytes]:
    """``most`` of the whole text's windows, evenly spread from its first to its
    last (all, if it has no more); the last is padded by zeros."""
    n = -(-len(text) // window)
    chosen = range(n) if n <= most else [i * (n - 1) // (most - 1) for i in range(most)]
    return [text[i * window : (i + 1) * window].ljust(window, b"\0") for i in chosen]


class ByteNet:
    def __init__(self, languages: list[str], seed: int = 5, filters: int = FILTERS):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = [rng.normal(0, 0.1, (w, 256, filters)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (filters * len(WIDTHS), len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 5) -> None:
        """x: windows as bytes (n, WINDOW); y: language numbers."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.out, self.bias]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), batch):
                rows = order[a : a + batch]
                b = x[rows].astype(np.int64)
                hidden, arg = [], []
                for t in self.tables:
                    w = len(t)
                    s = t[0][b[:, : WINDOW - w + 1]]
                    for i in range(1, w):
                        s = s + t[i][b[:, i : WINDOW - w + 1 + i]]
                    k = s.argmax(1)
                    arg.append(k)
                    hidden.append(np.maximum(np.take_along_axis(s, k[:, None], 1)[:, 0], 0))
                h = np.concatenate(hidden, 1)
                z = h @ self.out + self.bias
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(rows)), y[rows]] -= 1
                dz = p / len(rows)
                dh = (dz @ self.out.T) * (h > 0)
                grads = []
                for j, (t, k) in enumerate(zip(self.tables, arg, strict=True)):
                    n = t.shape[2]
                    d, g = dh[:, j * n : (j + 1) * n], np.zeros_like(t)
                    col = np.arange(n)[None, :].repeat(len(rows), 0)
                    for i in range(len(t)):
                        np.add.at(g[i], (np.take_along_axis(b, k + i, 1), col), d)
                    grads.append(g)
                grads += [h.T @ dz, dz.sum(0)]
                step += 1
                for q, (param, g) in enumerate(zip(params, grads, strict=True)):
                    m[q] += 0.1 * (g - m[q])
                    v[q] += 0.001 * (g * g - v[q])
                    param -= rate * (m[q] / (1 - 0.9**step)) / (np.sqrt(v[q] / (1 - 0.999**step)) + 1e-8)

    def prepare(self) -> None:
        """Tables over pairs of bytes, for scoring."""
        self.pairs = []
        for t in self.tables:
            parts = [((t[i][:, None, :] + t[i + 1][None, :, :]).reshape(65536, -1), i, True) for i in range(0, len(t) - 1, 2)]
            if len(t) % 2:
                parts.append((t[-1], len(t) - 1, False))
            self.pairs.append((len(t), parts))

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        one = x.astype(np.intp)
        two = one[:, :-1] * 256 + one[:, 1:]
        hidden = []
        for w, parts in self.pairs:
            n, s = WINDOW - w + 1, None
            for t, i, paired in parts:
                piece = t.take((two if paired else one)[:, i : i + n], axis=0)
                s = piece if s is None else np.add(s, piece, out=s)
            hidden.append(np.maximum(s.max(1), 0))
        z = np.concatenate(hidden, 1) @ self.out + self.bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def fit(docs: DataFrame, per_language: int = TRAIN_DOCS) -> ByteNet | None:
    """Train on at most ``per_language`` documents of each language, of those
    whose crc32(doc_id) mod 5 is not 0; the languages are counted over all."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
    total = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    names = sorted(total)
    if not names:
        return None
    # a hash threshold leaves a few times the wanted number, of which the smallest hashes count
    part = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(min(1.0, 3.0 * per_language / total[name])))])
    h = F.xxhash64("doc_id", F.lit(5))
    some = known.where(F.pmod(h, F.lit(1 << 20)) < part[F.col("lang")] * (1 << 20)).select("lang", h.alias("h"), "text")

    def spread(batches):
        import pyarrow as pa
        for b in batches:
            chosen = [spread_windows(t or b"") for t in byte_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("h"), pa.array(chosen, pa.list_(pa.binary()))], names=["lang", "h", "w"])

    some = (some.mapInArrow(spread, "lang string, h long, w array<binary>").where(F.size("w") > 0)
            .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "w"))).where(F.col("n") <= per_language))
    # per_language * TRAIN_WINDOWS windows of a language at most
    rows = sorted((r["lang"], r["h"], [bytes(w) for w in r["w"]]) for r in some.collect())
    x = [np.frombuffer(w, np.uint8) for _, _, ws in rows for w in ws]
    y = [names.index(name) for name, _, ws in rows for _ in ws]
    if not x:
        return None
    net = ByteNet(names)
    net.train(np.stack(x), np.array(y))
    net.prepare()
    return net


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """``docs`` (all columns) with lang_pred and score."""
    cols = docs.columns
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    letter = docs.select("*", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter_"))

    def task(batches):
        import pyarrow as pa
        for b in batches:
            texts, letters = byte_list(b.column("text")), b.column("has_letter_").to_pylist()
            pred, score = [UNKNOWN] * b.num_rows, [0.0] * b.num_rows
            if net is not None:
                for i, total in document_scores(net, [t if ok else None for t, ok in zip(texts, letters, strict=True)]):
                    p = np.exp(total - total.max())
                    p /= p.sum()
                    k = int(p.argmax())
                    pred[i], score[i] = net.languages[k], float(p[k])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in cols], pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*cols, "lang_pred", "score"])

    return letter.mapInArrow(task, schema)


def document_scores(net: ByteNet, texts: list[bytes | None], at_once: int = 512):
    """(index, mean log probabilities) of each text; windows go through the
    network ``at_once`` at a time, whatever the lengths."""
    held: list[bytes] = []
    owner: list[int] = []
    sums, counts = {}, {}

    def flush():
        if held:
            lp = net.log_probabilities(np.frombuffer(b"".join(held), np.uint8).reshape(len(held), WINDOW))
            o = np.array(owner)
            for i in np.unique(o):
                sums[i] = sums.get(i, 0) + lp[o == i].sum(0)
            held.clear()
            owner.clear()

    for i, t in enumerate(texts):
        if t:
            counts[i] = -(-len(t) // WINDOW)
            for a in range(0, len(t), WINDOW):
                held.append(t[a : a + WINDOW].ljust(WINDOW, b"\0"))
                owner.append(i)
                if len(held) == at_once:
                    flush()
    flush()
    for i, total in sums.items():
        yield int(i), total / counts[int(i)]


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    net = fit(docs)
    held = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return predict(docs.select("doc_id", "text", held), net).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents with an identified language, unchanged: ``und`` and scores
    under ``least`` are rejected."""
    kept = predict(packed(docs, "text"), fit(docs)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return unpacked(kept)
