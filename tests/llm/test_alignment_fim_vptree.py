"""Operators 11 to 13 against plain brute force."""
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from nearrate.llm import alignment, fim, vptree
from nearrate.llm.queries import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def brute_alignment(texts):
    """Whole texts, offsets as sets, every pair of tokens looked at."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_of = Tokenizer.from_file(tokenizer_path(A))
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    names = {i: t for t, i in a_of.get_vocab().items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def bytes_b(i):
        p = b_of.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_of.is_byte(i) else p.replace("▁", " ").encode()

    made, count = [], Counter()
    for t in texts:
        a, b = (a_of.encode(" " + t, add_special_tokens=False).ids, b_of.encode(t)) if t else ([], [])
        parts_a, parts_b = [bytes(letters[c] for c in names[i]) for i in a], [bytes_b(i) for i in b]
        if not t or b"".join(parts_a) != (" " + t).encode() or b"".join(parts_b) != (" " + t).encode():
            made.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in parts_a]), np.cumsum([len(x) for x in parts_b])
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = (int(np.searchsorted(x, end, "right")) for x in (ends_a, ends_b))
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j = k, m
        links = [(x, y) for x, p in zip(a, ends_a, strict=True) for y, q in zip(b, ends_b, strict=True) if p == q] if len(a) < 400 else [
            (a[int(np.searchsorted(ends_a, e))], b[int(np.searchsorted(ends_b, e))]) for e in sorted(set(ends_a) & set(ends_b))]
        count.update(links)
        made.append((len(a), len(b), groups, links))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if m is None else
            (m[0], m[1], len(m[2]), len(m[3]), sum(count[x] == best[x[1]] for x in m[3]), sum(count[x] for x in m[3]), hashlib.sha256(";".join(m[2]).encode()).hexdigest())
            for m in made]


def odd_texts(n):
    rng = random.Random(5)
    parts = [*" \n\t\r  ab1.,'é中文😀  ▁\x1c\x85　İß", "  ", "'s", "<s>", "</s>", "<0x41>", "<|endoftext|>", " the", " and", "ing ", "hello", "\x00"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(n)]


FACTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("frequent", [20, 100_000])
def test_alignment(docs_of, messy, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    rows = [*messy, *((100 + i, t) for i, t in enumerate(odd_texts(300)))]
    got = alignment.report(docs_of(rows), tokenizer_path(A), tokenizer_path(B)).select("doc_id", *FACTS).collect()
    want = [(r[0], *x) for r, x in zip(rows, brute_alignment([r[1] for r in rows]), strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_alignment_whole_texts_equal_segments():
    cut, whole = (alignment.Aligner(tokenizer_path(A), tokenizer_path(B)) for _ in range(2))
    assert cut.v.cuts
    whole.v.cuts = False
    texts = [t.encode() for t in odd_texts(200)] + ["the cat's 12 dogs  ran".encode(), b"", None]
    for x, y in zip(cut(texts), whole(texts), strict=True):
        assert list(x) == list(y)


def test_alignment_table_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_SEGMENTS", 3)
    work = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    free = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    for t in (b"one two three four five", b"six seven", b"one two"):
        monkeypatch.setattr(alignment, "KNOWN_SEGMENTS", 3)
        got = work([t])
        monkeypatch.setattr(alignment, "KNOWN_SEGMENTS", 1000)
        assert got[3] == free([t])[3]
    assert len(work.groups) <= 5


def test_alignment_empty(docs_of):
    assert alignment.report(docs_of([]), tokenizer_path(A), tokenizer_path(B)).count() == 0


def plain_fim(doc_id, text, seed="7", rate=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text or "", text or ""
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return n, form, len(p), len(m), out, text


def fim_rows():
    rng = random.Random(3)
    parts = ["a", "é", "中", "\n", "\n\n", "\r\n", "<", "<P", "<S", ">", "M>", "<M", " word", " ", "x" * 50]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return [(i, t) for i, t in enumerate(texts)] + [(200, "é" * 9001 + "\n" + "<" * 9000), (201, "x\n" * 9000), (202, "has <P> in it\nx"), (-5, "a\nb\n")]


@pytest.mark.parametrize("rate, spm", [(100, 50), (60, 0)])
def test_fim(docs_of, messy, rate, spm):
    rows = [*messy, *((i, t) for i, t in fim_rows())]
    docs = docs_of(rows)
    got = fim.report(docs, rate=rate, spm=spm).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t, *_ in rows:
        *facts, out, text = plain_fim(i, t, "7", rate, spm)
        want.append((i, *facts, sha(out), sha(text)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    output = fim.pieces(docs, rate=rate, spm=spm)
    assert sorted(repr(r["text"]) for r in fim.assembled(output).collect()) == sorted(repr(plain_fim(i, t, "7", rate, spm)[4]) for i, t, *_ in rows)
    assert sorted(repr(r["text"]) for r in fim.assembled(fim.restored(output)).collect()) == sorted(repr(t or "") for _, t, *_ in rows)


def test_fim_pieces_are_bounded_units(docs_of):
    made = fim.pieces(docs_of(fim_rows())).collect()
    assert max(len(r["piece"]) for r in made) <= fim.PIECE + 3
    # a text of short lines is cut at lines alone
    doc = {r["rid"] for r in made if r["doc_id"] == 201}
    assert all(bytes(r["piece"]).endswith((b"\n", b"<P>", b"<S>", b"<M>")) for r in made if r["rid"] in doc)


def test_fim_empty(docs_of):
    assert fim.report(docs_of([])).count() == 0


def test_fim_reader_finds_marks_across_pieces():
    out = b"<S>suf<fix<P>pre<M>mid<"
    for step in (1, 2, 3, 5, 50):
        reader, found = fim.Reader("spm"), []
        for i in range(0, len(out), step):
            found += reader.feed(out[i : i + step])
        found += reader.close()
        assert b"".join(x for _, x in sorted(found)) == b"premid<suf<fix"


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        *(T.StructField(x, T.StringType()) for x in ("point", "cell", "v", "rid"))])


def vectors(n=700, size=6):
    rng = random.Random(9)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(n)]
    crowd = [0.5] * size
    rows += [(n + i, crowd) for i in range(300)]  # copies, queries among them
    rows += [(n + 300 + i, [x * 2 for x in crowd]) for i in range(30)]
    rows += [(None, crowd), (50_000, None), (50_050, [0.0] * size), (50_100, [float("nan")] + crowd), (50_150, [None, 1.0]), (50_200, [float("inf")]),
             (50_250, [1.0]), (50_300, [1.0, 0.0, 0.0] * 9), (50_350, [3e38] * size), (50_400, [1e-44] * size), (50_450, []), (777, crowd)]
    return rows


def brute_nearest(rows, k=5, every=50):
    ok = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and v and None not in v]
    ok = [(i, v) for i, v in ok if all(map(math.isfinite, v)) and any(v)]
    norm = [math.sqrt(math.fsum(x * x for x in v)) for _, v in ok]
    out = []
    for a, (i, v) in enumerate(ok):
        if i % every == 0:
            near = sorted((-round(math.fsum(x * y for x, y in zip(v, w, strict=False)) / norm[a] / norm[b], 9), j) for b, (j, w) in enumerate(ok) if b != a)
            out += [(i, r + 1, -s) for r, (s, _) in enumerate(near[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def vector_table(spark):
    return spark.createDataFrame([(i, v, "p", "c", "v", "r") for i, v in vectors()], VECTORS)


def test_nearest_factor_one_is_exact(vector_table, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_BYTES", 4096)
    monkeypatch.setattr(vptree, "BLOCK_BYTES", 512)
    monkeypatch.setattr(vptree, "LEAF", 5)
    monkeypatch.setattr(vptree, "SALT_ROWS", 2)
    got = vptree.search(vector_table, factor=1.0).collect()
    assert sorted((r["query_id"], r["rank"], round(r["score"], 9)) for r in got) == brute_nearest(vectors())
    crowd = [r for r in got if 700 <= r["query_id"] < 1000]
    for r in crowd:  # ties go to the smallest ids
        assert r["vec_id"] == [i for i in range(700, 706) if i != r["query_id"]][r["rank"] - 1]


def test_nearest_recall(vector_table):
    got = {(r["query_id"], r["rank"]): r["score"] for r in vptree.search(vector_table).collect()}
    want = brute_nearest(vectors())
    hits = sum(got.get((i, r), -2) >= s - 1e-6 for i, r, s in want)
    assert hits >= 0.97 * len(want)


def test_nearest_prunes():
    """Branches are left out, fewer with a smaller factor, and none wrongly at one."""
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.05, (400, 4)) for c in rng.normal(0, 1, (10, 4))])
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = vptree.Tree(points, 16)
    q, seen = points[::40], {}
    for factor in (1.0, 3.0):
        near = np.sort(vptree.distances(q, points), 1)[:, 4]
        seen[factor] = sum(len(rows) * (tree.last[node] - tree.first[node]) for node, rows in tree.visit(q, near, factor))
    assert seen[3.0] < seen[1.0] < 0.3 * len(q) * len(points)


def test_nearest_small_tables(spark):
    assert vptree.search(spark.createDataFrame([], VECTORS)).count() == 0
    rows = [(0, [1.0, 0.0], *"pcvr"), (1, [0.0, 1.0], *"pcvr"), (2, [-1.0, 0.0], *"pcvr")]
    got = vptree.search(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 1), (0, 2, 2)]
