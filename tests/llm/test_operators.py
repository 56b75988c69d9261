"""Each operator against a plain brute force on a small table with odd rows."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearrate.llm import decontam, jaccard, language, licenses, lm, mixing, repeats, tokens_out, topk, toxicity
from nearrate.llm.queries import tokenizer_path

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
rows = lambda df: [r.asDict() for r in df.collect()]
mod = lambda i, m: zlib.crc32(("" if i is None else str(i)).encode()) % m


def targets_plainly(size):
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(size.values()), set(names)
    while left > 1e-6 and open_:
        total, before = sum(weight[s] for s in open_), dict(target)
        for s in open_:
            target[s] = min(2 * size[s], before[s] + left * weight[s] / total)
        left -= sum(target[s] - before[s] for s in open_)
        open_ = {s for s in open_ if target[s] < 2 * size[s] - 1e-9}
    return target


def test_mixing(docs_of, messy):
    got = rows(mixing.mixed(docs_of(messy)))
    assert sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t, *_ in messy)
    size = defaultdict(int)
    for _, t, _, s in messy:
        size[s] += len(words(t))
    target = targets_plainly(size)
    names = list(target)
    by_size = {size[s]: target[s] for s in names}
    taken = defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(by_size[r["source_size"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - by_size[s]) <= 2 * mixing.BLOCK_WORDS
    again = rows(mixing.mixed(docs_of(messy)))
    order = lambda x: sorted(map(repr, x))
    assert order(got) == order(again)
    mixed = mixing.mix_texts(docs_of(messy))
    assert sum(len(words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in got)


def test_sainte_lague(spark):
    rng = random.Random(3)
    for _ in range(4):
        votes = [rng.choice([0, 1, 5, 100, 1000, 7777]) for _ in range(9)]
        seats = rng.randint(0, 60)
        df = spark.createDataFrame([(0, i, float(v), seats) for i, v in enumerate(votes)], "g int, id int, votes double, seats long")
        got = {r["id"]: r["quota"] for r in mixing.apportion(df, ["g"], "id", "votes", "seats").collect()}
        want = Counter(i for _, i, _ in sorted((-v / (2 * k - 1), i, k) for i, v in enumerate(votes) if v for k in range(1, seats + 1))[:seats])
        assert {i: want[i] for i in range(9)} == got


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vec = [(int(i), rng.normal(size=8).round(1).tolist()) for i in range(130)]
    vec += [(3, vec[3][1]), (50, vec[50][1]), (200, None), (201, [1.0, None]), (202, [float("nan")] * 8), (None, vec[0][1]), (203, []), (204, vec[7][1][:5])]
    df = spark.createDataFrame(vec, "vec_id long, embedding array<double>")
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in vec if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for n, (i, v) in enumerate(ok):
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for m, (j, w) in enumerate(ok) if m != n)[:5]
            want += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df).collect()]
    assert sorted(got) == sorted(want)
    assert topk.search(df.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    """Scores near the edge of 64 bits are exact, beyond it the query fails."""
    rng = np.random.default_rng(5)
    big = 2.0**21  # 256 * big squared, eight times, is under 2^63
    vec = [(int(i), (np.round(rng.uniform(-1, 1, 8) * big) * rng.choice([-1, 1])).tolist()) for i in range(60)] + [(60, [big] * 8), (100, [big, -big] * 4)]
    ok = [(i, [int(256 * x) for x in v]) for i, v in vec]
    want = set()
    for i, v in ok:
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in ok if j != i)[:5]
            want |= {(i, r + 1, j, -n) for r, (n, j) in enumerate(s)}
    df = spark.createDataFrame(vec, "vec_id long, embedding array<double>")
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df).collect()} == want
    with pytest.raises(Exception, match="too large"):
        topk.search(spark.createDataFrame([(0, [1e300, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")).collect()


def test_decontamination(spark, docs_of, messy):
    t = {i: x for i, x, *_ in messy}
    item = words(t[7])
    bench = [(1, " ".join(item[5:40])), (2, "Nothing of this stands in any document at all, really nothing."), (3, "b c"), (None, " ".join(item[50:65])), (4, None), (5, ""), (10, " ".join(item[5:40]))]
    df = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["doc_id"], r["n_words"]): r for r in rows(decontam.report(docs_of(messy), df))}
    terms = lambda x: TERM.findall((x or "").translate(LOW))
    for i, x, *_ in messy:
        w, hit, ids = terms(x), set(), set()
        for b, y in bench:
            v = terms(y)
            for a in range(max(len(v) - 9, 1) if v else 0):
                win = v[a : a + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p : p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        ids.add(b)
        names = sorted(str(b) for b in ids if b is not None)
        r = got[i, len(w)]
        assert (r["n_hit"], r["n_items"], r["contaminated"]) == (len(hit), len(names), bool(hit)), i
        assert r["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
    assert got[7, len(terms(t[7]))]["n_hit"] > 30
    kept = decontam.clean(docs_of(messy), df)
    assert kept.columns == docs_of(messy).columns and 7 not in {r["doc_id"] for r in kept.collect()}
    assert decontam.report(docs_of(messy), df.limit(0)).where("contaminated").count() == 0
    assert decontam.report(docs_of(messy).limit(0), df).count() == 0


def test_decontamination_proximity(spark, docs_of):
    rng = random.Random(3)
    item = [f"w{i}" for i in range(14)]
    swapped = item[:]
    swapped[3], swapped[6] = swapped[6], swapped[3]
    texts = [" ".join(item), " ".join(swapped), " ".join(item[:7] + ["x"] * 4 + item[7:]), " ".join(item[:7] + ["x"] * 6 + item[7:]),
             " ".join(item[4:]), " ".join(reversed(item)), "a b " * 3000, "a " * 40 + "b " * 40, None, ""]
    texts += [" ".join(rng.choice([*item, "a", "b"]) for _ in range(200)) for _ in range(6)]
    bench = [(1, " ".join(item)), (2, "a b a b a b a b a b a"), (3, "b a"), (4, "w3"), (5, None)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    ws = [(i, TERM.findall((t or "").translate(LOW))) for i, t in docs]
    count = Counter(x for _, w in ws for x in w)
    windows = {tuple(v[a : a + 10]) for _, y in bench for v in [TERM.findall(y or "")] for a in range(max(len(v) - 9, 1) if v else 0)}
    got = {r["doc_id"]: r["n_near"] for r in rows(decontam.report(docs_of(docs), spark.createDataFrame(bench, "item_id long, text string")))}
    for i, w in ws:
        n = 0
        for win in windows:
            _, term, off = min((count[x], x, o) for o, x in enumerate(win))
            n += sum(all(x in w[max(p - off + j - 5, 0) : p - off + j + 6] for j, x in enumerate(win)) for p in range(off, len(w)) if w[p] == term)
        assert got[i] == n, i
    assert got[0] == 6 and got[1] == 6 and got[5] < 6 and got[6] > 5000


def test_repeats(docs_of, messy):
    got = {(r["doc_id"], r["n_words"]): r for r in rows(repeats.deduplicate(docs_of(messy)))}
    first = {}
    for i, t, *_ in messy:
        w = words(t)
        for p in range(len(w) - 49):
            if i is not None:
                s = tuple(w[p : p + 50])
                first[s] = min(first.get(s, i), i)
    for i, t, *_ in messy:
        w, gone = words(t), set()
        for p in range(len(w) - 49):
            if i is not None and first[tuple(w[p : p + 50])] < i:
                gone.update(range(p, p + 50))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        r = got[i, len(w)]
        assert (r["n_removed"], r["kept"]) == (len(gone), kept), i
        assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert got[2, 120]["n_removed"] == 120 and got[8, 240]["n_removed"] >= 120
    assert repeats.deduplicate(docs_of(messy).limit(0)).count() == 0


def repeats_plainly(made, length):
    first = {}
    for i, t in made:
        w = words(t)
        for p in range(len(w) - length + 1):
            s = tuple(w[p : p + length])
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, t in made:
        w = words(t)
        out[i] = {q for p in range(len(w) - length + 1) if first[tuple(w[p : p + length])] < i for q in range(p, p + length)}
    return {i: (len(words(t)), len(out[i]), " ".join(x for n, x in enumerate(words(t)) if n not in out[i])) for i, t in made}


@pytest.mark.parametrize("group", [1, 60, 1 << 14])
def test_repeats_in_groups_of_any_size(docs_of, monkeypatch, group):
    """Groups that fit at once, after longer prefixes, and never."""
    rng = random.Random(group)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(30, 90))] for _ in range(6)]
    made = []
    for i in range(40):
        w = []
        for _ in range(rng.randint(1, 4)):
            w += rng.choice(passages) if rng.random() < 0.7 else [f"x{rng.randint(0, 99)}" for _ in range(rng.randint(1, 60))]
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = "y"
        made.append((i, " ".join(w)))
    made += [(40, " ".join(["a"] * 1500)), (41, " ".join(["a"] * 700)), (42, " ".join(["a", "b"] * 60)), (43, " ".join(["b", "a"] * 60))]
    sizes, real = [], repeats.trees

    def trees(groups, length):
        sizes.extend(r[0] for r in groups.groupBy("prefix").agg(F.sum(F.size("words") - F.lit(length - 1))).select("sum((size(words) - %d))" % (length - 1)).collect())
        return real(groups, length)
    monkeypatch.setattr(repeats, "trees", trees)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows(repeats.deduplicate(docs_of(made), 20, 5, group=group))}
    assert got == repeats_plainly(made, 20)
    assert all(n <= group for n in sizes) and (sizes or group == 1)


def test_repeats_trees_against_plain_search():
    from nearrate.llm.text import word_hashes
    rng = random.Random(3)
    parts = [[rng.choice("ab") for _ in range(rng.randint(3, 40))] for _ in range(60)]
    group, least = np.array([rng.randint(0, 3) for _ in parts]), np.array([rng.randint(0, 9) for _ in parts])
    hashes, offsets = word_hashes([" ".join(p).encode() for p in parts])
    for length in (4, 7, 11):
        lowest = {}
        for g, d, p in zip(group, least, parts, strict=True):
            for o in range(len(p) - length + 1):
                s = (g, *p[o : o + length])
                lowest[s] = min(lowest.get(s, d), d)
        want = {(i, o) for i, p in enumerate(parts) for o in range(len(p) - length + 1) if lowest[(group[i], *p[o : o + length])] < least[i]}
        assert set(zip(*(x.tolist() for x in repeats.open_nodes(group, least, offsets, hashes, length)), strict=True)) == want and want


def test_jaccard(docs_of, messy):
    got = rows(jaccard.join(docs_of(messy)))
    sets = []
    for i, t, *_ in messy:
        w = [x.translate(LOW) for x in words(t)]
        sets.append((i, {tuple(w[p : p + 4]) for p in range(max(len(w) - 3, 1))} if w else set()))
    linked = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 85 * len(a | b)
    want = []
    for n, (i, s) in enumerate(sets):
        reach, todo = {n}, [n]
        while todo:
            x = todo.pop()
            new = [m for m in range(len(sets)) if m not in reach and linked(sets[x][1], sets[m][1])]
            reach.update(new)
            todo += new
        ids = [sets[m][0] for m in reach if sets[m][0] is not None]
        want.append((i, len(s), min(ids) if ids else None, sum(linked(s, sets[m][1]) for m in range(len(sets)) if m != n)))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == Counter(want)
    kept = jaccard.keep_one(docs_of(messy))
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert kept.columns == docs_of(messy).columns
    assert jaccard.join(docs_of(messy).limit(0)).count() == 0


def test_jaccard_many_near_copies(docs_of):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    made = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 14)):
            w[rng.randrange(400)] = f"x{rng.randint(0, 10**6)}"
        made.append((i, " ".join(w)))
    got = {r["doc_id"]: r for r in rows(jaccard.join(docs_of(made)))}
    sets = {i: {tuple(t.split()[p : p + 4]) for p in range(397)} for i, t in made}
    for i, s in sets.items():
        links = sum(100 * len(s & o) >= 85 * len(s | o) for j, o in sets.items() if j != i)
        assert got[i]["n_links"] == links


def test_keep_one_of_each_component_whatever_the_ids(docs_of):
    rng = random.Random(11)
    text = lambda: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(80))
    a, b, c, d, e, f, g = (text() for _ in range(7))
    near = " ".join(["new", *d.split()[1:]])
    made = [(None, a), (None, b), (None, b), (9, c), (9, d), (4, near), (None, near), (9, e), (9, e), (None, None), (None, None), (7, ""), (7, ""),
            (2, f), (None, f), (3, " ".join([*f.split()[:-1], "end"])), (2, g)]
    got = [(r["doc_id"], r["text"]) for r in rows(jaccard.keep_one(docs_of(made)))]
    assert Counter(got) == Counter([(None, a), (None, b), (9, c), (4, near), (9, e), (None, None), (None, None), (7, ""), (7, ""), (2, f), (2, g)])


def test_token_files(docs_of, messy, tmp_path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    more = [*messy, (20, "It's <|endoftext|> don'T x'll İI ñ é ﬁ 12a!?"), (21, "naïve Ünïcode　wide\u0085next")]
    got = rows(tokens_out.round_trip(docs_of(more), tokenizer_path()))
    encode = lambda x: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
    want = Counter((i, len(e := encode(x)), zlib.crc32(e.tobytes())) for i, x, *_ in more)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]).tolist()
    assert [r["doc_id"] or -1 for r in got] == sorted(-1 if i is None else i for i, *_ in more)
    assert tokens_out.round_trip(docs_of(more).limit(0), tokenizer_path()).count() == 0


def test_frames_are_random_access(tmp_path, monkeypatch):
    monkeypatch.setattr(tokens_out, "FRAME_IDS", 50)
    docs = [np.arange(i * 7 % 40, dtype="<u4") for i in range(100)]
    fs, root = tokens_out.open_fs(f"file://{tmp_path}")
    w = tokens_out.FrameWriter(fs.open_output_stream(f"{root}/a.ids"))
    for d in docs:
        w.add(d)
    w.close()
    r = tokens_out.FrameReader(f"file://{tmp_path}/a.ids")
    assert len(r.entries) > 10
    assert all((a == b).all() for a, b in zip(r.documents(37, 60), docs[37:60], strict=True))
    data = bytearray((tmp_path / "a.ids").read_bytes())
    data[r.entries[3][0] + 8] ^= 1
    (tmp_path / "b.ids").write_bytes(data)
    with pytest.raises(ValueError, match="damaged"):
        list(tokens_out.FrameReader(f"file://{tmp_path}/b.ids").documents(0, 100))


def licenses_by_hand(text, templates=None):
    """Labels and score from every block's word set, without any filter."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at = {x: [p for p in range(len(w)) if w[p : p + len(k.split())] == k.split()] for k, x in licenses.PHRASES.items()}
    base = sorted(x for x in at if at[x])
    best, more = 0.0, set(base)
    for label, t in licenses.template_words(templates):
        n = licenses.block_of(len(t))
        pairs = {*zip(t, t[1:])}
        for a in range(0, max(len(w) - n // 2, 1), n // 2):
            block = w[a : a + n]
            share = len(set(t) & set(block)) / len(set(t))
            beside = len(pairs & {*zip(block, block[1:])})
            if share >= licenses.CONTAINMENT - 1e-9 and beside >= math.ceil(licenses.PAIRS * len(pairs) - 1e-9):
                more.add(label)
                best = max(best, share)
    starts = sum(at.values(), [])
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted(more)), 1.0 if base else best)


def test_licenses(docs_of, messy):
    long = licenses.TEMPLATES["mit"][1]
    more = [*messy, (30, "Released UNDER the (MIT) License. Also under the mit license"), (31, "licensed under CC BY-NC 4.0 and Apache License, Version 2.0."),
            (32, "x " * 500 + long + " y" * 300), (33, "mit license the under"), (34, "This work is licensed under the GNU General Public License, version 3."),
            (35, "The book was released last year, under review; see the notes on mit students"),
            (36, long[:400]), (37, " ".join(reversed(long.split()))), (38, "a b " * 200 + long.replace("Software", "Program"))]
    more += [(100 + 10 * i + j, "q " * pad + text + " z" * pad) for i, (_, text) in enumerate((x, t) for x, ts in licenses.TEMPLATES.items() for t in ts)
             for j, pad in enumerate((0, 7, 130))]
    got = {(r["doc_id"], r["n_words"]): r for r in rows(licenses.scan(docs_of(more)))}
    for i, text, *_ in more:
        want = licenses_by_hand(text)
        r = got[i, want[0]]
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")) == want[:6], text
        assert r["score"] == pytest.approx(want[6])
    labels = {i: r["labels"] for (i, _), r in got.items()}
    assert labels[35] == labels[33] == labels[37] == "" and labels[32] == "mit" and labels[34] == "gpl-3"
    for i, (label, _) in enumerate((x, t) for x, ts in licenses.TEMPLATES.items() for t in ts):
        assert all(label in labels[100 + 10 * i + j].split(",") for j in range(3))
    assert licenses.scan(docs_of(more).limit(0)).count() == 0


def test_licenses_template_of_any_length_at_every_offset(docs_of):
    text = " ".join(f"w{i}" for i in range(250))
    docs = docs_of([(i, "pad " * i + text + " end" * 40) for i in range(0, 1100, 23)] + [(5000, "pad " * 400), (5001, " ".join(text.split()[:190]))])
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in rows(licenses.scan(docs, {"own": [text, " ,"]}))}
    assert got.pop(5000) == got.pop(5001) == ("", 0.0)
    assert set(got.values()) == {("own", 1.0)}
    assert {r["labels"] for r in rows(licenses.scan(docs, {}))} == {""}


def test_licenses_filters_reject(spark):
    """The template's words in rising frequency are a to j, and 8 are needed. A
    block with the rare end, one with the frequent end, one with too few."""
    from pyspark.sql import functions as F
    template = "a b c d e f g h i j"
    index = licenses.Index({x: n for n, x in enumerate(template.split())}, {"own": [template], "other": ["k l m n o p q r s t"]})
    tokens = spark.createDataFrame([(1, 1, template.split()), (2, 2, "c d e f g h i j".split()), (3, 3, "a b c d e f g".split()),
                                    (4, 4, "c d e f k l m n o p q r".split())], "doc_id long, key long, words array<string>")
    tried = licenses.candidate_blocks(tokens, index, licenses.block_of(10))
    own = 1
    assert index.entries[own][1] == "own"
    pairs = {(r["doc_id"], r["tid"]) for r in tried.collect()}
    assert {(1, own), (2, own)} <= pairs and (3, own) not in pairs  # 3: fewer than 8 of the words
    # 4 holds 12 known words and the prefix word c, but k to r stand before it: 4 words are left
    assert {t for i, t in pairs if i == 4} == {1 - own}
    assert {(r["doc_id"], r["label"], round(r["share"], 3)) for r in licenses.matching_blocks(tokens, index).collect()} == {
        (1, "own", 1.0), (2, "own", 0.8), (4, "other", 0.8)}


def test_language(spark, docs_of, messy):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.9 and got.score.between(0, 1).all()
    odd = {r["doc_id"]: r for r in rows(language.identify(docs_of(messy)))}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 for i in (4, 5, 6, 12))
    assert odd[1]["lang_pred"] == odd[2]["lang_pred"] and all(odd[i]["held_out"] == (mod(i, 5) == 0) for i in odd)
    none = docs_of([(1, "abc"), (2, None)])
    assert {r["lang_pred"] for r in rows(language.identify(none))} == {"und"}
    empty = docs_of([(i, "", "en") for i in range(9)] + [(9, "abc")])
    assert {r["lang_pred"] for r in rows(language.identify(empty))} == {"und"}
    kept = language.keep_identified(docs_of(messy))
    assert kept.columns == docs_of(messy).columns and not {4, 5, 6, 12} & {r["doc_id"] for r in kept.collect()}
    assert language.identify(none.limit(0)).count() == 0


def test_language_network_against_plain_convolution():
    rng = np.random.default_rng(2)
    net = language.ByteNet(["a", "b", "c"])
    x = rng.integers(0, 256, (40, language.WINDOW)).astype(np.uint8)
    net.train(x, rng.integers(0, 3, 40))
    net.prepare()
    got = net.log_probabilities(x)
    for row, lp in zip(x, got):
        hidden = []
        for table in net.tables:
            one_hot = np.eye(256)[row]
            at = [sum(one_hot[p + j] @ table[j] for j in range(len(table))) for p in range(len(row) - len(table) + 1)]
            hidden.append(np.maximum(np.max(at, 0), 0))
        z = np.concatenate(hidden) @ net.out + net.bias
        assert np.allclose(lp, z - np.log(np.exp(z - z.max()).sum()) - z.max(), atol=1e-3)


def test_language_trains_on_windows_from_all_of_a_text():
    text = bytes(range(1, 200)) * 9
    cut = [text[a : a + 128].ljust(128, b"\0") for a in range(0, len(text), 128)]
    got = language.spread_windows(text)
    assert got[0] == cut[0] and got[-1] == cut[-1] and len(got) == language.TRAIN_WINDOWS and all(w in cut for w in got)
    assert language.spread_windows(text[:300]) == [text[:128], text[128:256], text[256:300].ljust(128, b"\0")] and language.spread_windows(b"") == []


def test_toxicity_matcher_against_plain_search():
    rng = random.Random(4)
    pool = ["".join(rng.choice("abe") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    weights = {f" {w} " if i % 2 else " " + w: 1.0 + i for i, w in enumerate(pool[:24])}
    exceptions = [f"{pool[1]} {pool[30]}", f"{pool[40]} {pool[3]}"]
    s = toxicity.Scorer(weights, exceptions=exceptions)
    for _ in range(200):
        ws = [rng.choice(pool) for _ in range(rng.randint(0, 30))]
        free = {k for i in range(len(ws) - 1) if f"{ws[i]} {ws[i + 1]}" in exceptions for k in (i, i + 1)}
        best = [max([v for e, v in weights.items() if (e == f" {w} " if e.endswith(" ") else w.startswith(e[1:]))], default=0)
                for i, w in enumerate(ws) if i not in free]
        best = [b for b in best if b]
        n = max(len(ws), 1)
        assert s.features(" ".join(ws)) == pytest.approx((math.log1p(sum(best)), math.log1p(len(best)), math.log1p(100 * sum(best) / n), math.log1p(100 * len(best) / n)))


def test_toxicity_learns_rare_words(spark):
    rng = random.Random(5)
    rare = [f"vile{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]
    rows_ = [(i, i % 2, " ".join(rng.choice(["the", "a", "sun", "rain"]) for _ in range(20)) + (" " + rare[i // 2 % 64] if i % 2 else "")) for i in range(6000)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows_], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, y, _ in rows_], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels)
    assert sum(f" {toxicity.fold(w)[0]} " in scorer.weights for w in rare) == 64  # each in 1 of 64 toxic documents
    assert min(scorer.score("the sun " + w) for w in rare) > 0.3 > scorer.score("the sun rain")


def test_toxicity(spark, docs_of, messy):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.detect(docs, labels).join(labels, "doc_id").toPandas()
    clean = got[got.toxic == 0]
    assert clean.predicted.mean() < 0.05 and got[got.toxic == 1].predicted.mean() > 0.6
    odd = docs_of(messy)
    assert toxicity.detect(odd, labels.limit(0)).where("score = 0 and predicted = 0").count() == len(messy)
    s = toxicity.Scorer({" idiot ": 5.0, " vequ": 4.0}, [1.0, 1.0, 0.0, 0.0, -3.0])
    plain, none = s.features("you idiot"), s.features("nothing here")
    assert s.features("you 1D1оT") == plain and s.features("vequta du")[0] > 0 and none == (0.0,) * 4
    assert s.features("an idiot proof way") == none and s.features("idiotic") == none and s.features(None) == none


def test_lm(spark, docs_of, messy, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 40)
    for table in (messy, messy[:0]):
        got = rows(lm.score(docs_of(table), tokenizer_path()))
        train = [t for i, t, *_ in table if mod(i, 7) != 2]
        c = Counter(w.translate(LOW) for t in train for w in words(t))
        n, v, ends = sum(c.values()) + len(train), len(c) + bool(train), len(train)
        want = []
        for i, t, *_ in table:
            w = [x.translate(LOW) for x in words(t)]
            base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
            want.append((i, mod(i, 7) == 2, len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, round(base, 6)))
        assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == Counter(want)
        assert all(r["score"] < 0 for r in got)


def test_lm_shares_count_every_training_word(docs_of, monkeypatch):
    rng = random.Random(13)
    table = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(40))) for i in range(30)]
    fit = lm.fit
    monkeypatch.setattr(lm, "fit", lambda docs, rest, tokenizer: fit(docs, rest, tokenizer, rounds=2, steps=10))
    monkeypatch.setattr(lm, "CLASSES", 21)  # so that most subwords are in REST
    want = {r["doc_id"]: r["score"] for r in rows(lm.score(docs_of(table), tokenizer_path()))}
    monkeypatch.setattr(lm, "FREQUENT", 9)
    got = {r["doc_id"]: r["score"] for r in rows(lm.score(docs_of(table), tokenizer_path()))}
    assert got == pytest.approx(want) and len(want) == 30


def test_lm_model_is_trained_on_every_training_document(spark, docs_of, monkeypatch):
    table = [(i, f"w{i} " * (i % 5 + 1)) for i in range(4000)]
    docs = docs_of(table)
    pieces = lm.training_pieces(docs, {}, tokenizer_path()).collect()
    assert len(pieces) == 4000 and all(r["ids"][-1] == lm.END for r in pieces)
    # over the rounds every window of a partition is taken, and none twice
    rng = np.random.default_rng(3)
    seq = rng.integers(0, lm.REST, 16 * 333).astype(lm.IDS)
    seq[::16] = np.arange(333)  # the window's first wanted id names it
    x, y = lm.windows_of(seq)
    taken = []
    monkeypatch.setattr(lm.AttentionModel, "gradient", lambda self, ids, want: taken.extend(want[:: lm.SCORED]) or {k: np.zeros_like(w) for k, w in self.p.items()})
    for turn in range(4):
        lm.AttentionModel().train(x, y, turn=turn, turns=4)
    assert sorted(taken) == list(range(333))


def test_lm_gradient():
    model, rng = lm.AttentionModel(seed=2), np.random.default_rng(4)
    model.p = {k: w * 5 for k, w in model.p.items()}
    x, y = lm.windows_of(np.append(rng.integers(0, lm.CLASSES, 500), lm.END).astype(lm.IDS))
    want = y.ravel().astype(int)

    def loss():
        model.prepare()
        return -(model.log_likelihoods(x, np.maximum(want, 0)) * (want >= 0)).sum(dtype=float) / (want >= 0).sum()

    g = model.gradient(x.astype(np.int64), want)
    for name, w in model.p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), w.shape)
        mid, ends = w[at], []
        for step in (0.02, -0.02):
            w[at] = mid + np.float32(step)
            ends.append(loss())
        w[at] = mid
        assert (ends[0] - ends[1]) / 0.04 == pytest.approx(g[name][at], rel=0.02), name


def test_lm_unseen_places_have_no_share_and_cost_no_slow_arithmetic():
    """Shares of places that a window's place must not see are 0, not numbers so small
    that products of them are denormal, which processors multiply some 100 times slower."""
    model, seen = lm.AttentionModel(seed=2), []
    x, y = lm.windows_of(np.append(np.random.default_rng(4).integers(0, lm.CLASSES, 500), lm.END).astype(lm.IDS))
    model.prepare()
    model.mask = Spy(model.mask, seen)
    model.log_likelihoods(x, np.maximum(y.ravel(), 0))
    model.gradient(x.astype(np.int64), y.ravel().astype(int))
    assert len(seen) == 2 and all((s[:, 0, -1] == 0).all() and (s[:, -1] > 0).any() for s in seen)


class Spy:
    """A mask; when it is added to scores, these are kept, so that their shares can be read later."""

    def __init__(self, mask, seen):
        self.mask, self.seen = mask, seen

    def __getitem__(self, rows):
        part, seen = self.mask[rows], self.seen

        class Part(np.ndarray):
            __array_priority__ = 1

            def __array_ufunc__(self, ufunc, method, *inputs, **more):
                if more.get("out"):
                    seen.append(more["out"][0])
                return getattr(ufunc, method)(*[np.asarray(i) for i in inputs], **more)

        return part.view(Part)


def test_lm_rest_shares_travel_without_counts():
    import pickle
    rest = lm.RestShares({7: 0}, 6)
    rest.add([1, 2, 7, 3], 9)
    sent = pickle.loads(pickle.dumps(rest))
    assert not sent.pairs and not sent.alone and sent.log10([1, 2, 7, 3]) == rest.log10([1, 2, 7, 3])


def test_lm_rest_shares():
    rest = lm.RestShares({7: 0}, 6)  # ids 1 to 5 are in REST, 7 is a class
    for ids, times in (([1, 2, 7, 3], 9), ([2], 4), ([7, 1], 2)):
        rest.add(ids, times)
    for last in (None, 1, 2, 7, 5):
        front = [] if last is None else [last]
        before = rest.log10(front)
        assert sum(10 ** (rest.log10([*front, i]) - before) for i in range(1, 6)) == pytest.approx(1)
    assert rest.log10([7]) == 0 and rest.log10([7, 3]) > rest.log10([1, 3]) - rest.log10([1])


def test_lm_model_is_as_good_as_word_counts_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = lm.score(docs, tokenizer_path()).where("held_out").agg(*[F.sum(c) for c in ("score", "base_score", "n_tokens")]).first()
    assert got[0] / got[2] > got[1] / got[2]


def test_lm_scores_each_token_once():
    model = lm.AttentionModel(seed=1)
    model.prepare()
    rng = np.random.default_rng(2)
    seq = np.append(rng.integers(0, lm.CLASSES, 70), lm.END).astype(lm.IDS)
    got = lm.Scorer(model, lm.RestShares({}, 10), "").scores([(seq, 0.0), (seq[-1:], -1.0)])
    total, gap = 0.0, lm.CONTEXT - lm.SCORED
    for i, want in enumerate(seq):
        start = i - i % lm.SCORED - gap
        ids = [lm.PAD if p < 0 or p > len(seq) else lm.BEGIN if p == 0 else seq[p - 1] for p in range(start, start + lm.CONTEXT)]
        z, _ = model.states(np.array([ids]))
        h, p = z[0, i - start].astype(float), model.p
        a, b = h @ p["group"] + p["group_bias"], h @ p["place"][want // lm.MEMBERS] + p["place_bias"][want // lm.MEMBERS]
        total += a[want // lm.MEMBERS] - np.log(np.exp(a).sum()) + b[want % lm.MEMBERS] - np.log(np.exp(b).sum())
    assert got[0] == pytest.approx(total / math.log(10), rel=1e-4)


def test_pipeline_stages(spark, docs_of, messy):
    import corpus_pipeline
    docs = docs_of(messy)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "decontamination", "mixing", "token_files"]
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.STAGES[4][1](spark, docs, "/root/testdata/sf0.001")
    assert last.count() == docs.count()


def without_near_copies(made):
    """Of each component of documents that share 80% of five-word shingles the
    smallest id; those without words all stay."""
    sets = []
    for _, t, *_ in made:
        w = [x.translate(LOW) for x in words(t)]
        sets.append({tuple(w[p : p + 5]) for p in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(made)))

    def top(n):
        return n if root[n] == n else top(root[n])
    for a in range(len(made)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    groups = defaultdict(list)
    for n, row in enumerate(made):
        groups[top(n)].append(row)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def without_passages(made, items):
    terms = lambda t: TERM.findall((t or "").translate(LOW))
    windows = {tuple(w[p : p + 10]) for w in map(terms, items) if w for p in range(max(len(w) - 9, 1))}
    holds = lambda w: any(tuple(w[p : p + n]) in windows for n in {len(x) for x in windows} for p in range(len(w) - n + 1))
    return [r for r in made if not holds(terms(r[1]))]


def test_pipeline_keeps_what_plain_python_keeps(spark, docs_of, messy, tmp_path):
    """Each stage on all that the stage before it kept, then run()."""
    import corpus_pipeline
    from tokenizers import Tokenizer
    rng = random.Random(31)
    text = lambda n: " ".join(f"{rng.choice('abcdefg')}{rng.choice('aeiou')}{rng.randint(0, 400)}" for _ in range(n))
    passage, phrase = text(30), "Seven Rare words"
    near = text(200).split()
    more = [(100 + i, text(rng.randint(5, 90)), "en", "abc"[i % 3]) for i in range(12)]
    more += [(130, f"{text(20)} {passage[:90]} {text(5)}", "en", "a"), (131, f"{text(9)} seven, RARE words! {text(9)}", "de", "b"), (132, f"seven rare {text(4)}", "fr", "c")]
    more += [(140 + i, " ".join([*near[: 20 * i], "changed", *near[20 * i + 1 :]]), "en", "a") for i in range(4)] + [(150, "5 6 7 8", "en", "a")]
    made, items = messy + more, [passage, phrase, None, "", passage]
    folder = str(tmp_path)
    docs_of(made).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(f"i{n}", t) for n, t in enumerate(items)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")

    def stage(name, given):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs_of(given), folder)
        assert out.columns == docs_of(given).columns
        return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in out.collect()]
    # three languages: the likeliest always has a third, so that a letter is what counts
    kept = [r for r in made if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter(stage("language", made)) == Counter(kept) and len(kept) < len(made)
    before, kept = kept, without_near_copies(kept)
    assert Counter(stage("near_copies", before)) == Counter(kept) and len(before) - len(kept) == 6
    before, kept = kept, without_passages(kept, items)
    assert Counter(stage("decontamination", before)) == Counter(kept) and {r[0] for r in before} - {r[0] for r in kept} == {130, 131}

    mixed = stage("mixing", kept)
    size, taken, of = defaultdict(int), defaultdict(int), {r[0]: r for r in kept}
    for _, t, _, s in kept:
        size[s] += len(words(t))
    by_doc = Counter()
    for i, t, lang, s in mixed:
        assert (lang, s) == of[i][2:]
        left = iter(words(of[i][1]))
        assert all(w in left for w in words(t))  # words of the document, in order
        taken[s] += len(words(t))
        by_doc[i] += len(words(t))
    assert all(n <= 2 * len(words(of[i][1])) for i, n in by_doc.items())
    for s, n in targets_plainly(size).items():
        assert abs(taken[s] - n) <= 2 * mixing.BLOCK_WORDS
    assert Counter(stage("mixing", kept)) == Counter(mixed)

    t = Tokenizer.from_file(tokenizer_path())
    encoded = [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")) for i, x, *_ in mixed]
    got = sorted(rows(corpus_pipeline.run(spark, folder)), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((i, len(e), zlib.crc32(e.tobytes())) for i, e in encoded)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]).tolist()


def test_pipeline_on_empty_tables(spark, docs_of, tmp_path):
    import corpus_pipeline
    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_drops_near_copies_from_80_percent_of_five_word_shingles(spark, docs_of):
    import corpus_pipeline
    rng = random.Random(12)
    long, other = ([f"w{rng.randint(0, 10**6)}" for _ in range(1004)] for _ in range(2))
    made = [(1, " ".join(long)), (2, " ".join(long[:824])), (3, " ".join(other)), (4, " ".join(other[:784]))]  # of 1000 shingles 820 and 780
    assert sorted(r["doc_id"] for r in jaccard.keep_one(docs_of(made)).collect()) == [1, 2, 3, 4]
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs_of(made), None).collect()) == [1, 3, 4]


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_rearranged_words_are_other_words(docs_of):
    """Sequences that cancel out in polynomial hashes modulo 2^64."""
    odd = [thue_morse(512), thue_morse(512, "b", "a")]
    around = [f"w{i}" for i in range(59)]
    made = [" ".join([*around[:30], w, *around[30:]]) for w in odd]
    got = {r["doc_id"]: r["n_removed"] for r in rows(repeats.deduplicate(docs_of([(1, made[0]), (2, made[1]), (3, made[0])])))}
    assert got == {1: 0, 2: 0, 3: 60}
    short = [" ".join([*around[:10], w, *around[10:19]]) for w in odd]
    got = {r["doc_id"]: r["component_id"] for r in rows(jaccard.join(docs_of([(1, short[0]), (2, short[1]), (3, short[0])])))}
    assert got == {1: 1, 2: 2, 3: 1}


def test_hashes_tell_words_and_runs_apart():
    from nearrate.llm import text
    rng = random.Random(8)
    made = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    h, offsets = text.word_hashes([" ".join(made).encode(), None, b"", b"A b"], lower=True)
    assert list(offsets) == [0, 3000, 3000, 3000, 3002]
    assert len(set(h[:3000].tolist())) == len(set(made)) and h[3000] == text.word_hashes([b"a"])[0][0]
    runs = text.Runs(h)
    for n in (1, 2, 3, 7, 50, 64):
        got = runs(np.arange(2900), n).tolist()
        want = [tuple(made[i : i + n]) for i in range(2900)]
        assert len(set(got)) == len(set(want)) == len(set(zip(got, want, strict=True)))
    assert runs(np.array([5, 9]), np.array([2, 7])).tolist() == [runs.of(2)[5], runs.of(7)[9]]


def test_jaccard_bound_closes_groups(spark, docs_of, monkeypatch):
    """A group that shares a first token but too few others is a candidate, and
    is not opened; none that links is closed."""
    rng = random.Random(21)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    pool = [[word() for _ in range(30)] for _ in range(60)]  # texts of passages that several texts share
    made = [(i, [w for p in rng.sample(pool, 10) for w in p]) for i in range(40)]
    made += [(100 + i, made[i][1][:290]) for i in range(0, 40, 5)]
    docs = docs_of([(i, " ".join(w)) for i, w in made])
    seen, real = {}, jaccard.qualifying

    def watched(pairs, groups, lows, percent):
        seen["tried"], out = pairs.count(), real(pairs, groups, lows, percent)
        seen["open"] = out.count()
        return out

    monkeypatch.setattr(jaccard, "qualifying", watched)
    got = {r["doc_id"]: r["component_id"] for r in rows(jaccard.join(docs))}
    assert got == {i: i - 100 if i >= 100 else i for i, _ in made}
    assert 0 < seen["open"] < seen["tried"]


def test_jaccard_bounded_tables(docs_of, monkeypatch):
    """Many near copies with a table of shared counts in small pieces."""
    rng = random.Random(22)
    base = [f"w{i}" for i in range(120)]
    made = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(120)] = f"x{i}"
        made.append((i, " ".join(w)))
    made += [(100 + i, " ".join(f"y{rng.randint(0, 10**6)}" for _ in range(50))) for i in range(5)]
    want = {i: 0 if i < 100 else i for i, _ in made}
    for cells, members, queries in ((1 << 19, 512, 1024), (64, 7, 5)):
        monkeypatch.setattr(jaccard, "CELLS", cells)
        monkeypatch.setattr(jaccard, "GROUP_MEMBERS", members)
        monkeypatch.setattr(jaccard, "TASK_QUERIES", queries)
        assert {r["doc_id"]: r["component_id"] for r in rows(jaccard.join(docs_of(made)))} == want


def test_toxicity_folds_every_look_alike():
    for letter, alike in toxicity.LOOKS_LIKE.items():
        for x in alike.replace("!", ""):
            assert toxicity.fold(f"q{x}q") == toxicity.fold(f"Q{x.lower()}q") == [f"q{letter}q"], x


def test_lm_training_encodes_no_more_text_at_once_than_scoring(spark, docs_of, monkeypatch):
    """A batch of many texts is encoded in slices, whatever Arrow puts in a batch."""
    from nearrate.llm import lm
    from nearrate.llm.queries import tokenizer_path
    from nearrate.llm.text import parts
    import pyarrow as pa
    texts = [None, "", "é" * 40, *["word " * k for k in range(30)], "x" * 500, None]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(texts))), "t": texts})
    cut = list(parts(batch, "t", 200))
    assert [x for _, t in cut for x in t] == [t if t is None else t.encode() for t in texts]
    assert [n for p, _ in cut for n in p.column("n").to_pylist()] == list(range(len(texts)))
    assert len(cut) > 10 and all(len(t) == 1 or sum(len(x or b"") + 1 for x in t) <= 200 for _, t in cut)
    assert list(parts(batch.slice(0, 0), "t")) == []
    sizes = spark.sparkContext.accumulator(0)
    plain = lm.encoder

    def watched(path):
        made = plain(path)

        class Watch:
            tokenizer = made.tokenizer

            def __call__(self, given):
                sizes.add(sum(map(len, given)) > 2 << 20)
                return made(given)

        return Watch()

    monkeypatch.setattr(lm, "encoder", watched)
    docs = docs_of([(i, "ab cd " * 2500) for i in range(300)])
    got = lm.training_pieces(docs.coalesce(1), {}, tokenizer_path())
    assert got.count() == 300 and sizes.value == 0
