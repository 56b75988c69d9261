"""Fill-in-middle transformation (operator 13) by secondary-sort assembly.

A text is cut into n units (lines with their line feed). Two cut points, taken
from a hash of the document's id, split the units into prefix, middle and
suffix, and a third and a fourth number of the hash choose the form: plain, psm
(``<P>`` prefix ``<S>`` suffix ``<M>`` middle) or spm (``<S>`` suffix ``<P>``
prefix ``<M>`` middle).

``pieces`` emits each document as pieces of whole units (a unit above PIECE
bytes in several), keyed by document and output position. They are dealt by
document, sorted within partitions by output position and streamed: no text is
put together in memory to be hashed. ``restored`` reads the output stream,
finds the sections by their marks alone, and resorts the same partitions by
position in the text, without a second shuffle. ``assembled`` gives whole
output texts, ``report`` the digests of output and restored text.

Defined cases: null and empty texts have no units and are plain; a text that
holds a mark is plain, as its marks could not be told apart; a null doc_id
hashes as empty text; repeated ids and equal rows are documents of their own,
cut alike; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from nearrate.llm.common import byte_list

SEED, RATE, SPM = "7", 100, 50
PIECE = 4096
BATCH = 1 << 20
MARK = re.compile(rb"<[PSM]>")
#: The start of a mark, at the end of a piece.
OPEN = re.compile(rb"<[PSM]?\Z")
PLACE = {b"<P>": 0, b"<M>": 1, b"<S>": 2}
#: Positions in the text: the section's place, then the order within it.
SECTION = 1 << 48

PIECES = "rid long, pos long, doc_id long, n long, form string, prefix_chars long, middle_chars long, piece binary"
RESTORED = "rid long, at long, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, piece binary"
REPORT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def numbers(seed: str, doc_id: int | None) -> list[int]:
    """h1 to h4: the first four groups of eight hex digits."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(h[i : i + 4], "big") for i in (0, 4, 8, 12)]


def unit_ends(text: bytes) -> np.ndarray:
    """The offset after each unit."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def char_count(part: bytes) -> int:
    return int(((np.frombuffer(part, np.uint8) & 0xC0) != 0x80).sum())


def sections(text: bytes, doc_id: int | None, seed: str, rate: int, spm: int):
    """n, form, characters of prefix and middle, and the ordered parts of the
    output as (mark, start, stop)."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = numbers(seed, doc_id)
    if not text or MARK.search(text) or h3 % 100 >= rate:
        return n, "plain", None, None, ends, [(b"", 0, len(text))]
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[i - 1]) if i else 0 for i in (first, last))
    prefix, middle, suffix = (b"<P>", 0, a), (b"<M>", a, b), (b"<S>", b, len(text))
    form, parts = ("spm", [suffix, prefix, middle]) if h4 % 100 < spm else ("psm", [prefix, suffix, middle])
    return n, form, char_count(text[:a]), char_count(text[a:b]), ends, parts


def cuts(ends: np.ndarray, start: int, stop: int) -> list[tuple[int, int]]:
    """Ranges of whole units, of at most PIECE bytes where units allow it."""
    if stop - start <= PIECE:
        return [(start, stop)]
    out = []
    while start < stop:
        i = int(np.searchsorted(ends, min(start + PIECE, stop), "right")) - 1
        end = int(ends[i]) if i >= 0 and ends[i] > start else min(start + PIECE, stop)
        out.append((start, end))
        start = end
    return out


class Batches:
    """Rows gathered into Arrow batches of about BATCH bytes."""

    def __init__(self, schema: str):
        import pyarrow as pa
        kind = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        self.schema = pa.schema([(name, kind[t]) for name, t in (f.split() for f in schema.split(", "))])
        self.rows, self.size = [], 0

    def add(self, *row) -> bool:
        self.rows.append(row)
        self.size += 64 + len(row[-1] or b"")
        return self.size >= BATCH

    def take(self):
        import pyarrow as pa
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(self.schema)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def pieces(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """The output as rows (rid, pos, ..., piece): all pieces of a document in one
    partition, in output order. The facts of a document stand on its first."""
    def task(batches):
        out = Batches(PIECES)
        for b in batches:
            for rid, doc_id, text in zip(b.column("rid").to_pylist(), b.column("doc_id").to_pylist(), byte_list(b.column("text")), strict=True):
                text = text or b""
                n, form, p, m, ends, parts = sections(text, doc_id, seed, rate, spm)
                pos, facts = 0, (doc_id, n, form, p, m)
                for mark, start, stop in parts:
                    for i, j in cuts(ends, start, stop):
                        if out.add(rid, pos, *facts, mark + text[i:j]):
                            yield out.take()
                        pos, facts, mark = pos + 1, (None,) * 5, b""
        yield out.take()

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(task, PIECES).repartition("rid").sortWithinPartitions("rid", "pos")


def documents(batches, columns: list[str]):
    """The rows of sorted batches as (rid, facts of the row, piece)."""
    for b in batches:
        rows = zip(*(b.column(c).to_pylist() for c in columns), strict=True)
        yield from ((r[0], r[1:], p) for r, p in zip(rows, byte_list(b.column("piece")), strict=True))


class Reader:
    """The sections of one output, told from its marks as the stream goes by."""

    def __init__(self, form: str):
        self.plain, self.place, self.order, self.held = form == "plain", 0, 0, b""

    def at(self) -> int:
        self.order += 1
        return self.place * SECTION + self.order - 1

    def feed(self, piece: bytes):
        if self.plain:
            yield self.at(), piece
            return
        data = self.held + piece
        open_ = OPEN.search(data)
        self.held = data[open_.start():] if open_ else b""
        data = data[: len(data) - len(self.held)]
        start = 0
        for m in MARK.finditer(data):
            if m.start() > start:
                yield self.at(), data[start : m.start()]
            self.place, start = PLACE[m.group()], m.end()
        if start < len(data):
            yield self.at(), data[start:]

    def close(self):
        if self.held:
            yield self.at(), self.held


def restored(output: DataFrame) -> DataFrame:
    """From ``pieces`` to rows (rid, at, facts, output_sha256, piece) in the order
    of the text; facts and digest stand on a first row without a piece."""
    def task(batches):
        out, rid, digest, reader, facts = Batches(RESTORED), None, None, None, None
        none = (None,) * 6

        def finish():
            for at, part in reader.close():
                out.add(rid, at, *none, part)
            out.add(rid, -1, *facts, digest.hexdigest(), None)

        for r, f, piece in documents(batches, ["rid", "doc_id", "n", "form", "prefix_chars", "middle_chars"]):
            if r != rid:
                if rid is not None:
                    finish()
                rid, digest, facts, reader = r, hashlib.sha256(), f, Reader(f[2])
            digest.update(piece)
            for at, part in reader.feed(piece):
                out.add(rid, at, *none, part)
            if out.size >= BATCH:
                yield out.take()
        if rid is not None:
            finish()
        yield out.take()

    # the partitions already hold whole documents: sorting them anew is enough
    return output.mapInArrow(task, RESTORED).sortWithinPartitions("rid", "at")


def report(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """One row per document: form, cut points and the digests of output and text
    rebuilt from it."""
    def task(batches):
        import pyarrow as pa
        names = [f.split()[0] for f in REPORT.split(", ")]
        rid, rows, facts, digest = None, [], None, None

        def batch():
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            kinds = [pa.string() if "sha256" in x or x == "form" else pa.int64() for x in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for r, f, piece in documents(batches, ["rid", *names[:-1]]):
            if r != rid:
                if rid is not None:
                    rows.append((*facts, digest.hexdigest()))
                rid, facts, digest = r, f, hashlib.sha256()
                if len(rows) >= 8192:
                    yield batch()
                    rows.clear()
            if piece is not None:
                digest.update(piece)
        if rid is not None:
            rows.append((*facts, digest.hexdigest()))
        yield batch()

    return restored(pieces(docs, seed, rate, spm)).mapInArrow(task, REPORT)


def assembled(rows: DataFrame) -> DataFrame:
    """Whole texts, (doc_id, form, text), from the sorted rows of ``pieces`` (the
    outputs) or of ``restored`` (the rebuilt texts). A task holds one at a time."""
    def task(batches):
        import pyarrow as pa
        rid, facts, parts = None, None, []

        def batch():
            text = pa.array([b"".join(parts)], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array(facts[:1], pa.int64()), pa.array(facts[1:], pa.string()), text], names=["doc_id", "form", "text"])

        for r, f, piece in documents(batches, ["rid", "doc_id", "form"]):
            if r != rid:
                if rid is not None:
                    yield batch()
                rid, facts, parts = r, f, []
            parts.append(piece or b"")
        if rid is not None:
            yield batch()

    return rows.mapInArrow(task, "doc_id long, form string, text string")


#: DuckDB: the units as a list, cut and joined.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 AS plain FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN NOT plain THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE WHEN plain THEN text WHEN h4 % 100 < 50 THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
  sha256(CASE WHEN plain THEN text ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
