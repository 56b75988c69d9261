"""Token-ID output (operator 7): a binary file format of independent zstandard
frames with a trailing seek table, written and read by Spark tasks.

File: frames one after another, each a zstandard frame of its own that holds
the ids (unsigned 32-bit, little endian) of whole documents; then the seek
table, one entry per frame (byte offset, compressed bytes, first document,
documents, ids, crc32 of the compressed frame), then per document its number of
ids, and a fixed tail (entry count, document count, crc32 of the table, magic).
A reader takes the tail and the table, and then only the frames of the
documents it was asked for.

Documents are dealt by ascending doc_id into ranges; a task writes one file per
range under a name of its own attempt, and only the names that the committed
tasks return are read, so a lost executor or a second attempt does no harm.
Files go through pyarrow's file systems, which open the shared folder's URI.

Tokens: where the tokenizer's file says that white space ends every token, texts
are encoded by their words, and a bounded table of words already met is kept per
task; any other tokenizer gets whole texts.

Defined cases: null text is empty and has only the end id; a null doc_id comes
first; equal doc_ids follow in the order of a hash of their text; an empty table
gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from nearrate.llm.common import fresh_path, saved
from nearrate.llm.text import parts

END = 1
FRAME_IDS = 1 << 16
FILE_BYTES = 32 << 20
KNOWN_WORDS = 400_000
MAGIC = 0x5A49444B
ENTRY = "<QIQIQI"
TAIL = "<IIII"
ITEM = np.dtype("<u4")


#: Fixed value: a pre-tokenizer pattern of which no match holds white space, so
#: that a text's ids are those of its words, one after another.
# The pieces of words of ASCII and Latin-1 letters, lower-cased, one word a line,
# are those of the shorter pattern; all other words go through the tokenizer.
ODD = re.compile("[^\n!-~\u00c0-\u00ff]|<[|]")
PIECE = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff\n]+")
BY_WORD = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable
    bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ..., n[i] of them, one after another."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


class WordEncoder:
    """Ids of whole texts. If the tokenizer's file says that it drops white space
    and joins nothing across it, texts are cut into words, and the words not met
    before are encoded in one batch; else each text is. The table of words met
    is bounded: when it is full, the half met most stays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = self.by_word(path)
        self.known: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.turn = 0  # how often words were numbered anew
        self.letters = str.maketrans({c: "".join(byte_letters()[b] for b in c.encode()) for c in map(chr, range(128, 256))})
        self.no_pieces()
        self.first, self.flat, self.used = np.zeros(1, np.int64), np.zeros(0, ITEM), np.zeros(0, np.int64)

    @staticmethod
    def by_word(path: str) -> bool:
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        normal = (made["normalizer"] or {"type": "Sequence", "normalizers": []}).get("normalizers", [{}])
        steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        split = {"type": "Split", "pattern": {"Regex": BY_WORD}, "behavior": "Removed", "invert": True}
        return (all(x.get("type") in ("NFC", "Lowercase") or x == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} for x in normal)
                and len(steps) == 2 and steps[0] == split and steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
                and not made["truncation"] and not made["padding"]
                and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in made["added_tokens"]))

    def batch(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def places(self, words: list[list[bytes]]) -> np.ndarray:
        """The numbers, in the table, of the words of all lists."""
        known = self.known
        if len(known) > KNOWN_WORDS:
            self.forget()
            known = self.known
        flat_words = list(chain.from_iterable(words))
        at = np.fromiter(map(known.get, flat_words, repeat(-1)), np.int64, len(flat_words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = list(dict.fromkeys([flat_words[i] for i in missing]))
            flat, n = self.new_ids(new)
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.names += new
            self.flat = np.concatenate((self.flat, flat))
            self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(n)))
            self.used = np.concatenate((self.used, np.zeros(len(new), np.int64)))
            at[missing] = [known[flat_words[i]] for i in missing]
        self.used += np.bincount(at, minlength=len(self.used))
        return at

    def new_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, joined, and the number of each. Plain words are cut
        into pieces together; pieces have a bounded table of their own."""
        texts = [w.decode() for w in words]
        plain, lines = np.full(len(texts), self.cuts), "\n".join(texts)
        odd = [m.start() for m in ODD.finditer(lines)]
        plain[np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), np.array(odd, np.int64), "right")] = False
        n = np.zeros(len(texts), np.int64)
        other = self.tokenizer.encode_batch_fast([texts[i] for i in np.flatnonzero(~plain)], add_special_tokens=False)
        other = [e.ids for e in other]
        n[~plain] = [len(x) for x in other]
        rest = np.fromiter(chain.from_iterable(other), ITEM, int(n.sum()))
        if not plain.any():
            return rest, n
        if len(rest) or not plain.all():
            lines = "\n".join([texts[i] for i in np.flatnonzero(plain)])
        pieces = PIECE.findall(lines.lower())
        if len(self.piece_at) > KNOWN_WORDS:
            self.no_pieces()
        new = [p for p in dict.fromkeys(pieces) if p not in self.piece_at]
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(p if p.isascii() else p.translate(self.letters))] for p in new]
        self.piece_at.update(zip(new, range(len(self.piece_at), len(self.piece_at) + len(new)), strict=True))
        sizes = np.array([len(x) for x in ids], np.int64)
        self.piece_first = np.concatenate((self.piece_first, self.piece_first[-1] + np.cumsum(sizes)))
        self.piece_ids = np.concatenate((self.piece_ids, np.fromiter(chain.from_iterable(ids), ITEM, int(sizes.sum()))))
        at = np.fromiter(map(self.piece_at.__getitem__, pieces), np.int64, len(pieces))
        size = np.diff(self.piece_first)[at]
        n[plain] = np.bincount(np.cumsum(at == 0), size, int(plain.sum()))
        out, begin = np.empty(int(n.sum()), ITEM), np.cumsum(n) - n
        out[spans(begin[plain], n[plain])] = self.piece_ids[spans(self.piece_first[at], size)]
        out[spans(begin[~plain], n[~plain])] = rest
        return out, n

    def no_pieces(self) -> None:
        """An empty table but for the line end, which has no ids."""
        self.piece_at, self.piece_first, self.piece_ids = {"\n": 0}, np.zeros(2, np.int64), np.zeros(0, ITEM)

    def forget(self) -> None:
        stay = np.flatnonzero(self.used > max(1, int(np.median(self.used))))
        self.names = [self.names[i] for i in stay]
        self.known = {w: k for k, w in enumerate(self.names)}
        self.turn += 1
        self.flat, n = self.ids_at(stay)
        self.first, self.used = np.concatenate(([0], np.cumsum(n))), np.ones(len(stay), np.int64)

    def ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words of the table, joined, and the number of each."""
        n = np.diff(self.first)[at]
        return self.flat[spans(self.first[at], n)], n

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.cuts:
            return [np.array(x, ITEM) for x in self.batch([t or b"" for t in texts])]
        words = [(t or b"").split() for t in texts]
        ids, n = self.ids_at(self.places(words))
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum([len(w) for w in words])]
        return np.split(ids, ends[:-1])


def encoder(path: str) -> WordEncoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def open_fs(uri: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else "/" + uri)


class FrameWriter:
    def __init__(self, out):
        import zstandard
        self.out, self.zip = out, zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.entries: list[tuple] = []
        self.counts: list[int] = []
        self.parts: list[np.ndarray] = []
        self.held = self.at = self.first = 0

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.counts.append(len(ids))
        self.held += len(ids)
        if self.held >= FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.parts:
            return
        data = self.zip.compress(np.concatenate(self.parts).astype(ITEM).tobytes())
        self.out.write(data)
        self.entries.append((self.at, len(data), self.first, len(self.parts), self.held, zlib.crc32(data)))
        self.at += len(data)
        self.first, self.parts, self.held = len(self.counts), [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack(ENTRY, *e) for e in self.entries) + np.array(self.counts, ITEM).tobytes()
        self.out.write(table + struct.pack(TAIL, len(self.entries), len(self.counts), zlib.crc32(table), MAGIC))
        self.out.close()


class FrameReader:
    """Random access: ``documents(i, j)`` decompresses only the frames that hold
    documents i to j - 1 of the file."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, docs, crc, magic = struct.unpack(TAIL, self.file.read_at(struct.calcsize(TAIL), size - struct.calcsize(TAIL)))
        if magic != MAGIC:
            raise ValueError(f"{uri}: not a token file")
        length = n * struct.calcsize(ENTRY) + docs * ITEM.itemsize
        table = self.file.read_at(length, size - struct.calcsize(TAIL) - length)
        if zlib.crc32(table) != crc:
            raise ValueError(f"{uri}: the seek table is damaged")
        self.entries = [struct.unpack_from(ENTRY, table, i * struct.calcsize(ENTRY)) for i in range(n)]
        self.counts = np.frombuffer(table, ITEM, docs, n * struct.calcsize(ENTRY)).astype(np.int64)

    def documents(self, start: int, stop: int) -> Iterator[np.ndarray]:
        import zstandard
        unzip = zstandard.ZstdDecompressor()
        for at, size, first, docs, ids, crc in self.entries:
            if first + docs <= start or first >= stop:
                continue
            data = self.file.read_at(size, at)
            if zlib.crc32(data) != crc:
                raise ValueError("a frame is damaged")
            all_ids = np.frombuffer(unzip.decompress(data, max_output_size=ids * ITEM.itemsize), ITEM)
            cuts = np.cumsum(self.counts[first : first + docs])[:-1]
            for i, x in enumerate(np.split(all_ids, cuts)):
                if start <= first + i < stop:
                    yield x

    def close(self) -> None:
        self.file.close()


def write(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write all documents; the manifest (written): file, path, doc_ids, n_ids."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-files")
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = d.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    files = max(1, -(-size // FILE_BYTES))
    dealt = (d.withColumn("tie", F.xxhash64("text"))
             .repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "tie")
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie"))

    def task(batches):
        import pyarrow as pa
        encode, writer, ids, n = encoder(tokenizer), None, [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                fs, root = open_fs(folder)
                fs.create_dir(root, recursive=True)
                name = f"{uuid.uuid4().hex}.ids"
                writer = FrameWriter(fs.open_output_stream(f"{root}/{name}"))
            for held, texts in parts(b, "text"):
                ids += held.column("doc_id").to_pylist()
                for x in encode(texts):
                    writer.add(np.append(x, np.array([END], ITEM)))
                    n += len(x) + 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder.rstrip('/')}/{name}"], "part": [part()], "doc_ids": [ids], "n_docs": [len(ids)], "n_ids": [n]},
                                             schema=pa.schema([("path", pa.string()), ("part", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    def part() -> int:
        from pyspark import TaskContext
        return TaskContext.get().partitionId()

    made = dealt.mapInArrow(task, "path string, part int, doc_ids array<bigint>, n_docs long, n_ids long")
    made = saved(made, "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = made.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    return made.join(starts, "part")


def read_back(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    def task(batches):
        import pyarrow as pa
        for b in batches:
            for path, ids, start in zip(*(b.column(c).to_pylist() for c in ("path", "doc_ids", "start")), strict=True):
                reader = FrameReader(path)
                try:
                    found = [(len(x), zlib.crc32(x.tobytes())) for x in reader.documents(0, len(reader.counts))]
                finally:
                    reader.close()
                n = np.array([x[0] for x in found], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array([x[1] for x in found], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.select("path", "doc_ids", "start").mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_back(write(docs, tokenizer))
