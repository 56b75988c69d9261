"""Words of whole texts as arrays: vectorised splitting, 64-bit word hashes and
fingerprints of word runs.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``; as
these are ASCII, splitting the UTF-8 bytes equals splitting the characters.
Hashes are 64 bits wide and not linear: a word is taken in eights of bytes, each
multiplied and scrambled with the state so far, and a run is scrambled from its
halves, so rearranged parts (such as Thue-Morse sequences, which cancel out in
polynomials modulo 2^64) do not collide by their structure. Two different words
or runs agree with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B, _C, _D = (np.uint64(int(x) | 1) for x in np.random.default_rng(20240917).integers(2**40, 2**63, 4, dtype=np.uint64))
#: The bytes of an eight that belong to a word with 0 to 8 of them left.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one after another, and the offsets:
    text i has words[offsets[i]:offsets[i + 1]]. None has no words. ``lower``
    folds A-Z first."""
    sizes = np.array([len(t) + 1 if t else 1 for t in texts], np.int64)
    buf = np.frombuffer(b" ".join(t or b"" for t in texts) + b" " * 9, np.uint8)
    if lower:
        buf = _LOWER[buf]
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(buf) and not space[0]:
        edge = np.concatenate(([0], edge))
    first, last = edge[0::2], edge[1::2]  # the buffer ends in spaces
    eights = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
    words = mix((last - first).astype(np.uint64) * _A + _B)
    at, left, mine = first, last - first, slice(None)
    while len(at):
        words[mine] = mix((words[mine] ^ (eights[at] & _MASK[np.minimum(left, 8)])) * _C + _D)
        more = np.flatnonzero(left > 8)
        mine = more if isinstance(mine, slice) else mine[more]
        at, left = at[more] + 8, left[more] - 8
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    return words, np.searchsorted(first, bounds)


class Runs:
    """Fingerprints of any run of consecutive words: those of all runs of 1, 2, 4,
    ... words are built from halves once, and a run is made of such parts."""

    def __init__(self, words: np.ndarray):
        self.parts = [mix(words * _A + _B)]
        self.whole: dict[int, np.ndarray] = {}

    def of(self, length: int) -> np.ndarray:
        """The fingerprints of the runs of ``length`` words from every start."""
        if length not in self.whole:
            out, have = None, 0
            for k in reversed(range(int(length).bit_length())):
                while len(self.parts) <= k:
                    half, step = self.parts[-1], 1 << len(self.parts) - 1
                    self.parts.append(join(half[: max(len(half) - step, 0)], half[step:]))
                if length >> k & 1:
                    part = self.parts[k]
                    out = part if out is None else join(out[: max(len(part) - have, 0)], part[have:])
                    have += 1 << k
            self.whole[length] = out
        return self.whole[length]

    def __call__(self, start: np.ndarray, length) -> np.ndarray:
        if np.ndim(length) == 0:
            return self.of(int(length))[start]
        out = np.zeros(len(start), np.uint64)
        for n in np.unique(length):
            some = np.flatnonzero(length == n)
            out[some] = self.of(int(n))[start[some]]
        return out


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprints of two runs one after another."""
    return mix((a ^ _B) * _C + b)


def chunks(texts: list[bytes | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of the list with about ``limit`` bytes each (a longer text alone)."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n + 1
    if begin < len(texts):
        yield begin, len(texts)


def parts(batch, column: str, limit: int = 1 << 20) -> Iterator[tuple]:
    """An Arrow batch in slices with about ``limit`` bytes of text each (a longer
    text alone), each with its texts: no more of a batch is held as Python objects."""
    import pyarrow as pa
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, begin = np.cumsum(sizes.astype(np.int64) + 1), 0
    while begin < len(ends):
        have = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, have + limit, "right")))
        part = batch.slice(begin, stop - begin)
        yield part, part.column(column).cast(pa.large_binary()).to_pylist()
        begin = stop


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (by doubling)."""
    if len(x) < width:
        return x[:0]
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
