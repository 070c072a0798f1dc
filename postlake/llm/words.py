"""Words of whole batches of texts as numpy arrays.

Texts are handled as UTF-8 bytes.  A table of 256 entries says which bytes belong to a word (0: none, otherwise a class;
a word is a run of bytes of one class), another gives each byte its share of the word's hash; the latter maps A-Z to a-z,
so hashes are those of the lower-cased words.  No step loops over words in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes of text that are hashed at once; a longer word is hashed alone.
SEGMENT = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def byte_classes(kind: str) -> np.ndarray:
    """``space``: runs without ASCII white space.  ``alnum``: runs of 0-9, A-Z, a-z and bytes over 0x7F.
    ``mixed``: the latter as class 1 and runs of other visible characters as class 2."""
    codes = np.arange(256)
    white = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
    alnum = (
        ((codes >= 0x30) & (codes <= 0x39))
        | ((codes >= 0x41) & (codes <= 0x5A))
        | ((codes >= 0x61) & (codes <= 0x7A))
        | (codes >= 0x80)
    )
    if kind == "space":
        return (~white).astype(np.uint8)
    if kind == "alnum":
        return alnum.astype(np.uint8)
    if kind == "mixed":
        return np.where(alnum, 1, np.where(white | (codes < 0x20), 0, 2)).astype(np.uint8)
    raise ValueError(f"unknown kind of word: {kind}")


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _U(0xD1B54A32D192ED03))
    values[0x41:0x5B] = values[0x61:0x7B]
    return values


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit of the input reaches every bit of the output."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> _U(33))
        h = h * _U(0xFF51AFD7ED558CCD)
        h ^= h >> _U(33)
        h *= _U(0xC4CEB9FE1A85EC53)
        h ^= h >> _U(33)
    return h


def _power(n: int, base: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        out = np.full(size, base, dtype=_U)
        out[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
        if size <= SEGMENT + 1:
            _powers[name] = out
        return out
    return have


VALUES = _byte_values()


@dataclass
class Words:
    """Words of a batch in order; ``doc`` is each word's text, ``first`` the first word of each text (with an end)."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def raw(self, a: int, b: int) -> list[bytes]:
        """The words a to b - 1, lower-cased (A-Z only)."""
        data = self.buffer[self.starts[a] : self.ends[b - 1]].tobytes().lower() if b > a else b""
        s = self.starts[a:b] - (self.starts[a] if b > a else 0)
        return [data[i:j] for i, j in zip(s, s + (self.ends[a:b] - self.starts[a:b]), strict=True)]


def words_of(texts: list[bytes], classes: np.ndarray) -> Words:
    """Null texts are to be given as empty ones."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=offsets[1:])
    buffer = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    kinds = classes[buffer]
    edge = np.empty(len(kinds) + 1, dtype=bool)
    edge[0], edge[-1] = True, True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:-1])
    bounds = np.flatnonzero(edge)
    starts, ends = bounds[:-1], bounds[1:]
    keep = kinds[starts] > 0 if len(kinds) else np.zeros(0, dtype=bool)
    starts, ends = starts[keep], ends[keep]
    hashes = np.empty(len(starts), dtype=_U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, side="right")))
        low, size = starts[i], int(ends[j - 1] - starts[i])
        with np.errstate(over="ignore"):
            sums = np.zeros(size + 1, dtype=_U)
            np.cumsum(VALUES[buffer[low : low + size]] * _power(size, _BASE, "up")[:size], out=sums[1:])
            s, e = starts[i:j] - low, ends[i:j] - low
            part = (sums[e] - sums[s]) * _power(size + 1, _BASE_INVERSE, "down")[s]
            hashes[i:j] = mix(part + (e - s).astype(_U) * _U(0x9FB21C651E98DF25))
        i = j
    doc = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(starts, offsets)
    return Words(buffer, starts, ends, hashes, doc, first, offsets)


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words of one text, and the index of its first word."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    h = words.hashes
    out = h[:n].copy()
    with np.errstate(over="ignore"):
        for k in range(1, size):
            out *= _U(0x9DDFEA08EB382D69)
            out ^= out >> _U(29)
            out += h[k : n + k]
    at = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :])
    return mix(out[at] + _U(size)), at


def chunks(texts: list[bytes], limit: int = SEGMENT):
    """Ranges of consecutive texts with at most ``limit`` bytes; a longer text is alone."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if i > begin and held + len(t) > limit:
            yield begin, i
            begin, held = i, 0
        held += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)
