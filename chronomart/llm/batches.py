"""Arrow batches of bounded bytes, and the words of their texts as numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once in a Python worker; a single longer text goes alone.
BYTES = 2_000_000


def small_batches(batches: Iterator[pa.RecordBatch], most: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes; empty batches are left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        each = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, each):
            yield batch.slice(at, each)


#: The characters \x20 and \x09 to \x0D part words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _odd(256, 1)
_LOWER = _BYTE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASES = [int(x) for x in _odd(3, 2)]
_INVERSES = [pow(b, -1, 2**64) for b in _BASES]
_powers: dict[int, np.ndarray] = {}


#: Values that are hashed from one running sum; longer arrays are cut.
CHUNK = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; as long as the longest array so far."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.multiply.accumulate(known)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def ranges(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of each ``values[begin:end]``, from running sums; ``which`` picks one of three.

    Ranges in order are hashed from sums over about ``CHUNK`` values, so sums and powers stay short.
    """
    lengths = (ends - begins).astype(np.uint64)
    if len(values) <= CHUNK or not len(begins) or (np.diff(begins) < 0).any():
        hashed = _sums(values, begins, ends, which)
    else:
        cuts = np.flatnonzero(np.diff(begins // CHUNK, prepend=-1))
        parts = []
        for some_begins, some_ends in zip(np.split(begins, cuts[1:]), np.split(ends, cuts[1:])):
            low = some_begins[0]
            parts.append(_sums(values[low : some_ends.max()], some_begins - low, some_ends - low, which))
        hashed = np.concatenate(parts)
    return mix(hashed + lengths * np.uint64(_BASES[-1 - which]))


def _sums(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """The polynomial in the base over each range, from its own begin on."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(_BASES[which], n), out=sums[1:])
    return (sums[ends] - sums[begins]) * powers(_INVERSES[which], n + 1)[begins]


class Words:
    """The words of a batch of texts: ``hashes``, and where each document's words ``begin`` and ``end``.

    ``starts`` are the words' places in ``data``, the bytes of all texts, which ``bounds`` cuts into texts;
    ``apart`` are the bytes between words.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, apart: np.ndarray = SPACE):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        inside = ~apart[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = bounds[:-1][bounds[:-1] < len(data)]
        opens[edges] = inside[edges]
        edges = bounds[1:][bounds[1:] > 0] - 1
        closes[edges] = inside[edges]
        begins = np.flatnonzero(opens)
        self.hashes = ranges((_LOWER if lower else _BYTE)[data], begins, np.flatnonzero(closes) + 1, 0)
        at = np.searchsorted(begins, bounds)
        self.begin, self.end = at[:-1], at[1:]
        self.starts, self.data, self.bounds = begins, data, bounds

    def doc_of(self) -> np.ndarray:
        """The document, by its place in the batch, of each word."""
        return np.repeat(np.arange(len(self.begin)), self.end - self.begin)


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after the other."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(lengths.sum())]


class Places(dict):
    """Numbers words in the order in which they are first asked for; ``new`` are those whose ids are not known yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.new.append(word)
        return place
