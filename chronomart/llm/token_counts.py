"""Token counts by rank-synchronous merging of arrays.

The distinct pre-tokens of a batch lie in one ragged array of symbols. In each round every pre-token applies
its own pair of lowest rank, wherever it stands, to all pre-tokens at once; those without a pair are done and
leave, and the symbols that survive are counted. Applying all places of a pair together is the
same as leftmost first as long as a merge comes later than the merges that made its halves, which is checked when the
file is read; otherwise only the leftmost place is merged in a round. A pre-token of more than ``LONG`` bytes would
need many rounds over all its symbols: its places wait under their ranks instead, and each round touches one rank's.

Rows: a null text is read as empty and has no tokens; a null key stays null; repeated rows are counted each.
Other columns are not carried. Texts are read whole: long ones in runs of pre-tokens, so memory grows with the
text itself and not with its number of tokens.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.llm.batches import small_batches

#: What the library cuts a text into before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = np.int64(1) << 40
#: Bytes of a pre-token beyond which its places wait under their ranks.
LONG = 2048
#: Pre-tokens handled at once, and characters of a text beyond which they are not all held.
RUN, WHOLE = 200_000, 1_000_000
#: Counts are remembered for pre-tokens of at most so many characters, and for so many of them.
SHORT, KNOWN = 64, 200_000


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class Merges:
    """A byte-level merge list as sorted arrays: pairs of symbols, their ranks and what they become."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        left, right, made = (
            np.array([vocabulary[name] for name in names], np.int64)
            for names in zip(*((a, b, a + b) for a, b in pairs))
        )
        self.symbols = np.array([vocabulary[c] for c in _byte_characters()], np.int64)
        #: Special strings are tokens wherever they stand in a text, as the library has it by default.
        self.special = [t["content"] for t in spec["added_tokens"]]
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        self.made_at = made
        born = np.full(max(vocabulary.values()) + 1, -1)
        born[made] = np.arange(len(made))
        self.rising = len(set(made.tolist())) == len(made) and bool(
            (born[left] < np.arange(len(made))).all() and (born[right] < np.arange(len(made))).all()
        )

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """When neighbours are merged; NEVER if they are not."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER)

    def counts(self, words: list[bytes]) -> list[int]:
        """How many symbols survive in each of some non-empty pre-tokens."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out = np.zeros(len(words), np.int64)
        long = lengths > LONG if self.rising else np.zeros(len(words), bool)
        for i in np.flatnonzero(long).tolist():
            out[i] = self._long(self.symbols[np.frombuffer(words[i], np.uint8)])
        short = np.flatnonzero(~long)
        flat = np.frombuffer(b"".join(words[i] for i in short.tolist()), np.uint8)
        self._rounds(self.symbols[flat], lengths[short], short, out)
        return out.tolist()

    def _rounds(
        self, symbols: np.ndarray, lengths: np.ndarray, which: np.ndarray, out: np.ndarray, left: list | None = None
    ) -> None:
        """Merge ragged sequences, all together round by round; ``out[which]`` gets how many symbols are left of each, and
        ``left`` (which, how many, the symbols) of those done in a round."""
        ranks = np.full(len(symbols), NEVER)
        ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
        ranks[np.cumsum(lengths) - 1] = NEVER
        while len(which):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NEVER
            if done.any():
                out[which[done]] = lengths[done]
                stay = np.repeat(~done, lengths)
                if left is not None:
                    left.append((which[done], lengths[done], symbols[~stay]))
                symbols, ranks = symbols[stay], ranks[stay]
                which, lengths, lowest = which[~done], lengths[~done], lowest[~done]
                if not len(which):
                    return
                starts = np.cumsum(lengths) - lengths
            at = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            at = at[_every_other(at[1:] == at[:-1] + 1)]
            owner = np.searchsorted(starts, at, "right") - 1
            if not self.rising:
                first = np.ones(len(at), bool)
                first[1:] = owner[1:] != owner[:-1]
                at, owner = at[first], owner[first]
            symbols[at] = self.made_at[ranks[at]]
            stays_last = np.zeros(len(symbols), bool)
            stays_last[starts + lengths - 1] = True
            stays_last[at] = stays_last[at + 1]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, ranks, last = symbols[stay], ranks[stay], stays_last[stay]
            at = at - np.arange(len(at))  # each merge before has taken one symbol away
            changed = np.concatenate([at, at[at > 0] - 1])
            inside = ~last[changed]
            ranks[changed] = NEVER
            changed = changed[inside]
            ranks[changed] = self.rank(symbols[changed], symbols[changed + 1])
            lengths = lengths - np.bincount(owner, minlength=len(lengths))

    def _long(self, symbols: np.ndarray) -> int:
        """What is left of one long sequence: places wait under their ranks, in a list linked both ways."""
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ranks = np.full(n, NEVER)
        ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[ranks[places] != NEVER]
            places = places[np.argsort(ranks[places], kind="stable")]
            values, begins = np.unique(ranks[places], return_index=True)
            for value, some in zip(values.tolist(), np.split(places, begins[1:])):
                if value not in waiting:
                    heapq.heappush(heap, value)
                waiting.setdefault(value, []).append(some)

        wait(np.arange(n))
        left = n
        while heap:
            rank = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            at = at[ranks[at] == rank]
            at = at[_every_other(after[at[:-1]] == at[1:])] if len(at) else at
            taken = after[at]
            symbols[at] = self.made_at[rank]
            ranks[taken] = NEVER
            after[at] = after[taken]
            inner = at[after[at] < n]
            before[after[inner]] = inner
            left -= len(at)
            changed = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
            ranks[changed] = NEVER
            changed = changed[after[changed] < n]
            ranks[changed] = self.rank(symbols[changed], symbols[after[changed]])
            wait(changed)
        return left


def _every_other(follows: np.ndarray) -> np.ndarray:
    """Of places in order, those to merge: the first, third, ... of each run of places that overlap the one before."""
    place = np.arange(len(follows) + 1)
    opens = np.ones(len(place), bool)
    opens[1:] = ~follows
    return (place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0


class Counter:
    """Counts the tokens of whole texts; remembers those of short pre-tokens."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.pattern = regex.compile(PRE_TOKENS)
        self.special = regex.compile("|".join(map(regex.escape, self.merges.special)) or r"(?!)")
        self.known: dict[str, int] = {}

    def _runs(self, text: str) -> Iterable[list[str]]:
        """The pre-tokens between special strings, in lists of bounded length."""
        for part in self.special.split(text):
            if len(part) <= WHOLE:
                yield self.pattern.findall(part)
            else:
                matches = (m.group() for m in self.pattern.finditer(part))
                while run := list(islice(matches, RUN)):
                    yield run

    def _learn(self, words: set[str]) -> dict[str, int]:
        new = [w for w in words if w not in self.known]
        counted = dict(zip(new, self.merges.counts([w.encode() for w in new]))) if new else {}
        if len(self.known) + len(counted) > KNOWN:
            self.known = {}
        self.known.update((w, n) for w, n in counted.items() if len(w) <= SHORT)
        return counted

    def _sums(self, runs: list[list[str]]) -> list[int]:
        words = {w for run in runs for w in run}
        kept = {w: self.known[w] for w in words if w in self.known}  # learning may forget them
        kept |= self._learn(words - kept.keys())
        return [sum(map(kept.__getitem__, run)) for run in runs]

    def counts(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        size = 0

        def settle() -> None:
            for (i, _), n in zip(held, self._sums([run for _, run in held])):
                out[i] += n

        for i, text in enumerate(texts):
            if not text:
                continue
            out[i] += len(self.special.findall(text))
            for run in self._runs(text):
                held.append((i, run))
                size += len(run)
                if size >= RUN:
                    settle()
                    held, size = [], 0
        settle()
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` of every text; ``over_limit`` says ``n_tokens > limit``.

    ``path`` is a byte-level merge file, to be found under the same name on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in small_batches(batches):
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            tokens = pa.array(count.counts(batch.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, tokens], ["key", "n_bytes", "n_tokens"])

    schema = docs.select(F.col(key)).schema.add("n_bytes", "long").add("n_tokens", "long")
    counted = docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
