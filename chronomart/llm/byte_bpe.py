"""Byte-level BPE as a finite-state transducer, and its streaming inverse.

The merges are compiled into a transducer over bytes. It rests on a property of BPE: a sequence of
tokens is the encoding of its bytes exactly if every two neighbours are, so the last token of each
prefix follows from the last tokens of shorter prefixes. While reading a piece the transducer keeps
the ends that a later token may still start from, and emits every token all of them agree on. Whatever
follows passes through the end of what was emitted, so the rest is encoded as if it began there: the state is
the bytes read since, never more than a few token lengths (the bounded lookahead). States and arcs are
made when a text first needs them (lazy determinisation) and dropped together when there are too many,
which bounds memory.

Rows: a null text is read as empty and gives no ids; other columns are not carried. Repeated rows
give repeated results. A piece, however long, is read byte by byte, so there is no limit on texts.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from chronomart.llm.batches import Places, gathered, small_batches

START = -1
NEVER = 1 << 60
#: Marks that never belong to the word before them; the empty string is none.
MARKS = tuple(".,;:!?")
RUN_OF_SPACES = re.compile(r"\s\s")


class Ranks:
    """A rank file: tokens by id, ids by token, and plain merging as the definition of both."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.tokens = {i: t for t, i in self.ids.items()}

    def parts(self, piece: bytes) -> list[bytes]:
        return [piece[i : i + 1] for i in range(len(piece))]

    def rank(self, left: bytes, right: bytes) -> int:
        """When two neighbours are merged; NEVER if they are not."""
        return self.ids.get(left + right, NEVER)

    def merge(self, piece: bytes, until: int = 1) -> list[bytes]:
        """Merge the neighbours of lowest rank, leftmost first, until none can be merged or ``until`` are left."""
        parts = self.parts(piece)
        ranks = [self.rank(a, b) for a, b in zip(parts, parts[1:])]
        while len(parts) > until:
            best = min(ranks, default=NEVER)
            if best == NEVER:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = self.rank(parts[at - 1], parts[at])
            if at < len(ranks):
                ranks[at] = self.rank(parts[at], parts[at + 1])
        return parts


class Transducer:
    """States are numbered; ``arcs`` leads from 256 * state + byte to (256 * the next state, tokens emitted).

    Of each state are known the bytes not yet emitted, the token that ends at each of their ends, and the ends
    at which a token longer than what follows may begin. Whole numbers and tuples keep the tables
    small and out of the garbage collector's way.
    """

    def __init__(self, ranks: Ranks, max_states: int = 200_000):
        self.ranks, self.max_states = ranks, max_states
        self.prefixes = {t[:n] for t in ranks.ids for n in range(1, len(t))}
        self._forget()

    def _forget(self) -> None:
        self.joins: dict[tuple[int, int], bool] = {}
        self.made: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.states: list[tuple[bytes, tuple[int, ...], tuple[int, ...]]] = [(b"", (START,), (0,))]
        self.numbers: dict[bytes, int] = {b"": 0}
        self.arcs: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.rests: dict[int, tuple[int, ...]] = {}

    def _made(self, token: bytes) -> tuple[int, bytes, bytes]:
        """When merging makes a token, and of which halves: (-1, ...) for one that is there from the start,
        (NEVER, ...) for one that merging its bytes does not give."""
        known = self.made.get(token)
        if known is None:
            halves = self.ranks.merge(token, until=2)
            known = -1, token, token
            if len(halves) > 1:
                left, right = halves[0], halves[-1]
                rank = self.ranks.rank(left, right) if len(halves) == 2 else NEVER
                known = rank, left, right
            self.made[token] = known
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Whether ``right`` stays a token of its own when it follows ``left``.

        Backwards in time: the later made of the two is taken apart, which leaves the halves that met at the seam
        before; had they been merged earlier than it was made (at equal rank the left one is first), the
        seam would not have stayed.
        """
        known = self.joins.get((left, right))
        if known is None:
            b = self.ranks.tokens[right]
            known = self._made(b)[0] != NEVER
            if known and left != START:
                a, limit = self.ranks.tokens[left], NEVER
                while known := self.ranks.rank(a, b) >= limit:
                    (made_a, _, tail), (made_b, head, _) = self._made(a), self._made(b)
                    if made_a == made_b == -1:
                        break
                    if made_a > made_b:
                        a, limit = tail, made_a
                    else:
                        b, limit = head, made_b + 1
            self.joins[left, right] = known
        return known

    def _before(self, last: list[int], end: int) -> int:
        return end - len(self.ranks.tokens[last[end]])

    def _path(self, last: list[int], end: int) -> tuple[int, ...]:
        """The tokens on the way to ``end``."""
        path = []
        while end:
            path.append(last[end])
            end = self._before(last, end)
        return tuple(path[::-1])

    def _read(self, place: int) -> tuple[int, tuple[int, ...]]:
        """The arc for 256 * state + byte."""
        before, ends, opens = self.states[place >> 8]
        pending = before + bytes((place & 255,))
        tokens = ((begin, self.ranks.ids.get(pending[begin:])) for begin in opens)
        last = (*ends, next(t for b, t in tokens if t is not None and self._fits(ends[b], t)))
        opens = (*(b for b in opens if pending[b:] in self.prefixes), len(pending))
        # The end that the ways to all open ends pass: step back from the furthest until one is left.
        ways = set(opens)
        while len(ways) > 1:
            furthest = max(ways)
            ways.remove(furthest)
            ways.add(self._before(last, furthest))
        agreed = ways.pop()
        number = self.numbers.setdefault(pending[agreed:], len(self.states))
        if number == len(self.states):
            self.states.append(
                (pending[agreed:], (START, *last[agreed + 1 :]), tuple(b - agreed for b in opens))
            )
        self.arcs[place] = arc = number << 8, self._path(last, agreed)
        return arc

    def _rest(self, state: int) -> tuple[int, ...]:
        """The tokens still to come when the piece ends here."""
        rest = self.rests.get(state)
        if rest is None:
            pending, last, _ = self.states[state >> 8]
            rest = self.rests[state] = self._path(last, len(pending))
        return rest

    def stream(self, piece: Iterable[int]) -> Iterator[int]:
        """Ids of one piece as soon as they are certain."""
        state = 0
        for byte in piece:
            state, emitted = self.arcs.get(state | byte) or self._read(state | byte)
            yield from emitted
        yield from self._rest(state)

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        if len(self.states) > self.max_states:
            self._forget()
        ids: list[int] = []
        state, arcs = 0, self.arcs
        for byte in piece:
            state, emitted = arcs.get(state | byte) or self._read(state | byte)
            if emitted:
                ids += emitted
        ids += self._rest(state)
        return ids


class Utf8State:
    """The bytes of a character not yet complete; ``arcs``: token to (state, complete bytes)."""

    __slots__ = ("arcs", "held")

    def __init__(self, held: bytes):
        self.held = held
        self.arcs: dict[int, tuple[Utf8State, bytes]] = {}


def incomplete(data: bytes) -> int:
    """How many bytes at the end of ``data`` begin a character that needs more bytes."""
    for back in range(1, min(3, len(data)) + 1):
        byte = data[-back]
        if byte >= 0xC0:  # a lead byte says how long its character is
            needed = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
            return back if needed > back else 0
        if byte < 0x80:
            return 0
    return 0


class StreamDecoder:
    """Ids to bytes, given out at character ends only: the UTF-8 state machine over whole tokens."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.states: dict[bytes, Utf8State] = {}
        self.start = self._state(b"")
        self.open = frozenset(i for i, token in ranks.tokens.items() if incomplete(token))

    def _state(self, held: bytes) -> Utf8State:
        return self.states.setdefault(held, Utf8State(held))

    def _read(self, state: Utf8State, token: int) -> tuple[Utf8State, bytes]:
        data = state.held + self.ranks.tokens[token]
        cut = len(data) - incomplete(data)
        arc = self._state(data[cut:]), data[:cut]
        state.arcs[token] = arc
        return arc

    def stream(self, ids: Iterable[int]) -> Iterator[bytes]:
        """Whole characters as they become complete; bytes that end within one come last."""
        state = self.start
        for token in ids:
            state, done = state.arcs.get(token) or self._read(state, token)
            if done:
                yield done
        if state.held:
            yield state.held

    def whole(self, ids: list[int]) -> bytes:
        """All bytes at once. Up to the first token that ends within a character the machine stays in its first state."""
        if self.open.isdisjoint(ids):
            return b"".join(map(self.ranks.tokens.__getitem__, ids))
        return b"".join(self.stream(ids))


@lru_cache(maxsize=2)
def _ranks(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def _transducer(path: str) -> Transducer:
    return Transducer(_ranks(path))


class Encoder:
    """Ids of whole texts; remembers those of about ``max_parts`` parts between single spaces.

    ``spaced`` says that the pattern takes a space and the letters after it as one match and a mark at the end of
    a word as another, so what lies between single spaces can be encoded by itself. Parts are numbered on first sight
    and their ids lie in one flat array, from which those of a text are gathered. A part has no space in it, so one that
    begins with a space stands for the beginning of a text, which none precedes.
    """

    def __init__(self, path: str, pattern: str, spaced: bool, max_parts: int = 400_000):
        self.transducer = _transducer(path)
        self.pieces = regex.compile(pattern)
        self.spaced, self.max_parts = spaced, max_parts
        self.marks = {mark: self.piece(mark) for mark in MARKS}
        self.line = self.piece("\n")
        self._forget()

    def _forget(self) -> None:
        self.places = Places()
        self.flat = np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def piece(self, text: str) -> list[int]:
        data = text.encode()
        # Only a whole piece may be a token that merging does not reach.
        whole = self.transducer.ranks.ids.get(data)
        return self.transducer.encode(data) if whole is None else [whole]

    def part(self, text: str) -> list[int]:
        """Ids of a text that begins and ends where matches of the pattern do."""
        return [i for piece in self.pieces.findall(text) for i in self.piece(piece)]

    def _word(self, word: str, fresh: dict[str, list[int]]) -> list[int]:
        """Ids of letters after a space, remembered without the mark that follows: there are fewer of them."""
        place = self.places.get(word)
        if place is not None and place < len(self.starts):
            return self.flat[self.starts[place] : self.starts[place] + self.lengths[place]].tolist()
        if word not in fresh:
            fresh[word] = self.piece(" " + word)
            _ = self.places[word]
        return fresh[word]

    def _learn(self) -> None:
        """Add the ids of new parts to the flat array."""
        fresh: dict[str, list[int]] = {}
        found, sizes = [], []
        for part in self.places.new:  # grows by words that came with a mark only
            if part.isalpha():
                ids = self._word(part, fresh)
            elif part[:1] == " ":
                ids = self.part(part[1:])
            else:
                # A word, its mark and a line break before other letters: all three are matches of their own.
                word, line, rest = part.partition("\n")
                line = line and rest[:1].isalpha()
                mark = self.marks.get(word[-1:])
                if mark is not None and word[:-1].isalpha() and (line or word == part):
                    ids = self._word(word[:-1], fresh) + mark
                    if line:
                        ids = ids + self.line + self.part(rest)
                else:
                    ids = self.part(" " + part)
            found += ids
            sizes.append(len(ids))
        self.places.new = []
        lengths = np.array(sizes, np.int64)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, np.array(found, np.int32)])

    def ids(self, text: str) -> list[int]:
        return self.batch([text])[0].tolist()

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a null text has none."""
        if len(self.places) > self.max_parts:
            self._forget()
        get, out, cut = self.places.__getitem__, [], {}
        for i, text in enumerate(texts):
            text = text or ""
            if not self.spaced or RUN_OF_SPACES.search(text):
                out.append(np.array(self.part(text), np.int32))
                continue
            parts = text.split(" ")
            parts[0] = " " + parts[0]
            cut[i] = np.fromiter(map(get, parts), np.int64, len(parts))
            out.append(None)
        self._learn()
        for i, at in cut.items():
            out[i] = gathered(self.flat, self.starts[at], self.lengths[at])
        return out


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str, spaced: bool) -> Encoder:
    return Encoder(path, pattern, spaced)


def encode(
    docs: DataFrame, path: str, pattern: str, spaced: bool = False, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, ids array<int>)`` of every text.

    ``path`` is the rank file, to be found under the same name on every executor; each match of
    ``pattern`` is encoded by itself. For ``spaced`` see ``Encoder``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern, spaced)
        for batch in small_batches(batches):
            yield _lists(batch.column(0), encoder.batch(batch.column(1).to_pylist()))

    schema = docs.select(F.col(key)).schema.add("ids", ArrayType(IntegerType()))
    return docs.select(key, text).mapInArrow(run, schema)


def _lists(keys: pa.Array, rows: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows), pa.int32()))
    return pa.RecordBatch.from_arrays([keys, lists], ["key", "ids"])


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, ids, bytes binary)``; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = StreamDecoder(_ranks(path))
        for batch in small_batches(batches):
            lists = batch.column(1)
            flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            texts = [decoder.whole(flat[begin:end].tolist()) for begin, end in zip(ends - sizes, ends)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], ["key", "ids", "bytes"]
            )

    schema = encoded.select(key, ids).schema.add("bytes", BinaryType())
    return encoded.select(key, ids).mapInArrow(run, schema)
