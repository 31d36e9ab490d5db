"""Secrets in texts: fixed patterns, and formats learnt from labelled credentials.

For each format a prefix tree of labelled credentials is folded into a probabilistic automaton: states whose
outgoing frequencies, and those of all states below them, are compatible by Hoeffding's bound are merged.
Where a place holds one of few characters (a prefix) these are the symbols, elsewhere character classes are.
A candidate is a run of credential characters; it is a secret of a format if its walk through the automaton
ends in an end state, its likelihood is one that held-out credentials reach, and it is likelier than prose.

Labelled credentials are drawn by rule, ``EXAMPLES`` for each format, with a fixed seed: the models do not
depend on the corpus. Rows: a null text is read as empty; texts are scanned whole; repeated rows are scanned each.
Only the columns named are read; ``redact`` carries the others.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from chronomart.llm.batches import small_batches

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "format")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
EXAMPLES = 400
HELD_OUT = 200
ALPHA = 0.05
FEW = 2

CLASSES = {c: name for name, chars in (
    ("hex letter", "abcdef"), ("lower", "ghijklmnopqrstuvwxyz"), ("hex capital", "ABCDEF"),
    ("upper", "GHIJKLMNOPQRSTUVWXYZ"), ("digit", string.digits), ("mark", "+/_-="),
) for c in chars}
SIZES = Counter(CLASSES.values())
#: How often prose uses each class.
PROSE = {"hex letter": 0.30, "lower": 0.60, "hex capital": 0.02, "upper": 0.03, "digit": 0.03, "mark": 0.02}

_ALNUM = string.ascii_letters + string.digits
_CAPITALS = string.ascii_uppercase + "234567"
#: Credentials by rule: (prefix, alphabet, length) parts of each format.
FORMATS = {
    "cloud key": [("ASIA", _CAPITALS, 16)],
    "access key": [("AKIA", _CAPITALS, 16)],
    "code host token": [("ghp_", _ALNUM, 36)],
    "payment key": [("sk_live_", _ALNUM, 24)],
    "chat token": [("xoxb-", string.digits, 12), ("-", string.digits, 12), ("-", _ALNUM, 24)],
    "map key": [("AIza", _ALNUM + "_-", 35)],
    "web token part": [("eyJ", _ALNUM + "_-", 33)],
    "secret of 40": [("", _ALNUM + "+/", 40)],
}


def labelled(format_name: str, n: int, seed: int = 11) -> list[str]:
    rng = random.Random(f"{format_name}/{seed}")
    return [
        "".join(p + "".join(rng.choices(chars, k=size)) for p, chars, size in FORMATS[format_name])
        for _ in range(n)
    ]


class Automaton:
    """Grammar of one format. ``next[state][symbol]`` is the state reached, ``counts`` how often."""

    def __init__(self, examples: list[str]):
        self.lengths = {len(x) for x in examples}
        self.fixed: list[frozenset[str]] = []
        for place in range(max(map(len, examples))):
            seen = frozenset(x[place] for x in examples if place < len(x))
            self.fixed.append(seen if len(seen) <= FEW else frozenset())
        self.next: list[dict[str, int]] = [{}]
        self.counts: list[Counter] = [Counter()]
        self.ends: list[int] = [0]
        for example in examples:
            self._add(example)
        self._fold()

    def symbol(self, place: int, char: str) -> str | None:
        if place < len(self.fixed) and self.fixed[place]:
            return char if char in self.fixed[place] else None
        return CLASSES.get(char)

    def _add(self, example: str) -> None:
        state = 0
        for place, char in enumerate(example):
            symbol = self.symbol(place, char)
            self.counts[state][symbol] += 1
            if symbol not in self.next[state]:
                self.next[state][symbol] = len(self.next)
                self.next.append({})
                self.counts.append(Counter())
                self.ends.append(0)
            state = self.next[state][symbol]
        self.ends[state] += 1

    def _total(self, state: int) -> int:
        return self.ends[state] + self.counts[state].total()

    def _compatible(self, a: int, b: int) -> bool:
        """By Hoeffding's bound, here and at all states reached from both."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            n, m = self._total(a), self._total(b)
            if n and m:
                bound = (n**-0.5 + m**-0.5) * math.sqrt(0.5 * math.log(2 / ALPHA))
                seen = {*self.counts[a], *self.counts[b]}
                pairs = [(self.ends[a], self.ends[b]), *((self.counts[a][s], self.counts[b][s]) for s in seen)]
                if any(abs(x / n - y / m) > bound for x, y in pairs):
                    return False
            waiting += [(self.next[a][s], self.next[b][s]) for s in self.next[a] if s in self.next[b] and a != b]
        return True

    def _join(self, a: int, b: int) -> None:
        """Fold the tree below ``b`` into ``a``."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            self.ends[a] += self.ends[b]
            self.counts[a] += self.counts[b]
            for symbol, below in self.next[b].items():
                if symbol in self.next[a]:
                    waiting.append((self.next[a][symbol], below))
                else:
                    self.next[a][symbol] = below

    def _fold(self) -> None:
        """States kept are compared in order of depth, so that lengths and prefixes are told apart only where
        the examples do; a state is merged with kept ones of its own depth."""
        level = [(None, None, 0)]
        while level:
            kept: list[int] = []
            for parent, symbol, state in level:
                same = next((k for k in kept if self._compatible(k, state)), None)
                if same is None:
                    kept.append(state)
                else:
                    self._join(same, state)
                    self.next[parent][symbol] = same
            level = [(k, s, below) for k in kept for s, below in self.next[k].items()]

    def likelihood(self, text: str) -> tuple[float, float] | None:
        """Mean logarithms, per character, of the classes' and of the characters' probability; None if the
        grammar does not end where the text does."""
        if len(text) not in self.lengths:
            return None
        state, classes, chars = 0, 0.0, 0.0
        for place, char in enumerate(text):
            symbol = self.symbol(place, char)
            below = self.next[state].get(symbol) if symbol else None
            if below is None:
                return None
            p = math.log(self.counts[state][symbol] / self._total(state))
            classes += p
            chars += p - (math.log(SIZES[symbol]) if symbol in SIZES else 0.0)
            state = below
        if not self.ends[state]:
            return None
        return classes / len(text), chars / len(text)


class Formats:
    """The automata of all formats, with the likelihood that all but one in 200 held-out credentials reach."""

    def __init__(self):
        self.models = {}
        for name in FORMATS:
            model = Automaton(labelled(name, EXAMPLES))
            found = sorted(x[0] for s in labelled(name, HELD_OUT, 12) if (x := model.likelihood(s)))
            self.models[name] = model, found[len(found) // 200]

    def match(self, text: str) -> str | None:
        prose = sum(math.log(PROSE[CLASSES[c]] / SIZES[CLASSES[c]]) for c in text) / len(text)
        best = None
        for name, (model, least) in self.models.items():
            found = model.likelihood(text)
            if found and found[0] >= least and found[1] > prose and (best is None or found[1] > best[0]):
                best = found[1], name
        return best and best[1]


@lru_cache(maxsize=1)
def formats() -> Formats:
    return Formats()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    lower = text.lower()
    found = []
    if any(k in lower for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by start, then kind; a learnt format never covers a base span."""
    found = base_spans(text)
    taken = [(a, b) for _, a, b in found]
    for m in CANDIDATE.finditer(text):
        if not any(a < m.end() and m.start() < b for a, b in taken) and formats().match(m[0]):
            found.append(("format", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, spans array<struct<kind,start,end>>)`` of every row, in code points, end exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [
                [dict(zip(("kind", "start", "end"), s)) for s in spans(value or "")]
                for value in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(_SPAN))], ["key", "spans"]
            )

    kind = StructType().add("kind", "string").add("start", "long").add("end", "long")
    schema = docs.select(F.col(key)).schema.add("spans", ArrayType(kind))
    return docs.select(key, text).mapInArrow(run, schema)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with each secret, overlapping spans as one, replaced by ``mark``; other columns as they are."""
    at = docs.columns.index(text)

    def clean(value: str | None) -> str | None:
        if not value or not (found := spans(value)):
            return value
        parts, done = [], 0
        for _, start, end in found:
            if start >= done:
                parts += [value[done:start], mark]
            done = max(done, end)
        return "".join([*parts, value[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = pa.array(map(clean, batch.column(at).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [texts if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names
            )

    return docs.mapInArrow(run, docs.schema)
