"""Ids of a lower-casing BPE with word ends, as the tokenizers library gives them, a batch of texts at a time.

The library's own call is slow on texts of many rare words. Here texts are cut at white space, and words not met before
are merged together as ragged arrays, round by round (see ``token_counts``); the ids of all words lie in one flat
array, from which those of a text are gathered. Texts with characters outside ``PLAIN``, where normal forms
and letter tables matter, go to the library whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from chronomart.llm.batches import Places, gathered
from chronomart.llm.byte_bpe import MARKS
from chronomart.llm.token_counts import LONG, Merges, _byte_characters

#: Characters that are their own canonical form and whose case is the same in any table.
PLAIN = frozenset(map(chr, [*range(0x1C), *range(0x20, 0x250), *range(0x2010, 0x2028), 0x20AC]))
#: Of them, those beyond ASCII that are neither letters nor digits.
WIDE_MARKS = frozenset(c for c in PLAIN if c > "\x7f" and not c.isalnum())
#: Bytes as one of three kinds: white space, ASCII marks, and all else.
KINDS = bytes(0x20 if chr(b).isspace() and b < 0x80 else 0x2E if b < 0x80 and not chr(b).isalnum() else 0x61 for b in range(256))
MARKS_IN_A_ROW = re.compile(r"[^\w\s][^\w\s]|_[,.]|[^\w\s]_")
#: Characters of a text whose words are held at once.
RUN = 4_000_000


class WordMerges(Merges):
    """Merges of pieces whose last byte is a symbol of its own."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.ends = np.array([model["vocab"][c + model["end_of_word_suffix"]] for c in _byte_characters()], np.int64)

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A flat array of ids, and where those of each piece start and how many they are."""
        data = [piece.encode() for piece in pieces]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        flat = np.frombuffer(b"".join(data), np.uint8)
        symbols, last = self.symbols[flat], np.cumsum(lengths) - 1
        symbols[last] = self.ends[flat[last]]
        counts = np.zeros(len(data), np.int64)
        left = [(np.zeros(0, np.int64),) * 3]
        self._rounds(symbols, lengths, np.arange(len(data)), counts, left)
        which = np.concatenate([w for w, _, _ in left])
        sizes = np.concatenate([n for _, n, _ in left])
        starts = np.empty(len(data), np.int64)
        starts[which] = np.cumsum(sizes) - sizes
        return np.concatenate([ids for _, _, ids in left]).astype("<u4"), starts, counts


class WordBpe:
    """``max_words`` bounds the words whose ids are remembered."""

    def __init__(self, path: str, max_words: int = 500_000):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            splitter = json.load(file)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(splitter)
        self.merges = WordMerges(path)
        self.max_words = max_words
        self._forget()

    def _forget(self) -> None:
        self.places = Places()
        self.flat = np.zeros(0, "<u4")
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _pieces_of(self, word: str) -> list[str]:
        if word.isalpha():
            return [word]
        if word[-1] in MARKS and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.pieces.findall(word)

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``WordMerges.ids``; pieces of more than ``LONG`` characters, which would need many rounds, go to the library."""
        short = [piece for piece in pieces if len(piece) <= LONG]
        long = [np.array(self.library.encode(p, add_special_tokens=False).ids, "<u4") for p in pieces if len(p) > LONG]
        flat, starts, counts = self.merges.ids(short)
        sizes = np.fromiter(map(len, long), np.int64, len(long))
        is_long = np.fromiter((len(piece) > LONG for piece in pieces), bool, len(pieces))
        out_starts, out_counts = (np.empty(len(pieces), np.int64) for _ in range(2))
        out_starts[~is_long], out_counts[~is_long] = starts, counts
        out_starts[is_long], out_counts[is_long] = len(flat) + np.cumsum(sizes) - sizes, sizes
        return np.concatenate([flat, *long]), out_starts, out_counts

    def _learn(self) -> None:
        """Add the ids of new words to the flat array."""
        words, self.places.new = self.places.new, []
        parts = [self._pieces_of(word) for word in words]
        place = {piece: i for i, piece in enumerate(dict.fromkeys(p for some in parts for p in some))}
        many = np.fromiter(map(len, parts), np.int64, len(parts))
        each = np.fromiter((place[p] for some in parts for p in some), np.int64, int(many.sum()))
        flat, starts, counts = self._merged(list(place))
        sums = np.concatenate([[0], np.cumsum(counts[each])])
        ends = np.cumsum(many)
        lengths = sums[ends] - sums[ends - many]
        held = len(self.flat)
        self.flat = np.concatenate([self.flat, gathered(flat, starts[each], counts[each])])
        self.starts = np.concatenate([self.starts, held + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])

    def _words(self, text: str, wide: bool) -> Iterator[list[str]]:
        """The words of a text, in lists of bounded size; cuts are at spaces, where words end in any case. ``wide``
        says that marks beyond ASCII are among its characters."""
        begin = 0
        while begin < len(text):
            end = text.find(" ", begin + RUN)
            end = len(text) if end < 0 else end
            part = text[begin:end].lower()
            in_a_row = MARKS_IN_A_ROW.search(part) if wide else b".." in part.encode().translate(KINDS)
            if not in_a_row:
                # Marks at the end of words become words: fewer different ones to remember.
                part = part.replace(", ", " , ").replace(". ", " . ").replace(".\n", " .\n")
            yield part.split()
            begin = end

    def _ids(self, runs: list[list[str]]) -> list[np.ndarray]:
        if len(self.places) > self.max_words:
            self._forget()
        get = self.places.__getitem__
        found = [np.fromiter(map(get, words), np.int64, len(words)) for words in runs]
        self._learn()
        return [gathered(self.flat, self.starts[at], self.lengths[at]) for at in found]

    def ids(self, text: str) -> list[int]:
        return self.batch([text])[0].tolist()

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a null text has none."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def settle() -> None:
            for (i, _), ids in zip(held, self._ids([words for _, words in held])):
                out[i].append(ids)

        for i, text in enumerate(texts):
            characters = set(text or "")
            if not characters <= PLAIN:
                out[i].append(np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4"))
                continue
            for words in self._words(text or "", not characters.isdisjoint(WIDE_MARKS)):
                held.append((i, words))
                size += len(words)
                if size > RUN // 8:
                    settle()
                    held, size = [], 0
        settle()
        return [np.concatenate(parts) if parts else np.zeros(0, "<u4") for parts in out]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
