"""Removal of passages that were said before: seed on winnowed anchors, extend, keep maximal repeats.

Every run of ``WINDOW`` words holds ``WINDOW - ANCHOR + 1`` runs of ``ANCHOR`` words; the one of least
hash is its anchor (winnowing), so equal windows have equal anchors at equal places. Windows that
follow each other and share an anchor form a segment: the anchor extended both ways as far as it is
the seed. Occurrences meet under their anchor. Of equal segments all but the first go at once; where
one anchor has several segments, so that copies begin or end there, the segments that stayed are
extended window by window and compared again. Removed windows that overlap merge to maximal repeats.

No group is gathered: occurrences are sorted under their hash and read as a stream. Before that each
task drops, within every batch, all but the first of equal segments, so a passage that a third of all
documents share sends a row per batch, not one per document.

Rows: a null or empty text has no words. A row without ``key`` cannot come earlier or later than others
and keeps all its words. Rows repeated exactly count as one document and come back as often as given;
rows with the same key but other texts lose the passages found under that key in either. Other
columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.llm.batches import Words, mix, ranges, small_batches
from chronomart.llm.scratch import written

WINDOW = 20
ANCHOR = 8

REMOVE, CHECK = 0, 1
_OCCURRENCES = "deal long, a long, b long, doc long, start int, n int"
_FOUND = "doc long, start int, n int, what int"


def _segments(words: Words) -> tuple[np.ndarray, ...]:
    """Of each segment: the anchor's hash, a hash of all its words, its first window and their number."""
    n, doc = len(words.hashes), words.doc_of()
    last = words.end[doc] if n else doc
    begins = np.arange(n)
    windows = begins[begins + WINDOW <= last]
    if not len(windows):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at = np.arange(n - ANCHOR + 1)
    anchors = ranges(words.hashes, at, at + ANCHOR, 1)
    seen = np.lib.stride_tricks.sliding_window_view(anchors, WINDOW - ANCHOR + 1)
    seed = seen[windows].argmin(1) + windows
    first = np.flatnonzero(np.diff(seed, prepend=-1))
    count = np.diff(first, append=len(seed))
    start = windows[first]
    whole = ranges(words.hashes, start, start + count - 1 + WINDOW, 2)
    return anchors[seed[first]].view(np.int64), whole.view(np.int64), start, count


def _earliest(a: np.ndarray, b: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which rows have no row with the same (a, b) at an earlier place."""
    order = np.lexsort((start, doc, b, a))
    a, b, doc, start = (x[order] for x in (a, b, doc, start))
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    first = np.zeros(len(order), bool)
    first[order] = (doc == doc[at]) & (start == start[at])
    return first


def _deal(a, b, doc, start, n) -> pa.RecordBatch:
    """Rows to be sorted under their hashes; those known to be repeats (b null) pass under their key."""
    first = _earliest(a, b, doc, start)
    deal = np.where(first, a, mix(doc.view(np.uint64)).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(deal),
            pa.array(a, mask=~first),
            pa.array(b, mask=~first),
            pa.array(doc),
            pa.array(start.astype(np.int32)),
            pa.array(n.astype(np.int32)),
        ],
        ["deal", "a", "b", "doc", "start", "n"],
    )


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 1_000_000):
        words = Words(batch.column(1))
        a, b, start, n = _segments(words)
        row = words.doc_of()[start]
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        yield _deal(a, b, keys[row].astype(np.int64), start - words.begin[row], n)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decisions over rows sorted by (a, b, doc, start): repeats go, ambiguous firsts are to be checked."""
    held = None  # the latest first of its (a, b): (a, b, doc, start, n, whether a is shared)
    for batch in batches:
        if not batch.num_rows:
            continue
        known = batch.filter(batch.column(1).is_null())
        if known.num_rows:
            yield _found(*(known.column(i).to_numpy() for i in (3, 4, 5)), REMOVE)
        batch = batch.filter(batch.column(1).is_valid())
        if not batch.num_rows:
            continue
        a, b, doc, start, n = (batch.column(i).to_numpy() for i in range(1, 6))
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        if held is not None:
            new[0] = (a[0], b[0]) != held[:2]
        at = np.maximum.accumulate(np.where(new, np.arange(len(a)), -1))
        first = [np.where(at >= 0, x[at], h) for x, h in ((doc, held[2] if held else 0), (start, held[3] if held else 0))]
        gone = (doc != first[0]) | (start != first[1])
        yield _found(doc[gone], start[gone], n[gone], REMOVE)
        at = np.flatnonzero(new)
        if not len(at):
            continue
        firsts = [x[at] for x in (a, b, doc, start, n)] + [np.zeros(len(at), bool)]
        if held is not None:
            firsts = [np.concatenate([[h], f]) for h, f in zip(held, firsts)]
        same = firsts[0][1:] == firsts[0][:-1]
        firsts[5][1:] |= same
        firsts[5][:-1] |= same
        held = tuple(f[-1] for f in firsts)
        out = firsts[5].copy()
        out[-1] = False
        yield _found(*(f[out] for f in firsts[2:5]), CHECK)
    if held is not None and held[5]:
        yield _found(*(np.array([x]) for x in held[2:5]), CHECK)


def _found(doc, start, n, what: int) -> pa.RecordBatch:
    columns = [doc.astype(np.int64), start.astype(np.int32), n.astype(np.int32)]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, columns), pa.array(np.full(len(doc), what, np.int32))],
        ["doc", "start", "n", "what"],
    )


def _decide(occurrences: DataFrame) -> DataFrame:
    return (
        occurrences.repartition("deal")
        .sortWithinPartitions("a", "b", "doc", "start")
        .mapInArrow(_repeats, _FOUND)
    )


def _covered(n: int, found: list[dict], what: int) -> np.ndarray:
    """Which of ``n`` words lie in a removed window."""
    edges = np.zeros(n + 1, np.int64)
    for f in found:
        if f["what"] == what and f["start"] + f["n"] - 1 + WINDOW <= n:
            edges[f["start"]] += 1
            edges[f["start"] + f["n"] - 1 + WINDOW] -= 1
    return edges.cumsum()[:n] > 0


_PENDING = "doc long, n_words long, kept array<int>, text string, found array<struct<start:int,n:int,what:int>>"


def _kept_spans(mask: np.ndarray) -> list[int]:
    """Begin and end, in turn, of the runs of kept words."""
    return np.flatnonzero(np.diff(mask, prepend=False, append=False)).tolist()


def _settle(last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                n, found = len((text or "").encode().split()), found or []
                covered = _covered(n, found, REMOVE)
                # Even if all its words are gone: its windows may be the first that later documents repeat.
                open_ = any(f["what"] == CHECK for f in found)
                done = last or not open_
                out.append((doc, n, _kept_spans(~covered) if done else None, text, [] if done else found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), _ARROW)], ["doc", "n_words", "kept", "text", "found"]
            )

    return run


_ARROW = [
    pa.int64(),
    pa.int64(),
    pa.list_(pa.int32()),
    pa.string(),
    pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("what", pa.int32())])),
]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of segments to be checked, one by one."""
    for batch in small_batches(batches, 1_000_000):
        words = Words(batch.column(1))
        starts, rows = [], []
        for i, found in enumerate(batch.column(2).to_pylist()):
            for f in found:
                if f["what"] == CHECK:
                    starts.append(np.arange(f["start"], f["start"] + f["n"]) + words.begin[i])
                    rows.append(np.full(f["n"], i))
        if not starts:
            continue
        start, row = np.concatenate(starts), np.concatenate(rows)
        fits = start + WINDOW <= words.end[row]
        start, row = start[fits], row[fits]
        a, b = (ranges(words.hashes, start, start + WINDOW, k).view(np.int64) for k in (1, 2))
        keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        yield _deal(a, b, keys[row], start - words.begin[row], np.ones(len(row), np.int64))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, n_words, kept array<int>, text)``: begin and end, in turn, of the runs of words that stay.

    Runs jobs and writes to the shared folder: decisions, then texts that still need checks.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    seeds = docs.where("doc is not null").mapInArrow(_seeds, _OCCURRENCES)
    decided = written(_decide(seeds), "repeats")
    pending = written(_with(docs, decided).mapInArrow(_settle(False), _PENDING), "pending")
    open_ = pending.where("kept is null")
    windows = open_.select("doc", "text", "found").mapInArrow(_windows, _OCCURRENCES)
    more = _decide(windows).where(F.col("what") == REMOVE)
    known = open_.select("doc", F.inline("found")).where(F.col("what") == REMOVE)
    settled = _with(open_.select("doc", "text"), known.unionByName(more)).mapInArrow(
        _settle(True), _PENDING
    )
    columns = ["doc", "n_words", "kept", "text"]
    return pending.where("kept is not null").select(*columns).unionByName(settled.select(*columns))


def _with(docs: DataFrame, found: DataFrame) -> DataFrame:
    lists = found.groupBy("doc").agg(F.collect_list(F.struct("start", "n", "what")).alias("found"))
    return docs.join(lists, "doc", "left").select("doc", "text", "found")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_removed, kept)``: the words that stay, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            kept, removed = [], []
            for n, spans, value in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                words = (value or "").encode().split()
                parts = [w for i in range(0, len(spans), 2) for w in words[spans[i] : spans[i + 1]]]
                kept.append(b" ".join(parts).decode())
                removed.append(n - len(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["key", "n_words", "n_removed", "kept"],
            )

    return repeated_spans(docs, key, text).mapInArrow(
        run, f"`{key}` long, n_words long, n_removed long, kept string"
    )
