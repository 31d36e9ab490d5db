"""Packing of tokenised documents into sequences of bounded length, by best fit in rounds.

Each task packs its items best fit, longest first: an item goes to the open bin that it fills most. Bins
filled to within ``slack`` tokens are final. The others become items of the next round, met in fewer tasks
(each of at most about ``per_task`` items), and are packed again, until one task has seen them all or a round
hardly merges any. A bin carries its items, at most one per token; no task or group grows with the input.

Rows: a null text is read as empty and holds the closing id alone. Repeated rows are packed each. Texts
longer than ``capacity`` are cut, others never. Other columns are not carried; a null key stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomart.llm.batches import small_batches
from chronomart.llm.word_bpe import word_bpe
from chronomart.llm.scratch import written

_ITEM = "struct<doc:long,piece:int,start:long,length:long,crc:long>"
_BINS = f"size int, items array<{_ITEM}>"
_PIECES = pa.struct(
    [("doc", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]
)


def tokenised_pieces(docs: DataFrame, path: str, key: str, text: str, capacity: int, closing: int) -> DataFrame:
    """One row per piece: ``size`` and a single item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in small_batches(batches):
            rows = []
            for doc, tokens in zip(batch.column(0).to_pylist(), bpe.batch(batch.column(1).to_pylist())):
                ids = np.append(tokens, np.array(closing, "<u4"))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)]
            items = pa.StructArray.from_arrays(columns, fields=list(_PIECES))
            lists = pa.ListArray.from_arrays(pa.array(range(len(rows) + 1), pa.int32()), items)
            yield pa.RecordBatch.from_arrays([columns[3].cast(pa.int32()), lists], ["size", "items"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, _BINS)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: of the open bins the item fits in, the one with least room."""
    bins = np.empty(len(sizes), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some bin has room r
    made = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, chosen = capacity, made
            made += 1
        bins[item] = chosen
        if room > size:
            with_room[room - size].append(chosen)
            open_rooms |= 1 << (room - size)
    return bins


def _pack(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        sizes = table.column(0).to_numpy()
        bins = best_fit(sizes, capacity)
        order = np.argsort(bins, kind="stable")
        lists = pa.concat_arrays(table.column(1).chunks).take(pa.array(order))
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        first = np.concatenate([np.flatnonzero(np.diff(bins[order], prepend=-1)), [len(order)]])
        merged = pa.ListArray.from_arrays(pa.array(ends[first], pa.int32()), lists.flatten())
        filled = np.add.reduceat(sizes[order], first[:-1])
        for at in range(0, len(merged), 10_000):
            part = slice(at, at + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(filled[part], pa.int32()), merged[part]], ["size", "items"]
            )

    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items with their sequence and offset."""
    for batch in batches:
        lists = batch.column(1)
        counts = lists.value_lengths().to_numpy()
        items = lists.flatten()
        length = items.field("length").to_numpy()
        ends = np.cumsum(length)
        before = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])[:-1]]
        offset = ends - length - np.repeat(before, counts)
        sequence = pa.array(np.repeat(batch.column(0).to_numpy(), counts))
        yield pa.RecordBatch.from_arrays([*items.flatten(), sequence, pa.array(offset)], _COLUMNS)


_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    closing: int = 1,
    slack: int = 8,
    per_task: int = 100_000,
    max_rounds: int = 12,
) -> DataFrame:
    """One row per piece: where it starts in its document, its ids' length and CRC-32, its sequence and
    the offset there. Runs a job per round and writes bins, without texts, to the shared folder."""
    open_ = written(tokenised_pieces(docs, path, key, text, capacity, closing), "pieces")
    left = open_.count()
    final = []
    for _ in range(max_rounds):
        tasks = max(1, -(-left // per_task))
        bins = written(open_.repartition(tasks).mapInArrow(_pack(capacity), _BINS), "bins")
        final.append(bins.where(F.col("size") >= capacity - slack))
        open_, before = bins.where(F.col("size") < capacity - slack), left
        left = open_.count()
        if tasks == 1 or left > 0.95 * before:
            break
    sequences = open_
    for full in final:
        sequences = sequences.unionByName(full)
    return sequences.select(F.monotonically_increasing_id(), "items").mapInArrow(_placed, _PLACED)
