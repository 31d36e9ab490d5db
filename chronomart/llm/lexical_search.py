"""Ranked lexical search by dense blocks: item vocabularies times document impacts.

A document's score for an item is a sum, over the item's terms, of the term's weight times its impact in the
document, both whole numbers. Items are cut into tiles of a compact vocabulary (the terms of these items only), documents
into tiles of impacts over that vocabulary, and each pair of tiles is one matrix product in doubles. Columns are cut
so that no sum can reach 2**53: every product is exact, and products of column tiles are added as 64-bit
integers. Of each product a task keeps the entries that reach its k-th best score so far, equal ones
included, and then the k best by score and document; the best of all tasks are ranked last.

The items are the stated query set. They go out in blocks of at most about ``block_terms`` pairs of item and term, by
a hash of the item, with one pass over the documents each: what the driver holds and what is broadcast is
a block, whatever the number of items. Every row of the documents is read in each pass.

Rows: documents without an id and items without an id take no part, also in the corpus counts; every other row of the
documents is a document of its own, also when repeated. A null or empty text has no terms. Rows of the same item
are one item with the terms of all its texts. Equal scores go to the smaller id. Other columns are not carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronomart.llm.batches import small_batches
from chronomart.llm.scratch import written
from chronomart.session import scratch_path

#: Bytes other than ASCII letters and digits part terms; those of longer characters do not.
APART = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
#: Bytes of a text whose terms are held at once.
PIECE = 4_000_000
#: Sums of products below this are whole numbers that a double holds.
EXACT = 2.0**53
#: No impact reaches this: a term's frequency counts a thousandfold below the line, too.
IMPACTS = 1_000_000
#: Items and terms of an item tile, and values of a document tile.
TILE_ITEMS, TILE_TERMS, TILE_VALUES = 256, 4096, 4_000_000


def term_counts(text: str) -> Counter[bytes]:
    """How often each term occurs: runs of ASCII letters, digits and other characters from U+0080 on, A-Z lower-cased."""
    data = text.encode()
    if len(data) <= PIECE:
        return Counter(data.translate(APART).split())
    counts: Counter[bytes] = Counter()
    data = data.translate(APART)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + PIECE)
        end = len(data) if end < 0 else end
        counts.update(data[begin:end].split())
        begin = end
    return counts


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(item, term binary)``, each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            pairs = [
                (item, term)
                for item, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for term in term_counts(value or "")
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in pairs], pa.int64()), pa.array([t for _, t in pairs], pa.binary())], ["item", "term"]
            )

    rows = items.where(F.col(key).isNotNull()).select(F.col(key).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(run, "item long, term binary").distinct()


def document_terms(docs: DataFrame, vocabulary, key: str, text: str) -> DataFrame:
    """``(doc, n, terms, tfs)`` of documents with terms: their number, and places in the vocabulary of those that
    are in it. ``vocabulary`` is a broadcast dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = vocabulary.value
        for batch in small_batches(batches):
            docs, sizes, terms, tfs, ends = [], [], [], [], [0]
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = term_counts(value or "")
                if counts:
                    docs.append(doc)
                    sizes.append(counts.total())
                    for term in counts.keys() & places.keys():
                        terms.append(places[term])
                        tfs.append(counts[term])
                    ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
                ],
                ["doc", "n", "terms", "tfs"],
            )

    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<long>")


@dataclass
class ItemTile:
    """Some items: ``columns`` are their vocabulary's places, ``entries`` (row, column, weight) their weights, and ``cuts``
    the column tiles whose sums stay exact."""

    items: np.ndarray
    columns: np.ndarray
    entries: tuple[np.ndarray, np.ndarray, np.ndarray]
    cuts: list[int]

    def weights(self) -> np.ndarray:
        out = np.zeros((len(self.items), len(self.columns)))
        out[self.entries[0], self.entries[1]] = self.entries[2]
        return out


def item_tiles(items: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> list[ItemTile]:
    """Tiles of pairs of item and term sorted by item, each of a few items."""
    begins = np.flatnonzero(np.r_[True, items[1:] != items[:-1]]) if len(items) else np.zeros(0, int)
    ends = np.r_[begins[1:], len(items)]
    tiles, first = [], 0
    for i in range(len(begins)):
        full = i + 1 - first >= TILE_ITEMS or i + 1 == len(begins)
        if full or ends[i + 1] - begins[first] > TILE_TERMS:
            some = slice(begins[first], ends[i])
            columns, column = np.unique(terms[some], return_inverse=True)
            own, row = np.unique(items[some], return_inverse=True)
            tile = ItemTile(own, columns, (row, column, weights[some].astype(float)), [])
            tile.cuts = _exact_cuts(tile)
            tiles.append(tile)
            first = i + 1
    return tiles


def _exact_cuts(tile: ItemTile) -> list[int]:
    """Where to cut the columns so that no item's weights times the largest impact reach ``EXACT`` in a piece."""
    heaviest = np.zeros(len(tile.columns))
    np.maximum.at(heaviest, tile.entries[1], tile.entries[2])
    cuts, held = [0], 0.0
    for i, weight in enumerate((heaviest * IMPACTS).tolist()):
        if held + weight >= EXACT or i - cuts[-1] >= TILE_TERMS:
            cuts.append(i)
            held = 0.0
        held += weight
    return [*cuts, len(tile.columns)]


class Best:
    """The k best documents of each item of a tile so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)  # only scores above 0 count
        self.rows, self.docs, self.scores = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores`` of all items against some documents; equal scores at the edge stay until ids decide."""
        floor = self.floor
        if scores.shape[1] > self.k:
            n = scores.shape[1] - self.k
            floor = np.maximum(floor, np.partition(scores, n, axis=1)[:, n])
        row, column = np.nonzero(scores >= floor[:, None])
        rows = np.concatenate([self.rows, row])
        ids = np.concatenate([self.docs, docs[column]])
        values = np.concatenate([self.scores, scores[row, column]])
        order = np.lexsort((ids, -values, rows))
        rows, ids, values = rows[order], ids[order], values[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.k
        last = place == self.k - 1
        self.floor[rows[last]] = values[last]
        self.rows, self.docs, self.scores = rows[keep], ids[keep], values[keep]


def impacts(sizes: list[int], tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The impact of each term; the length's part in whole numbers of any size."""
    m = np.array([10 + (90 * n * n_docs) // n_terms for n in sizes], np.int64)
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, lengths))


def _best_of_task(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, n_vocabulary, n_docs, n_terms = shared.value
        weights = [tile.weights() for tile in tiles]
        best = [Best(len(tile.items), k) for tile in tiles]
        widest = max((b - a for t in tiles for a, b in zip(t.cuts, t.cuts[1:])), default=1)
        each = max(16, TILE_VALUES // max(widest, TILE_ITEMS))
        for batch in batches:
            for at in range(0, batch.num_rows, each):
                part = batch.slice(at, each)
                docs = part.column(0).to_numpy()
                lists = part.column(2)
                lengths = np.diff(lists.offsets.to_numpy())
                terms, tfs = lists.flatten().to_numpy(), part.column(3).flatten().to_numpy()
                values = impacts(part.column(1).to_pylist(), tfs, lengths, n_docs, n_terms).astype(float)
                place = np.repeat(np.arange(len(docs)), lengths)
                for tile, weight, top in zip(tiles, weights, best):
                    column_of = np.full(n_vocabulary, -1, np.int32)
                    column_of[tile.columns] = np.arange(len(tile.columns))
                    column = column_of[terms]
                    scores = np.zeros((len(tile.items), len(docs)), np.int64)
                    for a, b in zip(tile.cuts, tile.cuts[1:]):
                        inside = (column >= a) & (column < b)
                        tile_of_docs = np.zeros((b - a, len(docs)))
                        tile_of_docs[column[inside] - a, place[inside]] = values[inside]
                        scores += (weight[:, a:b] @ tile_of_docs).astype(np.int64)
                    top.add(scores, docs)
        for tile, top in zip(tiles, best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile.items[top.rows]), pa.array(top.docs), pa.array(top.scores)], ["item_id", "doc_id", "score"]
            )

    return run


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_terms: int = 200_000,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents with a score above 0.

    With N documents that have terms, L terms in all, n in a document, df documents with a term and tf of its
    occurrences in one: a term's weight is floor(1000 ln((2N + 2) / (2df + 1))), its impact 10**9 tf div
    (1000 tf + 8m), where m = 10 + 90nN div L. Runs its jobs at once, three for each block of items.
    """
    spark = docs.sparkSession
    wanted = written(item_terms(items, item_key, item_text), "item_terms")
    blocks = max(1, -(-wanted.count() // block_terms))
    out = scratch_path(spark, "ranked")
    for block in range(blocks):
        mine = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "term").toArrow()
        vocabulary = {term: i for i, term in enumerate(sorted(set(mine.column("term").to_pylist())))}
        places = spark.sparkContext.broadcast(vocabulary)
        found = written(document_terms(docs, places, key, text), "document_terms")
        n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(found.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow().to_pandas().values.tolist())
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))]
        terms = np.array([vocabulary[t] for t in mine.column("term").to_pylist()], np.int64)
        tiles = item_tiles(mine.column("item").to_numpy(), terms, np.array(weight, np.int64)[terms])
        shared = spark.sparkContext.broadcast((tiles, len(vocabulary), n_docs, n_terms))
        best = found.mapInArrow(_best_of_task(shared, k), "item_id long, doc_id long, score long")
        order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score").write.parquet(f"{out}/block={block}")
    return spark.read.schema("item_id long, rank int, doc_id long, score long").parquet(out).drop("block")
