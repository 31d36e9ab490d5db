"""Exact top-k inner products by a uniform threshold, in three phases.

Every vector is cut into ``slices`` runs of components, and each slice ranks the candidates by its own
partial score. (1) Each task gathers, slice by slice, the entries of largest partial score and sums them
up; the k-th best sum over all tasks is a safe cutoff, since k entries reach it. (2) With the cutoff
broadcast, each task collects the entries that reach ``cutoff / slices`` in some slice: what stays below in
every slice sums to less than the cutoff. (3) Their scores are resolved over all slices, and the k best stay.

Queries go out in batches of at most about ``batch_values`` components, one pass over the candidates each, so what
the driver and a broadcast hold is bounded whatever the number of queries.

Rows: vectors that are null, or hold null or non-finite components, and rows without an id take no part;
shorter vectors count as filled up with zeros. Every other row is a candidate of its own, also when
repeated; an id asked for by equal rows is asked once. Equal scores go to the smaller id. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronomart.llm.scratch import written

SCALE = 1024
BLOCK = 4096
#: Sums of products below this are whole numbers that a double holds.
EXACT = 2.0**53


def whole_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v array<double>)`` of usable rows, each component floor(1024 * x)."""
    parts = F.col(vector).cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"),
        F.transform(parts, lambda x: F.floor(x * SCALE).cast("double")).alias("v"),
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    rows = np.repeat(np.arange(len(lists)), sizes)
    columns = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fits = columns < width  # beyond the queries' width products are zero
    out[rows[fits], columns[fits]] = flat[fits]
    return out


def _partials(queries: np.ndarray, block: np.ndarray, slices: int) -> np.ndarray:
    """Whole-number partial scores, (slice, query, candidate)."""
    cuts = np.linspace(0, queries.shape[1], slices + 1).astype(int)
    exact = queries.shape[1] * np.abs(queries).max(initial=0) * np.abs(block).max(initial=0) < EXACT
    if not exact:
        queries, block = queries.astype(np.int64), block.astype(np.int64)
    return np.stack(
        [(queries[:, a:b] @ block[:, a:b].T).astype(np.int64) for a, b in zip(cuts, cuts[1:])]
    )


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    """Which entries of each row are among its k largest, equal ones included."""
    n = values.shape[-1]
    if n <= k:
        return np.ones(values.shape, bool)
    return values >= np.partition(values, n - k, axis=-1)[..., n - k, None]


def _best(scores: np.ndarray, among: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best entries of each query: (query, id, score)."""
    floor = np.iinfo(np.int64).min
    among = among & _largest(np.where(among, scores, floor), k)
    q, c = np.nonzero(among)
    return _first(q, ids[c], scores[q, c], k)


def _first(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], ids[keep], scores[keep]


def _lists(shared, k: int, slices: int, cutoffs=None):
    """Each task's k best entries of each query: of its local lists, or of all that the cutoff admits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        safe = None if cutoffs is None else cutoffs.value
        best = tuple(np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids, block = part.column(0).to_numpy(), _matrix(part.column(1), queries.shape[1])
                for begin in range(0, len(queries), 256):
                    some = slice(begin, begin + 256)
                    partial = _partials(queries[some], block, slices)
                    among = (
                        _largest(partial, k)
                        if safe is None
                        else partial * slices >= safe[some][None, :, None]
                    ).any(axis=0)
                    scores = partial.sum(axis=0)
                    among &= query_ids[some, None] != ids[None, :]
                    if safe is not None:
                        among &= scores >= safe[some][:, None]
                    q, found, score = _best(scores, among, ids, k)
                    best = tuple(map(np.concatenate, zip(best, (q + begin, found, score))))
                best = _first(*best, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[best[0]]), pa.array(best[1]), pa.array(best[2])], ["query_id", "vec_id", "score"]
        )

    return run


_ENTRIES = "query_id long, vec_id long, score long"


def _ranked(entries: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    asked: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    slices: int = 4,
    batch_values: int = 4_000_000,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the rows for which ``asked`` holds, against all other ids.

    Runs a job for each phase and batch of queries.
    """
    spark = vectors.sparkSession.sparkContext
    rows = whole_vectors(vectors, key, vector)
    queries = written(whole_vectors(vectors.where(asked), key, vector).distinct(), "queries")
    n, width = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    batches = max(1, -(-n * max(width or 1, 1) // batch_values))
    found = []
    for i in range(batches):
        mine = queries.where(F.pmod(F.xxhash64("id", "v"), F.lit(batches)) == i).orderBy("id", "v").collect()
        if not mine:
            continue
        ids = np.array([r.id for r in mine])
        matrix = np.zeros((len(mine), max(width, 1)))
        for row, r in zip(matrix, mine):
            row[: len(r.v)] = r.v
        shared = spark.broadcast((ids, matrix))
        gathered = _ranked(rows.mapInArrow(_lists(shared, k, slices), _ENTRIES), k)
        kth = {r.query_id: r.score for r in gathered.where(F.col("rank") == k).select("query_id", "score").collect()}
        floor = np.iinfo(np.int64).min // (2 * slices)
        cutoffs = spark.broadcast(np.array([kth.get(q, floor) for q in ids.tolist()]))
        sufficient = rows.mapInArrow(_lists(shared, k, slices, cutoffs), _ENTRIES)
        found.append(written(_ranked(sufficient, k), "nearest"))
    if not found:
        found = [rows.select(*(F.col("id").alias(c) for c in ("query_id", "vec_id", "score", "rank"))).limit(0)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
