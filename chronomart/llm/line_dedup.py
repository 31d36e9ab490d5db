"""One line of every group of alike lines: MinHash bands, exact Jaccard, connected components.

With ``whole``, as the query and the pipeline ask for, a line's set holds all its character shingles, every ``SHINGLE``
characters in a row in lower case (a shorter line is one shingle), and every line with a character other than a space is
compared. Without it only the shingles from the start of each word on count, and lines of fewer than ``MIN_CHARS``
characters stay. A signature are the least shingle hashes under several orders, taken together as bands: of whole lines
``WHOLE_BANDS`` bands of ``WHOLE_ROWS``, else ``BANDS`` of two. Lines of similarity 0.8 share a band with a chance above 0.99.

Equal lines are one from the start. In each band the lines are held against the one that occurs most often, of which
the others are likely copies, and linked if their exact similarity reaches the threshold. Before that, a bitmap of
each line's shingles bounds the similarity from above: shingles that two lines do not share differ in at least as many bits. Where a band still
holds lines of several components, its lines are held against each other again in the same way, now under every
two neighbouring bands they share. Both steps only spare pairs: at last, in every band that still holds several components, the
lines outside its largest component are compared with all of other components, in tiles of bounded size.
Of every component the first line, by document and place, stays.

With ``whole``, shingles are hashed and compared in Arrow batches, for in DataFrame functions the signatures alone take
most of the time allowed; candidates, links, components and removal are DataFrame functions, and without ``whole``
everything is. No group is ever collected. Rows: a null text has no lines; blank lines stay, as do all lines of rows
without a key.
Rows with equal key and text count as one document; rows with the same key but other texts are documents of their own, in
the order of a hash of their texts. All columns of the documents are carried; names starting with an
underscore are reserved for steps in between, and ``n_lines`` and ``n_removed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from chronomart.llm.batches import mix, ranges, small_batches
from chronomart.llm.components import components
from chronomart.llm.ngram_jaccard import verify
from chronomart.llm.scratch import written

SHINGLE = 9
BANDS = 5
PERCENT = 80
MIN_CHARS = 24
GRAMS = r"(?s)(?=\S)(?=(.{1,%d}))\S+" % SHINGLE
ALL_GRAMS = "(?s)(?=(.{%d}))." % SHINGLE
#: Bands of a whole line, and orders in each.
WHOLE_BANDS, WHOLE_ROWS = 8, 3
#: Lines on a tile's side, and of a largest component on the other.
TILE, LARGE_TILE = 500, 4000
#: Words of 64 bits in a line's bitmap.
WORDS = 8
_BITS = [f"_b{w}" for w in range(WORDS)]


def _order(i: int) -> Column:
    """The constant of order ``i``: its first bits differ from those of all others, so that the orders rank
    different hashes first."""
    spread = (i * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64
    return F.lit(spread - 2**64 if spread >= 2**63 else spread).cast("long")


def grams(line: Column, whole: bool = False) -> Column:
    low = F.lower(line)
    found = F.regexp_extract_all(low, F.lit(ALL_GRAMS if whole else GRAMS), F.lit(1))
    if whole:
        found = F.when(F.length(low) < SHINGLE, F.array(low)).otherwise(found)
    return F.array_distinct(F.transform(found, lambda g: F.xxhash64(g)))


def bitmap(grams_: Column) -> list[Column]:
    """The bits of the shingles' hashes."""

    def word(w: int) -> Column:
        mine = F.filter(grams_, lambda h: F.pmod(F.shiftright(h, 6), F.lit(WORDS)) == w)
        one = F.lit(1).cast("long")
        return F.aggregate(
            mine, F.lit(0).cast("long"), lambda bits, h: bits.bitwiseOR(F.call_function("shiftleft", one, F.pmod(h, F.lit(64)).cast("int")))
        )

    return [word(w).alias(_BITS[w]) for w in range(WORDS)]


def _possible(a: str, b: str) -> Column:
    """Whether lines whose columns end in ``a`` and ``b`` can be alike, by their numbers of shingles and their bitmaps."""
    na, nb = F.col(f"_n{a}"), F.col(f"_n{b}")
    apart = reduce(add, [F.bit_count(F.col(f"{c}{a}").bitwiseXOR(F.col(f"{c}{b}"))) for c in _BITS])
    return (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)) & ((100 + PERCENT) * apart <= (100 - PERCENT) * (na + nb))


def _document(key: str, text: str) -> Column:
    return F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), F.col(text)).alias("h2"))


def lines_of(docs: DataFrame, key: str, text: str, whole: bool = False) -> DataFrame:
    """``(_doc, _at, _line)`` of the lines that are compared."""
    return (
        docs.where(F.col(key).isNotNull())
        .select(_document(key, text).alias("_doc"), F.posexplode(F.split(text, "\n")).alias("_at", "_line"))
        .where(F.col("_line").rlike(r"\S") & (F.lit(whole) | (F.length("_line") >= MIN_CHARS)))
    )


def _identity() -> list[Column]:
    return [F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(7), "_line").alias("_h2")]


class WholeLines:
    """Similarity of lines by all their character shingles."""

    def shingles(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The different shingles of each line as sorted 64-bit numbers, one line after the other, and how many it has."""
        low = "\n".join(lines.to_pylist()).lower() + "\n"
        points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.flatnonzero(points == 10)
        begins = np.concatenate([[0], ends[:-1] + 1])
        full = np.maximum(ends - begins - SHINGLE + 1, 1)
        after = np.cumsum(full)
        at = np.arange(after[-1]) + np.repeat(begins - (after - full), full)
        hashes = ranges(mix(points.astype(np.uint64)), at, np.minimum(at + SHINGLE, np.repeat(ends, full)), 1)
        new = np.ones(len(hashes), bool)
        for begin, end in zip(after - full, after):
            hashes[begin:end].sort()
        new[1:] = hashes[1:] != hashes[:-1]
        new[after - full] = True
        return hashes[new], np.add.reduceat(new, after - full, dtype=np.int64)

    def sets(self, lines: pa.Array) -> list[np.ndarray]:
        hashes, sizes = self.shingles(lines)
        return np.split(hashes, np.cumsum(sizes)[:-1])

    def alike(self, common, a, b):
        return (100 + PERCENT) * common >= PERCENT * (a + b)


def _whole_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is the line: in its place the number of shingles, the band keys and the bitmap."""
    orders = np.random.default_rng(7).integers(0, 2**31, WHOLE_BANDS * WHOLE_ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
    width = 64 * WORDS
    for batch in small_batches(batches, 1_000_000):
        hashes, sizes = WholeLines().shingles(batch.column(batch.num_columns - 1))
        starts = np.cumsum(sizes) - sizes
        low = hashes.astype(np.uint32)
        keys = np.zeros((len(sizes), WHOLE_BANDS), np.uint64)
        for i, order in enumerate(orders):
            band = i // WHOLE_ROWS
            keys[:, band] = mix(keys[:, band] + np.minimum.reduceat(low * order, starts) + np.uint64(band))
        spots = np.repeat(np.arange(len(sizes)) * width, sizes) + (mix(hashes) % np.uint64(width)).astype(np.int64)
        odd = (np.bincount(spots, minlength=len(sizes) * width) & 1).astype(bool)
        bits = np.packbits(odd, bitorder="little").view(np.int64).reshape(len(sizes), WORDS)
        offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * WHOLE_BANDS)
        lists = pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64)))
        words = [pa.array(np.ascontiguousarray(bits[:, w])) for w in range(WORDS)]
        names = [*batch.schema.names[:-1], "_n", "_keys", *_BITS]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes), lists, *words], names)


def _signed(lines: DataFrame, whole: bool) -> DataFrame:
    """Lines with their number of shingles, band keys and bitmap."""
    if whole:
        rows = lines.select("_doc", "_at", *_identity(), "_line")
        long = LongType()
        fields = [("_n", long), ("_keys", ArrayType(long)), *[(c, long) for c in _BITS]]
        schema = StructType([*rows.schema.fields[:-1], *[StructField(c, t) for c, t in fields]])
        return rows.mapInArrow(_whole_signatures, schema)
    hashed = lines.select("_doc", "_at", *_identity(), grams(F.col("_line")).alias("_grams"))

    def least_under(order: Column) -> Column:
        return F.array_min(F.transform("_grams", lambda h: h.bitwiseXOR(order)))

    least = [least_under(_order(i)) for i in range(2 * BANDS)]
    keys = F.array(*[F.xxhash64(F.lit(i), least[2 * i], least[2 * i + 1]) for i in range(BANDS)])
    counted = F.size("_grams").cast("long").alias("_n")
    return hashed.select("_doc", "_at", "_h1", "_h2", counted, keys.alias("_keys"), *bitmap(F.col("_grams")))


def signatures(lines: DataFrame, whole: bool = False) -> DataFrame:
    """One row per different line: its first place, how often it occurs, its band keys and bitmap."""
    return _signed(lines, whole).groupBy("_h1", "_h2").agg(
        F.min(F.struct("_doc", "_at")).alias("_first"),
        F.count("*").alias("_times"),
        *[F.first(c).alias(c) for c in ("_n", "_keys", *_BITS)],
    )


def _texts(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """``(_id, _n, _line)`` of the lines at the places ``(_id, _n, _doc, _at)``."""
    per_doc = wanted.groupBy("_doc").agg(F.collect_list(F.struct("_id", "_n", "_at")).alias("_wanted"))
    lines = docs.where(F.col(key).isNotNull()).select(_document(key, text).alias("_doc"), F.split(text, "\n").alias("_lines"))
    found = (
        lines.join(per_doc, "_doc")
        .select("_lines", F.explode("_wanted").alias("_w"))
        .select("_w.*", F.get("_lines", F.col("_w._at")).alias("_line"))
    )
    return found.select("_id", "_n", "_line").dropDuplicates(["_id"])  # a document may be given more than once


def _alike(pairs: DataFrame, texts: DataFrame, whole: bool) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the threshold."""
    if whole:
        return verify(pairs, texts.select(F.col("_id").alias("doc"), F.col("_line").alias("text")), WholeLines())
    common = F.size(F.array_intersect(grams(F.col("_x")), grams(F.col("_y"))))
    return (
        pairs.join(texts.toDF("a", "_nx", "_x"), "a")
        .join(texts.toDF("b", "_ny", "_y"), "b")
        .where((100 + PERCENT) * common >= PERCENT * (F.col("_nx") + F.col("_ny")))
        .select("a", "b")
    )


def _number() -> Column:
    """A number for each line; the least in a group is one of those that occur most often. Six bits of the
    logarithm of ``_times``, then a number of its own (for fewer than 2 ** 24 partitions)."""
    often = F.lit(63) - F.floor(F.log2(F.col("_times").cast("double"))).cast("int")
    return F.shiftleft(often.cast("long"), 57).bitwiseOR(F.monotonically_increasing_id())


def _stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of the least line under each key with the others that may be alike, ``(_key, _id, _n, _least)`` and the
    bitmap given."""
    leasts = members.where("_id = _least").select(
        "_least", F.col("_n").alias("_n_least"), *[F.col(c).alias(f"{c}_least") for c in _BITS]
    )
    return (
        members.where("_id <> _least")
        .select("_least", "_id", "_n", *_BITS)
        .distinct()
        .join(leasts.distinct(), "_least")
        .where(_possible("", "_least"))
        .select(F.col("_least").alias("a"), F.col("_id").alias("b"))
    )


def _tiles(members: DataFrame) -> DataFrame:
    """All pairs (a, b) of different components under one key, ``(_key, _id, _n, _part)`` and the bitmap given, but those
    that cannot be alike. Lines of a key's largest component meet the other lines only. Both are dealt to blocks by
    hash, and a block of others with a block of either is a tile."""
    parts = members.groupBy("_key", "_part").agg(F.count("*").alias("_rows"))
    largest = F.max(F.struct("_rows", F.col("_part").alias("lead")))
    sizes = parts.groupBy("_key").agg(largest.alias("_largest"), F.sum("_rows").alias("_all"))
    sizes = sizes.select(
        "_key",
        F.col("_largest.lead").alias("_lead"),
        F.ceil((F.col("_all") - F.col("_largest._rows")) / TILE).cast("int").alias("_blocks"),
        F.ceil(F.col("_largest._rows") / LARGE_TILE).cast("int").alias("_large"),
    )
    dealt = written(
        members.join(written(sizes, "sizes"), "_key")
        .withColumn("_leads", F.col("_part") == F.col("_lead"))
        .withColumn("_block", F.pmod(F.xxhash64("_id"), F.when(F.col("_leads"), F.col("_large")).otherwise(F.col("_blocks"))).cast("int"))
        .select("_key", "_id", "_n", *_BITS, "_part", "_leads", "_block", "_blocks", "_large"),
        "dealt",
    )

    def side(rows: DataFrame, i: Column, j: Column, end: str) -> DataFrame:
        values = [F.col(c).alias(f"{c}_{end}") for c in ("_n", *_BITS)]
        return rows.select("*", i.alias("_i")).select("*", j.alias("_j")).select(
            "_key", "_i", "_j", F.col("_id").alias(end), F.col("_part").alias(f"_p{end}"), *values
        )

    others, lead = dealt.where("not _leads"), dealt.where("_leads")
    block, blocks = F.col("_block"), F.col("_blocks")
    left = side(others, block, F.explode(F.sequence(block, blocks + F.col("_large") - 1)), "a")
    right = side(others, F.explode(F.sequence(F.lit(0), block)), block, "b").unionByName(
        side(lead, F.explode(F.sequence(F.lit(0), blocks - 1)), blocks + block, "b")
    )
    apart = F.col("_pa") != F.col("_pb")
    once = (F.col("_i") < F.col("_j")) | (F.col("a") < F.col("b"))
    met = left.join(right, ["_key", "_i", "_j"]).where(apart & once & _possible("_a", "_b"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """``(_doc, _at)`` of the lines that go. Runs jobs and writes to the shared folder."""
    all_lines = lines_of(docs, key, text, whole)
    lines = written(signatures(all_lines, whole).withColumn("_id", _number()), "lines")
    keyed = lines.select("_id", F.explode("_keys").alias("_key"))
    shared = written(
        keyed.groupBy("_key").agg(F.min("_id").alias("_least"), F.count("*").alias("_rows")).where("_rows > 1"),
        "bands",
    )
    met = written(keyed.join(shared, "_key").select("_key", "_id", "_least"), "members")
    members = written(met.join(lines.select("_id", "_n", *_BITS), "_id"), "members")
    places = lines.select("_id", "_n", "_first._doc", "_first._at").join(met.select("_id").distinct(), "_id", "left_semi")
    texts = written(_texts(docs, key, text, places), "line-texts")

    stars = written(_stars(members), "pairs")
    links = written(_alike(stars, texts, whole), "links")
    parts = components(links)

    def with_parts(rows: DataFrame) -> DataFrame:
        named = rows.join(parts.withColumnRenamed("node", "_id"), "_id", "left")
        return named.withColumn("_part", F.coalesce("component", "_id")).drop("component")

    def mixed(rows: DataFrame) -> DataFrame:
        """The keys under which several components meet, with their least line."""
        found = rows.groupBy("_key").agg(
            F.min("_part").alias("_low"),
            F.max("_part").alias("_high"),
            F.min("_id").alias("_least"),
            F.min_by("_part", "_id").alias("_least_part"),
        )
        return written(found.where("_low <> _high").select("_key", "_least", "_least_part"), "mixed")

    named = with_parts(members)
    left = named.join(mixed(named).select("_key"), "_key", "left_semi").select("_id", "_part").distinct()
    bands = WHOLE_BANDS if whole else BANDS
    two = F.array(*[F.xxhash64(F.get("_keys", F.lit(i)), F.get("_keys", F.lit((i + 1) % bands))) for i in range(bands)])
    finer = lines.join(written(left, "left"), "_id")
    finer = written(finer.select("_id", "_n", *_BITS, "_part", F.explode(two).alias("_key")), "finer")
    apart = finer.join(mixed(finer), "_key").where("_id = _least or _part <> _least_part")
    more = _stars(apart)
    more = written(more.join(stars, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(written(_alike(more, texts, whole), "links"))
    parts = components(links)

    named = with_parts(members)
    rest = _tiles(named.join(mixed(named).select("_key"), "_key", "left_semi").select("_key", "_id", "_n", *_BITS, "_part"))
    rest = written(rest.join(stars.unionByName(more), ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(written(_alike(rest, texts, whole), "links"))
    parts = components(links)

    grouped = lines.drop("_keys").join(parts.withColumnRenamed("node", "_id"), "_id", "left")
    first = written(
        grouped.where("component is not null").groupBy("component").agg(F.min("_first").alias("_keep")),
        "kept-lines",
    )
    repeated = written(
        grouped.join(first, "component", "left")
        .where("_times > 1 or component is not null")
        .select("_h1", "_h2", F.coalesce("_keep", "_first").alias("_keep")),
        "repeated",
    )
    return (
        all_lines.select("_doc", "_at", *_identity())
        .join(repeated, ["_h1", "_h2"])
        .where((F.col("_doc") != F.col("_keep._doc")) | (F.col("_at") != F.col("_keep._at")))
        .select("_doc", "_at")
    )


def keep_one_of_alike(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """``docs`` without the lines that repeat others, with ``n_lines`` and ``n_removed``."""
    gone = removed_lines(docs, key, text, whole).groupBy("_doc").agg(F.collect_set("_at").alias("_gone"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # The lines alone go through the join; joined again they are the text.
    split = docs.select(
        F.when(F.col(key).isNotNull(), _document(key, text)).alias("_doc"),
        F.split(text, "\n").alias("_lines"),
        F.struct(*[F.col(f"`{c}`") for c in kept if c != text]).alias("_row"),
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    rest = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(
        F.transform(places, lambda i: F.get("_lines", i))
    )

    def count(values: str) -> Column:
        return F.when(F.col(values).isNotNull(), F.size(values)).otherwise(0).cast("long")

    columns = [F.array_join(rest, "\n").alias(c) if c == text else F.col(f"_row.`{c}`") for c in kept]
    return split.join(gone, "_doc", "left").select(*columns, count("_lines").alias("n_lines"), count("_gone").alias("n_removed"))
