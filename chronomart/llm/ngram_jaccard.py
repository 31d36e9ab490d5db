"""Documents whose sets of word n-grams are alike: exact Jaccard join to connected components.

Equal sets are one class, joined by hash before anything else. Of other sets that reach the threshold any two
share an n-gram among the first ``size - ceil(t * size) + 1`` of each in a common order. That order puts n-grams
that many documents share last, the rarer of them first, so shared passages and frequent words bring few documents
together; any order gives all links.

Candidates are found in two steps. First each document is held against the least document and the one before it
under each of its leading n-grams; the links found make most components. Then documents of different components that meet under an
n-gram are compared: where few meet by a join, where many do in tiles by size band and hash, those outside the
n-gram's largest component against all. Both steps drop
pairs by size and by a bitmap of hashed n-grams: sets differ in at least as many n-grams as their bitmaps
differ in bits. Of the tiles in which two documents meet, that of the least n-gram they share gives the pair.
What remains is settled by intersecting the sorted sets.

Rows: a null or empty text, or one without words, has no n-gram and is linked with nothing; a text of fewer words
than ``n`` is one n-gram as a whole. A row without ``key`` is linked with nothing and has no component. Repeated
rows are linked as copies are; the texts of rows that share a key are versions of it, and a link of one is a
link of the key. Other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.llm.batches import Words, mix, ranges, small_batches
from chronomart.llm.components import components
from chronomart.llm.scratch import written

#: An n-gram in more than this share of a task's recent documents is sent as common. Of the n-grams found,
#: those in this share of all documents come last in the order: at most (mean set size / share) of them.
COMMON = 0.002
#: ... but in more than this many of them: with more, short tasks would not see what is common in all.
OFTEN = 2
#: Bits for each size band: 64 words at most, about one bit or more for each n-gram of smaller sets.
BIT_WORDS = 64
#: Rows of a tile's side, and pairs held against one text.
TILE = 2048
PER_TASK = 64
#: Up to so many documents under an n-gram are paired by a join, more in tiles.
FEW = 48
#: N-grams whose holders are marked at a time in a tile.
MARKED = 4096


class Likeness:
    """Jaccard similarity of at least ``percent`` / 100, on word ``n``-grams."""

    def __init__(self, n: int, percent: int):
        self.n, self.percent = n, percent

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        """The sorted set of each text as 64-bit numbers."""
        words = Words(texts, lower=True)
        count = words.end - words.begin
        full = np.maximum(count - self.n + 1, (count > 0).astype(np.int64))
        doc = np.repeat(np.arange(len(count)), full)
        begins = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full) + words.begin[doc]
        hashes = ranges(words.hashes, begins, np.minimum(begins + self.n, words.end[doc]), 1)
        cuts = np.cumsum(full)[:-1]
        return [np.unique(part) for part in np.split(hashes, cuts)]

    def lead(self, size: int) -> int:
        return size - -(-self.percent * size // 100) + 1

    def alike(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)

    def may(self, a, b, differ):
        """Whether sets of these sizes, differing in so many n-grams at least, can reach the threshold."""
        sizes = 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)
        return sizes & self.alike((a + b - differ) // 2, a, b)


def _bitmap(grams: np.ndarray) -> bytes:
    """64 to 4096 bits, flipped by each n-gram; sets of one size band have equal lengths."""
    width = bit_words(len(grams)) * 64
    spots = (mix(grams) % np.uint64(width)).astype(np.int64)
    return np.packbits(np.bincount(spots, minlength=width) % 2 == 1).tobytes()


def bit_words(size: int) -> int:
    return min(BIT_WORDS, 1 << max(0, (max(size, 1) * 2 - 1).bit_length() - 6))


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """A wider bitmap as one of ``words``: a spot modulo a smaller power of two."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _words_of(bitmaps: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in bitmaps]


def _common(like: Likeness):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, total = [], 0, 0

        def counts() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            often = n > max(OFTEN, COMMON * docs)
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[often].view(np.int64)), pa.array(n[often])], ["gram", "n"]
            )

        for batch in small_batches(batches):
            for grams in like.sets(batch.column(0)):
                held.append(grams)
                docs, total = docs + 1, total + len(grams)
            if total > 4_000_000:
                yield counts()
                held, docs, total = [], 0, 0
        if held:
            yield counts()

    return run


def common_order(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The common n-grams, sorted, and the place of each from 1 on: by the documents that have it, fewest first."""
    place = np.empty(len(grams), np.int64)
    place[np.lexsort((grams, n))] = np.arange(1, len(grams) + 1)
    grams = grams.view(np.uint64)
    order = np.argsort(grams)
    return grams[order], place[order]


_FEATURES = "doc long, n long, h1 long, h2 long, bits binary, lead array<long>"


def _features(like: Likeness, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rank = common.value
        for batch in small_batches(batches):
            sets = like.sets(batch.column(1))
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
            ends = np.cumsum([len(s) for s in sets])
            begins = ends - [len(s) for s in sets]
            place = np.zeros(len(flat), np.int64)
            if len(last):
                at = np.minimum(np.searchsorted(last, flat), len(last) - 1)
                place = np.where(last[at] == flat, rank[at], 0)
            leads = []
            for begin, end in zip(begins, ends):
                grams = flat[begin:end]
                order = grams[np.argsort(place[begin:end], kind="stable")]
                leads.append(order[: like.lead(len(grams)) if len(grams) else 0].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in leads])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array((ends - begins).astype(np.int64)),
                    pa.array(ranges(flat, begins, ends, 1).view(np.int64)),
                    pa.array(ranges(flat, begins, ends, 2).view(np.int64)),
                    pa.array([_bitmap(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(np.concatenate([*leads, np.zeros(0, np.int64)]))
                    ),
                ],
                ["doc", "n", "h1", "h2", "bits", "lead"],
            )

    return run


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of different ends, each once."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    new &= a != b
    return a[new], b[new]


def _dealt_leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the documents of a batch under one n-gram only the least is dealt by it; the others know their pairs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(1)
        doc = np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())
        gram = lists.flatten().to_numpy()
        order = np.lexsort((doc, gram))
        doc, gram = doc[order], gram[order]
        new = np.ones(len(gram), bool)
        new[1:] = gram[1:] != gram[:-1]
        least = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
        before = np.concatenate([doc[:1], doc[:-1]])
        a, b = _distinct(np.concatenate([least[~new], before[~new]]), np.concatenate([doc[~new], doc[~new]]))
        first = doc[new]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([gram[new], mix(b.view(np.uint64)).view(np.int64)])),
                pa.array(np.concatenate([first, a])),
                pa.array(
                    np.concatenate([first, b]), mask=np.arange(len(first) + len(b)) < len(first)
                ),
            ],
            ["gram", "doc", "with"],
        )


def _star_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (gram, doc): each document with the least under its n-gram and with the one before it."""
    gram_before = least_before = doc_before = None
    for batch in batches:
        paired = batch.filter(batch.column(2).is_valid())
        batch = batch.filter(batch.column(2).is_null())
        a, b = [paired.column(1).to_numpy()], [paired.column(2).to_numpy()]
        if batch.num_rows:
            gram, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.ones(len(gram), bool)
            new[1:] = gram[1:] != gram[:-1]
            base = doc
            before = np.concatenate([doc[:1], doc[:-1]])
            if gram_before is not None and gram[0] == gram_before:
                new[0] = False
                base = doc.copy()
                base[0], before[0] = least_before, doc_before
            least = base[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
            gram_before, least_before, doc_before = gram[-1], least[-1], doc[-1]
            a += [least[~new], before[~new]]
            b += [doc[~new], doc[~new]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in _distinct(np.concatenate(a), np.concatenate(b))], ["a", "b"]
        )


def _passing(like: Likeness):
    """Pairs with sizes and bitmaps of both, without those that cannot reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n = [batch.column(i).to_numpy() for i in (2, 3)]
            bits = [_words_of(batch.column(i).to_pylist()) for i in (4, 5)]
            differ = np.array(
                [
                    int(np.bitwise_count(_fold(x, w := min(len(x), len(y))) ^ _fold(y, w)).sum())
                    for x, y in zip(*bits)
                ],
                np.int64,
            )
            yield batch.select([0, 1]).filter(pa.array(like.may(*n, differ)))

    return run


def _met_before(gram: int, grams: pa.Array, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows ``a[k]`` and ``b[k]`` of a tile share an n-gram less than its own; ``grams`` lists those of each row."""
    rows = np.repeat(np.arange(len(grams)), grams.value_lengths().to_numpy())
    flat = grams.flatten().to_numpy()
    rows, flat = rows[flat < gram], flat[flat < gram]
    _, name, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[name] > 1
    rows, name = rows[shared], np.unique(name[shared], return_inverse=True)[1]
    found = np.zeros(len(a), bool)
    for at in range(0, name.max(initial=-1) + 1, MARKED):
        now = (name >= at) & (name < at + MARKED)
        holds = np.zeros((len(grams), MARKED), bool)
        holds[rows[now], name[now] - at] = True
        marks = np.packbits(holds, axis=1).view(np.uint64)
        for some in range(0, len(a), 20_000):
            k = slice(some, some + 20_000)
            found[k] |= (marks[a[k]] & marks[b[k]]).any(1)
    return found


def _tiles(like: Likeness):
    """Pairs of different components in one tile. ``side``: 0 and 1 for its two blocks, 2 for rows of both;
    a guest belongs to the next size band and is compared with rows of this one only. Two documents meet under every n-gram
    they share; the tile of the least one gives the pair."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        gram, grams = key[0].as_py(), table.column("grams").combine_chunks()
        doc, part, n, side, guest = (
            table.column(c).to_numpy() for c in ("doc", "part", "n", "side", "guest")
        )
        bits = _words_of(table.column("bits").to_pylist())
        width = min(map(len, bits))
        bits = np.stack([_fold(x, width) for x in bits])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = max(1, 2_000_000 // (len(right) * width + 1))
        for at in range(0, len(left), step):
            i = left[at : at + step]
            differ = np.bitwise_count(bits[i][:, None, :] ^ bits[right][None, :, :]).sum(-1, dtype=np.int64)
            ok = like.may(n[i][:, None], n[right][None, :], differ)
            ok &= (part[i][:, None] != part[right][None, :]) & ~(guest[i][:, None] & guest[right][None, :])
            x, y = np.nonzero(ok)
            x, y = i[x], right[y]
            new = ~_met_before(gram, grams, x, y)
            a.append(doc[x[new]])
            b.append(doc[y[new]])
        a, b = np.concatenate(a), np.concatenate(b)
        a, b = _distinct(np.minimum(a, b), np.maximum(a, b))
        return pa.table({"a": a, "b": b})

    return run


def _verified(like: Likeness):
    """Texts sorted by (a, salt, whether it is a's): the pairs whose sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, grams = None, None
        for batch in small_batches(batches):
            a, b, out = batch.column(0).to_numpy(), batch.column(1).to_numpy(), []
            for i, own in enumerate(like.sets(batch.column(2))):
                if a[i] == b[i]:
                    of, grams = a[i], own
                elif of == a[i]:
                    common = len(np.intersect1d(grams, own, assume_unique=True))
                    out.append(bool(like.alike(common, len(grams), len(own))))
                    continue
                out.append(False)
            yield batch.select([0, 1]).filter(pa.array(out, pa.bool_()))

    return run


def verify(pairs: DataFrame, docs: DataFrame, like) -> DataFrame:
    """The pairs (a, b) that are links. Partners of one document go out in parts, each with its text."""
    sizes = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_TASK).alias("parts")), "parts")
    dealt = pairs.join(sizes, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")))
    needed = dealt.select("a", "salt", "b").unionByName(
        sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.col("a").alias("b"))
    )
    return (
        needed.join(docs.select(F.col("doc").alias("b"), "text"), "b")
        .repartition("a", "salt")
        .sortWithinPartitions("a", "salt", F.col("a") != F.col("b"))
        .select("a", "b", "text")
        .mapInArrow(_verified(like), "a long, b long")
    )


def _with_features(pairs: DataFrame, features: DataFrame, like: Likeness) -> DataFrame:
    def side(name: str) -> DataFrame:
        return features.select(F.col("doc").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))

    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        .mapInArrow(_passing(like), "a long, b long")
    )


def _dealt_to_tiles(many: DataFrame) -> DataFrame:
    """``(gram, doc, part, n, i, j, side)``: tiles in which every two documents under an n-gram meet, once, but for those
    that are both of its largest component.

    The documents outside it are dealt to blocks, which meet one another and the blocks of the largest component, numbered
    after them. So a group of near copies that is one component by now is copied for each block of the few others only.
    Where there is one block of each, both are one tile, in which nothing is copied: the others (side 2) meet one
    another and the largest component (side 1).
    """
    largest = (
        many.groupBy("gram", "part")
        .agg(F.count("*").alias("size"))
        .groupBy("gram")
        .agg(F.max(F.struct("size", "part")).alias("top"), F.sum("size").alias("all"))
        .select(
            "gram",
            F.col("top.part").alias("main"),
            F.ceil((F.col("all") - F.col("top.size")) / TILE).cast("int").alias("others"),
            F.ceil(F.col("top.size") / TILE).cast("int").alias("mains"),
        )
    )
    rows = written(many.join(largest, "gram").select("gram", "doc", "part", "n", "main", "others", "mains"), "meeting")

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64("doc"), F.col(count)).cast("int")

    one = F.expr("others = 1 and mains = 1")
    alone = rows.where(one).select("*", F.lit(0).alias("i"), F.lit(0).alias("j"), F.when(F.col("part") == F.col("main"), 1).otherwise(2).alias("side"))
    rows = rows.where(~one)
    other = rows.where("part <> main").withColumn("own", block("others"))
    other = other.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("others") + F.col("mains") - 1)))
    own, to = F.col("own"), F.col("to")
    other = (
        other.withColumn("side", F.when(own < to, 0).when(own > to, 1).otherwise(2))
        .withColumn("i", F.least(own, to))
        .withColumn("j", F.greatest(own, to))
    )
    main = rows.where("part = main").withColumn("j", F.col("others") + block("mains")).withColumn("side", F.lit(1))
    once = main.where("others = 1").withColumn("i", F.lit(0))
    copied = main.where("others > 1").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    names = ["gram", "doc", "part", "n", "i", "j", "side"]
    return reduce(DataFrame.unionByName, [x.select(*names) for x in (alone, other, once, copied)])


def _meeting_pairs(features: DataFrame, parts: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of documents of different components that share a leading n-gram and pass the filters."""
    leads = (
        features.select("doc", "lead")
        .join(parts.withColumnRenamed("node", "doc"), "doc", "left")
        .select("doc", F.coalesce("component", "doc").alias("part"), F.explode("lead").alias("gram"))
    )
    mixed = written(
        leads.groupBy("gram")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("rows"))
        .where("low <> high")
        .select("gram", "rows"),
        "mixed",
    )
    met = written(
        leads.join(mixed, "gram").join(features.select("doc", "n"), "doc").select("gram", "doc", "part", "n", "rows"),
        "met",
    )
    few = met.where(F.col("rows") <= FEW)
    a, b = (few.select("gram", *[F.col(c).alias(f"{c}_{x}") for c in ("doc", "part", "n")]) for x in "ab")
    alike_sizes = 100 * F.least("n_a", "n_b") >= like.percent * F.greatest("n_a", "n_b")
    paired = (
        a.join(b, "gram")
        .where((F.col("doc_a") < F.col("doc_b")) & (F.col("part_a") != F.col("part_b")) & alike_sizes)
        .select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
        .distinct()
    )
    paired = _with_features(written(paired, "paired"), features, like)
    # Alike sizes differ by one band at most; a little wider, against rounding.
    band = F.floor(F.log(F.col("n")) / (math.log(100 / like.percent) * 1.0001)).cast("int")
    many = met.where(F.col("rows") > FEW)
    held = many.groupBy("doc").agg(F.collect_set("gram").alias("grams"))
    tiled = (
        _dealt_to_tiles(many)
        .join(features.select("doc", "bits").join(held, "doc"), "doc")
        .withColumn("band", band)
        .withColumn("guest", F.explode(F.array(F.lit(False), F.lit(True))))
        .withColumn("band", F.col("band") - F.col("guest").cast("int"))
        .select("gram", "band", "i", "j", "doc", "part", "n", "bits", "grams", "side", "guest")
        .groupBy("gram", "band", "i", "j")
        .applyInArrow(_tiles(like), "a long, b long")
    )
    return paired.unionByName(tiled).distinct()


def linked(docs: DataFrame, n: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id)`` of every row. Runs jobs and writes to the shared folder."""
    like, spark = Likeness(n, percent), docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    counted = written(docs.select("text").mapInArrow(_common(like), "gram long, n long"), "common")
    many = docs.count() * COMMON
    often = counted.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > many).collect()
    last = common_order(np.array([r.gram for r in often], np.int64), np.array([r.n for r in often], np.int64))
    rows = written(docs.mapInArrow(_features(like, spark.sparkContext.broadcast(last)), _FEATURES), "sets")

    some = rows.where("n > 0 and doc is not null")
    features = written(
        some.groupBy("n", "h1", "h2").agg(
            F.min("doc").alias("doc"), F.first("bits").alias("bits"), F.first("lead").alias("lead")
        ),
        "features",
    )
    texts = docs.where("doc is not null")

    stars = (
        features.select("doc", "lead")
        .mapInArrow(_dealt_leads, "gram long, doc long, with long")
        .repartition("gram")
        .sortWithinPartitions("gram", "doc")
        .mapInArrow(_star_pairs, "a long, b long")
        .distinct()
    )
    stars = written(_with_features(written(stars, "stars"), features, like), "candidates")
    links = written(verify(stars, texts, like), "links")
    parts = components(links)

    pairs = written(_meeting_pairs(features, parts, like), "pairs")
    pairs = written(pairs.join(stars, ["a", "b"], "left_anti"), "pairs")
    if pairs.count():
        more = written(verify(pairs, texts, like), "links")
        parts = components(links.unionByName(more))

    named = written(
        features.select("n", "h1", "h2", F.col("doc").alias("node"))
        .join(parts, "node", "left")
        .select("n", "h1", "h2", F.coalesce("component", "node").alias("component_id")),
        "named",
    )
    alone = rows.where("n = 0 or doc is null").select("doc", "n", F.col("doc").alias("component_id"))
    return (
        some.select("doc", "n", "h1", "h2")
        .join(named, ["n", "h1", "h2"])
        .select("doc", "n", "component_id")
        .unionByName(alone)
        .select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "component_id")
    )
