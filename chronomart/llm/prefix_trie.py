"""The trie of conversation prefixes, as node tables under a minimal perfect hash.

A prefix's digest is a sum over its turns modulo a prime, in four lanes: each turn's hash times a power of the
lane's base at the turn's place. So digests need no walk along a conversation, and a very long one is cut into bands of
``per_band`` turns, each of which starts from the sums of the bands before. Conversations are dealt out to shards of
about ``per_shard`` turns. For each shard and band the distinct digests are enumerated and get the slots of a minimal
perfect hash; a lookup is checked against the digest in its slot, and all rows of a slot must agree on
their last turn and on their parent's slot, so two prefixes can never share a node unnoticed. Counts are scattered into flat
arrays by slot and added up over shards.

Sums over subtrees: every node's own value counts in one shard only, that of its smallest member, whose whole path lies
there. It is added to the parents through the array of parent slots, deepest nodes first, and the sums of all shards
add up to the subtree's. What a conversation owns in later bands enters at the node where it leaves a band.

Rows: turns without a conversation take no part; a null role or text is empty. Turns are equal by role and text
alone. A node that a third of all conversations pass sends one row per shard. The hash over a node's members is a
stream by nature: it is fed with long pieces of text, made in parallel in the order of ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronomart.llm.batches import mix
from chronomart.llm.scratch import written

PRIME = np.uint64(2**31 - 1)
LANES = 4
#: Powers of a base are looked up in two steps of so many places.
STEP = 1 << 16
#: Turns of a conversation that one band holds.
BAND = 1024
#: Ids in one piece of text to be hashed.
PIECE = 4096

_TURNS = "conv long, depth long, " + "".join(f"c{i} long, " for i in range(LANES)) + "check long, chars long"
_LANES = [f"c{i}" for i in range(LANES)]


def _powers(base: int, step: int, n: int) -> np.ndarray:
    """base ** 0, step, 2 step, ... modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, step * len(out), int(PRIME))) % PRIME])
    return out[:n]


class Powers:
    """Powers of the lanes' bases at any place."""

    def __init__(self, seed: int):
        self.bases = np.random.default_rng(seed).integers(2**20, int(PRIME) - 1, LANES).tolist()
        self.small = [_powers(b, 1, STEP) for b in self.bases]

    def at(self, lane: int, places: np.ndarray) -> np.ndarray:
        large = _powers(self.bases[lane], STEP, int(places.max(initial=0)) // STEP + 1)
        return self.small[lane][places % STEP] * large[places // STEP] % PRIME


def _summands(seed: int):
    """Each turn's part in the digests of the prefixes that hold it, and eight more bytes of its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(seed)
        for batch in batches:
            conv, depth, hashes, chars = batch.columns
            words = np.frombuffer(b"".join(hashes.to_pylist()), "<u4").reshape(-1, 8).astype(np.uint64)
            places = depth.to_numpy()
            lanes = [(words[:, i] % (PRIME - np.uint64(1)) + np.uint64(1)) * powers.at(i, places) % PRIME for i in range(LANES)]
            check = (words[:, 6] << np.uint64(32) | words[:, 7]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [conv, depth, *(pa.array(x.astype(np.int64)) for x in lanes), pa.array(check), chars],
                ["conv", "depth", *_LANES, "check", "chars"],
            )

    return run


class NodeTable:
    """A minimal perfect hash of distinct digests: ``n`` digests have the slots 0 .. n - 1.

    At each level the digests left fall on twice as many places; those alone on theirs get the next slots, in
    order of place, the others go on to the next level.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.ones(len(high), bool)
        first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        high, low = high[first], low[first]
        self.n = len(high)
        self.high, self.low = np.empty_like(high), np.empty_like(low)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        base = 0
        while len(high):
            places = self._place(high, low, len(self.levels), 2 * len(high))
            alone = np.bincount(places, minlength=2 * len(high)) == 1
            slots = base + np.cumsum(alone) - 1
            self.levels.append((alone, slots))
            placed = alone[places]
            self.high[slots[places[placed]]] = high[placed]
            self.low[slots[places[placed]]] = low[placed]
            base += int(placed.sum())
            high, low = high[~placed], low[~placed]

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = mix(high.view(np.uint64) + mix(low.view(np.uint64) + np.uint64(level)))
        return (mixed % np.uint64(size)).astype(np.int64)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for those that the table does not hold."""
        out = np.full(len(high), -1)
        left = np.arange(len(high))
        for level, (alone, slots) in enumerate(self.levels):
            places = self._place(high[left], low[left], level, len(alone))
            hit = alone[places]
            out[left[hit]] = slots[places[hit]]
            left = left[~hit]
        known = out >= 0
        known[known] = (self.high[out[known]] == high[known]) & (self.low[out[known]] == low[known])
        return np.where(known, out, -1)


_NODES = (
    "shard int, band long, slot int, parent int, high long, low long, parent_high long, parent_low long, depth long, "
    "n long, owner long, chars long, check long, own boolean, ends array<long>, through array<long>"
)


def _lists(slots: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """The values of each slot as a list."""
    order = np.argsort(slots, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(slots, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[order], pa.int64()))


def _agreed(slots: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The value that all rows of a slot share."""
    out = np.zeros(n, values.dtype)
    out[slots] = values
    if (out[slots] != values).any():
        raise ValueError("two prefixes have one digest; choose another seed")
    return out


def _shard_nodes(table: pa.Table, per_band: int) -> pa.Table:
    """The nodes of one shard and band. Each conversation's first row stands for the node it comes from (the
    root, or its last node in the band before) and knows the conversation's length."""
    columns = {name: table.column(name).to_numpy() for name in table.column_names}
    order = np.lexsort((columns["depth"], columns["conv"]))
    conv, depth, chars, check, length = (columns[c][order] for c in ("conv", "depth", "chars", "check", "length"))
    opens = np.ones(len(conv), bool)
    opens[1:] = conv[1:] != conv[:-1]
    begin = np.maximum.accumulate(np.where(opens, np.arange(len(conv)), 0))
    lanes = []
    for name in _LANES:
        sums = np.cumsum(columns[name][order])
        lanes.append((sums - (sums - columns[name][order])[begin]) % int(PRIME))
    high, low = lanes[0] << 31 | lanes[1], lanes[2] << 31 | lanes[3]

    nodes = NodeTable(high, low)
    slots, n = nodes.slots(high, low), nodes.n
    rows = np.arange(len(conv))
    band = int(columns["band"][0])
    own = (depth > band * per_band) | (depth == 0)  # the others are nodes of the band before
    # What a band starts from has its last turn and its parent there.
    parent = _agreed(slots, np.where(opens, -1, slots[rows - 1]), n)
    depths = _agreed(slots, depth, n)
    chars, check = (_agreed(slots, np.where(opens, 0, values), n) for values in (chars, check))
    owner = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(owner, slots, conv)
    length = length[begin]
    ended, leaves_band = own & (depth == length), own & (depth < length) & (depth == (band + 1) * per_band)
    above = np.maximum(parent, 0)
    none = parent < 0
    return pa.table(
        [
            pa.array(np.full(n, columns["shard"][0]), pa.int32()),
            pa.array(np.full(n, band), pa.int64()),
            pa.array(np.arange(n), pa.int32()),
            pa.array(parent, pa.int32()),
            pa.array(nodes.high),
            pa.array(nodes.low),
            pa.array(nodes.high[above], mask=none),
            pa.array(nodes.low[above], mask=none),
            pa.array(depths),
            pa.array(np.bincount(slots, minlength=n)),
            pa.array(owner),
            pa.array(chars),
            pa.array(check),
            pa.array(_agreed(slots, own, n)),
            _lists(slots[ended], conv[ended], n),
            _lists(slots[leaves_band], conv[leaves_band], n),
        ],
        [part.split()[0] for part in _NODES.split(", ")],
    )


_SUMS = "high long, low long, n_leaves long, saved_tokens long, parent_owner long"


def _accumulate(table: pa.Table) -> pa.Table:
    """The sums over the subtrees of one shard and band, through parent slots in order of depth."""
    columns = {name: table.column(name).to_numpy() for name in table.column_names}
    n = len(columns["slot"])
    flat = {name: np.empty(n, values.dtype) for name, values in columns.items()}
    for name, values in columns.items():
        flat[name][columns["slot"]] = values
    mine = flat["own"] & (flat["owner"] == flat["least"])
    saved = np.where(mine, (flat["members"] - 1) * flat["chars"], 0) + flat["later_saved"]
    leaves = np.where(mine & (flat["n_children"] == 0), 1, 0) + flat["later_leaves"]
    parent = flat["parent"]
    order = np.argsort(-flat["depth"], kind="stable")
    order = order[parent[order] >= 0]
    levels = np.flatnonzero(np.diff(flat["depth"][order])) + 1
    for level in np.split(order, levels):  # the deepest first
        np.add.at(saved, parent[level], saved[level])
        np.add.at(leaves, parent[level], leaves[level])
    own = flat["own"]
    above = pa.array(flat["least"][np.maximum(parent, 0)], mask=parent < 0)
    return pa.table(
        [pa.array(flat["high"]), pa.array(flat["low"]), pa.array(leaves), pa.array(saved), above],
        [part.split()[0] for part in _SUMS.split(", ")],
    ).filter(pa.array(own))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the ids of one node, sorted, as text."""
    for batch in batches:
        high, low, conv = (batch.column(i).to_numpy() for i in range(3))
        if not len(conv):
            continue
        opens = np.ones(len(conv), bool)
        opens[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        opens[::PIECE] = True
        begins = np.flatnonzero(opens)
        texts = [",".join(map(str, part.tolist())) for part in np.split(conv, begins[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(high[begins]), pa.array(low[begins]), pa.array(conv[begins]), pa.array(texts)],
            ["high", "low", "first", "ids"],
        )


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's pieces, which come in order."""
    key, state = None, hashlib.sha256()
    out: list[tuple[int, int, str]] = []
    for batch in batches:
        for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if node == key:
                state.update(b",")
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            state.update(ids.encode())
        yield _hash_batch(out)
        out = []
    if key:
        yield _hash_batch([(*key, state.hexdigest())])


def _hash_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
        ["high", "low", "ends_sha256"],
    )


def member_hashes(ends: DataFrame) -> DataFrame:
    """``(high, low, ends_sha256)`` of rows ``(high, low, conv)``: over the ids in numerical order, joined by commas."""
    spread = ends.repartitionByRange("high", "low", "conv").sortWithinPartitions("high", "low", "conv")
    pieces = spread.mapInArrow(_pieces, "high long, low long, first long, ids string")
    dealt = pieces.repartition("high", "low").sortWithinPartitions("high", "low", "first")
    return dealt.mapInArrow(_hashes, "high long, low long, ends_sha256 string")


def _same(column: str):
    """A group's one value; two values mean that two prefixes have one digest."""
    clash = F.raise_error(F.lit("two prefixes have one digest; choose another seed"))
    return F.when(F.min(column).eqNullSafe(F.max(column)), F.min(column)).otherwise(clash).alias(column)


def hashed_turns(rows: DataFrame, role: str = "role", text: str = "text") -> list:
    """What the trie needs of a turn, as columns: ``hash`` (of role and text, with null as empty) and ``chars`` of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return [F.unhex(F.sha2(told.cast("binary"), 256)).alias("hash"), F.length(text).cast("long").alias("chars")]


def prefix_trie(
    turns: DataFrame, conversations: DataFrame | None = None, seed: int = 12, per_shard: int = 200_000, per_band: int = BAND
) -> DataFrame:
    """One row per node of the trie of ``turns(conv, depth, role, text)``, or ``(conv, depth, hash, chars)`` with the columns
    of :func:`hashed_turns`; ``depth`` counts from 1 without gaps.

    ``conversations(conv)`` may name ids without turns. Columns: ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Runs jobs at once; without
    any conversation there is no node.
    """
    told = ["hash", "chars"] if "hash" in turns.columns else hashed_turns(turns)
    hashed = turns.where("conv is not null").select(F.col("conv").cast("long"), F.col("depth").cast("long"), *told)
    rows = written(hashed.mapInArrow(_summands(seed), _TURNS), "turns")
    ids = rows.select("conv", "depth")
    if conversations is not None:
        ids = ids.union(conversations.where("conv is not null").select(F.col("conv").cast("long"), F.lit(0).cast("long")))
    lengths = written(ids.groupBy("conv").agg(F.max("depth").alias("length")), "lengths")
    total = lengths.agg(F.sum(F.col("length") + 1)).first()[0] or 0
    shards = max(1, -(-total // per_shard))
    shard = F.pmod(F.xxhash64("conv"), F.lit(shards)).cast("int").alias("shard")
    band = F.floor((F.col("depth") - 1) / per_band).alias("band")

    zeros = [F.lit(0).cast("long").alias(c) for c in (*_LANES, "check", "chars")]
    roots = lengths.select("conv", F.lit(0).cast("long").alias("depth"), *zeros, F.lit(0).cast("long").alias("band"), "length")
    # The bands of conversations longer than one, each with the sums of those before it.
    deep = lengths.where(F.col("length") > per_band)
    sums = rows.join(deep, "conv").groupBy("conv", band, "length").agg(*(F.sum(c).alias(c) for c in _LANES))
    before = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = written(
        sums.select("conv", "band", "length", *((F.sum(c).over(before) % int(PRIME)).alias(c) for c in _LANES)), "bands"
    )
    starts = bands.where("band > 0").select(
        "conv", (F.col("band") * per_band).alias("depth"), *_LANES, *zeros[LANES:], "band", "length"
    )
    inner = rows.select("*", band, F.lit(None).cast("long").alias("length"))
    dealt = inner.unionByName(roots).unionByName(starts).select(shard, "*")
    local = written(dealt.groupBy("shard", "band").applyInArrow(lambda table: _shard_nodes(table, per_band), _NODES), "shard_nodes")

    nodes = (
        local.where("own")
        .groupBy("high", "low")
        .agg(F.sum("n").alias("members"), F.min("owner").alias("least"),
             *(_same(c) for c in ("depth", "chars", "check", "parent_high", "parent_low")))
    )
    nodes = written(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent_high").alias("high"), F.col("parent_low").alias("low")).agg(
        F.count("*").alias("n_children")
    )
    known = nodes.join(children, ["high", "low"], "left").select(
        "high", "low", "depth", "members", "least", "chars", F.coalesce("n_children", F.lit(0)).alias("n_children")
    )
    known = written(known, "nodes")

    # What long conversations own in later bands, at the node where they leave a band.
    owned = known.where("depth > 0").join(deep.select(F.col("conv").alias("least")), "least", "left_semi")
    owned = owned.groupBy(F.col("least").alias("conv"), band).agg(
        F.sum((F.col("members") - 1) * F.col("chars")).alias("saved"), F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves")
    )
    after = Window.partitionBy("conv").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = bands.select("conv", "band").join(owned, ["conv", "band"], "left").select(
        "conv", "band", F.sum("saved").over(after).alias("later_saved"), F.sum("leaves").over(after).alias("later_leaves")
    )
    through = local.where("size(through) > 0").select("shard", "band", "slot", F.explode("through").alias("conv"))
    later = through.join(later, ["conv", "band"]).groupBy("shard", "band", "slot").agg(
        F.sum("later_saved").alias("later_saved"), F.sum("later_leaves").alias("later_leaves")
    )
    placed = (
        local.drop("depth", "chars", "n", "check", "parent_high", "parent_low", "ends", "through")
        .join(known, ["high", "low"])
        .join(later, ["shard", "band", "slot"], "left")
        .fillna(0, ["later_saved", "later_leaves"])
    )
    partial = placed.groupBy("shard", "band").applyInArrow(_accumulate, _SUMS)
    summed = partial.groupBy("high", "low").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("parent_owner").alias("parent_conv_id")
    )
    ends = member_hashes(local.select("high", "low", F.explode("ends").alias("conv")))
    return known.join(summed, ["high", "low"]).join(ends, ["high", "low"], "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("members").alias("n_convs"), "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
