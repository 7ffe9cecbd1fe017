"""Exact Jaccard join of shingle sets by universe partitioning.

Two sets link when their similarity is at least ``percent`` / 100; then the sizes differ little and
at most H shingles belong to one of them only. The shingles of all sets of a size band are hashed
to segments. If the segments' allowances e satisfy sum(e + 1) > H, the two sets differ in at most
e shingles in at least one segment. So a segment with e = 0 is indexed by the hash of its subset,
and one with e = 1 by its subset and all subsets with one shingle deleted. How many segments of
each kind a band has is chosen by cost: rows to index against the candidates that equal subsets
of unrelated sets would make, given the number of sets in the band.

Most sets are linked with none, and most keys belong to one set only; neither are indexed. Linked sets
have many of their shingles of least hash in common (see prefixes). A first exchange of four bytes for
each of them finds those that may be repeated, as a map of bits; sets with too few of these are
linked with nothing, the others are written and partitioned. Their keys go the same way: only
those that may be repeated are shuffled with their sets.

Equal sets are one node, had by one row. The nodes of a key are not paired with each other. Each key has a pivot,
the node that shares most keys with others, and the nodes of all keys of a pivot are its group; two
linked nodes share a key, so they share a group. Every node is compared with one pivot; in groups
that are still in several components, with a second one out of the rest. What is left then are
groups of texts that resemble a common source but not each other. They are dealt in blocks, and in
each pair of blocks nodes of different components are held against each other by a bit for each
parity of hashed shingles: as many bits differ at most as shingles do. Only pairs that pass this
bound leave the task, and are verified like all others by their whole sets. So no link between
components is lost, and no pairs of a large group are emitted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm.arrow import id_and_text, map_in_arrow
from wattlake.llm.text import Words, chunks, combine, mix, words_of
from wattlake.session import shuffles_dropped, work_folder

#: Hashes that a bucket of the search for repeated ones holds, about (4 bytes each).
BUCKET_KEYS = 2_000_000
#: Shingles of stored sets that a task works on together; a longer set comes alone.
CHUNK_SHINGLES = 200_000
#: Bits of a map of repeated hashes that goes to all tasks: at least, at most (32 MB).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
#: Width of a size band: its smallest size over its largest.
BAND_RATIO = 0.65
#: Most pairs or nodes that are sent to all executors (16 bytes each); beyond, Spark shuffles.
BROADCAST_IDS = 1_000_000
#: Nodes of a block and most blocks of a group; beyond, blocks grow.
BLOCK_NODES = 64
MOST_BLOCKS = 40
#: Beyond so many nodes a block, groups get more blocks, so that a task's memory is bounded.
MOST_NODES = 2048


@dataclass(frozen=True)
class Band:
    """Sizes low to high, segments with allowance 0 (exact) and 1 (deletion)."""

    low: int
    high: int
    exact: int
    deletion: int


def most_apart(percent: int, total: int) -> int:
    """Most shingles in one of two linked sets only, if the sizes sum to total.

    With union u and d shingles apart, 100 * (u - d) >= percent * u and u + (u - d) = total.
    """
    return (100 - percent) * total // (100 + percent)


def largest_partner(percent: int, size: int) -> int:
    return 100 * size // percent


def band_limits(largest: int) -> list[tuple[int, int]]:
    """Consecutive size bands from 1 up to the largest size."""
    out, low = [], 1
    while low <= largest:
        high = max(low, int(low / BAND_RATIO))
        out.append((low, high))
        low = high + 1
    return out


def allocate(low: int, high: int, sets: int, percent: int) -> Band:
    """The cheapest segments for a band with that many sets.

    A key costs 1; a set that meets an unrelated one in a segment costs as much as 20 keys. Subsets
    of unrelated sets are taken to be equal when both are empty, or one short of it for e = 1.
    """
    apart = most_apart(percent, 2 * high)
    best: tuple[float, Band] | None = None
    for deletion in range((apart + 1) // 2 + 1):
        exact = max(0, apart + 1 - 2 * deletion)
        segments = exact + deletion
        if not segments:
            continue
        each = low / segments
        empty = math.exp(-2 * each) if segments > 1 else 0.0
        keys = exact + deletion * (1 + high / segments)
        meets = sets * (exact * empty + deletion * empty * (1 + 2 * each))
        cost = keys + 20 * meets
        if best is None or cost < best[0]:
            best = cost, Band(low, high, exact, deletion)
    return best[1]


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and where each text begins.

    A text with fewer words than a shingle is one shingle as a whole; one without words has none.
    """
    n = len(words.first) - 1
    h, first = words.hashes, words.first
    parts, begins = [], np.zeros(n + 1, np.int64)
    if len(h) >= size:
        joined = combine(*(h[k : len(h) - size + 1 + k] for k in range(size)))
    for i in range(n):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= size:
            own = joined[a : b - size + 1].copy()
            own.sort()
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        elif b > a:
            own = combine(*(h[k : k + 1] for k in range(a, b)), np.array([b - a], np.uint64))
        else:
            own = h[:0]
        parts.append(own)
        begins[i + 1] = begins[i] + len(own)
    return np.concatenate([np.zeros(0, np.uint64), *parts]), begins


def set_ids(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, from the sum of its mixed shingles and its size."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ np.uint64(0xA5A5A5A55A5A5A5A)), out=sums[1:])
    return mix(
        mix(sums[begins[1:]] - sums[begins[:-1]]) + np.diff(begins).astype(np.uint64)
    ).view(np.int64)


def keys_of(
    values: np.ndarray, begins: np.ndarray, band: Band, number: int, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of sets under a band: keys and the number of the set of each.

    A set is indexed by the first segments only whose allowances suffice for its own largest
    partner; of two linked sets the larger is indexed by all segments of the smaller.
    """
    n = len(begins) - 1
    segments = band.exact + band.deletion
    sizes = np.diff(begins)
    need = (100 - percent) * (sizes + 100 * sizes // percent) // (100 + percent) + 1
    used = np.where(need <= 2 * band.deletion, -(-need // 2), need - band.deletion)
    owner = np.repeat(np.arange(n), np.diff(begins))
    salted = mix(values + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64))
    segment = ((salted >> np.uint64(33)) % np.uint64(segments)).astype(np.int64)
    cell = owner * segments + segment
    # Sums of 32-bit halves stay exact in doubles.
    token = mix(salted ^ np.uint64(0x5851F42D4C957F2D))
    low = (token & np.uint64(0xFFFFFFFF)).astype(np.float64)
    high = (token >> np.uint64(32)).astype(np.float64)
    cells = n * segments
    sum_low = np.bincount(cell, low, minlength=cells).astype(np.uint64)
    sum_high = np.bincount(cell, high, minlength=cells).astype(np.uint64)

    def key(a: np.ndarray, b: np.ndarray, seg: np.ndarray) -> np.ndarray:
        place = np.uint64(number << 32) + seg.astype(np.uint64)
        return mix(mix(a * np.uint64(0x9E3779B97F4A7C15) + b) + mix(place + np.uint64(1)))

    every = np.arange(cells)
    every = every[every % segments < used[every // segments]]
    keys, sets = [key(sum_low[every], sum_high[every], every % segments)], [every // segments]
    if band.deletion:
        some = segment < np.minimum(band.deletion, used)[owner]
        c = cell[some]
        keys.append(
            key(
                sum_low[c] - low[some].astype(np.uint64),
                sum_high[c] - high[some].astype(np.uint64),
                segment[some],
            )
        )
        sets.append(owner[some])
    return np.concatenate(keys).view(np.int64), np.concatenate(sets)


def prefixes(sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of least hash that are looked at in sets of some sizes, and how many of them at
    least a linked set has among its own.

    Of a set of n shingles at least c = ceil(percent * n / 100) are in a linked one, whose size is c
    at least. In any order, the first n - c + k of two linked sets have k shingles in common.
    Here k is n // 5 + 1; the smaller set's holds for both, and that is c // 5 + 1 at least.
    """
    common = -(-percent * sizes // 100)
    return np.minimum(sizes, sizes - common + sizes // 5 + 1), common // 5 + 1


def _prefix_hashes(values: np.ndarray, begins: np.ndarray, percent: int):
    """Hashes of the shingles in the prefixes of all sets, the set of each, and its least number."""
    sizes = np.diff(begins)
    looked, least = prefixes(sizes, percent)
    owner = np.repeat(np.arange(len(sizes)), looked)
    at = np.arange(len(owner)) + (begins[:-1] - np.cumsum(looked) + looked)[owner]
    # The least hashes share their first bits, by which hashes are dealt to buckets.
    return mix(values[at] ^ np.uint64(0x13198A2E03707344)), owner, least


@dataclass
class Copies:
    """Nodes that several rows have, in order, and for each the hash of the id that stands for it."""

    nodes: np.ndarray
    stands: np.ndarray

    def first(self, nodes: np.ndarray, id_hash: np.ndarray) -> np.ndarray:
        """Whether a row stands for its node; also true for copies that are not held here."""
        if not len(self.nodes):
            return np.ones(len(nodes), bool)
        at = np.minimum(np.searchsorted(self.nodes, nodes), len(self.nodes) - 1)
        return (self.nodes[at] != nodes) | (self.stands[at] == id_hash)


def _copies(nodes: DataFrame) -> Copies:
    """Of nodes with more copies than BROADCAST_IDS nodes have, others are left out: their copies are
    then looked at, and one of them is kept later."""
    least = 2
    while nodes.where(F.col("copies") >= least).count() > BROADCAST_IDS:
        least *= 2
    rows = nodes.where(F.col("copies") >= least).select("node", "stands").toArrow()
    found, stands = rows["node"].to_numpy(), rows["stands"].to_numpy()
    order = np.argsort(found)
    return Copies(found[order], stands[order])


def _map_sets(docs: DataFrame, size: int, schema: str, each, copies=None) -> DataFrame:
    """Run each(batch slice, values, begins, set ids, pick) -> columns over the shingle sets of all rows.

    pick has the rows to use: with copies, those that stand for their node, once in a task.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for rows, texts in chunks(batch):
                values, begins = shingles(words_of(texts, lower=True), size)
                nodes = set_ids(values, begins)
                part = batch.slice(rows.start, len(texts))
                pick = np.arange(len(texts))
                if copies is not None:
                    id_hash = part.column("id_hash").to_numpy()
                    pick = pick[(np.diff(begins) > 0) & copies.value.first(nodes, id_hash)]
                    fresh = [i for i in pick.tolist() if (v := int(nodes[i])) not in seen and not seen.add(v)]
                    if len(seen) > 1_000_000:
                        seen.clear()
                    pick = np.array(fresh, np.int64)
                for columns in each(part, values, begins, nodes, pick):
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_in_arrow(docs, run, schema)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(part, values, begins, nodes, pick):
        yield [
            part.column("doc_id"),
            part.column("id_hash"),
            pa.array(np.diff(begins), pa.int64()),
            pa.array(nodes, pa.int64()),
        ]

    return _map_sets(docs, size, f"doc_id {kind}, id_hash long, n_shingles long, node long", each)


def _bits_of_buckets(hashes: int) -> int:
    """First bits by which so many hashes, about, are dealt to buckets."""
    return min(24, max(6, math.ceil(math.log2(max(1, hashes / BUCKET_KEYS)))))


def _dealt(hashes: np.ndarray, bits: int) -> list[pa.Array]:
    """Columns bucket and rest of 64-bit hashes: the first bits, and the 32 after them packed."""
    short = hashes >> np.uint64(32 - bits)
    short.sort()
    bucket = (short >> np.uint64(32)).astype(np.int64)
    opens = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = short.astype(np.uint32).view(np.uint8)
    cuts = np.append(opens, len(short)).astype(np.int32) * 4
    binary = pa.Array.from_buffers(pa.binary(), len(opens), [None, pa.py_buffer(cuts), pa.py_buffer(rest)])
    return [pa.array(bucket[opens], pa.int64()), binary]


def _repeated(dealt: DataFrame) -> DataFrame:
    """The first 32 + bits bits of hashes of which there may be two, as h.

    Most hashes are had by one set only and need no shuffle of their own. Here one travels as four
    bytes, dealt by its first bits to buckets of BUCKET_KEYS or so; a bucket's numbers that occur
    twice are repeated, or, with a chance below one in a thousand, single ones that look so.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] = []
        bucket = None

        def repeated() -> pa.RecordBatch:
            rest = np.frombuffer(b"".join(waiting), np.uint32).copy()
            rest.sort()
            twice = np.unique(rest[1:][rest[1:] == rest[:-1]]).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(twice + (bucket << 32), pa.int64())], names=["h"])

        for batch in batches:
            for own, rest in zip(batch.column("bucket").to_pylist(), batch.column("rest").to_pylist()):
                if own != bucket and waiting:
                    yield repeated()
                    waiting.clear()
                bucket = own
                waiting.append(rest)
        if waiting:
            yield repeated()

    return map_in_arrow(dealt.repartition("bucket").sortWithinPartitions("bucket"), run, "h long")


def _repeated_shingles(docs: DataFrame, size: int, percent: int, copies, bits: int) -> DataFrame:
    """Shingles that may be in the prefixes of two nodes."""

    def each(part, values, begins, nodes, pick):
        hashes, owner, _ = _prefix_hashes(values, begins, percent)
        used = np.zeros(len(begins) - 1, bool)
        used[pick] = True
        hashes = hashes[used[owner]]
        if len(hashes):
            yield _dealt(hashes, bits)

    return _repeated(_map_sets(docs, size, "bucket long, rest binary", each, copies))


def _candidates(docs: DataFrame, size: int, percent: int, copies, bits: int, bit_map) -> DataFrame:
    """Sets that may be linked: row (a number of its own), node, size, sorted shingles and their
    sketch, as bytes. A node has one row, or several for repeated rows and copies left out."""

    def each(part, values, begins, nodes, pick):
        hashes, owner, least = _prefix_hashes(values, begins, percent)
        hit = _may_be_repeated(bit_map.value, hashes, bits)
        at = pick[np.bincount(owner, hit, minlength=len(nodes))[pick] >= least[pick]]
        sets = [values[begins[i] : begins[i + 1]] for i in at]
        yield [
            pa.array(nodes[at], pa.int64()),
            pa.array([len(x) for x in sets], pa.int64()),
            pa.array([x.tobytes() for x in sets], pa.binary()),
            pa.array([sketch(x).tobytes() for x in sets], pa.binary()),
        ]

    found = _map_sets(docs, size, "node long, size long, members binary, sketch binary", each, copies)
    return found.withColumn("row", F.monotonically_increasing_id())


def _keyed(highs: np.ndarray, bands: list[Band], percent: int, begins, values, pick):
    """(keys, rows of pick's texts) by band, for the texts that pick names."""
    sizes = np.diff(begins)[pick]
    own = np.searchsorted(highs, sizes)
    reach = np.searchsorted(highs, 100 * sizes // percent)
    for number, band in enumerate(bands):
        at = pick[(sizes > 0) & ((own == number) | ((own < number) & (reach >= number)))]
        if len(at):
            cuts = np.concatenate([[0], np.cumsum(begins[at + 1] - begins[at])])
            some = np.concatenate([values[begins[i] : begins[i + 1]] for i in at])
            keys, sets = keys_of(some, cuts, band, number, percent)
            yield keys, at[sets]


def key_estimate(bands: list[Band], held: dict[int, int]) -> int:
    """About as many keys as sets have, by the number of sets of each band."""
    return sum(
        held.get(b.high, 0) * int(b.exact + b.deletion * (1 + b.high / (b.exact + b.deletion))) for b in bands
    )


def _map_members(members: DataFrame, schema: str, each) -> DataFrame:
    """Run each(values, begins, nodes) -> columns over stored sets, some of them at a time."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("members")).to_numpy().astype(np.int64) // 8)
            k = 0
            while k < batch.num_rows:
                before = ends[k - 1] if k else 0
                stop = max(k + 1, int(np.searchsorted(ends, before + CHUNK_SHINGLES, side="right")))
                part = batch.slice(k, stop - k)
                values = np.frombuffer(b"".join(part.column("members").to_pylist()), np.uint64)
                begins = np.concatenate([[0], ends[k:stop] - before])
                for columns in each(values, begins, part.column("node").to_numpy()):
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                k = stop

    return map_in_arrow(members.select("node", "members"), run, schema)


def _repeated_keys(members: DataFrame, percent: int, bands: list[Band], bits: int) -> DataFrame:
    """Keys that two nodes may have."""
    highs = np.array([b.high for b in bands], np.int64)

    def each(values, begins, nodes):
        pick = np.arange(len(nodes))
        found = [keys for keys, _ in _keyed(highs, bands, percent, begins, values, pick)]
        if found:
            yield _dealt(np.concatenate(found).view(np.uint64), bits)

    return _repeated(_map_members(members, "bucket long, rest binary", each))


def _bit_map(repeated: DataFrame) -> np.ndarray:
    """A bit for each h modulo a power of two, 16 bits a number while that stays below MOST_BITS.

    Spark sets the bits; the driver gets blocks of 4 KB, 32 MB in all at most. Beyond 16 million
    repeated keys more single ones pass; none that is repeated is ever lost.
    """
    size = LEAST_BITS
    count = repeated.count()
    while size < min(16 * count, MOST_BITS):
        size *= 2
    place = F.col("h").bitwiseAND(F.lit(size - 1))
    blocks = (
        repeated.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .toArrow()
    )
    # Position 0 lies in block 0 by Spark's numbering of its own; all others from block 1 on.
    out = np.zeros((size // 32768 + 2, 4096), np.uint8)
    for block, bits in zip(blocks["block"].to_pylist(), blocks["bits"].to_pylist()):
        own = np.frombuffer(bits, np.uint8)
        out[block, : len(own)] = own
    return out


def bits_are_set(bit_map: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    """Whether the map has the bits of h, by the numbering of Spark's bitmap functions."""
    place = h & (size - 1)
    # From 1 on, 32768 places a block; the bit of a place counts from the block's first.
    block = np.where(place > 0, 1 + (place - 1) // 32768, 0)
    bit = np.where(place > 0, (place - 1) % 32768, 0)
    return (bit_map[block, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _may_be_repeated(bit_map: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    h = (hashes >> np.uint64(32 - bits)).view(np.int64)
    return bits_are_set(bit_map, h, (len(bit_map) - 2) * 32768)


def _index(members: DataFrame, percent: int, bands: list[Band], bits: int, bit_map) -> DataFrame:
    """Keys of all candidates that may be repeated."""
    highs = np.array([b.high for b in bands], np.int64)

    def each(values, begins, nodes):
        for keys, sets in _keyed(highs, bands, percent, begins, values, np.arange(len(nodes))):
            may = _may_be_repeated(bit_map.value, keys.view(np.uint64), bits)
            yield [pa.array(keys[may], pa.int64()), pa.array(nodes[sets[may]], pa.int64())]

    return _map_members(members, "key long, node long", each)


def sketch_words(size: int) -> int:
    """64-bit words of a parity sketch: a power of two with more bits than twice the size."""
    return 1 << max(3, math.ceil(math.log2(max(size, 1) / 32)))


def sketch(members: np.ndarray) -> np.ndarray:
    """Parities of a set's hashes. Folding its halves by xor gives the sketch of half the bits."""
    bits = 64 * sketch_words(len(members))
    place = (mix(members ^ np.uint64(0x243F6A8885A308D3)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").view(np.uint64)


def fold(one: np.ndarray, words: int) -> np.ndarray:
    while len(one) > words:
        half = len(one) // 2
        one = one[:half] ^ one[half:]
    return one


def blocks_of(n: Column) -> Column:
    """Number of blocks of a group of n nodes."""
    few = F.least(F.ceil(n / BLOCK_NODES), F.lit(MOST_BLOCKS))
    return F.greatest(few, F.ceil(n / MOST_NODES)).cast("int")


def _near_in_blocks(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of nodes of one group in different parts that may be linked by their sketches.

    nodes: pivot, node, part, size, sketch, n (nodes of the group).
    """
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    dealt = (
        nodes.withColumn("blocks", blocks_of(F.col("n")))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "pivot",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") <= F.col("other")).alias("left"),
            "node",
            "part",
            "size",
            "sketch",
        )
        .repartition("pivot", "i", "j")
        .sortWithinPartitions("pivot", "i", "j")
    )

    def pairs(rows: list[tuple]) -> list[tuple[int, int]]:
        words = min(len(r[7]) for r in rows) // 8
        bits = np.array([fold(np.frombuffer(r[7], np.uint64), words) for r in rows])
        node = np.array([r[4] for r in rows])
        part = np.unique(np.array([r[5] for r in rows]), return_inverse=True)[1]
        size = np.array([r[6] for r in rows])
        same = rows[0][1] == rows[0][2]
        left = np.flatnonzero([r[3] for r in rows])
        right = left if same else np.flatnonzero([not r[3] for r in rows])
        if not len(right):
            return []
        out = []
        step = max(1, (1 << 20) // len(right))
        for k in range(0, len(left), step):
            at = left[k : k + step]
            apart = np.zeros((len(at), len(right)), np.int32)
            for w in range(words):
                apart += np.bitwise_count(bits[at, w][:, None] ^ bits[right, w][None, :])
            total = size[at][:, None] + size[right][None, :]
            near = (100 + percent) * apart <= (100 - percent) * total
            near &= part[at][:, None] != part[right][None, :]
            if same:
                near &= node[at][:, None] < node[right][None, :]
            x, y = np.nonzero(near)
            out += zip(node[at[x]].tolist(), node[right[y]].tolist(), strict=True)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def found() -> pa.RecordBatch:
            some = pairs(waiting) if len(waiting) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([min(p) for p in some], pa.int64()), pa.array([max(p) for p in some], pa.int64())],
                names=["a", "b"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if waiting and row[:3] != waiting[0][:3]:
                    yield found()
                    waiting.clear()
                waiting.append(row)
        if waiting:
            yield found()

    return map_in_arrow(dealt, run, "a long, b long").distinct()


def _small(table: DataFrame) -> DataFrame:
    """A stored table, sent to all tasks if its size allows."""
    return F.broadcast(table) if table.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else table


def _sides(pairs: DataFrame, members: DataFrame, *columns: str) -> DataFrame:
    """Stored pairs (a, b) with columns of both their sets.

    Sets are long and pairs are short: pairs go to the sets of b, and of a only used ones travel.
    """
    pairs = _small(pairs)
    b = pairs.join(members.select(F.col("node").alias("b"), *(F.col(c).alias(f"b_{c}") for c in columns)), "b")
    used = members.join(pairs.select(F.col("a").alias("node")), "node", "left_semi")
    a = used.select(F.col("node").alias("a"), *(F.col(c).alias(f"a_{c}") for c in columns))
    return b.join(a, "a").select("a", "b", *(f"{side}_{c}" for side in "ab" for c in columns))


def _linked(store: Callable, pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough.

    Sketches go first, since they are short: a pair in which too many of their bits differ is not
    linked. For the others the whole intersection is counted.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("a_sketch", "b_sketch", "a_size", "b_size"))
            for x, y, m, n in zip(*columns, strict=True):
                words = min(len(x), len(y)) // 8
                x, y = (fold(np.frombuffer(v, np.uint64), words) for v in (x, y))
                apart = int(np.bitwise_count(x ^ y).sum())
                keep.append((100 + percent) * apart <= (100 - percent) * (m + n))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("a_members", "b_members"))
            for x, y in zip(*columns, strict=True):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    close = store(map_in_arrow(_sides(store(pairs), members, "sketch", "size"), near, "a long, b long"))
    return map_in_arrow(_sides(close, members, "members"), same, "a long, b long")


class _Store:
    """Written tables of one join, under the shared work folder."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path, self.n = spark, work_folder(spark, "jaccard"), 0

    def __call__(self, frame: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.path}/{self.n}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)


def components(store: _Store, links: DataFrame, labels: DataFrame) -> DataFrame:
    """node, label: the least label that each node reaches by links (a, b).

    Every round takes the least label among a node and its neighbours, then follows labels that
    are themselves relabelled, so the rounds grow with the logarithm of a component's length.
    """
    both = store(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    linked = store(
        labels.join(both.select(F.col("a").alias("node")).distinct(), "node").select("node", "label")
    )
    while True:
        near = (
            both.join(linked.select(F.col("node").alias("a"), "label"), "a")
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = linked.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        # Jump: what the old label's nodes have found, all of them may take.
        better = step.groupBy("old").agg(F.min("label").alias("best"))
        step = store(
            step.join(better, "old").select(
                "node", F.col("best").alias("label"), (F.col("best") < F.col("old")).alias("moved")
            )
        )
        linked = step.select("node", "label")
        if step.where("moved").isEmpty():
            return linked


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    shingle_words: int = 3,
    percent: int = 90,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id that links lead to, for each row.

    Words are lower-cased (A-Z) and parted by ASCII white space. A text without words, or null, has
    the empty set and is linked with nothing, so its component is its own id. Shorter texts than a
    shingle are one shingle. Repeated rows are equal sets. An empty table gives no rows; other
    columns are not read. Rows without an id keep a null id and never name a component; a set that
    only such rows have is linked with nothing and has no component.
    """
    with shuffles_dropped(spark):
        sets, names = _components_of_sets(spark, docs, shingle_words, percent, id_col, text_col)
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return sets.join(names, "node", "left").select(
        "doc_id", "n_shingles", own.cast(sets.schema["doc_id"].dataType).alias("component_id")
    )


def _components_of_sets(
    spark: SparkSession, docs: DataFrame, shingle_words: int, percent: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """doc_id, n_shingles and node of each row, and component_id of each node."""
    store = _Store(spark)
    source = id_and_text(docs, id_col, text_col).withColumn("id_hash", F.xxhash64("doc_id"))
    sets = store(_sets(source, shingle_words))
    with_id = F.when(F.col("doc_id").isNotNull(), F.col("id_hash"))
    nodes = store(
        sets.where("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("label"),
            F.first("n_shingles").alias("size"),
            F.min(with_id).alias("stands"),
            F.count(with_id).alias("copies"),
        )
    )
    share = spark.sparkContext.broadcast
    copies = share(_copies(nodes))
    # Sets without an id are linked with nothing.
    source = source.where("doc_id IS NOT NULL")
    shingles_held = nodes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits = _bits_of_buckets(shingles_held)
    repeated = store(_repeated_shingles(source, shingle_words, percent, copies, bits))
    bit_map = share(_bit_map(repeated))
    found = store(_candidates(source, shingle_words, percent, copies, bits, bit_map))
    several = store(found.groupBy("node").agg(F.min("row").alias("kept"), F.count("*").alias("n")).where("n > 1"))
    members = (
        found.join(several.drop("n"), "node", "left").where("kept IS NULL OR kept = row").drop("kept", "row")
    )

    # One row for each band that has sets: the sizes of bands grow geometrically.
    largest = members.agg(F.max("size")).first()[0] or 0
    limits = band_limits(largest_partner(percent, largest))
    high = F.expr("CASE " + " ".join(f"WHEN size <= {h} THEN {h}" for _, h in limits) + " END") if limits else F.lit(0)
    held = {r["high"]: r["n"] for r in members.groupBy(high.alias("high")).agg(F.count("*").alias("n")).collect()}
    bands = [allocate(a, b, held.get(b, 0), percent) for a, b in limits]

    bits = _bits_of_buckets(key_estimate(bands, held))
    bit_map = share(_bit_map(store(_repeated_keys(members, percent, bands, bits))))
    index = _index(members, percent, bands, bits, bit_map)
    # Only keys of two different sets or more are kept.
    by_key = Window.partitionBy("key")
    buckets = store(
        index.repartition("key")
        .dropDuplicates(["key", "node"])
        .withColumn("n", F.count("*").over(by_key))
        .where("n > 1")
    )
    weight = store(buckets.groupBy("node").agg(F.sum("n").alias("weight")))
    pivot = F.max(F.struct("weight", "node")).over(by_key)["node"]
    groups = store(
        buckets.drop("n")
        .join(weight, "node")
        .withColumn("pivot", pivot)
        .groupBy("pivot", "node")
        .agg(F.count("*").alias("keys"))
    )

    first = (
        groups.where("node <> pivot")
        .groupBy(F.col("node").alias("b"))
        .agg(F.max(F.struct("keys", "pivot")).alias("best"))
        .select(F.col("best.pivot").alias("a"), "b")
    )
    linked_pairs = store(_linked(store, first, members, percent))

    rest = store(_open_groups(groups, components(store, linked_pairs, nodes)))
    seconds = (
        rest.where("part <> pivot_part")
        .join(weight, "node")
        .groupBy("pivot")
        .agg(F.max(F.struct("weight", "node", "part")).alias("best"))
        .select("pivot", F.col("best.node").alias("a"), F.col("best.part").alias("a_part"))
    )
    more = (
        rest.join(seconds, "pivot")
        .where("part <> a_part")
        .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
        .distinct()
    )
    linked_pairs = store(linked_pairs.unionByName(_linked(store, more, members, percent)))

    rest = _open_groups(groups, components(store, linked_pairs, nodes))
    near = _near_in_blocks(rest.join(members.drop("members"), "node"), percent)
    linked_pairs = store(linked_pairs.unionByName(_linked(store, near, members, percent)))

    linked = components(store, linked_pairs, nodes).withColumnRenamed("label", "reached")
    names = nodes.join(linked, "node", "left").select(
        "node", F.coalesce("reached", "label").alias("component_id")
    )
    return sets, names


def _open_groups(groups: DataFrame, linked: DataFrame) -> DataFrame:
    """Nodes of the groups that are still in several components: pivot, node, part (the label of
    its component, or the node itself), pivot_part, n (nodes of the group)."""
    alone = F.concat(F.lit("node "), "node")
    part = F.coalesce(F.concat(F.lit("label "), F.col("label").cast("string")), alone)
    placed = groups.join(linked, "node", "left").select("pivot", "node", part.alias("part"))
    parted = (
        placed.groupBy("pivot")
        .agg(
            F.min("part").alias("low"),
            F.max("part").alias("high"),
            F.max(F.when(F.col("node") == F.col("pivot"), F.col("part"))).alias("pivot_part"),
            F.count("*").alias("n"),
        )
        .where("low < high")
        .drop("low", "high")
    )
    return placed.join(parted, "pivot")
