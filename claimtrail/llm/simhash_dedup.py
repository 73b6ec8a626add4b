"""SimHash near-dedup with bit-sliced distances.

A fingerprint has a bit for each hash bit that is set in over half of the hashes of a text's word shingles. Equal fingerprints are one node,
so copies cost nothing after the first grouping. Nodes are compared only inside buckets: nodes that differ in at most ``radius`` bits agree in
all but ``radius`` of the blocks their bits are cut into, so a bucket is a choice of equal blocks. The number of blocks follows the number of
nodes, so that a bucket of unrelated nodes stays small. A bucket of over ``TILE`` nodes is dealt in tiles, every two of which are compared in
one group; one of over ``TILE * MAX_TILES`` nodes is cut again by finer blocks, which leave at most 4,096 different nodes in a bucket.

Inside a bucket the nodes' bits stand in vertical planes, 64 nodes to a machine word; a probe's distances to a whole word are counted
by carry-save steps of bitwise operations, plane by plane, and words whose 64 distances all exceed the radius are abandoned. Nodes near
a bucket's first nodes are united beforehand, and nodes already united are not compared. Links of a bucket shrink to a star before
they leave the task, which holds some whole buckets at a time.

Defined cases: a text of fewer words than a shingle is one shingle; a null, empty or blank text has fingerprint zero and is linked
like any other. Repeated rows share fingerprint and component; rows that repeat a doc_id with another text are linked by their own text. A null
doc_id names no component; a component of such rows only has a null id. A doc_id may have any type with an order. Other columns don't matter.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.columns import pack, unpack
from claimtrail.llm.components import components
from claimtrail.llm.text import U64, chunks, mix
from claimtrail.sources.scratch import settle

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 4096
MAX_TILES = 64
ROWS = 200_000
LEADERS = 3
NAMELESS = 1 << 62
SET_TILE = 256  # sets of a tile
SET_TILE_HASHES = 1 << 19  # shingles of a tile
BUCKET = 256  # nodes of a bucket wanted on average
_SLICE = 1 << 16
_PAIRS = 1 << 14
_ONES = U64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``size`` lower-cased words, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, U64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], U64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), U64, len(words) - size + 1)


def majority(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of hashes of these sizes, the bits set in over half of them."""
    counts = np.zeros((len(sizes), 64), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, len(flat), _SLICE):
        bits = np.unpackbits(flat[at : at + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        mine = owner[at : at + _SLICE]
        first = np.flatnonzero(np.diff(mine, prepend=-1))
        counts[mine[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash`` and the fingerprint of every row, as a signed number ``fp0``."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def compute(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist()
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
            prints = np.zeros(len(texts), U64)
            for first, last in chunks(offsets):
                hashes = [shingle_hashes(t, shingle) for t in texts[first:last]]
                prints[first:last] = majority(np.concatenate([*hashes, np.zeros(0, U64)]), np.array([len(h) for h in hashes]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(prints.view(np.int64))], ["doc_id", "text_hash", "fp0"])

    return map_batches(rows, compute, f"doc_id {kind}, text_hash bigint, fp0 bigint")


def block_masks(blocks: int, radius: int = RADIUS, free: int = -1) -> list[int]:
    """Masks that leave out ``radius`` of the ``blocks`` into which the bits of ``free`` (all, if negative) are cut.

    Bits outside ``free`` are in every mask. Numbers within the radius that agree outside ``free`` agree under a mask.
    """
    free &= (1 << 64) - 1
    places = [i for i in range(64) if free >> i & 1]
    cuts = [sum(1 << p for p in places[len(places) * b // blocks : len(places) * (b + 1) // blocks]) for b in range(blocks)]
    fixed = ~free & ((1 << 64) - 1)
    return [fixed | sum(cut for b, cut in enumerate(cuts) if b not in left) for left in combinations(range(blocks), radius)]


def blocks_for(nodes: int, radius: int = RADIUS, bucket: int = BUCKET) -> int:
    """The fewest blocks whose buckets would hold ``bucket`` unrelated nodes on average."""
    blocks = radius + 1
    while nodes >> (64 * (blocks - radius) // blocks) > bucket and blocks < 16:
        blocks += 1
    return blocks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _planes(fp: np.ndarray) -> np.ndarray:
    """Bits of one fingerprint word as planes: plane, word of 64 rows."""
    words = -(-len(fp) // 64)
    lanes = np.zeros(words * 64, U64)
    lanes[: len(fp)] = fp
    bits = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T.reshape(64, words, 64), axis=2, bitorder="little")).view("<u8")[..., 0]


def sliced_links(fps: list[np.ndarray], group: np.ndarray, label: np.ndarray, radius: int = RADIUS):
    """Yield arrays (i, j), i < j, of the rows of one group, not of one label, within ``radius`` bits of each other.

    Rows are in order of group and label. Pairs of one label may be left out or not.
    """
    n = len(group)
    words = -(-n // 64)
    planes = np.concatenate([_planes(fp) for fp in fps])
    stop, begin = np.searchsorted(group, group, "right"), np.searchsorted(group, group, "left")
    first = np.arange(words) * 64
    last = np.minimum(first + 63, n - 1)
    one_label = (label[first] == label[last]) & (group[first] == group[last])
    counts = stop[last] - first
    ends = np.cumsum(counts)
    levels = max(1, radius.bit_length())
    spare = (1 << levels) - 1 - radius  # counters start here, so that they run over beyond the radius
    for low in range(0, int(ends[-1]), _PAIRS):
        pair = np.arange(low, min(low + _PAIRS, int(ends[-1])))
        word = np.searchsorted(ends, pair, "right")
        probe = first[word] + pair - (ends[word] - counts[word])
        head = np.maximum(begin[probe] - first[word], 0)  # lanes of the probe's group, before the probe
        size = np.minimum(probe - first[word], 64) - head
        keep = (size > 0) & ~(one_label[word] & (label[first[word]] == label[probe]) & (group[first[word]] == group[probe]))
        word, probe, head, size = word[keep], probe[keep], head[keep].astype(U64), size[keep].astype(U64)
        over = ~((_ONES >> (U64(64) - size)) << head)
        ones = [np.full(len(word), _ONES if spare >> k & 1 else U64(0)) for k in range(levels)]
        for plane in range(len(planes)):
            value = fps[plane // 64][probe] >> U64(plane % 64) & U64(1)
            carry = planes[plane][word] ^ (U64(0) - value)
            for k in range(levels):
                ones[k], carry = ones[k] ^ carry, ones[k] & carry
            over |= carry
            if plane % 8 == 7:
                alive = over != _ONES
                if alive.sum() < 0.7 * len(alive):
                    word, probe, over, ones = word[alive], probe[alive], over[alive], [c[alive] for c in ones]
                if not len(word):
                    break
        near = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(near)
        if len(row):
            yield word[row] * 64 + lane, probe[row]


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels in which the rows i and j share the smallest label of their components."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != (next_ := label[label])).any():
            label = next_


def _stars(node: np.ndarray, fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes that links connect within their group, each with the smallest of its component; ``group`` counts up from 0."""
    n = len(node)
    order = np.lexsort((node, group))
    node, fps, group = node[order], fps[order], group[order]
    begin = np.searchsorted(group, np.arange(group[-1] + 1))
    label = np.arange(n)
    for _ in range(LEADERS):  # the first row of each group, then the first that none before is near to
        leader = begin[group]
        near = np.bitwise_count(fps ^ fps[leader]) <= radius
        label = unite(label, leader[near], np.flatnonzero(near))
        apart = np.flatnonzero(label != label[leader])
        begin[group[apart[::-1]]] = apart[::-1]
    order = np.lexsort((label, group))
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    fps, node, group, label = fps[order], node[order], group[order], where[label[order]]
    smallest = np.full(n, n)
    np.minimum.at(smallest, label, np.arange(n))  # labels are the first row of their component
    label = smallest[label]
    for i, j in sliced_links([fps], group, label.copy(), radius):
        label = unite(label, i, j)
    root = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(root, label, node)
    linked = np.flatnonzero(node != root[label])
    return node[linked], root[label[linked]]


def _bucket_stars(radius: int):
    """Stars of the buckets of a stream sorted by ``bucket, part``; whole buckets are worked on, about ``ROWS`` rows at a time."""

    def portions(batches):
        held, rows = [], 0
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("bucket", "part", "node", "fp0")]
            held.append(columns)
            rows += len(columns[0])
            if rows < ROWS:
                continue
            joined = [np.concatenate(c) for c in zip(*held)]
            last = np.flatnonzero((joined[0] != joined[0][-1]) | (joined[1] != joined[1][-1]))  # the last bucket may go on
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield [c[:cut] for c in joined]
            held, rows = [[c[cut:] for c in joined]], 0
        if held:
            yield [np.concatenate(c) for c in zip(*held)]

    def stars(batches):
        for bucket, part, node, fps in portions(batches):
            if len(node):
                group = np.cumsum(np.r_[False, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _stars(node, fps.view(U64), group, radius)], ["u", "v"])

    return stars


def _keyed(nodes: DataFrame, masks: list[int], level: int) -> DataFrame:
    """A row for each node and mask. ``bucket`` stands for (mask, masked bits); a clash only adds comparisons."""
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("m")) for i, m in enumerate(masks)])
    rows = nodes.select("node", "fp0", F.explode(listed).alias("_mask"))
    bucket = F.xxhash64(F.lit(level), "_mask.i", F.col("fp0").bitwiseAND(F.col("_mask.m")))
    return rows.select("node", "fp0", bucket.alias("bucket"), F.col("_mask.i").alias("mask"))


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE, max_tiles: int = MAX_TILES) -> DataFrame:
    """Edges ``u, v`` between nodes (``node``, their fingerprint ``fp0``) that connect the same nodes as all links do."""
    masks = block_masks(blocks_for(nodes.count(), radius), radius)
    keyed = _keyed(nodes, masks, 0)
    sizes = settle(keyed.groupBy("bucket", "mask").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    largest = sizes.agg(F.max("n")).first()[0] or 0
    sized = keyed.join(sizes, ["bucket", "mask"])
    tiles = F.ceil(F.col("n") / tile)
    own = F.pmod(F.xxhash64("node", "fp0"), tiles)
    pairs = F.transform(F.sequence(F.lit(0).cast("bigint"), tiles - 1), lambda other: F.least(own, other) * tiles + F.greatest(own, other))
    dealt = sized.where(tiles <= max_tiles).select("node", "fp0", "bucket", F.explode(pairs).alias("part"))
    if largest > tile * max_tiles:
        huge = sized.where(tiles > max_tiles)
        for i, mask in enumerate(masks):
            free = ~mask & ((1 << 64) - 1)
            # blocks of 4 bits: what a finer mask leaves out are 3 * 4 bits, 4,096 values
            finer = block_masks(max(radius, -(-free.bit_count() // 4)), radius, free)
            rows = _keyed(huge.where(F.col("mask") == i).select("node", "fp0"), finer, i + 1)
            dealt = dealt.unionByName(rows.select("node", "fp0", "bucket", F.lit(-1).cast("bigint").alias("part")))
    dealt = dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return map_batches(dealt, _bucket_stars(radius), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``text_hash``, the fingerprint ``fp0`` and ``component_id``: the smallest doc_id that links of ``radius`` bits reach."""
    found = settle(fingerprints(docs, shingle), "fingerprints")
    nodes = found.groupBy("fp0").agg(F.min("doc_id").alias("least")).withColumn("node", F.monotonically_increasing_id())
    nodes = settle(nodes, "nodes")
    labels = nodes.join(components(links(nodes.select("node", "fp0"), radius)), "node", "left").withColumn("component", F.coalesce("component", "node"))
    labels = settle(labels, "labels")
    names = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(labels.join(names, "component").select("fp0", "component_id"), "fp0").select("doc_id", "text_hash", "fp0", "component_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of the smallest doc_id of each component, unchanged; rows without a doc_id stay.

    Of rows with equal doc_id and text one stays, the least by a hash of all its columns. Rows of one doc_id with different texts all stay
    if each is its component's first.
    """
    kept = near_duplicates(docs, **options).where("doc_id = component_id").groupBy("doc_id", "text_hash").agg(F.lit(1).alias("_one"))
    packed = pack(docs).withColumn("_hash", F.xxhash64("text"))
    same = (packed["doc_id"] == kept["doc_id"]) & packed["_hash"].eqNullSafe(kept["text_hash"])
    first = packed.join(kept, same, "left_semi").groupBy("doc_id", "_hash").agg(F.min_by(F.struct("text", "_row"), F.xxhash64("_row")).alias("_first"))
    return unpack(first.select("_first.text", "_first._row"), docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def digest(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    found = near_duplicates(docs, shingle, radius)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp0")), 16, "0").alias("fingerprint"), "component_id")
