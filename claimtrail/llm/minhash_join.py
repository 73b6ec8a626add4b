r"""MinHash near-dedup by an inverted join of signature coordinates.

A document's set is its distinct three-word shingles, and two documents link if their sets have a similarity of at least 0.85. Of each
set 64 minimum hashes are taken. Two sets of similarity s agree in a coordinate with probability s, so linked ones agree in fewer than 40 of
64 with a probability of 3e-6 at most (``missed``); candidates are the pairs that agree in 40 or more.

Documents with equal sets are one class. Classes are posted under their coordinate-value pairs. Prefix: pairs that agree in 40 coordinates share one of
the 25 rarest of each, so only these are posted, and a class whose 25 rarest pairs nobody shares takes no further part. Skip:
posting lists of the same members are merged once. Within a list the agreeing coordinates of all its members are counted at once, and
members that cannot reach the threshold any more are left out; what remains is confirmed on the whole sets, and a list gives back one star
for each group it found linked, not its pairs.

A list of up to 1,024 members is one task's work. In a longer one all members are first compared with one hub. Those that the hub's
component holds are linked already and needn't meet each other; the others meet all, in tiles, each compared by a task of
its own. Shuffles grow with the members; comparisons grow with the square only for texts that share most coordinates with a hub's group
and don't belong to it. No list, no set of pairs and no component passes through the driver or one task.

Defined cases: a document of one or two words has its whole sequence as its only shingle; one without words or text has an empty set and
links with nothing. Rows that repeat a doc_id are compared text by text. Rows without a doc_id link like others but give no component their name; a
component of such rows alone has none, and its rows are kept. Texts of any length are compared whole. An empty table gives an empty
result. Only doc_id (of any type that has an order) and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.columns import named
from claimtrail.llm.components import components
from claimtrail.llm.text import BLANKS, U64, Words, each_chunk, gram_hashes, mix
from claimtrail.sources.scratch import settle

SHINGLE = 3
SIMILARITY = 85  # hundredths
COORDINATES = 64
MATCHES = 40
MEMBERS = 1024  # of a list that one task compares
TILE = 512
TILE_SHINGLES = 1 << 20
_COLUMNS = 4096  # of the incidence matrix at a time


def missed(similarity: float = SIMILARITY / 100, coordinates: int = COORDINATES, matches: int = MATCHES) -> float:
    """Probability that a pair of this similarity agrees in fewer than ``matches`` coordinates."""
    return sum(comb(coordinates, k) * similarity**k * (1 - similarity) ** (coordinates - k) for k in range(matches))


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the n-word shingles of each text, sorted, and the bounds of each text's hashes."""
    hashes, counts = words.hashes(), np.diff(words.of)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(len(hashes)) + n <= words.of[owner + 1])
    grams, owners = gram_hashes(hashes, n)[at], owner[at]
    few = np.flatnonzero((counts > 0) & (counts < n))
    if len(few):
        whole = [gram_hashes(hashes[words.of[i] : words.of[i + 1]], int(counts[i]))[0] for i in few]
        grams, owners = np.concatenate([grams, np.array(whole, U64)]), np.concatenate([owners, few])
    order = np.lexsort((grams, owners))
    grams, owners = grams[order], owners[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])
    return grams[new], np.searchsorted(owners[new], np.arange(len(counts) + 1))


def _seeds(count: int) -> np.ndarray:
    return mix(np.arange(1, 2 * count + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)).reshape(2, count)


def signatures(grams: np.ndarray, of: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """A 64-bit number for each coordinate-value pair of each set; zeros for an empty set."""
    out = np.zeros((len(of) - 1, coordinates), U64)
    full = of[1:] > of[:-1]
    if full.any():
        for k, (salt, factor) in enumerate(_seeds(coordinates).T):
            least = np.minimum.reduceat((grams ^ salt) * (factor | U64(1)), of[:-1][full])
            out[full, k] = mix(least ^ U64(k))
    return out


def _lists(values: np.ndarray, of: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(values.view(np.int64)))


def _prints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, size, identity and coordinates of the set of every row."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("text_hash bigint, n bigint, cls string, keys array<bigint>").fields])

    def run(batches):
        for batch in batches:
            for first, last, words in each_chunk(batch.column("text"), BLANKS, lower=True):
                grams, of = shingle_sets(words, SHINGLE)
                sums = []
                for salt in (1, 2):
                    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(grams ^ U64(salt)), dtype=U64)])
                    sums.append(total[of[1:]] - total[of[:-1]])
                names = [f"{a:016x}{b:016x}" for a, b in zip(*(s.tolist() for s in sums))]
                keys = signatures(grams, of)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(of), pa.int64()), pa.array(names, pa.string()),
                        _lists(keys.ravel(), np.arange(len(keys) + 1) * keys.shape[1]),
                    ],
                    names=schema.names,
                )

    return map_batches(rows, run, schema)


def _posted(classes: DataFrame) -> DataFrame:
    """``key, node, n``: the classes under those of their rarest coordinate-value pairs that others share, one key for equal lists."""
    posts = classes.select("node", "n", F.explode("keys").alias("key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    mine = posts.join(shared, "key").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("rows", "key"))).alias("mine"))
    prefix = COORDINATES - MATCHES + 1
    rarest = F.expr(f"slice(mine, 1, greatest(0, {prefix} - ({COORDINATES} - size(mine))))")  # the unshared ones are the first of the prefix
    posts = settle(mine.select("node", "n", F.explode(rarest["key"]).alias("key")), "posts")
    lists = posts.groupBy("key").agg(
        F.count("*").alias("members"), F.sum("n").alias("shingles"), F.min("node").alias("hub"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s1"), F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(38,0)")).alias("s2"),
    )
    lists = lists.where("members > 1").groupBy("members", "shingles", "hub", "s1", "s2").agg(F.min("key").alias("key"))
    return settle(posts.join(lists.drop("s1", "s2"), "key"), "posting-lists")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, hashes`` for the classes in ``wanted``, from the text of one row of each."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    same = rows["doc_id"].eqNullSafe(wanted["rep"]["doc_id"]) & (rows["text_hash"] == wanted["rep"]["text_hash"])
    rows = rows.join(wanted, same).select("node", "text")

    def run(batches):
        for batch in batches:
            for first, last, words in each_chunk(batch.column("text"), BLANKS, lower=True):
                grams, of = shingle_sets(words, SHINGLE)
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(first, last - first), _lists(grams, of)], names=["node", "hashes"])

    return settle(map_batches(rows, run, "node bigint, hashes array<bigint>").dropDuplicates(["node"]), "sets")


def _similar(common, first, second, similarity: int = SIMILARITY):
    return 100 * common >= similarity * (first + second - common)


def agreeing(keys: np.ndarray, matches: int = MATCHES) -> np.ndarray:
    """Which pairs of rows agree in ``matches`` columns; counting stops once no further pair can get there."""
    n, columns = keys.shape
    counts = np.zeros((n, n), np.uint8)
    for k in range(columns):
        counts += keys[:, k, None] == keys[None, :, k]
        left = columns - k - 1
        if k % 8 == 7 and left < matches:
            open_ = (counts < matches) & (counts >= matches - left)
            if not open_.any():
                break
    found = counts >= matches
    np.fill_diagonal(found, False)
    return found


def overlaps(hashes: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets: the incidence matrix of the hashes that several have, times its transpose."""
    n = len(hashes)
    owner = np.repeat(np.arange(n), [len(h) for h in hashes])
    _, at, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    common = count > 1
    column = np.cumsum(common) - 1
    keep = common[at]
    owner, column = owner[keep], column[at[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), np.float32)  # exact up to 2 ** 24 in a block of columns
    for low in range(0, int(common.sum()), _COLUMNS):
        part = slice(*np.searchsorted(column, (low, low + _COLUMNS)))
        block = np.zeros((n, _COLUMNS), np.float32)
        block[owner[part], column[part] - low] = 1
        out += block @ block.T
    return out.astype(np.int64)


def stars(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """For every component of a symmetric boolean matrix: its first row with each of the others."""
    todo = np.ones(len(linked), bool)
    for first in range(len(linked)):
        if not todo[first]:
            continue
        seen = np.zeros(len(linked), bool)
        front = np.array([first])
        seen[first] = True
        while len(front):
            reached = linked[front].any(0) & ~seen
            seen |= reached
            front = np.flatnonzero(reached)
        todo &= ~seen
        yield from ((first, int(i)) for i in np.flatnonzero(seen) if i != first)


def _merge(batches):
    """Links of the lists of a sorted stream ``key, part, node, n, keys, hashes``."""

    def rows():
        for batch in batches:
            flat = [(c.flatten().to_numpy(), np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy())])) for c in batch.columns[4:]]
            lead = zip(*(c.to_pylist() for c in batch.columns[:4]))
            for i, row in enumerate(lead):
                yield *row, *(values[of[i] : of[i + 1]].copy() for values, of in flat)

    first, second = [], []
    for _, members in groupby(rows(), key=lambda r: r[:2]):
        members = list(members)
        found = agreeing(np.array([m[4] for m in members]))
        near = np.flatnonzero(found.any(0))
        if len(near):
            sizes = np.array([members[i][3] for i in near])
            linked = found[np.ix_(near, near)] & _similar(overlaps([members[i][5] for i in near]), sizes[:, None], sizes[None, :])
            nodes = [members[i][2] for i in near]
            for a, b in stars(linked):
                first.append(nodes[a])
                second.append(nodes[b])
        if len(first) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["u", "v"])
            first, second = [], []
    yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["u", "v"])


def _hub_links(long: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the members of long lists and their list's hub."""
    pairs = long.where("node <> hub").select("node", "hub").distinct()
    sizes = F.size("hashes").cast("bigint")
    mine = pairs.join(sets.select("node", sizes.alias("n"), "hashes"), "node")
    both = mine.join(sets.select(F.col("node").alias("hub"), sizes.alias("m"), F.col("hashes").alias("others")), "hub")
    common = F.size(F.array_intersect("hashes", "others")).cast("bigint")
    return both.where(_similar(common, F.col("n"), F.col("m"))).select(F.col("node").alias("u"), F.col("hub").alias("v"))


def _dealt(posts: DataFrame, labels: DataFrame | None, members: int, tile: int) -> DataFrame:
    """``posts`` with the part of its list that a row is compared in, a row once for each of its parts."""
    posts = posts.withColumn("label", F.col("node")) if labels is None else posts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = posts.where(F.col("members") > members).groupBy("key", "label").agg(F.count("*").alias("rows"))
    main = counts.groupBy("key").agg(F.max_by("label", "rows").alias("main"))
    posts = posts.join(main, "key", "left").withColumn("inside", F.coalesce(F.col("label") == F.col("main"), F.lit(False)))
    tiles = "bigint(greatest(ceil(count_if({0}) / {1}), ceil(sum(if({0}, n, 0)) / {2})))"
    deals = posts.where(F.col("members") > members).groupBy("key").agg(
        F.expr(tiles.format("not inside", tile, TILE_SHINGLES)).alias("few"), F.expr(tiles.format("inside", tile, TILE_SHINGLES)).alias("many")
    )
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.when(F.col("inside"), F.col("many")).otherwise(F.col("few")))
    short = posts.where(F.col("members") <= members).select("key", "node", "n", F.lit(0).cast("bigint").alias("part"))
    long = posts.join(deals, "key").where("few > 0").withColumn("own", own)
    # outsiders' tiles come first: each meets every tile once, and tiles of the main component meet no other of these
    parts = """if(inside, transform(sequence(0L, few - 1), i -> i * (few + many) + few + own),
        transform(sequence(0L, few + many - 1), j -> least(own, j) * (few + many) + greatest(own, j)))"""
    return short.unionByName(long.select("key", "node", "n", F.explode(F.expr(parts)).alias("part")))


def near_duplicates(docs: DataFrame, members: int = MEMBERS, tile: int = TILE) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id that links reach) and ``kept`` (it is its own) of every row."""
    prints = settle(_prints(docs), "prints")
    classes = prints.where("n > 0").groupBy("cls").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.any_value("n").alias("n"), F.any_value("keys").alias("keys"), F.min("doc_id").alias("least")
    )
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    posts = _posted(classes.select("node", "n", "keys"))
    listed = classes.join(posts.select("node").distinct(), "node", "left_semi")
    sets = _sets(docs, listed.select("node", "rep"))
    long = posts.where(F.col("members") > members)
    edges, labels = [], None
    if not long.isEmpty():
        edges.append(settle(_hub_links(long, sets), "hub-links"))
        labels = components(edges[0]).withColumnRenamed("component", "label")
    dealt = _dealt(posts, labels, members, tile).join(listed.select("node", "keys"), "node").join(sets, "node")
    dealt = dealt.select("key", "part", "node", "n", "keys", "hashes").repartition("key", "part").sortWithinPartitions("key", "part")
    edges.append(map_batches(dealt, _merge, "u bigint, v bigint"))
    links = edges[0] if len(edges) == 1 else edges[0].unionByName(edges[1])
    labels = classes.select("cls", "node", "least").join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    labels = settle(labels, "labels")
    names = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    found = prints.join(labels.join(names, "component").select("cls", "component_id"), "cls", "left")
    found = found.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, one of equal rows (by doc_id and text), with all their columns."""
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text")).distinct()
    same = docs["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64(docs["text"]) == kept["_text"])
    rows = docs.select("*").join(kept, same, "left_semi")
    return rows.dropDuplicates(["doc_id", "text"]).select(*map(named, docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).drop("text_hash")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS k
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared WHERE 100 * k >= 85 * (nx + ny - k)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT x, y FROM both_ways
  UNION
  SELECT r.x, b.y FROM reached r JOIN both_ways b ON b.x = r.y
), least AS (
  SELECT x, min(y) AS y FROM reached GROUP BY x
)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id, doc_id <= coalesce(y, doc_id) AS kept
FROM sets LEFT JOIN least ON x = doc_id
"""
