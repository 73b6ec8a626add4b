r"""Merkle manifest of a table, with a witness for every row.

A row's leaf is the SHA-256 of its fields, each written as byte count and value. The leaves of a source, in order of doc_id, are joined
16 at a time, level by level, until one node remains, the source's subroot; the subroots, in order of the source, are joined likewise to
the root. A row's witness is, level by level up to the root, its place in its run of 16 and the digests of the run's other members.

Rows are numbered within their source by a range exchange and a running sum over its partitions, so a source that holds most of the rows
is spread like any other. Aligned blocks of 16 ** 3 leaves are streamed one by one: each append attaches to the new subtree the siblings
that its run has so far, and the siblings that complete later extend it when the run closes; a closed run is an append one level up.
The block roots are further appends, in blocks of their own, until one node is left (two rounds for 16 million rows of a source,
three for 68 billion). On the way back each block starts with the witness of its own root, which ends the witnesses of its members. A
task holds the digests of one block, and no texts: only digests are shuffled.

Defined cases: a null field counts as ``-``, so it differs from an empty one. A null source is a source of its own, the first; a null
doc_id stands first in its source. Rows that repeat a doc_id in a source are separate leaves, ordered by their digest. Texts of any
length are hashed whole. The only leaf of a table is its root, with an empty witness. An empty table has no rows in its manifest. Columns
other than the five fields don't matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.line_dedup import LOWER, UPPER
from claimtrail.sources.scratch import settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 16
LEVELS = 3
BLOCK = RUN**LEVELS
HEX = 64
_STEP = "struct<at: int, others: string>"


def leaf_of(*values: Column) -> Column:
    """SHA-256 of fields, each as its UTF-8 byte count, a colon and the value, or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""

    def up(node: Column, step: Column) -> Column:
        before = step["at"] * HEX
        return F.sha2(F.concat(F.substring(step["others"], F.lit(1), before), node, F.substring(step["others"], before + 1, F.length(step["others"]))), 256)

    return F.aggregate(witness, leaf, up)


class _Subtree:
    """A node of a block and the witness it has so far: its place, its siblings to the left, in time those to the right, its parent."""

    __slots__ = ("node", "at", "left", "right", "up", "path")

    def __init__(self, node: str):
        self.node, self.up, self.path = node, None, None

    def steps(self, rest: list) -> list:
        """The finished witness: own step, then the steps of the subtree above, shared by the run."""
        if self.up is None:
            return rest
        if self.up.path is None:
            self.up.path = self.up.steps(rest)
        return [{"at": self.at, "others": self.left + self.right}, *self.up.path]


class _Block:
    """Streaming aligned append of the leaves of one block. ``alone``: the block is its whole group, so it ends at one node."""

    def __init__(self, alone: bool, levels: int):
        self.alone, self.levels = alone, levels
        self.open: list[list[_Subtree]] = [[]]
        self.counts = [0]

    def append(self, node: str, level: int = 0) -> _Subtree:
        tree = _Subtree(node)
        if level == len(self.open):
            self.open.append([])
            self.counts.append(0)
        run = self.open[level]
        tree.at, tree.left = len(run), "".join(t.node for t in run)
        run.append(tree)
        self.counts[level] += 1
        if len(run) == RUN and level < self.levels:
            self._close(level)
        return tree

    def _close(self, level: int) -> None:
        run = self.open[level]
        whole = "".join(t.node for t in run)
        run_up = self.append(hashlib.sha256(whole.encode()).hexdigest(), level + 1)
        for tree in run:
            tree.right, tree.up = whole[(tree.at + 1) * HEX :], run_up
        run.clear()

    def root(self) -> str:
        """Close what is open. A block beside others rises the full number of levels, also with a single node."""
        level = 0
        while level < self.levels and not (self.alone and self.counts[level] == 1):
            if self.open[level]:
                self._close(level)
            level += 1
        return self.open[level][0].node


def _rows(batches):
    """Rows of Arrow batches as tuples."""
    return chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches)


def _blocks(rows):
    """Runs of rows of one group and block, for rows that begin with these two."""
    block, held = None, []
    for row in rows:
        if held and row[:2] != block:
            yield held
            held = []
        block = row[:2]
        held.append(row)
    if held:
        yield held


def _by_block(df: DataFrame) -> DataFrame:
    return df.repartition("_group", "_block").sortWithinPartitions("_group", "_block", F.col("_pos").asc_nulls_first())


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with the place in their ``_group`` by ``order`` in ``_pos`` and the group's size in ``_of``; both from a range exchange."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["_group", *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    dealt = settle(dealt.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()), "numbered")
    parts = dealt.groupBy("_group", "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("_group")
    before = F.sum("_rows").over(group.orderBy("_part")) - F.col("_rows")
    parts = parts.select("_group", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(group).alias("_of"))
    return dealt.join(parts, ["_group", "_part"]).withColumn("_pos", F.col("_id") + F.col("_shift")).drop("_id", "_part", "_shift")


def _roots(nodes: DataFrame) -> DataFrame:
    """The block roots of ``_group, _pos, _of, node``, as nodes of the next round."""
    schema = T.StructType.fromDDL("_group string, _pos bigint, _of bigint, node string")
    types = pa.schema([("_group", pa.string()), ("_pos", pa.int64()), ("_of", pa.int64()), ("node", pa.string())])

    def run(batches):
        out = []
        for held in _blocks(_rows(batches)):
            group, block, _, of, _ = held[0]
            tree = _Block(of <= BLOCK, LEVELS)
            for row in held:
                tree.append(row[4])
            out.append((group, block, -(-of // BLOCK), tree.root()))
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(types.names, r)) for r in out], types)
                out = []
        yield pa.RecordBatch.from_pylist([dict(zip(types.names, r)) for r in out], types)

    dealt = _by_block(nodes.select("_group", F.expr(f"_pos div {BLOCK}").alias("_block"), "_pos", "_of", "node"))
    return map_batches(dealt, run, schema)


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, their block roots, the roots of blocks of these, and so on until every group has one."""
    most = nodes.agg(F.max("_of")).first()[0] or 1
    levels = [nodes]
    while len(levels) == 1 or most > 1:
        levels.append(settle(_roots(levels[-1]), "block-roots"))
        most = -(-most // BLOCK)
    return levels


def _witnesses(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """``nodes`` with ``witness`` and ``top``, from ``tops``: the same of the roots of their blocks, by group and block."""
    names = ["_group", "_pos", "_of", "node", "_row"]
    extra = nodes.schema["_row"].dataType
    schema = T.StructType([nodes.schema[c] for c in names] + T.StructType.fromDDL(f"witness array<{_STEP}>").fields + [tops.schema["top"]])
    heads = tops.select(
        "_group", F.col("_pos").alias("_block"), F.lit(None).cast("bigint").alias("_pos"), F.lit(None).cast("bigint").alias("_of"),
        F.lit(None).cast("string").alias("node"), F.lit(None).cast(extra).alias("_row"), "witness", "top",
    )
    rows = nodes.select(
        "_group", F.expr(f"_pos div {BLOCK}").alias("_block"), "_pos", "_of", "node", "_row",
        F.lit(None).cast(f"array<{_STEP}>").alias("witness"), F.lit(None).cast(tops.schema["top"].dataType).alias("top"),
    )

    def run(batches):
        types = None

        def rows_of():
            nonlocal types
            for batch in batches:
                types = pa.schema([batch.schema.field(c) for c in (*names, "witness", "top")])
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for head, *held in _blocks(rows_of()):
            tree = _Block(held[0][3] <= BLOCK, LEVELS)
            trees = [tree.append(row[4]) for row in held]
            tree.root()
            rest, top = head[6], head[7]
            done = [t.steps(rest) for t in trees]
            for first in range(0, len(held), 500):  # a witness is some KB
                part = slice(first, first + 500)
                columns = [[r[i] for r in held[part]] for i in (0, 2, 3, 4, 5)] + [done[part], [top] * len(held[part])]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    return map_batches(_by_block(heads.unionByName(rows)), run, schema)


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Witnesses of the first level's nodes, from those of the last level's."""
    for level in reversed(levels[1:-1]):
        tops = _witnesses(level.withColumn("_row", F.lit(0)), tops)
    return _witnesses(levels[0], tops)


def manifest(docs: DataFrame, **more: Column) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root`` and ``witness`` (array of place in the run and the other digests) of every row.

    ``more`` are further columns by name, computed from ``docs``.
    """
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_group"),  # sorts as sources do, null first
        F.struct("doc_id", *[c.alias(n) for n, c in more.items()]).alias("_row"), F.col("doc_id").alias("_order"), leaf_of(*map(F.col, FIELDS)).alias("node"),
    )
    leaves = numbered(settle(leaves, "leaves"), ["_order", "node"]).drop("_order")
    levels = _climb(leaves)
    sources = levels[-1].select(F.lit("").alias("_group"), F.col("_group").alias("_order"), "node", F.col("_group").alias("_row"))
    above = _climb(numbered(sources, ["_order"]).drop("_order"))
    root = above[-1].select("_group", "_pos", F.expr(f"cast(array() as array<{_STEP}>)").alias("witness"), F.col("node").alias("top"))
    subroots = _descend(above, root)
    tops = subroots.select(
        F.col("_row").alias("_group"), F.lit(0).cast("bigint").alias("_pos"), "witness", F.struct(F.col("node").alias("subroot"), F.col("top").alias("root")).alias("top"),
    )
    out = _descend(levels, tops)
    return out.select("_row.doc_id", F.col("node").alias("leaf"), "top.subroot", "top.root", "witness", *[F.col("_row")[n].alias(n) for n in more])


def tampered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, the roots, a digest of its witness, and the root recomputed where every fifth is tampered with."""
    doc_id, source, lang, n_chars, text = (F.col(c) for c in FIELDS)
    hit = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    found = manifest(docs, changed=F.when(hit, leaf_of(doc_id, source, lang, n_chars, tampered(text))))
    found = found.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("witness")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(F.col("witness.others"), ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in FIELDS)
_CHANGED = " || ".join(_FIELD.format(c) for c in (*FIELDS[:4], f"translate(text, '{UPPER}', '{LOWER}')"))
#: CRC-32 of an ASCII text, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({0}) + 1),
    lambda i: list_transform(range(0, 8), lambda k: (ascii(substr({0}, i, 1)) >> k) & 1)))),
    lambda c, b: CASE WHEN xor(c, b::BIGINT) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"""
SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, sha256({_LEAF}) AS leaf, sha256({_CHANGED}) AS other, {CRC32.format("doc_id::VARCHAR")} AS crc FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER () AS id FROM leaves
), lower AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT source, lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM lower WHERE n > 1
  GROUP BY source, lvl, n, pos // 16
), subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lower WHERE n = 1
), upper AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY lvl, n, pos // 16
), lower_runs AS (
  SELECT source, lvl, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM lower WHERE n > 1 GROUP BY source, lvl, pos // 16
), upper_runs AS (
  SELECT lvl, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM upper WHERE n > 1 GROUP BY lvl, pos // 16
), first_fold AS (
  SELECT id, source, 0 AS lvl, pos, CASE WHEN crc % 5 = 0 THEN other ELSE leaf END AS h, '' AS proof FROM placed
  UNION ALL
  SELECT f.id, f.source, f.lvl + 1, f.pos // 16,
         sha256(array_to_string(hs[1 : f.pos % 16] || [f.h] || hs[f.pos % 16 + 2 : 16], '')),
         f.proof || array_to_string(hs[1 : f.pos % 16] || hs[f.pos % 16 + 2 : 16], '')
  FROM first_fold f JOIN lower_runs r ON r.source IS NOT DISTINCT FROM f.source AND r.lvl = f.lvl AND r.run = f.pos // 16
), halfway AS (
  SELECT id, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM first_fold GROUP BY id
), second_fold AS (
  SELECT p.id, s.subroot, 0 AS lvl, s.pos, w.h, w.proof
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source JOIN halfway w ON w.id = p.id
  UNION ALL
  SELECT f.id, f.subroot, f.lvl + 1, f.pos // 16, sha256(array_to_string(hs[1 : f.pos % 16] || [f.h] || hs[f.pos % 16 + 2 : 16], '')),
         f.proof || array_to_string(hs[1 : f.pos % 16] || hs[f.pos % 16 + 2 : 16], '')
  FROM second_fold f JOIN upper_runs r ON r.lvl = f.lvl AND r.run = f.pos // 16
), done AS (
  SELECT id, any_value(subroot) AS subroot, arg_max(h, lvl) AS folded_root, arg_max(proof, lvl) AS proof FROM second_fold GROUP BY id
)
SELECT doc_id, leaf, subroot, (SELECT h FROM upper WHERE n = 1) AS root, sha256(proof) AS proof_sha256, folded_root,
       folded_root = (SELECT h FROM upper WHERE n = 1) AS verified
FROM placed JOIN done USING (id)
"""
