"""Sharding by extendible hashing.

A document's place is a 60-bit hash of its id and text; a shard is a prefix of its bits. The directory starts with one bucket, and only a
bucket over the byte limit is split on one more bit, until each fits. The splits are found on cells, sums of bytes by a prefix that is
a few bits longer than the shards are expected to be, so the directory costs a few rows per shard and no pass over the documents per
bit; only the documents of cells that are still too large take part in a next round with more bits. The directory grows with the documents,
so it is never broadcast: its joins are merged on the hash bits, which are even.

Defined cases: a null text has no bytes. A document over the limit gets a shard of its own. Copies of a row (same id and text) share
all bits; if they exceed the limit together, they are dealt in pages that fit (``bits.page``). An empty table has no shards. Other
columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimtrail.llm.columns import named
from claimtrail.sources.scratch import settle

SHARD_BYTES = 256 << 20
QUERY_BYTES = 1 << 20  # of the registered query, so that small tables have many shards
BITS = 60
BLOCK = 10_000  # copies that are numbered together
EXTRA_BITS = 4  # of a cell, beyond those that an average shard needs


def place(doc_id: Column, text: Column) -> Column:
    """60 bits of the md5 of the id and the text's md5."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def prefix(place: str, bits: int) -> Column:
    return F.shiftright(place, BITS - bits)


def sizes_of(docs: DataFrame) -> DataFrame:
    """``doc_id, place, n_bytes, copies``: copies of a row are one."""
    rows = docs.select("doc_id", place(F.col("doc_id"), F.col("text")).alias("place"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    return rows.groupBy("doc_id", "place", "n_bytes").agg(F.count("*").alias("copies"))


def directory(sizes: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, place, n_bytes, copies, shard, depth, shard_bytes, pages_of`` of settled sizes.

    ``pages_of`` is the number of copies per page where a bucket of equal places is over the limit, else null.
    """
    total = sizes.agg(F.sum(F.col("n_bytes") * F.col("copies"))).first()[0] or 0
    step = max(1, (int(total) // limit).bit_length() + EXTRA_BITS)
    done, open_, low = None, sizes, 0
    while True:
        high = min(BITS, low + step)
        cells = open_.groupBy(prefix("place", high).alias("cell")).agg(F.sum(F.col("n_bytes") * F.col("copies")).alias("bytes"))
        cells = settle(cells, "cells")
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
        levels = levels.withColumn("bucket", F.expr(f"shiftright(cell, {high} - depth)"))
        fits = levels.groupBy("depth", "bucket").agg(F.sum("bytes").alias("shard_bytes")).where(F.col("shard_bytes") <= limit)
        fits = settle(fits, "fits")
        least = F.lit(fits.agg(F.min("depth")).first()[0]).cast("int")  # the few buckets above hold all cells, and none of them fits
        found = levels.drop("bytes").where(F.col("depth") >= least).join(fits.hint("merge"), ["depth", "bucket"])
        found = found.groupBy("cell").agg(F.min(F.struct("depth", "bucket", "shard_bytes")).alias("s")).select("cell", "s.*")
        found = settle(found, "directory")
        rows = open_.withColumn("cell", prefix("place", high))
        here = rows.join(found.hint("merge"), "cell").withColumn("pages_of", F.lit(None).cast("bigint")).drop("cell")
        done = here if done is None else done.unionByName(here)
        if cells.join(found.hint("merge"), "cell", "left_anti").limit(1).count() == 0:
            break
        open_, low = settle(rows.join(found.select("cell").hint("merge"), "cell", "left_anti").drop("cell"), "large"), high
        if low == BITS:
            groups = open_.groupBy(F.col("place").alias("bucket")).agg(F.sum(F.col("n_bytes") * F.col("copies")).alias("shard_bytes"))
            rest = open_.withColumn("bucket", F.col("place")).join(groups.hint("merge"), "bucket").withColumn("depth", F.lit(BITS))
            done = done.unionByName(rest.withColumn("pages_of", F.greatest(F.lit(1), F.floor(limit / F.col("n_bytes"))).cast("bigint")))
            break
    name = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.conv(F.col("bucket").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
    return done.withColumn("shard", name).drop("bucket")


def assign(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, n_bytes, shard, depth, shard_bytes`` for every row of ``docs``."""
    found = directory(settle(sizes_of(docs), "sizes"), limit)
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    page = F.floor(F.col("copy") / F.col("pages_of"))
    pages = F.col("pages_of").isNotNull()
    in_page = F.least(F.col("pages_of"), F.col("copies") - page * F.col("pages_of")) * F.col("n_bytes")
    return rows.select(
        "doc_id", "n_bytes",
        F.when(pages, F.concat("shard", F.lit("."), page.cast("string"))).otherwise(F.col("shard")).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        F.when(pages, in_page).otherwise(F.col("shard_bytes")).alias("shard_bytes"),
    )


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write the documents with a folder per shard, each row once; copies over the limit are dealt to a folder per page."""
    found = directory(settle(sizes_of(docs), "sizes"), limit)
    found = found.select(F.col("doc_id").alias("_id"), F.col("place").alias("_place"), F.col("n_bytes").alias("_bytes"), "shard", "pages_of")
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("_doc"))
    size = F.coalesce(F.octet_length("_doc.text"), F.lit(0)).cast("bigint")
    here = (place(F.col("_doc.doc_id"), F.col("_doc.text")) == F.col("_place")) & F.col("_doc.doc_id").eqNullSafe(F.col("_id")) & (size == F.col("_bytes"))
    rows = rows.join(found.hint("merge"), here)
    out = rows.where("pages_of is null").select("_doc", "shard")
    if found.where("pages_of is not null").limit(1).count():
        # copies are numbered by blocks of their rows, so that no task holds all copies of a row
        copies = rows.where("pages_of is not null").withColumn("_block", F.floor(F.monotonically_increasing_id() / BLOCK))
        copies = settle(copies, "copies")
        keys = ["_id", "_place", "_bytes"]
        before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = copies.groupBy(*keys, "_block").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        blocks = blocks.select(*[F.col(c).alias(c + "_b") for c in (*keys, "_block")], "_before")
        number = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(F.lit(0))) - 1
        copies = copies.withColumn("_number", number)
        copies = copies.join(blocks.hint("merge"), F.expr(" and ".join(f"{c} <=> {c}_b" for c in (*keys, "_block"))))
        page = F.floor((F.col("_before") + F.col("_number")) / F.col("pages_of")).cast("string")
        out = out.unionByName(copies.select("_doc", F.concat("shard", F.lit("."), page).alias("shard")))
    columns = [F.col("_doc").getField(c).alias(c) for c in docs.columns]
    out.select(*columns, F.concat(F.lit("b"), "shard").alias("shard")).repartition("shard").write.partitionBy("shard").parquet(path)


SQL = f"""
WITH sizes AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS place
  FROM documents
), levels AS (
  SELECT doc_id, n_bytes, place, d, place >> ({BITS} - d) AS bucket,
         sum(n_bytes) OVER (PARTITION BY d, place >> ({BITS} - d)) AS shard_bytes
  FROM sizes, range(0, {BITS} + 1) AS t(d)
), fit AS (
  SELECT * FROM levels WHERE shard_bytes <= {QUERY_BYTES}
  QUALIFY row_number() OVER (PARTITION BY doc_id, place ORDER BY d) = 1
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
       CASE WHEN d = 0 THEN '' ELSE right(lpad(bin(bucket), 64, '0'), CAST(d AS INTEGER)) END AS shard,
       CAST(d AS INTEGER) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes
FROM fit
"""
