"""Line dedup: lines found in many documents stay in one of them only.

Lines are exploded and keyed by their normalised text (ASCII blanks stripped at both ends, A-Z lower-cased); 128-bit hashes of the keys
are counted by distinct documents with map-side combining, so a line that every document has costs one row per task. Keys of at
least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines except in the largest doc_id that holds them.
The lines of those keys are found by an equi-join whose hot keys adaptive execution splits, gathered per document as positions, and
the remaining lines are put together again by position. Only this last step moves the texts, once.

Defined cases: a null or empty text is one empty line and becomes the empty text. A line that repeats inside one document counts that
document once; in the document that keeps it, all its lines stay. Rows that repeat a doc_id are one document for the count and are
each cleaned. A row without a doc_id counts as no document and keeps its lines. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimtrail.llm.columns import pack, unpack
from claimtrail.sources.scratch import settle

MIN_DOCS = 3
MIN_CHARS = 20
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ID, _TEXT, _POS = "_doc", "_text_hash", "_pos"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a long enough key: document, hash of its text, position, and two hashes of the key."""
    rows = docs.select(F.col("doc_id").alias(_ID), F.xxhash64("text").alias(_TEXT), F.posexplode(lines_of(F.col("text"))).alias(_POS, "_line"))
    rows = rows.where(F.col(_ID).isNotNull() & (F.length("_line") >= min_chars))
    rows = rows.withColumn("_key", line_key(F.col("_line"))).where(F.length("_key") >= min_chars)
    return rows.select(_ID, _TEXT, _POS, F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("second"), "_key").alias("_h2"))


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Positions of the lines to drop, one row per document that has any."""
    lines = hashed_lines(docs, min_chars)
    counted = lines.groupBy("_h1", "_h2").agg(F.countDistinct(_ID).alias("_docs"), F.max(_ID).alias("_keeper"))
    # written, so that the join below is an exchange on both sides, whose hot keys adaptive execution splits
    common = settle(counted.where(F.col("_docs") >= min_docs).drop("_docs"), "common-lines")
    dropped = lines.join(common, ["_h1", "_h2"]).where(F.col(_ID) != F.col("_keeper"))
    return dropped.groupBy(_ID, _TEXT).agg(F.collect_set(_POS).alias("_dropped"))


def split_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``_lines``, ``_dropped`` (positions or null) and the remaining text in ``_kept``."""
    dropped = repeated_lines(docs, min_docs, min_chars)
    same = (docs["doc_id"] == dropped[_ID]) & (F.xxhash64(docs["text"]) == dropped[_TEXT])
    out = docs.join(dropped, same, "left").drop(_ID, _TEXT)
    out = out.withColumn("_lines", lines_of(F.col("text")))
    kept = F.array_join(F.filter("_lines", lambda line, i: ~F.array_contains("_dropped", i)), "\n")
    return out.withColumn("_kept", F.when(F.col("_dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text`` and, where there is such a column, ``n_chars`` counted anew."""
    out = unpack(split_lines(pack(docs), min_docs, min_chars).withColumn("text", F.col("_kept")), docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def digest(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document, with a digest in place of the remaining text."""
    return split_lines(docs.select("doc_id", "text"), min_docs, min_chars).select(
        "doc_id",
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.when(F.col("_dropped").isNull(), 0).otherwise(F.size("_dropped")).cast("bigint").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, p, string_split(coalesce(text, ''), chr(10))[p] AS line
  FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS t(p)
), keyed AS (
  SELECT doc_id, p, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, p, line, coalesce(doc_id <> keeper, FALSE) AS gone FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
