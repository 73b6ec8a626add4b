"""Benchmark decontamination with suffix arrays over the training texts.

Every task builds suffix arrays over the shards (groups of whole texts) it reads and looks every test suffix up in them by binary
search, so no text leaves its task. A test suffix is met only by training suffixes that begin with its first words: a shard's
array holds the suffixes whose first ``ANCHOR`` words (fewer if a window is shorter) begin some test suffix; no other suffix can
match. The benchmark is the query set; it is broadcast in blocks of at most ``block_bytes`` of text, one pass each, so the size of a
broadcast is bounded whatever the benchmark's.

Words are maximal runs of digits, letters and non-ASCII characters, with A-Z lower-cased. A window is ``window`` consecutive words of
an item; an item of fewer words is one window; an item without words has none. Equal words are recognised by 64-bit hashes of
their bytes; a window matches if all its words do.

Defined cases: a null or empty text has no words and no hits. A null item id counts as the empty string. Repeated rows are judged
one by one; a repeated item counts once. An empty benchmark hits nothing. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.columns import pack, unpack
from claimtrail.llm.text import NOT_ALNUM, U64, Words, chunks, each_chunk, gram_hashes, lower_ascii, text_bytes, union_length
from claimtrail.sources.scratch import settle

WINDOW = 13
ANCHOR = 4
BLOCK_BYTES = 8 << 20
SHARE = 20  # contaminated: 20 * hit words >= words
_RUN = np.dtype([("item", "<i4"), ("item_pos", "<i4"), ("doc_pos", "<i8"), ("length", "<i8")])
MATCHES = "_matches array<struct<item_id:string,item_pos:int,doc_pos:bigint,length:bigint>>"


class TestSet:
    """The test suffixes of a block of items, as word codes."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        data, offsets = text_bytes(pa.array([text for _, text in items], pa.string()))
        words = Words(lower_ascii(data), offsets, NOT_ALNUM)
        hashes = words.hashes()
        size = np.diff(words.of)
        count = np.where(size > 0, np.maximum(size - window + 1, 1), 0)
        self.item = np.repeat(np.arange(len(items)), count)
        self.pos = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.length = np.minimum(size, window)[self.item]
        self.vocabulary, codes = np.unique(hashes, return_inverse=True)
        codes = np.concatenate([codes.astype(np.int32) + 1, np.zeros(window, np.int32)])
        at = words.of[:-1][self.item] + self.pos
        self.words = codes[at[:, None] + np.arange(window)]
        self.words[np.arange(window) >= self.length[:, None]] = 0
        self.anchor = int(min(ANCHOR, self.length.min())) if len(self.item) else 1
        grams = np.concatenate([gram_hashes(hashes[a:b], self.anchor) for a, b in zip(words.of[:-1], words.of[1:])] or [np.zeros(0, U64)])
        self.bits = max(16, int(64 * max(1, len(grams))).bit_length())
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[grams >> U64(64 - self.bits)] = True

    def code(self, hashes: np.ndarray) -> np.ndarray:
        """Word codes, 0 for a word that no item has."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)


class SuffixArray:
    """Suffixes of a shard's texts in the order of their first ``window`` words."""

    def __init__(self, words: Words, tests: TestSet, window: int):
        self.tests, hashes = tests, words.hashes()
        grams = gram_hashes(hashes, tests.anchor)
        at = np.flatnonzero(tests.seen[grams >> U64(64 - tests.bits)])
        self.text = np.searchsorted(words.of, at, "right") - 1
        stop = words.of[self.text + 1]
        reach = at[:, None] + np.arange(window)
        codes = tests.code(np.concatenate([hashes, np.zeros(window, U64)])[reach])
        codes[reach >= stop[:, None]] = 0
        order = np.lexsort(codes.T[::-1])
        self.at, self.text, self.words = at[order], self.text[order], codes[order]

    def _bound(self, right: bool) -> np.ndarray:
        """For each test suffix, the first place whose words are not less (or, right, are greater) over the suffix's length."""
        tests = self.tests
        low, high = np.zeros(len(tests.item), np.int64), np.full(len(tests.item), len(self.at), np.int64)
        valid = np.arange(tests.words.shape[1]) < tests.length[:, None]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            differ = (self.words[middle] != tests.words[open_]) & valid[open_]
            first = differ.argmax(1)
            rows = np.arange(len(open_))
            same = ~differ[rows, first]
            less = self.words[middle, first] < tests.words[open_, first]
            up = np.where(same, right, less)
            low[open_] = np.where(up, middle + 1, low[open_])
            high[open_] = np.where(up, high[open_], middle)
        return low

    def matches(self) -> tuple[np.ndarray, np.ndarray]:
        """Each place of each window: numbers of test suffix and of array entry."""
        low = self._bound(False)
        count = self._bound(True) - low
        test = np.repeat(np.arange(len(count)), count)
        entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return test, entry


def longest_runs(tests: TestSet, shard: SuffixArray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Longest verbatim matches, as (text, runs): occurrences that follow each other in item and text are one."""
    test, entry = shard.matches()
    text, item, item_pos = shard.text[entry], tests.item[test], tests.pos[test]
    doc_pos = shard.at[entry] - words.of[text]
    order = np.lexsort((item_pos, doc_pos - item_pos, item, text))
    text, item, item_pos, doc_pos, length = text[order], item[order], item_pos[order], doc_pos[order], tests.length[test][order]
    if not len(text):
        return text, np.zeros(0, _RUN)
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(doc_pos - item_pos) != 0) | (np.diff(item_pos) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(text)) - 1
    runs = np.zeros(len(first), _RUN)
    runs["item"], runs["item_pos"], runs["doc_pos"] = item[first], item_pos[first], doc_pos[first]
    runs["length"] = doc_pos[last] + length[last] - doc_pos[first]
    return text[first], runs


def _search(tests: TestSet, column: pa.Array, window: int) -> pa.Array:
    owner, found = [], []
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        words = Words(lower_ascii(data[offsets[first] : offsets[last]]), offsets[first : last + 1] - offsets[first], NOT_ALNUM)
        text, runs = longest_runs(tests, SuffixArray(words, tests, window), words)
        owner.append(text + first)
        found.append(runs)
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    runs = np.concatenate(found) if found else np.zeros(0, _RUN)
    fields = [pa.array([tests.names[i] for i in runs["item"]], pa.string()), *(pa.array(runs[c]) for c in ("item_pos", "doc_pos", "length"))]
    struct = pa.StructArray.from_arrays(fields, ["item_id", "item_pos", "doc_pos", "length"])
    return pa.ListArray.from_arrays(np.searchsorted(owner, np.arange(len(column) + 1)).astype(np.int32), struct)


def test_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about ``block_bytes``, one on the driver at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-int(size) // block_bytes)
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield sorted({(r["item_id"], r["text"]) for r in part.toLocalIterator()})


test_blocks.__test__ = False


def find_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, then=None, then_schema=None
) -> DataFrame:
    """``docs`` with ``_matches``: the longest verbatim matches of ``window`` words or more (or of a whole shorter item), with places.

    Rows are written between the passes of several blocks, so a task holds one block. ``then`` is a function of the batches with
    all matches, applied within the last pass, and ``then_schema`` what it makes.
    """
    spark, names = docs.sparkSession, docs.columns
    out = docs.withColumn("_matches", F.lit(None).cast(MATCHES.split(" ", 1)[1]))
    schema = StructType([*docs.schema.fields, *out.select("_matches").schema.fields])
    blocks = test_blocks(benchmark, block_bytes)
    items, following = next(blocks, []), next(blocks, None)
    while items is not None:
        shared = spark.sparkContext.broadcast(TestSet(items, window))

        def search(batches, shared=shared):
            tests = shared.value
            for batch in batches:
                found = _search(tests, batch.column("text"), window) if len(tests.item) else None
                old = batch.column("_matches")
                if found is None:
                    yield batch
                    continue
                if old.null_count < len(old):  # an earlier block's matches stay in front
                    pairs = zip(old.to_pylist(), found.to_pylist(), strict=True)
                    found = pa.array([(a or []) + b for a, b in pairs], found.type)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), found], [*names, "_matches"])

        last = following is None
        work = (lambda batches, search=search: then(search(batches))) if last and then else search
        out = map_batches(out, work, then_schema if last and then else schema)
        if not last:
            out = settle(out, "matches")
        items, following = following, next(blocks, None)
    return out


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_hit``, ``_items`` (sorted ids of the items met) and ``_contaminated``."""
    names = docs.columns
    extra = "_n_words bigint, _n_hit bigint, _items array<string>"
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(extra).fields])

    def count(batches):
        for batch in batches:
            n_words = np.zeros(len(batch), np.int64)
            for first, last, words in each_chunk(batch.column("text"), NOT_ALNUM, lower=True):
                n_words[first:last] = np.diff(words.of)
            n_hit, items = np.zeros(len(batch), np.int64), [[]] * len(batch)
            column = batch.column("_matches")
            if column.null_count < len(column):
                lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(lengths):
                    runs = column[int(i)].as_py()
                    start = np.array([r["doc_pos"] for r in runs])
                    n_hit[i] = union_length(start, start + np.array([r["length"] for r in runs]))
                    items[i] = sorted({r["item_id"] for r in runs})
            columns = [*(batch.column(c) for c in names), pa.array(n_words), pa.array(n_hit), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "_n_words", "_n_hit", "_items"])

    out = find_matches(docs, benchmark, window, block_bytes, count, schema)
    return out.withColumn("_contaminated", (F.col("_n_hit") > 0) & (share * F.col("_n_hit") >= F.col("_n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    return unpack(judged(pack(docs), benchmark, **options).where(~F.col("_contaminated")), docs.columns)


def digest(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document, with digests in place of the items."""
    out = judged(docs.select("doc_id", "text"), benchmark, **options)
    return out.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        F.col("_contaminated").alias("contaminated"),
    )


SQL = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS key
  FROM item_words, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(p) WHERE len(w) > 0
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), doc_win AS (
  SELECT doc_id, p, size, array_to_string(w[p : p + size - 1], ' ') AS key
  FROM doc_words, (SELECT DISTINCT size FROM win) AS sizes, unnest(range(1, len(w) - size + 2)) AS t(p)
), hits AS (
  SELECT doc_id, p, size, item FROM doc_win JOIN win USING (size, key)
), hit_words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + size)) AS t(q) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
