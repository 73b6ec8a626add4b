"""Substring dedup with prefix-partitioned suffix trees over words.

A window is ``WINDOW`` consecutive words of a document; a word is removed if a window that covers it also starts in a document with
a smaller doc_id. Only suffixes that may repeat are ever compared:

1. *Anchors.* Each window names the least-hashed run of ``SEED_WORDS`` words inside it, so equal windows name equal seeds, and
   neighbouring windows mostly share one. Seeds are gathered by hash; a seed met in one document only rules out its windows.
2. *Suffixes.* Windows with other seeds are sent to the task of their seed, neighbours with one seed together, as the codes of their
   words. A unit of texts (``UNIT_BYTES``) first settles its own repeats, so a window leaves a unit for its smallest document only
   and a passage that every document has costs one record per unit. The windows of a seed that has over ``GROUP`` of them are sent one by
   one to the task of all their words, so a phrase that stands in many different surroundings is no group of its own.
3. *Subtrees.* A task cuts its suffixes into groups by prefix, lengthening the prefix word by word while a group exceeds ``GROUP``
   suffixes, sorts each group's suffixes and takes the longest common prefixes of neighbours: their intervals are the inner nodes of
   the group's suffix tree. A node of depth ``WINDOW`` is a repeat; all its suffixes but the smallest document's are hits.
4. Hits go back to their documents by an equi-join, and there to the text of their hash; overlapping hits make up maximal repeats.

A task takes its records bucket by bucket, and there are ``BUCKETS`` times as many buckets as tasks.

Words are compared by 48 bits of a hash each, 624 bits a window.

Defined cases: a null, empty or blank text has no words. A text shorter than a window loses nothing. doc_id names a document: rows that
repeat one and its text are cleaned alike, and rows of one doc_id don't count as repeats of each other, whatever their texts. A row without a doc_id keeps its words and takes none from
others. An empty table gives an empty result. Other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.columns import pack, unpack
from claimtrail.llm.text import BLANKS, U64, Words, chunks, gram_hashes, mix, text_bytes
from claimtrail.sources.scratch import settle

WINDOW = 13
SEED_WORDS = 5
GROUP = 50_000
UNIT_BYTES = 2 << 20
BUCKETS = 8
NAMELESS = -(1 << 63)  # key of rows without a doc_id
_CODE = U64(0xFFFFFFFFFFFF)
_CODE_BYTES = 6
_FOUND = ["bucket", "doc", "found", "data", "hash"]
_FOUND_DDL = "bucket int, doc bigint, found boolean, data binary, hash bigint"


class Runs:
    """Neighbouring windows of a unit with one seed: first word, number of windows, seed, and number of the text."""

    def __init__(self, words: Words, window: int):
        self.codes = words.hashes()
        count = max(0, len(self.codes) - window + 1)
        grams = gram_hashes(self.codes, SEED_WORDS)
        owner = np.repeat(np.arange(len(words.of) - 1), np.diff(words.of))
        least = grams[:count].copy()
        for j in range(1, window - SEED_WORDS + 1):
            np.minimum(least, grams[j : j + count], out=least)
        valid = np.flatnonzero(owner[:count] == owner[window - 1 : window - 1 + count])
        new = np.ones(len(valid), bool)
        new[1:] = (np.diff(valid) != 1) | (np.diff(least[valid]) != 0) | (np.diff(owner[valid]) != 0)
        self.first = valid[new]
        self.size = np.diff(np.append(np.flatnonzero(new), len(valid)))
        self.seed, self.text = least[self.first], owner[self.first]
        self.pos = self.first - words.of[self.text]

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("first", "size", "seed", "text", "pos"):
            setattr(self, name, getattr(self, name)[chosen])


def _expand(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these sizes: the run of each element, and its number inside the run."""
    run = np.repeat(np.arange(len(size)), size)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)


def deep_nodes(codes: np.ndarray, starts: np.ndarray, docs: np.ndarray, window: int = WINDOW, group: int = GROUP) -> np.ndarray:
    """Which suffixes ``codes[start:]`` share their first ``window`` words with a suffix of a smaller document."""
    hit = np.zeros(len(starts), bool)
    todo = [(np.arange(len(starts)), 0)]
    while todo:
        members, depth = todo.pop()
        if depth == window:  # one node, however many suffixes
            hit[members] = docs[members] > docs[members].min()
        elif len(members) <= 2 * group:
            _subtree(codes, starts, docs, window, members, hit)
        else:
            word = codes[starts[members] + depth]
            order = np.argsort(word, kind="stable")
            first = np.flatnonzero(np.diff(word[order], prepend=~word[order[:1]]))
            size = np.diff(np.append(first, len(order)))
            large = size > group
            for a, n in zip(first[large], size[large]):  # a longer prefix parts them
                todo.append((members[order[a : a + n]], depth + 1))
            rest = members[order[np.repeat(~large, size)]]
            before = np.cumsum(size[~large]) - size[~large]
            pack = before // group
            cuts = before[np.flatnonzero(np.diff(pack, prepend=-1))]
            todo.extend((part, depth) for part in np.split(rest, cuts[1:]) if len(part))
    return hit


def _subtree(codes, starts, docs, window, members, hit) -> None:
    words = codes[starts[members][:, None] + np.arange(window)]
    order = np.lexsort((docs[members], *words.T[::-1]))
    words, members = words[order], members[order]
    differ = words[1:] != words[:-1]
    common = np.where(differ.any(1), differ.argmax(1), window)  # longest common prefixes
    node = np.concatenate([[0], np.cumsum(common < window)])
    smallest = docs[members[np.flatnonzero(np.diff(node, prepend=-1))]]  # documents are in order within a node
    hit[members] = docs[members] > smallest[node]


def _found(docs: np.ndarray, values: np.ndarray, buckets: int = 1, hashes: np.ndarray | None = None) -> pa.RecordBatch:
    """Found rows: one for each run of equal documents (and hashes), with the run's values, spread over the buckets by document."""
    hashes = np.zeros(len(docs), np.int64) if hashes is None else hashes
    first = np.flatnonzero((np.diff(docs, prepend=~docs[:1]) != 0) | (np.diff(hashes, prepend=~hashes[:1]) != 0))
    ends = (np.append(first, len(docs)) * values.itemsize).astype(np.int32)
    data = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())])
    doc = docs[first]
    return pa.RecordBatch.from_arrays([pa.array((doc % buckets).astype(np.int32)), pa.array(doc), pa.array(np.ones(len(doc), bool)), data, pa.array(hashes[first])], _FOUND)


def _in_order(docs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, docs))
    return docs[order], values[order]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.binary())
    columns = zip(*rows) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([*(pa.array(list(c), k) for c, k in zip(columns, kinds)), pa.array([0] * len(rows), pa.int64())], _FOUND)


def _by_bucket(batches, take) -> Iterator[pa.RecordBatch]:
    """Found rows as they are; and what ``take`` makes of the records (doc, data) of each bucket, one bucket at a time."""
    current, records = None, []
    for batch in batches:
        found = batch.column("found").to_numpy(zero_copy_only=False)
        yield batch.filter(batch.column("found"))
        rest = batch.filter(pa.array(~found))
        for bucket, doc, data in zip(rest.column("bucket").to_pylist(), rest.column("doc").to_pylist(), rest.column("data").to_pylist()):
            if bucket != current:
                if records:
                    yield from take(records)
                current, records = bucket, []
            records.append((doc, data))
    if records:
        yield from take(records)


def _units(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, Runs]]:
    data, offsets = text_bytes(batch.column("text"))
    for first, last in chunks(offsets, UNIT_BYTES):
        yield first, last, Runs(Words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], BLANKS), window)


def _bucket(seed: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of seeds, mixed anew: least hashes are small numbers."""
    return ((mix(seed) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _seed_rows(buckets: int, window: int):
    """Per unit: its seeds with a document and number of windows each, by bucket; and (found) those that two of its documents have, by document."""

    def rows(batches):
        for batch in batches:
            batch = batch.filter(pc.not_equal(batch.column("_key"), NAMELESS))
            ids = batch.column("_key").to_numpy()
            for first, last, runs in _units(batch, window):
                doc = ids[first:last][runs.text]
                order = np.lexsort((doc, runs.seed))
                seed, doc = runs.seed[order], doc[order]
                first_of = np.flatnonzero(np.diff(seed, prepend=~seed[:1]))
                count = np.add.reduceat(runs.size[order], first_of).astype(np.int32) if len(seed) else np.zeros(0, np.int32)
                fresh = np.ones(len(seed), bool)
                fresh[1:] = (np.diff(seed) != 0) | (np.diff(doc) != 0)
                seed, doc = seed[fresh], doc[fresh]
                head = np.flatnonzero(np.diff(seed, prepend=~seed[:1]))
                several = np.diff(np.append(head, len(seed))) > 1
                shared = np.repeat(several, np.diff(np.append(head, len(seed))))
                yield _found(*_in_order(doc[shared], seed[shared]), buckets)
                out = []
                bucket = _bucket(seed[head], buckets)
                order = np.argsort(bucket, kind="stable")
                one, who, several, count = seed[head][order], doc[head][order], several[order], count[order]
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(cut)):
                    part = slice(cut[b], cut[b + 1])
                    out.append((b, None, False, one[part].tobytes() + who[part].tobytes() + several[part].tobytes() + count[part].tobytes()))
                yield _batch(out)

    return rows


def _repeated_seeds(group: int):
    """Found rows (doc, seeds) of the seeds that several documents have; and a record of those that have over ``group`` windows."""

    def repeated(records):
        seeds, docs, several, counts = [], [], [], []
        for _, data in records:
            n = len(data) // 21
            seeds.append(np.frombuffer(data, U64, n))
            docs.append(np.frombuffer(data, np.int64, n, 8 * n))
            several.append(np.frombuffer(data, bool, n, 16 * n))
            counts.append(np.frombuffer(data, np.int32, n, 17 * n))
        seed, doc, many, count = (np.concatenate(c) for c in (seeds, docs, several, counts))
        order = np.argsort(seed, kind="stable")
        seed, doc, many, count = seed[order], doc[order], many[order], count[order]
        head = np.flatnonzero(np.diff(seed, prepend=~seed[:1]))
        size = np.diff(np.append(head, len(seed)))
        repeated = (np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head)) | np.logical_or.reduceat(many, head)
        reply = np.repeat(repeated, size) & ~many
        yield _found(*_in_order(doc[reply], seed[reply]))
        hot = repeated & (np.add.reduceat(count, head, dtype=np.int64) > group)
        if hot.any():
            yield _batch([(0, None, False, seed[head[hot]].tobytes())])

    return lambda batches: _by_bucket(batches, repeated)


def _suffix_rows(buckets: int, window: int, group: int, hot: np.ndarray):
    """Per unit: records of windows for its smallest documents, by bucket of their seed (of their words, if it is hot); and (found) its own hits by document and text."""

    def rows(batches):
        for batch in batches:
            ids, hashes = batch.column("_key").to_numpy(), batch.column("_hash").to_numpy()
            seeds = batch.column("seeds")
            for first, last, runs in _units(batch, window):
                asked = np.frombuffer(b"".join(d for part in seeds[first:last].to_pylist() for d in part or ()), U64)
                runs.keep(np.isin(runs.seed, asked))
                run, step = _expand(runs.size)
                doc, start, pos = ids[first:last][runs.text][run], runs.first[run] + step, runs.pos[run] + step
                text = hashes[first:last][runs.text][run]
                codes = runs.codes & _CODE
                hit = deep_nodes(codes, start, doc, window, group)
                yield _hits(doc[hit], text[hit], pos[hit], buckets)
                out = []
                left = np.flatnonzero(~hit)
                if len(left):
                    new = np.ones(len(left), bool)
                    heat = np.isin(runs.seed, hot)[run[left]]
                    new[1:] = (np.diff(left) != 1) | (np.diff(run[left]) != 0) | heat[1:]
                    head, heat = left[new], heat[new]
                    size = np.diff(np.append(np.flatnonzero(new), len(left)))
                    key = runs.seed[run[head]]
                    if heat.any():
                        key[heat] = gram_hashes(codes, window)[start[head[heat]]]
                    bucket = _bucket(key, buckets)
                    order = np.argsort(bucket, kind="stable")
                    head, size, bucket = head[order], size[order], bucket[order]
                    cut = np.searchsorted(bucket, np.arange(buckets + 1))
                    for b in np.flatnonzero(np.diff(cut)):
                        h, n = head[cut[b] : cut[b + 1]], size[cut[b] : cut[b + 1]]
                        record, word = _expand(n + window - 1)
                        words = np.ascontiguousarray(codes[start[h][record] + word]).view(np.uint8).reshape(-1, 8)[:, :_CODE_BYTES]
                        out.append((b, len(h), False, doc[h].tobytes() + text[h].tobytes() + pos[h].astype(np.int32).tobytes() + n.astype(np.int32).tobytes() + words.tobytes()))
                yield _batch(out)

    return rows


def _hits(doc: np.ndarray, text: np.ndarray, pos: np.ndarray, buckets: int = 1) -> pa.RecordBatch:
    order = np.lexsort((pos, text, doc))
    return _found(doc[order], pos[order].astype(np.int32), buckets, text[order])


def _suffix_hits(window: int, group: int):
    """Rows (doc, first words of hit windows) from the records of some seeds."""

    def hits(records):
        docs, texts, poss, sizes, codes = [], [], [], [], []
        for n, data in records:
            docs.append(np.frombuffer(data, np.int64, n))
            texts.append(np.frombuffer(data, np.int64, n, 8 * n))
            poss.append(np.frombuffer(data, np.int32, n, 16 * n))
            sizes.append(np.frombuffer(data, np.int32, n, 20 * n))
            codes.append(np.frombuffer(data, np.uint8, -1, 24 * n))
        doc, text, pos, size, raw = (np.concatenate(c) for c in (docs, texts, poss, sizes, codes))
        words = np.zeros((len(raw) // _CODE_BYTES, 8), np.uint8)
        words[:, :_CODE_BYTES] = raw.reshape(-1, _CODE_BYTES)
        words = words.view("<u8")[:, 0]
        length = size + window - 1
        begin = np.cumsum(length) - length
        run, step = _expand(size)
        doc, text, start, pos = doc[run], text[run], begin[run] + step, pos[run] + step
        hit = deep_nodes(words, start, doc, window, group)
        yield _hits(doc[hit], text[hit], pos[hit])

    return lambda batches: _by_bucket(batches, hits)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the document's number in ``_key``, which is never null, so that all joins by it share one exchange of the texts; and the text's ``_hash``."""
    return docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NAMELESS))).withColumn("_hash", F.xxhash64("text"))


def repeats(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``doc, starts``: for each keyed document with hits, its texts' hashes with 32-bit numbers of the words at which hit windows start."""
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda rows: rows.repartition("bucket").sortWithinPartitions("bucket")
    seeds = map_batches(docs.select("_key", "text"), _seed_rows(buckets, window), _FOUND_DDL)
    seeds = settle(map_batches(dealt(seeds), _repeated_seeds(group), _FOUND_DDL), "seeds")
    hot = np.frombuffer(b"".join(r.data for r in seeds.where("not found").select("data").collect()), U64)
    asked = seeds.where("found").groupBy("doc").agg(F.collect_list("data").alias("seeds"))
    records = map_batches(docs.join(asked, F.col("_key") == F.col("doc")), _suffix_rows(buckets, window, group, hot), _FOUND_DDL)
    hits = map_batches(dealt(records), _suffix_hits(window, group), _FOUND_DDL)
    return hits.groupBy("doc").agg(F.collect_list(F.struct("hash", "data")).alias("starts"))


def _kept(text: str | None, starts: list[bytes] | None, window: int) -> tuple[int, int, bytes]:
    """Words, removed words, and the remaining words with a space between."""
    words = (text or "").encode().split()
    if not starts:
        return len(words), 0, b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    at = np.unique(np.frombuffer(b"".join(starts), np.int32))
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    keep = np.cumsum(change)[:-1] == 0
    return len(words), int(len(words) - keep.sum()), b" ".join(compress(words, keep.tolist()))


def _own(starts: list[dict] | None, text_hash: int) -> list[bytes]:
    """The starts that belong to the text of this hash."""
    return [s["data"] for s in starts or () if s["hash"] == text_hash]


def _joined(docs: DataFrame, window: int, group: int) -> DataFrame:
    docs = keyed(docs)
    found = repeats(docs, window, group)
    return docs.join(found, docs["_key"] == found["doc"], "left").drop("doc", "_key")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``docs`` with the repeated words gone from ``text``, and one space between the others."""
    packed = pack(docs)
    names = packed.columns

    def rows(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("text", "starts", "_hash"))
            text = [_kept(t, _own(s, h), window)[2].decode() for t, s, h in zip(*columns)]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()) if c == "text" else batch.column(c) for c in names], names)

    return unpack(map_batches(_joined(packed, window, group), rows, packed.schema), docs.columns)


def digest(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    def rows(batches):
        for batch in batches:
            n, removed, sha = [], [], []
            for text, starts, own in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "_hash"))):
                words, gone, kept = _kept(text, _own(starts, own), window)
                n.append(words)
                removed.append(gone)
                sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(_joined(docs, window, group), rows, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string")


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(words[p : p + 12], ' ') AS key FROM w, unnest(range(1, len(words) - 11)) AS t(p)
), hit AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY key) AS least FROM win) WHERE doc_id > least
), gone AS (
  SELECT DISTINCT doc_id, q FROM hit, unnest(range(p, p + 13)) AS t(q)
), cut AS (
  SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(qs), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN qs IS NULL THEN words ELSE
         (SELECT coalesce(list(words[t.q] ORDER BY t.q), CAST([] AS VARCHAR[])) FROM unnest(range(1, len(words) + 1)) AS t(q) WHERE NOT list_contains(qs, t.q)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)
"""
