"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A document's terms are its byte trigrams, hashed into ``TRIGRAMS`` columns, and a few style terms (how many words repeat a word just
before, lie in repeated windows of three, are in capitals, hold symbols or digits). Term weights (log counts times inverse document
frequency) and the latent space (truncated singular value decomposition by power iteration) are fitted on a bounded sample of the
labelled documents: ``PER_LABEL`` of each label at most, those of the smallest hash of the id. The sample's latent vectors, at most
2 * PER_LABEL of ``RANK`` numbers, are broadcast; every document's cosines to all of them are computed exactly, a block of documents at a
time, and the ``NEIGHBOURS`` nearest vote for their label, weighted by a power of their similarity. As the sample holds both labels
alike, one half is the border between them.

Only rows whose crc32 of the id's text, modulo ``FOLDS``, is not ``HELD_OUT`` teach. Label, language, source and id are no input of a score.

Defined cases: a text without trigrams and words (null and empty texts too) is near to nothing and scores the share of label 1
among the labelled rows that teach. Without labels of both kinds every document scores that share (0.5 without any label).
A document labelled more than once counts with its lowest label. Repeated rows score alike. Other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.columns import pack, unpack
from claimtrail.llm.quality_gbt import _per_text, _repeat_words, one_per_document
from claimtrail.llm.text import BLANKS, byte_set, each_chunk

TRIGRAMS, RANK, ROUNDS = 4096, 64, 4
PER_LABEL = 2000
NEIGHBOURS, POWER = 15, 8
FOLDS, HELD_OUT = 3, 1
TEXTS = 256  # of a block
STYLE = 1.0
_LAGS = 8
_UPPER, _LETTER, _DIGIT = byte_set((65, 90)), byte_set((97, 122), (128, 255)), byte_set((48, 57))
_SYMBOL = ~(_UPPER | _LETTER | _DIGIT | BLANKS) & ~np.isin(np.arange(256), list(b".,;:'\"()-!?"))
_MARK = np.isin(np.arange(256), list(b"!?"))
N_STYLE = 7


def _style(words, part: np.ndarray) -> np.ndarray:
    """Shares of the words of each text that show a trait, under a square root."""
    count = np.diff(words.of)
    owner, hashes = np.repeat(np.arange(len(count)), count), words.hashes()
    echo = [np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)]
    for lag in range(1, _LAGS + 1):
        same = (hashes[lag:] == hashes[:-lag]) & (owner[lag:] == owner[:-lag])
        echo[1][lag:] |= same
        if lag == 1:
            echo[0][lag:] |= same
    has = []
    for table in (_UPPER, _LETTER, _DIGIT, _SYMBOL, _MARK):
        total = np.concatenate([[0], np.cumsum(table[part], dtype=np.int64)])
        has.append(total[words.ends] > total[words.starts])
    upper, letter, digit, symbol, mark = has
    flags = [*echo, upper & ~letter, digit, symbol, mark]
    columns = [_per_text(f, words.of) for f in flags] + [_repeat_words(hashes, words.of, owner)]
    return np.sqrt(np.stack(columns, 1) / np.maximum(count, 1)[:, None]).astype(np.float32)


def terms(column: pa.Array):
    """For each block of texts: its range, trigram counts (texts x TRIGRAMS) and style shares."""
    for first, last, words in each_chunk(column, BLANKS, texts=TEXTS):
        data, n = words.data, last - first
        text = np.repeat(np.arange(n), np.diff(words.offsets))
        counts = np.zeros(n * TRIGRAMS, np.int64)
        if len(data) > 2:
            b = data.astype(np.uint32)
            h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(20)
            inside = text[2:] == text[:-2]
            counts = np.bincount((text[:-2] * TRIGRAMS + h)[inside], minlength=n * TRIGRAMS)
        yield first, last, counts.reshape(n, TRIGRAMS), _style(words, data)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


class Space:
    """Term weights, latent space, and the labelled vectors in it."""

    def __init__(self, counts: np.ndarray, style: np.ndarray, labels: np.ndarray, prior: float):
        self.prior, self.labels = prior, labels.astype(np.float32)
        self.weight = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + np.float32(1)
        if not len(labels) or labels.min() == labels.max():
            self.vectors = None
            return
        x = self._weighted(counts, style)
        basis = np.random.default_rng(7).standard_normal((x.shape[1], min(RANK, *x.shape))).astype(np.float32)
        for _ in range(ROUNDS):
            basis, _ = np.linalg.qr(x.T @ (x @ basis))
        self.basis = basis
        self.vectors = _unit(x @ basis)

    def _weighted(self, counts: np.ndarray, style: np.ndarray) -> np.ndarray:
        found = _unit(np.log1p(counts.astype(np.float32)) * self.weight)
        return np.concatenate([found, np.float32(STYLE) * style], 1)

    def score(self, counts: np.ndarray, style: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors."""
        out = np.full(len(counts), self.prior)
        if self.vectors is None:
            return out
        latent = _unit(self._weighted(counts, style) @ self.basis)
        near = latent @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(near, top, 1), 0, None).astype(np.float64) ** POWER
        total = weight.sum(1)
        some = total > 0
        out[some] = ((weight * self.labels[top]).sum(1)[some] / total[some]).clip(0, 1)
        return out


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Space:
    """The latent space of a bounded sample; its terms, ``2 * per_label`` sparse rows, are all that reaches the driver."""
    teach = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    teach = teach.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = teach.agg(F.avg("quality")).first()[0]
    sides = [teach.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for q in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(sides[0].unionByName(sides[1])), "doc_id")
    sample = one_per_document(sample)

    def sparse(batches):
        for batch in batches:
            places, values, style = [], [], []
            for _, _, counts, shares in terms(batch.column("text")):
                for row, traits in zip(counts, shares):
                    at = np.flatnonzero(row)
                    places.append(at.astype("<u2").tobytes())
                    values.append(row[at].astype("<u4").tobytes())
                    style.append(traits.tobytes())
            columns = [batch.column("doc_id"), batch.column("quality"), *(pa.array(c, pa.binary()) for c in (places, values, style))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "places", "counts", "style"])

    kinds = ", ".join(f"{c} {sample.schema[c].dataType.simpleString()}" for c in ("doc_id", "quality"))
    rows = map_batches(sample, sparse, f"{kinds}, places binary, counts binary, style binary").toPandas()
    rows = rows.sort_values(["doc_id", "places", "counts"], ignore_index=True)  # the order of rows must not matter
    counts = np.zeros((len(rows), TRIGRAMS), np.uint32)
    for i, (places, values) in enumerate(zip(rows["places"], rows["counts"])):
        counts[i, np.frombuffer(places, "<u2")] = np.frombuffer(values, "<u4")
    style = np.frombuffer(b"".join(rows["style"]), np.float32).reshape(len(rows), N_STYLE)
    return Space(counts, style, rows["quality"].to_numpy(), 0.5 if share is None else float(share))


def scored(docs: DataFrame, space: Space) -> DataFrame:
    """``docs`` with ``_score``."""
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def score(batches):
        for batch in batches:
            out = np.zeros(len(batch))
            for first, last, counts, style in terms(batch.column("text")):
                out[first:last] = shared.value.score(counts, style)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out)], [*names, "_score"])

    schema = docs.withColumn("_score", F.lit(0.0)).schema
    return map_batches(docs, score, schema)


def accepted(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """The documents that score one half or more, unchanged."""
    return unpack(scored(pack(docs), fit(docs, labels, per_label)).where("_score >= 0.5"), docs.columns)


def digest(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    out = scored(docs.select("doc_id", "text"), fit(docs, labels, per_label))
    return out.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted")
    )
