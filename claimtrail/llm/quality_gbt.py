"""Quality rules: document statistics, and boosted trees over them.

Statistics of whole texts are computed in one pass over Arrow batches. The trees are fitted by histogram boosting on the statistics
of a bounded sample of labelled documents (``SAMPLE`` rows, those of the smallest hash), with log loss and class weights that
balance the labels. A split on a constrained feature is taken only if its sides keep the wanted order, and the leaves below it stay on
their side of the middle between them, so the score is monotone in that feature. The finished trees are flattened into node arrays
and score a batch of documents level by level.

A document is kept if the base rules pass (at least 50 words; at most half of them in repeated windows of three) and its score is
at least ``KEEP``.

Defined cases: a null, empty or blank text has statistics zero and fails the base rules. Rows are judged one by one, so repeated
rows agree. A document labelled more than once counts with its lowest label. With no labels, or labels of one kind only, every
document gets a score of 0.5 and the base rules decide alone. Other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.text import BLANKS, byte_set, each_chunk, mix, text_bytes

SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST, RIDGE = 60, 4, 64, 0.15, 20, 1.0
KEEP = 0.5
MIN_WORDS = 50
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER, _DIGIT, _STOP = byte_set((65, 90)), byte_set((48, 57)), np.isin(np.arange(256), list(b".!?"))
_PUNCT = byte_set((33, 47), (58, 64), (91, 96), (123, 126))

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features, and whether the score may only fall (-1) or rise (1) with them.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": -1, "digit_share": 0, "punct_per_word": 0, "stops_per_word": 0, "distinct_share": 1, "lines_per_word": 0, "wide_share": 0,
}


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _per_text(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[of[1:]] - total[of[:-1]]


def _same(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: how often its key is met in its text, and whether it is the first of them."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    group = np.cumsum(new) - 1
    count = np.bincount(group) if len(k) else np.zeros(0, np.int64)
    times, first = np.empty(len(k), np.int64), np.zeros(len(k), bool)
    times[order] = count[group]
    first[order[new]] = True  # lexsort is stable
    return times, first


def _repeat_words(hashes: np.ndarray, of: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Words of each text in three-word windows that the text has twice or more."""
    n = len(hashes)
    if n < 3:
        return np.zeros(len(of) - 1, np.int64)
    inside = np.flatnonzero(owner[2:] == owner[:-2])
    key = mix(mix(mix(hashes[inside]) + hashes[inside + 1]) + hashes[inside + 2])
    times, _ = _same(key, owner[inside])
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[inside[times > 1] + shift] = True
    return _per_text(covered, of)


def _dup_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines, and lines with a word that are equal to an earlier line, of each text."""
    text = data.tobytes()
    lines, dup = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        rows = text[a:b].split(b"\n")
        lines[i] = len(rows)
        if len(rows) > 1 and len(set(rows)) < len(rows):
            seen = [r for r in rows if r.strip()]
            dup[i] = len(seen) - len(set(seen))
    return lines, dup


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Base counts and features of each text of a column."""
    n = len(column)
    out = {c: np.zeros(n, np.int64) for c in BASE} | {c: np.zeros(n) for c in FEATURES}
    data, offsets = text_bytes(column)
    for first, last, words in each_chunk(column, BLANKS):
        part, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        count = np.diff(words.of)
        owner = np.repeat(np.arange(len(count)), count)
        hashes = words.hashes()
        heads = (part & 0xC0) != 0x80
        inside = heads & ~BLANKS[part]
        lines, dup = _dup_lines(part, at)
        _, fresh = _same(hashes, owner)
        found = {
            "n_words": count, "word_chars": _sums(inside, at), "n_symbols": _sums(_SYMBOL[part], at), "n_dup_lines": dup,
            "n_repeat_words": _repeat_words(hashes, words.of, owner),
        }
        some, chars = np.maximum(count, 1), np.maximum(found["word_chars"], 1)
        found |= {
            "log_words": np.log1p(count), "mean_word": found["word_chars"] / some, "symbols_per_word": found["n_symbols"] / some,
            "dup_line_share": dup / np.maximum(lines, 1), "repeat_share": found["n_repeat_words"] / some,
            "upper_share": _sums(_UPPER[part], at) / chars, "digit_share": _sums(_DIGIT[part], at) / chars,
            "punct_per_word": _sums(_PUNCT[part], at) / some, "stops_per_word": _sums(_STOP[part], at) / some,
            "distinct_share": _per_text(fresh, words.of) / some, "lines_per_word": lines / some, "wide_share": _sums(part >= 0xC0, at) / chars,
        }
        for name, values in found.items():
            out[name][first:last] = values
    return out


class Trees:
    """Boosted trees in flat node arrays; ``left[i]`` < 0 marks a leaf."""

    def __init__(self, signs: list[int]):
        self.signs, self.base = signs, 0.0
        self.roots: list[int] = []
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []

    def _node(self) -> int:
        for column, blank in ((self.feature, 0), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            column.append(blank)
        return len(self.value) - 1

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
        score = np.zeros(len(y))
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            gradient, hessian = weight * (p - y), weight * p * (1 - p)
            self.roots.append(self._node())
            open_ = [(self.roots[-1], np.arange(len(y)), -np.inf, np.inf, 0)]
            while open_:
                node, rows, low, high, depth = open_.pop()
                value = float(np.clip(-gradient[rows].sum() / (hessian[rows].sum() + RIDGE), low, high))
                best = self._split(binned, edges, rows, gradient, hessian, low, high) if depth < DEPTH else None
                if best is None:
                    self.value[node] = RATE * value
                    score[rows] += RATE * value
                    continue
                feature, bin_, vl, vr = best
                self.feature[node], self.cut[node] = feature, float(edges[feature][bin_])
                self.left[node], self.right[node] = self._node(), self._node()
                side = binned[rows, feature] <= bin_
                middle, sign = (vl + vr) / 2, self.signs[feature]
                bounds = ((low, middle), (middle, high)) if sign > 0 else ((middle, high), (low, middle)) if sign < 0 else ((low, high), (low, high))
                open_.append((self.left[node], rows[side], *bounds[0], depth + 1))
                open_.append((self.right[node], rows[~side], *bounds[1], depth + 1))
        for name in ("roots", "feature", "cut", "left", "right", "value"):
            setattr(self, name, np.array(getattr(self, name)))
        return self

    def _split(self, binned, edges, rows, gradient, hessian, low, high):
        best, chosen = 1e-6, None
        g, h = gradient[rows], hessian[rows]
        for f, edge in enumerate(edges):
            if not len(edge):
                continue
            b = binned[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(b, w, len(edge) + 1))[:-1] for w in (g, h, None))
            gr, hr, nr = g.sum() - gl, h.sum() - hl, len(rows) - nl
            vl, vr = np.clip(-gl / (hl + RIDGE), low, high), np.clip(-gr / (hr + RIDGE), low, high)
            whole = np.clip(-g.sum() / (h.sum() + RIDGE), low, high)
            loss = lambda v, g, h: g * v + (h + RIDGE) * v * v / 2
            gain = loss(whole, g.sum(), h.sum()) - loss(vl, gl, hl) - loss(vr, gr, hr)
            gain[(nl < LEAST) | (nr < LEAST) | (self.signs[f] * (vr - vl) < 0)] = 0
            at = int(gain.argmax())
            if gain[at] > best:
                best, chosen = gain[at], (f, at, vl[at], vr[at])
        return chosen

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                inner = self.left[at] >= 0
                below = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
                at = np.where(inner, below, at)
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def _matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([stats[c] for c in FEATURES], 1)


def one_per_document(sample: DataFrame) -> DataFrame:
    """``doc_id, quality, text`` with one row of each doc_id, that of the smallest hash of the text."""
    first = sample.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("_first"))
    return first.select("doc_id", "quality", F.col("_first.text").alias("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``doc_id, text, quality`` of at most ``limit`` labelled documents, those of the smallest hash of the id, one row each."""
    marks = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return one_per_document(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id"))


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Trees | None:
    """Trees fitted on a sample; only its statistics, ``limit`` short rows, reach the driver."""
    names = list(FEATURES)

    def measure(batches):
        for batch in batches:
            stats = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), *(pa.array(stats[c]) for c in names)], ["doc_id", "quality", *names])

    sample = labelled_sample(docs, labels, limit)
    kinds = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, quality {sample.schema['quality'].dataType.simpleString()}"
    rows = map_batches(sample, measure, f"{kinds}, " + ", ".join(f"{c} double" for c in names)).toPandas().sort_values(["doc_id", *names])
    y = rows["quality"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    return Trees(list(FEATURES.values())).fit(rows[names].to_numpy(), y, weight)


def judged(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``score`` and ``kept``."""
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def judge(batches):
        for batch in batches:
            stats = statistics(batch.column("text"))
            n = stats["n_words"]
            failed = (n < MIN_WORDS) | (100 * stats["n_repeat_words"] > 50 * n)
            score = np.full(len(n), 0.5) if shared.value is None else shared.value.score(_matrix(stats))
            arrays = [batch.column("doc_id"), *(pa.array(stats[c]) for c in BASE), pa.array(failed), pa.array(score), pa.array(~failed & (score >= KEEP))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *BASE, "base_failed", "score", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, judge, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, score double, kept boolean")


def digest(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    return judged(docs, fit(docs, labels, limit))
