"""Learned operators by held-out labels, links by brute force, sharding by its rules."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from claimtrail.llm import quality_gbt, quality_knn, sharding, simhash_dedup
from claimtrail.llm.components import components
from tests.conftest import rows

SHARED = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    """Plain sentences of label 1, and shouting, repeating or symbol-ridden ones of label 0."""
    rng = np.random.default_rng(1)
    words = ["the", "of", "river", "stone", "walks", "and", "quietly", "house", "under", "bright", "moon", "a", "sings", "little"]
    docs, labels = [], []
    for i in range(400):
        w = list(rng.choice(words, 80))
        good = i % 4 > 0
        if not good:
            w = [x.upper() + "!!" for x in w] if i % 8 else [x + "###" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(good), 0))
    return docs, spark.createDataFrame(labels + [(0, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")


def test_neighbours_vote(docs_of, labelled, odd_pairs):
    docs, labels = labelled
    table = docs_of(docs + [(i, t) for i, t in odd_pairs if i is None or i < 0])
    out = quality_knn.digest(table, labels, per_label=50).toPandas()
    assert len(out) == len(docs) + 3 and out.score.between(0, 1).all()
    known = out[out.doc_id >= 0]
    assert (known.held_out == known.doc_id.map(lambda d: zlib.crc32(str(int(d)).encode()) % 3 == 1)).all()
    unseen = known[known.held_out]
    assert (unseen.predicted == (unseen.doc_id % 4 > 0)).mean() > 0.95
    kept = quality_knn.accepted(table, labels, per_label=50)
    assert kept.dtypes == table.dtypes
    assert kept.count() == (out.score >= 0.5).sum()


def test_neighbours_of_nothing(spark, docs_of, labelled):
    docs, labels = labelled
    none = labels.where(F.lit(False))
    got = rows(quality_knn.digest(docs_of([(1, None), (2, "some words"), (2, "some words")]), none))
    assert got == [(1, False, 0.5, 1), (2, True, 0.5, 1), (2, True, 0.5, 1)] or {r[2] for r in got} == {0.5}
    prior = labels.where(F.col("quality") == 1)
    assert {r[2] for r in rows(quality_knn.digest(docs_of([(1, ""), (2, "x y")]), prior))} == {1.0}
    assert rows(quality_knn.digest(docs_of([]), labels)) == []


def test_statistics(odd_pairs):
    texts = [t for _, t in odd_pairs] + ["a b c a b c\n\na b c\n a b c\n# $ <x>\n# $ <x>", "x x x x"]
    stats = quality_gbt.statistics(pa.array(texts))
    for i, t in enumerate(texts):
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        grams = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        times = {g: grams.count(g) for g in set(grams)} if len(w) < 1000 else dict.fromkeys(grams, 2)
        covered = {j + k for j, g in enumerate(grams) if times[g] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert tuple(int(stats[c][i]) for c in quality_gbt.BASE) == want, t and t[:50]


def test_rules_keep_the_wanted_order():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) - x[:, 1] + 0.2 * rng.standard_normal(3000) > 0).astype(float)
    trees = quality_gbt.Trees([1, -1, 0]).fit(x, y, np.ones(3000))
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.85
    grid = np.linspace(0, 1, 200)
    for other in rng.random((20, 3)):
        for feature, sign in ((0, 1), (1, -1)):
            line = np.tile(other, (200, 1))
            line[:, feature] = grid
            assert (sign * np.diff(trees.score(line)) >= -1e-12).all()


def test_flat_trees_agree_with_walking():
    rng = np.random.default_rng(4)
    x = rng.random((500, 2))
    trees = quality_gbt.Trees([0, 0]).fit(x, (x[:, 0] > x[:, 1]).astype(float), np.ones(500))

    def walk(row, node):
        while trees.left[node] >= 0:
            node = trees.left[node] if row[trees.feature[node]] <= trees.cut[node] else trees.right[node]
        return trees.value[node]

    want = [1 / (1 + np.exp(-sum(walk(row, r) for r in trees.roots))) for row in x[:50]]
    assert np.allclose(trees.score(x[:50]), want)


def test_rules(spark, docs_of, labelled, odd_pairs):
    docs, labels = labelled
    out = quality_gbt.digest(docs_of(docs), labels, limit=300).toPandas()
    assert (out.kept == (out.doc_id % 4 > 0)).mean() > 0.95
    odd = quality_gbt.digest(docs_of(odd_pairs), labels.where("quality = 1")).toPandas()
    assert len(odd) == len(odd_pairs) and (odd.score == 0.5).all() and (odd.kept == ~odd.base_failed).all()
    assert rows(quality_gbt.digest(docs_of([]), labels)) == []


def brute_prints(pairs):
    out = []
    for i, t in pairs:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        runs = [" ".join(w[j : j + 3]) for j in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        h = np.array([xxhash.xxh64_intdigest(r.encode(), 42) for r in runs], np.uint64)
        out.append((i, sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))))
    return out


def brute_components(ids, linked):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, d in enumerate(ids):
        groups.setdefault(find(i), []).append(d)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(ids))]


def test_fingerprint_components(docs_of, odd_pairs):
    prints = brute_prints(odd_pairs)
    comp = brute_components([i for i, _ in prints], lambda a, b: bin(prints[a][1] ^ prints[b][1]).count("1") <= 3)
    want = sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, comp)), key=repr)
    docs = docs_of(odd_pairs)
    assert rows(simhash_dedup.digest(docs)) == want
    kept = simhash_dedup.keep_first(docs)
    assert kept.dtypes == docs.dtypes
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == sorted({c for (i, _), c in zip(prints, comp) if i is not None and c is not None})
    assert rows(simhash_dedup.digest(docs_of([]))) == []


@pytest.mark.parametrize("tile,max_tiles", [(4096, 64), (8, 64), (8, 1)])
def test_links_in_small_and_cut_buckets(spark, tile, max_tiles):
    rng = np.random.default_rng(6)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    prints = {b ^ sum(1 << int(p) for p in rng.integers(0, 63, rng.integers(0, 6))) for b in base for _ in range(40)}
    fps = sorted(prints)
    nodes = spark.createDataFrame([(n, f) for n, f in enumerate(fps)], "node bigint, fp0 bigint")
    found = {r.node: r.component for r in components(simhash_dedup.links(nodes, tile=tile, max_tiles=max_tiles)).collect()}
    want = brute_components(list(range(len(fps))), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 3)
    assert [found.get(n, n) for n in range(len(fps))] == want


@pytest.mark.parametrize("radius", [3, 5, 45])
def test_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    n, words = 300, 1 if radius < 10 else 4
    base = rng.integers(0, 1 << 63, (4, words)).astype(np.uint64)[rng.integers(0, 4, n)]
    noise = np.packbits(rng.random((n, words, 64)) < radius / 64 / words / 1.8, axis=2).view("<u8")[..., 0]
    fps = [(base[:, k] ^ noise[:, k]).astype(np.uint64) for k in range(words)]
    group = np.sort(rng.integers(0, 3, n))
    got = {(int(a), int(b)) for i, j in simhash_dedup.sliced_links(fps, group, np.arange(n), radius) for a, b in zip(i, j)}
    far = lambda a, b: sum(int(np.bitwise_count(f[a] ^ f[b])) for f in fps)
    assert got == {(a, b) for b in range(n) for a in range(b) if group[a] == group[b] and far(a, b) <= radius} and got


def test_samples_hold_one_row_of_each_id(docs_of, labelled):
    docs, labels = labelled
    table = docs_of(docs + [(8, f"another text {k}") for k in range(200)])
    sample = quality_gbt.labelled_sample(table, labels, 1_000)
    assert sample.count() == sample.select("doc_id").distinct().count() == len(docs)
    assert len(quality_knn.fit(table, labels, per_label=1_000).labels) == len(quality_knn.fit(docs_of(docs), labels, per_label=1_000).labels)


def test_text_ids_and_several_texts_of_one_id(spark, docs_of):
    docs = docs_of([(5, "one two three four"), (5, "quite another text here"), (5, "one two three four"), (6, "quite another text here"), (None, "x y z")])
    assert sorted((r.doc_id, r.text) for r in simhash_dedup.keep_first(docs).where("doc_id is not null").collect()) == [(5, "one two three four"), (5, "quite another text here")]
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert sorted({(r.doc_id, r.component_id) for r in simhash_dedup.digest(named).collect()}, key=repr) == [("d5", "d5"), ("d6", "d5"), (None, None)]


def test_components_of_a_path(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_shards_fit(docs_of, odd_pairs):
    pairs = odd_pairs + [(1000 + i, "y" * (50 + i % 70)) for i in range(200)] + [(5000, "z" * 400)] * 7
    out = sharding.assign(docs_of(pairs), limit=1000).toPandas()
    assert len(out) == len(pairs) and out.n_bytes.sum() == sum(len((t or "").encode()) for _, t in pairs)
    total = out.groupby("shard").agg(n=("n_bytes", "sum"), told=("shard_bytes", "max"), size=("n_bytes", "count"))
    assert (total.n == total.told).all()
    assert ((total.n <= 1000) | (total["size"] == 1)).all()
    names = [s for s in total.index if "." not in s]
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    split = {n[:-1] for n in names if n}
    for parent in split:  # a bucket was split only because it was too large
        assert total.n[[s for s in total.index if s.startswith(parent)]].sum() > 1000
    assert rows(sharding.assign(docs_of([]))) == []


def test_written_shards(docs_of, odd_pairs, spark, tmp_path):
    docs = docs_of(odd_pairs).drop("a.b")
    sharding.write_shards(docs, str(tmp_path / "shards"), limit=100_000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows(back, "doc_id", "text", "score") == rows(docs, "doc_id", "text", "score")
    assert back.select("shard").distinct().count() > 1


def test_written_shards_hold_each_row_once(docs_of, spark, tmp_path):
    pairs = [(7, f"text {i:03d}") for i in range(40)] + [(None, f"null {i:03d}") for i in range(40)] + [(9, "z" * 400)] * 7 + [(None, "y" * 300)] * 8 + [(i, "x" * 90) for i in range(20, 40)]
    docs = docs_of(pairs).drop("a.b")
    sharding.write_shards(docs, str(tmp_path / "shards"), limit=1000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows(back, "doc_id", "text") == rows(docs, "doc_id", "text")
    sizes = {r.shard: r.n for r in back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    assert max(sizes.values()) <= 1000
    assert sizes == {"b" + r.shard: r.shard_bytes for r in sharding.assign(docs, limit=1000).collect()}


def test_place_is_stable(spark):
    key = "5\n" + hashlib.md5("é".encode()).hexdigest()
    want = int(hashlib.md5(key.encode()).hexdigest()[:15], 16)
    assert spark.range(1).select(sharding.place(F.lit(5), F.lit("é"))).first()[0] == want
