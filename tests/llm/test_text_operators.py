"""Exact operators against brute force, on awkward tables."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from claimtrail.llm import decontaminate, line_dedup, sentencepiece_bpe, substring_dedup, text
from tests.conftest import rows

BLANK = "[^\x20\x09-\x0d]+"


def sha(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def lower(value: str) -> str:
    return value.translate({i: i + 32 for i in range(65, 91)})


def brute_lines(pairs):
    key = lambda line: lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    holders = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    common = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or common.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines(docs_of, odd_pairs):
    docs, want = docs_of(odd_pairs), brute_lines(odd_pairs)
    assert rows(line_dedup.digest(docs)) == sorted(((i, n, d, sha(k)) for i, n, d, k in want), key=repr)
    cleaned = line_dedup.dedup_lines(docs)
    assert cleaned.dtypes == docs.dtypes
    assert rows(cleaned, "doc_id", "text", "n_chars") == sorted(((i, k, len(k)) for i, _, _, k in want), key=repr)


def brute_substrings(pairs, window):
    docs = [(i, re.findall(BLANK, t or "")) for i, t in pairs]
    least = {}
    for i, w in docs:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            if i is not None:
                least[k] = min(least.get(k, i), i)
    out = []
    for i, w in docs:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and least[tuple(w[p : p + window])] < i:
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


@pytest.mark.parametrize("group", [100_000, 2])
def test_substrings(docs_of, odd_pairs, group):
    want = brute_substrings(odd_pairs, 13)
    docs = docs_of(odd_pairs)
    assert rows(substring_dedup.digest(docs, group=group)) == sorted(((i, n, g, sha(k)) for i, n, g, k in want), key=repr)
    cleaned = substring_dedup.dedup_substrings(docs)
    assert cleaned.dtypes == docs.dtypes
    assert rows(cleaned, "doc_id", "text") == sorted(((i, k) for i, _, _, k in want), key=repr)


def test_substrings_of_one_id_over_two_texts(docs_of):
    words = [f"w{i}" for i in range(200)]
    shared, other = " ".join(words[100:130]), " ".join(f"v{i}" for i in range(20))
    pairs = [(1, shared), (1, other), (5, " ".join(words)), (5, f"short text {other}"), (5, "no repeat at all " * 5)]
    out = {(r.doc_id, r.n_words): r.n_removed for r in substring_dedup.digest(docs_of(pairs)).collect()}
    assert out == {(1, 30): 0, (1, 20): 0, (5, 200): 30, (5, 22): 20, (5, 20): 0}


def test_a_phrase_in_many_surroundings_is_parted(docs_of):
    phrase = " ".join(f"p{i}" for i in range(9))
    texts = [" ".join([f"a{i}x{k}" for k in range(9)] + [phrase] + [f"b{i}x{k}" for k in range(9)]) for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"_key": list(range(300)), "_hash": [0] * 300, "text": texts, "seeds": [None] * 300})
    runs = next(substring_dedup._units(batch, 13))[2]
    asked, times = np.unique(runs.seed, return_counts=True)
    hot = asked[times > 50]
    batch = batch.set_column(3, "seeds", pa.array([[asked.tobytes()]] * 300))
    for heat in (hot[:0], hot):
        sizes = defaultdict(int)
        for part in substring_dedup._suffix_rows(64, 13, 50_000, heat)(iter([batch])):
            for row in part.filter(pa.array([not f for f in part.column("found").to_pylist()], pa.bool_())).to_pylist():
                n = row["doc"]
                sizes[row["bucket"]] += int(np.frombuffer(row["data"], np.int32, n, 20 * n).sum())
        assert (max(sizes.values()) > 200) == (not len(heat)) and sum(sizes.values()) > 3_000
    pairs = list(enumerate(texts)) + [(i + 1000, t) for i, t in enumerate(texts[:40])]
    got = rows(substring_dedup.digest(docs_of(pairs), group=100))
    assert got == sorted(((i, n, g, sha(k)) for i, n, g, k in brute_substrings(pairs, 13)), key=repr)


def test_substrings_of_a_small_alphabet(spark, docs_of):
    rng = np.random.default_rng(5)
    pairs = [(int(i), " ".join(rng.choice(list("abc"), rng.integers(0, 60)))) for i in rng.permutation(60)]
    got = rows(substring_dedup.digest(docs_of(pairs), window=6, group=3))
    assert got == sorted(((i, n, g, sha(k)) for i, n, g, k in brute_substrings(pairs, 6)), key=repr)


def brute_hits(pairs, items, window=13):
    find = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t or ""))
    windows = defaultdict(set)
    for name, t in items:
        w = find(t)
        n = min(len(w), window)
        for p in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[p : p + n])].add("" if name is None else str(name))
    sizes = {len(k) for k in windows}
    out = []
    for i, t in pairs:
        w, hit, met = find(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    met |= windows[tuple(w[p : p + n])]
        out.append((i, len(w), len(hit), len(met), sha(",".join(sorted(met))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


ITEMS = [(1, " ".join(f"word{i}" for i in range(3, 20))), (10, " ".join(f"Word{i}" for i in range(3, 20))), (2, "xxx"), (3, None), (4, "!!"), (None, "another"), (5, "cd ab cd"), (6, "☃")]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 200])
@pytest.mark.parametrize("window", [13, 4])
def test_contamination(spark, docs_of, odd_pairs, block, window):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = docs_of(odd_pairs)
    want = brute_hits(odd_pairs, ITEMS, window)
    assert rows(decontaminate.digest(docs, items, window=window, block_bytes=block)) == want
    kept = decontaminate.decontaminate(docs, items, window=window, block_bytes=block)
    assert kept.dtypes == docs.dtypes
    assert rows(kept, "doc_id") == sorted(((r[0],) for r in want if not r[-1]), key=repr)


def test_longest_matches_have_places(spark, docs_of):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    found = decontaminate.find_matches(docs_of([(1, "x a b c d e y b c d"), (2, "z")]).select("doc_id", "text"), items, window=3)
    runs = {r.doc_id: [tuple(m) for m in r["_matches"] or []] for r in found.collect()}
    assert runs == {1: [("1", 0, 1, 5), ("1", 1, 7, 3)], 2: []}


def test_empty_tables(spark, docs_of):
    none, items = docs_of([]), spark.createDataFrame([], "item_id bigint, text string")
    assert rows(line_dedup.digest(none)) == rows(substring_dedup.digest(none)) == rows(decontaminate.digest(none, items)) == []
    assert rows(decontaminate.digest(docs_of([(1, "a b")]), items)) == [(1, 2, 0, 0, sha(""), False)]
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    assert rows(sentencepiece_bpe.digest(none, path)) == []


def test_pieces(docs_of, odd_pairs):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    want = []
    for i, t in odd_pairs:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    docs = docs_of(odd_pairs)
    assert rows(sentencepiece_bpe.digest(docs, path)) == sorted(want, key=repr)
    got = sentencepiece_bpe.encode_texts(docs, path, decode=True)
    assert rows(got, "doc_id", "piece_ids", "decoded") == sorted(((i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in odd_pairs), key=repr)


def test_pieces_of_random_texts():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as file:
        model = sentencepiece_bpe.PieceModel(file.read())
    rng = np.random.default_rng(3)
    letters = list("ab cd  e\n▁é🙂́XY..()\r\t0019thetion<s>")
    for _ in range(3000):
        t = "".join(rng.choice(letters, rng.integers(0, 40)))
        ids = library.encode(t)
        assert (model.encode(t), model.encoded(t)) == (ids, (",".join(map(str, ids)), library.decode(ids))), repr(t)
    for _ in range(2000):
        ids = [int(i) for i in rng.choice([3, 5, 130, 198, 229, 240, 264, 28705, 272, 1, 2], rng.integers(1, 8))]
        if ids[0] >= 259:
            assert model.decode(ids) == library.decode(ids), ids


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        sentencepiece_bpe.PieceModel(b"")


def test_word_hashes_cross_lanes():
    import pyarrow as pa

    words = ["a", "aaaaaaaa", "aaaaaaaab", "b" * 64, "b" * 65, "b" * 500, "é", "a" * 16]
    column = pa.array([" ".join(words), None, "", " ".join(reversed(words))])
    found = [w for _, _, w in text.each_chunk(column, text.BLANKS)]
    assert len(found) == 1
    h = found[0].hashes()
    assert list(found[0].of) == [0, 8, 8, 8, 16] and len(set(h[:8])) == 8 and list(h[8:]) == list(h[:8][::-1])
