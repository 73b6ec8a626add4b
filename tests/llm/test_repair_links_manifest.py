"""Conversation repair, MinHash links and the Merkle manifest against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from claimtrail.llm import merkle, minhash_join, turn_repair

CONV = "conv_id bigint, turn bigint, role string, text string"


# ---- conversation repair


def plain_repair(rows):
    """All minimal paths by plain dynamic programming over (row, state) with whole audits; rows of (role, text, must go, cut off)."""
    after = {0: "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    best = {0: (0, "", ())}

    def relax(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def insertions(table):
        for _ in range(2):
            for state, (cost, audit, out) in list(table.items()):
                to = after[state]
                relax(table, to, (cost + 2, audit + "I", (*out, f"{name[to]}:")))

    for role, text, gone, cut in rows:
        insertions(best)
        new = {}
        for state, (cost, audit, out) in best.items():
            relax(new, state, (cost + 3, audit + "D", out))
            if gone:
                continue
            to = after[state]
            relax(new, to, (cost + 2 + cut, audit + "R", (*out, f"{name[to]}:{text}")))
            if role[:1] == to or (role[:1] == "s" and state == 0):
                relax(new, role[:1], (cost + cut, audit + "K", (*out, f"{role}:{text}")))
        best = new
    insertions(best)
    return min((v for s, v in best.items() if s in (0, "a")), key=lambda v: v[:2])


def plain_digest(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if code == 3 else 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked, numbers = set(), [], [0, 0, 0]
        for _, role, text in held:
            last = text.strip(" \t\n\x0b\x0c\r")[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                numbers[fault] += 1
            marked.append((role, text, fault in (0, 1), int(fault == 2)))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit, repaired = plain_repair(marked)
        out[conv] = (gaps, *numbers, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def repaired(spark, rows):
    found = turn_repair.digest(spark.createDataFrame(rows, CONV)).collect()
    out = {r.conv_id: tuple(r)[1:] for r in found}
    assert len(out) == len(found)
    return out


def some_conversations(count, seed=5):
    draw = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(draw.randrange(0, 9)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            rows.append((conv, draw.choice([turn, turn, turn, None]), role, draw.choice(["Yes.", "No!", "cut", "", None, " \n", f"text {draw.random()}."])))
    return rows


def test_repair_against_plain_programming(spark):
    rows = some_conversations(60) + [(None, 1, "user", "q?"), (None, None, "assistant", "a."), (70, 3, "", "no role."), (71, 1, "user", "x" * 300_000 + ".")]
    assert repaired(spark, rows) == plain_digest(rows)


def test_every_short_lattice():
    for size in range(5):
        for codes in itertools.product("suoUAx", repeat=size):
            rows = [(c.lower() if c.lower() in "sua" else "o", "t", c == "x", int(c.isupper())) for c in codes]
            codes = "".join(codes)
            edits, state = turn_repair.cheapest(codes)
            edits += turn_repair.ending(state)
            want = plain_repair(rows)
            assert (turn_repair.cost_of(codes, edits), edits) == want[:2], codes


def test_long_conversations_are_cut_in_blocks(spark, monkeypatch):
    draw = random.Random(1)
    rows = [(1, t, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", f"b {t}", f"c {t}."])) for t in range(600)]
    monkeypatch.setattr(turn_repair, "BLOCK", 40)
    rows += [(conv, t, "user", "same.") for conv in (0, 2) for t in (1, 1, 1)]
    assert repaired(spark, rows) == plain_digest(rows)
    turns = turn_repair.repaired_turns(turn_repair.damaged(spark.createDataFrame(rows, CONV))).where("conv_id = 1").orderBy("place").collect()
    assert [t.place for t in turns] == list(range(len(turns)))
    text = "\n".join(f"{t.role}:{t.text}" for t in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == plain_digest(rows)[1][-1]


def test_many_copies_of_a_turn(spark):
    rows = [(9, 2, "user", "again.")] * 2500 + [(9, 1, "system", "s.")]
    assert repaired(spark, rows) == plain_digest(rows)


def test_repair_of_odd_tables(spark):
    assert repaired(spark, []) == {}
    assert turn_repair.repaired_turns(spark.createDataFrame([], CONV)).count() == 0
    rows = spark.createDataFrame([("a", 1, "user", "q?", "x"), ("a", 2, "assistant", "r.", "y")], "conv_id string, turn int, role string, text string, code string")
    (found,) = turn_repair.repair(rows).collect()
    assert (found.conv_id, found.cost, found.audit) == ("a", 0, "KK")


# ---- MinHash links


def plain_links(pairs):
    sets = []
    for _, text in pairs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set())
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(pairs)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            parent[root(j)] = root(i)
    out = []
    for i, (doc, _) in enumerate(pairs):
        mates = [pairs[j][0] for j in range(len(pairs)) if root(j) == root(i) and pairs[j][0] is not None] if sets[i] else [doc]
        least = min(mates, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def family(draw, size, edits, first_id):
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    out = []
    for i in range(size):
        words = list(base)
        for _ in range(draw.randrange(edits)):
            words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
        out.append((first_id + i, " ".join(words)))
    return out


def linked(docs, **options):
    return sorted(map(tuple, minhash_join.near_duplicates(docs, **options).drop("text_hash").collect()), key=repr)


def test_links_against_all_pairs(spark, docs_of):
    draw = random.Random(3)
    pairs = family(draw, 40, 9, 100) + family(draw, 30, 16, 300) + [(i, f"short {i % 3}") for i in range(6)] + [(7, "One two"), (8, "one TWO"), (9, "")]
    assert linked(docs_of(pairs)) == plain_links(pairs)


def test_long_lists_are_tiled(spark, docs_of):
    draw = random.Random(4)
    pairs = family(draw, 60, 9, 100) + family(draw, 50, 20, 300)
    assert linked(docs_of(pairs), members=8, tile=6) == plain_links(pairs)


def test_links_of_odd_tables(spark, docs_of, odd_pairs):
    assert linked(docs_of(odd_pairs)) == plain_links(odd_pairs)
    assert linked(docs_of([])) == []
    texts = spark.createDataFrame([("b", "x y z", 1), ("a", "X y z", 2), (None, "x y z", 3), ("c", None, 4)], "doc_id string, text string, node int")
    assert linked(texts) == sorted([("b", 1, "a", False), ("a", 1, "a", True), (None, 1, "a", False), ("c", 0, "c", True)], key=repr)
    kept = minhash_join.keep_first(texts)
    assert kept.columns == texts.columns and {r.doc_id for r in kept.collect()} == {"a", "c"}


def test_two_texts_of_one_id_stay_apart(spark, docs_of):
    docs = docs_of([(1, "a b c d"), (1, "e f g h"), (1, "a b c d"), (2, "a b c d")])
    assert linked(docs) == sorted([(1, 2, 1, True)] * 3 + [(2, 2, 1, False)], key=repr)
    assert sorted(r.text for r in minhash_join.keep_first(docs).collect()) == ["a b c d", "e f g h"]


def test_recall_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert linked(docs) == plain_links([tuple(r) for r in docs.collect()])
    assert minhash_join.missed() < 3e-6


# ---- Merkle manifest

DOC = "doc_id bigint, source string, lang string, n_chars int, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes):
        """Root and, for each node, its (place, others) level by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for path, i in zip(paths, at):
                run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
                path.append((i % 16, run[: i % 16] + run[i % 16 + 1 :]))
            nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
            at = [i // 16 for i in at]
        return nodes[0], paths

    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        held = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((held, *tree([leaf(r) for r in held])))
    root, tops = tree([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (held, subroot, paths), top in zip(trees, tops):
        for row, path in zip(held, paths):
            node = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf((*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4])))
            for at, others in path + top:
                node = sha("".join([*others[:at], node, *others[at:]]))
            out.append((row[0], leaf(row), subroot, root, sha("".join(o for _, others in path + top for o in others)), node, node == root))
    return sorted(out, key=repr)


def manifest_of(spark, rows):
    return sorted(map(tuple, merkle.digest(spark.createDataFrame(rows, DOC)).collect()), key=repr)


def test_manifest_against_plain_trees(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(700)] + [(i, "alone", None, None, None) for i in (3,)]
    rows += [(i, f"ünï {i}", "fr", 1, "É A") for i in range(20)] + [(None, None, None, None, None), (None, None, "x", 1, ""), (5, None, "en", 2, "Z" * 200_000)]
    rows += [(1, "s1", "en", 1, "Text 1"), (1, "s1", "en", 1, "other")]
    assert manifest_of(spark, rows) == plain_manifest(rows)


@pytest.mark.parametrize("size", [16, 17, 257])
def test_manifest_of_several_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(size)]
    assert manifest_of(spark, rows) == plain_manifest(rows)


def test_manifest_of_odd_tables(spark):
    assert manifest_of(spark, []) == []
    docs = spark.createDataFrame([("b", "s", "en", 1, "t", 9), ("a", "s", "en", 1, "t", 8)], "doc_id string, source string, lang string, n_chars int, text string, node int")
    found = merkle.manifest(docs, node=F.col("node")).collect()
    assert [(r.doc_id, r.node, len(r.witness)) for r in sorted(found)] == [("a", 8, 1), ("b", 9, 1)]
    one = merkle.digest(docs.where("doc_id = 'a'")).collect()[0]
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified and one.proof_sha256 == sha("")
