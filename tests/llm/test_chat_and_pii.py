"""Chat layouts and the template's round trip; pseudonyms by their formats; the pipeline's stages."""

import hashlib
import json
import re
from datetime import date

import pytest
from hypothesis import given, settings, strategies as st

from claimtrail.llm import chat_format, pii_feistel
from tests.conftest import rows

LAYOUTS = {
    "prompt": ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    "completion": ({"prompt": "p", "completion": None, "id": 7}, [("user", "p"), ("assistant", "")]),
    "instruction": ({"instruction": "i", "output": "o", "meta": {"x": [1]}}, [("user", "i"), ("assistant", "o")]),
    "input": ({"instruction": "i", "input": "n", "output": "o"}, [("user", "i\n\nn"), ("assistant", "o")]),
    "no input": ({"system": "s", "instruction": "i", "input": "", "output": "o"}, [("system", "s"), ("user", "i"), ("assistant", "o")]),
    "messages": ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
    "from": ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
    "nested": ({"conversation": {"turns": [{"speaker": "human", "utterance": "a"}]}, "score": 1}, [("user", "a")]),
    "system and messages": ({"system": "s", "messages": [{"role": "user", "content": "a"}]}, [("system", "s"), ("user", "a")]),
    "both": ({"prompt": "p", "response": "r", "messages": [{"role": "user", "content": "a"}], "system": "s"}, [("system", "s"), ("user", "a")]),
    "unknown": ({"title": "t"}, None),
    "empty": ({}, None),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    record, want = LAYOUTS[name]
    got = chat_format.turns_of(record)
    assert want is None and got is None or [(r, t) for _, r, t in got] == want


def test_one_table_of_all_layouts(spark):
    table = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(LAYOUTS.values())] + [(99, None)], "conv_id bigint, record string")
    found = chat_format.assemble(chat_format.format_json(table)).collect()
    want = {i: t for i, (_, t) in enumerate(LAYOUTS.values()) if t}
    assert {r.conv_id: chat_format.read_turns(r.formatted) for r in found} == want
    for r in found:
        loss = [chat_format.unescape(r.formatted[s.start : s.end]) for s in r.loss_spans]
        assert loss == [t for role, t in want[r.conv_id] if role == "assistant" and t]
    assert {r.conv_id for r in chat_format.unmapped(table).collect()} == {10, 11, 99}


def test_one_wide_table_of_all_layouts(spark):
    records = [r for r, t in LAYOUTS.values() if t is not None and r.get("completion", "") is not None]
    table = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id bigint, record string")
    turns = [(i + 100, r) for i, r in enumerate([{"question": "q", "answer": "a"}, {"prompt": "p", "completion": "c"}, {"turn": 3, "role": "user", "text": "t"}, {"question": "q"}])]
    table = table.unionByName(spark.createDataFrame([(i, json.dumps(r)) for i, r in turns], table.schema))
    lines = table.rdd.map(lambda r: json.dumps({"conv_id": r.conv_id, **json.loads(r.record)}))
    wide = spark.read.json(lines)
    assert {"prompt", "question", "messages", "conversation"} <= set(wide.columns)
    found = {r.conv_id: chat_format.read_turns(r.formatted) for r in chat_format.assemble(chat_format.format_records(wide)).collect()}
    want = {i: t for i, (r, t) in enumerate((r, t) for r, t in LAYOUTS.values() if r in records)}
    want |= {100: [("user", "q"), ("assistant", "a")], 101: [("user", "p"), ("assistant", "c")], 102: [("user", "t")], 103: [("user", "q"), ("assistant", "")]}
    assert found == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("#:<\\/ turnuser>\n", max_size=12), st.text("#<\\/turn>: Asistn\n☃", max_size=40)), max_size=5))
def test_template_round_trip(turns):
    assert chat_format.read_turns("".join(chat_format.segment(*t)[0] for t in turns)) == turns


def test_marks_are_unique():
    for text in ("\\### Assistant: </turn> ok", "####", "</turn>\n### user: x</turn>\n"):
        body, start, end = chat_format.segment("assistant", text)
        assert body.count("</turn>") - len(re.findall(r"\\</turn>", body)) == 1
        assert chat_format.unescape(body[start:end]) == text


def test_turn_rows(spark):
    data = [(1, 1, "assistant", "b\n#"), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"), (2, None, "assistant", ""), (None, 5, "assistant", "☃")]
    table = spark.createDataFrame([(*r, "extra", "q") for r in data], "conv_id bigint, turn bigint, role string, text string, segment string, prompt string")
    got = rows(chat_format.digest(chat_format.format_records(table)))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [r[:5] for r in got] == sorted([
        (1, 2, sha("user\n\nassistant\nb\n#\n"), 3, sha("b\n#")), (2, 3, sha("assistant\n\n" + "\nx\n" * 2), 0, sha("")), (None, 1, sha("assistant\n☃\n"), 1, sha("☃")),
    ], key=repr)
    assert rows(chat_format.digest(chat_format.format_records(table.limit(0)))) == []
    tricky = chat_format.with_tricky(table.limit(0))
    assert rows(chat_format.digest(chat_format.format_records(tricky)))[0][:2] == (-7, 2)


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return (sum(d[0::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def iban_ok(text):
    t = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


CASES = [
    ("4111 1111 1111 1111", r"4\d{3}( \d{4}){3}"), ("378282246310005", r"3\d{14}"), ("4111-1111-1111-1111", r"4\d{3}(-\d{4}){3}"), ("6011000990139424", r"6\d{15}"),
    ("GB82 WEST 1234 5698 7654 32", r"GB\d\d WEST \d{4} \d{4} \d{4} \d\d"), ("DE89370400440532013000", r"DE\d{20}"),
    ("123-45-6789", r"\d{3}-\d\d-\d{4}"), ("+1 (415) 555-2671", r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}"), ("415.555.2671", r"[2-9]\d\d\.[2-9]\d\d\.\d{4}"),
    ("+44 20 7946 0958", r"\+44 \d\d \d{4} \d{4}"), ("192.168.17.254", r"\d+(\.\d+){3}"), ("2000-02-29", r"\d{4}-\d\d-\d\d"), ("3/7/1980", r"\d+/\d+/\d{4}"),
    ("12/31/1999", r"\d\d/\d\d/\d{4}"), ("ann.b7@mail.example.org", r"[a-z]{3}\.[a-z]\d@[a-z]{4}\.[a-z]{7}\.org"),
]
LEFT = ["4111111111111112", "666-12-1234", "000-12-1234", "1999-02-29", "256.1.1.1", "1.2.3.4.5", "4155552671", "DE89370400440532013001", "version 4.0.", "1700-01-01", "0000000000000000"]


def test_pseudonyms(docs_of):
    pairs = [(i, f"see {v}, or {v}.") for i, (v, _) in enumerate(CASES)] + [(100 + i, f"id {v} end") for i, v in enumerate(LEFT)]
    out = {r.doc_id: r for r in pii_feistel.digest(docs_of(pairs)).collect()}
    for i, (value, form) in enumerate(CASES):
        new = re.fullmatch(r"see (.*), or (.*)\.", out[i].text)
        assert new and new[1] == new[2] != value and re.fullmatch(form, new[1]), (value, out[i].text)
        if i < 4:
            assert luhn(re.sub(r"\D", "", new[1]))
        elif i < 6:
            assert iban_ok(new[1])
        assert sum(out[i][f"n_{k}"] for k in pii_feistel.KINDS) == 2
    for i, value in enumerate(LEFT):
        assert out[100 + i].text == f"id {value} end"
    again = {r.doc_id: r.text for r in pii_feistel.digest(docs_of(pairs), key="other").collect()}
    assert all(again[i] != out[i].text for i in range(len(CASES)))


def test_addresses_of_one_digit_parts(docs_of):
    out = pii_feistel.digest(docs_of([(1, "see 8.8.8.8"), (2, "see 8.8.8.8 since 2020"), (3, "dns=1.1.1.1")]))
    found = {r.doc_id: r for r in out.collect()}
    assert found[1].text == found[2].text.removesuffix(" since 2020") != "see 8.8.8.8" and "1.1.1.1" not in found[3].text
    assert all(r.n_ip == 1 for r in found.values())


def test_account_numbers_before_a_word(docs_of):
    numbers = ["BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68539007547034", "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00"]
    pairs = [(10 * i + k, f"pay {n}{tail}") for i, n in enumerate(numbers) for k, tail in enumerate(("", " EUR", " USD 5000", " A", "."))]
    found = {r.doc_id: r for r in pii_feistel.digest(docs_of(pairs)).collect()}
    for i, number in enumerate(numbers):
        new = found[10 * i].text.removeprefix("pay ")
        assert new != number and iban_ok(new)
        assert [found[10 * i + k].text for k in (1, 2, 3, 4)] == [f"pay {new}{tail}" for tail in (" EUR", " USD 5000", " A", ".")]
        assert all(found[10 * i + k].n_iban == 1 for k in range(5))


def test_one_day_in_all_its_forms(docs_of):
    text = pii_feistel.digest(docs_of([(1, "1999-12-31 31.12.1999 12/31/1999 31-12-1999")])).first().text
    iso, a, b, c = text.split()
    y, m, d = iso.split("-")
    assert (a, b, c) == (f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{d}-{m}-{y}") and date(int(y), int(m), int(d))


def test_permutation_is_one_to_one(docs_of, spark):
    ips = [f"10.0.{i // 256}.{i % 256}" for i in range(1500)]
    cards = []
    for i in range(300):
        body = f"400000000000{i:03d}"
        cards.append(body + next(c for c in "0123456789" if luhn(body + c)))
    text = pii_feistel.digest(docs_of([(1, " ".join(ips)), (2, " ".join(cards))])).orderBy("doc_id").collect()
    assert len(set(text[0].text.split())) == 1500 and text[0].n_ip == 1500
    assert len(set(text[1].text.split())) == 300 and text[1].n_card == 300 and all(map(luhn, text[1].text.split()))


def test_odd_texts_and_columns(docs_of, odd_pairs, plan):
    docs = docs_of(odd_pairs + [(50, "call +1 (415) 555-2671" + " x" * 50_000)])
    out = pii_feistel.pseudonymise(docs)
    assert out.dtypes == docs.dtypes
    assert rows(out.where("doc_id <> 50"), "doc_id", "text") == rows(docs.where("doc_id <> 50"), "doc_id", "text")
    assert "555-2671" not in out.where("doc_id = 50").first().text
    assert not re.search("Python|Arrow", plan(out))
    assert rows(pii_feistel.digest(docs_of([]))) == []
