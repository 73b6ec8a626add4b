r"""Chat formatting of records in different layouts.

The nested field paths of a record, sorted and hashed, are its layout's fingerprint; the fingerprint selects a declarative mapping
(``LAYOUTS``) that turns the record into canonical turns. Paths that no layout names don't count, so extra fields do no harm; a
record whose fields fit several layouts at once takes the one with the most fields, the first of equals. Fields without a value count only
if those with one fit no layout, so a wide table's empty columns don't choose, and a null text stays an empty turn. Records are read one by one, so
one table may hold all layouts.

The template writes a turn as ``### role: text</turn>`` and a line break. A backslash before each ``\``, ``#`` and ``<`` of a text
(and ``:`` of a role) makes the marks unique and is taken away on reading, so texts may hold any marks. Each turn is a segment of its
own, formatted where its record is read; a conversation's formatted text is its segments in order. The loss mask of a segment is the
span of an assistant's text. Reading back takes a sorted stream of segments with running digests, so a task holds one batch however
long a conversation is.

Defined cases: a null text or role is empty. Turns of one conversation are ordered by their number (null first), then role and text;
repeated rows stay. Rows without a conversation id are one conversation with a null id. A record of no known layout has no turns and
is reported by ``unmapped``. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.columns import named

ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """How the turns of a record are found. Paths are joined by dots; ``[]`` stands for each element of an array.

    ``turns`` lists (role, paths): a turn of a fixed role whose text is the non-empty fields, parted by an empty line. ``each`` names
    an array whose elements are turns with the fields ``role`` and ``text``; without ``each``, the record itself is one turn of a
    conversation. ``names`` translates roles.
    """

    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    order: str = ""
    names: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        inner = [f"{self.each}[].{p}" if self.each else p for p in (self.role, self.text) if p]
        return sorted({p for _, paths in self.turns for p in paths} | set(inner) | ({self.order} if self.order else set()))


_SPEAKERS = (("human", "user"), ("gpt", ASSISTANT), ("bot", ASSISTANT), ("ai", ASSISTANT))
LAYOUTS = (
    Layout(role="role", text="text", order="turn"),
    Layout(turns=(("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Layout(turns=(("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    Layout(turns=(("user", ("question",)), (ASSISTANT, ("answer",)))),
    Layout(turns=(("user", ("instruction",)), (ASSISTANT, ("output",)))),
    Layout(turns=(("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Layout(turns=(("system", ("system",)), ("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Layout(each="messages", role="role", text="content"),
    Layout(each="conversations", role="from", text="value", names=_SPEAKERS),
    Layout(each="conversation.turns", role="speaker", text="utterance", names=_SPEAKERS),
    Layout(turns=(("system", ("system",)),), each="messages", role="role", text="content"),
)


def field_paths(value, prefix: str = "", nulls: bool = True) -> set[str]:
    """Paths of the leaf fields of a record, or of those that have a value."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k, nulls) for k, v in value.items())) if value else set()
    if isinstance(value, list):
        return set().union(*(field_paths(v, prefix + "[]", nulls) for v in value)) if value else {prefix + "[]"}
    return {prefix} if nulls or value is not None else set()


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


_KNOWN = {p for layout in LAYOUTS for p in layout.paths()}
_BY_PRINT = {fingerprint(layout.paths()): layout for layout in reversed(LAYOUTS)}


@lru_cache(maxsize=10_000)
def layout_of(paths: frozenset[str]) -> Layout | None:
    known = {p for p in paths if p in _KNOWN}
    found = _BY_PRINT.get(fingerprint(known))
    if found is None:
        fits = [layout for layout in LAYOUTS if known.issuperset(layout.paths())]
        found = max(fits, key=lambda layout: len(layout.paths()), default=None)
    return found


def _layout(record: dict) -> Layout | None:
    """The layout of the fields that have a value; if none fits, among those that all fields fit the one with the most
    such fields, then the fewest others."""
    filled = frozenset(field_paths(record, nulls=False))
    found = layout_of(filled)
    if found is None:
        known = frozenset(p for p in field_paths(record) if p in _KNOWN)
        fits = [layout for layout in LAYOUTS if known.issuperset(layout.paths())]
        found = max(fits, key=lambda layout: (len(filled.intersection(layout.paths())), -len(layout.paths())), default=None)
    return found


def _get(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict) -> list[tuple[int | None, str, str]] | None:
    """Number, role and text of the turns of a record; None if its layout is not known."""
    layout = _layout(record)
    if layout is None:
        return None
    names, out = dict(layout.names), []
    for role, paths in layout.turns:
        texts = [t for p in paths if (t := _text(_get(record, p)))]
        if texts or role != "system":
            out.append((role, "\n\n".join(texts)))
    if layout.each:
        for item in _get(record, layout.each) or []:
            role = _text(_get(item, layout.role))
            out.append((names.get(role, role), _text(_get(item, layout.text))))
    elif layout.role:
        return [(_get(record, layout.order), _text(_get(record, layout.role)), _text(_get(record, layout.text)))]
    return [(i, role, text) for i, (role, text) in enumerate(out)]


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and the span of its text where it counts for the loss (else an empty one)."""
    head = "### " + re.sub(r"([\\#<:])", r"\\\1", role) + ": "
    body = re.sub(r"([\\#<])", r"\\\1", text)
    start = len(head)
    return f"{head}{body}</turn>\n", start, start + len(body) if role == ASSISTANT else start


_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return out


def format_records(records: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``conv_id, turn, role, segment, loss_start, loss_end``: a row for each turn of each record, whatever the records' layouts."""
    rows = records.select(F.col(id_col).alias("conv_id"), F.to_json(F.struct(*[named(c) for c in records.columns if c != id_col]), {"ignoreNullFields": "false"}).alias("record"))
    return format_json(rows)


def format_json(rows: DataFrame) -> DataFrame:
    """As ``format_records``, of rows ``conv_id, record`` with a record as JSON text."""
    names = ["conv_id", "turn", "role", "segment", "loss_start", "loss_end"]

    def convert(batches):
        for batch in batches:
            ids, out = batch.column("conv_id"), [[] for _ in range(5)]
            take = []
            for i, record in enumerate(batch.column("record")):
                for number, role, text in turns_of(json.loads(record.as_py() or "{}")) or []:
                    take.append(i)
                    for column, value in zip(out, (number, role, *segment(role, text))):
                        column.append(value)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(take, pa.int64())), *(pa.array(c, k) for c, k in zip(out, kinds))], names)

    kind = rows.schema["conv_id"].dataType.simpleString()
    return map_batches(rows, convert, f"conv_id {kind}, turn bigint, role string, segment string, loss_start bigint, loss_end bigint")


def unmapped(rows: DataFrame) -> DataFrame:
    """The rows ``conv_id, record`` whose layout is not known, with their fingerprint."""

    def look(batches):
        for batch in batches:
            prints = []
            for record in batch.column("record"):
                value = json.loads(record.as_py() or "{}")
                prints.append(fingerprint(field_paths(value)) if turns_of(value) is None else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*batch.schema.names, "fingerprint"])

    schema = rows.withColumn("fingerprint", F.lit(None).cast("string")).schema
    return map_batches(rows, look, schema).where(F.col("fingerprint").isNotNull())


def assemble(segments: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans`` with one row per conversation, for conversations that fit a row."""
    parts = segments.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "segment", "loss_start", "loss_end"))).alias("_p"))
    before = F.transform("_p", lambda p, i: F.aggregate(F.slice("_p", 1, i), F.lit(0).cast("bigint"), lambda a, x: a + F.length(x["segment"])))
    spans = F.transform(F.arrays_zip("_p", before.alias("_b")), lambda z: F.struct((z["_b"] + z["_p"]["loss_start"]).alias("start"), (z["_b"] + z["_p"]["loss_end"]).alias("end")))
    return parts.select("conv_id", F.array_join("_p.segment", "").alias("formatted"), F.filter(spans, lambda s: s["end"] > s["start"]).alias("loss_spans"))


def digest(segments: DataFrame) -> DataFrame:
    """One row per conversation with digests of what is read back from its segments."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches):
        current, state, out = None, None, []

        def close():
            n, turns, loss_chars, loss, chars = state
            out.append((n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def table(ids):
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)]
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns], names)

        ids = []
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for key, text, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end"))):
                if state is None or key != current:
                    if state is not None:
                        close()
                        ids.append(current)
                    current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{content}\n".encode())
                loss = unescape(text[start:end])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(text)
            if out:
                yield table(ids)
                ids, out = [], []
        if state is not None:
            close()
            ids.append(current)
            yield table(ids)

    kind = segments.schema["conv_id"].dataType.simpleString()
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment").select("conv_id", "segment", "loss_start", "loss_end")
    return map_batches(ordered, read, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


#: A conversation whose texts look like the template's own marks.
TRICKY_ID, TRICKY_TEXT = -7, "\\### Assistant: </turn> ok"


def with_tricky(conversations: DataFrame) -> DataFrame:
    rows = [(TRICKY_ID, 0, "user", TRICKY_TEXT), (TRICKY_ID, 1, ASSISTANT, TRICKY_TEXT)]
    extra = conversations.sparkSession.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### : </turn>') + 1 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g'))
                + length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
