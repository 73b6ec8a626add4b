r"""Repair of conversation structure by an auction for shortest paths.

A sound conversation is empty, or an optional system turn followed by pairs of a user and an assistant turn. Each row is kept (cost 0), given
the role that fits (2) or deleted (3); empty turns may be put in anywhere (2 each); a cut-off text costs 1 unless its row goes; blank rows and
repeats must go. Rows and the four states of that grammar span a lattice of integer costs whose shortest path is the cheapest repair.

The auction keeps a price at every node, never above the cost that is left, and a path from the start. If the cheapest arc out of the
path's end (cost plus price of its head) is dearer than the end's price, the price rises to it and the path contracts by a node; else the
path extends along that arc, the least in ASCII order of equal ones. An arc of a shortest path out of a node of the path stays tight at every price,
so the first path to arrive is the cheapest, and the least among these. Lattices are auctioned 32 rows at a time from the end, with the
prices found so far as the next ones' final prices, which keeps the work in proportion to the rows; then the edits are traced forwards.

A range exchange by conversation, turn, role and text deals the rows, so a conversation of any size is spread over tasks. Conversations inside
one task are solved there. Of the others every block of 5,000 rows first yields the costs between its entry and exit states; a stream
backwards over these few numbers gives the prices at the end of every block, and a stream forwards over the blocks traces the edits and writes the
turns. Only that last stream, which a running digest needs in order, takes a long conversation through one task, a block at a time.

Defined cases: a null role or text is one space. Rows of one turn are ordered by role, then text; equal rows are repeats of the first. A null
conversation id is a conversation of its own; null turns come first. A role whose first letter is none of s, u, a can't be kept. Conversations
without rows have an empty repair. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from claimtrail.llm.arrow import map_batches
from claimtrail.llm.merkle import CRC32
from claimtrail.sources.scratch import settle

BLANKS = r"[\x20\x09-\x0D]"
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
RELABEL, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
FAR = 1 << 60  # the price of a state that cannot be left any more
#: Cost of the turns that must follow a conversation's last row, by state.
FINAL = (0, 2 * INSERT, INSERT, 0)
STEP = 32  # rows of a lattice that are auctioned together
BLOCK = 5_000
BLOCK_CHARS = 4 << 20
COPIES = 1_000

_AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the state after a turn that fits
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}


def _arcs(code: str) -> list[list[tuple[int, int, str]]]:
    """For each state the ways through one row: cost, state after it, edits, in ASCII order of the edits.

    ``code`` is the role's initial (``o``: any other), upper case for a cut-off text, or ``x`` for a row that must go.
    """
    found = []
    for state in range(4):
        ways, cost, edits, at = [], 0, "", state
        for _ in range(3 if state in (START, SYSTEM) else 2):  # more insertions would come back to a state
            ways.append((edits + "D", cost + DELETE, at))
            if code != "x":
                paid = cost + CUT_OFF * code.isupper()
                if (at, code.lower()) in _KEPT:
                    ways.append((edits + "K", paid, _KEPT[at, code.lower()]))
                ways.append((edits + "R", paid + RELABEL, _AFTER[at]))
            cost, edits, at = cost + INSERT, edits + "I", _AFTER[at]
        found.append([(c, s, e) for e, c, s in sorted(ways)])
    return found


ARCS = {code: _arcs(code) for code in "suaoSUAOx"}


@lru_cache(maxsize=100_000)
def _auction(codes: str, final: tuple[int, ...]) -> tuple[tuple[int, str, int], ...]:
    """From each state in front of some rows: the least cost, its edits (the ASCII-least) and the state after them.

    ``final`` are the prices of the states behind the rows. The four auctions share one set of prices.
    """
    n, arcs = len(codes), [ARCS[c] for c in codes]
    prices = [[min(final)] * 4 for _ in codes] + [list(final)]
    out = []
    for start in range(4):
        states, edits = [start], []
        while (at := len(edits)) < n:
            state, onward = states[-1], prices[at + 1]
            cheapest, head, edit = FAR, None, ""
            for cost, to, label in arcs[at][state]:
                if cost + onward[to] < cheapest:
                    cheapest, head, edit = cost + onward[to], to, label
            if cheapest > prices[at][state]:  # contract
                prices[at][state] = cheapest
                if at:
                    states.pop()
                    edits.pop()
            elif head is None:  # nothing leads on from the start
                break
            else:
                states.append(head)
                edits.append(edit)
        out.append((prices[0][start], "".join(edits), states[-1]))
    return tuple(out)


def _steps(codes: str) -> list[str]:
    return [codes[i : i + STEP] for i in range(0, len(codes), STEP)]


def _lowered(final: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    low = min(final)
    return low, tuple(min(p - low, FAR) if p < FAR else FAR for p in final)


def _solved(codes: str, final: tuple[int, ...]) -> tuple[tuple[int, ...], list]:
    """Prices of the states in front of the rows, and the steps' auctions, last step first."""
    done = []
    for part in reversed(_steps(codes)):
        low, relative = _lowered(final)
        found = _auction(part, relative)
        done.append(found)
        final = tuple(cost + low if cost < FAR else FAR for cost, _, _ in found)
    return final, done


def cheapest(codes: str, state: int = START, final: tuple[int, ...] = FINAL) -> tuple[str, int]:
    """The edits of the cheapest way from ``state`` through the rows, without what follows the last row, and the state after it."""
    _, done = _solved(codes, final)
    edits = []
    for found in reversed(done):
        _, part, state = found[state]
        edits.append(part)
    return "".join(edits), state


def between(codes: str) -> list[int]:
    """Least costs from each state before the rows to each state after them, row by row."""
    columns = [_solved(codes, tuple(0 if e == exit_ else FAR for e in range(4)))[0] for exit_ in range(4)]
    return [columns[exit_][entry] for entry in range(4) for exit_ in range(4)]


def ending(state: int) -> str:
    """Edits that end a conversation after its last row."""
    return "I" * (FINAL[state] // INSERT)


def cost_of(codes: str, edits: str) -> int:
    kept = [(c, e) for c, e in zip(codes, edits.replace("I", ""))]
    return INSERT * edits.count("I") + sum(DELETE if e == "D" else RELABEL * (e == "R") + CUT_OFF * c.isupper() for c, e in kept)


def applied(edits: str, state: int, rows):
    """The turns that edits leave of ``rows`` of (turn, role, text): edit, turn, role, text."""
    rows = iter(rows)
    for edit in edits:
        if edit == "I":
            state = _AFTER[state]
            yield edit, None, NAMES[state], ""
            continue
        turn, role, text = next(rows)
        if edit == "R":
            state = _AFTER[state]
            yield edit, turn, NAMES[state], text
        elif edit == "K":
            state = _KEPT[state, role[:1]]
            yield edit, turn, role, text


# ---- rows in Spark


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` without repeats, with ``copies``, what is wrong with the first copy, and its code."""
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    hashes = [F.xxhash64("conv_id", "role", "text"), F.xxhash64(F.lit(1), "text", "role", "conv_id")]
    rows = settle(rows.withColumns({"h1": hashes[0], "h2": hashes[1]}), "turns")
    first = rows.groupBy("h1", "h2").agg(F.min(F.struct("turn")).alias("first"))
    rows = rows.join(first, ["h1", "h2"])
    last = F.regexp_extract("text", f"([^\\x20\\x09-\\x0D]){BLANKS}*\\z", 1)
    blank = last == ""
    repeated = ~blank & (F.struct("turn") > F.col("first"))
    cut = ~blank & ~repeated & ~last.isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    code = F.when(blank | repeated, "x").otherwise(F.when(initial.isin("s", "u", "a"), initial).otherwise("o"))
    rows = rows.withColumns({"blank": blank, "repeated": repeated, "cut_off": cut})
    return rows.withColumn("code", F.when(cut, F.upper(code)).otherwise(code)).drop("h1", "h2", "first")


def counts(rows: DataFrame) -> DataFrame:
    """Gaps in the turn numbers and numbers of faults of every conversation, from ``faults``."""

    def rows_if(flag: str) -> Column:
        return F.sum(F.when(F.col(flag), F.col("copies")).otherwise(0))

    more = F.sum(F.when(~F.col("blank") & ~F.col("repeated"), F.col("copies") - 1).otherwise(0))
    turns = rows.groupBy("conv_id", "turn").agg(
        rows_if("blank").alias("blank"), (rows_if("repeated") + more).alias("duplicate"), F.count_if("cut_off").alias("truncated")
    )
    return turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated")],
    )


class _Part:
    """Rows of one conversation in a row, within a task."""

    def __init__(self, conv):
        self.conv, self.codes, self.rows, self.size = conv, [], [], 0

    def add(self, turn, role, text, copies, code):
        self.codes.append(code + "x" * (copies - 1))
        self.rows.extend([(turn, role, text)] * copies)
        self.size += len(text or "")


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def _initials(rows) -> str:
    return "".join(role[:1] or " " for _, role, _ in rows)


def _deal(rows: DataFrame) -> DataFrame:
    """Rows of ``faults`` by range; many copies of a row are several rows."""
    rows = rows.withColumn("piece", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
    rows = rows.withColumn("code", F.when(F.col("piece") == 0, F.col("code")).otherwise("x"))
    rows = rows.withColumn("copies", F.least(F.lit(COPIES), F.col("copies") - COPIES * F.col("piece")).cast("int"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "piece")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("conv_id", "turn", "role", "text", "copies", "code", "piece").repartitionByRange(n, *order).sortWithinPartitions(*order).drop("piece")


def _blocks(rows: DataFrame) -> DataFrame:
    """The blocks of all conversations in order, each with its rows, codes and costs; ``whole`` if it is a whole conversation."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = T.StructType.fromDDL(
        f"conv_id {kinds['conv_id']}, segment int, block int, whole boolean, codes string, rows array<struct<turn: {kinds['turn']}, role: string, text: string>>, costs array<bigint>"
    )

    def run(batches):
        segment, types = TaskContext.get().partitionId(), None

        held, size = [], 0

        def done(part: _Part, number: int, whole: bool):
            nonlocal size
            codes = "".join(part.codes)
            rows = [dict(zip(("turn", "role", "text"), r)) for r in part.rows]
            held.append((part.conv, segment, number, whole, codes, rows, None if whole else between(codes)))
            size += part.size + 100 * len(rows)

        def blocks():
            nonlocal size
            out = pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], f.type) for i, f in enumerate(types)], schema=types)
            held.clear()
            size = 0
            return out

        part, number, opened = None, 0, False  # opened: the conversation has no earlier rows
        for batch in batches:
            if types is None:
                fields = {f.name: f.type for f in batch.schema}
                turn = pa.struct([("turn", fields["turn"]), ("role", pa.string()), ("text", pa.string())])
                types = pa.schema([
                    ("conv_id", fields["conv_id"]), ("segment", pa.int32()), ("block", pa.int32()), ("whole", pa.bool_()),
                    ("codes", pa.string()), ("rows", pa.list_(turn)), ("costs", pa.list_(pa.int64())),
                ])
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if part is None or conv != part.conv:
                    if part is not None:
                        done(part, number, opened)
                    opened, number = part is not None, 0
                    part = _Part(conv)
                elif len(part.rows) >= BLOCK or part.size >= BLOCK_CHARS:
                    done(part, number, False)
                    opened, number = False, number + 1
                    part = _Part(conv)
                part.add(*row)
                if size >= BLOCK_CHARS:
                    yield blocks()
        if part is not None:
            done(part, number, False)  # it may go on in the next task
            yield blocks()

    return map_batches(rows, run, schema)


def _prices(cut: DataFrame) -> DataFrame:
    """``conv_id, segment, block, final``: the prices of the states at the end of each block of a conversation in several."""
    rows = cut.select("conv_id", "segment", "block", "costs")
    schema = T.StructType([*rows.drop("costs").schema.fields, T.StructField("final", T.ArrayType(T.LongType()))])
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("segment"), F.desc("block"))

    def run(batches):
        last, final = None, FINAL
        for batch in batches:
            found = []
            for conv, costs in zip(batch.column("conv_id").to_pylist(), batch.column("costs").to_pylist()):
                if last is None or conv != last[0]:
                    final = FINAL
                found.append(list(final))
                final = tuple(min(min(costs[4 * entry + e] + final[e] for e in range(4)), FAR) for entry in range(4))
                last = (conv,)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))], names=schema.names)

    return map_batches(rows, run, schema)


def _traced(rows: DataFrame) -> DataFrame:
    """All blocks with the prices at their end, whole conversations first; each task's blocks of a conversation in order."""
    blocks = settle(_blocks(_deal(rows)), "blocks")
    cut = blocks.where("not whole")
    prices = _prices(cut)
    final = F.array(*[F.lit(p).cast("bigint") for p in FINAL])
    names = ["conv_id", "segment", "block", "codes", "rows", "final"]
    keyed = cut.join(prices.select("segment", "block", F.col("conv_id").alias("_conv"), "final"), ["segment", "block"]).where(F.col("conv_id").eqNullSafe(F.col("_conv")))
    keyed = keyed.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "segment", "block")
    return blocks.where("whole").withColumn("final", final).select(*names).unionByName(keyed)


def _conversations(batches):
    """Streams of (codes, rows, edits, state in front, the last block of its conversation) by conversation."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "codes", "rows", "final")))

    for conv, blocks in groupby(rows(), key=lambda r: r[0]):

        def stream(blocks=blocks):
            state = START
            for _, codes, held, final in blocks:
                edits, after = cheapest(codes, state, tuple(final))
                yield codes, [(r["turn"], r["role"], r["text"]) for r in held], edits, state
                state = after
            yield "", [], ending(state), state

        yield conv, stream()


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The turns of all repaired conversations: ``conv_id``, ``place`` from 0 on, ``edit`` (K, R or I), the ``turn`` it had, ``role`` and ``text``."""
    found = faults(rows)
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    schema = T.StructType.fromDDL(f"conv_id {kinds['conv_id']}, place bigint, edit string, turn {kinds['turn']}, role string, text string")

    def run(batches):
        for conv, stream in _conversations(batches):
            place = 0
            for _, held, edits, state in stream:
                turns = list(applied(edits, state, held))
                if turns:
                    columns = [[conv] * len(turns), range(place, place + len(turns)), *zip(*turns)]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c)) if i in (1, 2, 4, 5) else _typed(c, kinds["conv_id" if i == 0 else "turn"]) for i, c in enumerate(columns)], names=schema.names)
                place += len(turns)

    return map_batches(_traced(found), run, schema)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}


def _typed(values, kind: str) -> pa.Array:
    return pa.array(list(values), _TYPES.get(kind))


def repairs(found: DataFrame) -> DataFrame:
    """``conv_id, illegal, cost, audit, repaired_sha256`` of every conversation with rows, from ``faults``."""
    kind = found.schema["conv_id"].dataType.simpleString()
    schema = T.StructType.fromDDL(f"conv_id {kind}, illegal bigint, cost bigint, audit string, repaired_sha256 string")

    def run(batches):
        out = []
        for conv, stream in _conversations(batches):
            sha, first, last, illegal, cost, audit = hashlib.sha256(), True, "", 0, 0, []
            for codes, held, edits, state in stream:
                initials = last + _initials(held)
                illegal, last = illegal + _illegal(initials), initials[-1:]
                cost += cost_of(codes, edits)
                audit.append(edits)
                for _, _, role, text in applied(edits, state, held):
                    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            out.append((conv, illegal, cost, "".join(audit), sha.hexdigest()))
            if len(out) == 500:
                yield _rows_of(out, kind, schema.names)
                out = []
        if out:
            yield _rows_of(out, kind, schema.names)

    return map_batches(_traced(found), run, schema)


def _rows_of(out: list, kind: str, names: list[str]) -> pa.RecordBatch:
    conv, *rest = zip(*out)
    return pa.RecordBatch.from_arrays([_typed(conv, kind), *(pa.array(list(c)) for c in rest)], names=names)


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """What is wrong with every conversation and how it is repaired; one row for each of ``conversations``, by default those with rows."""
    marked = settle(faults(rows), "faults")
    found = counts(marked).withColumnRenamed("conv_id", "_a")
    fixed = repairs(marked).withColumnRenamed("conv_id", "_b")
    ids = (rows if conversations is None else conversations).select("conv_id").distinct()
    out = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_a")), "left").join(fixed, F.col("conv_id").eqNullSafe(F.col("_b")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


# ---- the registered query


def damaged(rows: DataFrame) -> DataFrame:
    """A twentieth each of the rows dropped, emptied, without full stops, repeated, and given the role user; nulls become one space."""
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    rows = rows.withColumn("fault", fault).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))})
    return rows.withColumn("copy", F.explode(F.expr("if(fault = 3, array(0, 1), array(0))"))).drop("fault", "copy")


def digest(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations), conversations)


def _best(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


def _went(start: str, cost: str, edit: str, turn: str | None = None, condition: str = "TRUE") -> str:
    text = f"{start}.t" + (f" || chr(10) || {turn}" if turn else "")
    return f"CASE WHEN {start} IS NOT NULL AND {condition} THEN {{'c': {start}.c + {cost}, 'a': {start}.a || '{edit}', 't': {text}}} END"


def _turn(start: str, role: str, initial: str) -> list[str]:
    keep = _went(start, "cut", "K", "role || ':' || text", f"NOT gone AND left(role, 1) = '{initial}'")
    return [keep, _went(start, "2 + cut", "R", f"'{role}:' || text", "NOT gone")]


def _inserted(start: str, role: str) -> str:
    return _went(start, "2", "I", f"'{role}:'")


def _delete(start: str) -> str:
    return _went(start, "3", "D")


SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, {CRC32.format("name")} % 20 AS f FROM keyed
), after AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE f <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS earlier,
         regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS ending
  FROM after
), checked AS (
  SELECT *, ending = '' AS blank, ending <> '' AND seen > 1 AS again, ending = '' OR seen > 1 AS gone,
         CASE WHEN ending <> '' AND seen = 1 AND ending NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut
  FROM placed
), path AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS rn, {{'c': 0, 'a': '', 't': ''}} AS v0, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS vs,
         NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS vu, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS va FROM after
  UNION ALL
  SELECT conv_id, rn, {_delete("v0")}, {_best(_delete("vs"), _went("v0", "cut", "K", "role || ':' || text", "NOT gone AND left(role, 1) = 's'"))},
         {_best(_delete("iu"), *_turn("v0", "user", "u"), *_turn("vs", "user", "u"), *_turn("ia", "user", "u"))},
         {_best(_delete("ia"), *_turn("iu", "assistant", "a"))}
  FROM (
    SELECT *, {_best("va", _inserted("iu", "assistant"))} AS ia FROM (
      SELECT p.conv_id, c.rn, v0, vs, vu, va, role, text, gone, cut,
             {_best("vu", _inserted("v0", "user"), _inserted("vs", "user"), _inserted("va", "user"))} AS iu
      FROM path p JOIN checked c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.rn = p.rn + 1
    )
  )
), last AS (
  SELECT conv_id, {_best("v0", "va", _inserted("iu", "assistant"))} AS best FROM (
    SELECT *, {_best("vu", _inserted("vs", "user"))} AS iu FROM path
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY rn DESC) = 1
  )
), numbers AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again) AS duplicate, sum(cut) AS truncated, count(*) FILTER (rn > 1 AND earlier || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM checked GROUP BY conv_id
)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN numbers n ON n.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN last l ON l.conv_id IS NOT DISTINCT FROM i.conv_id
"""
