"""Cheapest repair of conversations, by dynamic programming over runs of equal turns.

The rows of a conversation, in order of their turn, must become `(s?(ua)+)?` in initials of
their roles. A row is kept, given the role user or assistant, or deleted; rows with empty
text may be inserted anywhere. What an edit costs depends on the row's symbol only: its
role's initial and its first fault. A symbol is a min-plus matrix over the four states of
the pattern (nothing yet, after s, after u, after a). Equal consecutive symbols collapse to
a run; the costs that remain before a run follow from those after it by the matrix powers
M, M^2, M^4, .. that the binary digits of its length name, which are worked out once. Costs
are found from the last run to the first; the choices are then unrolled from first to last,
in blocks of `BLOCK` rows, each of which starts from the powers again. Of equally cheap
repairs that with the least letters (D, I, K, R) is taken. A letter fixes the next state,
and the letters fix the repaired roles, so the choice at each step is unique.

Spark deals the rows by conversation and sorts them twice over: first all symbols, without
text, then all texts. A task reads one stream; at the end of a conversation's symbols it
finds the edits, which then meet its texts one by one. No conversation is held: a task keeps
one batch of rows, and of one conversation a run-length list and a letter a row, which is
the size of its result. The hash of a conversation's repaired text has to be taken in order,
so one conversation is read by one task, however long; its sort spills to disk.

Defined results: a null role or text is one space; a null conv_id is one conversation; a
null turn comes first. Rows of one turn stand in order of role and text, so repeated rows
are adjacent and all but the first are duplicates. An initial is the first character as it
is (`User` has none of the three). A conversation without rows after the damage has zeros,
an empty audit and the hash of nothing; an empty table has no result. Texts may be of any
length. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.tables import for_python

BLANKS = " \t\n\v\f\r"
ENDS = ".!?"
#: Faults: none, no visible character, seen earlier, no sentence end.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Costs of edits; a truncated row that is not deleted costs more.
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
#: States of the pattern, and the one a row of each role leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Where an inserted or renamed row leads.
ADDED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60
#: Rows unrolled at once.
BLOCK = 4096

Costs = tuple[int, int, int, int]
Matrix = tuple[Costs, Costs, Costs, Costs]


# --- damage and faults, in DataFrame functions ---------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage; `present` is false for a row that is dropped, which keeps its conversation known."""
    blank = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"),
                                F.coalesce("text", blank).alias("text"), (F.crc32(named) % 20).alias("d"))
    present = F.col("d") != 0
    text = (F.when(F.col("d") <= 1, "").when(F.col("d") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")))
    role = F.when(~present, "").when(F.col("d") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", F.when(present, F.col("turn")).alias("turn"), role.alias("role"), text.alias("text"),
                       present.alias("present"), F.when(F.col("d") == 3, 2).otherwise(1).alias("copies"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Add `seen` (the number among equal rows of the conversation) and the first `fault`."""
    equal = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    solid = F.rtrim("text", F.lit(BLANKS))
    fault = (F.when(solid == "", BLANK).when(F.col("seen") > 1, DUPLICATE)
             .when(~F.right(solid, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(SOUND))
    return rows.withColumn("seen", F.row_number().over(equal)).withColumn("fault", fault)


# --- the cheapest edits ----------------------------------------------------------------------------------------

def symbol(initial: str, fault: int) -> tuple[str, int]:
    """What the costs of a row depend on."""
    if fault in (BLANK, DUPLICATE):
        return "", BLANK
    return (initial if initial in ("s", "u", "a") else ""), fault


def moves(state: int, sym: tuple[str, int]) -> list[tuple[str, int, int, bool]]:
    """(letter, cost, next state, whether the row is used up) of each edit, in order of letters."""
    initial, fault = sym
    after = ADDED[state]
    found = [("D", DELETE, state, True), ("I", INSERT, after, False)]
    if fault != BLANK:
        more = UNFINISHED if fault == TRUNCATED else 0
        if (state, initial) in STEP:
            found.append(("K", more, STEP[state, initial], True))
        found.append(("R", REROLE + more, after, True))
    return found


def final_costs() -> Costs:
    """Costs after the last row: rows are inserted until the pattern ends."""
    return 0, 2 * INSERT, INSERT, 0


@cache
def step(sym: tuple[str, int]) -> Matrix:
    """Least cost from each state before a row to each state after it, with inserted rows before it."""
    out = [[NEVER] * 4 for _ in STATES]
    for start in STATES:
        state, paid = start, 0
        # More than two inserted rows come back to a state.
        for _ in range(3):
            for _, cost, after, used in moves(state, sym):
                if used:
                    out[start][after] = min(out[start][after], paid + cost)
            state, paid = ADDED[state], paid + INSERT
    return tuple(map(tuple, out))


@cache
def power(sym: tuple[str, int], k: int) -> Matrix:
    """The matrix of 2^k rows of one symbol."""
    if k == 0:
        return step(sym)
    m = power(sym, k - 1)
    return tuple(tuple(min(NEVER, min(m[i][j] + m[j][x] for j in STATES)) for x in STATES) for i in STATES)


def lowered(costs: Costs) -> Costs:
    """Only differences matter for choices; small numbers repeat."""
    least = min(costs)
    return tuple(min(NEVER, c - least) for c in costs)


@lru_cache(1 << 16)
def before(sym: tuple[str, int], length: int, costs: Costs) -> Costs:
    """Costs that remain before a run, from those after it."""
    k = 0
    while length:
        if length & 1:
            m = power(sym, k)
            costs = lowered(tuple(min(m[i][j] + costs[j] for j in STATES) for i in STATES))
        length >>= 1
        k += 1
    return costs


def least_move(state: int, sym: tuple[str, int], after: Costs) -> tuple[str, int, int, bool]:
    """The first letter among the cheapest edits, before a row whose following costs are `after`."""
    own = before(sym, 1, after)
    # The costs before the row, on the scale of those after it.
    scale = min(step(sym)[state][j] + after[j] for j in STATES) - own[state]
    for move in moves(state, sym):
        _, cost, then, used = move
        if cost + (after[then] if used else own[then] + scale) == own[state] + scale:
            return move
    raise AssertionError("one edit is the cheapest")


@lru_cache(1 << 16)
def chosen(state: int, sym: tuple[str, int], after: Costs) -> tuple[bytes, int, int]:
    """Letters, cost and next state for one row, inserted rows before it included."""
    letters, paid = b"", 0
    while True:
        letter, cost, state, used = least_move(state, sym, after)
        letters, paid = letters + letter.encode(), paid + cost
        if used:
            return letters, paid, state


class Runs:
    """A conversation's symbols as runs."""

    def __init__(self) -> None:
        self.symbols: list[tuple[str, int]] = []
        self.numbers: dict[tuple[str, int], int] = {}
        self.runs, self.lengths = array("B"), array("q")

    def add(self, sym: tuple[str, int]) -> None:
        if sym not in self.numbers:
            self.numbers[sym] = len(self.symbols)
            self.symbols.append(sym)
        number = self.numbers[sym]
        if self.runs and self.runs[-1] == number:
            self.lengths[-1] += 1
        else:
            self.runs.append(number)
            self.lengths.append(1)

    def repair(self) -> tuple[bytearray, int]:
        """The letters of the cheapest edits, and their cost."""
        costs, behind = final_costs(), []
        for number, length in zip(reversed(self.runs), reversed(self.lengths), strict=True):
            behind.append(costs)
            costs = before(self.symbols[number], length, costs)
        audit, paid, state = bytearray(), 0, START
        for number, length in zip(self.runs, self.lengths, strict=True):
            sym, after = self.symbols[number], behind.pop()
            for first in range(0, length, BLOCK):
                last = min(length, first + BLOCK)
                inner = [before(sym, length - last, after)]
                for _ in range(last - first - 1):
                    inner.append(before(sym, 1, inner[-1]))
                for left in reversed(inner):
                    letters, cost, state = chosen(state, sym, left)
                    audit += letters
                    paid += cost
        # What remains is inserted.
        while final_costs()[state]:
            audit += b"I"
            paid, state = paid + INSERT, ADDED[state]
        return audit, paid


class Repaired:
    """Repaired rows, given the letters and the damaged rows one by one."""

    def __init__(self, audit: bytes) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == ord("I"):
            self.at += 1
            self.state = ADDED[self.state]
            yield NAMES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = chr(self.audit[self.at])
        self.at += 1
        if letter == "K":
            self.state = STEP[self.state, role[:1]]
            yield role, text
        elif letter == "R":
            self.state = ADDED[self.state]
            yield NAMES[self.state], text


class Conversation:
    """What is counted of one conversation while its rows pass by."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.faults = [0, 0, 0, 0]
        self.low = self.last = None
        self.turns = self.illegal = 0
        self.initial: str | None = None
        self.runs = Runs()
        self.repaired: Repaired | None = None
        self.audit, self.cost = bytearray(), 0

    def see(self, turn: int | None, initial: str, fault: int) -> None:
        """A row without its text, in order of turns."""
        self.faults[fault] += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.last
            self.last = turn
        if self.initial is not None:
            self.illegal += self.initial + initial not in LEGAL
        self.initial = initial
        self.runs.add(symbol(initial, fault))

    def edits(self) -> Repaired:
        """The repair, once all rows were seen."""
        if self.repaired is None:
            self.audit, self.cost = self.runs.repair()
            self.repaired = Repaired(self.audit)
        return self.repaired

    def facts(self) -> list[object]:
        gaps = 0 if self.low is None else self.last - self.low + 1 - self.turns
        return [self.conv_id, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost,
                self.audit.decode()]


# --- streams of sorted rows ------------------------------------------------------------------------------------

READ = ["conv_id", "pass", "turn", "role", "fault", "text"]


def ordered(conversations: DataFrame) -> DataFrame:
    """Per conversation, all rows without text (pass 0), then all with text (pass 1), by turn; one conversation in one partition.

    A dropped row is in pass 0 only, without a fault.
    """
    rows = with_faults(damaged(conversations).repartition("conv_id"))
    passes = F.when(F.col("present"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("pass", F.explode(passes)).sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "pass", F.col("turn").asc_nulls_first(), "role", "text", "seen")
    return rows.select("conv_id", "pass", "turn", "role", F.when(F.col("present"), F.col("fault")).alias("fault"),
                       F.when(F.col("pass") == 1, F.col("text")).alias("text"))


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, tuple[str, str] | None]]:
    """Each repaired row (role, text) with its conversation; then the conversation with None."""
    now: Conversation | None = None

    def ended() -> Iterator[tuple[Conversation, tuple[str, str] | None]]:
        if now is not None:
            for row in now.edits().inserted():
                yield now, row
            yield now, None

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in READ]
        for conv_id, part, turn, role, fault, text in zip(*columns, strict=True):
            if now is None or conv_id != now.conv_id:
                yield from ended()
                now = Conversation(conv_id)
            if part == 1:
                for row in now.edits().row(role, text):
                    yield now, row
            elif fault is not None:
                now.see(turn, role[:1], fault)
    yield from ended()


def _batches(rows: Iterator[list[object]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The conversations after damage and repair: conv_id, place (from 0), role, text."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[object]]:
        place = 0
        for conversation, row in walked(batches):
            if row is None:
                place = 0
            else:
                yield [conversation.conv_id, place, *row]
                place += 1

    return for_python(ordered(conversations)).mapInArrow(
        lambda batches: _batches(rows(batches), schema), "conv_id long, place long, role string, text string")


def digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and letters of its repair, and the hash of the repaired rows."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in counts], ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[object]]:
        digest, first = hashlib.sha256(), True
        for conversation, row in walked(batches):
            if row is None:
                yield [*conversation.facts(), digest.hexdigest()]
                digest, first = hashlib.sha256(), True
            else:
                digest.update(("" if first else "\n").encode() + f"{row[0]}:{row[1]}".encode())
                first = False

    return for_python(ordered(conversations)).mapInArrow(
        lambda batches: _batches(rows(batches), schema),
        f"conv_id long, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string")


def _text(col: str) -> str:
    return f"rtrim({col}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _moved(options: list[str]) -> str:
    return f"list_min([{', '.join(options)}])"


def _plus(state: str, cost: str, letters: str, text: str) -> str:
    return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{letters}', r := {state}.r || {text})"


def _closed(at: str) -> dict[int, str]:
    """Each state with up to two rows inserted: user after start, s and a; assistant after u."""
    user, assistant, no = "chr(10) || 'user:'", "chr(10) || 'assistant:'", "struct_pack(c := CAST(999999999 AS BIGINT), a := '', r := '')"
    return {
        0: f"{at}.s0", 1: f"{at}.s1",
        2: _moved([f"{at}.s2", _plus(f"{at}.s0", "5", "I", user), _plus(f"{at}.s1", "5", "I", user), _plus(f"{at}.s3", "5", "I", user), no]),
        3: _moved([f"{at}.s3", _plus(f"{at}.s2", "5", "I", assistant), _plus(f"{at}.s0", "10", "II", f"{user} || {assistant}"),
                   _plus(f"{at}.s1", "10", "II", f"{user} || {assistant}"), no]),
    }


def _next() -> str:
    """The states after a row: the least (cost, letters) of each, from the closed states of `q` and the row `x`."""
    line = "chr(10) || x.role || ':' || x.text"
    out = []
    for state in STATES:
        options = [_plus(f"q.q{state}", "2", "D", "''")]
        for start in STATES:
            for initial in "sua":
                if STEP.get((start, initial)) == state:
                    options.append(f"CASE WHEN x.keep AND x.role[1] = '{initial}' THEN " + _plus(f"q.q{start}", "x.more", "K", line) + " END")
            if ADDED[start] == state:
                options.append("CASE WHEN x.keep THEN " + _plus(
                    f"q.q{start}", "1 + x.more", "R", f"chr(10) || '{NAMES[state]}:' || x.text") + " END")
        out.append(f"{_moved(options)} AS s{state}")
    return ", ".join(out)


_BIT = "CASE WHEN {v} % 2 = 1 THEN xor({v} // 2, 3988292384) ELSE {v} // 2 END"

ORACLE_SQL = f"""
WITH RECURSIVE
t0 AS (SELECT CAST(range AS BIGINT) AS n, CAST(range AS BIGINT) AS v, 0 AS k FROM range(256)
       UNION ALL SELECT n, {_BIT.format(v="v")}, k + 1 FROM t0 WHERE k < 8),
crc_table AS MATERIALIZED (SELECT list(v ORDER BY n) AS t FROM t0 WHERE k = 8),
keys AS MATERIALIZED (SELECT DISTINCT coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
                      FROM conversations),
crc AS MATERIALIZED (SELECT k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
           range(1, len(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT))),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 20 AS d FROM keys, crc_table),
d AS (SELECT conv_id, turn, d, CASE WHEN d = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
             CASE d WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
             unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM conversations JOIN crc ON k = coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen, {_text("text")} AS solid FROM d),
x AS MATERIALIZED (SELECT *, row_number() OVER w AS i, role[1] AS initial, lag(role[1]) OVER w AS prior,
             CASE WHEN solid = '' THEN 1 WHEN seen > 1 THEN 2 WHEN solid[-1] NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
             fault NOT IN (1, 2) AS keep, CASE fault WHEN 3 THEN 5 ELSE 0 END AS more
      FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen)),
ids AS MATERIALIZED (SELECT DISTINCT conv_id FROM conversations),
p AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(c := CAST(0 AS BIGINT), a := '', r := '') AS s0,
             {", ".join(f"struct_pack(c := CAST(999999999 AS BIGINT), a := '', r := '') AS s{k}" for k in (1, 2, 3))} FROM ids
      UNION ALL
      SELECT q.conv_id, x.i, {_next()}
      FROM (SELECT conv_id, i, {", ".join(f"{v} AS q{k}" for k, v in _closed("p").items())} FROM p) q
      JOIN x ON x.conv_id IS NOT DISTINCT FROM q.conv_id AND x.i = q.i + 1),
ends AS (SELECT conv_id, list_min([p.s0, {_closed("p")[3]}]) AS best FROM p
         WHERE i = (SELECT count(*) FROM x WHERE x.conv_id IS NOT DISTINCT FROM p.conv_id)),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                 count(*) FILTER (fault = 3) AS truncated,
                 count(*) FILTER (prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal
          FROM x GROUP BY conv_id)
SELECT ids.conv_id, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
       best.c AS cost, best.a AS audit, sha256(best.r[2:]) AS repaired_sha256
FROM ids JOIN ends ON ids.conv_id IS NOT DISTINCT FROM ends.conv_id
LEFT JOIN facts ON ids.conv_id IS NOT DISTINCT FROM facts.conv_id
"""
