"""Conversation structure repair: the cheapest edits that make a conversation alternate, found by divide and conquer.

A repaired conversation's role initials read ``(s?(ua)+)?``. Between turns it is in one of four states,
and a turn, with the turns inserted before it, takes it from state to state at a cost. Hirschberg's scheme
keeps two vectors of four costs instead of a table: forward ones from the start and backward ones from the end
meet in the middle, the crossing is fixed, and each half is solved on its own.

Of the cheapest audits the least in ASCII counts. A forward vector therefore also ranks the audits that lead to
its states. A crossing lies right after a turn's own letter, never after an inserted one, so no audit up
to a crossing begins another, and the ranks decide between crossings of one cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.spark import shuffle_parts, written

# What edits cost, and their letters.
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
ADDED = [USER, USER, ASSISTANT, USER]  # what an inserted or rerolled turn leads to: there is one choice only
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60

INITIALS = "sua"
FORCED, OPEN_END = 4, 8  # added to the place of the initial in INITIALS (3: another one) to make a turn's code
_TEXT_BYTES = 1 << 20
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def _inserted(state: int) -> list[tuple[int, int]]:
    """(state, inserted turns) reachable by insertions; going round again would only cost more."""
    found = [(state, 0)]
    while (after := ADDED[found[-1][0]]) not in [s for s, _ in found]:
        found.append((after, found[-1][1] + 1))
    return found


def _step(code: int) -> list[list[tuple[int, str]]]:
    """Cheapest (cost, letters) from state to state over one turn of that code."""
    table = [[(FAR, "")] * 4 for _ in STATES]
    late = UNFINISHED * bool(code & OPEN_END)
    initial = (INITIALS + "-")[code & 3]
    for state in STATES:
        for at, n in _inserted(state):
            ways = [(at, DELETE, "D")]
            if not code & FORCED:
                ways.append((ADDED[at], REROLE + late, "R"))
                if initial in NEXT[at]:
                    ways.append((NEXT[at][initial], late, "K"))
            for to, cost, letter in ways:
                table[state][to] = min(table[state][to], (INSERT * n + cost, "I" * n + letter))
    return table


STEPS = [_step(code) for code in range(16)]
# From each state to the end: a conversation ends empty or after an assistant turn.
ENDS = [min((INSERT * n, "I" * n) for at, n in _inserted(s) if at == ASSISTANT or s == at == START) for s in STATES]

Vector = tuple[list[int], list[int]]  # costs and ranks by state
Turn = tuple[int, int]  # a code and how often the turn follows itself; more than once only where it must go


def forward(turns: Sequence[Turn], vector: Vector) -> Vector:
    """Costs and audit ranks of all states after some turns. Of equal turns that must go all but the last go first."""
    costs, ranks = vector
    for code, n in turns:
        step, best = STEPS[code], []
        for to in STATES:
            best.append(min((costs[s] + step[s][to][0], ranks[s], step[s][to][1]) for s in STATES))
        order = sorted(x[1:] for x in best if x[0] < FAR)
        costs = [x[0] + DELETE * (n - 1) if x[0] < FAR else FAR for x in best]
        ranks = [order.index(x[1:]) if x[0] < FAR else 4 for x in best]
    return costs, ranks


def backward(turns: Sequence[Turn], costs: list[int]) -> list[int]:
    """What it costs from each state before some turns to an end that costs as given."""
    for code, n in reversed(turns):
        step = STEPS[code]
        costs = [min(FAR, min(step[s][to][0] + costs[to] for to in STATES) + DELETE * (n - 1)) for s in STATES]
    return costs


def only(state: int) -> list[int]:
    return [0 if s == state else FAR for s in STATES]


def crossing(vector: Vector, costs: list[int]) -> int:
    """The state of least cost from both sides; of several the one with the least audit so far."""
    return min((vector[0][s] + costs[s], vector[1][s], s) for s in STATES)[2]


def solve(turns: Sequence[Turn], start: int, end: int) -> Iterator[tuple[str, int]]:
    """The letters of each turn and the state before it: the least of the cheapest audits between two states."""
    open_parts = [(0, len(turns), start, end)]
    while open_parts:
        low, high, before, after = open_parts.pop()
        if high - low == 1:
            code, n = turns[low]
            yield "D" * (n - 1) + STEPS[code][before][after][1], before
        elif high > low:
            middle = (low + high) // 2
            met = crossing(forward(turns[low:middle], (only(before), [0] * 4)), backward(turns[middle:high], only(after)))
            open_parts += [(middle, high, met, after), (low, middle, before, met)]


def chain(matrices: list[list[Vector]]) -> tuple[int, list[int]]:
    """(cost, states at the bounds) of pieces that follow each other, each given as forward vectors of all starts."""
    vectors = [(only(START), [0] * 4)]
    for rows in matrices:
        costs, ranks = vectors[-1]
        best = [min((min(FAR, costs[s] + rows[s][0][to]), ranks[s], rows[s][1][to]) for s in STATES) for to in STATES]
        order = sorted(x[1:] for x in best if x[0] < FAR)
        vectors.append(([x[0] for x in best], [order.index(x[1:]) if x[0] < FAR else 4 for x in best]))
    ends = [cost for cost, _ in ENDS]
    states = [crossing(vectors[-1], ends)]
    for vector, rows in zip(vectors[-2::-1], matrices[::-1]):
        states.append(crossing(vector, [rows[s][0][states[-1]] for s in STATES]))
    return vectors[-1][0][states[0]] + ends[states[0]], states[::-1]


# ---------------------------------------------------------------------- Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the CRC of conv_id and turn; null texts and roles are a space."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        shown("role").alias("role"), shown("text").alias("text"), fault.alias("fault"),
    ).filter("fault <> 0")
    text = (
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_")).drop("_")


def _coded(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n, code): equal rows as one; of a repeated text of a role only the first may stay."""
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    counted = given.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    said = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role"), "role", "text")
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"))
    seen = written(counted.withColumns({"said": F.unhex(F.sha2(said, 256)), "last": last, "place": place}), "turns")
    first = seen.groupBy("said").agg(F.min("place").alias("first"))
    forced = (F.col("last") == "") | (F.col("place") > F.col("first"))
    initial = F.instr(F.lit(INITIALS), F.left("role", F.lit(1)))
    initial = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    code = initial + F.when(forced, FORCED).otherwise(F.when(F.col("last").isin(*".!?"), 0).otherwise(OPEN_END))
    coded = seen.join(first, "said").withColumn("code", code.cast("int"))
    return coded.select("conv_id", "turn", "role", "text", "n", "code", (F.col("last") == "").alias("blank"))


def _turns(code: int, n: int) -> list[Turn]:
    """A row and its repetitions, which must go."""
    if code & FORCED:
        return [(code, n)]
    return [(code, 1), *([(code & 3 | FORCED, n - 1)] if n > 1 else [])]


_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}
_MATRIX = "costs array<long>, ranks array<int>"
_PIECE = (
    "conv_id long, part int, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    f"low long, high long, turns long, {_MATRIX}"
)


def _groups(batches: Iterator[pa.RecordBatch], names: list[str], keys: int = 1) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows that follow each other with the same first columns, without holding more than a batch of them."""
    rows = (row for batch in batches for row in zip(*(batch.column(name).to_pylist() for name in names)))
    return groupby(rows, key=lambda row: row[:keys])


def _packed(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch of the given Spark columns."""
    fields = [part.split() for part in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a piece of a conversation adds to its counts, and its costs and ranks from every state to every state."""
    done: list[tuple] = []
    for (conv, _), rows in _groups(batches, ["conv_id", "part", "turn", "role", "n", "code", "blank"], 2):
        blank = duplicate = truncated = illegal = turns = 0
        first = last = low = high = None
        vectors = [(only(s), [0] * 4) for s in STATES]
        for _, part, turn, role, n, code, empty in rows:
            seen = _turns(code, n)
            vectors = [forward(seen, v) for v in vectors]
            if empty:
                blank += n
            else:
                duplicate += n - (not code & FORCED)
                truncated += bool(code & OPEN_END)
            initial = role[:1]
            illegal += n - 1 + (last is not None and last + initial not in ("su", "ua", "au"))
            first, last = initial if first is None else first, initial
            if turn is not None and turn != high:
                low, high, turns = turn if low is None else low, turn, turns + 1
        costs, ranks = ([x for v in vectors for x in v[i]] for i in (0, 1))
        done.append((conv, part, blank, duplicate, truncated, illegal, first, last, low, high, turns, costs, ranks))
        if len(done) >= 4096:
            yield _packed(done, _PIECE)
            done = []
    yield _packed(done, _PIECE)


_TOTALS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_BOUNDS = f"conv_id long, part int, start int, end int, {_TOTALS}"


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a conversation's pieces in order: its totals, and the states at the bounds of each piece."""
    names = [part.split()[0] for part in _PIECE.split(", ")]
    done: list[tuple] = []
    for (conv,), given in _groups(batches, names):
        pieces = [dict(zip(names, row)) for row in given]
        matrices = [[(p["costs"][4 * s : 4 * s + 4], p["ranks"][4 * s : 4 * s + 4]) for s in STATES] for p in pieces]
        cost, states = chain(matrices)
        total = {name: sum(p[name] for p in pieces) for name in ("blank", "duplicate", "truncated", "illegal", "turns")}
        numbered = [p for p in pieces if p["low"] is not None]
        for a, b in zip(pieces, pieces[1:]):
            total["illegal"] += a["last"] + b["first"] not in ("su", "ua", "au")
        total["turns"] -= sum(a["high"] == b["low"] for a, b in zip(numbered, numbered[1:]))
        gaps = numbered[-1]["high"] - numbered[0]["low"] + 1 - total["turns"] if numbered else 0
        for i, p in enumerate(pieces):
            done.append((
                conv, p["part"], states[i], states[i + 1], gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost,
            ))
        if len(done) >= 4096:
            yield _packed(done, _BOUNDS)
            done = []
    yield _packed(done, _BOUNDS)


_SOLVED = "conv_id long, part int, at int, audit string, repaired string"


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and repaired turns of every piece, in rows of about _TEXT_BYTES."""
    done: list[tuple] = []
    size = 0
    for (conv, _), given in _groups(batches, ["conv_id", "part", "role", "text", "n", "code", "start", "end"], 2):
        turns: list[Turn] = []
        said: list[tuple[str, str]] = []
        for _, part, role, text, n, code, start, end in given:
            for turn in _turns(code, n):
                turns.append(turn)
                said.append((role, text) if not turn[0] & FORCED else ("", ""))
        at, audit, lines, held = 0, [], [], 0
        for (role, text), (letters, state) in zip(said, solve(turns, start, end)):
            audit.append(letters)
            for letter in letters:
                if letter == "K":
                    lines.append(f"{role}:{text}")
                elif letter in "IR":
                    state = ADDED[state]
                    lines.append(f"{NAMES[state]}:{text if letter == 'R' else ''}")
            held += len(text)
            if held > _TEXT_BYTES:
                done.append((conv, part, at, "".join(audit), "\n".join(lines) if lines else None))
                size, at, audit, lines, held = size + held, at + 1, [], [], 0
            if size > 8 * _TEXT_BYTES:
                yield _packed(done, _SOLVED)
                done, size = [], 0
        done.append((conv, part, at, "".join(audit), "\n".join(lines) if lines else None))
        size += held + 64
    yield _packed(done, _SOLVED)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, at, audit, repaired, end, gaps, blank, duplicate, truncated, illegal, cost): the repaired turns.

    A conversation's rows, in the order of part and at, give its audit and its text when put one after the
    other, texts with a newline between; the totals stand in each of them.

    Turns come in the order of their numbers, those without one first; turns of one number come in the order
    of role and text, so equal rows are neighbours. Rows without conv_id make up one conversation;
    null roles and texts are a space. Columns beyond the four named ones are left aside.

    Conversations are cut into pieces by ranges of (conv_id, turn, role, text), so a long one spreads over
    tasks. A piece first gives its costs and ranks from each state to each state, sixteen numbers each;
    along a conversation they fix the states at the bounds of its pieces, which are then solved separately.
    """
    parts = shuffle_parts(conversations)
    order = ["conv_id", "turn", "role", "text"]
    laid = _coded(conversations).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid = written(laid.withColumn("part", F.spark_partition_id()), "pieces")
    dealt = laid.repartition(parts, "part").sortWithinPartitions("part", *order)
    pieces = dealt.select("conv_id", "part", "turn", "role", "n", "code", "blank").mapInArrow(_summaries, _PIECE)
    lined = pieces.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part")
    chained = written(lined.mapInArrow(_chained, _BOUNDS), "bounds")
    bounds = chained.select(F.col("conv_id").alias("conv"), F.col("part").alias("of"), "start", "end")
    with_bounds = laid.join(bounds, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("of")))
    dealt = with_bounds.repartition(parts, "part").sortWithinPartitions("part", *order)
    solved = dealt.select("conv_id", "part", "role", "text", "n", "code", "start", "end").mapInArrow(_solved, _SOLVED)
    known = chained.withColumnsRenamed({"conv_id": "conv", "part": "of"}).drop("start")
    joined = solved.join(known, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("of")))
    return joined.drop("conv", "of")


_DIGEST = f"conv_id long, {_TOTALS}, audit string, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation; its text passes through the digest and is never held whole."""
    totals = [part.split()[0] for part in _TOTALS.split(", ")]
    done: list[tuple] = []
    for (conv,), rows in _groups(batches, ["conv_id", "audit", "repaired", "end", *totals]):
        digest, audit, began = hashlib.sha256(), [], False
        for _, letters, text, end, *numbers in rows:
            audit.append(letters)
            if text is not None:
                digest.update((("\n" if began else "") + text).encode())
                began = True
        state = end
        for _ in ENDS[end][1]:
            state = ADDED[state]
            digest.update((("\n" if began else "") + f"{NAMES[state]}:").encode())
            began = True
        audit.append(ENDS[end][1])
        done.append((conv, *numbers, "".join(audit), digest.hexdigest()))
        if len(done) >= 4096:
            yield _packed(done, _DIGEST)
            done = []
    yield _packed(done, _DIGEST)


def audit(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of all conversations.

    ``repaired`` comes from ``repair``, of rows of these conversations; those it has no rows of get zeros.
    """
    parts = shuffle_parts(conversations)
    lined = repaired.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "at")
    found = lined.mapInArrow(_digests, _DIGEST).withColumnRenamed("conv_id", "conv")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")]
    return joined.select("conv_id", *numbers, *texts)
