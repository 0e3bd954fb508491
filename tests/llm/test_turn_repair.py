"""Repair by divide and conquer against a plain search over whole audits."""

import hashlib
import itertools
import random
import zlib

import pytest

from tickwell.llm import turn_repair as R

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def plain(turns):
    """Counts and the least of the cheapest audits: every state keeps its best audit and repaired turns."""
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    numbers = [t for t, _, _ in turns if t is not None]
    counts = {name: faults.count(name) for name in ("blank", "duplicate", "truncated")}
    counts["gaps"] = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    counts["illegal"] = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "", ())}

    def put(into, state, found):
        if state not in into or found[:2] < into[state][:2]:
            into[state] = found
            return True
        return False

    def insertions(states):
        while any(
            put(states, after[s][c], (cost + 3, audit + "I", (*kept, name + ":")))
            for s, (cost, audit, kept) in list(states.items())
            for c, name in (("u", "user"), ("a", "assistant"))
            if c in after[s]
        ):
            pass

    for (_, role, text), fault in zip(turns, faults):
        insertions(best)
        found = {}
        for s, (cost, audit, kept) in best.items():
            put(found, s, (cost + 4, audit + "D", kept))
            if fault not in ("blank", "duplicate"):
                late = 3 * (fault == "truncated")
                if role[:1] in after[s]:
                    put(found, after[s][role[:1]], (cost + late, audit + "K", (*kept, f"{role}:{text}")))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if c in after[s]:
                        put(found, c, (cost + 3 + late, audit + "R", (*kept, f"{name}:{text}")))
        best = found
    insertions(best)
    cost, audit, kept = min(best[s] for s in ("", "a") if s in best)
    return {**counts, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest()}


def exhaustive(codes):
    """The least (cost, audit) of all edits of a few turns, insertions anywhere."""
    found = []

    def go(i, state, cost, audit):
        if i == len(codes):
            found.extend((cost + c, audit + a) for c, a in [R.ENDS[state]])
            return
        for at, n in [(state, 0), (R.ADDED[state], 1), (R.ADDED[R.ADDED[state]], 2), (R.ADDED[R.ADDED[R.ADDED[state]]], 3)]:
            base, so_far, late = cost + 3 * n, audit + "I" * n, 3 * bool(codes[i] & R.OPEN_END)
            go(i + 1, at, base + 4, so_far + "D")
            if not codes[i] & R.FORCED:
                go(i + 1, R.ADDED[at], base + 3 + late, so_far + "R")
                if (to := R.NEXT[at].get("sua-"[codes[i] & 3])) is not None:
                    go(i + 1, to, base + late, so_far + "K")

    go(0, R.START, 0, "")
    return min(found)


def solved(turns):
    cost, states = R.chain([[R.forward(turns, (R.only(s), [0] * 4)) for s in R.STATES]])
    letters = "".join(x for x, _ in R.solve(turns, states[0], states[1]))
    return cost, letters + R.ENDS[states[1]][1]


def test_small_conversations_exhaustively():
    codes = [0, 1, 2, 3, 4, 5, 8, 9, 10]
    for n in range(4):
        for chosen in itertools.product(codes, repeat=n):
            if n < 3 or hash(chosen) % 3 == 0:
                assert solved([(c, 1) for c in chosen]) == exhaustive(chosen), chosen


def test_pieces_of_a_conversation_give_what_the_whole_does():
    rng = random.Random(3)
    for _ in range(300):
        turns = [(rng.choice([0, 1, 2, 3, 8, 9, 10, 11]), 1) if rng.random() < 0.8 else (4 + rng.randint(0, 3), rng.randint(1, 3)) for _ in range(rng.randint(1, 30))]
        bounds = sorted({0, len(turns), *(rng.randint(0, len(turns)) for _ in range(3))})
        parts = [turns[a:b] for a, b in itertools.pairwise(bounds)]
        cost, states = R.chain([[R.forward(p, (R.only(s), [0] * 4)) for s in R.STATES] for p in parts])
        letters = "".join(x for p, s, e in zip(parts, states, states[1:]) for x, _ in R.solve(p, s, e))
        assert (cost, letters + R.ENDS[states[-1]][1]) == solved(turns)
        spread = [(c, 1) for c, n in turns for _ in range(n)]
        assert solved(spread) == solved(turns)


def expected(rows, kept):
    by = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in kept:
        by[conv].append((turn, role, text))
    return {conv: plain(turns) for conv, turns in by.items()}


SCHEMA = "conv_id long, turn long, role string, text string, part int, cost string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def got(df):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


ROLES = ["system", "user", "assistant", "tool", "", None, "ünd"]
TEXTS = ["Yes.", "No!", "Why?  ", "and then", "", " \t\n", None, "...", ".!? x", "ok.\x0b", "ok.\xa0"]


def test_rows_of_all_kinds(spark):
    rng = random.Random(11)
    rows = [
        (rng.choice([None, *range(40)]), rng.choice([None, *range(9), 10**15]), rng.choice(ROLES[:3] * 3 + ROLES), rng.choice(TEXTS))
        for _ in range(500)
    ]
    rows += rows[:40]  # repeated rows
    rows += [(500, t, ["user", "assistant"][t % 2], f"text {t}.") for t in range(3000)]  # one large conversation
    rows += [(501, None, "user", "same.")] * 700 + [(502, t, "user", "same.") for t in range(300)]
    rows += [(503, 0, "user", "long. " * 300_000), (503, 1, "assistant", "long. " * 300_000)]
    rows += [(conv, t, "user", "gone") for conv, t in ((c, 0) for c in range(600, 640)) if zlib.crc32(f"{conv}:{t}".encode()) % 20 == 0]
    df = frame(spark, rows).repartition(7)
    assert got(R.audit(df, R.repair(R.damaged(df)))) == expected(rows, damaged(rows))
    undamaged = [(c, t, *(" " if x is None else x for x in more)) for c, t, *more in rows]
    assert got(R.audit(df, R.repair(df))) == expected(rows, undamaged)


def test_repaired_texts_come_in_pieces(spark, monkeypatch):
    rows = [(1, t, "user", f"text {t}" * 10) for t in range(50)]
    parts = R.repair(frame(spark, rows)).orderBy("part", "at").collect()
    assert len({r["part"] for r in parts}) > 1
    whole = "\n".join(r["repaired"] for r in parts if r["repaired"]) + "\nassistant:" * (len(R.ENDS[parts[-1]["end"]][1]))
    found = plain([r[1:] for r in rows])
    assert hashlib.sha256(whole.encode()).hexdigest() == found["repaired_sha256"]


def test_empty_table(spark):
    df = frame(spark, [(1, 1, "user", "a")]).limit(0)
    assert R.audit(df, R.repair(R.damaged(df))).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query(spark, folder):
    from tickwell.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_turn_repair"](spark, folder)) == expected(rows, damaged(rows))
