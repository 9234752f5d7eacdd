"""Repaired conversations against a search that keeps every audit as a string."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from parcelflow.llm import turn_edits, turn_repair
from parcelflow.llm.expected_sql import ORACLE
from parcelflow.llm.queries import QUERIES
from parcelflow.llm.turn_edits import END, TAIL, least_edits
from tests.compare import database, difference

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may follow the last written initial


def finish(best):
    ends = []
    for last, (cost, audit, out) in best.items():
        for extra in range(3):
            if last in ("", "a"):
                ends.append((cost, audit, out))
            role = "assistant" if last == "u" else "user"
            last, cost, audit, out = role[0], cost + 2, audit + "I", (*out, f"{role}:")
    return min(ends)


def search(rows):
    best = {"": (0, "", ())}
    for initial, cut, gone, role, text in rows:
        after = {}
        for last, (cost, audit, out) in best.items():
            for _ in range(4):
                moves = [(last, cost + 3, audit + "D", out)]
                new = "assistant" if last == "u" else "user"
                if not gone:
                    moves.append((new[0], cost + 2 + cut, audit + "R", (*out, f"{new}:{text}")))
                    if initial and initial in NEXT[last]:
                        moves.append((initial, cost + cut, audit + "K", (*out, f"{role}:{text}")))
                for state, *rest in moves:
                    after[state] = min(after.get(state, tuple(rest)), tuple(rest))
                last, cost, audit, out = new[0], cost + 2, audit + "I", (*out, f"{new}:")
        best = after
    return finish(best)


def figures(rows):
    """Expected figures of the rows (turn, role, text) of one conversation."""
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()),
    )
    counts, seen, judged = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        judged.append((role[:1], fault == "truncated", fault in ("blank", "duplicate"), role, text))
    initials = [r[0] for r in judged]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, out = search(judged)
    return (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()), out


def test_edits_equal_search():
    rng = random.Random(3)
    for i in range(1500):
        kinds = bytes(rng.randrange(9) for _ in range(rng.randrange(150) if i % 15 == 0 else rng.randrange(9)))
        rows = [("suax"[(k - 1) // 2] if k else "x", (k - 1) % 2 if k else 0, not k, "", "") for k in kinds]
        letters, state = least_edits(kinds)
        cost, audit, _ = search(rows)
        assert "".join(letters) + TAIL[state] == audit
        assert turn_edits.backward(END, kinds)[turn_edits.NOTHING] == cost


def test_blocks_meet_in_the_states_of_the_whole():
    rng = random.Random(4)
    for _ in range(300):
        kinds = bytes(rng.randrange(9) for _ in range(rng.randrange(1, 60)))
        cuts = [0, *sorted(rng.sample(range(1, len(kinds) + 1), min(4, len(kinds)))), len(kinds)]
        blocks = [kinds[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]
        audit, state = "", turn_edits.NOTHING
        for block, (before, goal) in zip(blocks, turn_edits.crossings([turn_edits.summary(b) for b in blocks]), strict=True):
            assert before == state
            letters, state = least_edits(block, before, goal)
            audit += "".join(letters)
        whole, last = least_edits(kinds)
        assert (audit, state) == ("".join(whole), last)
    assert turn_edits.crossings([]) == []


def test_long_conversations_take_linear_space():
    kinds = bytes(random.Random(5).randrange(9) for _ in range(20_000))
    letters, _ = least_edits(kinds)
    assert len(letters) == len(kinds)


TEXTS = ["Yes.", "No", "", None, " \n", "Why? ", "Well!", "cut off\t", "é."]
ROLES = ["system", "user", "assistant", "tool", None, "", "User"]


def turns_of(seed, conversations, rows):
    rng = random.Random(seed)
    return [
        (c if c else None, rng.choice([None, *range(12)]), rng.choice(ROLES[:3] * 3 + ROLES), rng.choice(TEXTS))
        for c in range(conversations)
        for _ in range(rng.randrange(rows))
    ]


def frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string, row string, fault string, part string, digest string"
    return spark.createDataFrame([(*r, "?", "?", "?", "?") for r in rows], schema)


@pytest.mark.parametrize("seed,conversations,rows", [(1, 60, 9), (2, 3, 700)])
def test_figures_and_repairs(spark, seed, conversations, rows):
    turns = turns_of(seed, conversations, rows)
    by_id = {}
    for c, *row in turns:
        by_id.setdefault(c, []).append(row)
    found = turn_repair.repair_figures(frame(spark, turns)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == {c: figures(x)[0] for c, x in by_id.items()}
    assert len(found) == len(by_id)
    written = {}
    for r in turn_repair.repair_conversations(frame(spark, turns)).collect():
        written.setdefault(r.conv_id, {})[r.position] = f"{r.role}:{r.text}"
    for c, rows_ in by_id.items():
        out = figures(rows_)[1]
        assert written.get(c, {}) == dict(enumerate(out))


def test_a_conversation_over_many_ranges(spark):
    rng = random.Random(9)
    texts = [f"{i}." for i in range(3000)]
    turns = [(7, i, rng.choice(ROLES[:4]), texts[i]) for i in range(3000)] + [(8, 0, "user", "Hi.")]
    rows = turn_repair.find_faults(turn_repair.plain_turns(frame(spark, turns)))
    assert rows.selectExpr("row >> 33 as part").distinct().count() > 1
    found = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair_figures(frame(spark, turns)).collect()}
    assert found[7] == figures([t[1:] for t in turns if t[0] == 7])[0]


def test_empty_table(spark):
    assert turn_repair.repair_figures(frame(spark, [])).collect() == []
    assert turn_repair.repair_conversations(frame(spark, [])).collect() == []


def test_damage(spark):
    turns = [(c, t, "assistant" if t % 2 else None, f"a{t}. b!") for c in range(20) for t in range(10)] + [(None, None, "user", None)]
    wanted = []
    for c, t, role, text in turns:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = [c, t, " " if role is None else role, " " if text is None else text]
        if fault == 1:
            row[3] = ""
        if fault == 2:
            row[3] = row[3].replace(".", "").replace("!", "")
        if fault == 4:
            row[2] = "user"
        wanted += [tuple(row)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    got = [tuple(r) for r in turn_repair.damage(frame(spark, turns)).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_query_equals_sql(spark, tables):
    name = "op12_turn_repair"
    assert difference(QUERIES[name](spark, tables), database(tables), ORACLE[name]) is None
