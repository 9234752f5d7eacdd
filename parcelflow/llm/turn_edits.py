"""Cheapest edits that give a conversation's roles the form ``(s?(ua)+)?``, by divide and conquer in linear space.

A row of a conversation is one small number, its *kind*: 0 where it must be deleted, else its role initial and whether it is cut off.
Edits are K (keep, 0), R (rerole to user or assistant, 2), D (delete, 3) and I (insert a user or assistant turn, 2); a cut-off row that is
not deleted adds 1. What was written so far matters only as one of four states: nothing, after the system turn, after a user turn, after an
assistant turn. So an edit's letter fixes its effect, and equal letters mean equal repairs.

A cost vector holds, for the four states, the cost of the cheapest edits and the rank of the ASCII-least of them. Edits are grouped by the row they
end at (insertions go with the row that follows), so of two different ones up to a row neither begins the other, and ranks are
all it takes to compare: no vector holds letters. ``least_edits`` walks forward over the first half of the rows and backward
over the second; where they meet, the cheapest crossing of the least rank is on the best path; both halves are solved the same way.
Vectors also compose: ``summary`` describes a block of rows for any state before it, ``crossings`` chooses the states between blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INITIALS = "sua"
FAR = 1 << 60
START = ((0, 0), (FAR, 0), (FAR, 0), (FAR, 0))
# After the last row: insertions that complete the form, and their cost.
TAIL = ("", "II", "I", "")
END = (0, 4, 2, 0)

Vector = Sequence[tuple[int, int]]  # (cost, rank) by state


def kind_of(initial: str, cut_off: bool, deleted: bool) -> int:
    """The number of a row: 0 to be deleted, then two for each of s, u, a and any other initial."""
    at = INITIALS.index(initial) if initial and initial in INITIALS else len(INITIALS)
    return 0 if deleted else 1 + 2 * at + int(cut_off)


def inserted(state: int) -> int:
    """The state after the one turn that may be inserted (or a row reroled to) in this state."""
    return ASSISTANT if state == USER else USER


def kept(state: int, initial: str) -> int | None:
    """The state after keeping a row, None where its role may not follow."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def _moves(kind: int) -> tuple[tuple[tuple[int, int, str], ...], ...]:
    """For each state before a row: (state after, cost, letters) of the best edits that end with the row."""
    initial, cut_off = ("suax"[(kind - 1) // 2], (kind - 1) % 2) if kind else ("x", 0)
    table = []
    for before in STATES:
        best: dict[int, tuple[int, str]] = {}
        state, cost, letters = before, 0, ""
        for _ in range(3):  # a third insertion comes back to where the first led
            options = [(state, 3, "D")]
            if kind:
                options.append((inserted(state), 2 + cut_off, "R"))
                after = kept(state, initial)
                if after is not None:
                    options.append((after, cut_off, "K"))
            for after, more, letter in options:
                candidate = (cost + more, letters + letter)
                best[after] = min(best.get(after, candidate), candidate)
            state, cost, letters = inserted(state), cost + 2, letters + "I"
        table.append(tuple((after, *found) for after, found in best.items()))
    return tuple(table)


MOVES = tuple(_moves(kind) for kind in range(9))


def _ranked(best: dict) -> Vector:
    """(cost, *order) by state as (cost, rank)."""
    rank = {order: i for i, order in enumerate(sorted({found[1:] for found in best.values()}))}
    return [(best[s][0], rank[best[s][1:]]) if s in best else (FAR, 0) for s in STATES]


def forward(vector: Vector, kinds: Sequence[int]) -> Vector:
    """The vector after these rows, from the one before them."""
    for kind in kinds:
        best: dict[int, tuple[int, int, str]] = {}
        for state in STATES:
            cost, rank = vector[state]
            if cost < FAR:
                for after, more, letters in MOVES[kind][state]:
                    candidate = (cost + more, rank, letters)
                    if after not in best or candidate < best[after]:
                        best[after] = candidate
        vector = _ranked(best)
    return vector


def backward(goal: Sequence[int], kinds: Sequence[int]) -> Sequence[int]:
    """The cost to go from each state before these rows, from the cost after them."""
    for kind in reversed(kinds):
        goal = [min(more + goal[after] for after, more, _ in MOVES[kind][state]) for state in STATES]
    return goal


def _from(state: int) -> Vector:
    return [(0, 0) if s == state else (FAR, 0) for s in STATES]


def _to(state: int) -> Sequence[int]:
    return tuple(0 if s == state else FAR for s in STATES)


def least_edits(kinds: bytes, state: int = NOTHING, goal: Sequence[int] = END) -> tuple[list[str], int]:
    """(letters by row, state after the last row) of the ASCII-least of the cheapest edits of all rows."""
    if len(kinds) <= 64:
        letters, last = _least_of_few(bytes(kinds), state, tuple(goal))
        return list(letters), last
    return _halve(kinds, state, goal)


def _halve(kinds: bytes, state: int, goal: Sequence[int]) -> tuple[list[str], int]:
    if not kinds:
        return [], state
    if len(kinds) == 1:
        cost, letters, after = min((more + goal[s], letters, s) for s, more, letters in MOVES[kinds[0]][state])
        return [letters], after
    first, second = kinds[: len(kinds) // 2], kinds[len(kinds) // 2 :]
    left, right = forward(_from(state), first), backward(goal, second)
    _, _, middle = min((left[s][0] + right[s], left[s][1], s) for s in STATES)
    before, _ = least_edits(first, state, _to(middle))
    after, last = least_edits(second, middle, goal)
    return before + after, last


@lru_cache(maxsize=1 << 14)
def _least_of_few(kinds: bytes, state: int, goal: tuple[int, ...]) -> tuple[tuple[str, ...], int]:
    letters, last = _halve(kinds, state, goal)
    return tuple(letters), last


def summary(kinds: Sequence[int]) -> list[Vector]:
    """The vector after a block of rows, for each state before it."""
    return [forward(_from(state), kinds) for state in STATES]


def crossings(blocks: Sequence[list[Vector]], goal: Sequence[int] = END) -> list[tuple[int, Sequence[int]]]:
    """(state before, goal after) of each block of a conversation, from the blocks' summaries in order."""
    if not blocks:
        return []
    goals = [goal]
    for block in reversed(blocks[1:]):
        goals.append([min(min(cost + goals[-1][s], FAR) for s, (cost, _) in enumerate(block[state])) for state in STATES])
    found, state = [], NOTHING
    for block, after in zip(blocks, reversed(goals), strict=True):
        _, _, chosen = min((cost + after[s], rank, s) for s, (cost, rank) in enumerate(block[state]))
        found.append((state, _to(chosen)))
        state = chosen
    found[-1] = (found[-1][0], goal)
    return found
