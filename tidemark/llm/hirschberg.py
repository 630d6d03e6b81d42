"""Cheapest edits of a row of roles, by divide and conquer over four states.

A repaired conversation is empty or an optional system message followed by
pairs of user and assistant. Reading it takes four states: nothing yet, after
the system message, after a user, after an assistant. Each message gets one
edit (Keep, Rerole, Delete), with Inserts in front of it; these letters, in
order, are the audit.

A stretch of messages is an ``Element``: the least cost from each entry state to
each exit state and, for each entry, the order of the least audits to its exits.
Elements compose, so a stretch may stand for one message or a million. Edits of
one message never are the beginning of another's (they end in K, R or D, and
only there), so audits of the same messages compare edit by edit, and audits
that end in different states differ: the order is all that the choice of a
crossing needs.

``crossings`` is Hirschberg's method: costs forward from the entry and backward
from the exit meet in the middle, the crossing of least cost is taken, of
several the one whose left audit is least, and both halves go on by themselves.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

STATES = 4
FAR = 1 << 60
# Fixed values of the contract.
RELABEL, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
NEXT_ROLE = ("user", "user", "assistant", "user")
END = "E"  # closes a conversation: its exit is always state 0
MUST_GO = "D"


@dataclass(frozen=True)
class Element:
    cost: tuple[tuple[int, ...], ...]  # by entry, exit
    order: tuple[tuple[int, ...], ...]  # of the least audits from one entry

    def flat(self) -> list[int]:
        return [x for part in (self.cost, self.order) for row in part for x in row]

    @classmethod
    def of(cls, flat: list[int]) -> Element:
        rows = [tuple(flat[i : i + STATES]) for i in range(0, 2 * STATES * STATES, STATES)]
        return cls(tuple(rows[:STATES]), tuple(rows[STATES:]))


def message_class(initial: str, must_go: bool, cut_off: bool) -> str:
    """One letter for what the edits of a message depend on."""
    if must_go:
        return MUST_GO
    known = initial if initial in ("s", "u", "a") else "x"
    return known.upper() if cut_off else known


def _step(state: int, symbol: str) -> int | None:
    return STEP.get((state, symbol))


@lru_cache(maxsize=None)
def edits(kind: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(entry, exit): least cost and, among the cheapest, the least letters of one message's edits."""
    found: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(entry: int, leave: int | None, cost: int, letters: str) -> None:
        if leave is not None and (cost, letters) < found.get((entry, leave), (FAR, "")):
            found[entry, leave] = (cost, letters)

    for entry in range(STATES):
        state = entry
        for inserts in range(3):  # a third would only lead back
            cost, letters = INSERT * inserts, "I" * inserts
            if kind == END:
                offer(entry, 0 if state in ENDS else None, cost, letters)
            else:
                offer(entry, state, cost + DELETE, letters + "D")
            if kind not in (END, MUST_GO):
                extra = CUT_OFF if kind.isupper() else 0
                offer(entry, _step(state, kind.lower()), cost + extra, letters + "K")
                offer(entry, _step(state, NEXT_ROLE[state][0]), cost + extra + RELABEL, letters + "R")
            state = _step(state, NEXT_ROLE[state][0])
    return found


@lru_cache(maxsize=None)
def element(kind: str) -> Element:
    found = edits(kind)
    cost, order = [], []
    for e in range(STATES):
        exits = sorted((found[e, s][1], s) for s in range(STATES) if (e, s) in found)
        place = {s: i for i, (_, s) in enumerate(exits)}
        cost.append(tuple(found[e, s][0] if (e, s) in found else FAR for s in range(STATES)))
        order.append(tuple(place.get(s, STATES) for s in range(STATES)))
    return Element(tuple(cost), tuple(order))


def _forward(costs, order, after: Element):
    """Costs and order of audits of the states behind one more element."""
    out_cost, keys = [FAR] * STATES, []
    for s in range(STATES):
        best = (FAR, STATES, STATES)
        for m in range(STATES):
            cost = costs[m] + after.cost[m][s]
            if cost < FAR:
                best = min(best, (cost, order[m], after.order[m][s]))
        out_cost[s] = best[0]
        if best[0] < FAR:
            keys.append((best[1], best[2], s))
    place = {s: i for i, (_, _, s) in enumerate(sorted(keys))}
    return out_cost, [place.get(s, STATES) for s in range(STATES)]


def _from(entry: int):
    return [0 if s == entry else FAR for s in range(STATES)], [0 if s == entry else STATES for s in range(STATES)]


def compose(elements: list[Element]) -> Element:
    """One element for all of them, in order."""
    cost, order = [], []
    for e in range(STATES):
        costs, places = _from(e)
        for x in elements:
            costs, places = _forward(costs, places, x)
        cost.append(tuple(costs))
        order.append(tuple(places))
    return Element(tuple(cost), tuple(order))


def crossings(elements: list[Element], entry: int, leave: int) -> list[int]:
    """The states before each element and behind the last one, on the cheapest path of the least audit."""
    states = [entry] + [leave] * len(elements)

    def halve(lo: int, hi: int) -> None:
        if hi - lo < 2:
            return
        mid = (lo + hi) // 2
        costs, order = _from(states[lo])
        for x in elements[lo:mid]:
            costs, order = _forward(costs, order, x)
        rest = [0 if s == states[hi] else FAR for s in range(STATES)]
        for x in reversed(elements[mid:hi]):
            rest = [min(FAR, *(x.cost[s][m] + rest[m] for m in range(STATES))) for s in range(STATES)]
        states[mid] = min(range(STATES), key=lambda s: (costs[s] + rest[s], order[s]))
        halve(lo, mid)
        halve(mid, hi)

    halve(0, len(elements))
    return states


@lru_cache(maxsize=1 << 14)
def _solved(kinds: str, entry: int, leave: int) -> tuple[int, tuple[str, ...], tuple[int, ...]]:
    states = crossings([element(k) for k in kinds], entry, leave)
    chosen = [edits(k)[states[i], states[i + 1]] for i, k in enumerate(kinds)]
    return sum(c for c, _ in chosen), tuple(x for _, x in chosen), tuple(states)


def solve(kinds: str, entry: int = 0, leave: int = 0) -> tuple[int, tuple[str, ...], tuple[int, ...]]:
    """(cost, edits of each message, states) of a stretch; short ones are remembered."""
    return _solved(kinds, entry, leave) if len(kinds) <= 32 else _solved.__wrapped__(kinds, entry, leave)


def repaired(roles: list[str], texts: list[str], letters: tuple[str, ...], states: tuple[int, ...]) -> list[tuple[str, str]]:
    """The messages that the edits leave or add; an edit behind the last message belongs to the end."""
    out = []
    for i, edit in enumerate(letters):
        state = states[i]
        for x in edit:
            role = NEXT_ROLE[state]
            if x == "I":
                out.append((role, ""))
                state = _step(state, role[0])
            elif x == "R":
                out.append((role, texts[i]))
            elif x == "K":
                out.append((roles[i], texts[i]))
    return out
