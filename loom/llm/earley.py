"""Error-correcting Earley parsing of role sequences: the cheapest edits that make a sequence fit a weighted grammar.

Symbols, one a turn: the role's initial s, u or a (o: any other) of a sound turn, in capitals where its text is truncated, and 0 to 3 (in
the order s, u, a, o) where the turn has to go. Every chart item keeps the least (cost, audit) of its derivations.
"""

from __future__ import annotations

from functools import lru_cache

KEEP, REROLE, INSERT, DELETE, TRUNCATED = 0, 3, 3, 4, 3
INITIALS = "suao"
#: What may follow what: initials of neighbours.
LEGAL = {"su", "ua", "au"}

#: How far a dialogue is. Complete: nothing was said yet, or an assistant spoke last.
STATES = ("empty", "opened", "asked", "answered")
COMPLETE = ("empty", "answered")

#: (s?(ua)+)? with error productions: a turn is deleted, given another role, or put in. Left-recursive, so that all chart items of
#: a stretch begin where it begins and their number does not grow. The state in which a stretch begins also makes nothing at all.
GRAMMAR = {
    "empty": (("empty", "delete"),),
    "opened": (("empty", "s"), ("opened", "delete")),
    "asked": (*((before, turn) for before in ("empty", "opened", "answered") for turn in ("u", "rerole", "insert")), ("asked", "delete")),
    "answered": (("asked", "a"), ("asked", "rerole"), ("asked", "insert"), ("answered", "delete")),
}

Links = dict[tuple[str, str], tuple[int, str]]


def _dotted() -> tuple[list, list, dict]:
    """Of each dotted production, numbered so that the next number is the dot moved on: what it makes, the symbol after the dot; and starts."""
    makes, after, starts = [], [], {}
    for left, productions in GRAMMAR.items():
        for right in productions:
            starts.setdefault(left, []).append(len(makes))
            makes += [left] * (len(right) + 1)
            after += [*right, None]
    return makes, after, starts


_MAKES, _AFTER, _STARTS = _dotted()


def _scans(symbol: str) -> dict[str, tuple[int, str]]:
    """What a turn may be read as, with cost and audit."""
    out = {"delete": (DELETE, "D")}
    if not symbol.isdigit():
        more = TRUNCATED if symbol.isupper() else 0
        out |= {"rerole": (REROLE + more, "R"), symbol.lower(): (KEEP + more, "K")}
    return out


@lru_cache(200_000)
def links(symbols: str, start: str = "empty") -> Links:
    """(start, state): the least (cost, audit) of edits of symbols that lead from start to each state that can be reached.

    A chart holds, for each place between turns, items (dotted production, place where it began). Least values are found by
    relaxing until nothing improves; two turns put in without need only add cost, so this ends.
    """
    charts: list[dict] = [{(d, 0): (0, "") for state in STATES for d in _STARTS[state]}]
    waits: list[dict] = []
    for i in range(len(symbols) + 1):
        chart, waiting = charts[i], {}
        waits.append(waiting)
        agenda, made = list(chart), {}
        for d, origin in agenda:
            if _AFTER[d] in GRAMMAR:
                waiting.setdefault(_AFTER[d], []).append((d, origin))

        def relax(item: tuple[int, int], cost: int, audit: str, chart: dict = chart, agenda: list = agenda) -> None:
            old = chart.get(item)
            if old is None or (cost, audit) < old:
                chart[item] = (cost, audit)
                agenda.append(item)

        def complete(left: str, origin: int, cost: int, audit: str, made: dict = made) -> None:
            old = made.get(left)
            if origin == 0 and (old is None or (cost, audit) < old):
                made[left] = (cost, audit)
            for d, began in waits[origin].get(left, ()):
                c, a = charts[origin][d, began]
                relax((d + 1, began), c + cost, a + audit)

        if i == 0:
            complete(start, 0, 0, "")
        while agenda:
            d, origin = agenda.pop()
            cost, audit = chart[d, origin]
            if _AFTER[d] is None:
                complete(_MAKES[d], origin, cost, audit)
            elif _AFTER[d] == "insert":
                relax((d + 1, origin), cost + INSERT, audit + "I")
        if i < len(symbols):
            read, following = _scans(symbols[i]), {}
            for (d, origin), (cost, audit) in chart.items():
                if (got := read.get(_AFTER[d])) is not None:
                    following[d + 1, origin] = (cost + got[0], audit + got[1])
            charts.append(following)
    return {(start, state): value for state, value in made.items()}


def joined(a: Links, b: Links) -> Links:
    """The links of two stretches that follow each other."""
    out: Links = {}
    for (p, m), (cost, audit) in a.items():
        for q in STATES:
            if (m, q) in b:
                got = cost + b[m, q][0], audit + b[m, q][1]
                if (p, q) not in out or got < out[p, q]:
                    out[p, q] = got
    return out


def cheapest(stretches: list[Links]) -> tuple[int, str]:
    """The least (cost, audit) of the whole; neighbours are joined pair by pair, so that audits are copied few times."""
    while len(stretches) > 1:
        pairs = [joined(*stretches[i : i + 2]) if i + 1 < len(stretches) else stretches[i] for i in range(0, len(stretches), 2)]
        stretches = pairs
    return min(v for (p, q), v in stretches[0].items() if p == "empty" and q in COMPLETE) if stretches else (0, "")
