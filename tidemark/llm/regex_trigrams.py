"""Boolean trigram queries of regular expressions (the idea of Russ Cox's code search).

A query is an AND of clauses, a clause an OR of trigram sets: any text that a regex matches holds, for every clause,
all trigrams of one of its sets. Only what a match must contain is used: runs of literals, with alternatives, small
classes and optional parts multiplied out; whatever else stands between (classes, open repetitions) ends a run. Runs
of which some alternative is shorter than a trigram say nothing. Everything is lower-cased, so a query suits an index
of lower-cased texts whether a regex ignores case or not.
"""

from __future__ import annotations

from re import _constants as sre
from re import _parser as sre_parser

MOST = 64                # alternatives of a run before it is ended

Clause = frozenset[frozenset[str]]


def query(pattern: str) -> list[Clause]:
    """The clauses of a regex; an empty list if it has no mandatory trigram."""
    clauses: list[Clause] = []
    run = _walk(sre_parser.parse(pattern), {""}, clauses)
    _end(run, clauses)
    return clauses


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i: i + 3] for i in range(len(text) - 2))


def _end(run: set[str], clauses: list[Clause]) -> set[str]:
    if run and min(map(len, run)) >= 3:
        sets = {trigrams(x) for x in run}
        clause = frozenset(x for x in sets if not any(y < x for y in sets))
        if clause not in clauses:
            clauses.append(clause)
    return {""}


def _times(run: set[str], alternatives: set[str], clauses: list[Clause]) -> set[str]:
    if len(run) * len(alternatives) > MOST:
        run = _end(run, clauses)
    return {a + b for a in run for b in alternatives}


def _walk(items, run: set[str], clauses: list[Clause]) -> set[str]:
    for op, arg in items:
        exact = _exact([(op, arg)])
        if exact is not None:
            run = _times(run, exact, clauses)
        elif op is sre.SUBPATTERN:
            run = _walk(arg[3], run, clauses)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
            run = _end(_walk(arg[2], run, clauses), clauses)      # once for certain
        elif op is not sre.AT:
            run = _end(run, clauses)
    return run


def _exact(items) -> set[str] | None:
    """All lower-cased strings that a part matches, if they are few; None otherwise."""
    out = {""}
    for op, arg in items:
        if op is sre.LITERAL:
            more = {chr(arg).lower()}
        elif op is sre.IN and all(k is sre.LITERAL for k, _ in arg):
            more = {chr(c).lower() for _, c in arg}
        elif op is sre.SUBPATTERN:
            more = _exact(arg[3])
        elif op is sre.BRANCH:
            parts = [_exact(x) for x in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] is not sre.MAXREPEAT and arg[1] <= 8:
            once = _exact(arg[2])
            more = set() if once is not None else None
            for n in range(arg[0], arg[1] + 1) if once is not None else ():
                power = {""}
                for _ in range(n):
                    power = {a + b for a in power for b in once}
                    if len(power) > MOST:
                        return None
                more |= power
        else:
            more = None
        if more is None or len(out) * len(more) > MOST:
            return None
        out = {a + b for a in out for b in more}
    return out
