"""Boolean trigram queries from regular expressions, after the design of code search.

A query is a list of clauses, all of which must hold; a clause is a set of strings, one of
which must occur in the lower-cased text. A string occurs only where all its trigrams do.
"""

from re import _constants as op
from re import _parser

MEMBERS = 5  # a class of more members than this is not followed
WIDE = 64  # more strings than this in a clause are not followed further


def _strings(nodes) -> tuple[set[str] | None, list[set[str]]]:
    """The lower-cased strings that ``nodes`` can match, if these are few, and the clauses."""
    clauses: list[set[str]] = []
    run: set[str] | None = {""}
    exact = True

    def stop():
        nonlocal run, exact
        if run:
            clauses.append(run)
        run, exact = {""}, False

    def follow(found: set[str]):
        nonlocal run
        if len(run) * len(found) > WIDE:
            stop()
        run = {a + b for a in run for b in found}

    for kind, value in nodes:
        if kind is op.LITERAL:
            follow({chr(value).lower()})
        elif kind is op.IN and (some := _members(value)):
            follow(some)
        elif kind in (op.SUBPATTERN, op.BRANCH):
            branches = value[1] if kind is op.BRANCH else [value[-1]]
            parts = [_strings(b) for b in branches]
            if all(strings is not None for strings, _ in parts):
                follow(set().union(*(strings for strings, _ in parts)))
            else:
                stop()
                if len(parts) == 1:
                    clauses.extend(parts[0][1])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, item = value
            strings, inner = _strings(item)
            if strings is not None and (least, most) == (0, 1) and len(strings) == 1:
                follow(strings | {""})
            elif strings is not None and least == most and least <= 4:
                for _ in range(least):
                    follow(strings)
            else:
                if least and strings is not None:
                    follow(strings)
                stop()
                if least and strings is None:
                    clauses.extend(inner)
        else:
            stop()
    whole = run if exact else None
    return whole, clauses + ([run] if run else [])


def _members(value) -> set[str] | None:
    """The members of a small class, lower-cased."""
    found = set()
    for kind, x in value:
        if kind is op.LITERAL:
            found.add(chr(x).lower())
        elif kind is op.RANGE and x[1] - x[0] < MEMBERS:
            found |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
        else:
            return None
    return found if len(found) <= MEMBERS else None


def clauses(pattern: str) -> list[set[str]]:
    """The clauses of a pattern whose strings all have a trigram; empty if there is none."""
    _, found = _strings(_parser.parse(pattern))
    return [c for c in found if all(len(s) >= 3 for s in c)]


def grams(string: str) -> set[str]:
    return {string[i : i + 3] for i in range(len(string) - 2)}
