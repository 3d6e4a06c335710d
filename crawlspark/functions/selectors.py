"""CSS paths as steps that one walk over the markup can match: type, id, class, attribute, position, four combinators, lists.

Not taken, as an element's start tag can't tell: ``:last-child`` and its like, ``:has``, ``:contains``. Such a path, and one that is no path, is None.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

NAME = r"[A-Za-z_\u0080-\U0010FFFF-][\w\u0080-\U0010FFFF-]*"
PART = re.compile(
    rf"""(?P<type>\*|{NAME}) | \#(?P<id>{NAME}) | \.(?P<class>{NAME})
    | \[\s*(?P<attr>{NAME})\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s"']+))\s*)?\]
    | :(?P<nth>first-child|first-of-type|nth-child|nth-of-type)(?:\(\s*(?P<at>[^)]*?)\s*\))?""",
    re.X,
)
GAP = re.compile(r"\s*([>+~])\s*|\s+")
COMMA = re.compile(r"\s*,\s*")
NTH = re.compile(r"(?:([+-]?\d*)n\s*(?:([+-])\s*(\d+))?|([+-]?\d+))\Z")


class Step(NamedTuple):
    """One compound of a chain, with the combinator before it: blank, ``>``, ``+`` or ``~``."""

    combinator: str
    tag: str | None
    tests: tuple[Callable, ...]


Chain = tuple[Step, ...]


def _attribute(name: str, op: str | None, value: str) -> Callable:
    if op is None:
        return lambda e: name in e.attrs
    if not value and op in ("^=", "$=", "*=", "~="):
        return lambda e: False
    compare = {
        "=": lambda v: v == value,
        "~=": lambda v: value in v.split(),
        "|=": lambda v: v == value or v.startswith(value + "-"),
        "^=": lambda v: v.startswith(value),
        "$=": lambda v: v.endswith(value),
        "*=": lambda v: value in v,
    }[op]
    return lambda e: name in e.attrs and compare(e.attrs[name])


def _nth(kind: str, at: str | None) -> Callable | None:
    if kind.startswith("first"):
        step, start = (0, 1) if at is None else (None, None)
    else:
        found = NTH.match({"odd": "2n+1", "even": "2n"}.get(at or "", at or ""))
        if not found:
            return None
        n, sign, shift, only = found.groups()
        step = 0 if only else int(n + "1" if n in ("", "+", "-") else n)
        start = int(only) if only else int((sign or "") + (shift or "0"))
    if step is None:
        return None

    def holds(place: int) -> bool:
        return place == start if not step else (place - start) % step == 0 and (place - start) // step >= 0

    return (lambda e: holds(e.of_type)) if kind.endswith("of-type") else (lambda e: holds(e.place))


@lru_cache(4096)
def chains(path: str | None) -> tuple[Chain, ...] | None:
    """The alternatives of a path, or None."""
    found: list[Chain] = []
    steps: list[Step] = []
    text, at, combinator = (path or "").strip(), 0, " "
    while True:
        tag, tests, begin = None, [], at
        while part := PART.match(text, at):
            if part["type"] is not None:
                if at != begin:
                    return None
                tag = None if part["type"] == "*" else part["type"].lower()
            elif part["id"] is not None:
                tests.append(_attribute("id", "=", part["id"]))
            elif part["class"] is not None:
                tests.append(_attribute("class", "~=", part["class"]))
            elif part["attr"] is not None:
                value = next((part[k] for k in ("dq", "sq", "bare") if part[k] is not None), "")
                tests.append(_attribute(part["attr"].lower(), part["op"], value))
            else:
                test = _nth(part["nth"], part["at"])
                if test is None:
                    return None
                tests.append(test)
            at = part.end()
        if at == begin:
            return None
        steps.append(Step(combinator, tag, tuple(tests)))
        comma = COMMA.match(text, at)
        gap = GAP.match(text, at)
        if at == len(text) or comma:
            found.append(tuple(steps))
            if at == len(text):
                return tuple(found)
            steps, combinator, at = [], " ", comma.end()
        elif gap:
            combinator, at = gap[1] or " ", gap.end()
        else:
            return None
