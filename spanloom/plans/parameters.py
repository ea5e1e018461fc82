"""Pipeline parameters: variables, conditions, and series of invocations; stages as a graph of functions.

Values are strings; lists are words.  Nothing here runs a shell."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from graphlib import TopologicalSorter
from itertools import product
from typing import Any

NULLS = {"", "$NULL", "FALSE"}


def value_of(text: str | None) -> str | None:
    """The null words become None."""
    return None if text is None or text.strip() in NULLS else text


def substitute(text: str, values: dict[str, str | None]) -> str:
    """Replace $NAME and ${NAME}; an unknown name is an error, null is ``$NULL``."""

    def one(m: re.Match) -> str:
        name = m[1] or m[2]
        if name not in values:
            raise KeyError(f"variable {name} is not set")
        return values[name] if values[name] is not None else "$NULL"

    return re.sub(r"\$(?:\{(\w+)\}|(\w+))", one, text)


def choose(text: str, values: dict[str, str | None]) -> str | None:
    """``test ? a : b``: b where the test is null, 0 or false; without a question mark the text itself."""
    m = re.fullmatch(r"(.*?)\s\?\s(.*?)\s:\s(.*)", text)
    if not m:
        return value_of(substitute(text, values))
    test = value_of(substitute(m[1], values))
    return value_of(substitute(m[2] if test not in (None, "0") else m[3], values))


def series(spec: str, values: dict[str, str | None] | None = None) -> Iterator[dict[str, str]]:
    """Bindings of ``$A a1 a2 + $B b1 b2 * $C c1 c2``: ``+`` zips with the next variable, ``*`` crosses."""
    groups: list[list[dict[str, str]]] = []
    for block in re.split(r"\s\*\s", spec.strip()):
        columns: dict[str, list[str]] = {}
        for part in re.split(r"\s\+\s", block):
            name, *words = part.split()
            if not name.startswith("$"):
                raise ValueError(f"{name} is not a variable")
            columns[name[1:]] = [w for x in words for w in substitute(x, values or {}).split()]
        sizes = {len(v) for v in columns.values()}
        if len(sizes) != 1:
            raise ValueError(f"zipped variables have {sorted(sizes)} values")
        groups.append([dict(zip(columns, row)) for row in zip(*columns.values())])
    for combo in product(*groups):
        yield {k: v for d in combo for k, v in d.items()}


@dataclass(frozen=True)
class Directive:
    """One setting that a stage declares: required, or with a default; ``kind`` makes its value."""

    name: str
    default: str | None = None
    required: bool = False
    kind: Callable[[str], Any] = str

    @classmethod
    def parse(cls, text: str) -> Directive:
        """``require NAME`` or ``option NAME [default]``."""
        m = re.fullmatch(r"\s*(require|option)\s+\$?(\w+)(?:\s+\[(.*)\])?\s*", text)
        if not m or (m[1] == "require" and m[3] is not None):
            raise ValueError(f"not a directive: {text}")
        return cls(m[2], m[3], m[1] == "require")


def settle(directives: list[Directive], values: dict[str, str | None]) -> dict[str, Any]:
    """The declared settings' values; a required one without a value is an error."""
    out: dict[str, Any] = {}
    for d in directives:
        v = value_of(values.get(d.name))
        if v is None:
            if d.required:
                raise KeyError(f"variable {d.name} is not set")
            v = value_of(d.default)
        out[d.name] = None if v is None else d.kind(v)
    return out


def array_task(task: int, *lists: list[str]) -> tuple[str, ...]:
    """The objects of an array's task, numbered from 1 over the cross of the lists, the last of which turns fastest."""
    total, place = 1, task - 1
    for values in lists:
        total *= len(values)
    if not 0 <= place < total:
        raise IndexError(f"task {task} of {total}")
    out: list[str] = []
    for values in reversed(lists):
        place, i = divmod(place, len(values))
        out.append(values[i])
    return tuple(reversed(out))


@dataclass
class Pipeline:
    """Named stages, each a function of its predecessors' results; run in an order that respects them."""

    stages: dict[str, tuple[Callable[..., Any], tuple[str, ...]]] = field(default_factory=dict)

    def add(self, name: str, f: Callable[..., Any], *after: str) -> Pipeline:
        if name in self.stages:
            raise ValueError(f"stage {name} is there already")
        self.stages[name] = (f, after)
        return self

    def run(self) -> dict[str, Any]:
        done: dict[str, Any] = {}
        for name in TopologicalSorter({n: set(after) for n, (_, after) in self.stages.items()}).static_order():
            if name not in self.stages:
                raise KeyError(f"stage {name} is not defined")
            f, after = self.stages[name]
            done[name] = f(*(done[a] for a in after))
        return done


def invoke(f: Callable[..., dict[str, Any]], spec: str, preserve: tuple[str, ...] = (), last: tuple[str, ...] = ()) -> dict[str, list[Any]]:
    """Call ``f`` for each binding of a series; preserved outputs are appended, ``last`` ones replaced."""
    out: dict[str, Any] = {k: [] for k in preserve}
    for binding in series(spec):
        got = f(**binding)
        for k in preserve:
            out[k].append(got[k])
        for k in last:
            out[k] = got[k]
    return out
