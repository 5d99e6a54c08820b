"""Items of top-level JSON arrays from a stream of text fragments.

Small tokeniser that holds one item at a time: it follows strings, escapes and
nesting depth only, and leaves the meaning of an item to the JSON parser.
Stray commas between items are dropped; content after the array is ignored.

A file may be read from any fragment on, given the tokeniser's state there.
``Effect`` tells, without that state, what a run of fragments does to it;
``after`` applies that, so the states at all splits of a file follow from
their effects, one after the other, without the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

#: What can change the state outside of a string.
_OUTSIDE = re.compile(r'["{}\[\],]')
#: Depth and strings only.
_NESTING = re.compile(r'["{}\[\]]')
#: What can change the state inside of a string.
_INSIDE = re.compile(r'["\\]')

NOT_ARRAY, MALFORMED = "not a JSON array", "malformed JSON"


@dataclass(frozen=True)
class State:
    """Where a reader stands between two fragments; depth 0: before the array."""

    depth: int = 0
    in_string: bool = False
    escaped: bool = False
    done: bool = False


class ArrayItems:
    """Feed fragments of one file in order, from ``state`` on; ``feed`` gives
    (text, reason) for each item that ends, blank ones too (reason None), or
    for a problem of the file, after which the rest of it is ignored."""

    def __init__(self, state: State = State()) -> None:
        self.depth, self.in_string, self.escaped, self.done = state.depth, state.in_string, state.escaped, state.done
        self.held: list[str] = []  # pieces of the item that is being read

    def state(self) -> State:
        return State(self.depth, self.in_string, self.escaped, self.done)

    def open_text(self) -> str | None:
        """Text of the item that has not ended; None outside of the array."""
        return "".join(self.held) if self.depth and not self.done else None

    def feed(self, fragment: str) -> Iterator[tuple[str, str | None]]:
        at, start, n = 0, 0, len(fragment)
        while at < n and not self.done:
            if self.depth == 0:  # before the array
                rest = fragment[at:].lstrip("﻿ \t\r\n")
                if not rest:
                    return
                if rest[0] != "[":
                    self.done = True
                    yield rest, NOT_ARRAY
                    return
                at = start = n - len(rest) + 1
                self.depth = 1
            elif self.escaped:
                self.escaped = False
                at += 1
            elif self.in_string:
                found = _INSIDE.search(fragment, at)
                if not found:
                    break
                at = found.end()
                self.escaped, self.in_string = found[0] == "\\", found[0] != '"'
            else:
                found = _OUTSIDE.search(fragment, at)
                if not found:
                    break
                at, c = found.end(), found[0]
                if c == '"':
                    self.in_string = True
                elif c in "[{":
                    self.depth += 1
                elif c in "]}" and self.depth > 1:
                    self.depth -= 1
                elif self.depth == 1 and c in ",]":
                    text = "".join([*self.held, fragment[start : found.start()]])
                    self.held, start = [], at
                    yield text, None
                    self.done = c == "]"
        if self.depth and not self.done:
            self.held.append(fragment[start:])


@dataclass
class Effect:
    """What fragments do to a reader that starts them inside or outside of a
    string, at a depth that is not known: ``closers`` lists the brackets
    that close what was open before, as runs [number, bracket]; ``opens`` counts
    those left open at the end."""

    in_string: bool
    escaped: bool = False
    opens: int = 0
    closers: list[list] = field(default_factory=list)

    def feed(self, fragment: str) -> None:
        at, n = 0, len(fragment)
        while at < n:
            if self.escaped:
                self.escaped = False
                at += 1
            elif self.in_string:
                found = _INSIDE.search(fragment, at)
                if not found:
                    return
                at = found.end()
                self.escaped, self.in_string = found[0] == "\\", found[0] != '"'
            else:
                found = _NESTING.search(fragment, at)
                if not found:
                    return
                at, c = found.end(), found[0]
                if c == '"':
                    self.in_string = True
                elif c in "[{":
                    self.opens += 1
                elif self.opens:
                    self.opens -= 1
                elif self.closers and self.closers[-1][1] == c:
                    self.closers[-1][0] += 1
                else:
                    self.closers.append([1, c])


def after(state: State, outside: Effect, inside: Effect) -> State:
    """The state behind a split that starts in ``state``, from the effects of
    its text behind the first comma (all splits but a file's first start at
    one) for a start outside and inside of a string."""
    if state.done or not state.depth:  # a comma before the array: not an array
        return State(state.depth, done=True)
    effect = inside if state.in_string else outside  # an escape takes the comma
    spare = state.depth - 1
    for number, bracket in effect.closers:
        if number > spare and bracket == "]":
            return State(1, done=True)
        spare = max(0, spare - number)  # a brace at the array's own depth has no effect
    return State(spare + 1 + effect.opens, effect.in_string, effect.escaped)
