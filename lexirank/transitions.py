"""Grammar of level transitions: `a:b` or `a-b:c`, in lists separated by commas."""

from __future__ import annotations

import re
from dataclasses import dataclass

from .schemas import MAX_LEVEL, MIN_LEVEL

#: Fixed value: what is rebalanced where nothing is said.
DEFAULT_TRANSITIONS = "2:1,3:2,4:3"

_FORM = re.compile(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?:\s*(\d+)\s*")


@dataclass(frozen=True, order=True)
class Transition:
    """Words of the source levels are divided between `to` and another level."""

    low: int
    high: int
    to: int

    @property
    def sources(self) -> tuple[int, ...]:
        return (self.low,) if self.low == self.high else (self.low, self.high)

    @property
    def source_text(self) -> str:
        return "-".join(map(str, self.sources))

    @property
    def text(self) -> str:
        return f"{self.source_text}:{self.to}"

    @property
    def other(self) -> int:
        """Where words go that are not picked for `to`: the pair's other level, the next rarer of a split level, or they stay."""
        if self.low != self.high:
            return self.low + self.high - self.to
        return self.low + 1 if self.to == self.low else self.low

    @property
    def common(self) -> int:
        return min(self.to, self.other)

    @property
    def rare(self) -> int:
        return max(self.to, self.other)


def parse_transition(text: str) -> Transition:
    """One transition; sources are one level or two neighbours, the target one of the pair, the level itself or the next commoner."""
    m = _FORM.fullmatch(text)
    if not m:
        raise ValueError(f"not a transition: {text!r}")
    low, to = int(m[1]), int(m[3])
    high = int(m[2]) if m[2] else low
    if not all(MIN_LEVEL <= x <= MAX_LEVEL for x in (low, high, to)):
        raise ValueError(f"levels are {MIN_LEVEL} to {MAX_LEVEL}: {text!r}")
    if m[2]:
        if high != low + 1:
            raise ValueError(f"a pair has two neighbouring levels, the lower first: {text!r}")
        if to not in (low, high):
            raise ValueError(f"a pair's target is one of its levels: {text!r}")
    elif to not in (low, low - 1) or to == low == MAX_LEVEL:
        raise ValueError(f"a level is split into itself and the next rarer, or gives to the next commoner: {text!r}")
    return Transition(low, high, to)


def parse_transitions(text: str) -> list[Transition]:
    """Distinct transitions in order; their source levels may not overlap."""
    found = sorted({parse_transition(part) for part in text.split(",") if part.strip()})
    if not found:
        raise ValueError("no transition is given")
    check_disjoint(found)
    return found


def check_disjoint(transitions: list[Transition]) -> None:
    seen: dict[int, Transition] = {}
    for t in transitions:
        for level in t.sources:
            if seen.setdefault(level, t) != t:
                raise ValueError(f"{t.text} and {seen[level].text} both take from level {level}")
