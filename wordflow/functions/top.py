"""The k best entries as an accumulator that is added to and merged."""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterable
from dataclasses import dataclass, field

# Minus the count, the word, where it was found: what sorts first is best.
Entry = tuple[int, str, int]


@dataclass
class TopEntries:
    """Holds ``k`` entries at most, best first, whatever was added."""

    k: int
    entries: list[Entry] = field(default_factory=list)

    def add(self, entry: Entry) -> None:
        if len(self.entries) < self.k or entry < self.entries[-1]:
            insort(self.entries, entry)
            del self.entries[self.k :]

    def merge(self, others: Iterable[Entry]) -> None:
        for entry in others:
            self.add(entry)
