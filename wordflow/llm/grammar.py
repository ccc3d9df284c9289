"""A small weighted grammar of finite-state transducers over word classes.

Each transducer reads and writes one symbol per step. Composed, the output of one
is the input of the next, weights add up, and the pairs of states that can be
reached become the states of one table.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from dataclasses import dataclass

Symbol = Hashable
State = Hashable
#: From a state and a symbol to the next state, the output and a weight.
Step = Callable[[State, Symbol], tuple[State, Symbol, float]]


@dataclass(frozen=True)
class Transducer:
    start: State
    step: Step

    def then(self, other: Transducer) -> Transducer:
        """This transducer, its output read by the other one."""

        def both(state: tuple[State, State], symbol: Symbol) -> tuple[State, Symbol, float]:
            mine, middle, weight = self.step(state[0], symbol)
            theirs, out, more = other.step(state[1], middle)
            return (mine, theirs), out, weight + more

        return Transducer((self.start, other.start), both)

    def table(self, alphabet: Iterable[Symbol]) -> dict[Symbol, list[tuple[int, Symbol, float]]]:
        """Per symbol the step of every state that can be reached; the start is state 0."""
        alphabet = list(alphabet)
        numbers, states = {self.start: 0}, [self.start]
        rows: dict[Symbol, list[tuple[int, Symbol, float]]] = {a: [] for a in alphabet}
        for state in states:
            for a in alphabet:
                after, out, weight = self.step(state, a)
                if after not in numbers:
                    numbers[after] = len(states)
                    states.append(after)
                rows[a].append((numbers[after], out, weight))
        return rows


# What the words of a clause are. A finding is a kind with marks: (kind, negated, reported, aimed).
WORD, END, TARGET, NEGATION, REPORT, QUOTE = "word", "end", "target", "negation", "report", "quote"
INSULT, THREAT = ("insult",), ("threat",)
ALPHABET = [WORD, END, TARGET, NEGATION, REPORT, QUOTE, INSULT, THREAT]
# Words behind a negation that it reaches.
SCOPE = 3
AIMED_LATER = ("aimed later",)

# Logits of a finding before any label was seen, and what a mark takes or gives.
INSULT_WEIGHT, THREAT_WEIGHT = 1.0, 0.4
NEGATED, REPORTED, AIMED = -0.4, -0.3, 0.5


def _negate(left: State, symbol: Symbol) -> tuple[State, Symbol, float]:
    if symbol in (INSULT, THREAT):
        return max(0, left - 1), (*symbol, left > 0), NEGATED if left else 0.0
    if symbol == NEGATION:
        return SCOPE, symbol, 0.0
    return 0 if symbol == END else max(0, left - 1), symbol, 0.0


def _report(state: State, symbol: Symbol) -> tuple[State, Symbol, float]:
    said, quoted = state
    if isinstance(symbol, tuple):
        return state, (*symbol, said or quoted), REPORTED if said or quoted else 0.0
    if symbol == REPORT:
        return (True, quoted), symbol, 0.0
    if symbol == QUOTE:
        return (said, not quoted), symbol, 0.0
    # A quotation may run over several clauses, but not a verb of saying.
    return ((False, quoted) if symbol == END else state), symbol, 0.0


def _aim(state: State, symbol: Symbol) -> tuple[State, Symbol, float]:
    if isinstance(symbol, tuple):
        base = INSULT_WEIGHT if symbol[:1] == INSULT else THREAT_WEIGHT
        if state == "target":
            return state, (*symbol, True), base + AIMED
        return "open", (*symbol, False), base
    if symbol == TARGET:
        return "target", AIMED_LATER if state == "open" else None, AIMED if state == "open" else 0.0
    return ("none" if symbol == END else state), None, 0.0


def clause_table() -> dict[Symbol, list[tuple[int, Symbol, float]]]:
    """Negation, reported speech and target composed, over classes of words."""
    composed = Transducer(0, _negate).then(Transducer((False, False), _report)).then(Transducer("none", _aim))
    return composed.table(ALPHABET)


def findings(table: dict[Symbol, list[tuple[int, Symbol, float]]]) -> dict[Symbol, float]:
    """All outputs that score, with the grammar's own weights."""
    found = {out: weight for rows in table.values() for _, out, weight in rows if out is not None}
    return dict(sorted(found.items(), key=str))
