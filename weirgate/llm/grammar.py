"""Weighted finite-state transducers over the words of a clause.

A transducer has numbered states; from a state, a symbol leads to a state, a symbol to hand on, and a factor. What
it has no arc for it hands on unchanged with factor 1. Composing two of them feeds what the first hands on to
the second and multiplies the factors; the composition is a transducer again.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

WORD, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, QUOTE, END = (
    "word", "insult", "threat", "intent", "target", "negation", "report", "quote", "end"
)
SYMBOLS = (WORD, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, QUOTE, END)

#: Words after a negation that it reaches.
REACH = 3
DENIED, REPORTED, AIMED, IDLE_THREAT, FULL_THREAT = 0.4, 0.5, 1.5, 0.3, 2.0


@dataclass(frozen=True)
class Transducer:
    arcs: Mapping[tuple[int, str], tuple[int, str, float]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def then(self, other: Transducer, symbols: Iterable[str] = SYMBOLS) -> Transducer:
        """Composition; only states that can be reached from the two starts get a number."""
        numbers, waiting, arcs = {(0, 0): 0}, [(0, 0)], {}
        while waiting:
            pair = waiting.pop()
            for symbol in symbols:
                first, middle, one = self.step(pair[0], symbol)
                second, out, two = other.step(pair[1], middle)
                to = (first, second)
                if to not in numbers:
                    numbers[to] = len(numbers)
                    waiting.append(to)
                arcs[numbers[pair], symbol] = (numbers[to], out, one * two)
        return Transducer(arcs)


def negation() -> Transducer:
    """States count the words that the last negation still reaches."""
    arcs: dict[tuple[int, str], tuple[int, str, float]] = {}
    for state in range(REACH + 1):
        less = max(0, state - 1)
        for symbol in (WORD, INTENT, TARGET, REPORT):
            arcs[state, symbol] = (less, symbol, 1.0)
        for symbol in (INSULT, THREAT):
            arcs[state, symbol] = (less, symbol, DENIED if state else 1.0)
        arcs[state, NEGATION] = (REACH, NEGATION, 1.0)
        arcs[state, END] = (0, END, 1.0)
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """State 1 follows a verb of saying to the clause's end, state 2 lies within quotation marks."""
    arcs = {(0, REPORT): (1, REPORT, 1.0), (1, END): (0, END, 1.0)}
    arcs |= {(0, QUOTE): (2, QUOTE, 1.0), (1, QUOTE): (2, QUOTE, 1.0), (2, QUOTE): (0, QUOTE, 1.0)}
    for state in (1, 2):
        for symbol in (INSULT, THREAT):
            arcs[state, symbol] = (state, symbol, REPORTED)
    return Transducer(arcs)


def insult() -> Transducer:
    """State 1 has met somebody the insult can aim at."""
    arcs = {(0, TARGET): (1, TARGET, 1.0), (1, INSULT): (1, INSULT, AIMED), (1, END): (0, END, 1.0)}
    return Transducer(arcs)


def threat() -> Transducer:
    """State 1 has met an intention; a threat without one hardly counts."""
    arcs = {(0, INTENT): (1, INTENT, 1.0), (1, END): (0, END, 1.0)}
    arcs |= {(0, THREAT): (0, THREAT, IDLE_THREAT), (1, THREAT): (1, THREAT, FULL_THREAT)}
    return Transducer(arcs)


def grammar() -> Transducer:
    return negation().then(reported_speech()).then(insult()).then(threat())


#: Function words of the grammar, lower case, in English, German, French and Spanish.
LEXICON: dict[str, str] = {
    word: symbol
    for symbol, words in {
        NEGATION: "not no never neither nor don't doesn't didn't isn't aren't wasn't weren't won't can't cannot"
        " nicht kein keine keinen nie niemals ne pas jamais aucun aucune nunca jamás tampoco ningún ninguna",
        TARGET: "you your you're u ur he she they him them his her their everyone du dich dir dein deine ihr euch euer"
        " tu toi te vous votre ton tú ti usted ustedes vosotros os",
        INTENT: "will i'll we'll gonna going shall must should werde werden soll muss vais va allons dois voy vamos debo",
        REPORT: "said says say wrote writes claimed claims called calls reported stated quote quoted sagte sagt schrieb"
        " behauptet nannte dit disait écrit affirme déclare dijo dice escribió afirma declara",
        THREAT: "kill murder strangle stab shoot slaughter töten umbringen erschießen erwürgen tuer égorger étrangler"
        " matar apuñalar estrangular degollar",
    }.items()
    for word in words.split()
}
