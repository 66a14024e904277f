"""Stemmers as tables of suffix rules, evaluated as column expressions.

A stemmer is a list of steps, and a step a list of rules in order. A rule has a suffix, a condition on the letters before
it, and what takes the suffix's place. The first rule that applies ends its step. In a ``strict`` step a suffix that is
found ends the step even if its condition fails.

What a later step must know of an earlier one stands at the end of the token, as a mark that no token can hold:
``|`` (a suffix was taken), ``/`` (an adjective's ending was taken) and ``.`` (too short to be changed).

Array expressions are interpreted, so what counts is the number of comparisons for each token: rules are reached by their
last letter, and patterns only by tokens that hold what they look for.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Replace ``suffix`` by ``put`` where the letters before it match ``before`` (an empty pattern always does).

    Patterns have no look-around, so that every engine reads them alike.
    """

    suffix: str
    before: str = ""
    put: str = ""


@dataclass(frozen=True)
class Step:
    """``script``: the least token that the step may change, and the least beyond; without it, any."""

    rules: tuple[Rule, ...]
    strict: bool = False
    script: tuple[str, str] | None = None

    def by_last_letter(self) -> dict[str, list[Rule]]:
        """The rules by the last character of their suffix; those of different groups can't meet one token."""
        groups: dict[str, list[Rule]] = {}
        for rule in self.rules:
            groups.setdefault(rule.suffix[-1], []).append(rule)
        return groups


@dataclass(frozen=True)
class Swap:
    """Replace every match of a pattern; ``holds`` is in every token that the pattern matches."""

    pattern: str
    put: str
    holds: str


Stemmer = tuple[Step | Swap, ...]

# --- English. "Y" is a y that counts as a consonant: the first letter, or one after a vowel.
_V, _C = "[aeiouy]", "[^aeiouy]"
HAS_VOWEL = _V
MORE_THAN_0 = f"^{_C}*{_V}+{_C}"
MORE_THAN_1 = f"^{_C}*{_V}+{_C}+{_V}+{_C}"
# One vowel between consonants, the last of which isn't w, x or y, and nothing else but consonants in front.
SHORT = f"^{_C}+{_V}[^aeiouywxY]$"


def _pairs(text: str, before: str) -> tuple[Rule, ...]:
    return tuple(Rule(suffix, before, put) for suffix, _, put in (pair.partition(">") for pair in text.split()))


# The suffixes of the Porter algorithm, each before the shorter ones that it ends in.
ENGLISH: Stemmer = (
    Swap("^([aeiou]y)$", r"\1.", "y"),
    Swap("(^|[aeiouy])y", r"\1Y", "y"),
    Step((*_pairs("sses>ss ies>i ss>ss", ""), Rule("s", "..")), strict=True),
    Step((Rule("eed", MORE_THAN_0, "ee"), Rule("ed", HAS_VOWEL, "|"), Rule("ing", HAS_VOWEL, "|")), strict=True),
    Step(
        _pairs("at|>ate bl|>ble iz|>ize", "")
        + _pairs("bb|>b cc|>c dd|>d ff|>f gg|>g hh|>h jj|>j kk|>k mm|>m nn|>n pp|>p qq|>q rr|>r tt|>t vv|>v ww|>w xx|>x", "")
        + (Rule("|", SHORT, "e"), Rule("|"))
    ),
    Step((Rule("y", HAS_VOWEL, "i"), Rule("Y", HAS_VOWEL, "i"))),
    Step(
        _pairs(
            "ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous ization>ize "
            "ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble logi>log",
            MORE_THAN_0,
        ),
        strict=True,
    ),
    Step(_pairs("icate>ic ative> alize>al iciti>ic ical>ic ful> ness>", MORE_THAN_0), strict=True),
    Step(
        _pairs("al> ance> ence> er> ic> able> ible> ant> ement> ment> ent>", MORE_THAN_1)
        + (Rule("ion", f"{MORE_THAN_1}.*[st]$|{MORE_THAN_1[:-len(_C)]}[st]$"),)
        + _pairs("ou> ism> ate> iti> ous> ive> ize>", MORE_THAN_1),
        strict=True,
    ),
    Step((Rule("e", MORE_THAN_1), Rule("e", SHORT, "e"), Rule("e", MORE_THAN_0))),
    Step((Rule("ll", f"{MORE_THAN_0}+{_V}", "l"),)),
    Swap("Y", "y", "Y"),
    Swap(r"\.$", "", "."),
)

# --- Russian. A suffix may be taken only after the first vowel.
_AFTER_VOWEL = "[аеиоуыэюя]"
_AFTER_A = f"{_AFTER_VOWEL}.*[ая]$"
_SECOND_REGION = f"{_AFTER_VOWEL}[^аеиоуыэюя].*{_AFTER_VOWEL}[^аеиоуыэюя]"
_CYRILLIC = ("а", "ѐ")


def _taken(suffixes: str, before: str, end: str = "", put: str = "|") -> tuple[Rule, ...]:
    return tuple(Rule(s + end, before, put) for s in sorted(suffixes.split(), key=len, reverse=True))


# The endings of the Snowball algorithm for Russian.
RUSSIAN: Stemmer = (
    Swap("ё", "е", "ё"),
    Step(
        _taken("ив ивши ившись ыв ывши ывшись", _AFTER_VOWEL) + _taken("в вши вшись", _AFTER_A),
        script=_CYRILLIC,
    ),
    Step(_taken("ся сь", _AFTER_VOWEL, put=""), script=_CYRILLIC),
    Step(
        _taken("ее ие ые ое ими ыми ей ий ый ой ем им ым ом его ого ему ому их ых ую юю ая яя ою ею", _AFTER_VOWEL, put="/"),
        script=_CYRILLIC,
    ),
    Step(
        _taken("ивш ывш ующ", _AFTER_VOWEL, end="/") + _taken("ем нн вш ющ щ", _AFTER_A, end="/") + (Rule("/", "", "|"),),
        script=_CYRILLIC,
    ),
    Step(
        _taken("ила ыла ена ейте уйте ите или ыли ей уй ил ыл им ым ен ило ыло ено ят ует уют ит ыт ены ить ыть ишь ую ю", _AFTER_VOWEL)
        + _taken("ла на ете йте ли й л ем н ло но ет ют ны ть ешь нно", _AFTER_A),
        script=_CYRILLIC,
    ),
    Step(
        _taken("а ев ов ие ье е иями ями ами еи ии и ией ей ой ий й иям ям ием ем ам ом о у ах иях ях ы ь ию ью ю ия ья я", _AFTER_VOWEL),
        script=_CYRILLIC,
    ),
    Step((Rule("|"),), script=_CYRILLIC),
    Step((Rule("и", _AFTER_VOWEL),), script=_CYRILLIC),
    Step((Rule("ость", _SECOND_REGION), Rule("ост", _SECOND_REGION)), script=_CYRILLIC),
    Step(
        (
            Rule("ннейше", _AFTER_VOWEL, "н"), Rule("ннейш", _AFTER_VOWEL, "н"), Rule("ейше", _AFTER_VOWEL), Rule("ейш", _AFTER_VOWEL),
            Rule("нн", _AFTER_VOWEL, "н"), Rule("ь", _AFTER_VOWEL),
        ),
        script=_CYRILLIC,
    ),
)


def _swap(step: Swap) -> str:
    put = step.put.replace("\\", "$")
    return f"CASE WHEN contains(t, '{step.holds}') THEN regexp_replace(t, r'{step.pattern}', '{put}') ELSE t END"


def _rewrite(step: Step) -> str:
    cases = [f"WHEN t < '{step.script[0]}' OR t >= '{step.script[1]}' THEN t"] if step.script else []
    for letter, rules in step.by_last_letter().items():
        inner = []
        for rule in rules:
            before = f"left(t, length(t) - {len(rule.suffix)})"
            found, fits = f"endswith(t, '{rule.suffix}')", f"{before} RLIKE '{rule.before}'" if rule.before else "true"
            put = f"concat({before}, '{rule.put}')" if rule.put else before
            inner.append(f"WHEN {found} THEN if({fits}, {put}, t)" if step.strict else f"WHEN {found} AND {fits} THEN {put}")
        cases.append(f"WHEN endswith(t, '{letter}') THEN CASE {' '.join(inner)} ELSE t END")
    return f"CASE {' '.join(cases)} ELSE t END"


@cache
def _lambdas(stemmer: Stemmer) -> list[str]:
    return [f"t -> {_swap(step) if isinstance(step, Swap) else _rewrite(step)}" for step in stemmer]


def stemmed(tokens: Column, stemmer: Stemmer) -> Column:
    """The stems of an array of tokens, null for null.

    Every step is an array expression of its own: nested in one expression, a step would repeat all before it for
    each of its rules. Its rules are given as text, which is parsed at once; made of columns, they take seconds.
    """
    for step in _lambdas(stemmer):
        tokens = F.call_function("transform", tokens, F.expr(step))
    return tokens
