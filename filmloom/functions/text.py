"""Text analysis as column expressions.

``mixed`` text runs through: tokens, lower case, English stop words, English
stem, possessive, Russian stop words, Russian stem, in that order. ``plain``
text is tokens in lower case. A Chinese character and a kana of Hiragana are
tokens of their own, and so is a run of Katakana; Thai and other scripts
without blanks stay runs of letters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filmloom.functions.stem import ENGLISH, RUSSIAN, stemmed

# The default English stop list of the analyser.
ENGLISH_STOP = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then "
    "there these they this to was will with"
).split()

# Russian stop list (Snowball family).
RUSSIAN_STOP = (
    "и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее мне "
    "было вот от меня еще нет о из ему теперь когда даже ну вдруг ли если уже или ни быть был него "
    "до вас нибудь опять уж вам сказал ведь там потом себя ничего ей может они тут где есть надо "
    "ней для мы тебя их чем была сам чтоб без будто человек чего раз тоже себе под жизнь будет ж "
    "тогда кто этот говорил того потому этого какой совсем ним здесь этом один почти мой тем чтобы "
    "нее кажется сейчас были куда зачем сказать всех никогда сегодня можно при наконец два об "
    "другой хоть после над больше тот через эти нас про всего них какая много разве сказала три "
    "эту моя впрочем хорошо свою этой перед иногда лучше чуть том нельзя такой им более всегда "
    "конечно всю между"
).split()

# Letters, marks, digits and "_" form a token. Between two letters a joining
# mark stays inside, between two digits a separator does. 255 ends a token.
SINGLE = r"\p{IsHan}\p{IsHiragana}"
KATAKANA = r"\p{IsKatakana}ー"
LETTER = rf"[\p{{L}}\p{{M}}&&[^{SINGLE}{KATAKANA}]]"
# What most texts are made of is read first, without the classes above, which are slow: blanks and signs that start no
# token, and runs of letters and digits whose next character can't go on. All else is left to the rest of the pattern.
BLANK = r"[\x00-&(-+\-/<-@\[-^`{-\x7F]"
COMMON = "[a-z0-9_ß-öø-ÿа-яё]"
TOKEN = (
    rf"(?!{BLANK})(?:{COMMON}{{1,255}}+(?![\p{{L}}\p{{M}}\p{{N}}_]|['’‘.:·,;][\p{{L}}\p{{M}}\p{{N}}])"
    rf"|[{SINGLE}]\p{{M}}*|[{KATAKANA}][{KATAKANA}\p{{M}}]{{0,254}}"
    rf"|(?:{LETTER}|[\p{{N}}_&&[^{SINGLE}]]"
    rf"|(?<={LETTER})['’‘.:·](?={LETTER})"
    r"|(?<=\p{N})['’‘.,;](?=\p{N})){1,255})"
)


def tokens(text: Column) -> Column:
    """Lower-case tokens in text order; null text has none."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), F.array())


def keeps(token: Column, stop: list[str]) -> Column:
    return ~token.isin(stop)


def drop_possessive(token: Column) -> Column:
    ends = token.endswith("'s") | token.endswith("’s")
    return F.when(ends, token.substr(F.lit(1), F.length(token) - 2)).otherwise(token)


def mixed_terms(text: Column) -> Column:
    """Index terms of a text, in order."""
    kept = F.filter(tokens(text), lambda t: keeps(t, ENGLISH_STOP))
    english = F.transform(stemmed(kept, ENGLISH), drop_possessive)
    russian = lambda terms: stemmed(F.filter(terms, lambda t: keeps(t, RUSSIAN_STOP)), RUSSIAN)
    # An array of one holds the English stems, so that they are made once whichever way the text goes.
    return F.transform(F.array(english), lambda terms: F.when(text.rlike("[А-яЁё]"), russian(terms)).otherwise(terms))[0]


def plain_terms(text: Column) -> Column:
    return tokens(text)


ANALYSERS = {"mixed": mixed_terms, "plain": plain_terms}


def unescape(query: Column) -> Column:
    """Drop the backslashes that quote the next character of a query string."""
    return F.regexp_replace(query, r"\\(.)", "$1")
