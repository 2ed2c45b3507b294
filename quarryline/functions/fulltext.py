"""Full-text match: lexemes of a company's texts and web-style queries over them.

Lexemes are lower-case words without stop words, cut by the English stemmer. A vector keeps them in their order, with an
empty place for each stop word, so that phrases are told by positions. The query grammar has words (all wanted),
``or``, ``-word`` and quoted phrases; it is parsed on the driver into one column expression.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.functions.stemmer import stem

# English words without weight.
STOP = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be been "
    "being have has had having do does did doing a an the and but if or because as until while of at by for with about against between into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can will just don should now"
).split()
_STOP = frozenset(STOP)
WORD = r"[^\p{L}\p{N}]+"


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stems(words: pd.Series) -> pd.Series:
    return pd.Series([None if ws is None else [stem(w) for w in ws] for ws in words], dtype=object)


def positions(*columns: str, stemmed: bool = True) -> Column:
    """The lexemes of several columns in their order, stop words as empty places; null columns count as empty."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns]))
    words = F.filter(F.split(text, WORD), lambda w: w != "")
    kept = F.transform(words, lambda w: F.when(w.isin(STOP), F.lit("")).otherwise(w))
    return _stems(kept) if stemmed else kept


def lexemes(*columns: str, stemmed: bool = True) -> Column:
    """The distinct lexemes of several columns."""
    return F.array_distinct(F.filter(positions(*columns, stemmed=stemmed), lambda w: w != ""))


def search_vector(*columns: str) -> Column:
    """The distinct words of several columns, as they are and in order: what is kept beside a row and made anew whenever it is written."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns]))
    return F.array_sort(F.array_distinct(F.filter(F.split(text, WORD), lambda w: w != "")))


def _words(text: str, stemmed: bool) -> list[str]:
    """The lexemes of a part of a query, stop words as empty places."""
    return ["" if w in _STOP else stem(w) if stemmed else w for w in re.findall(r"[^\W_]+", text.lower())]


def _phrase(vector: Column, words: list[str]) -> Column:
    """Whether the words stand in ``vector`` one after the other; empty places match anything."""
    while words and not words[-1]:
        words = words[:-1]
    while words and not words[0]:
        words = words[1:]
    if len(words) < 2:
        return F.array_contains(vector, words[0]) if words else F.lit(True)
    places = " ".join(re.escape(w) if w else "[^ ]*" for w in words)
    return F.array_join(vector, " ").rlike(f"(?:^| ){places}(?: |$)")


def match(vector: Column, query: str, stemmed: bool = True) -> Column:
    """Whether ``vector`` (``positions``, or ``lexemes`` where there are no phrases) satisfies a web-style query; false for one without lexemes."""
    any_of: list[Column] = []
    for part in re.split(r"\s+or\s+", query.strip(), flags=re.I):
        all_of: list[Column] = []
        for neg, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', part):
            words = _words(phrase or word, stemmed)
            if any(words):
                hit = _phrase(vector, words)
                all_of.append(~hit if neg else hit)
        if all_of:
            any_of.append(reduce(lambda a, b: a & b, all_of))
    return reduce(lambda a, b: a | b, any_of) if any_of else F.lit(False)
