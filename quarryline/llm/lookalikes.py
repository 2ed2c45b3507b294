"""One consistent form for text that looks alike but is made of other characters.

Each token (run of letters, marks and digits) gets the script sets of its letters, by Unicode's script extensions with
the writing systems that combine scripts (Japanese, Korean, Bopomofo with Han) added; their intersection is the
token's resolved script set. An empty intersection is a mixed-script token: the script into which all foreign
letters can be converted by look-alikes is selected (the script of the surrounding tokens decides between
two, then the majority of letters). A token with a resolved script whose letters all look like letters of the
only script around it is a whole-script confusable and is respelled. The look-alikes listed here are those of the
scripts that most resemble Latin; ``read_confusables`` reads more from a file in the format of Unicode's table. Then the remaining forms are normalized:
compatibility forms (full width, ligatures, mathematical letters), combining sequences, unusual spaces and
hyphens, characters that cannot be seen. Joiners between letters of scripts that need them stay.

Only values with a character outside printable ASCII cross into Python (Arrow batches); the rest keep their
value in the JVM.

Defined results: null stays null and is no case; an empty text stays empty; very long texts are processed
whole; repeated rows give repeated results; an empty table gives an empty result; input columns pass through
and the two added columns take the names given.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Mapping
from types import MappingProxyType

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANONICAL = T.StructType([T.StructField("text", T.StringType()), T.StructField("found", T.BooleanType())])

# Letters of other scripts next to the Latin letter each looks like (after Unicode's confusables).
CYRILLIC = "аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ӏl ѵv гr АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ЅS ІI ЈJ ԌG ѴV ԚQ ԜW ҮY ЗZ"
GREEK = "οo αa νv ρp ιi κk υu χx γy ϲc ϳj ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ"
CHEROKEE = "ᎪA ᏴB ᏟC ᎠD ᎬE ᏀG ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᎡR ᏚS ᎢT ᏙV ᎳW ᏃZ"
COPTIC = "ⲀA ⲂB ⲈE ⲎH ⲒI ⲔK ⲘM ⲚN ⲞO ⲢP ⲤC ⲦT ⲨY ⲬX ⲟo ⲣp ⲥc"
OTHER = "סo օo սu հh ոn ցg ՍU ՕO ՏS ɑa ɡg ɩi ꓐB ꓑP ꓓD ꓔT ꓖG ꓗK ꓙJ ꓚC ꓜZ ꓝF ꓟM ꓠN ꓡL ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU"
# Letters that look like a Latin letter only next to Latin letters; they never make a whole word.
LOOSE = "вb кk мm нh тt пn иu εe τt ηn ωw σo βb μu"
# Punctuation that looks like an ASCII character.
PUNCTUATION = {c: "-" for c in "‐‑‒–—―−﹘﹣"} | {c: "/" for c in "⁄∕"} | {c: ":" for c in "꞉∶"} | {"․": ".", "‚": ",", "⁎": "*", "∗": "*", "﹫": "@"}
# Characters that cannot be seen, besides all of category Cf.
UNSEEN = set("͏ᅟᅠ឴឵ㅤﾠ⠀") | {chr(c) for c in range(0xFE00, 0xFE10)}
JOINERS = {"‌", "‍"}
JOINING = frozenset("Arabic Syriac Devanagari Bengali Gurmukhi Gujarati Oriya Tamil Telugu Kannada Malayalam Sinhala Khmer Mongolian".split())
#: Scripts told apart; letters of others resolve to none of them and are left alone.
SCRIPTS = tuple(
    "Latin Cyrillic Greek Armenian Hebrew Arabic Syriac Thaana Devanagari Bengali Gurmukhi Gujarati Oriya Tamil Telugu Kannada Malayalam Sinhala Thai Lao Tibetan Myanmar Georgian Hangul Ethiopic Cherokee "
    "Khmer Mongolian Hiragana Katakana Bopomofo Han Yi Coptic Lisu Vai Tifinagh Glagolitic Gothic Deseret".split()
)
# Writing systems that combine scripts (after UTS 39).
COMBINED = {"Han": ("Hanb", "Jpan", "Kore"), "Hiragana": ("Jpan",), "Katakana": ("Jpan",), "Hangul": ("Kore",), "Bopomofo": ("Hanb",)}
IDEOGRAPHIC = frozenset(("Han", "Hanb", "Jpan", "Kore"))

TO_LATIN = {p[0]: p[1] for p in " ".join((CYRILLIC, GREEK, CHEROKEE, COPTIC, OTHER)).split()}
LOOSE_LATIN = TO_LATIN | {p[0]: p[1] for p in LOOSE.split()}
FROM_LATIN: dict[str, dict[str, str]] = {
    "Cyrillic": {p[1]: p[0] for p in reversed(CYRILLIC.split())},
    "Greek": {p[1]: p[0] for p in reversed(GREEK.split())},
}


_SCX = [(name, regex.compile(rf"\p{{scx={name}}}")) for name in SCRIPTS]


@functools.lru_cache(65536)
def script_set(c: str) -> frozenset[str]:
    """The scripts a letter is used in; empty for digits, punctuation and marks, which go with any script."""
    if not c.isalpha():
        return frozenset()
    found = [name for name, pattern in _SCX if pattern.match(c)]
    if len(found) == len(_SCX):
        return frozenset()
    return frozenset(found).union(*(COMBINED.get(f, ()) for f in found)) or frozenset((unicodedata.name(c, "?").split(" ", 1)[0],))


def resolved(token: str) -> frozenset[str] | None:
    """The scripts all letters of a token are used in: empty for a mixed-script token, None for one without letters."""
    sets = [s for c in token if (s := script_set(c))]
    return frozenset.intersection(*sets) if sets else None


def respell(letter: str, to: str, loose: bool, more: Mapping[str, str] = MappingProxyType({})) -> str | None:
    """The look-alike of ``letter`` in script ``to``."""
    base = unicodedata.normalize("NFD", letter)
    own, marks = base[0], base[1:]
    if to == "Latin":
        seen = (LOOSE_LATIN if loose else TO_LATIN).get(own) or more.get(own)
    else:
        table = FROM_LATIN.get(to, {})
        seen = table.get(own) or table.get(TO_LATIN.get(own, ""))
    return None if seen is None else unicodedata.normalize("NFC", seen + marks)


def read_confusables(lines: Iterable[str]) -> dict[str, str]:
    """The look-alikes of single Latin letters from lines in the format of Unicode's table (``source ; target ; type``)."""
    out: dict[str, str] = {}
    for line in lines:
        parts = line.lstrip("\ufeff").split("#", 1)[0].split(";")
        if len(parts) < 2 or len(parts[0].split()) != 1 or len(parts[1].split()) != 1:
            continue
        source, target = (chr(int(p.strip(), 16)) for p in parts[:2])
        if source.isalpha() and not source.isascii() and target.isascii() and target.isalpha() and "Latin" not in script_set(source):
            out[source] = target
    return out


def one_script(token: str, around: frozenset[str], more: Mapping[str, str] = MappingProxyType({})) -> str:
    """The token in one script if its letters can be brought to one, else as it is; ``around`` has the scripts of the other tokens."""
    sets = [script_set(c) for c in token]
    own = resolved(token)
    if own is None:
        return token
    if own:
        if len(around) != 1 or own & around:
            return token
        (to,) = around
        spelt = [c if not s else respell(c, to, False, more) for c, s in zip(token, sets, strict=True)]
        return token if None in spelt else "".join(spelt)
    options = []
    for to in sorted(frozenset.union(*sets)):
        spelt = [c if not s or to in s else respell(c, to, True, more) for c, s in zip(token, sets, strict=True)]
        if None not in spelt:
            options.append((to in around, sum(to in s for s in sets), to == "Latin", "".join(spelt)))
    return max(options)[3] if options else token


def tokens_of(text: str) -> list[tuple[bool, str]]:
    """Runs of letters, marks and digits, and what is between them."""
    out: list[tuple[bool, list[str]]] = []
    for c in text:
        word = c.isalnum() or unicodedata.category(c)[0] == "M"
        if out and out[-1][0] == word:
            out[-1][1].append(c)
        else:
            out.append((word, [c]))
    return [(w, "".join(cs)) for w, cs in out]


_LATIN = frozenset(("Latin",))
_PLAIN = frozenset(SCRIPTS)


def _scripts_of(token: str) -> frozenset[str] | None:
    """The resolved script set of a token without the writing systems that combine scripts, if more is left."""
    r = resolved(token)
    return r if not r else r & _PLAIN or r


def canonical(text: str, more: Mapping[str, str] = MappingProxyType({})) -> tuple[str, bool]:
    """The consistent form of ``text``, and whether a character stood for another or could not be seen; ``more`` adds look-alikes of Latin letters."""
    found, kept = False, []
    for i, c in enumerate(text):
        category = unicodedata.category(c)
        if category == "Cf" or c in UNSEEN:
            before, after = text[i - 1 : i], text[i + 1 : i + 2]
            near = [script_set(x) for x in (before, after) if x and script_set(x)] or [script_set(x) for x in text[max(0, i - 2) : i] if script_set(x)]
            if c in JOINERS and near and all(n & JOINING for n in near) and before and after:
                kept.append(c)
            else:
                found = True
        elif category == "Cc":
            kept.append(" " if c in "\t\n\r\v\f" else "")
            found |= kept[-1] == ""
        elif category == "Zs" and c != " ":
            wide = c == "　" and 0 < i < len(text) - 1 and bool(script_set(text[i - 1]) & script_set(text[i + 1]) & IDEOGRAPHIC)
            kept.append(" ")
            found |= not wide
        elif c in PUNCTUATION:
            kept.append(PUNCTUATION[c])
            found = True
        else:
            kept.append(c)
    plain = "".join(kept)
    composed = unicodedata.normalize("NFC", plain)
    found |= len(composed) < len(plain)
    compatible = unicodedata.normalize("NFKC", composed)
    if compatible != composed:
        # full-width punctuation beside ideographs is usual there; other compatibility forms stand for plain ones
        cjk = any(script_set(c) & IDEOGRAPHIC for c in composed)
        found |= any(unicodedata.normalize("NFKC", c) != c and not (cjk and not c.isalnum()) for c in composed)
    parts = tokens_of(compatible)
    around = [_scripts_of(t) if w else None for w, t in parts]
    # a mixed token speaks for Latin if it can be read as Latin throughout, else for no script
    sure = [None if r is None else r or (_LATIN if one_script(t, _LATIN, more).isascii() else frozenset()) for r, (_, t) in zip(around, parts, strict=True)]
    spelt = []
    for i, (word, token) in enumerate(parts):
        if word and not token.isascii() or word and around[i] == _LATIN and any(s and s != _LATIN for s in sure):
            others = frozenset().union(*(s for k, s in enumerate(sure) if s and k != i))
            new = one_script(token, others, more)
            found |= new != token
            token = new
        spelt.append(token)
    return unicodedata.normalize("NFC", "".join(spelt)), found


def _canonical(values: Column, more: dict[str, str]) -> Column:
    @F.pandas_udf(CANONICAL)
    def forms(values: pd.Series) -> pd.DataFrame:
        known: dict[str | None, tuple[str | None, bool]] = {None: (None, False)}
        rows = []
        for v in values:
            if v not in known:
                known[v] = canonical(v, more)
            rows.append(known[v])
        return pd.DataFrame(rows, columns=["text", "found"])

    return forms(values)


def is_plain(value: Column) -> Column:
    """Whether ``value`` has nothing but printable ASCII."""
    return ~value.rlike(r"[^\x20-\x7e]")


def with_canonical(df: DataFrame, column: str, text: str = "canonical", found: str = "lookalike", more: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the consistent form of ``column`` and whether it had look-alikes or unseen characters; ``more`` adds look-alikes."""
    value = F.col(column)
    seen = df.withColumn("__seen", _canonical(F.when(~is_plain(value), value), more or {}))
    return seen.withColumns({text: F.coalesce(F.col("__seen.text"), value), found: F.coalesce(F.col("__seen.found"), F.lit(False)) & value.isNotNull()}).drop("__seen")


def lookalike_rows(df: DataFrame, key: str, column: str, label: str) -> DataFrame:
    """``field``, ``id`` of the rows whose ``column`` holds look-alikes; plain rows never leave the JVM."""
    odd = df.select(F.col(key).alias("id"), F.col(column).alias("value")).filter(F.col("value").rlike(r"[^\x20-\x7e]"))
    return with_canonical(odd, "value").filter("lookalike").select(F.lit(label).alias("field"), "id")
