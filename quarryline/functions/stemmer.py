"""The English (Porter2) stemmer, after its published description."""

from __future__ import annotations

import functools
import re

# Fixed values of the algorithm: words with a stem of their own, and words left alone.
OWN = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
ALONE = frozenset("sky news howe atlas cosmos bias andes".split())
ALONE_LATER = frozenset("inning outing canning herring earring proceed exceed succeed".split())
# Fixed values of the algorithm: endings and what replaces them, the longest that fits first.
SECOND = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"),
    ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
]
THIRD = [("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", "")]
FOURTH = "ement ance ence able ible ment ant ent ism ate iti ous ive ize ion al er ic".split()
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")


def _region(word: str, start: int) -> int:
    """Where the part after the first non-vowel behind a vowel begins."""
    m = re.compile("[aeiouy][^aeiouy]").search(word, start)
    return m.end() if m else len(word)


def _short(word: str, first: int) -> bool:
    """Whether the word ends in a short syllable and has no first region."""
    return first >= len(word) and bool(re.search(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$", word))


@functools.lru_cache(200_000)
def stem(word: str) -> str:
    """The stem of a lower-case word."""
    if len(word) < 3:
        return word
    if word in OWN:
        return OWN[word]
    if word in ALONE:
        return word
    w = word.lstrip("'")
    w = re.sub(r"^y|(?<=[aeiouy])y", "Y", w)
    prefix = re.match(r"gener|commun|arsen", w)
    r1 = prefix.end() if prefix else _region(w, 0)
    r2 = _region(w, r1)
    w = re.sub(r"(?:'s'|'s|')$", "", w)
    # plurals
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(r"[aeiouy].", w[:-1]):
        w = w[:-1]
    if w in ALONE_LATER:
        return w
    # participles and adverbs
    if m := re.search(r"(?:eedly|eed)$", w):
        if m.start() >= r1:
            w = w[: m.start()] + "ee"
    elif (m := re.search(r"(?:ingly|edly|ing|ed)$", w)) and re.search("[aeiouy]", w[: m.start()]):
        w = w[: m.start()]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(DOUBLES):
            w = w[:-1]
        elif _short(w, r1):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"
    # derived forms
    for end, new in SECOND:
        if w.endswith(end):
            at = len(w) - len(end)
            if at >= r1 and not (end == "ogi" and w[at - 1 : at] != "l") and not (end == "li" and w[at - 1 : at] not in tuple("cdeghkmnrt")):
                w = w[:at] + new
            break
    for end, new in THIRD:
        if w.endswith(end):
            at = len(w) - len(end)
            if at >= r1 and not (end == "ative" and at < r2):
                w = w[:at] + new
            break
    for end in FOURTH:
        if w.endswith(end):
            at = len(w) - len(end)
            if at >= r2 and not (end == "ion" and w[at - 1 : at] not in ("s", "t")):
                w = w[:at]
            break
    if w.endswith("e") and (len(w) - 1 >= r2 or len(w) - 1 >= r1 and not re.search(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])e$", w)):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")
