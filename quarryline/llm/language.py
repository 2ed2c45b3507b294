"""Language of documents and of the segments of mixed-language documents, with a confidence.

String-kernel classification. The kernel of two texts is the normalized intersection of their blended-spectrum
n-gram presence sets (n = 1 to 4 over the padded words): k(x, y) = |X & Y| / sqrt(|X| |Y|). A bounded sample of
labelled sentences is drawn (``per_language`` of each label, by hash), a bounded number of landmarks per label
spans the Nystroem features phi(x) = k(x, L) k(L, L)^-1/2, and one-versus-rest ridge regression on phi gives a
weight per landmark and language. Labels are noisy, so the fit runs twice, the second time without the rows that
the first contradicts. The confidence is the softmax of the scores at the scale that gives held-out labels the highest
likelihood.

Scoring k(x, L) A for a batch is a product of the sparse presence matrix X with the n-gram-by-landmark matrix G
and with A. The product G A is formed once (n-grams by languages), so that a batch costs one gather and one
segmented sum.

Defined results: null and empty texts, and texts without letters, get no segment, language or confidence; very
long texts are split and scored whole, sentence by sentence; repeated rows give repeated results; an empty table
gives an empty result; with no labelled rows fitting raises ``ValueError``; other columns pass through.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANGUAGES = "ar de en es fr hi it nl pl pt ru tr zh".split()
# Names of the languages in English and as they call themselves.
NAMES = {
    "ar": "arabic العربية عربي عربية",
    "de": "german deutsch ger deu",
    "en": "english eng",
    "es": "spanish español espanol castellano spa castilian",
    "fr": "french français francais fre fra",
    "hi": "hindi हिन्दी हिंदी hin",
    "it": "italian italiano ita",
    "nl": "dutch nederlands vlaams flemish nld dut",
    "pl": "polish polski pol",
    "pt": "portuguese português portugues por",
    "ru": "russian русский rus",
    "tr": "turkish türkçe turkce tur",
    "zh": "chinese 中文 汉语 漢語 普通话 mandarin zho chi 简体中文 繁體中文",
}
BY_NAME = {n: code for code, names in NAMES.items() for n in names.split()} | {c: c for c in LANGUAGES}

ORDER = 4
SENTENCE = re.compile(r"(?<=[.!?…])[\"”’»)]*\s+|(?<=[。！？])\s*|(?<=[।؟])\s*|\n+|\s+[|—–/•·»]\s+")
EDGE = re.compile(r"^[\s|—–/•·»>*-]+|\s+$")
WORD = re.compile(r"[^\W\d_]+", re.U)
CJK = re.compile(r"[぀-ヿ㐀-鿿]")
FOLD = str.maketrans({"ı": "i", "ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d"})


def label_language(label: str | None) -> str | None:
    """The language a label names, however it is written; None for no label or one that names none of them."""
    if not label:
        return None
    text = label.strip().lower()
    if text in BY_NAME:
        return BY_NAME[text]
    first = re.split(r"[-_\s(,;/]", text, maxsplit=1)[0]
    return BY_NAME.get(first)


def sentences(text: str) -> list[str]:
    """The segments of a text: sentences, lines, and what separators part."""
    return [s for p in SENTENCE.split(text) if (s := EDGE.sub("", p))]


def words_of(sentence: str) -> tuple[list[str], int]:
    """The words of a sentence and their number; two ideographs count as a word."""
    words = WORD.findall(sentence)
    if sentence.isascii() or not (wide := len(CJK.findall(sentence))):
        return words, len(words)
    return words, len(WORD.findall(CJK.sub(" ", sentence))) + wide // 2


def size(sentence: str) -> int:
    return words_of(sentence)[1]


def folded(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text.lower().translate(FOLD)) if not unicodedata.combining(c))


def grams(word: str) -> set[str]:
    padded = f" {word} "
    return {padded[i : i + n] for n in range(1, ORDER + 1) for i in range(len(padded) - n + 1)} - {" "}


#: A segment of this many words is a whole sentence; a longer one tells its language by itself.
WHOLE, CLEAR_WORDS = 3, 4
#: Scales of the scores tried for the confidence.
SCALES = tuple(float(x) for x in range(1, 31))
#: So many texts are scored as one matrix.
BATCH = 2000
#: So much better another language than that of the text must score for a segment; more for one that is short.
MARGIN, SHORT_MARGIN = 0.15, 0.45


class Classifier:
    """Weights of n-grams for each language, and what turns scores into languages."""

    def __init__(self, ids: dict[str, int], weights: np.ndarray, languages: list[str], scale: float = 6.0):
        self.ids, self.weights, self.languages, self.scale = ids, weights, languages, scale
        self._words: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.ids, self.weights, self.languages, self.scale

    def __setstate__(self, state):
        self.__init__(*state)

    def _word(self, word: str) -> np.ndarray:
        """The numbers of a word's n-grams, kept for the next time; those no landmark has are numbered behind the others by their hash."""
        behind = len(self.weights)
        found = np.array([self.ids[g] if g in self.ids else behind + zlib.crc32(g.encode()) for g in grams(word)], dtype=np.int64)
        if len(self._words) < 200_000:
            self._words[word] = found
        return found

    def scores(self, words: list[list[str]]) -> np.ndarray:
        """One row of scores per text, given as its words: (X G) A with X the sparse presence matrix of all texts, its rows normalized."""
        known, parts, counts = self._words, [], np.zeros(len(words), dtype=np.int64)
        for i, ws in enumerate(words):
            n = 0
            for w in set(map(str.lower, ws)):
                found = known.get(w)
                if found is None:
                    found = self._word(w)
                parts.append(found)
                n += len(found)
            counts[i] = n
        flat = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
        row = np.repeat(np.arange(len(words)), counts)
        present = np.sort((row << 40) | flat)
        present = present[np.r_[True, present[1:] != present[:-1]]] if len(present) else present  # an n-gram counts once in a text
        row, gram = present >> 40, present & ((1 << 40) - 1)
        norm = np.sqrt(np.maximum(1, np.bincount(row, minlength=len(words))))
        inside = gram < len(self.weights)
        row, gram = row[inside], gram[inside]
        out = np.zeros((len(words), len(self.languages)))
        if len(row):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            out[row[starts]] = np.add.reduceat(self.weights[gram], starts, axis=0)
        return out / norm[:, None]

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        e = np.exp(self.scale * (scores - scores.max(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and confidence of each text."""
        if not texts:
            return []
        p = self.probabilities(self.scores([WORD.findall(t) for t in texts]))
        return [(self.languages[b], float(p[i, b])) for i, b in enumerate(p.argmax(axis=1))]

    def segments(self, texts: list[str | None]) -> list[list[tuple[str, str, float, bool]]]:
        """Of each text: segment, language, confidence, and whether it is a whole sentence; all segments are scored as one matrix.

        A segment too short to tell, or one that tells little, takes the language of the text if that scores nearly as well.
        """
        if len(texts) > BATCH:
            return [f for i in range(0, len(texts), BATCH) for f in self.segments(texts[i : i + BATCH])]
        parts: list[tuple[int, str, list[str], int]] = []
        for i, t in enumerate(texts):
            for p in sentences(t) if t else ():
                words, n = words_of(p)
                if words:
                    parts.append((i, p, words, n))
        out: list[list[tuple[str, str, float, bool]]] = [[] for _ in texts]
        if not parts:
            return out
        s = self.scores([p[2] for p in parts])
        probability = self.probabilities(s)
        of, weight = np.array([p[0] for p in parts]), np.array([p[3] for p in parts])
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        total = np.add.reduceat(s * weight[:, None], starts, axis=0)
        main = np.repeat(total.argmax(axis=1), np.diff(np.r_[starts, len(of)]))
        best = s.argmax(axis=1)
        lead = s[np.arange(len(parts)), best] - s[np.arange(len(parts)), main]
        best = np.where(lead < np.where(weight < CLEAR_WORDS, SHORT_MARGIN, MARGIN), main, best)
        sure = probability[np.arange(len(parts)), best]
        for (i, p, _, n), b, c in zip(parts, best.tolist(), sure.tolist(), strict=True):
            out[i].append((p, self.languages[b], c, n >= WHOLE))
        return out


def _kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalized intersections of presence rows."""
    return (a @ b.T) / np.sqrt(np.maximum(1, a.sum(axis=1))[:, None] * np.maximum(1, b.sum(axis=1))[None, :])


def _fit_once(texts: list[str], labels: np.ndarray, landmarks: int, ridge: float) -> Classifier:
    languages = sorted({str(x) for x in labels})
    chosen = [i for l in languages for i in np.flatnonzero(labels == l)[:landmarks]]
    sets = [set().union(*[grams(w) for w in set(WORD.findall(t.lower()))]) for t in texts]
    ids = {g: k for k, g in enumerate(sorted(set().union(*[sets[i] for i in chosen])))}
    presence = np.zeros((len(chosen), len(ids)), dtype=np.float32)
    for row, i in enumerate(chosen):
        presence[row, [ids[g] for g in sets[i]]] = 1
    norm = np.sqrt(presence.sum(axis=1))
    base = _kernel(presence, presence).astype(np.float64)
    # the kernel of all rows with the landmarks, block by block
    k = np.zeros((len(texts), len(chosen)))
    for start in range(0, len(texts), 256):
        block = np.zeros((min(256, len(texts) - start), len(ids)), dtype=np.float32)
        for row in range(len(block)):
            block[row, [ids[g] for g in sets[start + row] if g in ids]] = 1
        k[start : start + len(block)] = (block @ presence.T) / norm[None, :]
    k /= np.sqrt([max(1, len(s)) for s in sets])[:, None]
    values, vectors = np.linalg.eigh(base)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-4))) @ vectors.T
    phi = k @ root
    target = np.array([[1.0 if l == m else -1.0 for m in languages] for l in labels])
    solved = np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ target)
    a = root @ solved
    weights = (presence / norm[:, None]).T.astype(np.float64) @ a
    return Classifier(ids, weights.astype(np.float32), languages)


def fit(sample: pd.DataFrame, landmarks: int = 30, ridge: float = 0.3) -> Classifier:
    """A classifier from labelled sentences (columns ``text``, ``lang``), refitted without the rows it contradicts."""
    if not len(sample):
        raise ValueError("no labelled sentences to fit on")
    texts, labels = list(sample["text"]), np.array(list(sample["lang"]))
    first = _fit_once(texts, labels, landmarks, ridge)
    agree = np.array([p == l for (p, _), l in zip(first.predict(texts), labels, strict=True)])
    texts, labels = [t for t, a in zip(texts, agree, strict=True) if a], labels[agree]
    plain = [(folded(t), l) for t, l in zip(texts, labels, strict=True) if folded(t) != t.lower() and t.isascii() is False and l not in ("ar", "hi", "ru", "zh")]
    # copies without accents stand behind the others, so that both kinds are among the landmarks
    scale = calibrated(texts, labels, landmarks, ridge)
    both = [x for pair in zip(zip(texts, labels, strict=True), (plain + [None] * len(texts))[: len(texts)], strict=True) for x in pair if x]
    model = _fit_once([t for t, _ in both], np.array([l for _, l in both]), landmarks * 2, ridge)
    model.scale = scale
    return model


def calibrated(texts: list[str], labels: np.ndarray, landmarks: int, ridge: float) -> float:
    """The scale under which a classifier fitted on every second row gives the labels of the others the highest likelihood; 6 where there is nothing to hold out."""
    odd = np.arange(len(texts)) % 2 == 1
    held = [i for i in np.flatnonzero(odd) if labels[i] in set(labels[~odd])]
    if not held:
        return 6.0
    model = _fit_once([t for t, o in zip(texts, odd, strict=True) if not o], labels[~odd], landmarks, ridge)
    s = model.scores([WORD.findall(texts[i]) for i in held])
    s -= s.max(axis=1, keepdims=True)
    own = s[np.arange(len(held)), [model.languages.index(labels[i]) for i in held]]
    likelihood = {scale: float(np.mean(scale * own - np.log(np.exp(scale * s).sum(axis=1)))) for scale in SCALES}
    return max(likelihood, key=lambda x: (likelihood[x], -x))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _sentences(texts: pd.Series) -> pd.Series:
    return pd.Series([[s for s in sentences(t) if size(s) >= 6][:2] if t else [] for t in texts], dtype=object)


@F.pandas_udf(T.StringType())
def _label(labels: pd.Series) -> pd.Series:
    known = {v: label_language(v) for v in set(labels)}
    return pd.Series([known[v] for v in labels], dtype=object)


def labelled_sample(documents: DataFrame, text: str = "text", label: str = "lang", per_language: int = 150) -> pd.DataFrame:
    """At most ``per_language`` labelled sentences of each language, of different texts, chosen by hash."""
    code = _label(F.col(label))
    few = documents.select(F.col(text).alias("t"), code.alias("lang"), F.xxhash64(text).alias("h")).filter("lang is not null and t is not null")
    few = few.dropDuplicates(["lang", "h"])
    order = Window.partitionBy("lang").orderBy("h", "t")
    few = few.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= 3 * per_language)
    rows = few.select("lang", "h", F.explode(_sentences("t")).alias("text")).dropDuplicates(["lang", "text"])
    rows = rows.withColumn("rn", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text"))).filter(F.col("rn") <= per_language)
    return rows.select("lang", "text").orderBy("lang", F.xxhash64("text"), "text").toPandas()


_PLACE = [T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("whole", T.BooleanType())]
SEGMENTS = T.ArrayType(T.StructType([T.StructField("segment", T.StringType()), *_PLACE]))


def with_segments(df: DataFrame, column: str, model: Classifier, name: str = "segments") -> DataFrame:
    """``df`` with the segments of ``column``: text, language, confidence, and whether each is a whole sentence."""

    @F.pandas_udf(SEGMENTS)
    def segments(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("segment", "lang", "confidence", "whole"), s, strict=True)) for s in found] for found in model.segments(list(texts))], dtype=object)

    return df.withColumn(name, segments(F.col(column)))


LANGUAGE_SETS = T.StructType([T.StructField("every", T.ArrayType(T.StringType())), T.StructField("whole", T.ArrayType(T.StringType()))])


def with_languages(df: DataFrame, column: str, model: Classifier) -> DataFrame:
    """``df`` with ``every`` and ``whole``: the languages of all segments of ``column``, and of its whole sentences."""

    @F.pandas_udf(LANGUAGE_SETS)
    def sets(texts: pd.Series) -> pd.DataFrame:
        found = model.segments(list(texts))
        return pd.DataFrame({"every": [sorted({l for _, l, _, _ in f}) for f in found], "whole": [sorted({l for _, l, _, w in f if w}) for f in found]})

    # else a filter on the result is moved below other steps and the languages are found twice
    sets = sets.asNondeterministic()
    return df.withColumn("__l", sets(F.col(column))).select(*[c for c in df.columns if c not in ("every", "whole")], "__l.*")


def with_language(df: DataFrame, segments: str = "segments", language: str = "detected", confidence: str = "confidence") -> DataFrame:
    """``df`` with the language most of its text is written in and the share of the text, weighed by confidence, that says so."""
    total = F.aggregate(segments, F.lit(0.0), lambda a, x: a + F.length(x["segment"]))
    languages = F.array_distinct(F.transform(segments, lambda x: x["lang"]))
    shares = F.transform(
        languages,
        lambda l: F.struct(
            (F.aggregate(F.filter(segments, lambda x: x["lang"] == l), F.lit(0.0), lambda a, x: a + F.length(x["segment"]) * x["confidence"]) / total).alias("share"), l.alias("lang")
        ),
    )
    best = F.array_max(shares)
    return df.withColumns({language: best["lang"], confidence: F.round(best["share"], 4)})


def suspects(metadata: DataFrame, model: Classifier) -> DataFrame:
    """``domain``, ``whole``: domains whose description is unlabelled, wrongly labelled or mixed, with the languages of its whole sentences."""
    rows = metadata.select("domain", "language", "description").filter("description is not null and trim(description) <> ''")
    cases = with_languages(rows, "description", model).select("domain", "every", "whole", _label(F.col("language")).alias("named"))
    wrong = F.col("named").isNull() | ~F.array_contains("every", F.col("named")) | (F.size("whole") > 1)
    return cases.filter(wrong).select("domain", "whole").distinct()


def misdeclared(cases: DataFrame, excluded: DataFrame) -> DataFrame:
    """``domain``, ``lang`` for each language of a case; ``excluded`` holds the domains whose description is residue or wrongly decoded."""
    return cases.join(excluded.select("domain").distinct(), "domain", "left_anti").select("domain", F.explode("whole").alias("lang")).distinct()
