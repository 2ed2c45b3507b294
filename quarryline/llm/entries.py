"""Mapping freely typed values to the entries of a reference list.

Token-level repair: each distinct token of the values is joined with the vocabulary of the reference list on
shared one-letter deletions (edit distance up to one, transpositions included) and, for abbreviations, on the
first letter; what a pair is worth is its similarity. Values are then joined with the entries that hold their
corrected tokens and ranked by soft TF-IDF: the cosine of the two token sets, where tokens count by their
similarity and their rarity in the reference list. An entry is accepted if its tokens are covered and the value
has nothing left over but words that say nothing of the entry (numbers, "near", "head office", the area); a
written area decides between entries. What no entry accepts is reported with entry 0.

Nothing whose size grows is broadcast unless its rows are counted first; the other joins are equi-joins Catalyst plans by size. Values and tokens are
made distinct first, so a value that a third of all rows hold is worked on once.

Defined results: null and empty values, and values equal to an entry, give no row; a value without letters or
digits gets 0; ties go to the smaller identifier; an empty reference list maps everything to 0; very long values
are split into tokens whole; columns other than those named are not read.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.llm.spread import broadcast_checked
from quarryline.session import cut

# Words that say nothing of the entry meant.
NOISE_PLACE = frozenset("hq city near greater dist district head office town region area the of in at metro central downtown province state county branch main suburb outskirts vicinity around close to".split())
NOISE_TITLE = frozenset("the of for and a an acting interim office branch hq department dept team at in region head_office".split())
# Customary short forms that are no subsequence of what they stand for, or stand for several words.
SHORT_TITLE = {"hr": "human resources", "vp": "vice president", "biz": "business", "md": "managing director", "svp": "senior vice president", "gm": "general manager", "ops": "operations", "it": "information technology", "pr": "public relations", "bd": "business development", "mkt": "marketing", "mktg": "marketing", "sr": "senior", "snr": "senior", "mng": "managing", "mgr": "manager", "mngr": "manager", "dir": "director", "prod": "production", "prodn": "production"}
SHORT_PLACE = {"pt": "port", "mt": "mount", "ft": "fort", "st": "saint", "jct": "junction", "jn": "junction", "hts": "heights", "hbr": "harbour", "upr": "upper", "nth": "north", "sth": "south"}
FOLD = str.maketrans({"ı": "i", "ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d"})
LEAST = 0.45
#: An entry not matched whole must be matched to this share of its rarity.
COVER = 0.6


def fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower().translate(FOLD)) if not unicodedata.combining(c))


def tokens(value: str, mode: str) -> list[str]:
    """The tokens of a value: folded, dotted initials joined, customary short forms written out."""
    text = re.sub(r"['’`]", "", fold(value))
    text = re.sub(r"\b(?:[a-z]\.){2,}[a-z]?\b\.?|\b[a-z](?:\.[a-z])+\b", lambda m: m.group().replace(".", "") + " ", text)
    if mode == "title":
        text = re.sub(r"\b(?:(non|co)[-/ ]+|(w)/)(?=[a-z])", r"\1\2", text)
    short = SHORT_TITLE if mode == "title" else SHORT_PLACE
    out: list[str] = []
    for t in re.findall(r"[^\W_]+", text):
        out += short.get(t, t).split()
    return out


def edits(a: str, b: str) -> bool:
    """Whether one insertion, deletion, replacement or transposition turns ``a`` into ``b``."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i:]


def subsequence(short: str, word: str) -> bool:
    rest = iter(word)
    return all(c in rest for c in short)


def similarity(token: str, word: str, generic: bool, mode: str) -> float | None:
    """What ``token`` is worth as a spelling of the vocabulary's ``word``; None for nothing."""
    if token == word:
        return 1.0
    if token.isdigit() or word.isdigit():
        return None
    if generic and mode == "place" and len(word) <= 3 and len(token) >= 2 and edits(token, word):
        return 0.85
    if generic and mode == "place" and len(token) == 1 and token == word[0]:
        return 0.75
    if min(len(token), len(word)) >= 3 and max(len(token), len(word)) >= 4 and edits(token, word):
        return 0.9
    if mode == "title" or generic:
        if 2 <= len(token) < len(word) and token[0] == word[0]:
            if len(token) >= 3 and word.startswith(token):
                return 0.88
            if len(token) <= len(word) - 2 and (len(token) <= 6 or token[:4] == word[:4]) and subsequence(token, word):
                return 0.82
        # a slip within a short form
        if mode == "title" and len(token) >= 5 and token[:2] == word[:2] and len(token) <= len(word) and any(subsequence(token[:i] + token[i + 1 :], word) for i in range(2, len(token))):
            return 0.75
        if mode == "title" and len(token) >= 7 and len(word) >= 7 and token[:6] == word[:6]:
            return 0.7
    return None


def deletions(token: str) -> list[str]:
    return [token] if len(token) < 3 else list({token, *(token[:i] + token[i + 1 :] for i in range(len(token)))})


def _udf_tokens(mode: str):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(values: pd.Series) -> pd.Series:
        return pd.Series([tokens(v, mode) for v in values], dtype=object)

    return split


@F.pandas_udf(T.ArrayType(T.StringType()))
def _deletions(values: pd.Series) -> pd.Series:
    return pd.Series([deletions(v) for v in values], dtype=object)


def token_matches(found: DataFrame, vocabulary: DataFrame, mode: str) -> DataFrame:
    """``token``, ``word``, ``sim``: distinct tokens joined with the vocabulary (``word``, ``generic``)."""

    @F.pandas_udf(T.DoubleType())
    def worth(a: pd.Series, b: pd.Series, generic: pd.Series) -> pd.Series:
        return pd.Series([similarity(x, y, g, mode) for x, y, g in zip(a, b, generic, strict=True)], dtype="float64")

    worth = worth.asNondeterministic()  # else the filter on its result makes it run twice
    left = found.select("token", F.explode(_deletions("token")).alias("key"))
    right = vocabulary.select("word", "generic", F.explode(_deletions("word")).alias("key"))
    near = left.join(right, "key").select("token", "word", "generic")
    letters = vocabulary if mode == "title" else vocabulary.filter("generic")
    # the vocabulary goes to the tokens, as initials are few and shared by many
    short = found.join(broadcast_checked(letters), F.substring("token", 1, 1) == F.substring("word", 1, 1)).select("token", "word", "generic")
    pairs = near.unionByName(short).distinct()
    return pairs.withColumn("sim", worth("token", "word", "generic")).filter("sim is not null").select("token", "word", "sim")


def match_values(values: DataFrame, entries: DataFrame, mode: str, areas: bool = False, extra: DataFrame | None = None) -> DataFrame:
    """``value``, ``ref_id``, ``score`` for each distinct ``value``; ref_id 0 where no entry is meant.

    ``entries`` has ``ref_id``, ``name`` and, with ``areas``, ``area`` and ``code``. ``extra`` has ``name``s whose
    words may stand beside an entry without being part of it (the places a branch is in).
    """
    noise = list(NOISE_TITLE if mode == "title" else NOISE_PLACE)
    split = _udf_tokens(mode)
    listed = entries.select("ref_id", F.explode(F.array_distinct(split("name"))).alias("word")).filter(~F.col("word").isin("of", "the", "and"))
    df = listed.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    total = entries.count()
    idf = cut(df.select("word", F.log(1 + F.lit(total) / F.col("df")).alias("idf"), (F.col("df") >= 3).alias("generic")))
    # the reference list is short, and so is the window over one entry's words
    rarest = Window.partitionBy("ref_id").orderBy(F.col("idf").desc(), "word").rowsBetween(Window.unboundedPreceding, -1)
    before, whole_entry = F.coalesce(F.sum("idf").over(rarest), F.lit(0.0)), F.sum("idf").over(Window.partitionBy("ref_id"))
    weights = listed.join(idf, "word").withColumn("lead", before <= (1 - COVER) * whole_entry + 1e-9)
    norms = weights.groupBy("ref_id").agg(F.sum(F.col("idf") * F.col("idf")).alias("entry_norm"), F.sum("idf").alias("entry_idf"), F.count(F.lit(1)).alias("entry_words"))

    # the steps are written out one by one: as one plan they take the driver's memory
    weights = cut(weights)
    at = cut(values.select("value", F.posexplode(split("value")).alias("pos", "token")))
    found = at.select("token").distinct()
    vocabulary = idf.select("word", "generic")
    matches = cut(token_matches(found, vocabulary, mode))

    # tokens that may be left over
    loose = found.filter(F.col("token").rlike("^[0-9]+$") | F.col("token").isin(noise)).select("token")
    if areas:
        area_words = entries.select(F.explode(split("area")).alias("word"), "area").distinct()
        near_area = token_matches(found, area_words.select("word", F.lit(False).alias("generic")).distinct(), mode).join(area_words, "word").select("token", "area")
        loose = loose.unionByName(near_area.select("token"))
        written = at.join(near_area, "token").select("value", "area").distinct()
    if extra is not None:
        beside = extra.select(F.explode(split("name")).alias("word")).distinct().withColumn("generic", F.lit(False))
        loose = loose.unionByName(token_matches(found, beside, "place").select("token"))
    loose = cut(loose.distinct()).withColumn("loose", F.lit(True))

    # soft TF-IDF of each value with the entries that hold one of its corrected tokens
    token_weight = matches.join(idf, "word").groupBy("token").agg(F.max_by("idf", F.struct("sim", "idf")).alias("token_idf"))
    weighed = at.join(token_weight, "token", "left").join(loose, "token", "left")
    weighed = weighed.select("value", "pos", "token", F.coalesce("loose", F.lit(False)).alias("loose"), F.coalesce("token_idf", F.log(F.lit(1.0 + total))).alias("token_idf"))
    weighed = cut(weighed)
    # an entry is accepted with COVER of its rarity at least, so one of its rarest words that hold the rest of it is among them
    meant = cut(weighed.join(matches, "token").select("value", "word", "sim", "pos"))
    options = meant.select("value", "word").distinct().join(weights.filter("lead").select("word", "ref_id"), "word").select("value", "ref_id").distinct()
    hits = options.join(weights.select("ref_id", "word", "idf"), "ref_id").join(meant, ["value", "word"])
    best = hits.groupBy("value", "ref_id", "word").agg(F.max(F.struct("sim", -F.col("pos"))).alias("m"), F.first("idf").alias("idf"))
    best = best.select("value", "ref_id", "idf", F.col("m.sim").alias("sim"), (-F.col("m.col2")).alias("pos"))
    scored = best.groupBy("value", "ref_id").agg(
        F.sum(F.col("sim") * F.col("idf") * F.col("idf")).alias("dot"), F.sum("idf").alias("covered"), F.count(F.lit(1)).alias("words"), F.collect_set("pos").alias("used"), F.min("sim").alias("weakest")
    )
    whole = weighed.groupBy("value").agg(
        F.collect_set(F.when(~F.col("loose"), F.col("pos"))).alias("needed"), F.sum(F.when(~F.col("loose"), F.col("token_idf") * F.col("token_idf")).otherwise(0.0)).alias("value_norm")
    )
    scored = scored.join(whole, "value").join(norms, "ref_id")
    # what the entry matched counts even where it might have been left over
    left = F.size(F.array_except("needed", "used"))
    full = F.col("words") == F.col("entry_words")
    partial = (F.col("covered") >= COVER * F.col("entry_idf")) & ((F.col("words") >= 2) if mode == "title" else F.lit(True))
    scored = scored.withColumn("score", F.col("dot") / F.sqrt(F.greatest("value_norm", "dot") * F.col("entry_norm"))).filter((left == 0) & (full | partial) & (F.col("score") >= LEAST))
    scored = cut(scored.withColumn("full", full).select("value", "ref_id", "score", "full"))
    rank: list[Column] = [F.col("score")]
    if areas:
        same = entries.select("ref_id", "area")
        scored = scored.join(same, "ref_id")
        agrees = scored.join(written.withColumn("agrees", F.lit(1.0)), ["value", "area"], "left").withColumn("agrees", F.coalesce("agrees", F.lit(0.0)))
        scored, rank = agrees, [F.col("score") + 0.35 * F.col("agrees")]
    chosen = scored.groupBy("value").agg(F.max(F.struct(F.col("full").cast("int"), F.round(rank[0], 6), -F.col("ref_id"))).alias("c"), F.count(F.lit(1)).alias("options"), F.max("full").alias("any_full"))
    if mode == "title":
        chosen = chosen.filter("any_full or options = 1")
    chosen = chosen.select("value", (-F.col("c.col3")).alias("ref_id"), F.col("c.col2").alias("score"))
    if mode == "title":
        # initials of an entry, where they are those of one entry only
        parted = F.filter(F.split(F.lower("name"), "[^a-z]+"), lambda x: ~x.isin("", "of", "the", "and"))
        initials = entries.select("ref_id", parted.alias("w")).filter(F.size("w") >= 2)
        initials = initials.select("ref_id", F.array_join(F.transform("w", lambda x: F.substring(x, 1, 1)), "").alias("token")).groupBy("token").agg(F.min("ref_id").alias("short_id"), F.count(F.lit(1)).alias("n")).filter("n = 1")
        only = weighed.filter("not loose").groupBy("value").agg(F.min("token").alias("token"), F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")
        by_initials = only.join(initials, "token").select("value", "short_id")
        chosen = chosen.join(by_initials, "value", "full").select("value", F.coalesce("short_id", "ref_id").alias("ref_id"), F.coalesce("score", F.lit(1.0)).alias("score"))
    if areas:
        codes = entries.select(F.upper("code").alias("code"), F.col("ref_id").alias("code_id")).groupBy("code").agg(F.min("code_id").alias("code_id"))
        coded = values.select("value", F.upper(F.trim("value")).alias("code")).join(codes, "code").select("value", "code_id")
        chosen = chosen.join(coded, "value", "full").select("value", F.coalesce("code_id", "ref_id").alias("ref_id"), F.coalesce("score", F.lit(1.0)).alias("score"))
    return values.join(chosen, "value", "left").select("value", F.coalesce("ref_id", F.lit(0)).cast("long").alias("ref_id"), F.coalesce("score", F.lit(0.0)).alias("score"))


def mapped(records: DataFrame, entries: DataFrame, mode: str, areas: bool = False, extra: DataFrame | None = None) -> DataFrame:
    """``record_key``, ``value``, ``ref_id``, ``score`` of each record (``record_key``, ``value``) that isn't an entry as it stands."""
    open_ = records.filter("value is not null and value <> ''").join(entries.select(F.col("name").alias("value")).distinct(), "value", "left_anti").distinct()
    distinct = open_.select("value").distinct()
    return open_.join(match_values(distinct, entries, mode, areas, extra), "value")
