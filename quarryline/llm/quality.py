"""Text statistics of documents and a verdict whether a text is natural prose.

Per document: words, mean word length, share of symbols, share of digits, share of lines ending in punctuation,
share of common words of its language, share of the text that stands in sentences, share of lines and sentences
that are no sentence. The texts of a language are ranked on each statistic exactly, and so are all texts together:
the statistics are stacked as (statistic, language, value), equal values are counted first, the distinct values are
range-partitioned and sorted, each partition is numbered with running counts, and the partitions' totals are turned
into offsets; the sum of both is the empirical cumulative distribution. An outlier score adds up the negative
logarithms of the tail probabilities, each statistic on the side on which junk lies. Size and word length are
reported but not scored, as short texts and languages with long words are no junk.

The scores of each language, and of all texts, are split in two by the threshold with the largest variance between
the two parts (an exact histogram of the scores). A text whose scores are both below the mean of the lower parts is
prose; one whose scores are both past the mean of the upper parts is junk. Between them the tails can't tell, as
where lists are common or a language has few texts, and an exact check follows: what share of the text stands in
sentences, and whether a single sentence stands among other lines.

Copies of a text are measured where they stand but ranked, scored and judged once. Values and texts that hold a
large share of the rows are joined by broadcast (there are at most ``1 / spread.HOT`` of a group), the others by shuffle,
so no task gets the rows of one value or text. What reaches the driver is one row per language.

Defined results: null and blank texts have no words, all ratios 0, and are no prose; very long texts are
measured whole; repeated rows and ties have the same rank; a language with one document ranks it 1; an empty
table gives an empty result; columns other than the key and the text are not read.
"""

from __future__ import annotations

import re
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.llm.spread import join_spread
from quarryline.session import cut

# Common words that carry sentences; those that stand in names of goods as well (de, of, in) are left out.
COMMON = {
    "en": "the is are was were that with from our we you your they it has have will by this who which when if be can their its and for not on at as to",
    "de": "der die das und ist sind mit für auf nicht ein eine wir sie es wird werden wurde aus bei noch auch den dem am seit wenn ihnen unser unsere im zu",
    "fr": "les des est sont une pour que qui nous vous ce dans sur plus notre avec par si il depuis été votre vos nos la le aux et",
    "es": "los las que para nos es se su sus le una más si por con nuestro nuestra desde la el fue sigue pero también son ha y",
    "it": "che per della delle è gli ci se vi nel nostro nostra una il lo sono stata ma anche più dal con la ancora e",
    "pt": "os as que para nos é se uma mais mas com nosso nossa desde um foi não na no ou também são por e",
    "nl": "het een van is op voor te zijn met wij die dat ook ons onze heeft om nog wordt werd worden altijd als u maar naar elke aan meer dan",
    "pl": "się nie jest na do od oraz że są dla ale też za jeszcze każda nas nasi naszym w z i po przed",
    "ru": "и в не на с что для по из от мы к до за это но как вам если всегда есть наши на",
    "tr": "ve bir bu için ile her çok daha hala iki gün aynı kadar olan size biz ancak eğer hakkındaki beri zaman fazla ayni icin iki",
    "hi": "के का की है हैं में से और को यह पर भी ने तक हम एक हमारी हमारे लिए आपको तो करती थी",
    "ar": "في من على إلى عن مع أن ما لا هذا كل التي بعد قبل كما ثم أكثر كان لكم إذا نحن ولا منذ هذه حتى نفس",
    "zh": "的 了 在 是 我 们 有 和 不 也 从 向 以 可 会 为 您 由 至 都 就 这 与 及 将",
}
WORD_LANGUAGES: dict[str, list[str]] = {}
for _l, _ws in COMMON.items():
    for _w in _ws.split():
        WORD_LANGUAGES.setdefault(_w, []).append(_l)
STATISTICS = ("words", "mean_word_length", "symbol_ratio", "digit_ratio", "ended_lines", "common_share", "sentence_share", "other_share")
#: The scored statistics with the side on which junk lies: the left or the right tail, or both ("lr").
SIDES = {"symbol_ratio": "r", "digit_ratio": "r", "ended_lines": "l", "common_share": "l", "sentence_share": "l", "other_share": "r"}
LEAST_SHARE = 0.5
#: The group of all texts.
EVERY = "*"

TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0900-\u0963\u064b-\u0652\u200c\u200d])*(?:[’'\-][^\W\d_]+)*")
WIDE = re.compile(r"[㐀-鿿]")
UNIT = re.compile(r"(?<=[.!?…])[\"”’»)]*\s+|(?<=[。！？।؟])\s*")
ENDED = re.compile(r"[.!?…。！？।؟:;][\"”’»)]*$")
ITEM = re.compile(r"^\s*(?:[-*•–·>#|]|\d+[.)]|[a-z][.)])\s+")


def _has_words(line: str, least: int) -> bool:
    """Whether a line has at least ``least`` words; two ideographs count as a word."""
    got = sum(1 for _ in islice(TOKEN.finditer(line), least))
    return got >= least or got + len(WIDE.findall(line)) // 2 >= least


def unwrapped(text: str) -> list[str]:
    """The lines of a text, with lines that go on joined: a line of several words followed by one that begins small, or where no sentence has ended."""
    out: list[list[str]] = []
    for line in text.split("\n"):
        s = line.strip()
        if not s:
            out.append([])
            continue
        if out and (run := out[-1]) and not ITEM.match(s) and not ITEM.match(run[0]) and not ENDED.search(run[-1][-8:]) and "\t" not in line:
            first = s[0]
            long = sum(map(len, islice(run, 45))) + len(run) - 1 >= 45
            if (first.islower() or not first.isupper() and not first.isdigit() or long) and (len(run) > 1 or _has_words(run[0], 4)):
                run.append(s)
                continue
        out.append([s])
    return [" ".join(run) for run in out if run]


def sentence_like(unit: str, words: list[str], wide: list[str], language: str) -> bool:
    """Whether a unit with its words (lowered) and ideographs reads as a running sentence: words in a row, with the words that carry sentences among them."""
    if len(wide) >= 6:
        carried = sum(c in _ZH for c in wide)
        return carried >= max(1, len(wide) // 14) and not SPLIT.search(unit) and unit.count(",") < 4
    if len(words) < 4:
        return False
    own = _SETS.get(language, frozenset())
    carried = sum(w in own for w in words)
    if carried < max(1, len(words) // 12) or len(set(words)) < 0.45 * len(words):
        return False
    commas = unit.count(",")
    if unit.count("  ") >= 3 or commas >= 3 and len(words) < 3.5 * commas:
        return False
    if unit.lstrip(OPENING)[:1].islower() and not ENDED.search(unit):
        return False
    if len(CAMEL.findall(unit)) > 0.2 * len(words):
        return False
    if sum(map(len, words)) < 0.62 * len(unit.replace(" ", "")):
        return False
    return not PARTED.search(unit)


SPLIT = re.compile(r"[|;\t]")
PARTED = re.compile(r"[|\t{}]|(?: / .*){3}|(?: [·•»] .*){3}")
CAMEL = re.compile(r"[a-z][A-Z]")
DIGIT = re.compile(r"\d")
OPENING = "\"“«'([¿¡—–- "
_SETS = {l: frozenset(w.split()) for l, w in COMMON.items()}
_ZH = _SETS["zh"]


def measures(text: str | None) -> tuple:
    """The statistics, the numbers of sentences and of other lines, and the language."""
    if text is None or not text.strip():
        return (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0, 0, "none")
    lines = [[(u, [w.lower() for w in TOKEN.findall(u)], [] if u.isascii() else WIDE.findall(u)) for u in UNIT.split(line) if u and u.strip()] for line in unwrapped(text)]
    dense = len("".join(text.split()))
    digits = len(DIGIT.findall(text))
    n_words = letters = n_wide = common_wide = with_wide = 0
    counts: dict[str, int] = {}
    for line in lines:
        for _, words, wide in line:
            n_words += len(words)
            letters += sum(map(len, words))
            for w in words:
                if w in WORD_LANGUAGES:
                    for l in WORD_LANGUAGES[w]:
                        counts[l] = counts.get(l, 0) + 1
            if wide:
                n_wide += len(wide)
                common_wide += sum(c in _ZH for c in wide)
                with_wide += sum(1 for w in words if WIDE.search(w))
    if n_wide > 0.3 * dense:
        language = "zh"
    else:
        language = max(sorted(counts), key=lambda l: counts[l]) if counts else "none"
    inside = sentences = others = ended = 0
    for line in lines:
        hit = 0
        for unit, words, wide in line:
            if sentence_like(unit, words, wide, language):
                inside += len("".join(unit.split()))
                hit += 1
        sentences += hit
        others += not hit
        ended += bool(line) and bool(ENDED.search(line[-1][0].rstrip()[-8:]))
    if language == "zh":
        shown, mean, common = n_wide // 2 + n_words - with_wide, 2.0, common_wide / max(1, n_wide)
    else:
        shown, mean, common = n_words, letters / max(1, n_words), counts.get(language, 0) / max(1, n_words)
    share = lambda part, whole: round(max(0, part) / max(1, whole), 4)
    return (
        shown, round(mean, 3), share(dense - letters - digits, dense), share(digits, dense), share(ended, len(lines)), round(common, 4),
        min(1.0, share(inside, dense)), share(others, others + sentences), sentences, others, language,
    )


MEASURES = T.StructType(
    [T.StructField("words", T.LongType())]
    + [T.StructField(s, T.DoubleType()) for s in STATISTICS[1:]]
    + [T.StructField("sentences", T.LongType()), T.StructField("other_lines", T.LongType()), T.StructField("text_language", T.StringType())]
)


@F.pandas_udf(MEASURES)
def _measures(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measures(t) for t in texts], columns=[f.name for f in MEASURES.fields])


def with_measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the statistics of ``text``."""
    names = [f.name for f in MEASURES.fields]
    return df.withColumn("__m", _measures(F.col(text))).select(*[c for c in df.columns if c not in names], *[F.col(f"__m.{n}") for n in names])


def exact_ranks(values: DataFrame, partitions: int | None = None) -> DataFrame:
    """``statistic``, ``lang``, ``value``, ``n``, ``at_most``, ``at_least``, ``total``: how many rows of the group have, are at most, or at least, each distinct value.

    ``values`` has ``statistic``, ``lang``, ``value``. Distinct values with their counts are range-partitioned; a running
    count within each partition plus the totals of the partitions before it is the rank.
    """
    counted = values.groupBy("statistic", "lang", "value").agg(F.count(F.lit(1)).alias("n"))
    n = partitions or int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(counted.repartitionByRange(n, "statistic", "lang", "value").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part", "statistic", "lang").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    totals = ranged.groupBy("part", "statistic", "lang").agg(F.sum("n").alias("part_total"))
    before = Window.partitionBy("statistic", "lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("statistic", "lang")
    offsets = totals.withColumns({"offset": F.coalesce(F.sum("part_total").over(before), F.lit(0)), "total": F.sum("part_total").over(group)}).drop("part_total")
    ranked = ranged.withColumn("running", F.sum("n").over(inside)).join(offsets, ["part", "statistic", "lang"])
    at_most = F.col("offset") + F.col("running")
    return ranked.select("statistic", "lang", "value", "n", at_most.alias("at_most"), (F.col("total") - at_most + F.col("n")).alias("at_least"), "total")


def splits(scores: DataFrame) -> DataFrame:
    """``lang``, ``low``, ``high``: below which scores of a language are those of prose, and past which they are those of junk.

    ``scores`` has ``lang`` and ``score``. The split maximizes the variance between its two sides; ``low`` is the mean of the
    lower side, ``high`` the middle between the split and the mean of the upper side. A group with one score has neither.
    """
    histogram = scores.groupBy("lang", F.round("score", 2).alias("score")).agg(F.count(F.lit(1)).alias("n"))  # scores are sums of logarithms: some thousands of values
    upto = Window.partitionBy("lang").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("lang")
    mass = F.col("n") * F.col("score")
    sides = histogram.withColumns({"n0": F.sum("n").over(upto), "s0": F.sum(mass).over(upto), "all_n": F.sum("n").over(group), "all_s": F.sum(mass).over(group)}).filter("n0 < all_n")
    mean0, mean1 = F.col("s0") / F.col("n0"), (F.col("all_s") - F.col("s0")) / (F.col("all_n") - F.col("n0"))
    between = F.col("n0") * (F.col("all_n") - F.col("n0")) * (mean0 - mean1) * (mean0 - mean1)
    best = sides.groupBy("lang").agg(F.max_by(F.struct(mean0.alias("low"), mean1.alias("high")), F.struct(between, -F.col("score"))).alias("b"))
    return best.select("lang", "b.low", "b.high")


def scored(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` with the statistics of ``text``, ``outlier_score`` and ``is_prose``; ``key`` is unique."""
    measured = cut(with_measures(documents.select(key, text, F.sha2(F.coalesce(text, F.lit("")), 256).alias("digest")), text).drop(text))
    facts = [f.name for f in MEASURES.fields]
    once = cut(measured.groupBy("digest").agg(F.first(F.struct(*facts)).alias("m"), F.count(F.lit(1)).alias("copies")).select("digest", "copies", "m.*"))
    stacked = F.explode(F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("value")) for s in SIDES])).alias("x")
    # each text is ranked in its language and among all texts
    groups = F.explode(F.when(F.col("text_language") == "none", F.array(F.lit(EVERY))).otherwise(F.array(F.lit(EVERY), F.col("text_language")))).alias("lang")
    long = once.select("digest", groups, *SIDES).select("digest", "lang", stacked).select("digest", "lang", "x.statistic", "x.value")
    left, right = -F.log(F.col("at_most") / F.col("total")), -F.log(F.col("at_least") / F.col("total"))
    side = F.create_map(*[x for s, d in SIDES.items() for x in (F.lit(s), F.lit(d))])[F.col("statistic")]
    tail = F.when(side == "l", left).when(side == "r", right).otherwise(F.greatest(left, right))
    ranks = exact_ranks(long.select("statistic", "lang", "value")).select("statistic", "lang", "value", tail.alias("tail"), (F.col("n") / F.col("total")).alias("share"))
    scores = cut(join_spread(long, ranks, ["statistic", "lang", "value"], "share").groupBy("digest", "lang").agg(F.sum("tail").alias("score")))
    judged = scores.join(F.broadcast(splits(scores)), "lang", "left")  # one row per language
    judged = judged.groupBy("digest").agg(
        F.round(F.min("score"), 4).alias("outlier_score"), F.coalesce(F.bool_and(F.col("score") < F.col("low")), F.lit(False)).alias("low"), F.coalesce(F.bool_and(F.col("score") >= F.col("high")), F.lit(False)).alias("high")
    )
    unlike_prose = (F.col("sentence_share") < LEAST_SHARE) | ((F.col("sentences") <= 1) & (F.col("other_lines") >= 3))
    verdict = F.when(F.col("words") == 0, F.lit(False)).when(F.col("high"), False).when(F.col("low"), True).otherwise(~unlike_prose)
    total = once.agg(F.sum("copies").alias("rows")).collect()[0]["rows"] or 1
    of_text = once.join(judged, "digest").select("digest", "outlier_score", verdict.alias("is_prose"), (F.col("copies") / F.lit(total)).alias("share"))
    return join_spread(measured, of_text, ["digest"], "share").drop("digest")
