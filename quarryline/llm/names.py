"""Variant spellings of the names of people and companies, linked within a domain.

Names are normalized (look-alikes, titles, legal forms, order around a comma) and become vectors of weighted
character n-grams: bigrams, trigrams and unordered pairs of letters at most two apart, of each word, customary short
forms of given names written out and initials left out. A gram weighs by its rarity, from counts over all names; grams
are hashed to ``BUCKETS`` places, so that the weights have one size however many names there are.

A sparse product of the vectors of a domain with themselves gives the cosines. Domains are cut into chunks of about
``CHUNK`` names and each pair of chunks is a block, so a domain with a third of all rows is many blocks of bounded
size; small domains are multiplied many at a time. Every pair at or above ``LEAST_COSINE`` is kept: the threshold
alone bounds the partners of a name (``top`` keeps the best n of each, with ties, where a caller wants no more). An
exact check of each such pair follows, on how the words agree as given and family names, since relatives share most of
their grams. Pairs that pass are linked with their cosine and grouped by average linkage, in which pairs without a link
count as 0: in each round all clusters that are each other's nearest merge, which gives what merging one by one gives,
and no component is brought into one task.

Defined results: rows without a domain or a name are left out; names that differ only in case, spaces or look-alike
characters are one spelling; names equal as stored share a cluster; names without letters only link where equal; very
long names are compared whole; ties of nearest clusters go to the smaller label; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.llm.lookalikes import canonical
from quarryline.llm.spread import broadcast_checked, join_spread
from quarryline.session import cut

LEAST_COSINE = 0.25
LEAST_AGREEMENT = 0.6
AVERAGE = 0.2
BUCKETS = 1 << 16
CHUNK = 1000
#: So many cells of products are worked on at once.
CELLS = 4_000_000
#: A given name is common if at least one in so many spellings has it; so there are at most so many.
COMMON = 2500

# Forms of address and degrees that are no part of a name.
TITLES = frozenset("mr mrs ms miss mx dr prof eng shri smt sri sir madam mme herr frau ing adv capt er ca hon rev mba phd md jr sr esq cpa bsc msc ma ba dba pmp prof".split())
# Legal forms and what joins them.
LEGAL = frozenset("co company corp corporation inc incorporated ltd limited llc llp plc pvt private p gmbh ag sa srl spa bv nv oy ab kg lp the and".split())
COMPANY_SIGNS = frozenset("co company corp corporation inc incorporated ltd limited llc llp plc pvt private gmbh intl international brothers bros group enterprises industries services traders exports impex logistics holdings".split())
SAME_WORD = {"intl": "international", "int": "international", "bros": "brothers", "svcs": "services", "mfg": "manufacturing", "inds": "industries", "ind": "industries", "ent": "enterprises", "assoc": "associates"}
# Customary short forms of given names.
NICKNAMES = {
    "robert": "rob robbie bob bobby bert", "william": "will willy willie bill billy liam", "anthony": "tony ant", "katherine": "kate katie kathy kat kathie kitty kay catherine cathy",
    "elizabeth": "liz lizzie lizzy beth betty bess eliza lisa libby", "susan": "sue suzie suzy susie", "jose": "pepe chepe", "christopher": "chris kit topher", "thomas": "tom tommy",
    "richard": "dick rick ricky rich richie", "margaret": "peggy maggie meg marge greta", "michael": "mike mick mickey micky misha", "joseph": "joe joey jo", "edward": "ed eddie ted ned teddy",
    "alexander": "alex sasha sandy xander aleks", "nicholas": "nick nicky nico klaus kolya", "stephen": "steve stevie", "rebecca": "becky becca", "patricia": "pat patty trish tricia pattie",
    "gabriela": "gabi gaby", "daniel": "dan danny", "daniela": "dani", "dmitri": "dima mitya", "sergei": "serge seryozha", "francisco": "paco pancho kiko fran", "francois": "fran", "olga": "olya", "ivan": "vanya",
    "rajendra": "raj raju rajinder", "vikram": "vik vicky", "venkatesh": "venkat venky", "mohammed": "mohd md mo muhammad", "lucia": "lucy", "maria": "mary marie", "deepak": "dipak deep", "priya": "pri", "lukasz": "luke",
    "john": "jack johnny jon", "james": "jim jimmy jamie", "charles": "charlie chuck", "henry": "harry hank", "andrew": "andy drew", "matthew": "matt", "samuel": "sam", "benjamin": "ben", "david": "dave", "anna": "annie ania", "natalia": "natasha", "andrea": "andi",
    "ibrahim": "ebrahim brahim ibraheem", "yusuf": "youssef yousuf yousef yusef", "fatima": "fatma fatimah fathima", "tariq": "tarek tareq tarik", "noor": "nur nour noura", "jurgen": "juergen", "sergey": "sergei",
}
FULL: dict[str, set[str]] = {}
for _full, _short in NICKNAMES.items():
    for _s in (_full, *_short.split()):
        FULL.setdefault(_s, set()).add(_full)
FOLD = str.maketrans({"ı": "i", "ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d"})


def fold(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.lower().translate(FOLD))
    return unicodedata.normalize("NFC", "".join(c for c in text if not ("̀" <= c <= "ͯ")))


@functools.lru_cache(200_000)
def parse(name: str) -> tuple[str, tuple[str, ...], bool, bool]:
    """The kind (person or company), the words, whether the family name is known to be last, and whether words were run together."""
    text = " ".join(canonical(name)[0].split())
    text = re.sub(r"^\s*m/s\b\.?", "", text, flags=re.I)
    joined = bool(re.search(r"[a-zà-ÿ][A-ZÀ-Þ][a-zà-ÿ]", text))
    if joined and " " not in text.strip():
        text = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ][a-zà-ÿ])", " ", text)
    low = fold(text)
    words = re.sub(r"['’.]", "", re.sub(r"\b([a-z])\.(?=[a-z]\b)", r"\1 ", low))
    plain = re.findall(r"[^\W_]+", words)
    if plain and (set(plain) & {"co", "company", "corp", "corporation", "inc", "ltd", "limited", "llc", "pvt", "gmbh", "intl", "international", "brothers", "bros"} or "&" in text or sum(w in COMPANY_SIGNS for w in plain) and len(plain) > 1 and plain[-1] in COMPANY_SIGNS):
        core = tuple(SAME_WORD.get(w, w) for w in plain if w not in LEGAL)
        return "company", core or tuple(plain), True, False
    words = re.sub(r"\((?:[^()]*)\)", lambda m: " " if set(re.findall(r"\w+", m.group())) <= TITLES else m.group(), words)
    parts = [p.strip() for p in words.split(",")]
    parts = [" ".join(w for w in re.findall(r"[^\W_]+(?:-[^\W_]+)*", p) if w not in TITLES) for p in parts]
    parts = [p for p in parts if p]
    sure = False
    if len(parts) == 2:
        ordered = f"{parts[1]} {parts[0]}".split()
        sure = True
    else:
        ordered = " ".join(parts).split()
    return "person", tuple(ordered), sure, joined


@functools.lru_cache(100_000)
def sound(given: str) -> str:
    """A given name without the differences between its transliterations."""
    g = given.replace("-", "")
    for a, b in (("sch", "s"), ("sh", "s"), ("ch", "k"), ("ck", "k"), ("ph", "f"), ("th", "t"), ("sz", "s"), ("cz", "s"), ("ts", "s"), ("kh", "k"), ("x", "ks"), ("c", "k"), ("q", "k"), ("w", "v"), ("oo", "u"), ("ou", "u"), ("ue", "u"), ("oe", "o"), ("ee", "i"), ("y", "i"), ("z", "s"), ("h", "")):
        g = g.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", g)


def slip(a: str, b: str) -> bool:
    """Whether one insertion, deletion, replacement or transposition lies between the two."""
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


def two_slips(a: str, b: str) -> bool:
    """Whether two slips lie between the two: one slip from every place where ``a`` can be mended once."""
    if abs(len(a) - len(b)) > 2:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return slip(x[1:], y[1:]) or slip(x[1:], y) or slip(x, y[1:]) or (x[:2] == y[:2][::-1] and slip(x[2:], y[2:]))


def gendered(a: str, b: str) -> bool:
    """Whether two given names differ by a final vowel only, as those of men and women do."""
    if a == b:
        return False
    short, long = sorted((a, b), key=len)
    if len(long) == len(short) + 1:
        return long[:-1] == short and long[-1] in "aoe" and len(short) >= 3
    return len(a) == len(b) >= 4 and a[:-1] == b[:-1] and a[-1] in "aoei" and b[-1] in "aoei" and "i" not in (a[-1], b[-1])


@functools.lru_cache(200_000)
def given_score(a: str, b: str, common_a: bool, common_b: bool) -> float:
    """How well two given names can be of one person; ``common``: whether many people bear that very spelling."""
    if a == b:
        return 1.0
    fa, fb = a.replace("-", ""), b.replace("-", "")
    if fa == fb:
        return 1.0
    short, long = sorted((a, b), key=len)
    if len(short) == 1:
        return 0.8 if short == long[0] else 0.7 if any(f[0] == short for f in FULL.get(long, ())) else 0.0
    if gendered(a, b):
        return 0.0
    if "-" in long and short == "".join(p[:1] for p in long.split("-")):
        return 0.8
    if FULL.get(a, set()) & FULL.get(b, set()):
        return 0.95
    if "-" in long and short == long.split("-")[0]:
        return 0.8
    sa, sb = sound(a), sound(b)
    if sa == sb:
        return 0.95
    bones = lambda x: re.sub(r"[aeiou]", "", x)
    if a[0] == b[0] and len(bones(sa)) >= 3 and bones(sa) == bones(sb):
        return 0.9
    if len(short) >= 3 and long.startswith(short) and len(long) - len(short) >= 2:
        return 0.85
    if common_a and common_b:
        return 0.75 if len(sa) >= 6 and len(sb) >= 6 and slip(sa, sb) else 0.0
    if len(short) >= 3 and slip(a, b):
        return 0.9
    # a slip in a nickname or another transliteration of a known name
    for known, other in ((a, b), (b, a)):
        if known in FULL and other not in FULL and len(other) >= 3:
            spellings = {n for f in FULL[known] for n in (f, *NICKNAMES[f].split())}
            if any(slip(other, n) and not gendered(other, n) for n in spellings if len(n) >= 3):
                return 0.8
    if a[0] == b[0] and min(len(sa), len(sb)) >= 4 and slip(sa, sb):
        return 0.8
    return 0.0


def family_score(a: str, b: str) -> float:
    if a == b:
        return 1.0
    fa, fb = a.replace("-", ""), b.replace("-", "")
    if min(len(fa), len(fb)) >= 3 and slip(fa, fb):
        return 0.9
    if min(len(fa), len(fb)) >= 7 and two_slips(fa, fb):
        return 0.7
    pa, pb = a.split("-"), b.split("-")
    if len(pa) != len(pb):
        few, many = (pa, pb) if len(pa) < len(pb) else (pb, pa)
        if len(few) == 1 and len(few[0]) >= 4 and any(x == few[0] for x in many):
            return 0.85
        if len(few) == 1 and len(few[0]) >= 5 and any(slip(x, few[0]) for x in many):
            return 0.75
    return 0.0


def orders(words: tuple[str, ...], sure: bool, common: frozenset) -> list[tuple[str, tuple[str, ...], str]]:
    """The ways to read the words as given name, middle initials and family name."""
    if len(words) == 1:
        return [("", (), words[0])]
    out = []
    turned = words[1:] + words[:1]
    known = lambda x: len(x) == 1 or x in common or x in FULL
    ways = (words,) if sure or known(words[0]) else (turned,) if known(words[-1]) else (words, turned)
    for w in ways:
        head, last = w[:-1], w[-1]
        if len(last) == 1:
            continue
        first, rest = head[0], head[1:]
        middle = tuple(x for x in rest if len(x) == 1)
        more = [x for x in rest if len(x) > 1]
        out.append(("-".join([first, *more]), middle, last))
        if more and len(more) == 1:
            # the second word may belong to the family name
            out.append((first, middle, f"{more[0]}-{last}"))
    return out


def person_score(a: tuple, b: tuple, common: frozenset) -> float:
    best = 0.0
    for ga, ma, la in orders(a[0], a[1], common):
        for gb, mb, lb in orders(b[0], b[1], common):
            family = family_score(la, lb)
            if not family or not ga or not gb:
                continue
            given = given_score(ga, gb, ga in common, gb in common)
            if not given:
                # two initials written as one word
                for g, h, m in ((ga, gb, mb), (gb, ga, ma)):
                    if len(g) == 2 and g not in common and g[0] == h[0] and (g[1] in m or not m and not re.search("[aeiou]", g)):
                        given = 0.8 if m else 0.7
            if not given:
                continue
            if ma and mb and not set(ma) & set(mb):
                continue
            best = max(best, family * given * (1.0 if bool(ma) == bool(mb) else 0.97))
    return best


def agreement(a: tuple[str, tuple[str, ...], bool], b: tuple[str, tuple[str, ...], bool], common: frozenset) -> float:
    """How well two names (kind, words, whether the family name is known to be last) can be of one person or company."""
    ka, wa, sa = a
    kb, wb, sb = b
    if not wa or not wb or ka != kb:
        return 0.0
    if wa == wb:
        return 1.0
    if ka == "company":
        if len(wa) == len(wb) and all(x == y or len(x) >= 4 and slip(x, y) for x, y in zip(wa, wb, strict=True)):
            return 0.95
        return 0.9 if "".join(wa) == "".join(wb) or slip("".join(wa), "".join(wb)) else 0.0
    if sorted(wa) == sorted(wb) or "".join(wa) == "".join(wb):
        return 0.97
    return person_score((wa, sa), (wb, sb), common)


# ---- vectors and their cosines -------------------------------------------------------------------------------


def grams(words: list[str]) -> set[str]:
    """The n-grams of a name's words."""
    words = [w for x in words for w in x.split("-") if w]
    if len(words) > 1:
        words = [w for w in words if len(w) > 1] or words
    out: set[str] = set()
    for w in words:
        for form in FULL.get(w, (w,)):
            p = f" {form} "
            out.update(p[i : i + n] for n in (2, 3) for i in range(max(1, len(p) - n + 1)))
            out.update("~" + "".join(sorted((p[i], p[i + k]))) for k in (1, 2) for i in range(len(p) - k))
    return out


@functools.lru_cache(100_000)
def _word_places(word: str) -> np.ndarray:
    return np.array(sorted({zlib.crc32(g.encode()) % BUCKETS for g in grams([word])}), dtype=np.int64)


def places(norm: str) -> np.ndarray:
    """The places of the n-grams of a normalized name."""
    words = norm[2:].replace("-", " ").split()
    if len(words) > 1:
        words = [w for w in words if len(w) > 1] or words
    if not words:
        return np.empty(0, dtype=np.int64)
    return _word_places(words[0]) if len(words) == 1 else np.unique(np.concatenate([_word_places(w) for w in words]))


NORM = T.StructType([T.StructField("norm", T.StringType()), T.StructField("sure", T.BooleanType()), T.StructField("given", T.StringType())])


@F.pandas_udf(NORM)
def _norm(names: pd.Series) -> pd.DataFrame:
    rows = []
    for n in names:
        kind, words, sure, _ = parse(n)
        given = words[0] if kind == "person" and len(words) > 1 and len(words[0]) > 2 else None
        rows.append((f"{kind[0]}:{' '.join(words)}", sure, given))
    return pd.DataFrame(rows, columns=["norm", "sure", "given"])


def _count_places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for frame in frames:
        for n in frame["norm"]:
            total[places(n)] += 1
    at = np.flatnonzero(total)
    yield pd.DataFrame({"place": at, "n": total[at]})


def rarity(nodes: DataFrame) -> np.ndarray:
    """The weight of each place by the number of names of ``nodes`` that have a gram there; ``BUCKETS`` numbers."""
    counted = nodes.select("norm").mapInPandas(_count_places, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    held = np.zeros(BUCKETS)
    for r in counted:
        held[r["place"]] = r["n"]
    return np.log(1 + nodes.count() / np.maximum(held, 1)).astype(np.float32)


def common_given(nodes: DataFrame) -> frozenset:
    """The given names that at least one in ``COMMON`` of the names with one has; at most ``COMMON`` reach the driver."""
    given = nodes.filter("given is not null")
    total = given.count()
    rows = given.groupBy("given").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * COMMON >= total).collect()
    return frozenset(r["given"] for r in rows)


def products(vectors: list[np.ndarray], blocks: np.ndarray, weights: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers ``i`` < ``j`` and cosines of the pairs of rows of one block (``blocks`` is sorted) with at least ``least``."""
    sizes = np.bincount(blocks)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    offset = np.concatenate([[0], np.cumsum(sizes * sizes)])
    counts = np.array([len(v) for v in vectors])
    row = np.repeat(np.arange(len(vectors)), counts)
    place = np.concatenate(vectors) if len(vectors) else np.empty(0, dtype=np.int64)
    w = weights[place].astype(np.float64)
    norm = np.sqrt(np.bincount(row, w * w, minlength=len(vectors)))
    w /= np.maximum(norm, 1e-9)[row]
    key = blocks[row] * BUCKETS + place
    order = np.lexsort((row, key))
    key, row, w = key[order], row[order], w[order]
    # each entry meets those after it in its run of equal keys
    end = np.searchsorted(key, key, side="right")
    meets = end - np.arange(len(key)) - 1
    sums = np.zeros(offset[-1])
    upto = np.cumsum(meets)
    start = 0
    while start < len(key):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + CELLS, side="right")))
        left = np.repeat(np.arange(start, stop), meets[start:stop])
        if len(left):
            ahead = np.arange(len(left)) - np.repeat(np.cumsum(meets[start:stop]) - meets[start:stop], meets[start:stop])
            right = left + 1 + ahead
            b = blocks[row[left]]
            slot = offset[b] + (row[left] - first[b]) * sizes[b] + row[right] - first[b]
            sums += np.bincount(slot, w[left] * w[right], minlength=len(sums))
        start = stop
    hit = np.flatnonzero(sums >= least - 1e-9)
    b = np.searchsorted(offset, hit, side="right") - 1
    inside = hit - offset[b]
    return first[b] + inside // sizes[b], first[b] + inside % sizes[b], np.round(sums[hit], 9)


def with_blocks(nodes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``nodes`` (``domain``, ``norm``) with ``lo``, ``hi``, ``part``: once for each pair of chunks of its domain that has its own, ``part``."""
    many = nodes.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > chunk)
    chunks = many.select("domain", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    sized = nodes.join(broadcast_checked(chunks), "domain", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    part = F.pmod(F.xxhash64("norm"), F.col("chunks")).cast("int")
    each = sized.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return each.withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")}).drop("other", "chunks")


LINKS = "domain string, a string, b string, cosine double"


def similar(nodes: DataFrame, weights: np.ndarray, common: frozenset | None, least: float = LEAST_COSINE, chunk: int = CHUNK, top: int | None = None) -> DataFrame:
    """Pairs ``a`` < ``b`` of names (``domain``, ``norm``, ``sure``) of one domain with a cosine of at least ``least``.

    With ``common``, only those that the exact check accepts. With ``top``, only those among the ``top`` best of ``a`` or
    of ``b``, ties included.
    """

    def product(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []  # rows of whole blocks and of one that may go on
        cells = last = 0

        def work(rows: list[tuple]) -> pd.DataFrame:
            keys = [r[:3] for r in rows]
            new = np.array([1] + [int(x != y) for x, y in zip(keys[1:], keys, strict=False)])
            i, j, cosine = products([places(r[4]) for r in rows], np.cumsum(new) - 1, weights, least)
            out = []
            for x, y, c in zip(i.tolist(), j.tolist(), cosine.tolist(), strict=True):
                a, b = rows[x], rows[y]
                # a pair of one chunk is the matter of that chunk's own block
                if a[3] == b[3] and a[1] != a[2]:
                    continue
                if common is None or agreement((_KINDS[a[4][0]], _words(a[4]), a[5]), (_KINDS[b[4][0]], _words(b[4]), b[5]), common) >= LEAST_AGREEMENT:
                    out.append((a[0], min(a[4], b[4]), max(a[4], b[4]), c))
            return pd.DataFrame(out, columns=["domain", "a", "b", "cosine"])

        for frame in frames:
            for r in frame[["domain", "lo", "hi", "part", "norm", "sure"]].itertuples(index=False, name=None):
                if held and held[-1][:3] != r[:3]:
                    size = len(held) - last
                    cells, last = cells + size * size, len(held)
                    if cells >= CELLS:
                        yield work(held)
                        held, cells, last = [], 0, 0
                held.append(r)
        if held:
            yield work(held)

    blocks = with_blocks(nodes.select("domain", "norm", "sure"), chunk)
    order = ["domain", "lo", "hi"]
    pairs = blocks.repartition(*order).sortWithinPartitions(*order, "norm").mapInPandas(product, LINKS)
    if top is None:
        return pairs
    sides = pairs.select("*", F.col("a").alias("name")).unionByName(pairs.select("*", F.col("b").alias("name")))
    ranked = sides.groupBy("domain", "name").agg(F.sort_array(F.collect_list("cosine"), asc=False).alias("c"))  # as many as the partners of one name
    worst = ranked.select("domain", "name", F.when(F.size("c") > top, F.element_at("c", top)).otherwise(F.lit(0.0)).alias("worst"))
    near = sides.join(worst, ["domain", "name"]).filter(F.col("cosine") >= F.col("worst"))
    return near.select("domain", "a", "b", "cosine").distinct()


_KINDS = {"p": "person", "c": "company"}


@functools.lru_cache(100_000)
def _words(norm: str) -> tuple[str, ...]:
    return tuple(norm[2:].split(" ")) if len(norm) > 2 else ()


# ---- average linkage -------------------------------------------------------------------------------------------


def average_linkage(links: DataFrame, least: float = AVERAGE) -> DataFrame:
    """``domain``, ``node``, ``cluster`` of the names in ``links`` (``domain``, ``a`` < ``b``, ``cosine``).

    All clusters that are each other's nearest merge at once, until no two are at least ``least`` alike on average.
    """
    now = cut(links.select("domain", "a", "b", F.col("cosine").alias("s"), F.lit(1).cast("long").alias("na"), F.lit(1).cast("long").alias("nb")))
    of = now.select("domain", F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("cluster", F.col("node"))
    while True:
        # ties go to the smaller labels, in one order for both sides
        rank = F.struct((-F.col("s") / (F.col("na") * F.col("nb"))).alias("far"), F.col("a").alias("lo"), F.col("b").alias("hi"))
        live = now.filter(F.col("s") >= least * F.col("na") * F.col("nb")).withColumn("rank", rank)
        ends = live.select("domain", "rank", F.explode(F.array("a", "b")).alias("x"))
        nearest = ends.groupBy("domain", "x").agg(F.min("rank").alias("r")).select("domain", "r.lo", "r.hi")
        merged = cut(nearest.groupBy("domain", "lo", "hi").agg(F.count(F.lit(1)).alias("ends")).filter("ends = 2").select("domain", "lo", "hi"))
        if not merged.limit(1).count():
            return of
        sizes = live.select("domain", F.col("a").alias("lo"), F.col("b").alias("hi"), (F.col("na") + F.col("nb")).alias("size"))
        grown = cut(merged.join(sizes, ["domain", "lo", "hi"]))
        to = grown.select("domain", F.explode(F.array(F.struct(F.col("lo").alias("x"), F.col("lo").alias("to")), F.struct(F.col("hi").alias("x"), F.col("lo").alias("to")))).alias("m"), "size")
        to = to.select("domain", "m.x", "m.to", "size")
        of = of.join(to.select("domain", F.col("x").alias("cluster"), "to"), ["domain", "cluster"], "left").select("domain", "node", F.coalesce("to", "cluster").alias("cluster"))
        new = now.join(to.select("domain", F.col("x").alias("a"), F.col("to").alias("ta"), F.col("size").alias("sa")), ["domain", "a"], "left")
        new = new.join(to.select("domain", F.col("x").alias("b"), F.col("to").alias("tb"), F.col("size").alias("sb")), ["domain", "b"], "left")
        x = F.struct(F.coalesce("ta", "a").alias("c"), F.coalesce("sa", "na").alias("n"))
        y = F.struct(F.coalesce("tb", "b").alias("c"), F.coalesce("sb", "nb").alias("n"))
        new = new.select("domain", F.least(x, y).alias("p"), F.greatest(x, y).alias("q"), "s").filter("p.c <> q.c")
        now = cut(new.groupBy("domain", "p", "q").agg(F.sum("s").alias("s")).select("domain", F.col("p.c").alias("a"), F.col("q.c").alias("b"), "s", F.col("p.n").alias("na"), F.col("q.n").alias("nb")))


def clusters(people: DataFrame) -> DataFrame:
    """``id``, ``domain``, ``name``, ``cluster`` of each named row of ``people``; labels are unique within a domain."""
    rows = people.select("id", "domain", "name").filter("domain is not null and name is not null and trim(name) <> ''").withColumn("n", _norm("name"))
    rows = cut(rows.select("id", "domain", "name", "n.*"))
    nodes = cut(rows.groupBy("domain", "norm").agg(F.bool_or("sure").alias("sure"), F.min("given").alias("given"), F.count(F.lit(1)).alias("rows")))
    links = similar(nodes, rarity(nodes), common_given(nodes))
    of = average_linkage(links).withColumnRenamed("node", "norm")
    total = rows.count() or 1
    labels = nodes.join(of, ["domain", "norm"], "left").select("domain", "norm", F.coalesce("cluster", "norm").alias("cluster"), (F.col("rows") / F.lit(total)).alias("share"))
    return join_spread(rows.select("id", "domain", "name", "norm"), cut(labels), ["domain", "norm"], "share").select("id", "domain", "name", "cluster")


def linked_pairs(people: DataFrame) -> DataFrame:
    """``id_a`` < ``id_b`` of rows of one domain that name the same under names not equal as stored.

    Spellings are paired first, so rows equal as stored, however many, never meet one another.
    """
    members = cut(clusters(people))
    spelt = members.select("domain", "cluster", "name").distinct()
    x, y = spelt.withColumnRenamed("name", "name_a"), spelt.withColumnRenamed("name", "name_b")
    pairs = x.join(y, ["domain", "cluster"]).filter("name_a < name_b").select("domain", "name_a", "name_b")
    a = members.select("domain", F.col("name").alias("name_a"), F.col("id").alias("a"))
    b = members.select("domain", F.col("name").alias("name_b"), F.col("id").alias("b"))
    met = pairs.join(a, ["domain", "name_a"]).join(b, ["domain", "name_b"])
    return met.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()
