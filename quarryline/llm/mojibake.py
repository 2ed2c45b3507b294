"""Text decoded with the wrong character encoding: finding it and restoring the original.

1. Twins. Every word with a character outside ASCII (or a question mark inside) is counted over all texts. Its
   skeleton is the word stripped of those characters. Of the words of one skeleton the most frequent and the one of
   the most usual pairs of characters are joined with the others. Which side is the clean one is told by how many
   distinct words have the pairs of characters of each, so a garbled text with many copies is no twin of its clean
   words; the counts decide only where that is near equal. Words that keep no skeleton (other scripts) are joined
   with the word that a transformation turns them into.
2. Alignment. The ASCII runs of a pair coincide, so its other runs pair up character by character: each clean
   character with the one in its place, or with the several that its bytes became. Tables of bytes tell which
   transformations (written in encoding A, read as B, once or more often) make the one of the other; those that do so
   for every character of the pair explain it, and one that explains enough distinct pairs is learned.
3. Application. The learned transformations are undone in all texts: reading of UTF-8 run by run, where the bytes
   must form valid UTF-8; single-byte confusions word by word, where the word it gives must be known to the
   corpus and clearly more usual, whatever the counts. Replacement characters, and question marks in the place of letters of a twin, mark text whose
   original is lost; the twin's spelling is put in where there is one.

Counting words pre-aggregates before the shuffle; the twin of a skeleton is an aggregate (no pairs within a
group are emitted); only the learned transformations, at most as many as there are candidates, reach the driver.

Defined results: null and empty texts are no cases; very long texts are processed whole; repeated rows give
one case; with no twins nothing is learned and only lost characters are found; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.llm.spread import broadcast_checked
from quarryline.session import cut

# Candidate encodings: UTF-8 read as one of READERS; or written in one of WRITERS and read as one of MISREADERS.
READERS = ["cp1252", "latin_1", "cp1251", "cp1250", "cp1253", "cp1254", "cp437", "cp850", "cp852", "cp866", "mac_roman", "iso8859_2", "iso8859_9", "iso8859_15", "koi8_r", "gbk", "big5"]
WRITERS = ["cp1251", "koi8_r", "cp866", "iso8859_5", "cp1250", "iso8859_2", "cp1254", "iso8859_9", "cp1252", "cp1253", "iso8859_7", "cp1256", "iso8859_6", "cp437", "cp850", "cp852", "mac_roman", "mac_cyrillic", "gbk", "gb18030", "big5"]
WIDE = ("gbk", "gb18030", "big5")
MISREADERS = ["cp1252", "latin_1", "cp1251", "cp1250", "cp437", "cp850", "mac_roman", "koi8_r", "cp866"]
#: A clause of ideographs, which stands for a word where words are not parted by spaces.
CLAUSE = re.compile(r"[\u4e00-\u9fff]{3,}")
LOST = "�"
ODD = r"[^\x00-\x7f]"
RUN = re.compile(r"[^\x00-\x7f]+")
HOLE = re.compile(r"[^\x00-\x7f]+|\?+")
#: A transformation counts as learned with this many distinct aligned pairs; UTF-8 misread has a form of its own, so one is enough.
SUPPORT = {"utf8": 1, "single": 3}
#: So much more usual, as a logarithm, the pairs of characters of one spelling must be to tell it as the clean one whatever the counts.
CLEAR = 1.0


def to_bytes(text: str, reader: str) -> bytes | None:
    """The bytes that ``reader`` showed as ``text``; bytes it leaves undefined were passed on as controls."""
    try:
        return text.encode(reader)
    except UnicodeEncodeError:
        if reader in ("gbk", "big5"):
            return None
    out = bytearray()
    for c in text:
        try:
            out += c.encode(reader)
        except UnicodeEncodeError:
            if 0x80 <= ord(c) < 0xA0:
                out.append(ord(c))
            else:
                return None
    return bytes(out)


def sane(text: str) -> bool:
    """Nothing but letters, marks, digits, punctuation, usual signs and spaces."""
    return all(c == "\n" or unicodedata.category(c) not in ("Cc", "Cn", "Co", "Cs") for c in text)


def undo(run: str, pair: str) -> str | None:
    """``run`` before it was written as A and read as B; None where it can't have been."""
    writer, reader, times = pair.split(">")
    for _ in range(int(times)):
        data = to_bytes(run, reader)
        if data is None:
            return None
        try:
            run = data.decode("utf-8" if writer == "utf8" else writer)
        except UnicodeDecodeError:
            return None
    return run if sane(run) else None


UTF8_PAIRS = [f"utf8>{r}>{n}" for n in (1, 2, 3) for r in READERS if n == 1 or r in ("cp1252", "latin_1", "cp1251", "cp1254", "mac_roman")]
SINGLE_PAIRS = [f"{w}>{r}>1" for w in WRITERS for r in MISREADERS if w != r and not (w in ("cp1252",) and r == "latin_1")]


PAIRS = UTF8_PAIRS + SINGLE_PAIRS
_BIT = {p: 1 << i for i, p in enumerate(PAIRS)}


def _shown(byte: int, encoding: str) -> str | None:
    """What a single-byte encoding shows for a byte; bytes it leaves undefined are passed on as controls."""
    try:
        return bytes([byte]).decode(encoding)
    except UnicodeDecodeError:
        return chr(byte) if 0x80 <= byte < 0xA0 else None


def _byte_tables() -> tuple[dict[str, dict[int, str]], dict[tuple[str, str], int], dict[str, int]]:
    """Of each single-byte transformation what it makes of a character; which transformations make one character of another; which make anything sane of one."""
    tables: dict[str, dict[int, str]] = {}
    makes: dict[tuple[str, str], int] = {}
    reads: dict[str, int] = {}
    for p in SINGLE_PAIRS:
        writer, reader, _ = p.split(">")
        if writer in WIDE:
            continue
        table = tables.setdefault(p, {})
        for byte in range(0x80, 0x100):
            seen, meant = _shown(byte, reader), None
            try:
                meant = bytes([byte]).decode(writer)
            except UnicodeDecodeError:
                continue
            if seen is not None and sane(meant):
                table[ord(seen)] = meant
                makes[seen, meant] = makes.get((seen, meant), 0) | _BIT[p]
                reads[seen] = reads.get(seen, 0) | _BIT[p]
    return tables, makes, reads


BYTES, MAKES, READS = _byte_tables()


def _mangled(data: bytes, reader: str) -> str | None:
    """What ``reader`` shows for bytes."""
    if reader in WIDE:
        try:
            return data.decode(reader)
        except UnicodeDecodeError:
            return None
    shown = [_shown(b, reader) for b in data]
    return None if None in shown else "".join(shown)


@functools.lru_cache(100_000)
def mangled(run: str) -> dict[str, int]:
    """The forms a clean run takes when its characters become several: written as UTF-8 or double bytes and read in another encoding, with the transformations that give each."""
    out: dict[str, int] = {}
    for p in PAIRS:
        writer, reader, times = p.split(">")
        if writer != "utf8" and writer not in WIDE:
            continue
        now: str | None = run
        for _ in range(int(times)):
            try:
                now = _mangled(now.encode("utf-8" if writer == "utf8" else writer), reader) if now is not None else None
            except UnicodeEncodeError:
                now = None
        if now is not None:
            out[now] = out.get(now, 0) | _BIT[p]
    return out


def aligned(word: str, clean: str) -> int:
    """The transformations (as bits) that turn each character of ``clean`` into what stands in its place in ``word``; the ASCII runs align the two."""
    a, b = RUN.findall(word), RUN.findall(clean)
    if len(a) != len(b) or RUN.split(word) != RUN.split(clean):
        return 0
    left = -1
    for x, y in zip(a, b, strict=True):
        if x != y and left:
            each = -1
            if len(x) == len(y):
                for c, d in zip(x, y, strict=True):
                    each &= MAKES.get((c, d), 0)
            else:
                each = 0
            left &= each | mangled(y).get(x, 0)
    return left if left != -1 else 0


def explained(word: str, clean: str) -> list[str]:
    """The transformations that turn the runs of ``clean`` into those of ``word`` when the two are aligned."""
    bits = aligned(word, clean)
    return [p for p in PAIRS if bits & _BIT[p]] if bits else []


def originals(word: str, pairs: list[str]) -> list[dict]:
    """What each single-byte transformation makes of a word that has letters of no ASCII skeleton."""
    out = []
    readable = -1
    for c in {c for c in word if not c.isascii()}:
        readable &= READS.get(c, 0)
    for p in pairs:
        if p.split(">")[0] in WIDE:
            for run in RUN.findall(word):
                new = undo(run, p) if len(run) >= 6 else None
                if new is not None and ideographic(new):
                    out += [{"pair": p, "original": c} for c in dict.fromkeys(CLAUSE.findall(new))]
        elif readable & _BIT[p] and (o := word.translate(BYTES[p])) != word and any(c.isalpha() and ord(c) > 127 for c in o):
            out.append({"pair": p, "original": o})
    return out


ORIGINALS = T.ArrayType(T.StructType([T.StructField("pair", T.StringType()), T.StructField("original", T.StringType())]))


@F.pandas_udf(ORIGINALS)
def _originals(words: pd.Series) -> pd.Series:
    return pd.Series([originals(w, SINGLE_PAIRS) for w in words], dtype=object)


def has_odd(c: str | Column) -> Column:
    """Whether a text has a character outside ASCII: more bytes than characters."""
    return F.octet_length(c) > F.length(c)


def tokens_of(texts: DataFrame) -> DataFrame:
    """``domain``, ``field``, ``is_word``, ``token``, ``before``, ``after``: what there is to learn from or to find in each text, by one pass.

    The different tokens with odd characters or with marks inside (``is_word``), and each token that is one odd character or has a
    mark, with its neighbours.
    """
    split = texts.filter(has_odd("text") | F.col("text").contains("?")).select("domain", "field", F.split("text", r"[ \t\r\n]+").alias("t"))
    t, none, empty = F.col("t"), F.array(F.lit(None).cast("string")), F.lit(None).cast("string")
    inside = lambda x: (F.locate("?", x) > 0) & (F.locate("?", x) < F.length(x))
    words = F.transform(F.array_distinct(F.filter(t, lambda x: has_odd(x) | inside(x))), lambda x: F.struct(F.lit(True).alias("is_word"), x.alias("token"), empty.alias("before"), empty.alias("after")))
    three = F.arrays_zip(t.alias("token"), F.concat(none, t).alias("before"), F.concat(F.slice(t, 2, F.size(t)), none).alias("after"))
    alone = F.filter(three, lambda x: x["token"].contains("?") | (F.length(x["token"]) == 1) & has_odd(x["token"]))
    around = F.transform(alone, lambda x: F.struct(F.lit(False).alias("is_word"), x["token"].alias("token"), x["before"].alias("before"), x["after"].alias("after")))
    return split.select("domain", "field", F.explode(F.concat(words, around)).alias("x")).select("domain", "field", "x.*")


def words_of(tokens: DataFrame) -> DataFrame:
    """``domain``, ``field``, ``word``: the words among ``tokens``, without outer ASCII punctuation."""
    out = tokens.filter("is_word").select("domain", "field", F.col("token").alias("raw"))
    clauses = F.filter(F.split("raw", r"[^\x{4e00}-\x{9fff}]+"), lambda c: F.length(c) >= 3)
    each = F.explode(F.concat(F.array("raw"), F.when(F.col("raw").rlike(r"[\x{4e00}-\x{9fff}]{3}"), F.array_distinct(clauses)).otherwise(F.array().cast("array<string>")))).alias("raw")
    out = out.select("domain", "field", each)
    return out.select("domain", "field", F.regexp_replace("raw", r"^[\x00-\x2f\x3a-\x3e\x40\x5b-\x60\x7b-\x7f]+|[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+$", "").alias("word"))


@functools.lru_cache(100_000)
def scripts(text: str) -> frozenset[str]:
    return frozenset(_scripts(text))


def _scripts(text: str) -> set[str]:
    return {unicodedata.name(c, "?").split(" ", 1)[0] for c in text if c.isalpha()}


@functools.lru_cache(100_000)
def natural(run: str) -> bool:
    """Whether a run reads like a word or a part of one: letters of one script, capitals only where words have them."""
    return run.isalpha() and len(scripts(run)) == 1 and (run.islower() or run.isupper() or run[1:].islower() or run.upper() == run.lower())


def ideographic(text: str) -> bool:
    """Whether ``text`` is ideographs and their punctuation only."""
    return all("\u3000" <= c <= "\u9fff" or "\uff00" <= c <= "\uffef" for c in text)


@functools.lru_cache(200_000)
def _as_utf8(run: str, pairs: tuple[str, ...]) -> str | None:
    """A run undone by the first transformation under which it reads as UTF-8."""
    for p in pairs:
        new = undo(run, p)
        if new is not None and len(new) < len(run) and len(scripts(new)) < 2:
            return new
    return None


@functools.lru_cache(200_000)
def _as_double(run: str, pairs: tuple[str, ...]) -> str | None:
    """A run undone by the first transformation that makes ideographs of all of it."""
    for p in pairs:
        new = undo(run, p)
        if new is not None and ideographic(new):
            return new
    return None


def repaired(text: str, pairs: list[str], wide: list[str]) -> str:
    """``text`` with every run undone that reads as UTF-8 under a learned transformation, the first that holds.

    Runs that read like words are undone only along with others that do not. Runs of at least six characters are
    also tried as double-byte text (``wide``), where all of it must come out as ideographs.
    """
    sure = False
    narrow, double = tuple(pairs), tuple(wide)

    def one(m: re.Match) -> str:
        nonlocal sure
        run = m.group()
        if len(run) < 2:
            return run
        if (new := _as_utf8(run, narrow)) is not None:
            a, b = m.start(), m.end()
            while a and text[a - 1].isalpha():
                a -= 1
            while b < len(text) and text[b].isalpha():
                b += 1
            sure = sure or not natural(text[a:b])
            return new
        if len(run) >= 6 and double and (new := _as_double(run, double)) is not None:
            sure = True
            return new
        return run

    new = RUN.sub(one, text)
    return new if sure else text


SIGN_IN_WORD = re.compile(r"[^\W\d_][¡¢£¤¥¦§¨©ª«¬®¯°±²³´¶¸¹º»¼½¾¿×÷][^\W\d_]|(?<!\w)[¦¬³¹¶¿¼¾][a-z]|[a-z][¦¬³¹¶¿¼¾](?!\w)")


def respelt(text: str, singles: list[str]) -> str:
    """``text`` with the words undone that have signs among their letters, where a learned single-byte transformation gives letters."""
    if not SIGN_IN_WORD.search(text):
        return text
    parts = re.split(r"(\s+)", text)
    for i, w in enumerate(parts):
        if SIGN_IN_WORD.search(w):
            for p in singles:
                new = "".join(undo(x, p) or "\0" if x and not x.isascii() else x for x in re.split(r"([^\x00-\x7f]+)", w))
                if "\0" not in new and new != w and not SIGN_IN_WORD.search(new) and len(scripts(new)) == 1 and all(c.isascii() or c.isalpha() for c in new):
                    parts[i] = new
                    break
    return "".join(parts)


def reads_as_utf8(word: str) -> bool:
    """Whether a run of ``word``, which doesn't read like a word itself, is UTF-8 under some reading."""
    if natural(word):
        return False
    return any(len(run) > 1 and _as_utf8(run, _UTF8) is not None for run in RUN.findall(word))


_UTF8 = tuple(UTF8_PAIRS)


def edges(word: str) -> list[str]:
    """The distinct pairs of adjacent characters, the ends of the word included, that hold one outside ASCII; none of UTF-8 misread or of letters of two scripts."""
    b = f"^{word.lower()}$"
    return [] if len(scripts(word)) > 1 or reads_as_utf8(word) else sorted({b[i : i + 2] for i in range(len(b) - 1) if not b[i : i + 2].isascii()})


@F.pandas_udf(T.ArrayType(T.StringType()))
def _edges(words: pd.Series) -> pd.Series:
    return pd.Series([edges(w) for w in words], dtype=object)


def spellings(tokens: DataFrame) -> DataFrame:
    """``word``, ``n``, ``usual`` of all odd words: how many fields have it, and how usual its pairs of characters are.

    ``usual`` is the mean logarithm of the number of distinct words with each pair, so copies of a text, however many,
    make the spellings in it no more usual.
    """
    counts = words_of(tokens).filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    held = counts.select("word", F.explode(_edges("word")).alias("edge"))
    types = held.groupBy("edge").agg(F.count(F.lit(1)).alias("types"))
    usual = held.join(types, "edge").groupBy("word").agg(F.avg(F.log("types")).alias("usual"))
    return counts.join(usual, "word", "left").fillna(0.0, ["usual"])


def turned(usual: float, other: float) -> int:
    """1 where the second of two spellings is clearly the usual one, -1 where the first is, else 0."""
    return (other - usual > CLEAR) - (usual - other > CLEAR)


TURNED = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("twin", T.StringType()), T.StructField("pairs", T.ArrayType(T.StringType()))]))


@F.pandas_udf(TURNED)
def _directed(words: pd.Series, ns: pd.Series, usuals: pd.Series, twins: pd.Series, twin_ns: pd.Series, twin_usuals: pd.Series) -> pd.Series:
    """The garbled spelling of each two with its clean twin: the side that a transformation turns into the more usual one."""
    out = []
    for w, n, u, t, tn, tu in zip(words, ns, usuals, twins, twin_ns, twin_usuals, strict=True):
        way, found = turned(u, tu), []
        if n <= tn and way >= 0 or way > 0:
            found.append((w, t, explained(w, t)))
        elif way < 0 and not re.search(r"[?\ufffd\x80-\x9f]", w):
            found.append((t, w, explained(t, w)))
        if not found or not found[0][2]:
            # marks in the place of letters, and runs that read as UTF-8, tell the direction by themselves
            utf8 = [p for p in explained(w, t) if p.startswith("utf8")]
            found = [(w, t, utf8)] if utf8 or n <= tn or holes_match(w, t) and ("?" in w or LOST in w) else []
        out.append([{"word": a, "twin": b, "pairs": ps} for a, b, ps in found])
    return pd.Series(out, dtype=object)


def learn(counts: DataFrame) -> DataFrame:
    """``word``, ``twin``, ``pairs``: garbled words among the ``spellings`` with their clean twins and the transformations that explain them."""
    counts = counts.withColumn("skeleton", F.regexp_replace("word", ODD + r"+|\?+", ""))
    has_skeleton = F.length(F.regexp_replace("skeleton", r"[^A-Za-z]", "")) >= 2
    clean = F.col("word").rlike(r"[^\x00-\x7f]") & ~F.col("word").rlike(r"\?|�|[\x{80}-\x{9f}]")
    twin = F.struct("word", "n", "usual")
    # the most frequent spelling and the one of the most usual pairs of characters, mostly the same
    twins = (
        counts.filter(has_skeleton & clean)
        .groupBy("skeleton")
        .agg(F.max_by(twin, F.struct(F.col("n"), -F.length("word"), F.col("word"))).alias("frequent"), F.max_by(twin, F.struct("usual", "n", "word")).alias("likely"))
        .select("skeleton", F.explode(F.array_distinct(F.array("frequent", "likely"))).alias("t"))
    )
    by_skeleton = counts.filter(has_skeleton).join(twins, "skeleton").filter("word <> t.word")
    by_skeleton = by_skeleton.select(F.explode(_directed("word", "n", "usual", "t.word", "t.n", "t.usual")).alias("d")).select("d.*").distinct()
    three = F.length(F.regexp_replace("word", r"[\x00-\x7f]", "")) >= 3
    mixed = F.col("word").rlike(r"[A-Za-z]") & (F.length(F.regexp_replace("word", r"[\x00-\x7f]", "")) >= 2)
    bare = counts.filter((~has_skeleton & (three | mixed) | F.col("word").rlike(r"[^\x00-\x7f]{6}")) & F.col("word").rlike(ODD) & ~F.col("word").contains(LOST)).select("word", "n", "usual", F.explode(_originals("word")).alias("o"))
    known = counts.select(F.col("word").alias("twin"), F.col("n").alias("twin_n"), F.col("usual").alias("twin_usual"))
    more = F.col("twin_usual") - F.col("usual")
    by_word = bare.select("word", "n", "usual", "o.pair", F.col("o.original").alias("twin")).join(known, "twin").filter((F.expr("twin_n > n and twin_n > 1") & (more >= -CLEAR)) | (more > CLEAR))
    by_word = by_word.groupBy("word", "twin").agg(F.collect_set("pair").alias("pairs"))
    return by_skeleton.unionByName(by_word)


def undone(counts: DataFrame, singles: list[str]) -> DataFrame:
    """``word``, ``twin``, ``pairs``: each word that a learned single-byte transformation turns into a clearly more usual one the corpus has."""

    @F.pandas_udf(ORIGINALS)
    def back(words: pd.Series) -> pd.Series:
        return pd.Series([originals(w, singles) for w in words], dtype=object)

    # a letter or two by themselves are words of many languages
    long = F.col("word").rlike(r"[A-Za-z]{2}") | (F.length(F.regexp_replace("word", r"[\x00-\x7f]", "")) >= 3)
    made = counts.filter(long & F.col("word").rlike(ODD) & ~F.col("word").contains(LOST)).select("word", "usual", F.explode(back("word")).alias("o"))
    known = counts.select(F.col("word").alias("twin"), F.col("usual").alias("twin_usual"))
    met = made.select("word", "usual", "o.pair", F.col("o.original").alias("twin")).join(known, "twin").filter(F.col("twin_usual") - F.col("usual") > CLEAR)
    return met.groupBy("word", "twin").agg(F.collect_set("pair").alias("pairs"))


def supported(pairs: DataFrame) -> list[str]:
    """The learned transformations, best first; at most as many rows as there are candidates reach the driver."""
    rows = pairs.select(F.explode("pairs").alias("pair")).groupBy("pair").count().collect()
    support = {r["pair"]: r["count"] for r in rows}
    good = [p for p, n in support.items() if n >= SUPPORT["utf8" if p.startswith("utf8") else "single"]]
    # fewer rounds first: a text read twice is undone twice by the single transformation as well
    return sorted(good, key=lambda p: (-int(p[-1]), -support[p], p))


def restore(metadata_texts: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``domain``, ``field``, ``kind``, ``text``, ``restored`` of each damaged text; ``restored`` keeps what can't be recovered.

    Kinds: ``decoded`` and ``respelt`` by learned transformations (runs of UTF-8; single bytes), ``filled`` from a twin that has
    letters where the text has marks, ``lost`` for marks and controls no twin tells the letters of.

    Transformations are learned from all texts; with ``only``, they are applied to those of its texts.
    """
    every = cut(metadata_texts.select("domain", "field", "text").filter(has_odd("text") | F.col("text").contains("?")))  # plain texts have nothing to learn or find
    tokens = cut(tokens_of(every))
    counts = cut(spellings(tokens))
    pairs = cut(learn(counts))
    texts = only.select("domain", "field", "text").filter(has_odd("text") | F.col("text").contains("?")) if only is not None else every
    learned = supported(pairs)
    utf8 = [p for p in learned if p.startswith("utf8")]
    wide = [p for p in learned if p.split(">")[0] in WIDE]
    ranked = [p for p in learned if not p.startswith("utf8") and p not in wide]
    single = set(ranked + wide)

    spelt = T.StructType([T.StructField("kind", T.StringType()), T.StructField("restored", T.StringType())])

    @F.pandas_udf(spelt)
    def runs(values: pd.Series) -> pd.DataFrame:
        rows = []
        for t in values:
            new = repaired(t, utf8, wide)
            kind = "decoded" if new != t else "lost" if LOST in t or re.search(r"[\x80-\x9f]", t) else None
            if kind is None and (letters := respelt(t, ranked)) != t:
                new, kind = letters, "respelt"
            rows.append((kind, new))
        return pd.DataFrame(rows, columns=["kind", "restored"])

    runs = runs.asNondeterministic()  # else the filter on its result makes it run twice
    odd = texts.filter(has_odd("text"))
    by_run = odd.select("domain", "field", runs("text").alias("r")).select("domain", "field", "r.*").filter("kind is not null")

    # words with a twin: single-byte confusions that were learned, and holes where the twin has letters
    rank = {p: i for i, p in enumerate(ranked + wide)}

    @F.pandas_udf(T.StructType([T.StructField("kind", T.StringType()), T.StructField("rank", T.IntegerType())]))
    def word_kind(words: pd.Series, twins: pd.Series, explaining: pd.Series) -> pd.DataFrame:
        out = []
        for w, t, e in zip(words, twins, explaining, strict=True):
            if any(p in single for p in e):
                out.append(("respelt", min(rank[p] for p in e if p in single)))
            elif ("?" in w or LOST in w) and holes_match(w, t):
                out.append(("filled", 0))
            else:
                out.append((None, 0))
        return pd.DataFrame(out, columns=["kind", "rank"])

    word_kind = word_kind.asNondeterministic()
    pairs = pairs.unionByName(undone(counts, [p for p in ranked if p.split(">")[0] not in WIDE])) if ranked else pairs
    ranks = pairs.withColumn("k", word_kind("word", "twin", "pairs")).filter("k.kind is not null").join(counts.select(F.col("word").alias("twin"), "n"), "twin", "left")
    garbled = ranks.groupBy("word").agg(F.min_by("twin", F.struct("k.kind", "k.rank", -F.col("n"), "twin")).alias("twin"), F.min("k.kind").alias("kind"))
    own = cut(tokens_of(texts)) if only is not None else tokens
    hits = words_of(own).join(broadcast_checked(cut(garbled)), "word").groupBy("domain", "field").agg(F.min("kind").alias("word_kind"), F.map_from_entries(F.collect_set(F.struct("word", "twin"))).alias("spelling"))
    return _join_found(texts, by_run, hits, lone_marks(own, tokens))


def holes_match(word: str, twin: str) -> bool:
    """Whether ``word`` is ``twin`` with its characters outside ASCII replaced by marks."""
    return HOLE.split(word) == RUN.split(twin)


MARKED = r"^[.,;:()\"'\-]*\?[?.,;:()\"'\-]*\?[?.,;:()\"'\-0-9]*$|\?{4,}|\?\?+[0-9A-Za-z]|^[^A-Za-z?]*\?{2,}[^A-Za-z]*\?"


def lone_marks(own: DataFrame, every: DataFrame) -> DataFrame:
    """``domain``, ``field`` of texts (by their tokens, ``own``) whose standing-alone question marks took the place of other characters.

    A token of two or more marks by itself, or one mark between two words between which other texts, of ``every``, have a
    sign outside ASCII.
    """
    around = own.filter(~F.col("is_word") & F.col("token").contains("?"))
    many = around.filter(F.col("token").rlike(MARKED)).select("domain", "field")
    signs = every.filter(~F.col("is_word") & (F.length("token") == 1) & has_odd("token")).select("before", "after").distinct()
    between = around.filter("token = '?'").join(signs, "after", "left_semi").select("domain", "field")
    return many.unionByName(between).distinct()


def _join_found(texts: DataFrame, by_run: DataFrame, hits: DataFrame, marks: DataFrame) -> DataFrame:
    @F.pandas_udf(T.StringType())
    def put(values: pd.Series, spellings: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(values, spellings, strict=True):
            for w, o in sorted((s or {}).items(), key=lambda x: -len(x[0])) if isinstance(s, dict) else sorted(s or [], key=lambda x: -len(x[0])):
                t = t.replace(w, o)
            out.append(t)
        return pd.Series(out, dtype=object)

    keys = ["domain", "field"]
    found = by_run.join(hits, keys, "full").join(marks.withColumn("marked", F.lit(True)), keys, "full").join(texts, keys)
    base = F.coalesce("restored", "text")
    spelling = F.coalesce("spelling", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    kind = F.coalesce("kind", "word_kind", F.lit("lost"))
    return found.select(*keys, kind.alias("kind"), "text", put(base, spelling).alias("restored"))
