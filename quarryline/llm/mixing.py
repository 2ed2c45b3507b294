"""Mixing sources to target shares of all tokens, with a cap on repetitions.

Capped water-filling: each source is given its share of the total; sources that can't reach it even at
``max_repeats`` uses of every text are clamped there, and what they leave is spread over the others in proportion
to their targets, again until nothing changes. A source's allotment is then so many whole uses of each text and a
fraction of one more; the fraction is a seeded sample. Texts are ordered by a seeded hash; a histogram of tokens
over ``BUCKETS`` hash ranges tells in which range the sample ends, and only the texts of that one range are summed
one by one. So the sample is exact to one text, and no source is brought into one task, however large.

Exact copies of a text are one text (its first row stands for it), so copies don't get around the cap. The
targets are a short list; one row per source reaches the driver.

The report says for each source whether its share was reached (within ``TOLERANCE`` of it, and never without texts) and
the largest total at which its target holds; the least of these is the largest total at which all do.

Defined results: rows without a source, or with one that is no target, and blank texts are not used; a target
without texts is reported with 0 reached; null targets count as 0, null caps as 1; targets that don't sum to 1
are scaled; ties of the hash are broken by identifier; empty tables give empty selections.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.tokens import TOKENIZER, token_count
from quarryline.session import cut

BUCKETS = 4096
#: A share counts as reached within this part of it.
TOLERANCE = 0.01
#: More target sources than this are refused; the list is a parameter of a mix, not data.
MOST_TARGETS = 10_000


def water_fill(shares: dict[str, float], caps: dict[str, float], total: float) -> dict[str, float]:
    """The allotment of each source: its share of ``total``, at most its cap, the rest spread in proportion."""
    total = min(total, sum(caps[s] for s in shares if shares[s] > 0))
    allotted, open_ = {s: 0.0 for s in shares}, {s for s in shares if shares[s] > 0}
    left = total
    while open_ and left > 1e-9:
        weight = sum(shares[s] for s in open_)
        full = {s for s in open_ if shares[s] / weight * left >= caps[s] - 1e-9}
        if not full:
            for s in open_:
                allotted[s] = shares[s] / weight * left
            break
        for s in full:
            allotted[s] = caps[s]
            left -= caps[s]
        open_ -= full
    return allotted


def distinct_texts(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id``, ``source``, ``tokens`` of each different text of the target sources."""
    wanted = documents.filter("source is not null and text is not null and trim(text) <> ''").join(targets.select("source").distinct(), "source", "left_semi")
    sized = wanted.select("doc_id", "source", token_count(F.col("text"), tokenizer).alias("tokens"), F.sha2("text", 256).alias("print"))
    first = sized.groupBy("print").agg(F.min(F.struct("doc_id", "source", "tokens")).alias("x"))
    return first.select("x.*").filter("tokens > 0")


def plan(texts: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """``source``, ``target_share``, ``max_repeats``, ``available``, ``allotted`` of each target."""
    listed = targets.groupBy("source").agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats")).filter("source is not null")
    rows = listed.join(texts.groupBy("source").agg(F.sum("tokens").alias("available")), "source", "left").limit(MOST_TARGETS + 1).collect()
    if len(rows) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} target sources")
    have = {r["source"]: r["available"] or 0 for r in rows}
    weight = sum(r["target_share"] for r in rows) or 1.0
    shares = {r["source"]: r["target_share"] / weight for r in rows}
    caps = {r["source"]: float(have[r["source"]] * r["max_repeats"]) for r in rows}
    allotted = water_fill(shares, caps, float(total_tokens if total_tokens is not None else sum(have.values())))
    data = [(r["source"], float(r["target_share"]), int(r["max_repeats"]), int(have[r["source"]]), float(allotted[r["source"]])) for r in sorted(rows, key=lambda r: r["source"])]
    return texts.sparkSession.createDataFrame(data, "source string, target_share double, max_repeats int, available long, allotted double")


def mixed(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """The selection (``doc_id``, ``source``, ``tokens``, ``uses``) and the report of shares reached."""
    texts = cut(distinct_texts(documents, targets, tokenizer))
    wanted = plan(texts, targets, total_tokens)
    whole = F.floor(F.col("allotted") / F.col("available") + F.lit(1e-9))
    rates = wanted.filter("available > 0").select("source", whole.alias("whole"), (F.col("allotted") - whole * F.col("available")).alias("part_tokens"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    bucket = F.shiftrightunsigned(order, 64 - int(math.log2(BUCKETS)))
    placed = texts.withColumns({"order": order, "bucket": bucket})
    histogram = placed.groupBy("source", "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)  # at most BUCKETS rows
    ends = histogram.withColumn("upto", F.sum("bucket_tokens").over(running)).join(rates, "source")
    before = F.col("upto") - F.col("bucket_tokens")
    state = F.when(F.col("upto") <= F.col("part_tokens") + 1e-6, F.lit("in")).when(before < F.col("part_tokens"), F.lit("edge")).otherwise(F.lit("out"))
    ends = ends.select("source", "bucket", "whole", state.alias("state"), (F.col("part_tokens") - before).alias("room"))
    joined = placed.join(ends, ["source", "bucket"])
    within = Window.partitionBy("source", "bucket").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = joined.filter("state = 'edge'").withColumn("sum", F.sum("tokens").over(within))
    edge = edge.withColumn("extra", (F.col("sum") - F.col("tokens") / 2 <= F.col("room")).cast("int"))
    sure = joined.filter("state <> 'edge'").withColumn("extra", (F.col("state") == "in").cast("int"))
    columns = ["doc_id", "source", "tokens", (F.col("whole") + F.col("extra")).cast("int").alias("uses")]
    selection = sure.select(*columns).unionByName(edge.select(*columns)).filter("uses > 0")
    used = selection.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("used_tokens"), F.max("uses").alias("most_uses"), F.count(F.lit(1)).alias("texts"))
    report = wanted.join(used, "source", "left").na.fill({"used_tokens": 0, "most_uses": 0, "texts": 0})
    all_used = report.agg(F.sum("used_tokens").alias("all_used"))
    report = report.join(all_used, F.lit(True)).withColumn("reached_share", F.when(F.col("all_used") > 0, F.round(F.col("used_tokens") / F.col("all_used"), 6)).otherwise(0.0))
    wanted_any = F.col("target_share") > 0
    close = F.abs(F.col("reached_share") - F.col("target_share")) <= TOLERANCE * F.col("target_share")
    report = report.withColumn("is_reached", F.when(wanted_any, (F.col("used_tokens") > 0) & close).otherwise(F.col("used_tokens") == 0))
    report = report.withColumn("holds_up_to", F.when(wanted_any, F.floor(F.col("available") * F.col("max_repeats") / F.col("target_share") + F.lit(1e-6)).cast("long")))
    return selection, report.select("source", "target_share", "reached_share", "is_reached", "max_repeats", "most_uses", "texts", "available", "used_tokens", "holds_up_to")
