"""Filling containers of fixed capacity with texts, neighbours in content together.

Each document becomes a hashed bag-of-words vector, a fixed seeded projection brings it to ``DIMENSIONS``
numbers, and their cell on a Hilbert curve gives its key. Documents are range-partitioned and sorted by (spec,
key, identifier); the identifier parts copies, so a text that a third of all rows hold is spread as well. Each
partition is packed along the curve in blocks of about ``BLOCK`` containers: the block's items are placed largest
first, each into the fullest container that takes it. Containers filled less than ``GOOD`` are dissolved and
their items handed to the next block, so that little is left unused but at the end of a partition.

A text over the capacity is cut into pieces of the capacity, and only its rest shares a container.

Defined results: null and blank texts have 0 tokens and share containers like others; very long texts are cut as
above; ties are broken by identifier; repeated rows are separate items; an empty table gives an empty result;
columns other than those named are not read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.llm.tokens import TOKENIZER, token_count

FEATURES, DIMENSIONS, BITS = 512, 4, 10
BLOCK, GOOD = 96, 0.97
#: More specs than this are refused; the list is a parameter of a packing, not data.
MOST_SPECS = 1000
WORD = re.compile(r"[^\W_]+")


def projection() -> np.ndarray:
    """The fixed projection of the hashed features."""
    return np.random.default_rng(20240229).standard_normal((FEATURES, DIMENSIONS)) / np.sqrt(FEATURES)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (rows), by Skilling's transposition."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(texts: list[str | None]) -> np.ndarray:
    """Hilbert keys of texts by their hashed words."""
    matrix = np.zeros((len(texts), FEATURES))
    slots: dict[str, tuple[int, int]] = {}
    for row, text in enumerate(texts):
        for w in WORD.findall((text or "").lower()):
            if w not in slots:
                h = zlib.crc32(w.encode())
                slots[w] = (h % FEATURES, 1 if h & 0x10000 else -1)
            at, sign = slots[w]
            matrix[row, at] += sign
    size = np.linalg.norm(matrix, axis=1, keepdims=True)
    spots = (matrix / np.maximum(size, 1e-9)) @ projection() * np.sqrt(FEATURES)
    # the normal distribution of projections becomes uniform cells
    uniform = 1 / (1 + np.exp(-1.702 * spots))
    return hilbert_keys(np.minimum((uniform * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


@F.pandas_udf(T.LongType())
def _keys(texts: pd.Series) -> pd.Series:
    return pd.Series(curve_keys(list(texts)), dtype="int64")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each container: largest first, each into the fullest container that takes it."""
    space: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = bisect.bisect_left(space, (sizes[i], -1))
        if at < len(space):
            left, b = space.pop(at)
        else:
            left, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        bisect.insort(space, (left - sizes[i], b))
    return bins


ITEMS = "spec string, capacity int, key long, doc_id long, piece int, token_start long, tokens long"
PACKED = "spec string, capacity int, container long, doc_id long, piece int, token_start long, tokens long"


def pack_sorted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Packs a partition sorted along the curve; containers are numbered within the partition."""
    number, held, held_size, spec, capacity = 0, [], 0, None, 1

    def close(last: bool) -> tuple[list[tuple], list[tuple]]:
        nonlocal number
        out, back = [], []
        for b in best_fit([x[3] for x in held], capacity):
            if not last and sum(held[i][3] for i in b) < GOOD * capacity:
                back += [held[i] for i in b]
                continue
            out += [(spec, capacity, number, *held[i]) for i in b]
            number += 1
        return out, back

    columns = ["spec", "capacity", "container", "doc_id", "piece", "token_start", "tokens"]
    for frame in frames:
        rows: list[tuple] = []
        for s, c, doc, piece, start, size in frame[["spec", "capacity", "doc_id", "piece", "token_start", "tokens"]].itertuples(index=False, name=None):
            if s != spec:
                if held:
                    rows += close(True)[0]
                held, held_size, spec, capacity = [], 0, s, c
            if size >= c:
                rows.append((s, c, number, doc, piece, start, size))
                number += 1
                continue
            held.append((doc, piece, start, size))
            held_size += size
            if held_size >= BLOCK * c or len(held) >= 64 * BLOCK:
                done, held = close(False)
                rows += done
                held_size = sum(x[3] for x in held)
                if held_size >= BLOCK * c // 2 or len(held) >= 32 * BLOCK:
                    done, _ = close(True)
                    rows += done
                    held, held_size = [], 0
        yield pd.DataFrame(rows, columns=columns)
    if held:
        yield pd.DataFrame(close(True)[0], columns=columns)


def packed(documents: DataFrame, specs: DataFrame, tokenizer: str = TOKENIZER, partitions: int | None = None) -> DataFrame:
    """``spec``, ``capacity``, ``container``, ``doc_id``, ``piece``, ``token_start``, ``tokens`` of each text or piece.

    ``specs`` is a handful of rows (spec, capacity_tokens); container numbers are unique within a spec.
    """
    from quarryline.session import cut

    measured = cut(documents.select("doc_id", token_count(F.col("text"), tokenizer).alias("size"), _keys("text").alias("key")))
    listed = specs.select("spec", F.col("capacity_tokens").alias("capacity")).filter("capacity > 0").distinct().orderBy("spec").limit(MOST_SPECS + 1).collect()
    if len(listed) > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} specs")
    kinds = [F.struct(F.lit(r["spec"]).alias("spec"), F.lit(r["capacity"]).cast("int").alias("capacity")) for r in listed]
    each = F.explode(F.array(*kinds) if kinds else F.array().cast("array<struct<spec:string,capacity:int>>")).alias("s")
    items = measured.select("doc_id", "size", "key", each).select("doc_id", "size", "key", "s.*")  # one copy of the narrow rows per spec
    pieces = F.greatest(F.lit(1), F.ceil(F.col("size") / F.col("capacity")))
    items = items.select("spec", "capacity", "key", "doc_id", "size", F.posexplode(F.sequence(F.lit(0), (pieces - 1).cast("int"))).alias("piece", "at"))
    start = F.col("piece") * F.col("capacity")
    items = items.select("spec", "capacity", "key", "doc_id", "piece", start.cast("long").alias("token_start"), F.least(F.col("capacity").cast("long"), F.col("size") - start).cast("long").alias("tokens"))
    n = partitions or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["spec", "key", "doc_id", "piece"]
    ranged = items.repartitionByRange(n, *order).sortWithinPartitions(*order)
    out = ranged.mapInPandas(pack_sorted, PACKED)
    return out.withColumn("container", F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("container"))


def fills(items: DataFrame) -> DataFrame:
    """``spec``, ``container``, ``capacity``, ``items``, ``tokens``, ``fill`` of each container."""
    by = items.groupBy("spec", "container").agg(F.first("capacity").alias("capacity"), F.count(F.lit(1)).alias("items"), F.sum("tokens").alias("tokens"))
    return by.withColumn("fill", F.round(F.col("tokens") / F.col("capacity"), 4))
