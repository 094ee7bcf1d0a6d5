"""Helpers that the corpus operators share: words, hashes, global ranks, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope.session import materialize

#: Odd multiplier of the polynomial over word hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


# A random number for each byte, and 0 for the characters between words: 0x20 and 0x09-0x0D.
_BYTES = np.random.default_rng(1302).integers(1, 1 << 64, 256, dtype=np.uint64)
_BYTES[[*range(0x09, 0x0E), 0x20]] = 0
_SOLID = bytes((_BYTES != 0).astype(np.uint8).tolist())
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2**64, kept and doubled when a longer text needs more."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1024) * 2, base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = known = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


#: Bytes of text that are hashed at a time; a longer word is hashed whole.
HASHED_AT_ONCE = 1 << 20


def hash_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, those of `text.split()`, and the number of words before
    each text, with that of all at the end. Memory beyond the texts and hashes is bounded."""
    joined = b" ".join(t or b"" for t in texts)
    begin = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    solid = joined.translate(_SOLID)
    hashes, starts, at = [], [], 0
    while at < len(joined):
        end = solid.find(b"\0", at + HASHED_AT_ONCE)
        end = len(joined) if end < 0 else end
        flags = np.frombuffer(b"\0" + solid[at:end], dtype=bool)
        start = np.flatnonzero(flags[1:] > flags[:-1])
        if len(start):
            codes = np.frombuffer(joined, dtype=np.uint8)[at + start[0] : end]
            size = np.diff(start, append=end - at)
            starts.append(start + at)
            start = start - start[0]
            place = np.arange(len(codes)) - np.repeat(start, size)
            powers = _powers_of(BASE, int(size.max()))
            terms = np.take(_BYTES, codes, mode="clip") * np.take(powers, place, mode="clip")
            hashes.append(mix(np.add.reduceat(terms, start)))
        at = end
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(begin), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), begin)


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text."""
    return hash_words([text])[0]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values after which every bit depends on every bit."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class Spans:
    """Hashes of any word ranges of one text from prefix sums of a polynomial over its words."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.n = n
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * _powers_of(BASE, n), out=self.prefix[1:])
        self.back = _powers_of(INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        raw = (self.prefix[end] - self.prefix[start]) * self.back[start]
        return mix(raw + length * np.uint64(0xA24BAED4963EE407))

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all runs of k words, in order; none if the text is shorter."""
        start = np.arange(max(0, self.n - k + 1))
        return self.of(start, start + k)


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)


def global_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """All rows with `rank`, gapless from 0 in the order of the columns given.

    Rows are range-partitioned, so no task holds more than its share. The sorted rows are written
    once: ranges come from a sample, and a second evaluation could cut them elsewhere. Only one
    count per partition is broadcast.
    """
    placed = materialize(
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        name,
    )
    counts = sorted(
        (r["_part"], r["n"])
        for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()
    )
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    spark = df.sparkSession
    # As an Arrow table: a list of rows would start a second set of Python workers for itself.
    parts, starts = zip(*offsets) if offsets else ((), ())
    before = spark.createDataFrame(
        pa.table({"_part": pa.array(parts, pa.int32()), "_before": pa.array(starts, pa.int64())})
    )
    return (
        placed.join(F.broadcast(before), "_part")
        .withColumn("rank", F.col("_before") + F.col("_pos"))
        .drop("_part", "_pos", "_before")
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node`, `component`: every linked node with the smallest node reachable from it.

    Alternates two star steps until the edges stand still. Each step is a minimum per node and a
    join, so a node with very many links is combined before the shuffle and its join partition
    can be split. The edges of each round are a written table: nothing reaches the driver but
    their count and checksum.
    """
    edges = links.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where("u > v").distinct()

    def state(of: DataFrame):
        return of.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = materialize(edges, "edges")
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u > v")
            .distinct()
        )
        edges = materialize(small, "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def tile_pairs(df: DataFrame, key: str, order: str, size: int, name: str) -> DataFrame:
    """Rows dealt so that all rows of a key meet in pairs of tiles, none of them large.

    Rows are cut into tiles of `size` in the order of the key, so small keys share a tile and a
    large one fills several. Each row is repeated for every pair of tiles that its key reaches; a
    group by (`low`, `high`) has two tiles at most. `tile` tells them apart.
    """
    placed = global_rank(df, [key, order], name).withColumn("tile", F.floor(F.col("rank") / size))
    reach = placed.groupBy(key).agg(F.min("tile").alias("_from"), F.max("tile").alias("_to"))
    return (
        placed.join(reach, key)
        .withColumn("_other", F.explode(F.sequence("_from", "_to")))
        .withColumn("low", F.least("tile", "_other"))
        .withColumn("high", F.greatest("tile", "_other"))
        .drop("rank", "_from", "_to", "_other")
    )
