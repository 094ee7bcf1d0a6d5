"""Near-duplicate documents by min-max hashing.

Each of the permutations of the shingle hashes gives two signature values, its minimum and its
maximum: both agree between two sets with probability equal to their Jaccard similarity, so half
the evaluations give a signature of the same length. Bands of signature values propose pairs, and
whole shingle sets decide them.

Pairs are never enumerated within a band bucket. Documents with equal sets form one class first.
Each bucket then compares its members with two of them, and links are merged into components. Only
buckets whose members still lie in different components go on: their members are compared across
components, in tiles of bounded size. Sizes and whole signatures leave few pairs to decide by whole
sets, the likeliest first, and a pair that a link found before already joins is settled. A tile
gives out those links only. So a bucket of near copies emits about as many rows as it has members,
and no candidate pair that could still join two components is passed over.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope.llm.common import Spans, components, signed, tile_pairs, word_hashes
from serpscope.session import materialize

#: Words of a shingle.
SHINGLE = 5
#: Permutations; each gives a minimum and a maximum.
PERMUTATIONS = 63
#: Values of a band. 25 bands of 5 miss a pair of similarity 0.85 with probability 4e-7.
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
#: Shingles that are permuted at a time, to bound memory for very long texts.
CHUNK = 8192
#: Members of a bucket whose signatures are compared at a time.
TILE = 512
#: Standard deviations by which the agreement of two signatures may stay below its mean at the
#: similarity asked for; beyond that (chance 3e-7) whole sets are not compared.
DEVIATIONS = 5.0

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word runs in lower case (A-Z); shorter texts are one run."""
    hashes = word_hashes(text.lower() if text else text)
    if not len(hashes):
        return hashes
    return np.unique(Spans(hashes).grams(min(SHINGLE, len(hashes))))


def signature(values: np.ndarray) -> np.ndarray:
    """The minimum and the maximum under each permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(values), CHUNK):
        part = values[at : at + CHUNK]
        moved = np.multiply.outer(_FACTORS, part) + _SHIFTS[:, None]
        np.minimum(low, moved.min(axis=1), out=low)
        np.maximum(high, moved.max(axis=1), out=high)
    return np.concatenate((low, high))


def bands(sign: np.ndarray) -> list[int]:
    """One key for each band of a signature; a band's number is part of it."""
    sign = sign[: BANDS * ROWS].reshape(ROWS, BANDS)
    keys = [xxhash.xxh64_intdigest(np.ascontiguousarray(sign[:, b]), seed=b) for b in range(BANDS)]
    return signed(np.array(keys, dtype=np.uint64)).tolist()


SIGNED = "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch binary"


def _sign(batches):
    """Size, key, band keys and sketch of each document's shingle set."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("set_key", pa.binary()),
            ("bands", pa.list_(pa.int64())),
            ("sketch", pa.binary()),
        ]
    )

    def row(doc_id, text):
        found = shingles(text)
        if not len(found):
            return doc_id, 0, None, None, None
        sign = signature(found)
        # The lowest byte of each value is enough to count agreements.
        sketch = (sign & np.uint64(255)).astype(np.uint8).tobytes()
        return doc_id, len(found), xxhash.xxh3_128_digest(found), bands(sign), sketch

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        rows = list(map(row, ids, batch.column("text").cast(pa.binary()).to_pylist()))
        columns = zip(*rows) if rows else ([] for _ in schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
        )


def _packed(batches):
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        packed = [None if t is None else press.compress(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "packed"]
        )


def _confirm(percent: int):
    """The pairs whose whole sets are similar enough. Rows of one `b` mostly follow each other."""

    def run(batches):
        press = zstandard.ZstdDecompressor()
        known, middle = None, None
        for batch in batches:
            good = []
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if row["b"] != known:
                        known, middle = row["b"], shingles(press.decompress(row["packed_b"]))
                    other = shingles(press.decompress(row["packed_a"]))
                    both = len(np.intersect1d(other, middle, assume_unique=True))
                    if 100 * both >= percent * (len(other) + len(middle) - both):
                        good.append((row["a"], row["b"]))
            a, b = zip(*good) if good else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

    return run


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are linked. texts: `doc_id`, `packed`."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("packed_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("packed").alias("packed_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.mapInArrow(_confirm(percent), "a long, b long")


def _least_agreement(percent: int) -> float:
    """Agreeing signature values below which a pair is taken to be less similar."""
    n, p = 2 * PERMUTATIONS, percent / 100
    return n * p - DEVIATIONS * math.sqrt(n * p * (1 - p))


def _across(percent: int):
    """Links between different components among the members of two tiles."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bucket", "node"])
        low = rows["low"].iloc[0]
        apart = low != rows["high"].iloc[0]
        bucket, node, part, size, tile = (
            rows[c].to_numpy() for c in ("bucket", "node", "part", "n_shingles", "tile")
        )
        packed = rows["packed"].to_list()
        sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
        edge = np.flatnonzero(np.diff(bucket)) + 1
        first, second, alike = [], [], []
        for a, b in zip(np.concatenate(([0], edge)), np.concatenate((edge, [len(rows)]))):
            own = np.arange(a, b)
            one, other = (own[tile[own] == low], own[tile[own] != low]) if apart else (own, own)
            if not len(one) or not len(other):
                continue
            fits = part[one][:, None] != part[other][None, :]
            fits &= 100 * size[one][:, None] >= percent * size[other][None, :]
            fits &= 100 * size[other][None, :] >= percent * size[one][:, None]
            if not apart:
                fits &= one[:, None] < other[None, :]
            x, y = np.nonzero(fits)
            x, y = one[x], other[y]
            for at in range(0, len(x), 1 << 16):
                i, j = x[at : at + (1 << 16)], y[at : at + (1 << 16)]
                same = (sketch[i] == sketch[j]).sum(axis=1)
                fits = same >= _least_agreement(percent)
                first.append(i[fits])
                second.append(j[fits])
                alike.append(same[fits])
        if not first:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        first, second, alike = map(np.concatenate, (first, second, alike))
        press = zstandard.ZstdDecompressor()
        sets: dict[int, np.ndarray] = {}
        joined: dict[int, int] = {}

        def top(label: int) -> int:
            while label in joined:
                label = joined[label]
            return label

        def own_set(i: int) -> np.ndarray:
            if node[i] not in sets:
                sets[node[i]] = shingles(press.decompress(packed[i]))
            return sets[node[i]]

        links, tried = [], set()
        order = np.argsort(-alike, kind="stable")
        for i, j in zip(first[order].tolist(), second[order].tolist()):
            p, q = top(part[i]), top(part[j])
            pair = (node[i], node[j])
            if p == q or pair in tried:
                continue
            tried.add(pair)
            x, y = own_set(i), own_set(j)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                links.append(pair)
                joined[max(p, q)] = min(p, q)
        return pd.DataFrame(links or None, columns=["a", "b"]).astype("int64")

    return run


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Components of documents that share at least `percent` of 100 of their joint shingles.

    docs: `doc_id`, `text`; further columns are ignored. One row per input row: `n_shingles`, the
    size of its set; `component_id`, the smallest id reachable by links, itself included; `kept`,
    whether that is its own id.

    Null and empty texts have no shingles and no links. Texts of fewer than five words are one
    shingle. Equal texts always share a component. Rows without an id are returned alone, kept,
    without a component. Repeated rows are one document; rows that share an id but not a text count
    as linked with both texts' partners. Texts are hashed by slices. An empty table has no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = materialize(docs.mapInArrow(_sign, SIGNED), "minmax-signatures")
    classes = materialize(
        marked.where("doc_id is not null and set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("node"),
            # Equal sets have equal values.
            *(F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")),
        ),
        "minmax-classes",
    )
    placed = classes.select("node", F.explode("bands").alias("bucket"))
    crowded = (
        placed.groupBy("bucket")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low < high")
    )
    members = materialize(placed.join(crowded, "bucket"), "minmax-buckets")
    candidates = members.select(F.col("node").alias("doc_id")).distinct()
    texts = materialize(
        docs.where("text is not null and doc_id is not null")
        .mapInArrow(_packed, "doc_id long, packed binary")
        .join(candidates, "doc_id", "left_semi"),
        "minmax-texts",
    )
    pairs = members.select(F.col("node").alias("a"), F.explode(F.array("low", "high")).alias("b"))
    pairs = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialize(confirm(pairs.distinct(), texts, percent), "minmax-links")
    merged = materialize(components(links), "minmax-components")

    labelled = members.drop("low", "high").join(merged, "node", "left")
    labelled = labelled.withColumn("part", F.coalesce("component", "node")).drop("component")
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("part").alias("least"), F.max("part").alias("most"))
        .where("least < most")
        .select("bucket")
    )
    left = labelled.join(mixed, "bucket", "left_semi")
    facts = classes.select("node", "n_shingles", "sketch")
    late = (
        tile_pairs(left, "bucket", "node", TILE, "minmax-tiles")
        .join(facts, "node")
        .join(texts.toDF("node", "packed"), "node")
        .groupBy("low", "high")
        .applyInPandas(_across(percent), "a long, b long")
        .distinct()
    )
    late = materialize(late, "minmax-links")
    names = merged.select("node", "component")
    joined = (
        late.join(names.toDF("a", "part_a"), "a", "left")
        .join(names.toDF("b", "part_b"), "b", "left")
        .select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"))
    )
    last = materialize(components(joined), "minmax-components").toDF("component", "last")
    own = classes.select("set_key", "node").join(merged, "node", "left")
    own = own.withColumn("component", F.coalesce("component", "node"))
    own = own.join(last, "component", "left")
    found = own.select("set_key", F.coalesce("last", "component").alias("component_id"))
    result = marked.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
    # A row without an id is alone, whatever its text.
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of `docs`, with all their columns, without those that are near copies of an earlier
    row. Rows are told apart by a number of their own, so rows that share an id, or have none, are
    near copies like others: of repeated rows the first stays. Texts without words all stay."""
    number = "row"
    while number in docs.columns:
        number += "_"
    # Written, so that numbers do not change when a task runs again.
    numbered = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "minmax-rows")
    found = near_duplicates(numbered.select(F.col(number).alias("doc_id"), "text"), percent)
    copies = found.where("not kept").select(F.col("doc_id").alias(number))
    return numbered.join(copies, number, "left_anti").select(docs.columns)
