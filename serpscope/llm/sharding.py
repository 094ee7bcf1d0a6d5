"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to 2**bits cells at its quantiles, the cells of a row give its index on
the curve, and the rows in the order of the curve are cut into runs of equal counts. Neighbours on
the curve are neighbours in every dimension, so a shard covers a small range of each and a reader
that filters on any of them skips most files.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from serpscope.llm.common import global_rank
from serpscope.session import materialize

#: Bits of a cell; with three dimensions the curve has 4096 points.
BITS = 4
#: Most points of a curve, which bounds the table of indexes that is broadcast.
MOST_POINTS = 1 << 16
#: Accuracy of the quantiles that separate cells.
ACCURACY = 10_000


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of each row of cells, one column per dimension."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            upper = (x[:, d] >> bit) & 1 == 1
            swap = np.where(upper, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(upper, low, swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, -1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip[:, None]
    index = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << 1) | ((x[:, d] >> bit) & 1)
    return index


def _text_cuts(values: DataFrame, cells: int) -> list[str]:
    """The values at which whole text values, in byte order, are cut into cells of equal counts.

    Distinct values with their counts are sorted by range; counts add up within each range and over
    the ranges, one number each. Only the cuts reach the driver.
    """
    counted = values.where("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    counted = counted.repartitionByRange("v").withColumn("part", F.spark_partition_id())
    counted = materialize(counted, "shard-values")
    sums = counted.groupBy("part").agg(F.sum("n")).collect()
    total, before = 0, {}
    for part, n in sorted(map(tuple, sums)):
        before[part] = total
        total += n
    if not total:
        return []
    offsets = values.sparkSession.createDataFrame([*before.items()], "part int, before long")
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v")) + F.col("before")
    placed = counted.join(F.broadcast(offsets), "part").withColumn("upto", upto)
    # Values with which the count passes multiples of a cell's share: a cut for each multiple, so
    # that few distinct values still lie as far apart as their counts.
    passed = F.expr(f"upto * {cells} div {total} - (upto - n) * {cells} div {total}")
    found = placed.where(F.col("upto") < total).select("v", passed.alias("cuts")).where("cuts > 0")
    return sorted((v for v, n in found.collect() for _ in range(n)), key=str.encode)


def with_curve(df: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """The rows with `curve`, their index on the curve over the columns named.

    Numbers are cut at their quantiles, other types as text at those of their whole values. A null
    shares the lowest cell.
    """
    if 1 << (bits * len(dims)) > MOST_POINTS:
        raise ValueError("the curve has too many points; use fewer bits or dimensions")
    numeric = {f.name: isinstance(f.dataType, NumericType) for f in df.schema.fields}
    own = {d: F.col(d).cast("double" if numeric[d] else "string") for d in dims}
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [d for d in dims if numeric[d]]
    cuts = df.agg(F.lit(0), *[F.percentile_approx(own[d], shares, ACCURACY) for d in numbers])
    cuts = dict(zip(numbers, cuts.first()[1:]))
    cuts |= {d: _text_cuts(df.select(own[d].alias("v")), 1 << bits) for d in dims if not numeric[d]}
    code = F.lit(0)
    for d in dims:
        cell = F.lit(0)
        for bound in cuts[d] or []:
            cell = cell + F.coalesce(own[d] > bound, F.lit(False)).cast("int")
        code = code * (1 << bits) + cell
    points = np.indices([1 << bits] * len(dims)).reshape(len(dims), -1).T
    places = [(i, int(h)) for i, h in enumerate(hilbert_index(points, bits))]
    lookup = df.sparkSession.createDataFrame(places, "_code int, curve long")
    return df.withColumn("_code", code).join(F.broadcast(lookup), "_code").drop("_code")


def hilbert_shards(
    docs: DataFrame, dims: list[str], shards: int = 16, bits: int = BITS
) -> DataFrame:
    """Every document's shard: runs of the curve whose counts differ by one at most.

    docs: `doc_id`, `text` and the dimensions; further columns are ignored. One row per input row
    with `size` (UTF-8 bytes of the text plus 1), `text_crc32`, `law` = rows, `shard`, `slot` (its
    place there, gapless from 0), `grown_shard` (null: counts change with every row) and `curve`.

    A null text is empty. Null dimensions share the lowest cell. Rows at one point of the curve are
    ordered by checksum, so that equal texts stay together, then by id; repeated rows are rows of
    their own. With fewer rows than shards, some shards stay empty; an empty table has no rows. Only
    lengths and checksums of texts are moved, however long they are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *[F.col(d).alias(f"_dim{i}") for i, d in enumerate(dims)],
    )
    placed = with_curve(rows, [f"_dim{i}" for i in range(len(dims))], bits)
    placed = placed.select("doc_id", "size", "text_crc32", "curve")
    ranked = global_rank(placed, ["curve", "text_crc32", "doc_id", "size"], "shard-order")
    n = max(1, ranked.count())
    shard = F.expr(f"cast(rank * {shards} div {n} as int)")
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def write_shards(docs: DataFrame, placed: DataFrame, key: str, path: str) -> None:
    """Writes the documents, one folder per shard, each in the order of its slots.

    Parquet keeps the range of every column per file, which is what readers prune by.
    """
    docs.join(placed.select(key, "shard", "slot"), key).repartitionByRange(
        "shard", "slot"
    ).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
