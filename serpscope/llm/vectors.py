"""Near-duplicate vectors by sorted projection passes.

Each pass draws random hyperplanes, concatenates their signs into one hash and orders the vectors
by it: close vectors share a long prefix and come to stand near each other. Vectors are compared
with their neighbours in a bounded window, and the verified pairs of all passes are united. Equal
vectors are one class and are compared once.

A pair at the threshold shares the first `depth` signs of a pass with a chance that depends on the
depth alone, not on how the vectors lie. How many rows share them does depend on that, so it is
counted for each label; depth and passes are the cheapest that give RECALL. Rows that share them
are compared whole: by windows while they fit one, else in tiles of bounded size, unless windows
have joined them all.

Components joined by the passes are then compared whole, in tiles too, so that a dense group larger
than a window keeps all its links.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope.llm.common import components, global_rank, tile_pairs
from serpscope.session import materialize

#: Signs in a hash; they fit a positive long.
BITS = 62
#: Neighbours on each side that a vector is compared with in one pass.
WINDOW = 128
#: Rows whose windows one group evaluates.
RUN = 512
#: Rows on each side of a tile.
TILE = 512
#: Rows on each side of a tile of rows that share their first signs.
BLOCK = 2048
#: Numbers of first signs to choose from.
DEPTHS = range(0, 33, 2)
#: Comparisons in a tile that take as long as one row in one pass; weighs passes against tiles.
PASS = 1500
#: Chance aimed at for a pair just at the threshold to meet in some pass.
RECALL = 0.97


def passes_for(depth: int, threshold: float) -> int:
    """Passes after which a pair at the threshold has shared its first signs with chance RECALL.

    Two such vectors differ in a sign with probability angle / pi, wherever they lie.
    """
    meet = (1 - math.acos(min(1.0, threshold)) / math.pi) ** depth
    return 1 if meet >= RECALL else math.ceil(math.log(1 - RECALL) / math.log(1 - meet))


def _valid(vector: str) -> str:
    """Whether a vector has a direction: not null, no null or non-finite component, not zero."""
    finite = f"forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    return f"{vector} is not null and {finite} and exists({vector}, x -> x <> 0)"


def _matrix(column) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    values = np.array([np.asarray(v, dtype=np.float64) for v in column])
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _hash(batches):
    """A row for each of the `passes` of a vector."""
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = batch.column("vector").to_pylist()
        widths = np.array([len(v) for v in vectors])
        passes = np.array(batch.column("passes").to_pylist())
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            at = at[np.argsort(-passes[at], kind="stable")]
            rows, own = _matrix([vectors[i] for i in at]), batch.take(pa.array(at))
            for number in range(passes[at[0]]):
                n = int((passes[at] > number).sum())
                planes = np.random.default_rng([number, width]).standard_normal((width, BITS))
                code = ((rows[:n] @ planes) > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, number, dtype=np.int32)),
                        own.column("label")[:n],
                        pa.array(np.full(n, width, dtype=np.int32)),
                        own.column("depth")[:n],
                        pa.array(code.astype(np.int64)),
                        own.column("node")[:n],
                        own.column("vector")[:n],
                    ],
                    ["turn", "label", "width", "depth", "code", "node", "vector"],
                )


def _depths(classes: DataFrame, kind: str, vector: str, threshold: float) -> DataFrame:
    """`label`, `width`, `depth`, `passes`: the cheapest depth by the rows that share signs in a pass.

    A label whose vectors crowd together gets more signs and passes, or none and one whole
    comparison, whichever takes fewer comparisons. The choice bears on time only.
    """
    trial = classes.withColumn("depth", F.lit(0)).withColumn("passes", F.lit(1))
    trial = trial.mapInArrow(_hash, _hashed(kind, vector)).select("label", "width", "code")
    shared = (
        trial.withColumn("depth", F.explode(F.array(*map(F.lit, DEPTHS))))
        .withColumn("prefix", F.expr(f"shiftright(code, {BITS} - depth)"))
        .groupBy("label", "width", "depth", "prefix")
        .agg(F.count("*").cast("double").alias("n"))
    )
    passes = F.create_map(*(F.lit(x) for d in DEPTHS for x in (d, passes_for(d, threshold))))
    wide = F.when(F.col("n") > WINDOW, F.col("n") * F.col("n")).otherwise(0.0)
    costs = (
        shared.groupBy("label", "width", "depth")
        .agg((F.sum("n") * PASS + F.sum(wide)).alias("cost"))
        .withColumn("passes", passes[F.col("depth")])
    )
    best = F.min(F.struct(F.col("cost") * F.col("passes"), "depth", "passes")).alias("best")
    return costs.groupBy("label", "width").agg(best).select(
        "label", "width", "best.depth", "best.passes"
    )


def _hashed(kind: str, vector: str) -> str:
    return f"turn int, label {kind}, width int, depth int, code long, node long, vector {vector}"


def _spanning(node: np.ndarray, close: np.ndarray) -> pd.DataFrame:
    """Each node with the smallest one it is joined to: these links say as much as all of them."""
    at = np.flatnonzero(close.any(axis=1))
    node, close = node[at], close[np.ix_(at, at)]
    label = node.copy()
    while True:
        least = np.minimum(label, np.array([label[row].min() for row in close], dtype=label.dtype))
        if (least == label).all():
            return pd.DataFrame({"a": node, "b": label})[node != label]
        label = least


def _wide_links(threshold: float):
    """Links between rows that share their first signs, among the pairs of two tiles."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows["low"].iloc[0]
        apart = first != rows["high"].iloc[0]
        links = [pd.DataFrame({"a": [], "b": []}, dtype="int64")]
        for _, same in rows.groupby("group", sort=False):
            node, unit = same["node"].to_numpy(), _matrix(same["vector"])
            own = same["tile"].to_numpy() == first
            close = np.zeros((len(node), len(node)), dtype=bool)
            if apart:
                one, other = np.flatnonzero(own), np.flatnonzero(~own)
                found = unit[one] @ unit[other].T >= threshold
                close[np.ix_(one, other)] = found
                close[np.ix_(other, one)] = found.T
            else:
                close = unit @ unit.T >= threshold
                np.fill_diagonal(close, False)
            links.append(_spanning(node, close))
        return pd.concat(links)

    return run


def _window_links(threshold: float):
    """Links between neighbours, each vector with the smallest node it is joined to here."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        links = []
        for _, same in rows.groupby(["turn", "label", "width"], sort=False):
            if len(same) < 2:
                continue
            unit, node = _matrix(same["vector"]), same["node"].to_numpy()
            rank = same["rank"].to_numpy()
            close = unit @ unit.T >= threshold
            close &= np.abs(rank[:, None] - rank[None, :]) <= WINDOW
            # The spanning links of the window graph say as much as all of them.
            label = node.copy()
            while True:
                least = np.where(close, label[None, :], label[:, None]).min(axis=1)
                if (least == label).all():
                    break
                label = least
            links.append(pd.DataFrame({"a": node, "b": label})[node != label])
        return pd.concat(links) if links else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return run


def _tile_counts(threshold: float):
    """How many vectors each one is linked with, among the pairs of two tiles."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = int(rows["low"].iloc[0])
        found = []
        for _, same in rows.groupby(["component", "width"], sort=False):
            tile = same["tile"].to_numpy() == first
            unit, size = _matrix(same["vector"]), same["size"].to_numpy()
            close = unit @ unit.T >= threshold
            np.fill_diagonal(close, False)
            if same["high"].iloc[0] != first:
                close &= tile[:, None] != tile[None, :]
            found.append(pd.DataFrame({"node": same["node"], "n": close @ size}))
        return pd.concat(found)

    return run


def near_vectors(table: DataFrame, threshold: float = 0.93) -> DataFrame:
    """Vectors with equal labels linked at a cosine of at least `threshold`.

    table: `vec_id`, `embedding` (array of numbers), `label`; further columns are ignored. One row
    per input row: `n_links`, the other vectors linked directly; `component_id`, the smallest
    vec_id reachable by links, itself included; `kept`, whether that is its own.

    Vectors without a label, an id or a direction (null, empty, zero, null or non-finite
    components) link with nothing. Vectors of different lengths are not compared. Equal vectors
    are linked with each other, repeated rows too. An id under two labels is two vectors: they share
    no links and no component. Vectors are compared in blocks, however many a label has. An empty
    table has no rows.
    """
    table = table.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").alias("vector"),
        "label",
    )
    kinds = dict(table.dtypes)
    good = table.where(f"vec_id is not null and label is not null and {_valid('vector')}")
    classes = good.groupBy("label", "vector").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("size")
    )
    # Classes go by a number of their own: labels may share ids.
    classes = materialize(
        classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes"
    )
    sized = classes.drop("size", "least").withColumn("width", F.size("vector"))
    depths = materialize(
        _depths(classes.drop("size", "least"), kinds["label"], kinds["vector"], threshold), "vector-depths"
    )
    hashed = sized.join(depths, ["label", "width"]).mapInArrow(
        _hash, _hashed(kinds["label"], kinds["vector"])
    )
    ranked = global_rank(hashed, ["turn", "label", "width", "code", "node"], "vector-order")
    run = F.floor(F.col("rank") / RUN)
    # The first rows of a run also close the windows of the run before.
    halo = F.when(F.col("rank") % RUN < WINDOW, F.array(run, run - 1)).otherwise(F.array(run))
    links = (
        ranked.withColumn("run", F.explode(halo))
        .groupBy("run")
        .applyInPandas(_window_links(threshold), "a long, b long")
    )
    links = materialize(links.distinct(), "vector-links")
    merged = materialize(components(links), "vector-components")

    # Rows that share their first signs, do not fit a window and are not joined yet.
    shared = ["turn", "label", "width", "prefix"]
    signs = ranked.withColumn("prefix", F.expr(f"shiftright(code, {BITS} - depth)"))
    parts = signs.select(*shared, "node").join(merged, "node", "left")
    parts = parts.withColumn("part", F.coalesce("component", "node"))
    wide = (
        parts.groupBy(*shared)
        .agg(
            F.count("*").alias("n"),
            F.min("part").alias("least"),
            F.max("part").alias("most"),
            F.min("node").alias("low"),
        )
        .where(f"n > {WINDOW} and least < most")
        .select(*shared, F.concat_ws("/", "turn", "low").alias("group"))
    )
    inside = signs.join(wide, shared).select("group", "node", "vector")
    late = (
        tile_pairs(inside, "group", "node", BLOCK, "vector-blocks")
        .groupBy("low", "high")
        .applyInPandas(_wide_links(threshold), "a long, b long")
    )
    links = materialize(links.unionByName(late).distinct(), "vector-links")
    merged = materialize(components(links), "vector-components")

    inside = classes.join(merged, "node").withColumn("width", F.size("vector"))
    counts = (
        tile_pairs(inside, "component", "node", TILE, "vector-tiles")
        .groupBy("low", "high")
        .applyInPandas(_tile_counts(threshold), "node long, n long")
        .groupBy("node")
        .agg(F.sum("n").alias("n"))
    )
    names = merged.join(classes.select("node", "least"), "node")
    names = names.groupBy("component").agg(F.min("least").alias("name"))
    facts = (
        classes.join(merged, "node", "left")
        .join(names, "component", "left")
        .join(counts, "node", "left")
        .select(
            F.col("label"),
            "vector",
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("name", "least").alias("component_id"),
        )
    )
    alone = table.where(f"not (vec_id is not null and label is not null and {_valid('vector')})")
    alone = alone.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = good.join(facts, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    return result.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
