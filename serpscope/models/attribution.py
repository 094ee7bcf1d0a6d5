"""Additive feature attributions of a tree ensemble, and their global ranking."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import factorial, prod

import numpy as np
import pandas as pd
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serpscope import schema as S
from serpscope.plans.training import feature_columns
from serpscope.session import scratch_path


def tree_nodes(model: GBTRegressionModel, spark: SparkSession) -> DataFrame:
    """The ensemble's nodes as a table, read from the saved model."""
    path = scratch_path(spark, "model")
    model.write().save(path)
    node = "nodeData"
    weights = spark.createDataFrame(
        list(enumerate(float(w) for w in model.treeWeights)), "treeID int, weight double"
    )
    return (
        spark.read.parquet(f"{path}/data")
        .join(weights, "treeID")
        .select(
            F.col("treeID").alias("tree"),
            "weight",
            *[
                F.col(f"{node}.{a}").alias(b)
                for a, b in [
                    ("id", "node"),
                    ("prediction", "value"),
                    ("rawCount", "rows"),
                    ("leftChild", "left"),
                    ("rightChild", "right"),
                ]
            ],
            F.col(f"{node}.split.featureIndex").alias("feature"),
            F.try_element_at(f"{node}.split.leftCategoriesOrThreshold", F.lit(1)).alias(
                "threshold"
            ),
        )
    )


def leaf_paths(nodes: list) -> list[tuple]:
    """Per leaf its weighted value and, per feature on its path, the interval of values that
    lead to it and the share of training rows the feature's splits let through."""
    by_id = {(n.tree, n.node): n for n in nodes}
    leaves = []
    stack = [(by_id[t, 0], {}) for t in sorted({n.tree for n in nodes})]
    while stack:
        n, path = stack.pop()
        if n.left < 0:
            leaves.append((n.weight * n.value, path))
            continue
        for child_id, is_left in ((n.left, True), (n.right, False)):
            child = by_id[n.tree, child_id]
            low, high, share = path.get(n.feature, (-np.inf, np.inf, 1.0))
            low, high = (low, min(high, n.threshold)) if is_left else (max(low, n.threshold), high)
            stack.append(
                (child, {**path, n.feature: (low, high, share * child.rows / n.rows)})
            )
    return leaves


def shapley_tables(leaves: list[tuple]) -> list[tuple]:
    """Per leaf its path, and a table of Shapley values.

    A leaf's value is a product over its path's features: of a known feature whether it is inside
    its interval, of an unknown one its pass-through share. So its contributions depend on a row
    only through which of its m features are inside: one row of 2**m, indexed by these bits. Tables
    of leaves with the same m are computed together. Leaves without a path contribute nothing.
    """
    by_size: dict[int, list[int]] = {}
    for at, (_, path) in enumerate(leaves):
        if path:
            by_size.setdefault(len(path), []).append(at)
    tables: dict[int, tuple] = {}
    for m, group in sorted(by_size.items()):
        weight = [factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)]
        inside = ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float)
        for at in range(0, len(group), TOGETHER):
            some = [leaves[i] for i in group[at : at + TOGETHER]]
            value = np.array([v for v, _ in some])
            share = np.array([[s for _, _, s in path.values()] for _, path in some])
            found = np.empty((len(some), 1 << m, m))
            for f in range(m):
                # Coefficients by number of known features among the others.
                sums = [np.ones((len(some), 1 << m))]
                for g in range(m):
                    if g != f:
                        known = [0.0] + [c * inside[:, g] for c in sums]
                        unknown = [c * share[:, g, None] for c in sums] + [0.0]
                        sums = [a + b for a, b in zip(known, unknown, strict=True)]
                total = sum(w * c for w, c in zip(weight, sums, strict=True))
                found[:, :, f] = value[:, None] * (inside[:, f] - share[:, f, None]) * total
            for i, (_, path), table in zip(group[at : at + TOGETHER], some, found):
                tables[i] = (path, table)
    return [tables[i] for i in sorted(tables)]


#: Leaves whose tables are computed together.
TOGETHER = 2000
#: Cells of the grid that leaves share.
CELLS = 1 << 12


def _cuts(path: dict) -> dict[int, set]:
    return {f: {t for t in (lo, hi) if np.isfinite(t)} for f, (lo, hi, _) in path.items()}


def shared_grids(tables: list[tuple]) -> list[tuple]:
    """Leaves, in their order, in groups whose bounds cut the values into at most CELLS cells: the
    cuts of each feature and the group's leaves. The leaves of a tree have most bounds in common. A
    leaf whose own cells are more has a group of its own."""
    groups: list[tuple] = []
    for path, table in tables:
        own = _cuts(path)
        if groups:
            cuts, members = groups[-1]
            both = {f: cuts.get(f, set()) | own.get(f, set()) for f in {*cuts, *own}}
            if prod(len(c) + 1 for c in both.values()) <= CELLS:
                groups[-1] = (both, members)
                members.append((path, table))
                continue
        groups.append((own, [(path, table)]))
    return [({f: np.array(sorted(c)) for f, c in sorted(cuts.items())}, m) for cuts, m in groups]


def _filled(cuts: dict[int, np.ndarray], members: list[tuple]) -> np.ndarray:
    """Sums of the members' Shapley values, by feature and cell."""
    place = {f: i for i, f in enumerate(cuts)}
    sizes = [len(c) + 1 for c in cuts.values()]
    grid = np.zeros((len(cuts), *sizes))
    for path, table in members:
        bits = np.zeros([1] * len(sizes), dtype=np.int64)
        for k, (f, (lo, hi, _)) in enumerate(path.items()):
            # Cell c holds the values above c cuts.
            cell = np.arange(sizes[place[f]])
            low = 0 if lo == -np.inf else np.searchsorted(cuts[f], lo) + 1
            high = len(cuts[f]) if hi == np.inf else np.searchsorted(cuts[f], hi)
            shape = [-1 if i == place[f] else 1 for i in range(len(sizes))]
            bits = bits + (((cell >= low) & (cell <= high)).astype(np.int64) << k).reshape(shape)
        for k, f in enumerate(path):
            grid[place[f]] += table[:, k][bits]
    return grid.reshape(len(cuts), -1)


def leaf_tables(leaves: list[tuple]) -> tuple[dict, list[tuple]]:
    """All cuts of each feature, and per group of leaves what a row's cell is and gives.

    Shapley values of leaves add up, and each depends on a row only through its cell in the leaf's
    bounds. So leaves with common bounds are summed into one grid: a row takes a look-up per group
    and feature, not per leaf. A group has the step of each place between all cuts of a feature,
    whose sum over features is the row's cell, and the sums by feature and cell.
    """
    groups = shared_grids(shapley_tables(leaves))
    every = {
        f: np.unique(np.concatenate([c[f] for c, _ in groups if f in c]))
        for f in sorted({f for c, _ in groups for f in c})
    }
    found = []
    for cuts, members in groups:
        steps, stride = {}, 1
        for f, own in reversed(cuts.items()):
            # Places above i of all cuts are above as many of the group's as lie below the next.
            above = np.searchsorted(own, every[f], side="right")
            steps[f] = np.concatenate([[0], above]) * stride
            stride *= len(own) + 1
        found.append((steps, dict(zip(cuts, _filled(cuts, members), strict=True))))
    return every, found


def attribute(x: np.ndarray, tables: tuple[dict, list[tuple]]) -> np.ndarray:
    """Shapley values of each row, summed over groups of leaves.

    A missing value lies above all cuts, as the model sends it right at every split."""
    every, groups = tables
    out = np.zeros(x.shape[::-1])
    place = {f: np.searchsorted(cuts, np.ascontiguousarray(x[:, f])) for f, cuts in every.items()}
    for steps, sums in groups:
        cell = np.zeros(len(x), dtype=np.int64)
        for f, step in steps.items():
            cell += step.take(place[f])
        for f, values in sums.items():
            out[f] += values.take(cell)
    return out.T


_built: dict[str, tuple] = {}


def _tables(name: str, leaves: list[tuple]) -> tuple:
    """Those of the last model stay with the worker: its next tasks need them again."""
    if name not in _built:
        _built.clear()
        _built[name] = leaf_tables(leaves)
    return _built[name]


def base_value(leaves: list[tuple]) -> float:
    """Expected prediction when no feature is known."""
    return float(sum(v * np.prod([s for _, _, s in p.values()]) for v, p in leaves))


def feature_attribution(model: GBTRegressionModel, df: DataFrame, key: str) -> DataFrame:
    """Per row the base value and ten attributions that add up to the raw prediction."""
    spark = df.sparkSession
    # Bounded by the model: trees x nodes per tree.
    leaves = leaf_paths(tree_nodes(model, spark).collect())
    shared, name = spark.sparkContext.broadcast(leaves), uuid.uuid4().hex
    base = base_value(leaves)
    names = [f"phi_{f}" for f in S.FEATURES]
    schema = T.StructType(
        [df.schema[key], T.StructField("base_value", T.DoubleType())]
        + [T.StructField(n, T.DoubleType()) for n in names]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Larger than the leaves, so computed where they are used: a worker computes them once.
        tables = _tables(name, shared.value)
        for batch in batches:
            values = attribute(batch[S.FEATURES].to_numpy(dtype=float), tables)
            out = pd.DataFrame(values, columns=names)
            out.insert(0, "base_value", base)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    return feature_columns(df, key).mapInPandas(run, schema)


def importance_ranking(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    means = attributions.agg(*[F.avg(F.abs(f"phi_{f}")).alias(f) for f in S.FEATURES])
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("importance")) for f in S.FEATURES]
    return means.select(F.inline(F.array(*rows))).orderBy(F.desc("importance"), "feature")
