"""Isolation forest: trees grown in parallel from small samples, scoring with Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators.quantiles import MAP_ROWS, group_quantiles
from serpscope.session import materialize

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, depth double, "
    "sample_rows int"
)


def mean_depth(rows: float) -> float:
    """Average path length of an unsuccessful search among so many rows."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (np.log(rows - 1.0) + np.euler_gamma) - 2.0 * (rows - 1.0) / rows


#: Positions on the circle that a row's hash is spread over, for each tree anew.
CIRCLE = 1 << 31


def _position(tree: Column) -> Column:
    """Where a tree sees a row. The multiplier is odd, so the circle is mapped onto itself, and each
    tree turns it by an offset of its own."""
    factor = (tree * 1103515245 + 12345) % (CIRCLE // 2) * 2 + 1
    offset = (tree * 22695477 + 97) % CIRCLE
    return (F.col("_high") * factor + offset) % CIRCLE * F.lit(CIRCLE) + F.col("_low")


def tree_samples(
    df: DataFrame, columns: list[str], key: str, trees: int, rows_per_tree: int, seed: int
) -> DataFrame:
    """Exactly min(rows_per_tree, rows) distinct rows for every tree: those it sees first.

    A row is hashed once. Where it lies on a circle of 2**62 positions differs from tree to tree by
    arithmetic alone, and it is emitted only for the trees that see it within an arc just above the
    share wanted: rows made are in proportion to the samples, not to the table times the trees.
    """
    narrow = df.select(F.col(key).cast("string").alias("_id"), *columns).na.drop("any")
    total = narrow.count()
    wanted = min(rows_per_tree, total)
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.col("_id")))
    hashed = narrow.withColumns(
        {
            "_high": F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % CIRCLE,
            "_low": F.conv(F.substring(digest, 9, 8), 16, 10).cast("long") % CIRCLE,
        }
    )
    numbers = F.sequence(F.lit(0), F.lit(trees - 1))

    def seen(arc: int) -> DataFrame:
        near = F.filter(numbers, lambda t: _position(t.cast("long")) < arc) if arc else numbers
        placed = hashed.withColumn("tree", F.explode(near))
        return placed.withColumn("_position", _position(F.col("tree").cast("long")))

    share = (rows_per_tree + 6 * math.sqrt(rows_per_tree) + 10) / max(1, total)
    if share < 1:
        placed = materialize(seen(math.ceil(share * CIRCLE * CIRCLE)), "tree-samples")
        enough = placed.groupBy("tree").count().where(F.col("count") >= wanted).count() == trees
        if not enough:
            placed = seen(0)
    else:
        placed = seen(0)
    place = F.row_number().over(Window.partitionBy("tree").orderBy("_position", "_id"))
    return placed.withColumn("_place", place).where(F.col("_place") <= wanted).select(
        "tree", "_id", *columns
    )


def grow(sample: pd.DataFrame, columns: list[str], limit: int, seed: int) -> pd.DataFrame:
    """One tree over one small sample: random feature, random cut, until rows are alone."""
    tree = int(sample["tree"].iloc[0])
    # Row order within a group is not fixed; sorting makes the tree reproducible.
    data = sample[columns].sort_values(columns).to_numpy(dtype=float)
    draw = np.random.default_rng([seed, tree])
    nodes: list[list] = []
    stack = [(data, 0, None)]
    while stack:
        rows, depth, parent = stack.pop()
        node = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = node
        spread = rows.max(axis=0) - rows.min(axis=0)
        open_columns = np.flatnonzero(spread > 0)
        if depth >= limit or len(rows) <= 1 or len(open_columns) == 0:
            nodes.append([tree, node, -1, 0.0, -1, -1, depth + mean_depth(len(rows))])
            continue
        feature = int(draw.choice(open_columns))
        low, high = rows[:, feature].min(), rows[:, feature].max()
        cut = float(draw.uniform(low, high))
        nodes.append([tree, node, feature, cut, -1, -1, 0.0])
        goes_left = rows[:, feature] <= cut
        stack.append((rows[~goes_left], depth + 1, (node, 5)))
        stack.append((rows[goes_left], depth + 1, (node, 4)))
    return pd.DataFrame(
        nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "depth"]
    ).assign(sample_rows=len(data))


def train_outlier_model(
    df: DataFrame,
    columns: list[str] | None = None,
    key: str = "event_id",
    trees: int = 100,
    rows_per_tree: int = 256,
    seed: int = 42,
) -> DataFrame:
    """The forest as a node table, one small group per tree."""
    columns = columns or S.OUTLIER_FEATURES
    limit = int(np.ceil(np.log2(rows_per_tree)))
    samples = tree_samples(df, columns, key, trees, rows_per_tree, seed)
    return samples.groupBy("tree").applyInPandas(
        lambda pdf: grow(pdf, columns, limit, seed), NODE_SCHEMA
    )


def path_depths(x: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    """Depth each row reaches in one tree; all rows step down together."""
    at = np.zeros(len(x), dtype=int)
    while True:
        feature = tree["feature"][at]
        moving = feature >= 0
        if not moving.any():
            return tree["depth"][at]
        rows = np.flatnonzero(moving)
        here = at[rows]
        left = x[rows, feature[rows]] <= tree["threshold"][here]
        at[rows] = np.where(left, tree["left"][here], tree["right"][here])


def outlier_score(forest: DataFrame, columns: list[str]) -> Column:
    """Score column in (-1, 0); more negative is more unusual, null where an input is missing.
    The node table is collected: it is bounded by trees x 2 x rows of a tree."""
    nodes = forest.orderBy("tree", "node").toPandas()
    arrays = [
        {c: part[c].to_numpy() for c in ["feature", "threshold", "left", "right", "depth"]}
        for _, part in nodes.groupby("tree")
    ]
    shared = forest.sparkSession.sparkContext.broadcast(arrays)
    # What the trees were grown from, not what was asked for, sets the usual depth. A forest from
    # one row tells nothing apart.
    usual = mean_depth(int(nodes["sample_rows"].max()) if len(nodes) else 0) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in batch])
            known = ~np.isnan(x).any(axis=1)
            out = np.full(len(x), np.nan)
            if known.any() and shared.value:
                depth = np.mean([path_depths(x[known], t) for t in shared.value], axis=0)
                out[known] = -np.power(2.0, -depth / usual)
            yield pd.Series(out).astype(object).where(~np.isnan(out), None)

    return score(*[F.col(c).cast("double") for c in columns])


def score_outliers(
    forest: DataFrame,
    df: DataFrame,
    columns: list[str] | None = None,
    *,
    offset: float | None,
) -> DataFrame:
    """Decision score and flag per row. ``offset`` is the cut that ``training_cut`` found on the
    training rows, None if there were none. Rows with a missing input keep a null score and no
    flag."""
    columns = columns or S.OUTLIER_FEATURES
    scored = df.withColumn("_score", outlier_score(forest, columns))
    decision = F.col("_score") - F.lit(offset).cast("double")
    return scored.withColumns(
        {
            "anomaly_score": decision,
            "label": F.when(decision < 0, -1).when(decision >= 0, 1),
            "is_anomaly": decision < 0,
        }
    ).drop("_score")


def training_cut(
    forest: DataFrame,
    df: DataFrame,
    columns: list[str] | None = None,
    contamination: float = 0.1,
    hot_rows: int = MAP_ROWS,
) -> float:
    """The cut to keep beside a forest: the contamination share of its training rows lies below."""
    scored = df.select(outlier_score(forest, columns or S.OUTLIER_FEATURES).alias("_score"))
    return contamination_cut(materialize(scored, "scores"), contamination, hot_rows)


def contamination_cut(scored: DataFrame, contamination: float, hot_rows: int = MAP_ROWS) -> float:
    """Score below which the contamination share of the rows lies."""
    whole = scored.where("_score is not null").select(F.lit(1).alias("_all"), "_score")
    cut = group_quantiles(whole, ["_all"], "_score", {"cut": contamination}, hot_rows=hot_rows)
    row = cut.first()
    return row["cut"] if row else None
