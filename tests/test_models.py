from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.models import attribution as A
from serpscope.models import forest as OF
from serpscope.models import quality as QM
from serpscope.models import screening as VIF
from serpscope.operators import features as FT
from serpscope.plans import training as T
from serpscope.session import materialize


@pytest.fixture(scope="module")
def matrix(log):
    uf, qf = FT.user_daily_features(log), FT.query_daily_features(log)
    return materialize(T.training_matrix(log, uf, qf), "matrix")


@pytest.fixture(scope="module")
def model(matrix):
    return QM.train_quality_model(matrix, maxIter=4, maxDepth=3)


def test_model_explains_the_score(model, matrix):
    metrics = QM.holdout_metrics(model, matrix).first()
    assert metrics.r2 > 0.5 and metrics.row_count == matrix.count()
    scores = QM.predict(model, matrix).agg(F.min("prediction"), F.max("prediction")).first()
    assert 0 <= scores[0] and scores[1] <= 100


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, p double")
    got = T.regression_metrics(df, "y", "p").first()
    assert (got.mae, got.r2) == (0.333333, 0.5)


def test_attributions_add_up(model, matrix):
    raw = model.transform(QM.assemble(matrix)).select("event_id", "prediction")
    parts = A.feature_attribution(model, matrix, "event_id")
    total = F.col("base_value")
    for f in S.FEATURES:
        total = total + F.col(f"phi_{f}")
    gap = raw.join(parts, "event_id").agg(F.max(F.abs(total - F.col("prediction")))).first()[0]
    assert gap < 1e-8
    assert parts.count() == matrix.count()


def test_attributions_equal_brute_force_shapley(spark, model, matrix):
    leaves = A.leaf_paths(A.tree_nodes(model, spark).collect())
    x = matrix.limit(3).select(*S.FEATURES).toPandas().to_numpy(dtype=np.float32).astype(float)
    got = A.attribute(x, A.leaf_tables(leaves))
    used = sorted({f for _, path in leaves for f in path})

    def value(row, known):
        total = 0.0
        for v, path in leaves:
            for f, (lo, hi, share) in path.items():
                v *= float(lo < row[f] <= hi) if f in known else share
            total += v
        return total

    m = len(used)
    for row, phi in zip(x, got, strict=True):
        for f in used:
            others = [g for g in used if g != f]
            want = sum(
                factorial(k) * factorial(m - k - 1) / factorial(m)
                * (value(row, {*c, f}) - value(row, set(c)))
                for k in range(m)
                for c in combinations(others, k)
            )
            assert phi[f] == pytest.approx(want, abs=1e-8)


def test_importances_are_ranked(model, matrix):
    ranked = A.importance_ranking(A.feature_attribution(model, matrix, "event_id")).collect()
    values = [r.importance for r in ranked]
    assert len(ranked) == 10 and values == sorted(values, reverse=True)


def test_search_settings():
    settings = QM.trial_settings(5, 42)
    assert settings == QM.trial_settings(5, 42) and len(settings) == 5
    assert all(3 <= s["maxDepth"] <= 8 and 50 <= s["maxIter"] <= 150 for s in settings)


def test_search_returns_the_best_trial(matrix):
    best, table = QM.tune_quality_model(matrix, trials=2, depths=(2, 3), trees=(2, 4))
    top = table.orderBy("mae").first()
    assert best["maxDepth"] == top.max_depth and table.count() == 2
    # The winner's settings are those of a model.
    model = QM.train_quality_model(matrix, **best)
    assert model.getNumTrees == top.trees and model.getOrDefault("maxDepth") == top.max_depth
    again = QM.tune_quality_model(matrix.repartition(3), trials=2, depths=(2, 3), trees=(2, 4), rows=200)
    assert again[1].count() == 2


def test_tables_of_leaves_equal_the_polynomials():
    """Deep paths: the look-up gives what sums over subsets give, to nine places."""
    draw = np.random.default_rng(8)

    def polynomials(x, leaves):
        out = np.zeros(x.shape)
        for value, path in leaves:
            features, m = list(path), len(path)
            weight = [factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)]
            inside = {f: ((x[:, f] > lo) & (x[:, f] <= hi)) * 1.0 for f, (lo, hi, _) in path.items()}
            for f in features:
                sums = [np.ones(len(x))]
                for g in features:
                    if g != f:
                        known = [0.0] + [c * inside[g] for c in sums]
                        unknown = [c * path[g][2] for c in sums] + [0.0]
                        sums = [a + b for a, b in zip(known, unknown)]
                total = sum(w * c for w, c in zip(weight, sums))
                out[:, f] += value * (inside[f] - path[f][2]) * total
        return out

    leaves = []
    for _ in range(300):
        path = {}
        for f in draw.permutation(10)[: draw.integers(0, 9)]:
            lo, hi = sorted(draw.normal(size=2))
            path[int(f)] = (lo, hi, draw.random())
        leaves.append((draw.normal(), path))
    x = draw.normal(size=(500, 10))
    got = A.attribute(x, A.leaf_tables(leaves))
    assert np.abs(got - polynomials(x, leaves)).max() < 1e-9
    assert A.attribute(x, A.leaf_tables([(3.0, {})])).any() == False  # noqa: E712


def test_records_and_promotion(spark, matrix, model):
    ranking = A.importance_ranking(A.feature_attribution(model, matrix, "event_id"))
    good = QM.holdout_metrics(model, matrix)
    weak = good.withColumn("mae", F.col("mae") + 1)
    records = QM.model_record(spark, "quality", "1", good, ranking).unionByName(
        QM.model_record(spark, "quality", "2", weak, ranking)
    )
    got = {r.version: (r.status, len(r.importances)) for r in
           QM.promote_if_better(records).collect()}
    assert got == {"1": ("active", 10), "2": ("shadow", 10)}


@pytest.fixture(scope="module")
def points(spark):
    draw = np.random.default_rng(5)
    data = [(str(i), float(a), float(b)) for i, (a, b) in enumerate(draw.normal(size=(900, 2)))]
    data += [(f"far{i}", 12.0 + i, -12.0 - i) for i in range(5)]
    return spark.createDataFrame(data, "id string, a double, b double")


def test_forest_finds_far_points(points):
    forest = materialize(OF.train_outlier_model(points, ["a", "b"], "id", 50, 64), "forest")
    assert forest.select("tree").distinct().count() == 50
    cut = OF.training_cut(forest, points, ["a", "b"])
    scored = OF.score_outliers(forest, points, ["a", "b"], offset=cut).collect()
    flagged = {r.id for r in scored if r.is_anomaly}
    assert {f"far{i}" for i in range(5)} <= flagged
    assert len(flagged) / len(scored) == pytest.approx(0.1, abs=0.01)
    assert all((r.label == -1) == r.is_anomaly == (r.anomaly_score < 0) for r in scored)


def test_normal_batch_is_held_against_the_training_cut(spark, points):
    gap = spark.createDataFrame([("gap", None, 1.0)], points.schema)
    forest = materialize(OF.train_outlier_model(points, ["a", "b"], "id", 50, 64), "forest")
    cut = OF.training_cut(forest, points, ["a", "b"])
    middle = points.where("abs(a) < 0.5 and abs(b) < 0.5").unionByName(gap)
    scored = OF.score_outliers(forest, middle, ["a", "b"], offset=cut).collect()
    assert sum(bool(r.is_anomaly) for r in scored) == 0
    last = next(r for r in scored if r.id == "gap")
    assert (last.anomaly_score, last.label, last.is_anomaly) == (None, None, None)
    assert {r.sample_rows for r in forest.collect()} == {64}


def test_forest_does_not_depend_on_partitioning(points):
    one = OF.train_outlier_model(points.repartition(1), ["a", "b"], "id", 10, 64)
    many = OF.train_outlier_model(points.repartition(6), ["a", "b"], "id", 10, 64)
    assert sorted(one.collect()) == sorted(many.collect())


@pytest.mark.parametrize("hot_rows", [100, 10_000])
def test_contamination_cut_is_the_quantile(points, hot_rows):
    scored = points.withColumn("_score", F.col("a"))
    cut = OF.contamination_cut(scored, 0.1, hot_rows)
    values = [r.a for r in points.collect()]
    assert cut == pytest.approx(np.quantile(values, 0.1), abs=1e-12)


def test_tree_samples_stay_small_and_distinct(points):
    few = OF.tree_samples(points, ["a"], "id", 4, 32, 1)
    assert few.count() == 4 * 32
    many = OF.tree_samples(points, ["a", "b"], "id", 100, 64, 1)
    sizes = [r[1] for r in many.groupBy("tree").count().collect()]
    assert sizes == [64] * 100
    # Fewer rows than asked for: every tree has all of them.
    short = OF.tree_samples(points.limit(40), ["a", "b"], "id", 5, 64, 1)
    assert [r[1] for r in short.groupBy("tree").count().collect()] == [40] * 5
    assert many.groupBy("tree", "a", "b").count().where("count > 1").count() == 0


def test_rows_made_follow_the_samples_and_trees_differ(spark, monkeypatch):
    """One hash a row: a row is made only for the trees that may take it."""
    made = []

    def counted(df, name):
        made.append(df.count())
        return materialize(df, name)

    monkeypatch.setattr(OF, "materialize", counted)
    table = spark.range(60_000).select(F.col("id").cast("string").alias("id"), F.rand(3).alias("a"))
    drawn = OF.tree_samples(table, ["a"], "id", 40, 64, 1).collect()
    assert len(made) == 1 and 40 * 64 <= made[0] < 40 * 64 * 3
    ids = {}
    for r in drawn:
        ids.setdefault(r.tree, set()).add(r["_id"])
    assert all(len(v) == 64 for v in ids.values()) and len(ids) == 40
    # Trees draw from the whole table, each its own rows.
    assert len(set().union(*ids.values())) > 0.95 * 40 * 64
    assert abs(np.mean([int(r["_id"]) for r in drawn]) - 30_000) < 2_500


def test_path_depths_follow_the_tree():
    tree = {
        "feature": np.array([0, -1, -1]),
        "threshold": np.array([1.0, 0, 0]),
        "left": np.array([1, -1, -1]),
        "right": np.array([2, -1, -1]),
        "depth": np.array([0.0, 1.0, 4.0]),
    }
    got = OF.path_depths(np.array([[0.5], [1.0], [2.0]]), tree)
    assert list(got) == [1.0, 1.0, 4.0]


def test_collinear_features_are_dropped(spark):
    draw = np.random.default_rng(2)
    data = [(float(a), float(b), float(2 * a)) for a, b in draw.normal(size=(300, 2))]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {r.feature: r for r in VIF.collinearity_vif(df, ["a", "b", "c"]).collect()}
    assert got["b"].kept and got["b"].vif < 1.5
    assert got["a"].kept != got["c"].kept


def _grown(draw, depth, bins):
    """Leaves of a tree whose splits come from the bins of each feature, as a fit has them."""
    leaves, stack = [], [({}, 0)]
    while stack:
        path, level = stack.pop()
        f = int(draw.integers(0, 6))
        lo, hi, share = path.get(f, (-np.inf, np.inf, 1.0))
        inner = bins[f][(bins[f] > lo) & (bins[f] < hi)]
        if level == depth or not len(inner):
            leaves.append((draw.normal(), path))
            continue
        t, part = float(draw.choice(inner)), draw.uniform(0.1, 0.9)
        stack.append(({**path, f: (lo, t, share * part)}, level + 1))
        stack.append(({**path, f: (t, hi, share * (1 - part))}, level + 1))
    return leaves


def test_leaves_with_common_bounds_are_looked_up_together():
    """a row took a look-up per leaf, 1600 in a model of 50 trees."""
    draw = np.random.default_rng(3)
    bins = np.sort(draw.normal(size=(6, 31)).astype(np.float32).astype(float), axis=1)
    leaves = [leaf for _ in range(30) for leaf in _grown(draw, 5, bins)]
    assert len(leaves) > 800
    every, groups = A.leaf_tables(leaves)
    assert len(groups) * 8 < len(leaves)
    assert all(len(v) <= A.CELLS for _, sums in groups for v in sums.values())
    x = draw.normal(size=(400, 6))
    # Values on the bounds themselves, and beyond all of them.
    x[:186] = np.array([np.roll(bins[:, i % 31], i // 31) for i in range(186)])
    x[190:192] = [[-np.inf] * 6, [np.inf] * 6]
    want = np.zeros(x.shape)
    for path, table in A.shapley_tables(leaves):
        inside = [(x[:, f] > lo) & (x[:, f] <= hi) for f, (lo, hi, _) in path.items()]
        bits = sum(b.astype(int) << k for k, b in enumerate(inside))
        for k, f in enumerate(path):
            want[:, f] += table[:, k][bits]
    # Below all bounds is inside of (-inf, t], which the plain comparison denies to -inf itself.
    want[190] = A.attribute(np.full((1, 6), -1e300), (every, groups))
    assert np.abs(A.attribute(x, (every, groups)) - want).max() < 1e-9
    # A leaf with more cells than a group may have still has its own.
    wide = [(1.0, {f: (-1.0, 1.0, 0.5) for f in range(9)})]
    assert [len(s[0]) for _, s in A.leaf_tables(wide)[1]] == [3**9]


def test_a_worker_builds_the_tables_of_a_model_once(monkeypatch):
    """every task of the ranking built them anew."""
    built = []
    plain = A.leaf_tables
    monkeypatch.setattr(A, "leaf_tables", lambda leaves: built.append(1) or plain(leaves))
    leaves = [(1.0, {0: (-np.inf, 0.5, 0.5)}), (2.0, {0: (0.5, np.inf, 0.5)})]
    first = A._tables("a", leaves)
    assert A._tables("a", leaves) is first and len(built) == 1
    assert A._tables("b", leaves) is not first and list(A._built) == ["b"]


def test_trainings_on_the_same_rows_share_their_vectors(matrix, monkeypatch):
    """the challenger had its rows assembled, counted, dealt out and written once more."""
    written = []

    def counted(df, name):
        written.append(name)
        return materialize(df, name)

    monkeypatch.setattr(QM, "materialize", counted)
    vectors = QM.training_vectors(matrix)
    assert written == ["vectors"] * 2 and vectors.count() == matrix.count()
    ours = QM.train_quality_model(vectors, maxIter=2, maxDepth=2, subsamplingRate=1.0)
    assert written == ["vectors"] * 2
    alone = QM.train_quality_model(matrix, maxIter=2, maxDepth=2, subsamplingRate=1.0)
    assert written == ["vectors"] * 4
    assert ours.toDebugString.split("\n")[1:] == alone.toDebugString.split("\n")[1:]
