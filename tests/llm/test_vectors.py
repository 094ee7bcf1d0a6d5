import numpy as np
import pytest
from brute import smallest_reachable

from serpscope.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, node long, code long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(3)
    middle = draw.standard_normal((30, 24))
    out = []
    for i in range(400):
        noise = draw.choice([0.02, 0.1, 0.25])
        vector = middle[draw.integers(30)] + noise * draw.standard_normal(24)
        out.append((i, [float(np.float32(x)) for x in vector], int(draw.integers(3))))
    out += [(400 + i, out[i][1], out[i][2]) for i in range(20)]
    out += [(500, None, 1), (501, [], 1), (502, [0.0] * 24, 1), (503, [float("nan")] * 24, 1)]
    out += [(504, [None, 1.0] * 12, 1), (505, out[0][1], None), (506, out[0][1], None)]
    out += [(507, [float("inf")] + [1.0] * 23, 1), (508, [1.0, 2.0], 1)]
    return out


def brute(rows):
    def usable(v, label):
        if v is None or label is None or not v or any(x is None for x in v):
            return False
        return bool(np.isfinite(v).all() and np.any(v))

    good = [r for r in rows if usable(r[1], r[2])]
    links, count = [], dict.fromkeys((r[0] for r in rows), 0)
    for i, (a, x, p) in enumerate(good):
        for b, y, q in good[:i]:
            if p == q and len(x) == len(y):
                if np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links.append((a, b))
                    count[a] += 1
                    count[b] += 1
    low = smallest_reachable(count, links)
    return sorted((i, n, low[i], low[i] == i) for i, n in count.items())


def test_equals_brute_force(spark, rows):
    assert sorted(map(tuple, V.near_vectors(table(spark, rows)).collect())) == brute(rows)


def test_recall_with_small_windows_and_tiles(spark, rows, monkeypatch):
    monkeypatch.setattr(V, "WINDOW", 8)
    monkeypatch.setattr(V, "RUN", 32)
    monkeypatch.setattr(V, "TILE", 16)
    got = {r["vec_id"]: r["n_links"] for r in V.near_vectors(table(spark, rows)).collect()}
    want = {r[0]: r[1] for r in brute(rows)}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_empty_table(spark):
    assert V.near_vectors(table(spark, [])).count() == 0


def test_crowded_vectors_keep_their_links(spark, monkeypatch):
    """Vectors with a strong common mean share their first signs far beyond a window."""
    monkeypatch.setattr(V, "WINDOW", 8)
    monkeypatch.setattr(V, "RUN", 32)
    monkeypatch.setattr(V, "TILE", 16)
    monkeypatch.setattr(V, "BLOCK", 64)
    draw = np.random.default_rng(5)
    mean = 2 * draw.standard_normal(64)
    crowd = mean + draw.standard_normal((1500, 64))
    pairs = crowd[:200] + 0.8 * draw.standard_normal((200, 64))
    values = np.concatenate((crowd, pairs)).astype(np.float32)
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(values)]
    unit = values.astype(float) / np.linalg.norm(values.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    assert want.sum() >= 300
    # A pass that seems dear leaves one whole comparison, a cheap one more signs.
    for cost in (1500, 10):
        monkeypatch.setattr(V, "PASS", cost)
        got = np.zeros(len(rows))
        for r in V.near_vectors(table(spark, rows)).collect():
            got[r["vec_id"]] = r["n_links"]
        assert (got <= want).all() and got.sum() >= 0.95 * want.sum()


def test_passes_give_the_chance_asked_for():
    for depth in V.DEPTHS:
        meet = (1 - np.arccos(0.93) / np.pi) ** depth
        assert 1 - (1 - meet) ** V.passes_for(depth, 0.93) >= V.RECALL


def test_an_id_under_two_labels_joins_nothing(spark):
    x, y = [1.0, 0.0, 0.2], [0.0, 1.0, 0.1]
    rows = [(1, x, 1), (1, y, 2), (2, x, 1), (3, y, 2), (1, x, 1)]
    got = sorted(map(tuple, V.near_vectors(table(spark, rows)).collect()))
    assert got == [
        (1, 1, 1, True),
        (1, 2, 1, True),
        (1, 2, 1, True),
        (2, 2, 1, False),
        (3, 1, 1, False),
    ]
