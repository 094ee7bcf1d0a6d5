import random
import zlib

import numpy as np
import pytest

from serpscope.llm import sharding
from serpscope.llm.sharding import hilbert_index, hilbert_shards, write_shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank long, curve int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("dims, bits", [(2, 5), (3, 4), (4, 3)])
def test_curve_visits_neighbours(dims, bits):
    points = np.indices([1 << bits] * dims).reshape(dims, -1).T
    order = points[np.argsort(hilbert_index(points, bits))]
    assert len(np.unique(hilbert_index(points, bits))) == len(points)
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(2)
    out = [
        (i, "é" * int(n), f"l{draw.integers(4)}", f"s{draw.integers(30)}", int(n))
        for i, n in enumerate(draw.integers(0, 900, 500))
    ]
    return [*out, (None, None, None, None, None), (7, "", "l1", None, None), out[3], out[3]]


@pytest.mark.parametrize("shards", [1, 16, 700])
def test_counts_slots_and_checksums(spark, rows, shards):
    got = hilbert_shards(table(spark, rows), ["lang", "source", "n_chars"], shards).collect()
    assert len(got) == len(rows)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    by_shard = {}
    for r in got:
        if r["doc_id"] != 7:
            text = texts[r["doc_id"]]
            assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        assert 0 <= r["shard"] < shards and r["law"] == "rows" and r["grown_shard"] is None
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by_shard.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_files_can_be_skipped(spark, rows, tmp_path):
    docs = table(spark, [r for r in rows if r[0] is not None and r[0] != 7])
    docs = docs.dropDuplicates(["doc_id"])
    placed = hilbert_shards(docs, ["lang", "source", "n_chars"], 16)
    write_shards(docs, placed, "doc_id", str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == docs.count()
    for condition in ("n_chars > 800", "lang = 'l0'", "source = 's3'"):
        assert back.where(condition).select("shard").distinct().count() <= 10


def test_empty_table(spark):
    assert hilbert_shards(table(spark, []), ["lang", "source", "n_chars"]).count() == 0


def test_text_cells_hold_equal_counts_whatever_values_begin_with(spark):
    """One value that breaks the shared beginning leaves all cells in use."""
    urls = [f"https://www.site{i:03}.org" for i in range(100)] + ["ftp://x", "", None]
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "d string, i int").repartition(3)
    cells = {r["d"]: r["curve"] for r in sharding.with_curve(df, ["d"]).collect()}
    used = sorted(cells.values())
    assert len(set(used)) == 16 and max(map(used.count, set(used))) <= 9
    assert cells[None] == cells[""]
    # In one dimension the curve is the order of the values.
    known = sorted((u for u in urls if u is not None), key=str.encode)
    assert [cells[u] for u in known] == sorted(cells[u] for u in known)


def test_shards_by_brute_force(spark):
    """The assignment recomputed: rows in the order of curve, checksum and id, cut in even runs."""
    draw = random.Random(1)
    rows = [
        (i if i % 9 else None, draw.choice(["a", "b c", None, "", f"t{i}"]), draw.choice(["x", "y", None]), i % 13)
        for i in range(150)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(4)
    got = sharding.hilbert_shards(docs, ["source", "n"], 16).collect()
    order = sorted(got, key=lambda r: (r.curve, r.text_crc32, r.doc_id is not None, r.doc_id or 0, r["size"]))
    n = len(order)
    want, slots = [], {}
    for rank, r in enumerate(order):
        shard = rank * 16 // n
        want.append((r.doc_id, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
    key = lambda r: (r[1], r[2])
    assert sorted(((r.doc_id, r.shard, r.slot) for r in got), key=key) == sorted(want, key=key)
    assert max(slots.values()) - min(slots.values()) <= 1 and len(slots) == 16
    for r in got:
        assert r.text_crc32 in {zlib.crc32((t or "").encode()) for _, t, _, _ in rows}
    by_point = {(s, m): None for _, _, s, m in rows}
    curves = sharding.with_curve(docs.select("source", "n"), ["source", "n"]).collect()
    for r in curves:
        assert by_point[r.source, r.n] in (None, r.curve)
        by_point[r.source, r.n] = r.curve
    empty = sharding.hilbert_shards(docs.limit(0), ["source", "n"], 16)
    assert empty.count() == 0
