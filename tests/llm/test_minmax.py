import numpy as np
from brute import documents, near_copies
from texts import corpus  # noqa: F401

from serpscope.llm import minmax as M
from serpscope.llm.common import global_rank


def found(spark, rows, percent=85):
    return sorted(map(tuple, M.near_duplicates(documents(spark, rows), percent).collect()))


def test_equals_brute_force(spark, corpus):
    assert found(spark, corpus) == near_copies(corpus, 85)


def test_chains_join_what_is_not_alike_itself(spark):
    words = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[2 * i] = f"new{i}"
    want = near_copies(rows, 85)
    assert len({r[2] for r in want}) == 1
    assert found(spark, rows) == want


def test_tiles_smaller_than_a_bucket(spark, corpus, monkeypatch):
    monkeypatch.setattr(M, "TILE", 3)
    assert found(spark, corpus) == near_copies(corpus, 85)


def test_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = M.signature(values[:2500]), M.signature(values[500:])
    assert abs((a == b).mean() - 2000 / 3000) < 0.1
    assert (M.signature(np.concatenate((values, values))) == M.signature(values)).all()


def test_rows_without_id_repeated_rows_and_empty_table(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (None, None), (5, text), (5, text), (7, text)]
    got = [tuple(r) for r in M.near_duplicates(documents(spark, rows)).collect()]
    assert sorted(r for r in got if r[0] is not None) == [
        (5, 4, 5, True),
        (5, 4, 5, True),
        (7, 4, 5, False),
    ]
    # Without an id a row is alone, even if its text is another's.
    assert sorted(r for r in got if r[0] is None) == [(None, 0, None, True), (None, 4, None, True)]
    assert M.near_duplicates(documents(spark, [])).count() == 0


def test_one_row_of_each_group_stays(spark):
    text, other = "a b c d e f g h", "some other words that nothing else has in it"
    rows = [(1, text), (1, text), (None, text), (None, other), (1, other), (2, None), (2, None), (3, "")]
    docs = documents(spark, rows).withColumnRenamed("node", "row").coalesce(1)
    kept = M.one_of_each(docs, 80)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, text), (None, other), (2, None), (2, None), (3, "")], key=str)
    assert M.one_of_each(docs.limit(0)).count() == 0


def test_ranks_start_no_workers_for_plain_rows(spark):
    """Offsets are a local relation; from a list of rows they came by an RDD of Python's own."""
    ranked = global_rank(spark.range(100).toDF("n").repartition(3), ["n"], "test-ranks")
    assert "ExistingRDD" not in ranked._jdf.queryExecution().toString()
    assert sorted(map(tuple, ranked.collect())) == [(i, i) for i in range(100)]
    assert global_rank(spark.range(0).toDF("n"), ["n"], "test-ranks").count() == 0
