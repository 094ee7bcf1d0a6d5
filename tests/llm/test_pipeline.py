import pyarrow as pa
from brute import base_spans, edit_distance, near_copies

import corpus_pipeline as P
from serpscope.llm import queries
from serpscope.llm.decontaminate import RATE, normal
from serpscope.session import BATCH_BYTES, bound_batches, materialize


def test_each_stage_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    before = docs.collect()
    for name, stage in P.STAGES[:-1]:
        docs = materialize(stage(spark, docs, data), name)
        assert docs.columns == columns
        after = docs.collect()
        kept = {r["doc_id"] for r in after}
        assert len(kept) == len(after)
        if name == "quality_classifier":
            scores = queries.quality(spark, data).collect()
            assert kept == {r["doc_id"] for r in scores if r["predicted"]} and len(kept) < len(before)
        elif name == "minhash_near_dedup":
            want = near_copies([(r["doc_id"], r["text"]) for r in before], P.SIMILAR)
            assert kept == {r[0] for r in want if r[3]} and len(kept) < len(before)
        elif name == "benchmark_decontamination":
            items = [normal(r["text"]) for r in queries.table(spark, data, "benchmark").collect()]
            whole = {r["doc_id"] for r in before if any(i in normal(r["text"]) for i in items)}
            gone = [r for r in before if r["doc_id"] not in kept]
            assert whole and not kept & whole
            for r in gone:
                text = normal(r["text"])
                assert any(i in text for i in items) or any(
                    edit_distance(i, text) <= RATE * len(i) for i in items
                )
        else:
            assert len(after) == len(before)
            texts = {r["doc_id"]: r["text"] for r in before}
            for r in after:
                assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
                if not base_spans(texts[r["doc_id"]]) and "token" not in texts[r["doc_id"]]:
                    assert r["text"] == texts[r["doc_id"]]
        before = after
    packed = P.STAGES[-1][1](spark, docs, data).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in before}
    run = P.run(spark, data).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, packed))


def test_near_copies_of_four_fifths_are_dropped(spark, data):
    """One word in about 50 changed: similarity between 0.80 and 0.85."""
    own = [f"w{i}" for i in range(300)]
    other = ["x" if i % 52 == 26 else w for i, w in enumerate(own)]
    rows = [(1, " ".join(own)), (2, " ".join(other)), (3, " ".join(own[:150]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in P.keep_one_of_each(spark, docs, data).collect()}
    assert kept == {r[0] for r in near_copies(rows, 80) if r[3]} == {1, 3}
    assert all(r[3] for r in near_copies(rows, 85))


def test_stages_judge_rows_whatever_their_ids(spark, data):
    items = queries.table(spark, data, "benchmark").collect()
    good = [r["text"] for r in queries.table(spark, data, "documents").limit(3).collect()]
    rows = [(1, good[0]), (1, good[0]), (None, good[0]), (1, items[0]["text"]), (None, good[1])]
    rows += [(2, None), (2, None), (3, "")]
    schema = "doc_id long, text string, row long, label int, n_chars int"
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], schema).coalesce(1)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), data).count() == 0
        texts = [(r["doc_id"], r["text"]) for r in out.collect()]
        if name == "minhash_near_dedup":
            want = [rows[0], *rows[3:]]
            assert sorted(texts, key=str) == sorted(want, key=str)
        elif name == "benchmark_decontamination":
            assert sorted(texts, key=str) == sorted([r for r in rows if r != rows[3]], key=str)
        elif name == "pii":
            assert len(texts) == len(rows)
    assert P.STAGES[-1][1](spark, docs.limit(0), data).count() == 0


def test_batches_are_bounded_by_bytes(spark, data):
    """Long rows come to a Python worker in batches of some megabytes, not by thousands."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    docs = spark.range(3000, numPartitions=1).selectExpr(
        "id as doc_id", f"concat(id, repeat(' w', {1 << 13})) as text", "1L as n_chars"
    )

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    for _, stage in P.STAGES:
        spark.conf.unset(key)
        stage(spark, docs.limit(0), data)
        found = docs.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in found) == 3000
        assert max(r["bytes"] for r in found) <= BATCH_BYTES + (1 << 16)
    spark.conf.set(key, "1m")
    bound_batches(spark)
    assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)
