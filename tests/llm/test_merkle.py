import hashlib
import random
import zlib

import pytest

from serpscope.llm.merkle import manifest, proofs, tampered_text
from serpscope.llm.queries import merkle


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def brute(rows, fanout=16):
    by = {}
    for row in rows:
        by.setdefault(row.source, []).append((row.doc_id, leaf(row, row.text), row))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[source] = tree([r[1] for r in by[source]], fanout)
    top = tree([trees[s][-1][0] for s in order], fanout)
    root, out = top[-1][0], []
    for j, source in enumerate(order):
        for i, (doc_id, own, row) in enumerate(by[source]):
            text = row.text
            if None not in (doc_id, text) and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                text = "".join(c.lower() if c.isascii() else c for c in text)
            node, proof = leaf(row, text), []
            for levels, at in ((trees[source], i), (top, j)):
                for level in levels[:-1]:
                    start = at // fanout * fanout
                    run = level[start : start + fanout]
                    proof += run[: at - start] + run[at - start + 1 :]
                    run[at - start] = node
                    node, at = h(run), at // fanout
            found = (trees[source][-1][0], root, h(proof), node, node == root)
            out.append((doc_id, own, *found, proof))
    return sorted(out, key=str)


SCHEMA = "text string, doc_id long, lang string, n_chars long, source string, rank long, block int, node string"


def proved(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    fanout = options.get("fanout", 16)
    blocks = manifest(docs.repartition(3), seen={"text": tampered_text()}, **options)
    found = [tuple(r) for r in proofs(blocks, fanout).collect()]
    return sorted(found, key=str), brute(docs.collect(), fanout)


def rows(n, sources, seed=1):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        key = i if i % 50 else None
        lang = draw.choice(["en", None, "ü"])
        text = draw.choice(["Abc", "é B", ""]) + str(i % 90) if i % 7 else None
        out.append((text, key, lang, i, draw.choice(sources), 1, 2, "x"))
    return out


@pytest.mark.parametrize("block", [16, None])
def test_hot_source_and_many_small_ones(spark, block):
    some = rows(700, ["big", "big", None, "a", *(f"é{k}" for k in range(40))])
    got, want = proved(spark, [*some, *[some[3]] * 20, *rows(600, ["big"], 2)], block=block)
    assert got == want


@pytest.mark.parametrize("n", [2, 9, 10, 28, 55])
def test_any_number_of_blocks(spark, n):
    got, want = proved(spark, rows(n, ["one"]), fanout=3, block=1)
    assert got == want


def test_groups_of_one_and_no_group(spark):
    got, want = proved(spark, [(f"T{i}", i, "en", 1, f"s{i:03}", 1, 2, "x") for i in range(40)], fanout=4)
    assert got == want
    got, want = proved(spark, rows(1, [None]))
    assert got == want and got[0][7] == []


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert proofs(manifest(docs)).count() == 0


def test_untouched_documents_verify(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert all(r.verified for r in proofs(manifest(docs)).collect())


def test_the_given_documents(spark, data):
    want = [r[:7] for r in brute(spark.read.parquet(f"{data}/documents.parquet").collect())]
    got = [tuple(r) for r in merkle(spark, data).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert not all(r[6] for r in got)
