import random

from brute import documents, edit_distance
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import corpus  # noqa: F401

from serpscope.llm import decontaminate as D


@settings(max_examples=500, deadline=None)
@given(st.text("abc ", min_size=1, max_size=90), st.text("abc ", max_size=120))
def test_bit_parallel_distance(pattern, text):
    distance, end = D.Pattern(pattern).best(text)
    assert distance == edit_distance(pattern, text)
    assert edit_distance(pattern, text[:end]) == distance


def edited(draw, text, n):
    text = list(text)
    for _ in range(n):
        at, what = draw.randrange(len(text)), draw.randrange(3)
        text[at : at + (what > 0)] = [draw.choice("xyz")] if what < 2 else []
    return "".join(text)


def items(spark, rows):
    return spark.createDataFrame([(*r, 3) for r in rows], "item_id long, text string, doc_id int")


def test_equals_brute_force(spark, monkeypatch):
    draw = random.Random(4)

    def text(n):
        return " ".join("".join(draw.choice("abcd") for _ in range(5)) for _ in range(n))

    bench = [(i, text(8 + i % 9)) for i in range(12)] + [(12, bench_text := text(10)), (13, bench_text)]
    docs = [(i, text(40)) for i in range(20)]
    for i in range(60):
        own = edited(draw, bench[i % 14][1], i % 8)
        docs.append((100 + i, f"{text(10)}, {own.upper()}! {text(i % 4)}"))
    docs += [(200, None), (201, ""), (202, bench[0][1]), (202, bench[0][1]), (None, bench[1][1])]
    want = []
    for doc_id, body in docs:
        for item_id, item in bench:
            item, body_ = D.normal(item), D.normal(body)
            distance = edit_distance(item, body_)
            if distance <= int(D.RATE * len(item)):
                want.append((doc_id, item_id, distance))
    bench += [(20, None), (21, ""), (22, " .,"), (None, "a")]
    for block in (4_000_000, 300):
        monkeypatch.setattr(D, "BLOCK_CHARACTERS", block)
        got = D.benchmark_matches(documents(spark, docs), items(spark, bench))
        got = got.select("doc_id", "item_id", "distance").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_tables(spark, corpus):
    none = items(spark, [])
    assert D.benchmark_matches(documents(spark, corpus), none).count() == 0
    assert D.benchmark_matches(documents(spark, []), items(spark, [(1, "a b c")])).count() == 0
