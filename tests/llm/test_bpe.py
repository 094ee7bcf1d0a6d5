import hashlib
import random

import numpy as np
import pytest
import tiktoken
from brute import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import corpus  # noqa: F401

from serpscope.llm import bpe
from serpscope.llm.queries import byte_pairs

OWN = bpe.Codec()
LIBRARY = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=OWN.ranks, special_tokens={})
TEXTS = st.text(
    st.sampled_from("aBtsldm''s 09$,_\n\t\r\x0b\x1c\x1f\x85\xa0 ​́éÅΣß漢🙂<|>!٣")
    | st.characters(exclude_categories=["Cs"]),
    max_size=60,
)


def back(codec, ids):
    parts = [b""] * len(ids)
    for k, found in codec.decode(ids):
        parts[k] += found
    return parts


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_ids_equal_the_library(texts):
    ids = OWN.encode(texts)
    assert [i.tolist() for i in ids] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert back(OWN, ids) == [t.encode() for t in texts]


def odd_texts():
    draw = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    return [
        "<|endoftext|> x",
        "it's  they'll\n\n 've",
        "",
        " " * 900,
        "-" * 3000,
        "abc" * 700 + " x",
        "é" * 400,
        "".join(draw.choice(letters) for _ in range(4000)),
        *("".join(draw.choice(letters) for _ in range(n)) for n in (bpe.LONG - 1, bpe.LONG, bpe.LONG + 1)),
        *(" ".join(draw.choice(letters) * draw.randint(1, 9) for _ in range(50)) for _ in range(20)),
    ]


@pytest.mark.parametrize("setting", ["LONG", "STEP_ROWS", "SLICE", "DECODED", "REMEMBERED"])
def test_bounds_change_nothing(monkeypatch, setting):
    texts = odd_texts()
    want = [LIBRARY.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(bpe, setting, 7)
    own = bpe.Codec()
    for _ in range(2):
        ids = own.encode(texts)
        assert [i.tolist() for i in ids] == want
    assert back(own, ids) == [t.encode() for t in texts]


def test_other_vocabulary():
    path = bpe.RANKS.replace("byte_bpe_50k", "byte_bpe_multi_50k")
    own = bpe.Codec(path)
    library = tiktoken.Encoding("m", pat_str=bpe.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    texts = [*odd_texts(), "Ünder größe ελληνικά 中文字 русский"]
    assert [i.tolist() for i in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def wanted(rows):
    out = []
    for doc_id, text in rows:
        ids = np.array(LIBRARY.encode_ordinary(text or ""), dtype="<u4")
        digests = [hashlib.sha256(b).hexdigest() for b in (ids.tobytes(), (text or "").encode())]
        out.append((doc_id, len(ids), *digests))
    return sorted(out, key=str)


def test_documents(spark, corpus):  # noqa: F811
    rows = [*corpus, (None, "no id"), (None, None), corpus[3], corpus[3], (9, "word " * 300_000)]
    got = bpe.coded_digests(bpe.round_trip(documents(spark, rows).repartition(3))).collect()
    assert sorted((tuple(r) for r in got), key=str) == wanted(rows)
    assert bpe.round_trip(documents(spark, rows).limit(0)).count() == 0


def test_the_given_documents(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in byte_pairs(spark, data).collect()), key=str) == wanted(rows)
