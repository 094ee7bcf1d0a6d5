import pytest
from brute import documents, windows_removed
from texts import corpus  # noqa: F401

from serpscope.llm import common, substring
from serpscope.llm.substring import substring_dedup

COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize("width", [5, 13])
def test_equals_brute_force(spark, corpus, width):
    rows = [*corpus, (None, corpus[0][1]), (None, None)]
    found = substring_dedup(documents(spark, rows), width).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=key) == sorted(windows_removed(rows, width), key=key)


def test_repeated_rows_are_no_copies_of_each_other(spark, corpus):
    rows = [corpus[3], corpus[3], corpus[25], corpus[25]]
    found = substring_dedup(documents(spark, rows)).collect()
    assert len(found) == 4 and all(r["n_removed"] == 0 for r in found)


def test_factors_stand_whole_in_their_source(spark, corpus):
    a = [f"a{i}" for i in range(1, 15)]
    split = " ".join([*a[:13], "zz", *a[1:]])
    texts = dict(corpus) | {400: split, 401: " ".join(a)}
    whole = 0
    for row in substring_dedup(documents(spark, [*texts.items()])).collect():
        words, gone = (texts[row["doc_id"]] or "").encode().split(), set()
        for start, end, source, there in row["factors"]:
            other = (texts[source] or "").encode().split()
            assert source < row["doc_id"] and end - start >= 13
            assert words[start:end] == other[there : there + end - start]
            gone.update(range(start, end))
            whole += end - start > 13
        kept = [w.decode() for i, w in enumerate(words) if i not in gone]
        assert row["kept_text"] == " ".join(kept)
        assert len(gone) == row["n_removed"] and len(words) == row["n_words"]
        if row["doc_id"] == 401:
            assert [tuple(f)[2:] for f in row["factors"]] == [(400, 0), (400, 14)]
    assert whole > 20


def test_slices_change_nothing(spark, corpus, monkeypatch):
    want = windows_removed(corpus, 13)
    for module, name, value in ((common, "HASHED_AT_ONCE", 50), (substring, "TOGETHER", 300)):
        monkeypatch.setattr(module, name, value)
        given = [t.encode() if t is not None else None for _, t in corpus]
        hashes, begin = common.hash_words(given)
        monkeypatch.undo()
        assert hashes.tolist() == [h for t in given for h in common.word_hashes(t).tolist()]
        assert begin.tolist()[-1] == sum(r[1] for r in want)
    texts = substring.Texts(given, 13)
    first, count, anchor, block = texts.blocks()
    alone = [substring.Texts([t], 13).blocks() for t in given]
    for k, whole in enumerate((count, anchor, block), 1):
        assert whole.tolist() == [v for one in alone for v in one[k].tolist()]


def test_empty_table(spark):
    assert substring_dedup(documents(spark, [])).count() == 0
