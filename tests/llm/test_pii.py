import hashlib
import time

from brute import base_spans, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import corpus  # noqa: F401

from serpscope.llm import pii


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="aZ0129@.+-_%() é\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.find(text) if s[2] in pii.BASE] == base_spans(text)


def test_cards_and_phones_equal_the_patterns():
    texts = [
        "4111 1111 1111 1111 4111-1111-1111-1111",
        "x4111111111111111,0004111111111111111 +1 (132) 555-1352 Bebe +1.2",
        "1.2.3.4.5.6.7.8 300.1.1.1.2.3.4.5 001.02.3.255 " + "9" * 4000 + ".1.1.1",
        "a@b a@b.c@d.e @x.y é.55@mail4.example.com+33 1 23 45 67 89",
    ]
    for text in texts:
        assert [s for s in pii.find(text) if s[2] in pii.BASE] == base_spans(text)


def test_added_kinds_need_a_cue_and_pass_their_checks():
    text = (
        'token = "24be64439e3e49cf46b2d7c90f3602a3" IBAN GB82 WEST 1234 5698 7654 32 and '
        "account: GB83 WEST 1234 5698 7654 32 then https://me:pw@host.org/x https://host.org"
    )
    found = {(kind, text[a:b]) for a, b, kind in pii.find(text)}
    assert found == {
        ("secret", "24be64439e3e49cf46b2d7c90f3602a3"),
        ("account", "GB82 WEST 1234 5698 7654 32"),
        ("login", "https://me:pw@host.org"),
        ("email", "pw@host.org"),
    }


def test_redaction_leaves_no_base_span(spark):
    rows = [(1, "mail a.b@c.de, ip 10.0.0.1!"), (2, None), (3, "clean text"), (4, "")]
    got = {r["doc_id"]: r for r in pii.redacted(documents(spark, rows)).collect()}
    assert got[1]["text"] == "mail [EMAIL], ip [IP]!"
    assert (got[2]["text"], got[3]["text"], got[4]["text"]) == (None, "clean text", "")
    assert got[1]["packed"] == "x" and got[1]["label"] == 2


def test_table(spark, corpus):
    rows = [*corpus, (None, "1.2.3.4"), (400, "a@b.cd " * 3000), (400, "a@b.cd " * 3000)]
    got = pii.personal_data(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    long = [r for r in got if r["doc_id"] == 400]
    assert [r["n_email"] for r in long] == [3000, 3000]
    want = ",".join(f"{k}:{a}:{b}" for a, b, k in base_spans("a@b.cd " * 3000))
    assert long[0]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    empty = next(r for r in got if r["doc_id"] == 300)
    assert empty["spans"] == "" and empty["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(documents(spark, [])).count() == 0


def test_cues_that_run_on_take_linear_time():
    """Each of these has a cue or anchor every few characters, in one run without end."""
    for unit in ("token=", "://a", "a@", "+1", "1.", "1-", "iban AB12", "a.b@c."):
        start = time.process_time()
        pii.find(unit * 40_000)
        assert time.process_time() - start < 5
    assert [s for s in pii.find("token=" * 4) if s[2] == "secret"] == [(6, 24, "secret")]
