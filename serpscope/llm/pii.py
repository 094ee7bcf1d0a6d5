"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over the whole text finds anchors: at-signs, plus signs,
digits, schemes and identifier cues. At each anchor a small parser looks only at the text around
it, finds where the value begins and ends, and checks it (labels of a domain, parts of an address,
Luhn and mod-97 check digits). Text without anchors is never looked at twice.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans of one start are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "login", "account", "secret")
BASE = KINDS[:4]
#: Documents whose results are handed on together.
SLICE = 1000

# Fixed: what each kind is made of.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"://[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")
_ASSIGNMENT = re.compile(r"['\"]?\s?[:=]\s?['\"]?")
_ASSIGNED = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_ACCOUNT = re.compile(r"[\s:#.]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
_SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key")
_ACCOUNT_CUES = ("iban", "account")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cues, kind in ((_SECRET_CUES, "secret"), (_ACCOUNT_CUES, "account")):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(cue)))
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def valid_iban(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def find(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in code points, by start, then in the order of KINDS."""
    spans: list[tuple[int, int, str]] = []
    #: Where the next match of a kind may begin.
    free = dict.fromkeys((*KINDS, "dotted", "grouped"), 0)

    def add(kind: str, start: int, end: int) -> None:
        spans.append((start, end, kind))
        free[kind] = end

    for last, (anchor, width) in _ANCHORS.iter(text):
        at = last - width + 1
        if anchor == "digit":
            if at >= free["dotted"]:
                chain = _DOTTED.match(text, at)
                free["dotted"] = chain.end()
                parts, start = chain.group().split("."), at
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i : i + 4]
                    end = start + sum(map(len, four)) + 3
                    if all(map(_small, four)):
                        add("ip", start, end)
                    start = end + 1
            if at >= free["grouped"]:
                chain = _GROUPED.match(text, at)
                free["grouped"] = chain.end() if chain else at + 1
                if chain:
                    digits = chain.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        add("card", at, chain.end())
        elif anchor == "at":
            start = at
            while start > free["email"] and text[start - 1] in _LOCAL:
                start -= 1
            domain = _DOMAIN.match(text, at + 1)
            if start < at and domain:
                add("email", start, domain.end())
        elif anchor == "plus":
            dialled = _DIALLED.match(text, at)
            if dialled and 10 <= sum(c.isdigit() for c in dialled.group()) <= 15:
                add("phone", at, dialled.end())
        elif anchor == "scheme":
            login, start = _LOGIN.match(text, at), at
            while start > free["login"] and text[start - 1].isalpha():
                start -= 1
            if login and start < at:
                add("login", start, login.end())
        elif anchor == "secret":
            lead = _ASSIGNMENT.match(text, last + 1)
            # Values run on over further cues, so each is read once.
            if lead and lead.end() >= free["secret"]:
                value = _ASSIGNED.match(text, lead.end())
                if value:
                    add("secret", *value.span())
        elif anchor == "account":
            value = _ACCOUNT.match(text, last + 1)
            # The longest valid beginning: words after the number may look like its last groups.
            for end in range(value.end(1), value.start(1) + 14, -1) if value else ():
                own = text[value.start(1) : end].replace(" ", "")
                if text[end - 1] != " " and 15 <= len(own) <= 34 and valid_iban(own):
                    add("account", value.start(1), end)
                    break
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def redact(text: str) -> str:
    """The text with each span, or group of overlapping spans, as its first kind in brackets."""
    out, done = [], 0
    for start, end, kind in find(text):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string"
)


def _find(batches):
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), SLICE):
            some = batch.slice(at, SLICE)
            rows = []
            for doc_id, text in zip(
                some.column("doc_id").to_pylist(), some.column("text").to_pylist()
            ):
                spans = find(text or "")
                count = [sum(s[2] == kind for s in spans) for kind in BASE]
                base = _listed([s for s in spans if s[2] in BASE]).encode()
                rows.append((doc_id, *count, hashlib.sha256(base).hexdigest(), _listed(spans)))
            columns = zip(*rows) if rows else ([] for _ in names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names
            )


def personal_data(docs: DataFrame) -> DataFrame:
    """All personal data of every document.

    docs: `doc_id`, `text`; further columns are ignored. One row per input row: how many of each
    base kind, the SHA-256 of the base spans, and all spans as kind:start:end. Base kinds are
    email, ip, card and phone; added are logins in addresses, account numbers after a cue with
    valid check digits, and secrets assigned to a cue.

    A null text is empty and has no spans. Repeated rows and rows without an id are searched like
    others. Each text is read once from left to right, however long. An empty table has no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_find, FOUND)


def _redact(batches):
    for batch in batches:
        texts = [None if t is None else redact(t) for t in batch.column("text").to_pylist()]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, pa.string()))


def redacted(docs: DataFrame) -> DataFrame:
    """The same rows and columns with personal data in `text` replaced; null stays null."""
    return docs.mapInArrow(_redact, docs.schema)
