"""Byte-level BPE by recursive queries of an in-process DuckDB in each task.

A word (a match of the vocabulary's pattern) starts as one row per byte: its id and its follower's,
its position and its follower's. Each step of the recursive query joins the rows to the table of
merges and contracts, in every word that still has one, the leftmost pair of the smallest rank: the
first row of the pair goes, the second takes the merged id, the row before now points to it. Words
without a pair are closed, and their rows are their tokens. Decoding joins ids to the vocabulary's bytes and aggregates them
in order of position.

A task sends each new word to the query once and remembers its ids, within a bound. Texts are cut
where a blank follows a character that is none: no match of the pattern reaches across such a place,
so a slice gives the matches of the whole.

The query takes one step per contraction, so its work grows with the square of a word's length.
Words beyond `LONG` bytes (none in running text) are contracted in the same order from a heap.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope.llm.tokens import groups_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Bytes of the longest word that the query contracts; its positions take one byte.
LONG = 160
#: Rows of all steps that one query may make: at most the sum of the words' squared lengths by 2.
STEP_ROWS = 2_000_000
#: Words a task remembers, and the length beyond which it doesn't.
REMEMBERED = 500_000
REMEMBERED_LENGTH = 64
#: Characters of text that are cut into words at a time, and tokens that are decoded at a time.
SLICE = 1_000_000
DECODED = 1_000_000

_CONTRACT = """
WITH RECURSIVE step(word, pos, next_pos, id, next_id, is_open) AS (
    SELECT word, pos, pos + 1, id,
           coalesce(lead(id) OVER (PARTITION BY word ORDER BY pos), -1), true
    FROM letters
    UNION ALL
    (
        WITH best AS (
            SELECT word, min((merged << 16) | (pos << 8) | next_pos) AS best
            FROM step JOIN merges ON id = a AND next_id = b
            WHERE is_open GROUP BY word
        )
        SELECT word, pos,
               CASE WHEN next_pos = ((best >> 8) & 255) THEN best & 255 ELSE next_pos END,
               CASE WHEN pos = (best & 255) THEN best >> 16 ELSE id END,
               CASE WHEN next_pos = ((best >> 8) & 255) THEN best >> 16 ELSE next_id END,
               best IS NOT NULL
        FROM step LEFT JOIN best USING (word)
        WHERE is_open AND pos IS DISTINCT FROM ((best >> 8) & 255)
    )
)
SELECT word, list(id ORDER BY pos) AS ids FROM step WHERE NOT is_open GROUP BY word ORDER BY word
"""

_DECODE = """
SELECT doc, list(bytes ORDER BY pos) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""


class Codec:
    """Encodes and decodes by a file of ranks."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.find = regex.compile(pattern).findall
        self.edge = regex.compile(r"(?<=\S)\s").search
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.known: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        self.db.execute("SET enable_progress_bar = false")
        merges = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if (left := self.ranks.get(token[:k])) is not None
            and (right := self.ranks.get(token[k:])) is not None
        ]
        self._table("merges", dict(zip("ab", np.array(merges).T[:2])) | {"merged": pa.array([m[2] for m in merges], pa.int64())})
        self._table("vocabulary", {"id": [*self.ranks.values()], "bytes": [*self.ranks]})

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of words, as bytes, from one recursive query."""
        size = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        start = np.repeat(np.cumsum(size) - size, size)
        letters = pa.table(
            {
                "word": pa.array(np.repeat(np.arange(len(words)), size)),
                "pos": pa.array(np.arange(len(flat)) - start),
                "id": pa.array(self.byte[flat].astype(np.int64)),
            }
        )
        self.db.register("letters", letters)
        found = self.db.sql(_CONTRACT).to_arrow_table().column("ids").combine_chunks()
        ids = found.values.to_numpy().astype("<u4").tobytes()
        ends = found.offsets.to_numpy() * 4
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _contract_long(self, word: bytes) -> bytes:
        """The same contractions for one long word: a heap of pairs over a linked list."""
        ids = self.byte[np.frombuffer(word, dtype=np.uint8)].tolist()
        text = [word[i : i + 1] for i in range(len(word))]
        n = len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i) for i in range(n - 1) if (r := self.ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if text[i] else n
            # A pair that was contracted otherwise meanwhile.
            if j >= n or self.ranks.get(text[i] + text[j]) != rank:
                continue
            text[i], text[j], ids[i] = text[i] + text[j], b"", rank
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    new = self.ranks.get(text[k] + text[after[k]])
                    if new is not None:
                        heapq.heappush(heap, (new, k))
        return np.array([i for i, t in zip(ids, text) if t], dtype="<u4").tobytes()

    def _learn(self, new: set[str]) -> None:
        short: list[tuple[str, bytes]] = []
        for word in new:
            raw = word.encode("utf-8", "replace")
            whole = self.ranks.get(raw)
            if whole is not None:
                self.known[word] = whole.to_bytes(4, "little")
            elif len(raw) > LONG:
                self.known[word] = self._contract_long(raw)
            else:
                short.append((word, raw))
        # Words of similar length together: a query has as many steps as its longest word.
        short.sort(key=lambda x: len(x[1]))
        at, rows = 0, 0
        for i, (_, raw) in enumerate(short):
            rows += len(raw) * (len(raw) + 1) // 2
            if rows >= STEP_ROWS or i + 1 == len(short):
                some = short[at : i + 1]
                self.known.update(zip((w for w, _ in some), self._contract([r for _, r in some])))
                at, rows = i + 1, 0

    def _slices(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SLICE:
            edge = self.edge(text, at + SLICE)
            if edge is None:
                break
            yield text[at : edge.start()]
            at = edge.start()
        yield text[at:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found = [[] for _ in texts]
        pending: list[tuple[int, str]] = []
        size = 0
        for k, text in enumerate(texts):
            for part in self._slices(text):
                pending.append((k, part))
                size += len(part)
                if size >= SLICE:
                    self._encode(pending, found)
                    pending, size = [], 0
        self._encode(pending, found)
        return [np.frombuffer(b"".join(parts), dtype="<u4") for parts in found]

    def _encode(self, pending: list[tuple[int, str]], found: list[list[bytes]]) -> None:
        cut = [self.find(part) for _, part in pending]
        seen = set().union(*cut)
        if len(self.known) + len(seen) > REMEMBERED:
            self.known.clear()
        new = seen - self.known.keys()
        self._learn(new)
        look = self.known.__getitem__
        for (k, _), words in zip(pending, cut):
            found[k].append(b"".join(map(look, words)))
        for word in new:
            if len(word) > REMEMBERED_LENGTH:
                del self.known[word]

    def decode(self, texts: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        """Bytes of each list of ids, in order, a long one in parts: (number of the list, bytes)."""
        some, n = [], 0
        for k, ids in enumerate(texts):
            for at in range(0, len(ids), DECODED):
                part = ids[at : at + DECODED]
                if n + len(part) > DECODED:
                    yield from self._decode(some)
                    some, n = [], 0
                some.append((k, part))
                n += len(part)
        yield from self._decode(some)

    def _decode(self, parts: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, bytes]]:
        if not parts:
            return
        size = np.array([len(p) for _, p in parts])
        flat = np.concatenate([p for _, p in parts]).astype(np.int32)
        tokens = pa.table(
            {
                "doc": pa.array(np.repeat(np.arange(len(parts), dtype=np.int32), size)),
                "pos": pa.array(np.arange(len(flat), dtype=np.int32)),
                "id": pa.array(flat),
            }
        )
        self.db.register("tokens", tokens)
        found = self.db.sql(_DECODE).to_arrow_table()
        at = found.column("doc").to_pylist()
        for chunk in found.column("bytes").chunks:
            ends = chunk.offsets.to_numpy()
            values = chunk.values
            offsets = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset :]
            data = values.buffers()[2]
            for i in range(len(chunk)):
                a, b = int(offsets[ends[i]]), int(offsets[ends[i + 1]])
                yield parts[at.pop(0)][0], data[a:b].to_pybytes()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str = RANKS, pattern: str = PATTERN) -> Codec:
    """This worker's codec."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


CODED = "doc_id long, ids binary, bytes binary"


def _round_trip(path: str, pattern: str):
    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in groups_of(texts):
                ids = own.encode(texts[a:b])
                back = [[] for _ in ids]
                for k, part in own.decode(ids):
                    back[k].append(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[a:b], pa.int64()),
                        pa.array([i.tobytes() for i in ids], pa.binary()),
                        pa.array([b"".join(parts) for parts in back], pa.binary()),
                    ],
                    ["doc_id", "ids", "bytes"],
                )

    return run


def round_trip(docs: DataFrame, path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Encodes every text and decodes its ids: `doc_id`, `ids` (little-endian unsigned 32-bit
    integers), `bytes` (decoded).

    docs: `doc_id`, `text`; further columns are ignored. A null or empty text has no ids. Strings of
    special tokens are ordinary text. Repeated rows and rows without an id are encoded like others;
    an empty table has no rows. Nothing is shuffled; a long text is cut into words by slices and
    decoded in parts, so a task holds one text with its ids, and else about two million characters.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_round_trip(path, pattern), CODED)


def coded_digests(coded: DataFrame) -> DataFrame:
    """Number of ids and checksums of both sides of `round_trip`."""
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
