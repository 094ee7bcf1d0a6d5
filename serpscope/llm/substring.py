"""Substring dedup by relative parsing: documents are factored against all earlier ones.

The reference of a document is every document with a smaller id. It is indexed in blocks that
content defines: each window of `width` words has one anchor, its smallest hash of `ANCHOR` words,
and the windows in a row that share an anchor form a block. Equal passages fall into equal blocks
but for those at their ends, so a document is parsed in two steps:

1. Whole blocks. A block whose anchor occurs with no other surroundings anywhere is found by the
   anchor alone; its source is the first place of the first document that has it.
2. Factor boundaries. Where an anchor occurs with different surroundings, a factor may begin or
   end inside the block; only there are the single windows looked up.

The parse is greedy from left to right: a factor goes on as long as the next window continues at the
next place of the same source, so each factor is a run of words that stands in its source as a
whole, and as every window is at least `width` words, each is long enough to be a duplicate span.

Anchors and windows are combined before each shuffle (minimum and maximum per key), and the joins
back can be split, so a passage in a third of all documents is no hot spot. No task sees two
documents of one passage for the other's sake: documents are hashed together only to save calls.

Words, anchors, blocks and windows are told apart by 64-bit hashes. Two different ones are equal with
a chance of 2**-64 a pair; a run over 10**9 windows expects 0.03 such pairs, each of which could
remove one window wrongly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope.llm.common import Spans, hash_words, signed
from serpscope.session import materialize, release

#: Words of an anchor. Longer ones are rarer in running text, but more of them are needed.
ANCHOR = 4
#: In place of a source.
NONE = np.iinfo(np.int64).min
#: Bytes of the texts that are hashed together; a longer text is hashed alone.
TOGETHER = 1 << 20
#: Bytes of a row group of written texts.
ROW_GROUP = 8 << 20
#: Bits of a word's place beside its anchor's order; the others are of the hash.
PLACE_BITS = 30


class Texts:
    """Some texts with the hashes of their words, as one sequence."""

    def __init__(self, texts: list[bytes | None], width: int):
        self.width = width
        hashes, self.begin = hash_words(texts)
        self.n = np.diff(self.begin)
        self.spans = Spans(hashes)
        # Windows that lie within one text.
        start = np.arange(max(0, len(hashes) - width + 1))
        self.text_of = np.repeat(np.arange(len(texts)), self.n)
        self.windows = start[self.text_of[: len(start)] == self.text_of[width - 1 :]]

    def blocks(self) -> tuple[np.ndarray, ...]:
        """First window, number of windows, anchor hash and block hash of each block."""
        windows = self.windows
        if not len(windows):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none.view(np.uint64), none.view(np.uint64)
        grams = self.spans.grams(ANCHOR)
        # The first of the smallest hashes, by one minimum over (hash, place).
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        reach, have = self.width - ANCHOR + 1, 1
        while have < reach:
            step = min(have, reach - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        place = (least[windows] & low).astype(np.int64)
        edge = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        count = np.diff(np.concatenate((edge, [len(place)])))
        first = windows[edge]
        block = self.spans.of(first, first + count + self.width - 1)
        return first, count, grams[place[edge]], block

    def place(self, at: np.ndarray) -> np.ndarray:
        """Places within their texts."""
        return (at - self.begin[self.text_of[at]]).astype(np.int32)

    def window_hashes(self, at: np.ndarray) -> np.ndarray:
        return self.spans.of(at, at + self.width)


def _together(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about TOGETHER bytes, one text at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= TOGETHER:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _first_of_each(text_of: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands first in each text."""
    order = np.lexsort((keys, text_of))
    text_of, keys = text_of[order], keys[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (text_of[1:] != text_of[:-1]) | (keys[1:] != keys[:-1])
    return order[new]


def _anchors(width: int, with_block: bool):
    """Distinct anchors of each document, with or without the block around them and its place."""

    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            ids = batch.column("doc_id").to_numpy()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for a, b in _together([len(t or b"") for t in texts]):
                some = Texts(texts[a:b], width)
                first, _, anchor, block = some.blocks()
                own = some.text_of[first]
                at = _first_of_each(own, block if with_block else anchor)
                found = {"anchor": signed(anchor[at]), "doc_id": ids[a:b][own[at]]}
                if with_block:
                    found |= {"place": some.place(first[at]), "block": signed(block[at])}
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.values()], [*found])

    return run


def _packed(batches):
    """Texts compressed for the shuffle, with their length."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        packed = [None if t is None else press.compress(t) for t in texts]
        size = [len(t or b"") for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(packed, pa.binary())],
            ["doc_id", "size", "packed"],
        )


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, list, Texts]]:
    """Slices of a batch with their texts."""
    press = zstandard.ZstdDecompressor()
    for a, b in _together(batch.column("size").to_pylist()):
        some = batch.slice(a, b - a)
        texts = [press.decompress(p) if p else b"" for p in some.column("packed").to_pylist()]
        yield some, texts, Texts(texts, width)


def _values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """All values of a column of lists."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def _open_windows(width: int):
    """The windows in blocks whose anchor has other surroundings elsewhere.

    Whether an anchor is open does not depend on the document, so one list serves a slice.
    """

    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column("open").is_valid())
            for some, _, texts in _unpacked(batch, width):
                _, count, anchor, _ = texts.blocks()
                is_open = np.isin(signed(anchor), _values(some, "open"))
                at = texts.windows[np.repeat(is_open, count)]
                keys, own = texts.window_hashes(at), texts.text_of[at]
                new = _first_of_each(own, keys)
                ids = some.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(keys[new])),
                        pa.array(ids[own[new]]),
                        pa.array(texts.place(at[new])),
                    ],
                    ["window", "doc_id", "place"],
                )

    return run


def _lookup(keys: np.ndarray, batch: pa.RecordBatch, names: tuple[str, str, str]):
    """Source and place of each key, NONE where it has none. A key's source is the same in all lists."""
    source, place = (np.full(len(keys), NONE, dtype=np.int64) for _ in range(2))
    known, at = np.unique(_values(batch, names[0]), return_index=True)
    if len(known):
        found = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        same = known[found] == keys
        at = at[found[same]]
        source[same] = _values(batch, names[1])[at]
        place[same] = _values(batch, names[2])[at]
    return source, place


FACTORED = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, "
    "factors array<struct<start:long,end:long,source:long,source_start:long>>"
)
_FACTOR = pa.struct([(c, pa.int64()) for c in ("start", "end", "source", "source_start")])
_FACTORED = pa.schema(
    [
        *((c, pa.int64()) for c in ("doc_id", "n_words", "n_removed")),
        *((c, pa.string()) for c in ("kept_sha256", "kept_text")),
        ("factors", pa.list_(_FACTOR)),
    ]
)


def _copied(some: pa.RecordBatch, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Source and place there of each window, NONE where no earlier document has it."""
    first, count, anchor, _ = texts.blocks()
    source, place = _lookup(signed(anchor), some, ("whole", "whole_source", "whole_place"))
    source, place = np.repeat(source, count), np.repeat(place, count)
    place = place + texts.windows - np.repeat(first, count)
    left = np.flatnonzero(source == NONE)
    if len(left) and len(_values(some, "windows")):
        keys = signed(texts.window_hashes(texts.windows[left]))
        names = ("windows", "window_source", "window_place")
        source[left], place[left] = _lookup(keys, some, names)
    ids = some.column("doc_id").fill_null(NONE).to_numpy()
    # A slice's lists name sources for documents that come before them, too.
    source[source >= ids[texts.text_of[texts.windows]]] = NONE
    return source, place


def _factors(source: np.ndarray, place: np.ndarray, texts: Texts) -> np.ndarray:
    """Rows (text, start, end, source, start there): the greedy parse of all texts."""
    at = texts.windows
    own = texts.text_of[at]
    same = (source[1:] == source[:-1]) & (place[1:] == place[:-1] + 1) & (own[1:] == own[:-1])
    edge = np.concatenate(([0], np.flatnonzero(~same) + 1))
    last = np.concatenate((edge[1:], [len(at)])) - 1
    found = source[edge] != NONE
    edge, last = edge[found], last[found]
    start = texts.place(at[edge]).astype(np.int64)
    return np.stack([own[edge], start, start + last - edge + texts.width, source[edge], place[edge]], 1)


def _factor(width: int, keep_text: bool):
    def run(batches):
        for batch in batches:
            for some, raw, texts in _unpacked(batch, width):
                gone = np.zeros(len(texts.text_of) + 1, dtype=np.int64)
                rows = np.zeros((0, 5), dtype=np.int64)
                if len(texts.windows):
                    source, place = _copied(some, texts)
                    rows = _factors(source, place, texts)
                    start = texts.begin[rows[:, 0]]
                    np.add.at(gone, start + rows[:, 1], 1)
                    np.add.at(gone, start + rows[:, 2], -1)
                left = np.cumsum(gone[:-1]) == 0
                cuts = np.searchsorted(rows[:, 0], np.arange(len(raw) + 1))
                out = []
                for i, doc_id in enumerate(some.column("doc_id").to_pylist()):
                    words = raw[i].split()
                    own = left[texts.begin[i] : texts.begin[i + 1]]
                    if cuts[i] < cuts[i + 1]:
                        words = list(compress(words, own.tolist()))
                    kept = b" ".join(words)
                    factors = rows[cuts[i] : cuts[i + 1], 1:].tolist()
                    out.append(
                        {
                            "doc_id": doc_id,
                            "n_words": len(own),
                            "n_removed": len(own) - len(words),
                            "kept_sha256": hashlib.sha256(kept).hexdigest(),
                            "kept_text": kept.decode("utf-8", "replace") if keep_text else None,
                            "factors": [
                                dict(zip(("start", "end", "source", "source_start"), f)) for f in factors
                            ],
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, _FACTORED)

    return run


def substring_dedup(docs: DataFrame, width: int = 13, keep_text: bool = True) -> DataFrame:
    """Removes each word in a window of `width` words that also starts in an earlier document.

    docs: `doc_id`, `text`; further columns are ignored. One row per input row: the number of words
    and of removed ones, the kept words joined by a space (`kept_text`, its SHA-256), and the
    `factors`: word ranges with the earlier document they are copied from and where they start there.

    A null text counts as empty. Texts shorter than a window keep all words. Rows without an id
    are neither compared nor changed. Rows that share an id are not copies of each other; should
    they differ, a factor's place may be in any of them. Windows are judged on the input, not on
    what is left of other documents. Long texts are hashed by slices. An empty table has no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = docs.mapInArrow(_anchors(width, True), "anchor long, doc_id long, place int, block long")
    shared = (
        placed.groupBy("anchor")
        .agg(
            F.min("doc_id").alias("first"),
            F.min_by("place", "doc_id").alias("place"),
            F.max("doc_id").alias("last"),
            F.min("block").alias("low"),
            F.max("block").alias("high"),
        )
        .where("first < last")
        .select("anchor", "first", "place", (F.col("low") != F.col("high")).alias("is_open"))
    )
    # Each step is written, so that the shuffles before it can go.
    shared = materialize(shared, "substring-anchors")
    release(spark)
    verdicts = (
        docs.mapInArrow(_anchors(width, False), "anchor long, doc_id long")
        .join(shared, "anchor")
        .where("is_open or first < doc_id")
        .groupBy("doc_id")
        .agg(
            F.collect_list(F.expr("if(is_open, anchor, null)")).alias("open"),
            F.collect_list(F.expr("if(is_open, null, struct(anchor, first, place))")).alias("whole"),
        )
    )
    judged = docs.mapInArrow(_packed, "doc_id long, size long, packed binary")
    judged = judged.join(verdicts, "doc_id", "left").select(
        "doc_id",
        "size",
        "packed",
        "open",
        F.col("whole.anchor").alias("whole"),
        F.col("whole.first").alias("whole_source"),
        F.col("whole.place").alias("whole_place"),
    )
    # Writers buffer a row group for each task.
    judged = materialize(judged, "substring-verdicts", **{"parquet.block.size": ROW_GROUP})
    release(spark)
    windows = judged.where("size(open) > 0").mapInArrow(
        _open_windows(width), "window long, doc_id long, place int"
    )
    first = windows.groupBy("window").agg(
        F.min("doc_id").alias("first"),
        F.min_by("place", "doc_id").alias("place"),
        F.max("doc_id").alias("last"),
    )
    first = materialize(first.where("first < last").drop("last"), "substring-windows")
    release(spark)
    copies = (
        windows.drop("place")
        .join(first, "window")
        .where("first < doc_id")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("window", "first", "place")).alias("copies"))
        .select(
            "doc_id",
            F.col("copies.window").alias("windows"),
            F.col("copies.first").alias("window_source"),
            F.col("copies.place").alias("window_place"),
        )
    )
    return judged.join(copies, "doc_id", "left").mapInArrow(_factor(width, keep_text), FACTORED)
