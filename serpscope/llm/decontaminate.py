"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of e edits is split into e + 1 pieces: in any passage within the
budget one of them is unchanged. An Aho-Corasick automaton over all pieces finds those in one pass
over a document, and the text around each hit is checked with Myers' bit-parallel edit distance.
Both sides are compared in lower case with single spaces for all that is no letter or digit.
"""

from __future__ import annotations

import math
import re
import uuid
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed for each character of an item.
RATE = 0.08
#: Characters of items that one automaton holds, and so one broadcast. Larger benchmarks are
#: searched in several passes.
BLOCK_CHARACTERS = 4_000_000

_WORDS = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    return " ".join(_WORDS.findall(text.lower())) if text else ""


def pieces(item: str, rate: float) -> list[tuple[int, str]]:
    """Offset and text of the pieces of a normalised item, one more than its error budget."""
    n = math.floor(rate * len(item)) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b]


class Pattern:
    """Myers' algorithm for one pattern: the best end of an approximate match in a text."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """Smallest edit distance of the pattern to any part of the text, and where it ends."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = full, 0, self.size
        best, end = score, 0
        for i, c in enumerate(text, 1):
            same = self.masks.get(c, 0)
            vertical = same | down
            flat = (((same & up) + up) ^ up) | same
            rise = down | (full & ~(flat | up))
            fall = up & flat
            score += bool(rise & top) - bool(fall & top)
            if score < best:
                best, end = score, i
            rise, fall = (rise << 1) & full, (fall << 1) & full
            up = fall | (full & ~(vertical | rise))
            down = rise & vertical
        return best, end


class Index:
    """Pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, t, math.floor(rate * len(t)), Pattern(t)) for i, t in items if t]
        where: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, _, _) in enumerate(self.items):
            for offset, piece in pieces(text, rate):
                where.setdefault(piece, []).append((at, offset))
        self.pieces = ahocorasick.Automaton()
        for piece, places in where.items():
            self.pieces.add_word(piece, (len(piece), places))
        self.pieces.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """Items found in a normalised text: id, distance, end of the match."""
        if not self.items:
            return []
        hits: dict[int, set[int]] = {}
        for last, (width, places) in self.pieces.iter(text):
            for at, offset in places:
                hits.setdefault(at, set()).add(last + 1 - width - offset)
        found = []
        for at, starts in hits.items():
            item_id, pattern, budget, search = self.items[at]
            best = (budget + 1, 0)
            for a, b in _ranges(sorted(starts), budget, len(pattern)):
                a = max(0, a)
                distance, end = search.best(text[a:b])
                best = min(best, (distance, a + end))
            if best[0] <= budget:
                found.append((item_id, *best))
        return found


def _ranges(starts: list[int], budget: int, size: int):
    """Parts of the text that can hold a match for these starts; overlapping ones are joined."""
    first, last = starts[0], starts[0]
    for start in starts[1:]:
        if start - budget > last + size + budget:
            yield first - budget, last + size + budget
            first = start
        last = start
    yield first - budget, last + size + budget


_indexes: dict[str, Index] = {}


def _index(key: str, block: Broadcast, rate: float) -> Index:
    """This worker's index of a block."""
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(block.value, rate)
    return _indexes[key]


def _search(key: str, block: Broadcast, rate: float):
    def run(batches):
        index = _index(key, block, rate)
        for batch in batches:
            rows = []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            ):
                rows += [(doc_id, *found) for found in index.search(normal(text))]
            columns = zip(*rows) if rows else ([] for _ in range(4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "item_id", "distance", "match_end"],
            )

    return run


def _without(key: str, block: Broadcast, rate: float):
    def run(batches):
        index = _index(key, block, rate)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield batch.filter(pa.array([not index.search(normal(t)) for t in texts], pa.bool_()))

    return run


def _blocks(items: DataFrame) -> list[tuple[str, Broadcast]]:
    """The items in blocks of bounded size, each broadcast under a name."""
    spark = items.sparkSession
    items = items.where("text is not null and item_id is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_CHARACTERS))
    found = []
    for i in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i)
        block = sorted((r["item_id"], normal(r["text"])) for r in own.collect())
        found.append((uuid.uuid4().hex, spark.sparkContext.broadcast(block)))
    return found


def benchmark_matches(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """Every benchmark item that a document holds within the error budget.

    docs: `doc_id`, `text`. items: `item_id`, `text`. Further columns are ignored. One row per
    document and item: `distance`, the fewest edits, and `match_end`, where that match ends in the
    normalised text. Documents without a match have no row.

    Null and empty texts and items match nothing. An item too short for a single edit must occur
    unchanged. Rows that share an id are reported for each. Empty tables have no matches.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = "doc_id long, item_id long, distance long, match_end long"
    found = [docs.mapInArrow(_search(*block, rate), kinds) for block in _blocks(items)]
    return reduce(DataFrame.unionByName, found)


def without_benchmark(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no benchmark item. Each row is judged
    by its own text, whatever ids it shares; nothing is shuffled."""
    for block in _blocks(items):
        docs = docs.mapInArrow(_without(*block, rate), docs.schema)
    return docs
