"""Cost-balanced packing of documents into sequences of bounded length.

A training step waits for its slowest sequence, so sequences should cost the same, not only hold
the same number of tokens. The cost of a document is linear in its length (projections, feed
forward) plus quadratic (attention within the document). Documents go, longest first, to the
sequence of lowest cost that still has room.

Documents longer than a sequence are cut into whole sequences and a rest. Rests are dealt by hash
into groups of a bounded number of tokens; each group is packed alone, so no task sees more than
its share. Only lengths and checksums are shuffled, never ids.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope.llm.tokens import WORD_BPE, encoder, groups_of, with_end
from serpscope.session import materialize

#: Tokens of a sequence.
LENGTH = 4096
#: Sequences that one group fills.
GROUP_SEQUENCES = 2048
#: Sequence ids set aside for a group.
GROUP_IDS = 1 << 24
#: Cost of a document of n tokens: n * LINEAR + n * n * QUADRATIC. At this ratio both parts are
#: equal at 8192 tokens.
LINEAR = 8192.0
QUADRATIC = 1.0

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(path: str, length: int):
    """Each document's pieces: whole sequences, then the rest."""

    def run(batches):
        own = encoder(path)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in groups_of(texts):
                rows = []
                for doc_id, tokens in zip(ids[a:b], own.encode(texts[a:b])):
                    tokens = with_end(tokens).astype("<u4")
                    for start in range(0, len(tokens), length):
                        piece = tokens[start : start + length]
                        crc = zlib.crc32(piece.tobytes())
                        rows.append((doc_id, start, len(piece), crc, len(tokens)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return run


def place(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; lengths descend.

    Pieces for which no sequence has room go, in the same order, into further sequences.
    """
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    waiting, base = np.arange(len(lengths)), 0
    while len(waiting):
        own = lengths[waiting]
        n = math.ceil(own.sum() / length)
        room = np.full(n, length, dtype=np.int64)
        cost = np.zeros(n)
        late = []
        for i, size in zip(waiting.tolist(), own.tolist()):
            at = int(np.where(room >= size, cost, np.inf).argmin())
            if room[at] < size:
                late.append(i)
                continue
            sequence[i], offset[i] = base + at, length - room[at]
            room[at] -= size
            cost[at] += LINEAR * size + QUADRATIC * size * size
        waiting, base = np.array(late, dtype=np.int64), base + n
    return sequence, offset


def _pack(length: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        keys = ["length", "doc_id", "start", "ids_crc32"]
        pieces = pieces.sort_values(keys, ascending=[False, True, True, True])
        sequence, offset = place(pieces["length"].to_numpy(), length)
        pieces["sequence_id"] = sequence + pieces["bin"].iloc[0] * GROUP_IDS
        pieces["offset"] = offset
        return pieces.drop(columns="bin")

    return run


def pack(docs: DataFrame, path: str = WORD_BPE, length: int = LENGTH) -> DataFrame:
    """Places every token of every document, and its end token, in one sequence.

    docs: `doc_id`, `text`; further columns are ignored. One row per piece: the piece (`start`,
    `length`, checksum of its ids), its document's length, and its place (`sequence_id`,
    `offset`, gapless from 0 within the sequence). Sequence ids are unique, not gapless.

    A null or empty text is its end token. Repeated rows are packed once each; rows without an id
    are packed like others. An empty table has no pieces.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialize(docs.mapInArrow(_pieces(path, length), PIECES), "packing-pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, math.ceil(total / (length * GROUP_SEQUENCES)))
    salt = F.xxhash64("doc_id", "start", "ids_crc32")
    return (
        pieces.withColumn("bin", F.pmod(salt, F.lit(groups)))
        .groupBy("bin")
        .applyInPandas(_pack(length), f"{PIECES}, sequence_id long, offset long")
    )
