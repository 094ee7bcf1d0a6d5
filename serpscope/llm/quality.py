"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of which only the bag is labelled: one page of junk can spoil a
document of many pages. Every passage is encoded, gated attention decides from the document labels
which passages matter, and the document's score is read off their weighted mean.

The model is fitted on the driver from the passages of a bounded sample of labelled documents and
is then applied to the whole text of every document, each in its place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope.llm.common import Spans, word_hashes

#: Words of a passage.
PASSAGE = 64
#: Labelled documents that the model is fitted on at most, and their passages together. Documents
#: are drawn by hash; those that no longer fit the second bound are passed over.
SAMPLE_DOCUMENTS = 4000
SAMPLE_PASSAGES = 80_000
#: Buckets of hashed words, units of the encoder and of the attention.
BUCKETS, HIDDEN, ATTENTION = 32, 24, 12
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.01, 1e-4
#: Score from which a document counts as good.
GOOD = 0.3

# Kinds of bytes: each mark that junk is made of by itself, the rest in groups.
_MARKS = b"!?#$%&*|.,;:@=<>\"'()-_/\\"
_KINDS = np.zeros(256, dtype=np.int64)
for _group, _members in enumerate(
    (range(128, 256), range(65, 91), range(97, 123), range(48, 58), (10, 13), (9, 32)), 1
):
    _KINDS[list(_members)] = _group
_KINDS[list(_MARKS)] = np.arange(7, 7 + len(_MARKS))
_N_KINDS = 7 + len(_MARKS)
_SOLID = np.ones(256, dtype=bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
FEATURES = _N_KINDS + 7 + BUCKETS


#: Passages whose bytes are counted at a time, to bound memory for very long texts.
COUNTED = 2000


def passages(text: bytes | None) -> np.ndarray:
    """One row of features for each passage of a text; an empty text is one empty passage."""
    text = text or b""
    codes = np.frombuffer(text, dtype=np.uint8)
    hashes = word_hashes(text)
    n = len(hashes)
    if not n:
        return np.zeros((1, FEATURES), dtype=np.float32)
    solid = np.zeros(len(codes) + 2, dtype=bool)
    solid[1:-1] = _SOLID[codes]
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edge[::2], edge[1::2]
    own = np.arange(n) // PASSAGE
    count = own[-1] + 1
    words = np.bincount(own)
    # Bytes belong to the passage of the word they follow.
    kinds = np.zeros(count * _N_KINDS)
    for a in range(0, n, PASSAGE * COUNTED):
        begin = start[a : a + PASSAGE * COUNTED + 1]
        end_byte = begin[-1] if len(begin) > PASSAGE * COUNTED else len(codes)
        begin = begin[: PASSAGE * COUNTED]
        at = np.repeat(own[a : a + len(begin)] - own[a], np.diff(begin, append=end_byte))
        found = np.bincount(at * _N_KINDS + _KINDS[codes[begin[0] : end_byte]])
        kinds[own[a] * _N_KINDS : own[a] * _N_KINDS + len(found)] += found
    kinds = kinds.reshape(count, _N_KINDS)
    size = (end - start).astype(np.float64)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(own, weights=values, minlength=count) / words

    # Words and runs of four words that occur before in the document, and the same word again.
    _, first = np.unique(hashes, return_index=True)
    seen = np.ones(n)
    seen[first] = 0
    again = np.zeros(n)
    again[1:] = hashes[1:] == hashes[:-1]
    runs = np.zeros(n)
    grams = Spans(hashes).grams(4)
    if len(grams):
        _, first = np.unique(grams, return_index=True)
        runs[: len(grams)] = 1
        runs[first] = 0
    buckets = np.bincount(own * BUCKETS + (hashes % BUCKETS).astype(np.int64), minlength=count * BUCKETS)
    rows = np.concatenate(
        (
            np.sqrt(kinds / kinds.sum(axis=1, keepdims=True)),
            np.stack(
                (
                    np.log1p(mean(size)),
                    np.log1p(mean(size * size)),
                    mean(size <= 3),
                    mean(seen),
                    mean(again),
                    mean(runs),
                    np.log1p(words) / 4,
                ),
                axis=1,
            ),
            np.sqrt(buckets.reshape(count, BUCKETS) / words[:, None]),
        ),
        axis=1,
    )
    return rows.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights by name, and the scale of the features."""

    weights: dict[str, np.ndarray]
    center: np.ndarray
    scale: np.ndarray

    def scores(self, rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Probability of good quality; `start` holds the first passage of each document."""
        return _forward(self.weights, (rows - self.center) / self.scale, start)["p"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, start: np.ndarray) -> dict:
    size = np.diff(start, append=len(x))
    h = np.tanh(x @ w["encode"] + w["encode0"])
    t, g = np.tanh(h @ w["content"]), _sigmoid(h @ w["gate"])
    raw = (t * g) @ w["attend"]
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, start), size))
    a = raw / np.repeat(np.add.reduceat(raw, start), size)
    z = np.add.reduceat(a[:, None] * h, start)
    p = _sigmoid(z @ w["read"] + w["read0"])
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": p, "size": size}


def _gradient(w: dict, x: np.ndarray, start: np.ndarray, y: np.ndarray) -> dict:
    """Of the mean cross entropy."""
    f = _forward(w, x, start)
    d = (f["p"] - y) / len(y)
    dz = np.repeat(d[:, None] * w["read"], f["size"], axis=0)
    da = (dz * f["h"]).sum(axis=1)
    mean = np.repeat(np.add.reduceat(f["a"] * da, start), f["size"])
    draw = (f["a"] * (da - mean))[:, None]
    t, g, h = f["t"], f["g"], f["h"]
    dt = draw * w["attend"] * g * (1 - t * t)
    dg = draw * w["attend"] * t * g * (1 - g)
    dh = f["a"][:, None] * dz + dt @ w["content"].T + dg @ w["gate"].T
    dx = dh * (1 - h * h)
    return {
        "encode": x.T @ dx,
        "encode0": dx.sum(axis=0),
        "content": h.T @ dt,
        "gate": h.T @ dg,
        "attend": (draw * t * g).sum(axis=0),
        "read": f["z"].T @ d,
        "read0": d.sum(keepdims=True),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Trains with Adam on bags of passages; the same bags in the same order give the same model."""
    rng = np.random.default_rng(seed)
    rows = np.concatenate(bags).astype(np.float64)
    center, scale = rows.mean(axis=0), rows.std(axis=0) + 0.05
    bags = [((b - center) / scale).astype(np.float32) for b in bags]
    shapes = {
        "encode": (FEATURES, HIDDEN),
        "encode0": (HIDDEN,),
        "content": (HIDDEN, ATTENTION),
        "gate": (HIDDEN, ATTENTION),
        "attend": (ATTENTION,),
        "read": (HIDDEN,),
        "read0": (1,),
    }
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) * (k[-1] != "0") for k, s in shapes.items()}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    moved = {k: np.zeros_like(v) for k, v in w.items()}
    spread = {k: np.zeros_like(v) for k, v in w.items()}
    labels = labels.astype(np.float32)
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            size = [len(bags[i]) for i in some]
            start = np.cumsum([0, *size[:-1]])
            found = _gradient(w, np.concatenate([bags[i] for i in some]), start, labels[some])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, d in found.items():
                d = d + DECAY * w[k]
                moved[k] = 0.9 * moved[k] + 0.1 * d
                spread[k] = 0.999 * spread[k] + 0.001 * d * d
                near = moved[k] / (1 - 0.9**step)
                w[k] = w[k] - rate * near / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8)
    return Model(w, center, scale)


def held_out(doc_id) -> F.Column:
    """Documents that no model may learn from: a fifth, by checksum of the id as text."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0


def drawn(docs: DataFrame, labels: DataFrame, label: str, n: int) -> DataFrame:
    """At most n labelled documents that may be learnt from, drawn by hash, with their label.

    Only the ids of the sample are broadcast. Of rows that share an id the least text is taken.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
    known = known.where("doc_id is not null and label is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # One row of each id, so that the sample's bounds hold whatever repeats.
    drawn = docs.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label")
    return drawn.agg(F.min("text").alias("text"))


def _encode(batches):
    for batch in batches:
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            rows = passages(text)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(i, 1),
                    "label": batch.column("label").slice(i, 1).cast(pa.float64()),
                    "n": pa.array([len(rows)], pa.int64()),
                    "rows": pa.array([rows.astype("<f2").tobytes()], pa.binary()),
                }
            )


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model from the labelled documents among `docs`; None if there are none."""
    sample = drawn(docs, labels, "quality", SAMPLE_DOCUMENTS)
    coded = sample.mapInArrow(_encode, "doc_id long, label double, n long, rows binary")
    sizes = coded.groupBy("doc_id").agg(F.max("n").alias("n"))
    fits, total = [], 0
    for row in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if total + row["n"] <= SAMPLE_PASSAGES:
            fits.append(row["doc_id"])
            total += row["n"]
    found = coded.where(F.col("doc_id").isin(fits)).collect() if fits else []
    found = sorted(found, key=lambda r: (r["doc_id"], r["rows"]))
    if not found:
        return None
    bags = [np.frombuffer(r["rows"], "<f2").reshape(-1, FEATURES).astype(float) for r in found]
    return fit(bags, np.array([r["label"] for r in found]))


def _scores(model: Model | None, texts: list[bytes | None]) -> np.ndarray:
    scores = [np.zeros(0)]
    for at in range(0, len(texts), 256):
        bags = [passages(t) for t in texts[at : at + 256]]
        start = np.cumsum([0, *(len(b) for b in bags[:-1])])
        if model is None:
            scores.append(np.full(len(bags), 0.5))
        else:
            scores.append(model.scores(np.concatenate(bags).astype(float), start))
    return np.concatenate(scores)


def _score(model: Model | None):
    def run(batches):
        for batch in batches:
            score = pa.array(_scores(model, batch.column("text").cast(pa.binary()).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], ["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of every document, learnt from `labels.quality`.

    docs: `doc_id`, `text`. labels: `doc_id`, `quality` (1 good, 0 bad). Further columns are
    ignored. One row per input row: `held_out`, `score` (0 to 1, higher: good is likelier) and
    `predicted` (1 from a score of GOOD). Only the text decides the score.

    Null and empty texts are one empty passage and get its score. Rows without an id are scored and
    are not held out. Repeated rows get equal scores; the model learns from one row of each id.
    Long texts are read by slices. Without any labelled document every score is 0.5; an empty table
    has no rows.
    """
    model = train(docs, labels)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = docs.mapInArrow(_score(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that the classifier does not reject. Each row is
    judged by its own text, whatever ids it shares; nothing is shuffled."""
    model = train(docs, labels)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array(_scores(model, texts) >= GOOD))

    return docs.mapInArrow(run, docs.schema)
