"""Toxicity categories by a classifier chain.

Categories are predicted one after the other. The model of each is linear in the words of the
document and in the log odds that the models before it gave. While the chain is trained those come
from models that have not seen the document (out-of-fold), as they will when it is applied, so a
later model does not trust the earlier ones more than they deserve.

The chain is fitted on the driver from a bounded sample of labelled documents and applied to the
whole text of every document, each in its place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serpscope.llm.common import BASE, mix, word_hashes
from serpscope.llm.quality import drawn, held_out

#: Labelled documents that the chain is fitted on at most.
SAMPLE_DOCUMENTS = 8000
#: Distinct words of the sample, all documents together, that reach the driver at most. Documents
#: are drawn by hash; those that no longer fit are passed over.
SAMPLE_WORDS = 6_000_000
#: Bytes of the beginnings of words that are looked at besides whole words.
BEGINNINGS = (4, 5, 6)
#: Words are told apart by hash.
SLOTS = 1 << 20
#: Words that a chain looks at: those most associated with its labels.
WORDS = 192
#: Slots that are looked at for these, and the chi-square that one must add.
#: Among a million slots some reach 40 by chance.
CANDIDATES, LEAST_GAIN = 3000, 45.0
#: Slots that are kept whatever they add, for very small samples.
LEAST_SLOTS = 12
FOLDS, RIDGE, STEPS = 5, 0.3, 12
#: Probability from which a document belongs to a category.
LIMIT = 0.6
#: The categories, in the order of the chain.
CATEGORIES = ("insult", "severe", "toxic")

# Letters in lower case; all other ASCII separates words.
_LETTERS = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def words(text: bytes | None) -> np.ndarray:
    """Sorted distinct slots of the words of a text and of their beginnings, case and marks aside.

    Beginnings stand for all forms of a word, which single forms may be too rare to show.
    """
    plain = text.translate(_LETTERS) if text else b""
    slots = [word_hashes(plain)]
    codes = np.frombuffer(b" " + plain, dtype=np.uint8)
    start = np.flatnonzero((codes[1:] != 32) & (codes[:-1] == 32)) + 1
    for size in BEGINNINGS:
        own = start[start + size <= len(codes)]
        value = np.full(len(own), size, dtype=np.uint64)
        whole = np.ones(len(own), dtype=bool)
        for k in range(size):
            value = value * np.uint64(BASE) + codes[own + k]
            whole &= codes[own + k] != 32
        slots.append(mix(value[whole]))
    return np.unique(np.concatenate(slots) & np.uint64(SLOTS - 1)).astype(np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _linear(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with ridge, the constant last and free, by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(rate / (1 - rate))
    for _ in range(STEPS):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Chain:
    """The words looked at, and one linear model for each category."""

    slots: np.ndarray
    models: list[np.ndarray]

    def table(self, documents: list[np.ndarray]) -> np.ndarray:
        """Which of the words each document has."""
        found = np.zeros((len(documents), len(self.slots)))
        for row, own in zip(found, documents):
            row[np.isin(self.slots, own)] = 1
        return found

    def predict(self, documents: list[np.ndarray]) -> np.ndarray:
        """Probabilities, a column for each category."""
        x, out = self.table(documents), []
        for w in self.models:
            odds = _odds(x, w)
            out.append(_sigmoid(odds))
            x = np.column_stack((x, np.clip(odds, -6, 6)))
        return np.column_stack(out) if out else np.zeros((len(documents), 0))


def associated(documents: list[np.ndarray], y: np.ndarray, n: int) -> np.ndarray:
    """At most n slots that together tell y apart, by chi-square.

    Slots are taken one after the other, each judged on the documents that have none of those
    before, so that the many forms of one word do not crowd out a rarer word. What room is left
    goes to the best slots over all documents. Slots of a single document say nothing about others.
    """
    flat = np.concatenate([np.zeros(0, np.int32), *documents])
    size = np.array([len(d) for d in documents], dtype=np.int64)
    has = np.bincount(flat, minlength=SLOTS).astype(float)
    good = np.bincount(flat, weights=np.repeat(y, size), minlength=SLOTS)

    def gain(has: np.ndarray, good: np.ndarray, share: float) -> np.ndarray:
        over = np.maximum(good - has * share, 0)
        return np.where(has > 1, over**2 / np.maximum(has * share * (1 - share), 1e-9), 0)

    first = gain(has, good, y.mean() if len(y) else 0.0)
    order = np.argsort(-first, kind="stable")[:CANDIDATES]
    order = order[first[order] > 0]
    place = np.full(SLOTS, -1)
    place[order] = np.arange(len(order))
    found = np.zeros((len(documents), len(order)), dtype=bool)
    for row, own in zip(found, documents):
        at = place[own]
        row[at[at >= 0]] = True
    open_, chosen = np.ones(len(documents), dtype=bool), []
    has, good = has[order], good[order]
    while len(chosen) < n and open_.any() and len(order):
        score = gain(has, good, y[open_].mean())
        best = int(score.argmax())
        if score[best] < LEAST_GAIN:
            break
        chosen.append(best)
        covered = open_ & found[:, best]
        has = has - found[covered].sum(axis=0)
        good = good - found[covered & (y > 0)].sum(axis=0)
        open_ &= ~covered
    sure = set(chosen)
    rest = [i for i in range(len(order)) if i not in sure]
    rest = [i for k, i in enumerate(rest) if first[order[i]] >= LEAST_GAIN or k < LEAST_SLOTS - len(sure)]
    return np.sort(order[[*chosen, *rest][:n]])


def fit_chain(documents: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> Chain:
    """labels: a column of 0 and 1 for each category, in the order of the chain."""
    share = WORDS // max(1, labels.shape[1])
    chosen = [associated(documents, y, share) for y in labels.T.astype(float)]
    chain = Chain(np.unique(np.concatenate(chosen)).astype(np.int32), [])
    x = chain.table(documents)
    fold = np.random.default_rng(seed).permutation(len(documents)) % FOLDS
    for y in labels.T.astype(float):
        chain.models.append(_linear(x, y))
        apart = np.zeros(len(y))
        for k in range(FOLDS):
            if (fold == k).any():
                apart[fold == k] = _odds(x[fold == k], _linear(x[fold != k], y[fold != k]))
        x = np.column_stack((x, np.clip(apart, -6, 6)))
    return chain


def categories(documents: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Labels of CATEGORIES from the one flag that is given.

    The words most associated with the flag stand for abuse. A toxic document with any of them is
    an insult, one with at least two different ones, or the median if that is more, is severe.
    """
    toxic = toxic.astype(float)
    common = associated(documents, toxic, 12)
    n = np.array([np.isin(common, d).sum() for d in documents])
    middle = np.median(n[toxic == 1]) if (toxic == 1).any() else 0
    return np.column_stack((toxic * (n > 0), toxic * (n >= max(2, middle)), toxic))


def _words(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            own = [words(t) for t in some.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("doc_id"),
                    some.column("label").cast(pa.float64()),
                    pa.array([len(o) for o in own], pa.int64()),
                    pa.array([o.astype("<i4").tobytes() for o in own], pa.binary()),
                ],
                ["doc_id", "label", "n", "words"],
            )


def train(
    docs: DataFrame,
    labels: DataFrame,
    derive: Callable[[list[np.ndarray], np.ndarray], np.ndarray] = categories,
) -> Chain | None:
    """The chain from the labelled documents among `docs`; None if there are none."""
    sample = drawn(docs, labels, "toxic", SAMPLE_DOCUMENTS)
    coded = sample.mapInArrow(_words, "doc_id long, label double, n long, words binary")
    sizes = coded.groupBy("doc_id").agg(F.max("n").alias("n"))
    fits, total = [], 0
    for row in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if total + row["n"] <= SAMPLE_WORDS:
            fits.append(row["doc_id"])
            total += row["n"]
    found = coded.where(F.col("doc_id").isin(fits)).collect() if fits else []
    if not found:
        return None
    found = sorted(found, key=lambda r: (r["doc_id"], r["words"]))
    documents = [np.frombuffer(r["words"], "<i4") for r in found]
    flags = np.array([r["label"] for r in found])
    return fit_chain(documents, derive(documents, flags))


def _apply(chain: Chain | None):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = [np.zeros((0, len(CATEGORIES)))]
            for at in range(0, len(texts), 256):
                some = texts[at : at + 256]
                if chain is None:
                    found.append(np.zeros((len(some), len(CATEGORIES))))
                else:
                    found.append(chain.predict([words(t) for t in some]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in np.concatenate(found).T.copy())],
                ["doc_id", *(f"p_{c}" for c in CATEGORIES)],
            )

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Probabilities of each category for every document, learnt from `labels.toxic`.

    docs: `doc_id`, `text`. labels: `doc_id`, `toxic` (1 toxic, 0 not). Further columns are
    ignored. One row per input row: `held_out`, `p_insult`, `p_severe`, `p_toxic` and `toxic`,
    whether the last reaches LIMIT. Only the text decides.

    Null and empty texts have no words and get the chain's base rates. Rows without an id are
    scored like others, and so are repeated rows; the chain learns from one row of each id. Words of
    long texts are hashed by slices. Without any labelled document all probabilities are 0; an empty
    table has no rows.
    """
    chain = train(docs, labels)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = ", ".join(f"p_{c} double" for c in CATEGORIES)
    scored = docs.mapInArrow(_apply(chain), f"doc_id long, {kinds}")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        *(f"p_{c}" for c in CATEGORIES),
        (F.col("p_toxic") >= LIMIT).alias("toxic"),
    )
