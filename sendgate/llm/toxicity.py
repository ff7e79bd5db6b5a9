"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

A document is as toxic as its most toxic windows of letters (see ``string_kernel``), so an insult
counts the same in a long text as in a short one, and one with left-out or inserted characters
is near the plain one. Labels say which documents are toxic, not which words, so training goes in
rounds: in every toxic document the window that scores highest is taken as its witness, in every
clean one as a counterexample; landmarks are drawn from both by their distance to those drawn
before; the Nyström map of the landmarks turns windows into vectors, and a support vector
machine with squared hinge loss separates them. The learned weights sum up to one number per
subsequence, a fixed table that scores texts in one pass. A logistic curve, fitted on labelled
documents that the machine has not seen, turns the highest margin and the mean of the next three
into a score.

Training takes at most ``Settings.toxic`` toxic and ``Settings.clean`` clean labelled documents,
drawn by a hash of their texts; that bound keeps what reaches the driver small. Every document
is scored, over its whole text.

Defined results:

* A null or empty text, or one without a unit of three letters, scores as the lowest margin.
* Repeated rows score alike and are all kept; a document with several labels is toxic if one is.
* Null labels are no labels. Without labels of both kinds nothing is known to be toxic, and
  every score is 0.
* Every column of the input stays, except those named like an output column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sendgate.llm import string_kernel as kernel
from sendgate.llm.common import return_memory
from sendgate.session import keep


@dataclass(frozen=True)
class Settings:
    toxic: int = 2_000  # labelled documents to learn from, at most
    clean: int = 4_000
    landmarks: int = 400
    rounds: int = 5
    penalty: float = 10.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """One weight per subsequence (a megabyte), and the curve from margins to scores."""

    weights: np.ndarray | None
    floor: float = 0.0
    curve: tuple[float, ...] = ()

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        margins = _margins(kernel.text_scores(texts, self.weights, self.floor))
        return 1.0 / (1.0 + np.exp(-np.clip(margins @ np.array(self.curve), -500, 500)))


def _margins(top: np.ndarray) -> np.ndarray:
    """The highest margin, the mean of the next ones, and one for the shift."""
    return np.column_stack([top[:, 0], top[:, 1:].mean(axis=1), np.ones(len(top))])


# The number of the first text in a group, and the group's units.
Group = tuple[int, kernel.Units]


def _kernel(left: kernel.Sets, right: kernel.Sets) -> np.ndarray:
    """Kernel values of all pairs of two lists of windows."""
    codes, place = np.unique(right.codes, return_inverse=True)
    table = np.zeros((len(codes) + 1, len(right)))  # the last row stands for what right has not
    np.add.at(table, (place, right.rows), right.weights)
    at = np.searchsorted(codes, left.codes)
    at[at < len(codes)] = np.where(
        codes[at[at < len(codes)]] == left.codes[at < len(codes)], at[at < len(codes)], len(codes)
    )
    values = np.zeros((len(left), len(right)))
    for first in range(0, len(left), 256):
        bounds = left.bounds[first : first + 257]
        part = slice(bounds[0], bounds[-1])
        products = table[at[part]] * left.weights[part, None]
        if len(products):
            values[first : first + 256] = np.add.reduceat(products, bounds[:-1] - bounds[0])
    return values


def _landmarks(sets: kernel.Sets, most: int, draw: np.random.Generator) -> np.ndarray:
    """Rows far from each other: each is drawn by its squared distance to those before."""
    own = np.bincount(sets.rows, sets.weights**2, len(sets))
    left = own.copy()
    chosen: list[int] = []
    weight_of = np.zeros(kernel.SIZE)
    while len(chosen) < min(most, len(sets)) and left.sum() > 1e-9:
        row = int(draw.choice(len(sets), p=left / left.sum()))
        chosen.append(row)
        part = slice(sets.bounds[row], sets.bounds[row + 1])
        np.add.at(weight_of, sets.codes[part], sets.weights[part])
        similar = np.bincount(sets.rows, sets.weights * weight_of[sets.codes], len(sets))
        weight_of[sets.codes[part]] = 0.0
        left = np.minimum(left, np.maximum(own + own[row] - 2 * similar, 0.0))
        left[row] = 0.0
    return np.array(chosen, int)


def _machine(vectors: np.ndarray, toxic: np.ndarray, penalty: float) -> np.ndarray:
    """Weights, the bias last, of a linear support vector machine with squared hinge loss."""
    x = np.hstack([vectors, np.ones((len(vectors), 1))])
    y = np.where(toxic, 1.0, -1.0)
    cost = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
    cost = cost * penalty * len(y) / 2
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    active = np.zeros(len(y), bool)
    for _ in range(30):  # Newton steps; the set of rows inside the margin settles in a few
        inside = y * (x @ w) < 1
        if w.any() and np.array_equal(inside, active):
            break
        active = inside
        part = x[active] * cost[active][:, None]
        w = np.linalg.solve(ridge + part.T @ x[active], part.T @ y[active])
    return w


def _first_weights(groups: Sequence[Group], toxic: np.ndarray) -> np.ndarray:
    """How much more often toxic documents than clean ones hold each subsequence."""
    seen = {True: np.zeros(kernel.SIZE), False: np.zeros(kernel.SIZE)}
    for first, units in groups:
        pairs = [
            units.text_of[there].astype(np.int64) * kernel.SIZE + found[there]
            for found, there, _ in kernel.subsequences(units)
        ]
        text, code = np.divmod(np.unique(np.concatenate(pairs)), kernel.SIZE)
        for kind, counts in seen.items():
            counts += np.bincount(code[toxic[first + text] == kind], minlength=kernel.SIZE)
    more = np.log((seen[True] + 0.5) / (toxic.sum() + 1)) - np.log(
        (seen[False] + 0.5) / ((~toxic).sum() + 1)
    )
    return np.where(seen[True] + seen[False] > 0, more, 0.0)


def _curve(x: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic curve over margins, with smoothed targets."""
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n_toxic + 1) / (n_toxic + 2), 1 / (n_clean + 2))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - target * z))

    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        steep = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x * steep[:, None]).T @ x + 1e-6 * np.eye(len(w)), x.T @ (target - p))
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return tuple(map(float, w))


def train(texts: Sequence[str], toxic: Sequence[bool], settings: Settings | None = None) -> Model:
    """A model from labelled texts."""
    settings = settings or Settings()
    toxic = np.asarray(toxic, bool)
    if not toxic.any() or toxic.all():
        return Model(None)
    draw = np.random.default_rng(settings.seed)
    # Every fifth text of each kind is kept for the curve, if there are enough.
    aside = np.zeros(len(texts), bool)
    for kind in (toxic, ~toxic):
        if kind.sum() >= 10:
            aside[np.flatnonzero(kind)[::5]] = True
    learn = np.flatnonzero(~aside)
    # A word that a text repeats gives no other windows.
    plain = [" ".join(dict.fromkeys((texts[i] or "").split())) for i in learn]
    y = toxic[learn]
    groups = [(numbers[0], kernel.read_units(part)) for numbers, part in kernel.whole_pieces(plain)]
    groups = [(first, units) for first, units in groups if len(units.starts)]
    if not groups:
        return Model(None)
    weights = _first_weights(groups, y)
    kept = [np.zeros(0, int) for _ in groups]  # counterexamples of earlier rounds stay
    for _ in range(settings.rounds):
        found: list[kernel.Sets] = []
        labels: list[np.ndarray] = []
        for number, (first, units) in enumerate(groups):
            scores = kernel.window_scores(units, weights)
            best = kernel.best_windows(units, scores)
            is_toxic = y[first + units.text_of[units.starts[best]]]
            kept[number] = np.union1d(kept[number], best[~is_toxic])
            rows = np.concatenate([best[is_toxic], kept[number]])
            found.append(kernel.window_sets(units, rows))
            labels.append(y[first + units.text_of[units.starts[rows]]])
        sets, label = kernel.Sets.joined(found), np.concatenate(labels)
        if not label.any() or label.all():
            return Model(None)
        marks = np.concatenate(
            [
                part[_landmarks(sets.take(part), settings.landmarks // 2, draw)]
                for part in (np.flatnonzero(label), np.flatnonzero(~label))
            ]
        )
        marked = sets.take(marks)
        values, axes = np.linalg.eigh(_kernel(marked, marked))
        good = values > 1e-8 * values.max()
        root = axes[:, good] / np.sqrt(values[good])
        machine = _machine(_kernel(sets, marked) @ root, label, settings.penalty)
        shares = root @ machine[:-1]
        weights = np.zeros(kernel.SIZE)
        np.add.at(weights, marked.codes, shares[marked.rows] * marked.weights)
    floor = min(float(kernel.window_scores(units, weights).min()) for _, units in groups)
    fit = np.flatnonzero(aside) if aside.any() and len(np.unique(toxic[aside])) == 2 else learn
    outside = kernel.text_scores([texts[i] for i in fit], weights, floor)
    return Model(weights.astype(np.float32), floor, _curve(_margins(outside), toxic[fit]))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, settings: Settings, text: str = "text"
) -> pd.DataFrame:
    """Text and label of the different labelled texts that the bounds of ``settings`` let in.

    A text is toxic if any of its copies is. Which ones, a hash of the text decides; the result goes to the driver.
    """
    labels = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    rows = docs.where(F.col(text).isNotNull()).select("doc_id", F.col(text).alias("text"))
    # The texts stay where they are until the few that are wanted are known.
    known = rows.select("doc_id", F.xxhash64("text").alias("hash")).join(labels, "doc_id")
    known = known.groupBy("hash").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    known = keep(known, "labelled")
    parts = [
        known.where(F.col("toxic") == kind).orderBy("hash").limit(most)
        for kind, most in ((True, settings.toxic), (False, settings.clean))
    ]
    wanted = keep(parts[0].unionAll(parts[1]), "wanted")
    return (
        rows.withColumn("hash", F.xxhash64("text"))
        .join(F.broadcast(wanted), ["doc_id", "hash"])
        .groupBy("hash")  # rows may repeat
        .agg(F.first("toxic").alias("toxic"), F.first("text").alias("text"))
        .orderBy("hash")
        .select("toxic", "text")
        .toPandas()
    )


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    settings = settings or Settings()
    sample = labelled_sample(docs, labels, settings)
    return train(sample["text"].tolist(), sample["toxic"].tolist(), settings)


def score_texts(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    score: str = "score",
    predicted: str = "predicted",
) -> DataFrame:
    """``docs`` with the score of each text and 1 where it is 0.5 or more, else 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(texts.tolist()))
        return_memory()

    others = [c for c in docs.columns if c.lower() not in (score.lower(), predicted.lower())]
    scored = docs.select(*others, scores(F.col(text)).alias(score))
    return scored.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))
