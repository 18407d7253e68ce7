"""Text quality from trusted positives and unlabelled web text alone.

Positive-unlabelled learning with the non-negative unbiased risk: unlabelled text is a mixture
of good and bad, so the risk on the bad is that of calling unlabelled text bad, less the share that its
good part takes, known from the positives and the class prior. That difference can't be
negative; where an estimate of it is, the step goes the other way. The prior comes from the texts too:
whatever part of the positives a first classifier accepts, of unlabelled text it accepts at
least the prior times as much, and almost exactly that where it accepts hardly any bad text.

The model is fitted on the driver on a bounded sample (``Settings``); features and scores of all texts are computed
where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.chunks import tidy
from holdfast.llm.common import fold, fresh, keep_rows

FOLDS = 5
THRESHOLD = 0.3
KINDS, SHAPES = 6, 12
WIDTH = KINDS**2 + SHAPES
# Kind of each byte: 0 other, 1 capital, 2 small letter, 3 digit, 4 blank, 5 part of a letter beyond ASCII.
KIND = np.zeros(256, dtype=np.uint8)
for _kind, (_low, _high) in enumerate([(65, 91), (97, 123), (48, 58), (9, 14), (128, 256)], 1):
    KIND[_low:_high] = _kind
KIND[32] = 4
# Bytes counted at once, so that a long text needs no more memory.
SLICE = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample (rows of lowest hash), and how the model is fitted to it.

    The prior used is the estimate less the share ``caution``: one too low only makes good texts less certain, by that
    share, one too high takes whole kinds of bad texts for good.
    """

    positives: int = 5_000
    unlabelled: int = 10_000
    hidden: int = 16
    steps: int = 1_000
    batch: int = 512
    rate: float = 0.004
    decay: float = 1e-2
    caution: float = 0.1
    seed: int = 3


def features(text: str) -> np.ndarray:
    """Square roots of the shares of pairs of byte kinds, and measures of a text's shape, all between 0 and about 1.

    No single word or letter counts, so that what is learned is neither a language nor a topic.
    """
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    n = len(data)
    pairs, singles = np.zeros(KINDS**2), np.zeros(256)
    for start in range(0, n, SLICE):
        kinds = KIND[data[start : start + SLICE + 1]]
        pairs += np.bincount(kinds[:-1] * KINDS + kinds[1:], minlength=KINDS**2)
        singles += np.bincount(data[start : start + SLICE], minlength=256)
    words, rows = text.split(), text.split("\n")
    n_words = max(1, len(words))
    upper, lower = singles[65:91].sum(), singles[97:123].sum() + singles[128:].sum()
    digits, blanks = singles[48:58].sum(), singles[9:14].sum() + singles[32]
    shape = (
        upper / max(1, upper + lower),
        digits / max(1, n),
        blanks / max(1, n),
        max(0.0, n - upper - lower - digits - blanks) / max(1, n),
        len(set(words)) / n_words,
        sum(map(str.__eq__, words[:-1], words[1:])) / n_words,
        len(set(rows)) / len(rows),
        sum(map(str.isalpha, words)) / n_words,
        min(1.0, n / n_words / 20),
        min(1.0, np.log1p(n) / 15),
        singles.max() / max(1, n),
        1.0 if n else 0.0,
    )
    return np.concatenate([np.sqrt(pairs / max(1.0, pairs.sum())), shape]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


class Network:
    """One hidden layer on standardised features; its output is the log-odds of good text."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        self.weights = [
            rng.standard_normal((len(mean), hidden)) / np.sqrt(len(mean)),
            np.zeros(hidden),
            rng.standard_normal(hidden) / np.sqrt(hidden),
            np.zeros(1),
        ]

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -6, 6)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.weights
        return np.tanh(self.standard(x) @ w + b) @ v + c[0]

    def gradient(self, z: np.ndarray, push: np.ndarray) -> list[np.ndarray]:
        """Of ``push @ log_odds`` for standardised rows."""
        w, b, v, _ = self.weights
        h = np.tanh(z @ w + b)
        back = push[:, None] * v * (1 - h**2)
        return [z.T @ back, back.sum(axis=0), h.T @ push, np.array([push.sum()])]


def _descend(net: Network, gradients: Iterator[list[np.ndarray]], s: Settings) -> None:
    """Adam with weight decay, the rate falling to zero."""
    first, second = ([np.zeros_like(w) for w in net.weights] for _ in range(2))
    for t, gradient in enumerate(gradients, 1):
        rate = s.rate * (1 - (t - 1) / s.steps)
        for w, g, m, q in zip(net.weights, gradient, first, second):
            m += 0.1 * (g - m)
            q += 0.001 * (g**2 - q)
            w -= rate * (m / (1 - 0.9**t) / (np.sqrt(q / (1 - 0.999**t)) + 1e-8) + s.decay * w)


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, s: Settings) -> Network:
    """Minimise the non-negative risk for a prior; without one, tell positives from unlabelled text."""
    both = np.vstack([positive, unlabelled])
    net = Network(both.mean(axis=0), both.std(axis=0) + 1e-3, s.hidden, s.seed)
    p, u = net.standard(positive), net.standard(unlabelled)
    rng = np.random.default_rng(s.seed)

    def gradients() -> Iterator[list[np.ndarray]]:
        w, b, v, c = net.weights
        for _ in range(s.steps):
            a, z = p[rng.integers(len(p), size=s.batch)], u[rng.integers(len(u), size=s.batch)]
            f_p, f_u = (np.tanh(x @ w + b) @ v + c[0] for x in (a, z))
            # Logistic loss: log(1 + exp(-f)) for good, log(1 + exp(f)) for bad.
            up, down_p, down_u = (_sigmoid(f_p) - 1) / len(a), _sigmoid(f_p) / len(a), _sigmoid(f_u) / len(z)
            if prior is None:
                yield [x + y for x, y in zip(net.gradient(a, up), net.gradient(z, down_u))]
                continue
            bad = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
            of_bad = [x - y for x, y in zip(net.gradient(z, down_u), net.gradient(a, prior * down_p))]
            yield [x + y for x, y in zip(net.gradient(a, prior * up), of_bad)] if bad >= 0 else [-x for x in of_bad]

    _descend(net, gradients(), s)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, s: Settings) -> float:
    """Share of good text among unlabelled: the least ratio of the parts accepted, over thresholds that accept enough.

    The classifier is fitted on one half of the sample and its acceptance counted on the other.
    """
    net = _fit(positive[::2], unlabelled[::2], None, s)
    held_p, held_u = (np.sort(net.log_odds(x[1::2] if len(x) > 1 else x)) for x in (positive, unlabelled))
    cuts = np.quantile(held_p, np.linspace(0.01, 0.6, 60))
    of_p = 1 - np.searchsorted(held_p, cuts) / len(held_p)
    of_u = 1 - np.searchsorted(held_u, cuts) / len(held_u)
    # Two standard errors of the ratio, so that the least of many isn't one of chance.
    error = 2 * np.sqrt((1 - of_p) / (of_p * len(held_p)) + (1 - of_u) / (np.maximum(of_u, 1e-9) * len(held_u)))
    return float(np.clip((of_u / of_p * (1 + error)).min(), 0.02, 0.98))


@dataclass
class Model:
    """What scoring needs; without a network every score is 1/2."""

    network: Network | None = None
    prior: float | None = None

    def score(self, texts: list[str]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), 0.5)
        return _sigmoid(self.network.log_odds(np.array([features(t) for t in texts]).reshape(-1, WIDTH)))


def _lowest(ids: DataFrame, key: str, n: int) -> DataFrame:
    return ids.orderBy(F.xxhash64(key), key).limit(n)


def _sample(df: DataFrame, ids: DataFrame, key: str, text: str, n: int) -> np.ndarray:
    """Features of the rows of ``df`` with these at most n keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t or "").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, type=pa.binary())], ["key", "features"])

    chosen = keep_rows(df, F.broadcast(ids), key).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("features", T.BinaryType())])
    # Ordered, so that the sample and with it the model is the same whichever task ends first.
    rows = chosen.mapInArrow(tidy(run), schema).orderBy("key", "features").limit(n).collect()
    return np.frombuffer(b"".join(r.features for r in rows), dtype=np.float32).reshape(-1, WIDTH).astype(np.float64)


def train(
    df: DataFrame,
    positives: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    may_learn: Column | None = None,
    settings: Settings = Settings(),
) -> Model:
    """Fit to the texts of ``df``: those whose keys are in the one-column table ``positives``, and unlabelled ones.

    ``may_learn`` limits the rows that are looked at at all. Of each kind the rows of lowest hash of the key
    are taken, so many as ``settings`` says. Without positives there is nothing to learn.
    """
    rows = df.where(F.col(key).isNotNull() & (F.lit(True) if may_learn is None else may_learn))
    # Only positives that have a row here, so that the sample isn't spent on others.
    good = keep_rows(rows.select(key), positives, key).distinct()
    positive = _sample(rows, _lowest(good, key, settings.positives), key, text, settings.positives)
    unlabelled = _sample(rows, _lowest(rows.select(key).distinct(), key, settings.unlabelled), key, text, settings.unlabelled)
    if not len(positive) or not len(unlabelled):
        return Model()
    prior = estimate_prior(positive, unlabelled, settings) * (1 - settings.caution)
    return Model(_fit(positive, unlabelled, prior, settings), prior)


def score(df: DataFrame, model: Model, name: str = "score", key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, name): the probability that a whole text is good, for every row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                scores = model.score([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, type=pa.float64())], ["key", name])

    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField(name, T.DoubleType())])
    return source.mapInArrow(tidy(run), schema).withColumnRenamed("key", key)


def trusted(labels: DataFrame, key: str = "doc_id", quality: str = "quality", folds: int = FOLDS) -> DataFrame:
    """Keys outside the held-out fold that are labelled 1 and never 0."""
    return (
        labels.where(F.col(key).isNotNull() & (fold(F.col(key), folds) != 0))
        .groupBy(key)
        .agg(F.min(quality).alias("_least"), F.max(quality).alias("_most"))
        .where("_least = 1 AND _most = 1")
        .select(key)
    )


def rate(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``df``.

    The fold of the key's crc32 modulo 5 that is 0 is held out: neither its labels nor its texts are learned from.
    Null and empty texts are scored like others, by their features; repeated rows stay; without
    any trusted positive all scores are 1/2; a row without a key isn't held out. Columns other than key and text aren't looked at.
    Every text is scored whole, however long; an empty table gives an empty one.
    """
    not_held = fold(F.col(key), FOLDS) != 0
    model = train(df, trusted(labels, key), key, text, not_held)
    scored = score(df, model, "score", key, text)
    return scored.select(
        key,
        F.coalesce(fold(F.col(key), FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose text the classifier accepts; all columns. The text is scored where the row is read."""
    model = train(df, trusted(labels, key), key, text, fold(F.col(key), FOLDS) != 0)
    name = fresh(df, "_score")
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                scores = model.score([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, type=pa.float64())], schema.names)

    return df.mapInArrow(tidy(run), schema).where(F.col(name) >= threshold).drop(name)
