"""Language of texts by a convolutional network over bytes.

Bytes are embedded, filters of several widths slide over windows of fixed length, each filter's
largest value in a window is kept, and a softmax over them gives the window's languages; a text's are the
mean over all its windows, weighted by their bytes. The network is trained in numpy on windows of a
bounded sample of labelled texts (``Settings``). For use, embedding and filters are multiplied out into tables
of single bytes and of pairs, so that a filter costs one or two look-ups a place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.chunks import tidy
from holdfast.llm.common import fold

FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
# Windows that go through the network at once.
BLOCK = 128
_SPACE = 1 << 31


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample and how the network is trained on it.

    ``texts`` per language are expected, by hash of key and text; ``most`` bounds the texts of all languages.
    """

    texts: int = 600
    most: int = 60_000
    windows: int = 4
    embedding: int = 8
    filters: int = 16
    epochs: int = 12
    batch: int = 64
    rate: float = 0.004
    seed: int = 11


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, one after the other, the last filled with zeros; an empty text has none."""
    n = -(-len(data) // WINDOW)
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW)


@dataclass
class Network:
    """Embedding (256, d), filters by width (width, d, filters) with biases, and the dense layer over all of them."""

    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray
    _tables: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_tables": {}}

    @classmethod
    def start(cls, labels: list[str], s: Settings) -> Network:
        rng = np.random.default_rng(s.seed)
        filters = [
            rng.standard_normal((w, s.embedding, s.filters)).astype(np.float32) / np.sqrt(np.float32(w * s.embedding))
            for w in WIDTHS
        ]
        return cls(
            labels,
            rng.standard_normal((256, s.embedding)).astype(np.float32),
            filters,
            [np.zeros(s.filters, dtype=np.float32) for _ in WIDTHS],
            (rng.standard_normal((len(WIDTHS) * s.filters, len(labels))) * 0.1).astype(np.float32),
            np.zeros(len(labels), dtype=np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.dense, self.offset]

    def loss_gradient(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Gradient of the mean cross-entropy, in the order of ``parameters``."""
        n = len(windows)
        embedded = self.embedding[windows]
        pooled, places = [], []
        for f, b in zip(self.filters, self.biases):
            width = len(f)
            slid = np.lib.stride_tricks.sliding_window_view(embedded, width, axis=1)  # (n, places, d, width)
            flat = slid.transpose(0, 1, 3, 2).reshape(n, WINDOW - width + 1, -1)
            values = flat @ f.reshape(-1, f.shape[2]) + b
            place = values.argmax(axis=1)
            places.append((flat, place))
            pooled.append(np.take_along_axis(values, place[:, None, :], axis=1)[:, 0, :])
        top = np.hstack(pooled)
        active = np.maximum(top, 0)
        error = (_softmax(active @ self.dense + self.offset) - np.eye(len(self.labels), dtype=np.float32)[target]) / n
        back = (error @ self.dense.T) * (top > 0)
        of_embedding = np.zeros_like(self.embedding)
        of_filters, of_biases, at = [], [], 0
        for f, (flat, place) in zip(self.filters, places):
            width, d, count = f.shape
            own = back[:, at : at + count]
            at += count
            patches = flat[np.arange(n)[:, None], place]  # (n, filters, width * d)
            of_filters.append(np.einsum("nfp,nf->pf", patches, own).reshape(f.shape))
            of_biases.append(own.sum(axis=0))
            for k in range(width):
                hit = np.take_along_axis(windows, place + k, axis=1)
                np.add.at(of_embedding, hit, own[:, :, None] * f[k].T[None, :, :])
        return [of_embedding, *of_filters, *of_biases, active.T @ error, error.sum(axis=0)]

    def _multiplied(self) -> dict:
        """Tables of what single bytes and pairs of bytes add to each filter, built once a process."""
        if not self._tables:
            for i, (f, b) in enumerate(zip(self.filters, self.biases)):
                single = [self.embedding @ part for part in f]
                pairs = [
                    (single[k][:, None, :] + single[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, len(f) - 1, 2)
                ]
                pairs[0] = pairs[0] + b
                self._tables[i] = (pairs, single[-1] if len(f) % 2 else None)
        return self._tables

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Languages of windows (rows)."""
        tables = self._multiplied()
        out = []
        for start in range(0, len(windows), BLOCK):
            part = windows[start : start + BLOCK]
            pairs = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
            pooled = []
            for i, f in enumerate(self.filters):
                width, (by_pair, last) = len(f), tables[i]
                places = WINDOW - width + 1
                values = by_pair[0].take(pairs[:, :places], axis=0)
                for k, table in enumerate(by_pair[1:], 1):
                    values += table.take(pairs[:, 2 * k : 2 * k + places], axis=0)
                if last is not None:
                    values += last.take(part[:, width - 1 : width - 1 + places], axis=0)
                pooled.append(values.max(axis=1))
            out.append(_softmax(np.maximum(np.hstack(pooled), 0) @ self.dense + self.offset))
        return np.concatenate(out) if out else np.zeros((0, len(self.labels)), dtype=np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: np.ndarray, target: np.ndarray, labels: list[str], s: Settings) -> Network:
    """Adam over shuffled batches, the rate falling to zero; every language weighs alike."""
    net = Network.start(labels, s)
    rng = np.random.default_rng(s.seed)
    counts = np.bincount(target, minlength=len(labels))
    # Languages with fewer windows are drawn more often.
    chance = 1 / counts[target]
    chance = chance / chance.sum()
    steps = s.epochs * -(-len(windows) // s.batch)
    weights = net.parameters()
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for t in range(1, steps + 1):
        rows = rng.choice(len(windows), size=s.batch, p=chance)
        rate = s.rate * (1 - (t - 1) / steps)
        for w, g, m, q in zip(weights, net.loss_gradient(windows[rows], target[rows]), first, second):
            m += 0.1 * (g - m)
            q += 0.001 * (g**2 - q)
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.999**t)) + 1e-8)
    return net


# So many counts of languages go to every task; beyond that the texts are shuffled to them.
MOST_LANGUAGES = 4_096


def drawn(rows: DataFrame, texts: int) -> DataFrame:
    """Of (key, lang, text) about ``texts`` rows a language, with their ``draw``: by a hash of key and text, whatever the partitions."""
    counts = rows.groupBy("lang").agg(F.count("*").alias("of_lang"))
    few = counts.limit(MOST_LANGUAGES + 1).collect()
    if len(few) <= MOST_LANGUAGES:
        # No more rows than this, so that the texts stay where they are.
        counts = F.broadcast(rows.sparkSession.createDataFrame([(r.lang, r.of_lang) for r in few], "lang string, of_lang long"))
    limit = F.least(F.lit(_SPACE), F.expr(f"{_SPACE}L * {texts}L div of_lang"))
    placed = rows.withColumn("draw", F.xxhash64("key", "text")).join(counts, "lang")
    return placed.where(F.pmod("draw", F.lit(_SPACE)) <= limit).drop("of_lang")


def train(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    may_learn: Column | None = None,
    settings: Settings = Settings(),
) -> Network | None:
    """The network for the labelled texts of ``df`` (lang not null, text not empty); None if there are none.

    From each sampled text up to ``settings.windows`` windows are taken, evenly over its whole length.
    """
    usable = F.col(lang).isNotNull() & (F.length(text) > 0) & (F.lit(True) if may_learn is None else may_learn)
    rows = df.where(usable).select(
        F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    )
    sampled = drawn(rows, settings.texts).select("lang", "text", "draw")
    most = settings.windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for one in batch.column(1).to_pylist():
                found = windows_of(one.encode())
                chosen = np.unique(np.linspace(0, len(found) - 1, most).round().astype(int))
                made.append(found[chosen].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(made, type=pa.binary())], ["lang", "draw", "windows"]
            )

    sample = sampled.mapInArrow(tidy(run), "lang string, draw long, windows binary")
    # Ordered, so that the network is the same whichever task ends first.
    taken = sample.orderBy("draw", "lang", "windows").limit(settings.most).collect()
    labels = sorted({r.lang for r in taken})
    if not labels:
        return None
    windows = np.concatenate([np.frombuffer(r.windows, dtype=np.uint8).reshape(-1, WINDOW) for r in taken])
    target = np.repeat([labels.index(r.lang) for r in taken], [len(r.windows) // WINDOW for r in taken])
    return fit(windows, target, labels, settings)


def predict(df: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for every row: the likeliest language over all windows of the text, and its probability.

    ``und`` and 0 where the text is null or has no letter, or nothing was learned. Equal probabilities go to the
    first language in order of name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                names, scores = [], []
                for one in part.column(1).to_pylist():
                    if one is None or network is None:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    data = one.encode()
                    total, sizes = 0.0, 0
                    for at in range(0, len(data), WINDOW * 4096):
                        whole = windows_of(data[at : at + WINDOW * 4096])
                        size = np.full(len(whole), WINDOW)
                        size[-1] -= whole.size - len(data[at : at + WINDOW * 4096])
                        total = total + size @ network.probabilities(whole)
                        sizes += size.sum()
                    mean = total / sizes
                    names.append(network.labels[int(mean.argmax())])
                    scores.append(float(mean.max()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names), pa.array(scores)], ["key", "lang_pred", "score"])

    body = F.col(text).cast("string")
    source = df.select(F.col(key).alias("key"), F.when(body.rlike(r"\p{L}"), body).alias("text"))
    schema = T.StructType(
        [
            T.StructField("key", df.schema[key].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return source.mapInArrow(tidy(run), schema).withColumnRenamed("key", key)


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score) for every row of ``df``.

    Rows whose key's crc32 modulo 3 is 1 are held out: nothing is learned from them. Languages are those of
    the labelled rows outside. Repeated rows stay; a row without a key isn't held out and isn't learned from.
    A very long text is read whole, window by window; an empty table gives an empty one; columns other than these three aren't looked at.
    """
    in_fold = fold(F.col(key), FOLDS) == HELD_OUT
    network = train(df, key, text, lang, ~in_fold)
    return predict(df, network, key, text).select(key, F.coalesce(in_fold, F.lit(False)).alias("held_out"), "lang_pred", "score")
