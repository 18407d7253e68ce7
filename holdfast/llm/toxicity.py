"""Toxicity of texts by a support vector machine over subsequences of words.

Two words are alike as far as they share letters in the same order, whatever stands between: the
subsequence string kernel counts all three-letter subsequences within a few letters of each other, each the less
the longer the stretch it spans. Letters put in, dots, stars or blanks between letters so only weaken a
likeness. A word is described by its likeness to landmark words (Nyström), and a linear support vector machine over
that says how insulting it is. A text is judged by its worst words; so of a text labelled toxic only a few words need
be to blame, and which these are is found in turn with the machine.

The model is fitted on the driver on a bounded sample (``Settings``); texts are scored where they are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.chunks import runs_of, tidy
from holdfast.llm.common import fold, keep_rows

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
# 0 is no letter, 1 to 26 are a to z, all others share the rest.
LETTERS = 32
FEATURES = LETTERS**3
# Subsequences whose letters are at most so many letters apart; each place they span weighs DECAY.
REACH, DECAY = 5, 0.85
# Likeness is raised to this power, so that words with a part in common don't count as alike.
POWER = 2
# Longer words are taken in windows that overlap by half.
WINDOW = 24
# Taken off both ends of words.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# A text is judged by the margins of so many words.
WORST = 4
# Texts go through the model together up to so many bytes (one longer text alone), words so many at a time.
GROUP_BYTES = 8_000_000
WORDS = 20_000
# Share of the disguised words in the weight of all insults.
HIDDEN = 0.5

_CLASS = np.zeros(128, dtype=np.int32)
_CLASS[97:123] = np.arange(1, 27)


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample (documents of lowest hash of key and text) and of the fit.

    Of each sampled document at most ``words`` different words are taken, those of lowest hash. Up to ``blamed``
    words of a toxic document are learned as insults; a word blamed ``often`` is learned in disguise too.
    """

    toxic: int = 2_000
    clean: int = 3_000
    words: int = 2_000
    landmarks: int = 160
    rounds: int = 3
    cost: float = 3.0
    most_negatives: int = 24_000
    blamed: int = 4
    often: int = 8
    seed: int = 5


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def _spread(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Units of words: the words, or windows of long ones; and whose each unit is."""
    if max(map(len, words), default=0) <= WINDOW:
        return words, np.arange(len(words))
    units, owners = [], []
    for i, word in enumerate(words):
        for at in range(0, max(1, len(word) - WINDOW // 2), WINDOW // 2):
            units.append(word[at : at + WINDOW])
            owners.append(i)
    return units, np.array(owners)


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of words without line ends: class, place and word of each."""
    codes = np.frombuffer("\n".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    word = np.cumsum(codes == 10)
    kind = np.where(codes < 128, _CLASS[np.minimum(codes, 127)], 27 + codes % 5).astype(np.int32)
    there = kind > 0
    return kind[there], np.nonzero(there)[0], word[there]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kernel's features as a sparse matrix: words (rising), subsequences and weights, each pair once.

    Every word's weights have length 1; a word of fewer than three letters has none.
    """
    kind, place, word = letters_of(words)
    keys, weights = [], []
    for far in range(2, REACH + 1):
        if len(kind) <= far:
            break
        same = np.nonzero(word[far:] == word[:-far])[0]
        weight = DECAY ** (place[same + far] - place[same] - 2.0)
        for near in range(1, far):
            code = (kind[same] * LETTERS + kind[same + near]) * LETTERS + kind[same + far]
            keys.append(word[same].astype(np.int64) * FEATURES + code)
            weights.append(weight)
    if not keys or not sum(map(len, keys)):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(keys)
    keys, first = np.unique(keys[order], return_index=True)
    weights = np.add.reduceat(weights[order], first)
    word = keys // FEATURES
    norm = np.sqrt(np.bincount(word, weights**2))
    return word, keys % FEATURES, weights / norm[word]


@dataclass
class Machine:
    """Landmark words and the weight of the likeness to each."""

    landmarks: list[str]
    weights: np.ndarray
    offset: float
    calibration: np.ndarray | None = None
    _table: tuple | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_table": None}

    def likeness(self, words: list[str]) -> np.ndarray:
        """Kernel of words (rows) and landmarks (columns), between 0 and 1."""
        if self._table is None:
            at, feature, weight = subsequences(self.landmarks)
            order = np.argsort(feature, kind="stable")
            self._table = (np.bincount(feature, minlength=FEATURES), at[order], weight[order])
        # Few landmarks have a subsequence, so only they are added up.
        in_landmarks, of_landmark, landmark_weight = self._table
        starts = np.cumsum(in_landmarks) - in_landmarks
        word, feature, weight = subsequences(words)
        times = in_landmarks[feature]
        entries = np.repeat(starts[feature] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        cells = np.repeat(word, times) * len(self.landmarks) + of_landmark[entries]
        shape = (len(words), len(self.landmarks))
        out = np.bincount(cells, np.repeat(weight, times) * landmark_weight[entries], minlength=shape[0] * shape[1])
        return out.reshape(shape) ** POWER

    def margins(self, words: list[str]) -> np.ndarray:
        """How far each word is on the insulting side; that of a long word is its worst window's."""
        units, owners = _spread(words)
        out = np.full(len(words), self.offset)
        for start in range(0, len(units), WORDS):
            part = units[start : start + WORDS]
            np.maximum.at(out, owners[start : start + WORDS], self.likeness(part) @ self.weights + self.offset)
        return out

    def probability(self, margins: np.ndarray) -> np.ndarray:
        """Of texts with these worst margins."""
        return 0.5 * (1 + np.tanh(_summary(margins) @ self.calibration / 2))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words of lower-case texts, and for every occurrence its word and its text (rising).

    Runs of at least three words of a single letter count as one more word.
    """
    split = pc.utf8_split_whitespace(texts)
    parents = pc.list_parent_indices(split).to_numpy()
    coded = pc.utf8_trim(pc.list_flatten(split), characters=MARKS).dictionary_encode()
    words, at = coded.dictionary, coded.indices.to_numpy()
    if not len(words):
        return words, at, parents
    listed = words.to_pylist()
    single = np.bincount(letters_of(listed)[2], minlength=len(listed)) == 1
    alone = single[at]
    starts = np.nonzero(alone & ~(np.concatenate([[False], alone[:-1]]) & np.concatenate([[False], parents[1:] == parents[:-1]])))[0]
    if len(starts):
        # The run goes on as long as words are single letters of the same text.
        goes_on = np.concatenate([alone[1:] & (parents[1:] == parents[:-1]), [False]])
        ends = np.nonzero(alone & ~goes_on)[0]
        long = np.nonzero(ends - starts >= 2)[0]
        if len(long):
            runs = ["".join(listed[i] for i in at[starts[r] : ends[r] + 1]) for r in long]
            joined = pa.array(runs, type=words.type).dictionary_encode()
            words = pa.concat_arrays([words, joined.dictionary])
            at = np.concatenate([at, joined.indices.to_numpy() + len(listed)])
            parents = np.concatenate([parents, parents[starts[long]]])
            order = np.argsort(parents, kind="stable")
            at, parents = at[order], parents[order]
    return words, at, parents


def worst_margins(of_word: np.ndarray, parents: np.ndarray, n: int, offset: float) -> np.ndarray:
    """The WORST highest different margins of each of n texts, falling; ``offset`` where there are fewer words."""
    out = np.full((n, WORST), offset)
    values = of_word.copy()
    own, first, counts = np.unique(parents, return_index=True, return_counts=True)
    for k in range(WORST if len(own) else 0):
        highest = np.maximum.reduceat(values, first)
        out[own, k] = np.maximum(highest, offset)
        values[values == np.repeat(highest, counts)] = -np.inf
    return out


def text_margins(machine: Machine, texts: pa.Array) -> np.ndarray:
    """The margins of the worst words of each text."""
    words, at, parents = words_of(_lowered(texts))
    of_word = machine.margins(words.to_pylist())
    return worst_margins(of_word[at], parents, len(texts), machine.offset)


def _separate(z: np.ndarray, target: np.ndarray, weight: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps; targets are 1 and -1."""
    rows = np.hstack([z, np.ones((len(z), 1), dtype=z.dtype)]).astype(np.float64)
    ridge = np.ones(rows.shape[1])
    ridge[-1] = 1e-6
    w = np.zeros(rows.shape[1])
    w[-1] = -1.0

    def loss(v: np.ndarray) -> float:
        return 0.5 * (ridge * v) @ v + cost * (weight * np.maximum(0, 1 - target * (rows @ v)) ** 2).sum()

    for _ in range(30):
        slack = 1 - target * (rows @ w)
        wrong = slack > 0
        active, own = rows[wrong], weight[wrong]
        gradient = ridge * w - 2 * cost * active.T @ (own * target[wrong] * slack[wrong])
        step = np.linalg.solve(np.diag(ridge) + 2 * cost * (active * own[:, None]).T @ active, gradient)
        rate, now = 1.0, loss(w)
        while rate > 1e-4 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-6:
            break
    return w[:-1], w[-1]


def fit(documents: list[list[str]], toxic: np.ndarray, s: Settings) -> Machine | None:
    """The machine for sampled documents, given as their different words; None without both kinds."""
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(documents))
    # A fifth of the sample only turns margins into probabilities.
    learn, check = order[len(order) // 5 :], order[: len(order) // 5]
    if len(set(toxic[learn])) < 2 or len(set(toxic[check])) < 2:
        learn = check = order
    if len(set(toxic[learn])) < 2:
        return None
    innocent = {w for i in learn if not toxic[i] for w in documents[i]}
    clean_words = sorted(innocent)
    suspects = [sorted(set(documents[i]) - innocent) for i in learn if toxic[i]]
    suspects = [x for x in suspects if x]
    if not suspects or not clean_words:
        return None
    # A word that is in a clean document can't be to blame; among the rest the first guess are words
    # whose subsequences are commoner in toxic than in clean documents.
    known = sorted({w for x in suspects for w in x})
    number = {w: i for i, w in enumerate(known)}
    parts = [np.array([number[w] for w in x]) for x in suspects]
    guess = _first_guess(documents, toxic, learn, known)
    machine = None
    for _ in range(s.rounds):
        # The worst words of a document; beyond the first only those that come near it, or that the machine condemns.
        worst = [x[np.argsort(-guess[x], kind="stable")[: s.blamed]] for x in parts]
        least = [0.7 * guess[x[0]] if machine is None else 0.0 for x in worst]
        blame = np.bincount(np.concatenate([x[(guess[x] > g) | (np.arange(len(x)) == 0)] for x, g in zip(worst, least)]))
        blamed = np.nonzero(blame)[0]
        blamed = blamed[np.argsort(-blame[blamed], kind="stable")]
        positives = [known[i] for i in blamed]
        hidden = [d for i in blamed if blame[i] >= s.often for d in disguises(known[i], rng) if d not in innocent]
        # The clean words that look worst are always among those learned from.
        half = s.most_negatives // 2
        hard = [] if machine is None else np.argsort(-machine.margins(clean_words), kind="stable")[:half]
        near = [clean_words[i] for i in hard[: s.landmarks // 4]]
        negatives = sorted({clean_words[i] for i in hard} | set(_some(clean_words, s.most_negatives - len(hard), rng)))
        chosen = positives[: s.landmarks // 2] + near
        chosen += _some(hidden, s.landmarks // 8, rng)
        chosen = _distinct(chosen + _some(negatives, s.landmarks - len(chosen), rng))
        machine = Machine(chosen, np.zeros(len(chosen)), 0.0)
        # Nyström: the kernel of all words through that of the landmarks.
        values, vectors = np.linalg.eigh(machine.likeness(chosen))
        real = values > 1e-4
        root = vectors[:, real] / np.sqrt(values[real])
        z = machine.likeness(positives + hidden + negatives) @ root
        groups = [np.sqrt(blame[blamed]), np.ones(len(hidden)), np.ones(len(negatives))]
        target = np.repeat([1.0, 1.0, -1.0], [len(x) for x in groups])
        # Both kinds weigh alike; a word blamed often weighs more.
        weight = np.concatenate([share * x / max(1, x.sum()) for share, x in zip((1 - HIDDEN, HIDDEN, 1.0), groups)])
        w, machine.offset = _separate(z, target, weight * 1_000, s.cost)
        machine.weights = root @ w
        guess = machine.margins(known)
    return _calibrated(machine, [documents[i] for i in check], toxic[check])


def disguises(word: str, rng: np.random.Generator) -> list[str]:
    """A word with a letter put in, doubled or starred out, at each inner place."""
    if not 4 <= len(word) <= WINDOW or not word.isalpha():
        return []
    out = []
    for i in range(1, len(word)):
        out += [word[:i] + chr(97 + rng.integers(26)) + word[i:], word[:i] + word[i - 1] + word[i:]]
        out += [word[:i] + "*" + word[i + 1 :]] if i + 1 < len(word) else []
    return out


def _some(words: list[str], n: int, rng: np.random.Generator) -> list[str]:
    return words if len(words) <= n else [words[i] for i in np.sort(rng.choice(len(words), n, replace=False))]


def _distinct(words: list[str]) -> list[str]:
    """Words with subsequences that no earlier word's equal."""
    return list(dict.fromkeys(w for w in words if len(subsequences([w[:WINDOW]])[0])))


def _first_guess(documents: list[list[str]], toxic: np.ndarray, learn: np.ndarray, words: list[str]) -> np.ndarray:
    """For each word, how much commoner its subsequences are in toxic documents, on average."""
    counts = np.zeros((2, FEATURES))
    for i in learn:
        counts[int(toxic[i])][np.unique(subsequences(documents[i])[1])] += 1
    n = np.array([(~toxic[learn]).sum(), toxic[learn].sum()])
    odds = np.log((counts[1] + 0.5) / (n[1] + 1)) - np.log((counts[0] + 0.5) / (n[0] + 1))
    word, feature, weight = subsequences([w[: 2 * WINDOW] for w in words])
    total = np.bincount(word, weight, minlength=len(words))
    return np.where(total > 0, np.bincount(word, weight * odds[feature], minlength=len(words)) / np.maximum(total, 1e-9), -9.0)


def _calibrated(machine: Machine, documents: list[list[str]], toxic: np.ndarray) -> Machine:
    """Logistic regression of the label on the worst margins and their mean, by Newton steps, with a little prior."""
    margins = [machine.margins(d) for d in documents]
    parents = np.repeat(np.arange(len(documents)), [len(x) for x in margins])
    rows = _summary(worst_margins(np.concatenate(margins), parents, len(documents), machine.offset))
    target = toxic.astype(float)
    v = np.zeros(rows.shape[1])
    for _ in range(50):
        p = 0.5 * (1 + np.tanh(np.clip(rows @ v, -30, 30) / 2))
        gradient = rows.T @ (p - target) + 0.1 * v
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(len(v)), gradient)
        v = v - step / max(1.0, np.abs(step).max())
    machine.calibration = v
    return machine


def _summary(margins: np.ndarray) -> np.ndarray:
    return np.column_stack([margins[:, 0], margins.mean(axis=1), np.ones(len(margins))])


def _held(key: str) -> Column:
    return fold(F.col(key), FOLDS) == HELD_OUT


def labelled(labels: DataFrame, key: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """(key, toxic) of the rows outside the held-out fold whose labels are all 0 or all 1."""
    known = labels.where(F.col(key).isNotNull() & F.col(toxic).isin(0, 1) & ~_held(key))
    ends = known.groupBy(key).agg(F.min(toxic).alias("_least"), F.max(toxic).alias("_most"))
    return ends.where("_least = _most").select(key, (F.col("_most") == 1).alias("toxic"))


def train(
    df: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> Machine | None:
    """The machine for the texts of ``df`` whose keys are in ``known`` (key, toxic); None without both kinds.

    Of each kind the keys of lowest hash are taken, so many as ``settings`` says, and of their rows as many again.
    """
    there = keep_rows(known, df.where(F.col(key).isNotNull()).select(key), key)
    chosen = [there.where("toxic").orderBy(F.xxhash64(key), key).limit(settings.toxic)]
    chosen.append(there.where("NOT toxic").orderBy(F.xxhash64(key), key).limit(settings.clean))
    ids = chosen[0].union(chosen[1]).toDF("_key", "_toxic")
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.join(F.broadcast(ids), F.col("key") == F.col("_key")).select("_toxic", F.xxhash64("key", "text").alias("draw"), "text")
    most = settings.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = words_of(_lowered(batch.column(2).slice(i, 1)))[0].to_pylist()
                if len(words) > most:
                    words = sorted(words, key=lambda w: (zlib.crc32(w.encode()), w))[:most]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, 1).columns[:2], pa.array(["\n".join(sorted(words))])], ["toxic", "draw", "words"]
                )

    sample = rows.mapInArrow(tidy(run), "toxic boolean, draw long, words string").distinct()
    # Ordered, so that the sample and with it the model is the same whichever task ends first.
    taken = sample.orderBy("draw", "words").limit(settings.toxic + settings.clean).collect()
    if not taken:
        return None
    return fit([r.words.split("\n") if r.words else [] for r in taken], np.array([r.toxic for r in taken]), settings)


def score(df: DataFrame, machine: Machine | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): the probability that a whole text is toxic, for every row; 1/2 without a machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in runs_of(batch.column(1), GROUP_BYTES):
                part = batch.slice(start, length)
                if machine is None:
                    scores = np.full(length, 0.5)
                else:
                    scores = machine.probability(text_margins(machine, part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["key", "score"])

    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(tidy(run), schema).withColumnRenamed("key", key)


def rate(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``df``.

    The fold of the key's crc32 modulo 3 that is 1 is held out: neither its labels nor its texts are learned from. Null
    and empty texts are scored like texts without any bad word; however long ones are read whole; repeated rows
    stay and score alike; rows labelled both ways teach nothing; without labels of both kinds all scores are 1/2; a
    row without a key isn't held out; an empty table gives an empty one. Columns other than key and text aren't looked at.
    """
    scored = score(df, train(df, labelled(labels, key), key, text), key, text)
    return scored.select(
        key,
        F.coalesce(_held(key), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
