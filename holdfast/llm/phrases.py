"""Collocations: phrases whose words stand together more often than their parts would by chance.

Documents are gathered into shards of one language. Each shard's words become numbers, and an
FM-index over them (Burrows-Wheeler transforms of the shard and of the shard read backwards) lists
its phrases by extending intervals on either side, word by word, down to a bounded depth. Counts are then
summed across shards.

So are the counts of each phrase's commonest extension to the right and to the left: no phrase one word longer can
be found more often than that sum. Only where it reaches what is asked for do shards list longer phrases at
all. And a phrase found often enough in all shards of a language has its share in at least one of them, so pairs of
words that have it nowhere aren't counted (with more shards than occurrences asked for, that leaves none out). What
may be frequent goes to the shards as a sieve of fixed size, which at most lets too much through. Counting
is by hashes of 96 bits; the words of a frequent phrase are asked of one shard that holds it.
"""

from __future__ import annotations

import functools
import itertools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.chunks import tidy
from holdfast.session import SCRATCH, materialise, shared_root

UNKNOWN = "und"
# A task holds back the texts of all languages together up to so many times a shard.
HELD = 4
# Bits of a sieve: 4 MB, whatever the data.
SIEVE_BITS = 25
# Rows of a language's ranking are first ranked in so many parts.
PARTS = 64

# A-Z in lower case, pieces end at [.,;:!?\n\v\f\r], words at blanks and tabs.
_ENDS = b".,;:!?\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + _ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(_ENDS) + b" "
)
# The numbers of a shard are kept compressed.
CODEC = "zstd"
_SHARD = "shard long, lang string, words array<string>, counts array<long>, size long, ids binary"
_HASHED = "h1 long, h2 int, f long, right long, left long, shard long"
_LISTED = "h1 long, h2 int, shard long, lang string, phrase string, n_words int"


@dataclass(frozen=True)
class Settings:
    """``least`` occurrences and at most ``longest`` words make a candidate; ``top`` are kept per language.

    A candidate goes if a longer one that holds it has at least ``share`` hundredths of its occurrences.
    Texts of one language make a shard when they reach ``shard_bytes``, and at the end of a task.
    """

    least: int = 100
    longest: int = 5
    share: int = 100
    top: int = 2_000
    shard_bytes: int = 12_000_000


class Index:
    """FM-index of word numbers, read forwards and backwards; 0 stands between pieces.

    Rows are sorted by the first ``depth`` words only: an interval of a phrase of at most so many words is
    then in its place, and can be extended by one more.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self._text, self._depth = np.concatenate([[0], text, [0]]).astype(np.int64), depth

    @cached_property
    def forward(self) -> np.ndarray:
        """The word before each row."""
        return self._transform(self._text)

    @cached_property
    def backward(self) -> np.ndarray:
        """The word after each row of the text read backwards."""
        return self._transform(self._text[::-1])

    @cached_property
    def _places_forward(self) -> np.ndarray:
        return self._places(self.forward)

    @cached_property
    def _places_backward(self) -> np.ndarray:
        return self._places(self.backward)

    def _transform(self, text: np.ndarray) -> np.ndarray:
        return text[np.argsort(self._ranks(text)) - 1]

    @staticmethod
    def _places(transform: np.ndarray) -> np.ndarray:
        """Sorted (word, row) pairs in one number, to look up how often a word stands above a row."""
        return np.sort(transform * len(transform) + np.arange(len(transform)))

    def _ranks(self, text: np.ndarray) -> np.ndarray:
        """Numbers that order the places by the ``depth`` words from there on (past the end follow zeros)."""
        ranks, width, done = text, 1, None
        depth = self._depth
        while True:
            if depth & 1:
                done = ranks if done is None else self._paired(ranks, done, width)
            depth >>= 1
            if not depth:
                return done
            ranks, width = self._paired(ranks, ranks, width), 2 * width

    @staticmethod
    def _paired(first: np.ndarray, then: np.ndarray, width: int) -> np.ndarray:
        after = np.zeros_like(then)
        after[: len(then) - width] = then[width:]
        return np.unique(first * (int(then.max()) + 1) + after, return_inverse=True)[1]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bi-intervals of all words: phrases (rows of word numbers), starts forwards and backwards, and counts."""
        found, counts = np.unique(self._text, return_counts=True)
        starts = np.cumsum(counts) - counts
        real = found > 0
        return found[real, None], starts[real], starts[real], counts[real]

    @staticmethod
    def _counted(transform: np.ndarray, own: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Which interval is extended by which word (0: by an end), and how often."""
        rows = np.repeat(own - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        size = int(transform.max()) + 1
        keys, new = np.unique(np.repeat(np.arange(len(own)) * size, counts) + transform[rows], return_counts=True)
        return keys // size, keys % size, new

    def _extended(
        self, transform: np.ndarray, places: np.ndarray, own: np.ndarray, other: np.ndarray, counts: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """Which interval is extended by which word, the new starts on both sides, and the new counts."""
        parent, word, new = self._counted(transform, own, counts)
        # Extensions by smaller words, 0 among them, stand before this one in the parent's interval on the other side.
        smaller = np.cumsum(new) - new
        start_of_parent = smaller[np.searchsorted(parent, np.arange(len(own)))]
        beside = other[parent] + smaller - start_of_parent[parent]
        real = word > 0
        parent, word, new, beside = parent[real], word[real], new[real], beside[real]
        return parent, word, np.searchsorted(places, word * len(transform) + own[parent]), beside, new

    def extend_right(self, phrases, starts, reverse, counts):
        """Bi-intervals of all phrases one word longer, the word added at the end."""
        parent, word, back, there, new = self._extended(self.backward, self._places_backward, reverse, starts, counts)
        return np.hstack([phrases[parent], word[:, None]]), there, back, new

    def extend_left(self, phrases, starts, reverse, counts):
        """Bi-intervals of all phrases one word longer, the word added at the front."""
        parent, word, there, back, new = self._extended(self.forward, self._places_forward, starts, reverse, counts)
        return np.hstack([word[:, None], phrases[parent]]), there, back, new

    def longest_extensions(self, phrases, starts, reverse, counts) -> tuple[np.ndarray, np.ndarray]:
        """The counts of each phrase's commonest extension to the right and to the left."""
        parent, word, new = (x for x in self._counted(self.backward, reverse, counts))
        parent, word, new = (x[word > 0] for x in (parent, word, new))
        right, left = (np.zeros(len(counts), dtype=np.int64) for _ in range(2))
        np.maximum.at(right, parent, new)
        if phrases.shape[1] == 1 and len(counts):
            # All pairs of words are at hand, so the other side needs no second transform.
            np.maximum.at(left, np.searchsorted(phrases[:, 0], word), new)
        else:
            parent, word, new = self._counted(self.forward, starts, counts)
            np.maximum.at(left, parent[word > 0], new[word > 0])
        return right, left


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    """Two rows of 64-bit hashes, the same in every process."""
    digests = b"".join(xxhash.xxh3_128_digest(w.encode()) for w in words)
    return np.frombuffer(digests, dtype=">u8").astype(np.uint64).reshape(-1, 2).T


def phrase_hashes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from those of their language and of their words, in order; the second has 32 bits."""
    out = lang
    for one in words:
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + one)
    return np.stack([out[0], out[1] >> np.uint64(32)])


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = hashes >> np.uint64(64 - SIEVE_BITS)
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot, bit = _slots(hashes)
    return sieve[slot] & bit != 0


def _owned(hashes: np.ndarray, shard: int) -> np.ndarray:
    return hashes ^ np.uint64((shard << (64 - SIEVE_BITS)) % (1 << 64))


def sieve_of(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes in a one-column table; at most 4 MB come to the driver."""
    h = hashes.columns[0]
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({h}, {64 - SIEVE_BITS}) & 63 as int))")
    marked = hashes.select(F.shiftrightunsigned(h, 64 - SIEVE_BITS + 6).alias("slot"), bit.alias("bit"))
    rows = marked.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (SIEVE_BITS - 6), dtype=np.uint64)
    out[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


# Sieves of the words and of the pairs that may be extended to the right and to the left.
Sieves = list[tuple[np.ndarray, np.ndarray]]


def _cut_long(text: bytes, most: int) -> Iterator[bytes]:
    """Parts of at most ``most`` bytes, cut behind ends of pieces; a longer piece stays whole."""
    start = 0
    while len(text) - start > most:
        end = text.rfind(b"\n", start, start + most) + 1 or text.find(b"\n", start + most) + 1
        if not end or end == len(text):
            break
        yield text[start:end]
        start = end
    yield text[start:]


def shard_of(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The different words of a text in lower case with ``\\n`` between pieces, and the text as their numbers.

    Numbers count from 1 in the order of the words; 0 stands between pieces.
    """
    spaced = text.replace(b"\n", b" \n ")
    offsets = pa.py_buffer(np.array([0, len(spaced)], dtype=np.int64))
    whole = pa.Array.from_buffers(pa.large_string(), 1, [None, offsets, pa.py_buffer(spaced)])
    coded = pc.list_flatten(pc.split_pattern(whole, " ")).dictionary_encode()
    known = coded.dictionary
    end, none = (pc.index(known, value).as_py() for value in ("\n", ""))
    numbers = np.zeros(len(known), dtype=np.int32)
    real = np.ones(len(known), dtype=bool)
    real[[at for at in (end, none) if at >= 0]] = False
    numbers[real] = np.arange(1, real.sum() + 1)
    ids = coded.indices.to_numpy()
    return known.filter(pa.array(real)), numbers[ids[ids != none] if none >= 0 else ids]


def _squeezed(ids: np.ndarray) -> np.ndarray:
    """``ids`` without zeros at the start and without repeated ones."""
    real = ids != 0
    return ids[real | np.concatenate([[False], real[:-1]])]


def shards(df: DataFrame, text: str = "text", lang: str = "lang", shard_bytes: int = Settings.shard_bytes) -> DataFrame:
    """(lang, words, counts, ids): the texts of ``df`` in shards of one language, each with its own word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        task, made_here = TaskContext.get().partitionId(), itertools.count()

        def made(name: str) -> pa.RecordBatch:
            words, ids = shard_of(b"".join(held.pop(name)))
            del sizes[name]
            ids = _squeezed(ids)
            counts = np.bincount(ids, minlength=len(words) + 1)[1:]
            one = np.array([0, len(words)], dtype=np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 16 | next(made_here)]),
                    pa.array([name]),
                    pa.ListArray.from_arrays(one, words.cast(pa.string())),
                    pa.ListArray.from_arrays(one, pa.array(counts, type=pa.int64())),
                    pa.array([len(ids)]),
                    pa.array([pa.compress(ids.astype("<i4"), CODEC, asbytes=True)], type=pa.binary()),
                ],
                ["shard", "lang", "words", "counts", "size", "ids"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                names = part.column(1)
                for name in pc.unique(names).to_pylist():
                    own = part.column(0).filter(pc.equal(names, name)).cast(pa.large_string())
                    ended = pc.binary_join_element_wise(own, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
                    size = np.frombuffer(ended.buffers()[1], dtype=np.int64)[len(ended)]
                    plain = ended.buffers()[2].to_pybytes()[:size].translate(_PLAIN)
                    for piece in _cut_long(plain, shard_bytes):
                        held.setdefault(name, []).append(piece)
                        sizes[name] = sizes.get(name, 0) + len(piece)
                        if sizes[name] >= shard_bytes:
                            yield made(name)
                while sum(sizes.values()) > HELD * shard_bytes:
                    yield made(max(sizes, key=sizes.get))
        while held:
            yield made(next(iter(held)))

    source = df.select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
    )
    return source.mapInArrow(tidy(run), _SHARD)


class _Shard:
    """A row of ``shards``, with what the passes over it need."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        self.number, self.lang = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
        self.words, self.counts = batch.column(2)[at].values, batch.column(3)[at].values.to_numpy()
        size = 4 * batch.column(4)[at].as_py()
        self.ids = np.frombuffer(pa.decompress(batch.column(5)[at].as_buffer(), size, CODEC), dtype="<i4")
        self._lang_hash, self._hashes = word_hashes([self.lang]), word_hashes(self.words.to_pylist())

    def hashes_of(self, phrases: np.ndarray) -> np.ndarray:
        return phrase_hashes(self._lang_hash, [self._hashes[:, column - 1] for column in phrases.T])

    def single(self) -> tuple[np.ndarray, np.ndarray]:
        """All words as phrases, and their counts."""
        return np.arange(1, len(self.words) + 1)[:, None], self.counts

    def thinned(self, sieves: Sieves, candidates: np.ndarray | None = None) -> np.ndarray:
        """The text with 0 in place of words, and between words, that can't be in a longer frequent phrase.

        ``candidates`` are all the pairs of words that may be frequent, if that is known.
        """
        if not sieves:
            return self.ids
        hashes = self.hashes_of(self.single()[0])[0]
        right, left = (np.concatenate([[False], _passes(sieve, hashes)]) for sieve in sieves[0])
        ids = _squeezed(np.where((right | left)[self.ids], self.ids, 0))
        together = right[ids[:-1]] & left[ids[1:]]
        if len(sieves) > 1 or candidates is not None:
            at = np.nonzero(together)[0]
            pairs = self.hashes_of(np.stack([ids[at], ids[at + 1]], axis=1))[0]
            may = np.ones(len(at), dtype=bool) if candidates is None else _passes(candidates, pairs)
            if len(sieves) > 1:
                may &= _passes(sieves[1][0], pairs) | _passes(sieves[1][1], pairs)
            together[at] = may
        spread = np.full(2 * len(ids), -1, dtype=ids.dtype)
        # Words that stand alone on both sides can't be in any phrase.
        spread[::2] = np.where(np.append(together, False) | np.insert(together, 0, False), ids, 0)[: len(ids)]
        spread[1:-1:2][~together] = 0
        return _squeezed(spread[spread >= 0])

    def phrases(self, index: Index, longest: int, sieves: Sieves) -> Iterator[tuple[np.ndarray, ...]]:
        """Bi-intervals of the phrases of two words and more, extended in turn to the right and to the left."""
        found = index.extend_right(*index.words())
        for length in range(2, longest + 1):
            if length > 2:
                # Both phrases of one word less must be able to grow, as far as their pairs at the ends tell.
                side, other = (slice(0, 2), slice(-2, None)) if length % 2 else (slice(-2, None), slice(0, 2))
                ahead, behind = (1, 0) if length % 2 else (0, 1)
                found = self._where(found, side, sieves[1][ahead])
                found = index.extend_left(*found) if length % 2 else index.extend_right(*found)
                found = self._where(found, side, sieves[1][behind])
            yield found

    def _where(self, found: tuple, words: slice, sieve: np.ndarray) -> tuple:
        may = _passes(sieve, self.hashes_of(found[0][:, words])[0])
        return tuple(x[may] for x in found)


def _hashed(
    sharded: DataFrame,
    lengths: range,
    sieves: Sieves,
    extended: bool,
    least: dict[str, int] | None = None,
    candidates: np.ndarray | None = None,
) -> DataFrame:
    """(h1, h2, f, right, left, shard): each shard's own counts of phrases of so many words that may be frequent.

    ``right`` and ``left`` are the counts of the commonest extensions, 0 if they aren't asked for (``extended``). Only
    phrases that the shard holds as often as ``least`` says for its language, and whose pairs may be ``candidates``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                shard = _Shard(batch, at)
                text = shard.thinned(sieves, candidates)
                if not len(text):
                    continue
                index = Index(text, max(1, lengths[-1] if extended else lengths[-1] - 1))
                for found in [index.words()] if lengths[-1] == 1 else shard.phrases(index, lengths[-1], sieves):
                    if found[0].shape[1] not in lengths:
                        continue
                    if least is not None:
                        found = tuple(x[found[3] >= least[shard.lang]] for x in found)
                    h1, h2 = shard.hashes_of(found[0])
                    counts = found[3]
                    if not len(counts):
                        continue
                    none = np.zeros(len(counts), dtype=np.int64)
                    right, left = index.longest_extensions(*found) if extended else (none, none)
                    columns = [h1.view(np.int64), h2.astype(np.uint32).view(np.int32), counts, right, left]
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, columns), pa.array(np.full(len(counts), shard.number))],
                        ["h1", "h2", "f", "right", "left", "shard"],
                    )

    return sharded.mapInArrow(tidy(run), _HASHED)


def _listed(
    sharded: DataFrame, longest: int, sieves: Sieves, candidates: np.ndarray | None, owners: np.ndarray
) -> DataFrame:
    """(h1, h2, shard, lang, phrase, n_words): the frequent phrases that a shard was asked for, and a few more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                shard = _Shard(batch, at)
                text = shard.thinned(sieves[:1], candidates)
                found = [shard.single()]
                if longest > 1 and len(text):
                    found = itertools.chain(found, shard.phrases(Index(text, longest - 1), longest, sieves))
                for phrases, *_ in found:
                    h1, h2 = shard.hashes_of(phrases)
                    asked = _passes(owners, _owned(h1, shard.number))
                    phrases, h1, h2 = phrases[asked], h1[asked], h2[asked]
                    if not len(phrases):
                        continue
                    columns = [shard.words.take(pa.array(c - 1)) for c in phrases.T]
                    n = len(phrases)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h1.view(np.int64)),
                            pa.array(h2.astype(np.uint32).view(np.int32)),
                            pa.array(np.full(n, shard.number)),
                            pa.array([shard.lang] * n, type=pa.string()),
                            pc.binary_join_element_wise(*columns, " "),
                            pa.array(np.full(n, phrases.shape[1], dtype=np.int32)),
                        ],
                        ["h1", "h2", "shard", "lang", "phrase", "n_words"],
                    )

    return sharded.mapInArrow(tidy(run), _LISTED)


def frequent(df: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, n_words, f) of every phrase of up to ``longest`` words found ``least`` times, (lang, n) of all).

    Counts are of whole texts and exact. Null texts have no words, a null language is ``und``; repeated rows count
    each; an empty table gives empty ones.
    """
    path = f"{shared_root(df.sparkSession)}/{SCRATCH}/shards-{uuid.uuid4().hex}"
    shards(df, text, lang, settings.shard_bytes).write.parquet(path)
    sharded = df.sparkSession.read.schema(_SHARD).parquet(path)
    totals = sharded.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    passes = [range(1, 2), range(2, 3), range(3, settings.longest + 1)]
    passes = [r for r in passes if r and r[0] <= settings.longest]
    # One row per language: the share of the occurrences asked for that the shard richest in a phrase has at least.
    shares = {r.lang: -(-settings.least // r["count"]) for r in sharded.groupBy("lang").count().collect()}
    sieves: Sieves = []
    levels = []
    candidates = None
    for lengths in passes:
        last = lengths[-1] == settings.longest
        if lengths[-1] == 2 and max(shares.values(), default=1) > 1:
            candidates = sieve_of(_hashed(sharded, lengths, sieves, False, least=shares).select("h1"))
        sums = [F.sum(c).alias(c) for c in ("f", "right", "left")]
        counted = _hashed(sharded, lengths, sieves, not last, candidates=candidates)
        counted = counted.groupBy("h1", "h2").agg(*sums, F.min("shard").alias("shard"))
        level = materialise(counted.where(F.col("f") >= settings.least), "phrases")
        levels.append(level.select("h1", "h2", "f", "shard"))
        if not last:
            right, left = (sieve_of(level.where(F.col(c) >= settings.least).select("h1")) for c in ("right", "left"))
            sieves.append((right, left))
        if lengths[-1] == 2:
            candidates = sieve_of(level.select("h1"))
    known = functools.reduce(DataFrame.union, levels)
    owned = F.col("h1").bitwiseXOR(F.shiftleft("shard", 64 - SIEVE_BITS)).alias("h1")
    listed = _listed(sharded, settings.longest, sieves, candidates, sieve_of(known.select(owned)))
    found = listed.join(known, ["h1", "h2", "shard"]).select("lang", "phrase", "n_words", "f")
    return materialise(found, "phrases"), totals


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two words and more.

    a, l and r are the occurrences of a phrase and of the two parts at its lowest-scoring cut (the first of
    equals), n all words of the language, the score floor(1000 * a * n / (l * r)). Phrases that a longer candidate
    takes ``share`` hundredths of go. Ties go to the higher a, then to the smaller phrase in order of bytes. Null and
    empty texts add nothing, however long ones are read whole; other columns aren't looked at; an empty
    table gives an empty one.
    """
    counted, totals = frequent(df, text, lang, settings)
    parts = counted.select("lang", "phrase", "f")
    candidates = counted.where("n_words > 1")
    cuts = candidates.join(totals, "lang").select(
        "lang", "phrase", "n_words", F.col("f").alias("a"), "n", F.explode(F.expr("sequence(1, n_words - 1)")).alias("k")
    )
    cuts = cuts.withColumns(
        {"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - n_words)")}
    )
    cuts = cuts.join(parts.toDF("lang", "first", "l"), ["lang", "first"]).join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr(
        "(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # A phrase's counts with one more word on either side; a longer one around it can't have more.
    longer = candidates.where("n_words > 2").select(
        "lang",
        "f",
        F.explode(
            F.array(F.expr("substring_index(phrase, ' ', n_words - 1)"), F.expr("substring_index(phrase, ' ', 1 - n_words)"))
        ).alias("phrase"),
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = lowest.join(most, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (100 * F.col("most") < settings.share * F.col("a"))
    )
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best)
    ranked = ranked.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= settings.top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= settings.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
