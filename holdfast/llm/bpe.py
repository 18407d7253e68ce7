"""Byte-level BPE encoding and decoding without replaying merges.

A sequence of tokens is the encoding of its bytes exactly if each pair of
neighbours is: if the merges, run on the bytes of the two, give the two back. So
the tokens that start at each byte are looked up with an Aho-Corasick automaton
(bytes as Latin-1 characters), the longest is tried first, a pair's compatibility is
worked out once and remembered, and a place from which nothing fits is marked and
left by one step back. A prefix has one encoding only, so no place is left twice
and the work is linear in the bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.chunks import ChunkCache, current, groups, texts_of, tidy

RANKS = "byte_bpe_50k.tiktoken"
# Entries after which what is remembered about pairs and words is forgotten; only speed depends on them.
PAIR_ROOM, WORD_ROOM = 2_000_000, 200_000


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


class MergeTable:
    """Encoder and decoder for one table of ranks, which must hold every single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self._split = regex.compile(pattern)
        self._automaton = ahocorasick.Automaton()
        for piece, rank in ranks.items():
            self._automaton.add_word(piece.decode("latin-1"), (len(piece), rank))
        self._automaton.make_automaton()
        self._fits: dict[tuple[int, int], bool] = {}
        self._words: dict[str, bytes] = {}

    def merged(self, data: bytes) -> list[int]:
        """The merges as defined: join the neighbours of lowest rank, leftmost first, until none can be."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are beside each other."""
        pair = (left, right)
        known = self._fits.get(pair)
        if known is None:
            if len(self._fits) > PAIR_ROOM:
                self._fits.clear()
            known = self._fits[pair] = self.merged(self.pieces[left] + self.pieces[right]) == [left, right]
        return known

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one piece of text that the pattern doesn't cut."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, token in self._automaton.iter(data.decode("latin-1")):
            starts[end - token[0] + 1].append(token)
        known, fits = self._fits, self.fits
        blocked = bytearray(n + 1)
        ids: list[int] = []
        tried: list[int] = []  # for each id, its place among the tokens that start where it does
        at, choice, last = 0, len(starts[0]) - 1 if n else -1, -1
        while at < n:
            if choice < 0:
                blocked[at] = 1
                at -= len(self.pieces[ids.pop()])
                choice = tried.pop() - 1
                last = ids[-1] if ids else -1
                continue
            length, token = starts[at][choice]
            if not blocked[at + length] and (last < 0 or (known.get((last, token)) or fits(last, token))):
                ids.append(token)
                tried.append(choice)
                at, last = at + length, token
                choice = len(starts[at]) - 1 if at < n else -1
            else:
                choice -= 1
        return ids

    def _word(self, word: str) -> bytes:
        ids = self._words.get(word)
        if ids is None:
            ids = np.array(self.encode_bytes(word.encode()), dtype="<u4").tobytes()
            if len(word) <= 32:
                if len(self._words) > WORD_ROOM:
                    for old in list(self._words)[WORD_ROOM // 2 :]:
                        del self._words[old]
                self._words[word] = ids
        return ids

    def encode_all(self, chunks: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk, cut by the pattern first."""
        word = self._word
        return [
            word(chunk) if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha())
            else b"".join([word(piece) for piece in self._split.findall(chunk)])
            for chunk in chunks
        ]


def _cache(raw: bytes, pattern: str) -> ChunkCache:
    return current((raw, pattern), lambda: ChunkCache(MergeTable(read_ranks(raw), pattern).encode_all))


@lru_cache(maxsize=1)
def _pieces(raw: bytes) -> dict[int, bytes]:
    return {rank: piece for piece, rank in read_ranks(raw).items()}


def _ranks(df: DataFrame, path: str | None):
    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, under 1 MB


def encode(
    df: DataFrame, text: str = "text", key: str = "doc_id", ranks_path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(key, ids): the ids of every whole text, special tokens read as ordinary text.

    A null or empty text has no ids (an empty array). Repeated rows give repeated
    rows, other columns are left out, an empty table gives an empty one. Each
    text is encoded where it is read, without a shuffle.
    """
    ranks, pattern = _ranks(df, ranks_path), pattern or public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(ranks.value, pattern)
        for batch in batches:
            done = 0
            for texts in groups(texts_of(batch.column(1))):
                encoded = cache.encode(texts)
                ends = np.cumsum([0, *(len(ids) // 4 for ids in encoded)], dtype=np.int32)
                ids = pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"), type=pa.int32())
                keys = batch.column(0).slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(ends, ids)], ["key", "ids"])

    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return source.mapInArrow(tidy(run, keep_cache=True), schema).withColumnRenamed("key", key)


def decode(
    df: DataFrame, ids: str = "ids", key: str = "doc_id", ranks_path: str | None = None
) -> DataFrame:
    """(key, ids, bytes): the bytes the ids stand for. Null ids are no ids; an unknown id is an error."""
    ranks = _ranks(df, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _pieces(ranks.value).__getitem__
        for batch in batches:
            column = batch.column(1)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy()
            out, at = [], 0
            for n in ends.tolist():
                out.append(b"".join(map(piece, flat[at : at + n].tolist())))
                at += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), column, pa.array(out, type=pa.binary())], ["key", "ids", "bytes"]
            )

    source = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    schema = T.StructType([*source.schema.fields, T.StructField("bytes", T.BinaryType())])
    return source.mapInArrow(tidy(run, keep_cache=True), schema).withColumnRenamed("key", key)
