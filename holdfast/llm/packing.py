"""Packing tokenised examples into sequences under several limits at once.

Vector bin packing with the dot-product heuristic: an example is a vector (tokens,
segments, loss-bearing tokens), and what a sequence can still take is one too. The
sequence being filled takes, of the examples that fit in every dimension, the one
whose vector has the largest dot product with the room left, each dimension in units
of its limit. When none fits, an example is cut and its first part fills the rest.

Each task packs the rows it reads with a bounded number of waiting examples. Nothing
is shuffled or gathered, no example waits for another task, and at most one sequence
of a task stays partly filled.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from holdfast.llm.chunks import ChunkCache, current, groups, texts_of, tidy

VOCABULARY = "byte_bpe_50k.json"
# Ends every example.
END_ID = 0
# Examples that wait in a task; when so many wait, sequences are filled until half are left.
WAITING = 512
ROWS_OUT = 2_000
# Sequence numbers are the task's number times this, and a count.
PER_TASK = 1 << 33


@dataclass(frozen=True)
class Limits:
    """What one sequence can hold."""

    tokens: int = 1024
    segments: int = 256
    loss_tokens: int = 1024


class ChunkEncoder:
    """Ids of chunks as a vocabulary file of the tokenizers library gives them.

    Where the file is plain byte-level BPE whose merges stand in the order of their
    ids, the merges are run by tiktoken on all chunks at once, several times faster with the
    same ids. Any other file, chunks that hold an added token, and chunks that end in
    white space go to the library itself.
    """

    def __init__(self, vocabulary: str):
        self._tokenizer = Tokenizer.from_str(vocabulary)
        whole = json.loads(vocabulary)
        self._added = [token["content"] for token in whole["added_tokens"]]
        ranks = self._ranks(whole)
        self._fast = None
        if ranks:
            self._fast = tiktoken.Encoding(
                "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
            self._sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
            self._sizes[list(ranks.values())] = [len(piece) for piece in ranks]

    @staticmethod
    def _ranks(whole: dict) -> dict[bytes, int] | None:
        """Token bytes to id, if ids alone say which merge comes first."""
        model, before = whole["model"], whole["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and before.get("type") == "ByteLevel"
            and before.get("use_regex")
            and not before.get("add_prefix_space")
            and not (whole["normalizer"] or model.get("dropout") or model.get("ignore_merges"))
            and not any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in whole["added_tokens"])
        )
        if not plain:
            return None
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on in order.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        byte_of = {chr(b if b in printable else next(others)): b for b in range(256)}
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        order = [model["vocab"].get(a + b, -1) for a, b in pairs]
        if order != sorted(set(order)) or len(order) + 256 != len(model["vocab"]):
            return None
        return {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}

    def encode_all(self, chunks: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk."""
        by_library = [
            i
            for i, chunk in enumerate(chunks)
            if self._fast is None
            or not chunk
            or chunk[0] != " "
            or chunk[-1].isspace()
            or any(token in chunk for token in self._added)
        ]
        out: list[bytes] = [b""] * len(chunks)
        found = self._tokenizer.encode_batch_fast([chunks[i] for i in by_library], add_special_tokens=False)
        for i, x in zip(by_library, found):
            out[i] = np.array(x.ids, dtype="<u4").tobytes()
        for i in by_library:
            chunks[i] = ""
        if self._fast is not None:
            # Each of the others starts with a space after a non-space character: joined, they are cut there.
            ids = np.array(self._fast.encode_ordinary("".join(chunks)), dtype="<u4")
            ends = np.cumsum([len(chunk.encode()) for chunk in chunks])
            stops = np.searchsorted(np.cumsum(self._sizes[ids]), ends, side="right").tolist()
            data, at = ids.tobytes(), 0
            for i, stop in enumerate(stops):
                if stop > at:
                    out[i], at = data[4 * at : 4 * stop], stop
        return out


def _chunk_cache(vocabulary: str) -> ChunkCache:
    return current(vocabulary, lambda: ChunkCache(ChunkEncoder(vocabulary).encode_all))


Batches = Iterator[pa.RecordBatch]


def _texts(df: DataFrame, text: str, key: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


def _tokeniser(df: DataFrame, path: str | None, end_id: int) -> Callable[[Batches], Batches]:
    """From batches of (key, text) to batches of (key, tokens, n_prompt)."""
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        vocabulary = df.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, under 2 MB
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Batches) -> Batches:
        cache = _chunk_cache(vocabulary.value)
        for batch in batches:
            done = 0
            for texts in groups(texts_of(batch.column(1))):
                tokens = pa.array([ids + end for ids in cache.encode(texts)], type=pa.binary())
                keys = batch.column(0).slice(done, len(texts))
                done += len(texts)
                prompts = pa.array([1] * len(texts), type=pa.int32())
                yield pa.RecordBatch.from_arrays([keys, tokens, prompts], ["key", "tokens", "n_prompt"])

    return run


def tokenise(
    df: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """(key, tokens, n_prompt): each whole text's ids and ``end_id``, as little-endian unsigned 32-bit binary.

    Null and empty texts have the end id alone. ``n_prompt``, the ids at the start that
    bear no loss, is 1: nothing predicts a document's first id. Repeated rows stay, other
    columns are left out, an empty table gives an empty one, a very long text keeps all its ids.
    """
    fields = [T.StructField("tokens", T.BinaryType()), T.StructField("n_prompt", T.IntegerType())]
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), *fields])
    run = tidy(_tokeniser(df, path, end_id), keep_cache=True)
    return _texts(df, text, key).mapInArrow(run, schema).withColumnRenamed("key", key)


class Packer:
    """Fills sequences from examples that come one by one; ``rows`` is what is placed."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits = limits
        self._next = first_sequence
        self._caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        # Waiting examples: what of them is left, from start on.
        self._needs: list[tuple[int, int, int]] = []
        self._held: list[tuple] = []
        self.rows: list[tuple] = []

    def _place(self, example: tuple, start: int, length: int, sequence: int, offset: int) -> None:
        key, data, _, n = example
        self.rows.append((key, start, length, data[4 * start : 4 * (start + length)], n, sequence, offset))

    def _loss(self, example: tuple, start: int, length: int) -> int:
        return max(0, start + length - max(start, example[2]))

    def _longest(self, example: tuple, start: int, tokens: int, loss: int) -> int:
        """How many ids from ``start`` on fit into so many tokens and loss-bearing tokens."""
        return min(tokens, example[3] - start, max(0, example[2] - start) + loss)

    def add(self, key, data: bytes, n_prompt: int) -> None:
        """Cut whole sequences off a long example; what is left waits."""
        example, start = (key, data, min(n_prompt, len(data) // 4), len(data) // 4), 0
        limits = self.limits
        while (left := example[3] - start) > 0:
            take = self._longest(example, start, limits.tokens, limits.loss_tokens)
            if take == limits.tokens:
                self._place(example, start, take, self._next, 0)
                self._next += 1
            else:
                self._held.append((example, start, take))
                self._needs.append((take, 1, self._loss(example, start, take)))
            start += take if take < left else left
        if len(self._held) >= WAITING:
            self.fill(WAITING // 2)

    def fill(self, leave: int) -> None:
        """Fill sequences until at most ``leave`` examples wait."""
        needs, held = np.array(self._needs, dtype=np.float64).reshape(-1, 3), self._held
        tokens, segments, loss = needs.T
        here, waits = np.ones(len(held), dtype=bool), len(held)
        while waits > leave:
            room, offset, sequence = self._caps.copy(), 0, self._next
            self._next += 1
            while room[0] > 0 and room[1] > 0:
                fits = here & (tokens <= room[0]) & (segments <= room[1]) & (loss <= room[2])
                if fits.any():
                    i = int(np.argmax(np.where(fits, needs @ (room / self._caps**2), -1.0)))
                    length = held[i][2]
                else:
                    waiting = np.where(here, tokens, 0)
                    i = int(np.argmax(waiting))
                    if not waiting[i]:
                        break
                    example, start, length = held[i]
                    length = min(length, self._longest(example, start, int(room[0]), int(room[2])))
                    if not length:
                        break
                example, start, whole = held[i]
                self._place(example, start, length, sequence, offset)
                offset += length
                room -= (length, 1, self._loss(example, start, length))
                if length < whole:
                    held[i] = (example, start + length, whole - length)
                    needs[i] = (whole - length, 1, self._loss(example, start + length, whole - length))
                else:
                    here[i] = False
                    waits -= 1
        self._held = [x for x, stays in zip(held, here) if stays]
        self._needs = [tuple(map(int, x)) for x in needs[here]]


NAMES = ["key", "start", "length", "piece", "n_tokens", "sequence_id", "offset"]


def _packer(limits: Limits) -> Callable[[Batches], Batches]:
    """From batches of (key, tokens, n_prompt) to batches of NAMES."""
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError("limits must be positive")

    def run(batches: Batches) -> Batches:
        packer = Packer(limits, TaskContext.get().partitionId() * PER_TASK)
        kind = None

        def taken() -> pa.RecordBatch:
            types = {"key": kind, "piece": pa.binary()}
            columns = [pa.array(c, type=types.get(n, pa.int64())) for n, c in zip(NAMES, zip(*packer.rows))]
            packer.rows = []
            return pa.RecordBatch.from_arrays(columns, NAMES)

        for batch in batches:
            kind = batch.column(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                packer.add(row[0], row[1] or b"", row[2] or 0)
                if len(packer.rows) >= ROWS_OUT:
                    yield taken()
        packer.fill(0)
        if packer.rows:
            yield taken()

    return run


def _pieces(df: DataFrame, key: str) -> T.StructType:
    fields = [T.StructField(n, T.BinaryType() if n == "piece" else T.LongType()) for n in NAMES[1:]]
    return T.StructType([T.StructField("key", df.schema[key].dataType), *fields])


def pack(
    df: DataFrame, limits: Limits = Limits(), key: str = "doc_id", tokens: str = "tokens", n_prompt: str = "n_prompt"
) -> DataFrame:
    """One row per piece: (key, start, length, piece, n_tokens, sequence_id, offset).

    Every id of every example lies in exactly one piece; ``piece`` has its ids as
    little-endian binary, ``start`` counts the example's ids before it, ``offset`` the ids
    before it in its sequence. Null or empty ``tokens`` give no piece, a null ``n_prompt``
    is 0, repeated rows are packed like any others. Sequence numbers are unique, not
    dense. A task that runs again packs alike if it reads its rows in the same order, as from files.
    """
    source = df.select(F.col(key).alias("key"), F.col(tokens).alias("tokens"), F.col(n_prompt).cast("int").alias("n_prompt"))
    return source.mapInArrow(tidy(_packer(limits)), _pieces(df, key)).withColumnRenamed("key", key)


def pack_texts(
    df: DataFrame,
    limits: Limits = Limits(),
    text: str = "text",
    key: str = "doc_id",
    path: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """``pack`` of ``tokenise``, in one Python worker per task, so that no ids travel between two."""
    tokens, packed = _tokeniser(df, path, end_id), _packer(limits)
    run = tidy(lambda batches: packed(tokens(batches)), keep_cache=True)
    return _texts(df, text, key).mapInArrow(run, _pieces(df, key)).withColumnRenamed("key", key)
