"""Cutting texts where byte-level pre-tokenisation certainly cuts, so that repeated chunks are encoded once.

The pattern of these tokenizers never lets a match run from a non-space character
into a following space, and looks ahead only inside a run of white space. Before a
space that follows a non-space character a match therefore always begins, whatever
stands around it, and a text is encoded by encoding the parts between such places.
"""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Python's white space contains that of the tokenizers, so every cut found here is one for them.
CUT = re.compile(r"(?<=\S) ")
# Where it is nowhere found and no space comes first, every space is such a cut, and str.split finds them faster.
AFTER_SPACE = re.compile(r"\s ")
# Texts are handled in groups of at most so many characters, so that a batch of long ones needs no more memory.
GROUP_CHARS = 1_000_000
# Longer chunks are encoded but not kept.
KEPT_CHARS = 64


def chunks_of(text: str) -> list[str]:
    """The text cut before every space that follows a non-space character, without those spaces."""
    return CUT.split(text) if text.startswith(" ") or AFTER_SPACE.search(text) else text.split(" ")


class ChunkCache:
    """Little-endian 32-bit ids of texts; ``encode_all`` gives those of a list of chunks.

    The cache only saves work: at ``room`` entries the later half, mostly chunks
    that came once, is forgotten.
    """

    def __init__(self, encode_all: Callable[[list[str]], list[bytes]], room: int = 400_000):
        self._encode_all, self._room = encode_all, room
        self._known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        known = self._known
        parts = [chunks_of(text) for text in texts]
        # A text's first part has no space before it and is encoded as it is.
        rests = [part[1:] for part in parts]
        missing = list(set().union(*rests).difference(known))
        firsts = [part[0] for part in parts]
        encoded = self._encode_all(firsts + [" " + chunk for chunk in missing])
        here = {chunk: ids for chunk, ids in zip(missing, encoded[len(firsts) :])}
        known.update(here)
        out = [first + b"".join(map(known.__getitem__, rest)) for first, rest in zip(encoded, rests)]
        for chunk in [c for c in missing if len(c) > KEPT_CHARS]:
            del known[chunk]
        if len(known) > self._room:
            for chunk in list(known)[self._room // 2 :]:
                del known[chunk]
        return out


# The cache of this Python worker. Workers are used again by later stages, so there is one at a time.
_CURRENT: dict[Hashable, ChunkCache] = {}


def current(key: Hashable, make: Callable[[], ChunkCache]) -> ChunkCache:
    """The worker's cache for ``key``, made after another one has been let go."""
    if key not in _CURRENT:
        release()
        _CURRENT[key] = make()
    return _CURRENT[key]


def release() -> None:
    """Let the worker's cache go and give freed memory back; the allocators keep it otherwise."""
    _CURRENT.clear()
    _trim()


def _trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator], keep_cache: bool = False) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, leaving a small worker behind.

    Spark keeps several idle Python workers per executor, so what one holds on to counts several times. Only
    operators that use the worker's cache keep it for their next task.
    """

    def tidied(batches: Iterator) -> Iterator:
        if not keep_cache:
            release()
        try:
            yield from run(batches)
        finally:
            _trim()

    return tidied


def key_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of at least two rows with the same integer ``keys``, of sorted batches; a run may go on in the next batch."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        values = np.stack([table.column(c).to_numpy() for c in keys])
        starts = [0, *(np.nonzero((values[:, 1:] != values[:, :-1]).any(axis=0))[0] + 1).tolist()]
        for start, end in zip(starts[:-1], starts[1:]):
            if end - start > 1:
                yield table.slice(start, end - start)
        rest = table.slice(starts[-1]) if table.num_rows else None
    if rest is not None and rest.num_rows > 1:
        yield rest


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """A batch's texts, some hundred at a time in Python's memory."""
    for start in range(0, len(column), 500):
        yield from column.slice(start, 500).to_pylist()


def groups(texts: Iterable[str | None]) -> Iterable[list[str]]:
    """Runs of texts of at most GROUP_CHARS characters (one longer text alone); null is the empty text."""
    run, size = [], 0
    for text in texts:
        text = text or ""
        if run and size + len(text) > GROUP_CHARS:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def runs_of(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of texts of at most ``most`` bytes together; one longer text is a run of its own."""
    start = total = 0
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i - start
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes) - start
