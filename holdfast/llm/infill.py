"""Fill-in-middle examples: texts cut into prefix, middle and suffix at line ends and put in another order.

Everything between the draw and the joined text is done column by column in Arrow: a batch's texts become
lists of lines, the lists are flattened beside their row and place, each line gets its part
by its place, and the lines of a part are gathered into lists again and joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.chunks import runs_of, tidy

# Texts of a batch are cut together up to so many bytes (one longer text alone).
GROUP_BYTES = 16_000_000
DRAWS = ("cut_one", "cut_two", "takes_part", "form_draw")


@dataclass(frozen=True)
class Settings:
    """Which texts are rearranged and how; rates are in hundredths.

    ``rate`` of the texts take part, of them ``suffix_first`` with the suffix first. A text that holds a marker
    never takes part, so that it can be rebuilt.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    salt: str = "7:"
    rate: int = 100
    suffix_first: int = 50


def draws(key: Column, salt: str) -> list[Column]:
    """Four numbers of 32 bits from the sha256 of salt and key; a null key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [
        F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(name) for i, name in enumerate(DRAWS)
    ]


def _joined(*parts: pa.Array | str) -> pa.Array:
    return pc.binary_join_element_wise(*parts, "")


def _gathered(units: pa.Array, part: np.ndarray, wanted: int, counts: np.ndarray) -> pa.Array:
    """The units of one part, joined row by row; ``counts`` says how many each row has."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(offsets, units.filter(pa.array(part == wanted))), "")


def rearrange_arrays(texts: pa.Array, drawn: list[np.ndarray], s: Settings) -> list[pa.Array]:
    """Line count, form, characters of prefix and middle, and output of each of the (not null) texts."""
    pieces = pc.split_pattern(texts, "\n")
    counts = pc.list_value_length(pieces).to_numpy().astype(np.int64)
    flat, parents = pc.list_flatten(pieces), pc.list_parent_indices(pieces).to_numpy()
    starts = np.cumsum(counts) - counts
    places = np.arange(len(flat)) - starts[parents]
    # A line keeps its line end; what follows the last one is a line only if there is anything.
    last = places == counts[parents] - 1
    rest = pc.binary_length(flat.take(pa.array(starts + counts - 1))).to_numpy() == 0
    lines = _joined(flat, pc.if_else(pa.array(last), "", "\n"))
    there = ~(last & rest[parents])
    lines, parents, places = lines.filter(pa.array(there)), parents[there], places[there]
    n = counts - rest

    one, two = drawn[0] % (n + 1), drawn[1] % (n + 1)
    first, second = np.minimum(one, two), np.maximum(one, two)
    part = (places >= first[parents]).astype(np.int8) + (places >= second[parents])
    prefix, middle, suffix = (
        _gathered(lines, part, i, count) for i, count in enumerate((first, second - first, n - second))
    )

    marked = np.zeros(len(texts), dtype=bool)
    for marker in (s.prefix, s.suffix, s.middle):
        marked |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
    plain = pa.array((n == 0) | marked | (drawn[2] % 100 >= s.rate))
    suffix_first = pa.array(drawn[3] % 100 < s.suffix_first)
    moved = pc.if_else(
        suffix_first,
        _joined(s.suffix, suffix, s.prefix, prefix, s.middle, middle),
        _joined(s.prefix, prefix, s.suffix, suffix, s.middle, middle),
    )
    unless_plain = pa.scalar(None, pa.int64())
    return [
        pa.array(n),
        pc.if_else(plain, "plain", pc.if_else(suffix_first, "spm", "psm")),
        pc.if_else(plain, unless_plain, pc.utf8_length(prefix).cast(pa.int64())),
        pc.if_else(plain, unless_plain, pc.utf8_length(middle).cast(pa.int64())),
        pc.if_else(plain, texts, moved),
    ]


def restore_arrays(outputs: pa.Array, forms: pa.Array, s: Settings) -> pa.Array:
    """The texts that ``rearrange_arrays`` made ``outputs`` of, form by form."""

    def halves(column: pa.Array, marker: str) -> tuple[pa.Array, pa.Array]:
        """What stands before and after the first marker."""
        split = pc.split_pattern(column, marker, max_splits=1)
        return pc.list_element(split, 0), pc.list_element(split, 1)

    found, rows = [], []
    for form, lead, between in (("plain", "", ""), ("psm", s.prefix, s.suffix), ("spm", s.suffix, s.prefix)):
        here = pc.equal(forms, form)
        rows.append(np.nonzero(here.to_numpy(zero_copy_only=False))[0])
        part = outputs.filter(here)
        if form != "plain" and len(part):
            one, rest = halves(pc.utf8_slice_codeunits(part, len(lead)), between)
            two, middle = halves(rest, s.middle)
            prefix, suffix = (one, two) if form == "psm" else (two, one)
            part = _joined(prefix, middle, suffix)
        found.append(part)
    back = np.argsort(np.concatenate(rows))
    return pa.concat_arrays(found).take(pa.array(back))


def _texts(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(pa.string()), "")


def rearrange(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) for every row of ``df``; other columns aren't looked at.

    A text's n lines (each with its line end) are cut at two places drawn from its key, so the same key and text
    give the same output wherever they are. ``psm`` is prefix, suffix, middle, each after its marker, ``spm``
    suffix, prefix, middle; ``plain`` is the text as it is: an empty or null one, one that holds a marker, or one not
    drawn to take part. Repeated rows stay and come out alike; a null key draws like an empty one; very long
    texts are cut alone and whole; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in runs_of(batch.column(1), GROUP_BYTES):
                part = batch.slice(start, length)
                drawn = [c.to_numpy() for c in part.columns[2:]]
                made = rearrange_arrays(_texts(part.column(1)), drawn, settings)
                yield pa.RecordBatch.from_arrays([part.column(0), *made], schema.names)

    source = df.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), *draws(F.col(key), settings.salt)
    )
    schema = T.StructType(
        [
            T.StructField("key", df.schema[key].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )
    return source.mapInArrow(tidy(run), schema).withColumnRenamed("key", key)


def restore(df: DataFrame, settings: Settings = Settings(), name: str = "restored") -> DataFrame:
    """``df``, which has the columns form and output of ``rearrange``, with the exact texts these were made of.

    A null text comes back as the empty one.
    """
    at = [df.columns.index(c) for c in ("output", "form")]
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in runs_of(batch.column(at[0]), GROUP_BYTES):
                part = batch.slice(start, length)
                outputs, forms = (part.column(i).cast(pa.string()) for i in at)
                yield pa.RecordBatch.from_arrays([*part.columns, restore_arrays(outputs, forms, settings)], schema.names)

    return df.mapInArrow(tidy(run), schema)
