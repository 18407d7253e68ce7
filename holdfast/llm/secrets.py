"""Secrets in texts: known shapes, and strings that look random. Built-in functions only.

Known shapes are found by regular expressions. Beyond them, each long run of key
characters is a candidate; a window slides over it, and the counts of the characters
in the window give its Shannon entropy. When the window moves by one, one character
leaves and one comes, so the sum of ``c * log2(c)`` over the counts changes by two table
entries; sums are kept in millionths as whole numbers, so nothing drifts. Windows that
reach the limit of the candidate's character class make a span, unless the candidate
matches the allow list.

Spans are (start, end) in code points, end exclusive. Everything is computed where a
row is read: no shuffle, no row depends on another.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import fresh

# The known shapes. The first group is the secret itself where the shape has a name before it.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_CHARS = 6
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
# Bits a character a window must reach, by the characters of the whole candidate: first match counts.
CLASSES = ((r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0), (r"^[A-Za-z0-9]+$", 3.6), (r"^.*$", 3.8))
# A candidate without a digit or without a letter is a long word, a path or a number.
MIXED = r"^(?=.*[0-9])(?=.*[A-Za-z])"
ALLOWED = (
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i)example|placeholder|changeme|your[_-]?(?:key|token|secret)",
    r"(?i)0123456789|abcdefghij|(.)\1{7}",  # alphabets and fillers
)
_SCALE = 1_000_000
_GROUP = 256


def running_totals(lengths: Column) -> Column:
    """Exclusive running sums of an array of integers, in groups so that no long array is copied per element."""
    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _GROUP).cast("int")),
        lambda g: F.slice(lengths, g * _GROUP + 1, F.lit(_GROUP)),
    )

    def sums(values: Column) -> Column:
        start = F.array(F.lit(0).cast("long"))
        return F.aggregate(values, start, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    inside = F.transform(groups, sums)
    before = sums(F.transform(inside, lambda s: F.element_at(s, -1)))
    shifted = F.zip_with(
        inside, F.slice(before, F.lit(1), F.size(inside)), lambda s, base: F.transform(s, lambda x: x + base)
    )
    return F.when(F.size(lengths) > 0, F.flatten(F.transform(shifted, lambda s: F.slice(s, F.lit(1), F.size(s) - 1))))


def _found(df: DataFrame, text: str, pattern: str, name: str, group: bool) -> DataFrame:
    """Add ``name``: array of (start, end, value) of the leftmost non-overlapping matches of ``pattern``.

    ``\\G`` ties each search to the end of the one before, so gap and match follow one
    another without loss and their lengths give the offsets; a text without a further match is left after one pass.
    """
    searched = r"\G(?s:(.*?))(" + pattern + ")"
    value = 3 if group else 2
    hit = F.col(text).rlike(pattern)

    def parts(index: int) -> Column:
        return F.when(hit, F.regexp_extract_all(F.col(text), F.lit(searched), F.lit(index)))

    gaps, wholes, values, ends = (fresh(df, f"_{name}_{x}") for x in ("gaps", "wholes", "values", "ends"))
    with_parts = df.withColumns(
        {
            gaps: F.transform(parts(1), F.length),
            wholes: F.transform(parts(0), F.length),
            values: parts(value),
        }
    ).withColumn(ends, running_totals(F.col(wholes)))
    places = F.arrays_zip(
        F.col(gaps).alias("gap"), F.col(wholes).alias("whole"), F.col(values).alias("value"), F.col(ends).alias("before")
    )
    spans = F.transform(
        places,
        lambda p: F.struct(
            (p["before"] + p["gap"]).alias("start"),
            (p["before"] + p["whole"]).alias("end"),
            p["value"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return with_parts.withColumn(name, F.coalesce(spans, none)).drop(gaps, wholes, values, ends)


def _hot(candidate: Column, window: int) -> Column:
    """(first, last) in the candidate: from the first window over its limit to the end of the last; null if none is."""
    gain = [(c + 1) * math.log2(c + 1) - (c * math.log2(c) if c else 0.0) for c in range(window)]
    gains = F.array(*[F.lit(round(g * _SCALE)) for g in gain])
    chars, most = candidate["chars"], candidate["most"]

    def step(acc: Column, i: Column) -> Column:
        before = F.slice(chars, F.greatest(i - window + 2, F.lit(1)), F.least(i, F.lit(window - 1)))
        came = F.size(F.filter(before, lambda c: c == F.get(chars, i)))
        left = F.size(F.filter(before, lambda c: c == F.get(chars, i - window)))
        total = acc["total"] + F.get(gains, came) - F.when(i >= window, F.get(gains, left)).otherwise(0)
        hot = (i >= window - 1) & (total <= most)
        return F.struct(
            total.cast("long").alias("total"),
            F.when(hot & acc["first"].isNull(), i - window + 1).otherwise(acc["first"]).cast("long").alias("first"),
            F.when(hot, i + 1).otherwise(acc["last"]).cast("long").alias("last"),
        )

    start = F.struct(
        F.lit(0).cast("long").alias("total"),
        F.lit(None).cast("long").alias("first"),
        F.lit(None).cast("long").alias("last"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step)


def scan(
    df: DataFrame,
    text: str = "text",
    name: str = "spans",
    window: int = WINDOW,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """Every row with ``name`` added: array of (start, kind, end), kind a position in KINDS, sorted.

    Null and empty texts have no spans, repeated rows give repeated rows, other columns stay.
    An empty table stays empty, and a very long text is scanned whole.
    Equal spans of two kinds are both given. The allow list only holds back entropy spans.
    """
    source, hits = fresh(df, "_text"), fresh(df, "_candidates")
    found = df.withColumn(source, F.coalesce(F.col(text).cast("string"), F.lit("")))
    columns = {}
    for kind, pattern, group in (
        ("assign", ASSIGN, True),
        ("access", ACCESS, False),
        ("hex", HEX, False),
        ("entropy", CANDIDATE, False),
    ):
        columns[kind] = fresh(found, f"_{kind}")
        found = _found(found, source, pattern, columns[kind], group)

    def most(value: Column) -> Column:
        chosen = F.lit(None)
        for shape, bits in reversed(CLASSES):
            chosen = F.when(value.rlike(shape), F.lit(math.floor(window * (math.log2(window) - bits) * _SCALE))).otherwise(chosen)
        return chosen.cast("long")

    def suspect(value: Column) -> Column:
        keep = value.rlike(MIXED) & (F.length(value) >= window)
        for pattern in allowed:
            keep = keep & ~value.rlike(pattern)
        return keep

    found = found.withColumn(
        hits,
        F.transform(
            F.filter(columns["entropy"], lambda c: suspect(c["value"])),
            lambda c: F.struct(
                c["start"].alias("start"),
                F.regexp_extract_all(c["value"], F.lit("(?s)."), F.lit(0)).alias("chars"),
                most(c["value"]).alias("most"),
            ),
        ),
    ).withColumn(
        hits,
        F.transform(hits, lambda c: F.struct(c["start"].alias("start"), _hot(c, window).alias("hot"))),
    )

    def spans(column: str, kind: str, keep=None) -> Column:
        values = F.col(column) if keep is None else F.filter(column, keep)
        return F.transform(
            values,
            lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")),
        )

    by_entropy = F.transform(
        F.filter(hits, lambda c: c["hot"]["first"].isNotNull()),
        lambda c: F.struct(
            (c["start"] + c["hot"]["first"]).alias("start"),
            F.lit(KINDS.index("entropy")).alias("kind"),
            (c["start"] + c["hot"]["last"]).alias("end"),
        ),
    )
    every = F.concat(
        spans(columns["assign"], "assign", lambda s: F.length(s["value"]) >= ASSIGN_CHARS),
        spans(columns["access"], "access"),
        spans(columns["hex"], "hex"),
        by_entropy,
    )
    return found.withColumn(name, F.array_sort(every)).drop(source, hits, *columns.values())


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    said = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(said, ",")


def base_only(spans: Column) -> Column:
    """The spans of known shapes."""
    return F.filter(spans, lambda s: s["kind"] < KINDS.index("entropy"))


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, every secret in ``text`` replaced by ``mark``; overlapping spans share one."""
    spans, merged = fresh(df, "_spans"), fresh(df, "_merged")
    found = scan(df, text, spans)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def join(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.concat(
            F.slice(acc, F.lit(1), F.size(acc) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))),
        )
        added = F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))
        return F.when((F.size(acc) > 0) & (s["start"] < F.get(acc, F.size(acc) - 1)["end"]), grown).otherwise(added)

    found = found.withColumn(merged, F.aggregate(spans, none, join))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(merged, lambda s: s["end"]))
    starts = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), (b - a).cast("int")))
    clean = F.when(F.size(merged) > 0, F.array_join(kept, mark)).otherwise(F.col(text))
    return found.withColumn(text, clean).select(*df.columns)
