"""Near-duplicate documents by DartMinHash signatures, banded joins and an exact check.

Darts are thrown at the plane of weight and rank above every element (a word shingle): how
many fall into a cell of that plane, and where, follows from hashes of element and cell alone. A
document keeps the darts below its elements' weights; each belongs to one of k coordinates, and
the earliest per coordinate is the signature. Two documents agree on a coordinate with
probability equal to their weighted Jaccard similarity. Only about ``k ln k + 2k`` darts are looked at,
however many elements there are: the rank up to which cells are opened shrinks with the total weight, and is
doubled for the few documents that miss a coordinate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.chunks import key_runs, tidy
from holdfast.llm.common import components, sieve, two_hashes, without
from holdfast.session import materialise

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 5
# In buckets of three documents and more, members are also dealt by so many finer keys of so many more coordinates.
FINER, FINER_ROWS = 4, 2
# Pairs whose signatures agree this much less than the threshold (four to five standard errors) aren't checked exactly.
MARGIN = 0.2
# So many members of a bucket are compared with one another, or with so many others, at once; and shingles at a time.
TILE, COLUMNS = 512, 4_096
ROWS_OUT = 2_000

_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)]
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64 for i in range(1, WORDS + 3)], dtype=np.uint64)
# Ranks below 1 are cut at powers of two from this one on; above, cells are one wide.
_FIRST = 6


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64's finaliser, elementwise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _cells(most: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower ends and widths of the rank cells up to ``most`` at least."""
    low = [0.0, *(2.0 ** (i - _FIRST) for i in range(_FIRST))]
    if most > 1:
        low += [float(i) for i in range(1, math.ceil(most))]
    ends = np.array([*low[1:], low[-1] * 2 if low[-1] < 1 else low[-1] + 1])
    low = np.array(low)
    used = low < most
    return low[used], (ends - low)[used]


def dart_signature(elements: np.ndarray, weights: np.ndarray | None, k: int) -> np.ndarray:
    """k 32-bit values for a set of uint64 elements; weights default to 1 and must be positive."""
    if weights is not None:
        # Weight is cut into cells of one; each is thrown at like an element of its own, the last up to its part.
        whole = np.ceil(weights).astype(np.int64)
        at = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
        part = np.minimum(np.repeat(weights, whole) - at, 1.0)
        elements = np.repeat(elements, whole) + mixed(at.astype(np.uint64)) * (at > 0)
        total = float(weights.sum())
    else:
        part, total = None, float(len(elements))
    most = (k * math.log(k) + 2 * k) / total
    with np.errstate(over="ignore"):
        while True:
            low, width = _cells(most)
            cell = mixed(elements[:, None] + mixed(np.arange(1, len(low) + 1, dtype=np.uint64) * _MIX[2])[None, :])
            u = _unit(cell)
            chance = np.exp(-width)
            row, column = np.nonzero(u >= chance)
            u, hashes, wide = u[row, column], cell[row, column], width[column]
            count, term, below = np.ones(len(row), dtype=np.int64), chance[column] * wide, chance[column]
            below = below + term
            while (more := u >= below).any() and count.max() < 64:
                count += more
                term = term * wide / np.maximum(count, 1)
                below = np.where(more, below + term, np.inf)
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            dart = mixed(np.repeat(hashes, count) + (nth + 1).astype(np.uint64) * _MIX[2])
            if part is not None:
                inside = _unit(mixed(dart + _ODD[0])) < np.repeat(part[row], count)
                dart, row, column = dart[inside], np.repeat(row, count)[inside], np.repeat(column, count)[inside]
            else:
                column = np.repeat(column, count)
            rank = low[column] + width[column] * _unit(mixed(dart + _ODD[1]))
            place = (mixed(dart + _ODD[2]) % np.uint64(k)).astype(np.int64)
            latest_first = np.argsort(-rank, kind="stable")
            found = np.zeros(k, dtype=np.int64)
            found[place[latest_first]] = latest_first + 1
            if found.all():
                return (dart[found - 1] >> np.uint64(32)).astype(np.uint32)
            most *= 2


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words are one run."""
    n = len(words)
    with np.errstate(over="ignore"):
        if n < size:
            return mixed(np.array([(words * _ODD[:n]).sum(dtype=np.uint64) + _ODD[size] * np.uint64(n)])) if n else words
        total = words[: n - size + 1] * _ODD[0]
        for i in range(1, size):
            total = total + words[i : n - size + 1 + i] * _ODD[i]
        return np.unique(mixed(total))


def words_of(text: Column) -> Column:
    """Hashes of a text's words: lower case, cut at white space."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _by_document(df: DataFrame, compute, result: list[T.StructField]) -> DataFrame:
    """Run ``compute`` on each row's word hashes; the other columns are carried along."""
    carried = [c for c in df.columns if c != "words"]
    schema = T.StructType([*(df.schema[c] for c in carried), *result])
    types = {"n": pa.int32(), "signature": pa.list_(pa.int32()), "shingles": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(first, ROWS_OUT)
                words = batch.column(len(carried))
                ends = np.concatenate([[0], np.cumsum(words.value_lengths().fill_null(0).to_numpy())])
                flat = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                rows = [compute(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                made = [pa.array(list(values), type=types[f.name]) for f, values in zip(result, zip(*rows))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(carried))), *made], [f.name for f in schema.fields]
                )

    return df.select(*carried, "words").mapInArrow(tidy(run), schema)


def _signed(words: np.ndarray, k: int) -> tuple:
    found = shingles(words)
    return len(found), dart_signature(found, None, k).view(np.int32) if len(found) else None


def _bucket_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (bucket, doc, n): each bucket's smallest document with every other, and the members of buckets of three and more
    with that smallest one.

    Buckets are reduced to a count and two documents; none is ever listed.
    """
    who = F.struct("doc", "n")
    buckets = materialise(
        members.groupBy("bucket")
        .agg(F.count("*").alias("members"), F.min(who).alias("lowest"), F.max(who).alias("highest"))
        .where("members > 1"),
        "buckets",
    )
    twos = buckets.where("members = 2").select(
        F.col("lowest.doc").alias("a"), F.col("lowest.n").alias("n_a"), F.col("highest.doc").alias("b"), F.col("highest.n").alias("n_b")
    )
    large = buckets.where("members > 2").select("bucket", "lowest")
    larger = materialise(sieve(members, "bucket", large.select("bucket")).join(large, "bucket"), "larger")
    stars = larger.select(
        F.col("lowest.doc").alias("a"), F.col("lowest.n").alias("n_a"), F.col("doc").alias("b"), F.col("n").alias("n_b")
    )
    return twos.union(stars), larger


def near_pairs(signed: DataFrame, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(a, b), a below b: documents of (doc, n, signature) that share a band and may reach the threshold, and the
    members of large buckets.

    A first pass that links most of a group of near copies with few comparisons; ``rest_links`` gives what it leaves out.
    """
    signature = F.col("signature")
    key = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, F.slice(signature, b * rows + 1, F.lit(rows)))
    )
    members = signed.select("doc", "n", F.posexplode(key).alias("band", "bucket"))
    pairs, larger = _bucket_pairs(members)
    again = F.concat(signature, signature)
    finer = F.transform(
        F.sequence(F.lit(0), F.lit(FINER - 1)),
        lambda i: F.xxhash64(
            "bucket", i, F.slice(again, (F.col("band") + 1) * rows + i * FINER_ROWS + 1, F.lit(FINER_ROWS))
        ),
    )
    dealt = (
        larger.select("doc", "n", "band", "bucket")
        .join(sieve(signed.select("doc", "signature"), "doc", larger.select("doc")), "doc")
        .select("doc", "n", F.explode(finer).alias("bucket"))
    )
    both = pairs.union(_bucket_pairs(dealt)[0])
    # A set can only be this similar to one of nearly its own size.
    fits = F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b")
    found = materialise(both.where((F.col("a") < F.col("b")) & fits).select("a", "b").distinct(), "candidates")
    left, right = (
        sieve(signed, "doc", found.select(c)).select(F.col("doc").alias(c), signature.alias(f"s_{c}")) for c in ("a", "b")
    )
    alike = F.size(F.filter(F.arrays_zip("s_a", "s_b"), lambda s: s["s_a"] == s["s_b"]))
    alike_enough = alike >= (threshold - MARGIN) * bands * rows
    return found.join(left, "a").join(right, "b").where(alike_enough).select("a", "b"), larger


def _common(group: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each of the rows ``left`` has in common with each of the rows ``right``.

    Shingles of one row alone can't be common; the others are counted some thousand at a time.
    """
    lists = group.column("shingles").combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    number = np.cumsum(times > 1) - 1
    owner, column = owner[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        held = np.zeros((len(sizes), COLUMNS), dtype=np.float32)
        held[owner[a:b], column[a:b] - first] = 1
        out += held[left] @ held[right].T
    return out


def _merged(group: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) whose classes links inside the group make one, j's the lower; at most one for each class."""
    n, tile = (group.column(c).to_numpy() for c in ("n", "tile"))
    of_class, row, place = np.unique(group.column("class").to_numpy(), return_index=True, return_inverse=True)
    x, y = (group.column(c)[0].as_py() for c in ("x", "y"))
    left, right = np.nonzero(tile == x)[0], np.nonzero(tile == y)[0]
    apart = place[left, None] != place[None, right]
    if not apart.any():
        return row[:0], row[:0]
    common = _common(group, left, right)
    linked = apart & (common >= threshold * (n[left, None] + n[None, right] - common))
    i, j = np.nonzero(linked)
    i, j = place[left[i]], place[right[j]]
    roots = np.arange(len(of_class))
    while True:
        low = np.minimum(roots[i], roots[j])
        after = roots.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        if (after == roots).all():
            break
        roots = after
    moved = np.nonzero(roots != np.arange(len(roots)))[0]
    return row[moved], row[roots[moved]]


def rest_links(signed: DataFrame, larger: DataFrame, classes: DataFrame, source: DataFrame, threshold: float) -> DataFrame:
    """(a, b): classes of ``classes`` (by a document of each) that pairs in large buckets link, checked exactly.

    Members of one class need no comparing, nor does a bucket's smallest document, which met all others. Every
    other pair is compared by its shingles, in tiles over many tasks. A tile gives no pairs but a spanning forest of the
    classes that its links make one, so at most one row for each class it holds.
    """
    of_doc = classes.select(F.col("node").alias("doc"), F.col("component").alias("class"))
    others = larger.where(F.col("doc") != F.col("lowest.doc")).select("bucket", "doc", "n")
    others = materialise(
        others.join(of_doc, "doc", "left").withColumn("class", F.coalesce("class", "doc")), "bucket-classes"
    )
    mixed = materialise(
        others.groupBy("bucket")
        .agg(F.ceil(F.count("*") / TILE).alias("tiles"), F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low != high")
        .select("bucket", "tiles"),
        "mixed-buckets",
    )
    left_apart = materialise(sieve(others, "bucket", mixed.select("bucket")).join(mixed, "bucket"), "left-apart")
    placed = (
        left_apart.join(_shingle_sets(source, left_apart.select("doc").distinct()), "doc")
        .withColumn("tile", F.pmod(F.xxhash64("doc"), F.col("tiles")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumns({"x": F.least("tile", "other"), "y": F.greatest("tile", "other")})
        .select("bucket", "x", "y", "tile", "doc", F.size("shingles").alias("n"), "class", "shingles")
    )
    grouped = placed.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    doc = signed.schema["doc"].dataType
    schema = T.StructType([T.StructField("a", doc), T.StructField("b", doc)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_runs(batches, ["bucket", "x", "y"]):
            i, j = _merged(group, threshold)
            if len(i):
                docs = group.column("doc").combine_chunks()
                yield pa.RecordBatch.from_arrays([docs.take(pa.array(i)), docs.take(pa.array(j))], ["a", "b"])

    return grouped.mapInArrow(tidy(run), schema).distinct()


def _shingle_sets(source: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc, shingles) of the documents in the one-column table ``ids``."""
    # An inner join, because the optimizer would move a semi join below the sieve and shuffle every text.
    wanted = sieve(source, "doc", ids).join(ids.toDF("doc"), "doc").select("doc", words_of(F.col("text")).alias("words"))
    words = wanted.groupBy("doc").agg(F.min_by("words", F.struct(*two_hashes(F.col("words")))).alias("words"))
    fields = [T.StructField("shingles", T.ArrayType(T.LongType()))]
    return materialise(_by_document(words, lambda w: (shingles(w).view(np.int64),), fields), "shingles")


def _links(source: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` whose texts' shingles reach the threshold, by exact Jaccard similarity."""
    sets = _shingle_sets(source, pairs.select("a").union(pairs.select("b")).distinct())
    left, right = (sets.select(F.col("doc").alias(c), F.col("shingles").alias(f"s_{c}")) for c in ("a", "b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(common >= F.lit(threshold) * (F.size("s_a") + F.size("s_b") - common))
        .select("a", "b")
    )


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(key, class_id): for every row the smallest key of the documents it is linked to, directly or not.

    Two documents are linked if the Jaccard similarity of their distinct shingles of five words (lower
    case, cut at white space; fewer words are one shingle) is at least ``threshold``, which is checked exactly. Equal
    texts are one document for all of this. Pairs are found if they share a band of the signature: at 0.8 all but
    4 in 10,000, at 0.9 all but 2 in 100 million. Of a band's bucket every pair is compared that isn't in one class already:
    many different texts that share a band without being near copies are compared by the square of their number, in
    tiles, but what a tile gives never exceeds its members. Null, empty and
    blank texts have no words and are copies of one another, rows without a key have no class, repeated rows stay, rows of
    one key are one document, other columns are left out. An empty table gives an empty result; a very long text counts with all
    its shingles.
    """
    k = bands * rows
    source = df.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    hashed = source.select("doc", words_of(F.col("text")).alias("words"))
    one, two = two_hashes(F.col("words"))
    hashed = hashed.select("doc", one.alias("h1"), two.alias("h2"), "words")
    fields = [T.StructField("n", T.IntegerType()), T.StructField("signature", T.ArrayType(T.IntegerType()))]
    signed = materialise(_by_document(hashed, lambda words: _signed(words, k), fields), "signed")
    texts = (
        signed.where("doc IS NOT NULL")
        .groupBy("h1", "h2")
        .agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    )
    texts = materialise(texts, "texts")
    # Should one key have several texts, the one of lowest hash speaks for it here and below.
    one_each = (
        texts.groupBy("doc").agg(F.min_by(F.struct("n", "signature"), F.struct("h1", "h2")).alias("t")).select("doc", "t.*")
    )
    one_each = one_each.where("n > 0")
    pairs, larger = near_pairs(one_each, threshold, bands, rows)
    pairs = materialise(pairs, "pairs")
    classes = components(_links(source, pairs, threshold))
    rest = materialise(rest_links(one_each, larger, classes, source, threshold), "rest-links")
    if not rest.isEmpty():
        known = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
        classes = components(known.union(rest))
    of_text = texts.select("h1", "h2", F.col("doc").alias("node")).join(classes, "node", "left")
    of_text = of_text.select("h1", "h2", F.coalesce("component", "node").alias("class_id"))
    return signed.select("doc", "h1", "h2").join(of_text, ["h1", "h2"], "left").select(
        F.col("doc").alias(key), F.when(F.col("doc").isNotNull(), F.coalesce("class_id", "doc")).alias("class_id")
    )


def first_of_each(df: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``df`` whose key is that of their class, and rows without a key; all columns.

    Rows of one key stay or go together. The smallest key of a class stays, an empty table stays empty.
    """
    found = near_duplicates(df, text, key, **settings)
    others = found.where(F.col("class_id") < F.col(key)).select(key).distinct()
    return without(df, key, materialise(others, "later-copies"))
