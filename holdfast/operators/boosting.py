"""Second-order boosted trees, many models side by side.

Columns are cut into bins of equal frequency once. A model's tree grows level by level: one aggregation adds up
gradients and Hessians by (model, node, column, bin) for all models at once, and each node takes
the cut with the largest gain under an L2 penalty. Columns are drawn per tree, rows per round by a hash of their
key, and the positive class's weight enters gradients and Hessians. Sums are of whole numbers (fixed point), so a model
is the same however rows are spread, added up or retried.

As long as all rows fit the bound ``rows_at_once``, each model is grown by one task from start to end, and the
models are what is spread; beyond it the rows are, and every level is a job. Both ways call the same
functions and give the same trees. The bound is one of memory: a task holds about 100 bytes a row of nine columns,
400 MB at most. Rows are worked on in strips, so that what is computed for them stays in a core's cache.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.ordering import running_totals
from holdfast.session import materialise, shared_root
from holdfast.sources.schemas import KEY

# The helpers below travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bins of a column, so that a bin is one byte.
BINS = 256
# Whole numbers to one unit of gradient: sums stay exact below 10^10 rows of weight 10.
UNIT = 1 << 24
# Rows of one block, rows of one task when levels are jobs, and after how many rounds the rows' margins are written.
BLOCK_ROWS = 50_000
ROWS_PER_TASK = 2_000_000
WRITTEN_ROUNDS = 10
ROWS_AT_ONCE = 4_000_000
# Rows worked on at a time.
STRIP_ROWS = 16_384
# Up to so many nodes of a level of at least so many rows are told apart by comparing whole columns, others by looking up each
# row's node.
FEW_NODES = 8
MANY_ROWS = 4_096
# A split must gain more than this.
LEAST_GAIN = 1e-6

NODE = np.dtype(
    [("left", "<i4"), ("right", "<i4"), ("feature", "<i2"), ("cut", "<i2"), ("grad", "<i8"), ("hess", "<i8"), ("gain", "<f8")]
)


@dataclass(frozen=True)
class Params:
    """A booster's parameters by their usual names."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    scale_pos_weight: float = 1.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0


@dataclass(frozen=True)
class Fit:
    """One model to grow: its parameters, and the fold it doesn't see but is judged on (None: it sees all rows)."""

    params: Params
    held: int | None = None


@dataclass
class Grown:
    """A fitted model's trees, and the area under the ROC curve on the held fold."""

    trees: list[np.ndarray] = field(default_factory=list)
    area: float | None = None


@dataclass
class Rows:
    """Rows of one or more blocks; ``bins`` has a line per column."""

    bins: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    hashes: np.ndarray

    def of(self, fit: Fit) -> np.ndarray:
        """Which rows a model learns from."""
        return np.ones(len(self.label), dtype=bool) if fit.held is None else self.fold != fit.held

    def at(self, places: np.ndarray) -> Rows:
        """Some of the rows."""
        return Rows(self.bins.take(places, axis=1), *(x.take(places) for x in (self.label, self.fold, self.hashes)))


def _strips(n: int) -> Iterator[slice]:
    return (slice(start, min(start + STRIP_ROWS, n)) for start in range(0, n, STRIP_ROWS))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Mix the bits, in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def sampled(hashes: np.ndarray, share: float, seed: int, round_: int) -> np.ndarray:
    """Rows drawn for a round: the same whichever model, task or attempt asks."""
    if share >= 1:
        return np.ones(len(hashes), dtype=bool)
    salt = _mixed(np.array([seed * 1_000_003 + round_ + 1], dtype=np.uint64))
    # The upper 53 bits are a fraction of 1, which is compared as a whole number.
    bound = np.uint64(math.ceil(share * 2.0**53) << 11)
    keys, out = hashes.view(np.uint64), np.empty(len(hashes), dtype=bool)
    for strip in _strips(len(keys)):
        np.less(_mixed(keys[strip] ^ salt), bound, out=out[strip])
    return out


def drawn_columns(n: int, share: float, seed: int, round_: int) -> np.ndarray:
    """Columns drawn for a tree, at least one."""
    order = np.argsort(_mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(7919) + np.uint64(seed * 1_000_003 + round_)))
    return np.sort(order[: max(1, int(share * n))])


def gradients(margin: np.ndarray, label: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the logistic loss by the margin, in whole units."""
    grad, hess = np.empty(len(margin)), np.empty(len(margin))
    weights = np.array([1.0, params.scale_pos_weight])
    for strip in _strips(len(margin)):
        g, h, y = grad[strip], hess[strip], label[strip]
        p = np.tanh(margin[strip] / 2)
        p += 1
        p *= 0.5
        np.subtract(p, y, out=g)
        np.subtract(1, p, out=h)
        if params.scale_pos_weight != 1:
            weight = weights.take(y)
            g *= weight
            p *= weight
        h *= p
        for units in (g, h):
            units *= UNIT
            np.rint(units, out=units)
    return grad, hess


def some_rows(bins: np.ndarray, columns: Iterable[int], rows: np.ndarray) -> np.ndarray:
    """The bins of some rows side by side; columns that aren't asked for are left unset."""
    if len(rows) == bins.shape[1]:
        return bins
    out = np.empty((len(bins), len(rows)), dtype=bins.dtype)
    for c in columns:
        bins[c].take(rows, out=out[c], mode="clip")
    return out


def root(n: int, nodes: int) -> np.ndarray:
    """Rows that are all in the root of a tree of at most so many nodes; a byte each if that is enough."""
    return np.zeros(n, dtype=np.uint8 if nodes <= 256 else np.int64)


def step(node: np.ndarray, bins: np.ndarray, tree: np.ndarray, level: Sequence[int]) -> None:
    """Take the rows in a level's nodes, all of them split, one level further down; rows elsewhere stay.

    Children have larger numbers than the nodes of their parents' level, so rows that have moved aren't met again.
    """
    few, kind = len(level) <= FEW_NODES and len(node) >= MANY_ROWS, node.dtype.type
    if few:
        splits = [(kind(k), int(tree["feature"][k]), int(tree["cut"][k]), kind(tree["left"][k] - k)) for k in level]
    else:
        inner = np.zeros(len(tree), dtype=bool)
        inner[list(level)] = True
        # A row elsewhere leads to itself.
        first = np.where(inner, tree["feature"], 0).astype(np.int64) * bins.shape[1]
        cut = np.where(inner, tree["cut"], BINS - 1).astype(np.uint8)
        left = np.where(inner, tree["left"], np.arange(len(tree))).astype(node.dtype)
        flat = bins.reshape(-1)
    for strip in _strips(len(node)):
        at = node[strip]
        if few:
            for k, feature, last, move in splits:
                here = at == k
                at += here * move
                here &= bins[feature, strip] > last
                at += here
        else:
            was = at.astype(np.intp)
            place = first.take(was)
            place += np.arange(strip.start, strip.stop)
            right = flat.take(place) > cut.take(was)
            left.take(was, out=at, mode="clip")
            at += right


def reached(tree: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The node each row ends in."""
    node, level = root(bins.shape[1], len(tree)), np.zeros(1, dtype=np.int64)
    while len(level := level[tree["feature"][level] >= 0]):
        step(node, bins, tree, level.tolist())
        level = np.concatenate([tree["left"][level], tree["right"][level]])
    return node


def leaf_values(tree: np.ndarray, params: Params) -> np.ndarray:
    return -params.learning_rate * tree["grad"] / (tree["hess"] + params.reg_lambda * UNIT)


def _groups(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Runs of slots, first and behind the last, of at most STRIP_ROWS rows together, or a single larger one."""
    first = together = 0
    for slot, size in enumerate(sizes):
        if slot > first and together + size > STRIP_ROWS:
            yield first, slot
            first, together = slot, 0
        together += size
    if len(sizes):
        yield first, len(sizes)


def histogram(
    bins: np.ndarray, rows: np.ndarray | range, sizes: Sequence[int], grad: np.ndarray, hess: np.ndarray, columns: Sequence[int]
) -> np.ndarray:
    """Sums of gradient and Hessian, by (slot, column, bin) each; whole numbers below 2^53 add up exactly.

    ``rows`` has the numbers of each slot's rows, one slot after the other, and ``sizes`` how many each has. A range stands for
    rows that lie side by side.
    """
    out, ends = np.zeros((2, len(sizes), len(columns), BINS)), np.cumsum([0, *sizes]).tolist()
    for first, last in _groups(sizes):
        slots = last - first
        offset = np.repeat(np.arange(slots) * BINS, sizes[first:last]) if slots > 1 else None
        for strip in _strips(ends[last] - ends[first]):
            some = rows[ends[first] + strip.start : ends[first] + strip.stop]
            aside = isinstance(some, range)
            at = slice(some.start, some.stop) if aside else some
            g, h = (grad[at], hess[at]) if aside else (grad.take(at), hess.take(at))
            for i, c in enumerate(columns):
                cell = (bins[c, at] if aside else bins[c].take(at)).astype(np.intp)
                if offset is not None:
                    cell += offset
                for sums, values in zip(out, (g, h)):
                    sums[first:last, i] += np.bincount(cell, values, minlength=slots * BINS).reshape(slots, BINS)
    return out


def _score(grad: np.ndarray, hess: np.ndarray, params: Params) -> np.ndarray:
    return (grad / UNIT) ** 2 / (hess / UNIT + params.reg_lambda)


def best_splits(sums: np.ndarray, columns: np.ndarray, cuts: Sequence[int], params: Params) -> list[tuple | None]:
    """For each slot (gain, column, cut, left gradient and Hessian, whole ones), or None where nothing is gained.

    ``columns`` are those of ``sums``; a cut leaves a value on the right. Equal gains go to the first column, then to the
    lowest cut.
    """
    left = sums.cumsum(axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left
    least = params.min_child_weight * UNIT
    gain = 0.5 * (_score(*left, params) + _score(*right, params) - _score(*whole, params))
    usable = np.arange(BINS) < np.asarray(cuts)[columns][:, None]
    gain[~((left[1] >= least) & (right[1] >= least) & usable)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    out: list[tuple | None] = []
    for slot, at in enumerate(best.tolist()):
        column, cut = divmod(at, BINS)
        if not flat[slot, at] > LEAST_GAIN:
            out.append(None)
            continue
        l, w = left[:, slot, column, cut], whole[:, slot, 0, 0]
        out.append((float(flat[slot, at]), int(columns[column]), cut, int(l[0]), int(l[1]), int(w[0]), int(w[1])))
    return out


class Tree:
    """A tree that grows: nodes in the order in which they came up, and those of the last level."""

    def __init__(self, grad: int = 0, hess: int = 0):
        self.nodes: list[list] = [[-1, -1, -1, -1, grad, hess, 0.0]]
        self.open = [0]

    def grow(self, splits: dict[int, tuple | None]) -> None:
        """Split the open nodes that have a split; the children are open next."""
        following = []
        for node in self.open:
            if split := splits.get(node):
                gain, column, cut, grad, hess, all_grad, all_hess = split
                at = len(self.nodes)
                self.nodes[node] = [at, at + 1, column, cut, all_grad, all_hess, gain]
                self.nodes.append([-1, -1, -1, -1, grad, hess, 0.0])
                self.nodes.append([-1, -1, -1, -1, all_grad - grad, all_hess - hess, 0.0])
                following += [at, at + 1]
        self.open = following

    def may_split(self, node: int, params: Params) -> bool:
        """Whether the node could be cut in two halves of enough weight."""
        return self.nodes[node][5] >= 2 * params.min_child_weight * UNIT

    def array(self) -> np.ndarray:
        return np.array([tuple(n) for n in self.nodes], dtype=NODE)


def grow_tree(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, columns: np.ndarray, cuts: Sequence[int], p: Params) -> tuple:
    """A tree from the rows drawn for it, and the node each of them ends in.

    Each node keeps the numbers of its rows. Of two sisters only the one with fewer rows is added up; the other's sums are what
    their parent's leave.
    """
    tree, parts = Tree(int(grad.sum()), int(hess.sum())), {0: range(len(grad))}
    nodes: list[int] = []
    sums = np.zeros((2, 0, len(columns), BINS))
    for level in range(p.max_depth):
        if level == 0:
            if not tree.may_split(0, p):
                break
            nodes, sums = [0], histogram(bins, parts[0], [len(grad)], grad, hess, columns)
        else:
            pairs = [(slot, tree.nodes[n][0]) for slot, n in enumerate(nodes) if tree.nodes[n][2] >= 0]
            pairs = [(slot, n) for slot, n in pairs if tree.may_split(n, p) or tree.may_split(n + 1, p)]
            if not pairs:
                break
            small = [n + int(len(parts[n + 1]) < len(parts[n])) for _, n in pairs]
            added = histogram(bins, np.concatenate([parts[n] for n in small]), [len(parts[n]) for n in small], grad, hess, columns)
            sums = np.concatenate([added, sums[:, [slot for slot, _ in pairs]] - added], axis=1)
            nodes = small + [2 * n + 1 - s for (_, n), s in zip(pairs, small)]
        was = tree.open
        tree.grow(dict(zip(nodes, best_splits(sums, columns, cuts, p))))
        for n in was:
            left, _, feature, cut = tree.nodes[n][:4]
            if left >= 0:
                parts[left], parts[left + 1] = parted(parts.pop(n), bins[feature], cut)
        if not tree.open:
            break
    node = root(len(grad), len(tree.nodes))
    for n, part in parts.items():
        node[slice(part.start, part.stop) if isinstance(part, range) else part] = n
    return tree.array(), node


def parted(rows: np.ndarray | range, bins: np.ndarray, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """A node's rows up to a cut and beyond it."""
    whole = isinstance(rows, range)
    right = (bins if whole else bins.take(rows)) > cut
    sides = np.flatnonzero(~right), np.flatnonzero(right)
    return sides if whole else (rows.take(sides[0]), rows.take(sides[1]))


def grow_here(rows: Rows, fit: Fit, cuts: Sequence[int], seed: int) -> Grown:
    """One model from all its rows."""
    p, learns, trees = fit.params, rows.of(fit), []
    held, rows = rows.at(np.flatnonzero(~learns)), rows.at(np.flatnonzero(learns))
    margin = np.zeros(len(rows.label))
    for round_ in range(p.n_estimators):
        drawn = sampled(rows.hashes, p.subsample, seed, round_)
        taken, others = np.flatnonzero(drawn), np.flatnonzero(~drawn)
        before = margin.take(taken)
        grad, hess = gradients(before, rows.label.take(taken), p)
        columns = drawn_columns(len(cuts), p.colsample_bytree, seed, round_)
        tree, node = grow_tree(some_rows(rows.bins, columns, taken), grad, hess, columns, cuts, p)
        trees.append(tree)
        values = leaf_values(tree, p)
        add_values(before, node, values)
        margin[taken] = before
        if len(others):
            before = margin.take(others)
            used = np.unique(tree["feature"][tree["feature"] >= 0])
            add_values(before, reached(tree, some_rows(rows.bins, used, others)), values)
            margin[others] = before
    return Grown(trees, area(margins(trees, p, held.bins), held.label) if len(held.label) else None)


def margins(trees: Iterable[np.ndarray], params: Params, bins: np.ndarray) -> np.ndarray:
    """The log-odds of class 1, block by block."""
    total, made = np.zeros(bins.shape[1]), [(tree, leaf_values(tree, params)) for tree in trees]
    for start in range(0, len(total), BLOCK_ROWS):
        some, sums = bins[:, start : start + BLOCK_ROWS].copy(), total[start : start + BLOCK_ROWS]
        for tree, values in made:
            add_values(sums, reached(tree, some), values)
    return total


def add_values(margin: np.ndarray, node: np.ndarray, values: np.ndarray) -> None:
    """Add to rows' margins the values of their nodes."""
    for strip in _strips(len(node)):
        margin[strip] += values.take(node[strip])


def area(score: np.ndarray, label: np.ndarray) -> float | None:
    """Area under the ROC curve, ties counting half; None without both classes."""
    values, place, counts = np.unique(score, return_inverse=True, return_counts=True)
    bad = np.bincount(place, label == 1, minlength=len(values))
    good = counts - bad
    if not bad.sum() or not good.sum():
        return None
    return float((bad * (np.cumsum(good) - good / 2)).sum() / (bad.sum() * good.sum()))


def cut_points(rows: DataFrame, columns: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Per column the upper ends of its bins but the last: equal values stay together, bins hold about as many rows.

    Exact and the same on every run: distinct values are counted, ordered globally, and dealt by the rows before them.
    """
    entries = [F.struct(F.lit(i).alias("feature"), F.col(c).alias("value")) for i, c in enumerate(columns)]
    counted = rows.select(F.inline(F.array(*entries))).groupBy("feature", "value").agg(F.count("*").alias("n"))
    placed = running_totals(counted, [F.col("value")], {"upto": "n"}, ["feature"], with_totals=True)
    bin_ = F.floor((F.col("upto") - F.col("n")) * bins / F.col("upto_total"))
    # At most so many bins a column.
    ends = placed.groupBy("feature", bin_.alias("bin")).agg(F.max("value").alias("value")).collect()
    found: list[list[float]] = [[] for _ in columns]
    for r in ends:
        found[r.feature].append(r.value)
    return [np.sort(np.array(f))[:-1] for f in found]


_BLOCK = "n long, bins binary, label binary, fold binary, hashes binary"
_BYTES = ("bins", "label", "fold", "hashes")


def blocks_of(rows: DataFrame, columns: Sequence[str], cuts: list[np.ndarray]) -> DataFrame:
    """(n, bins, label, fold, hashes): the rows packed into blocks, each value as the number of its bin."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                if waiting and sum(w.num_rows for w in waiting) + part.num_rows > BLOCK_ROWS:
                    yield packed(waiting)
                    waiting = []
                waiting.append(part)
        if waiting:
            yield packed(waiting)

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        hashes, label, fold, *values = (c.to_numpy() for c in table.columns)
        bins = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, values)]).astype(np.uint8)
        block = [bins, label.astype(np.uint8), fold.astype("<i4"), hashes.astype("<i8")]
        return pa.RecordBatch.from_arrays(
            [pa.array([table.num_rows]), *(pa.array([x.tobytes()], type=pa.binary()) for x in block)],
            ["n", "bins", "label", "fold", "hashes"],
        )

    fold = F.col("fold") if "fold" in rows.columns else F.lit(-1)
    wide = rows.select(
        F.xxhash64(KEY).alias("_hash"), F.col("label").cast("int"), fold.cast("int"), *[F.col(c).cast("double") for c in columns]
    )
    return wide.mapInArrow(pack, _BLOCK)


def _rows_of(blocks: Iterable[Sequence[bytes]], columns: int) -> Rows:
    """The rows of blocks given as (bins, label, fold, hashes)."""
    bins, label, fold, hashes = zip(*blocks)
    return Rows(
        np.concatenate([np.frombuffer(b, dtype="u1").reshape(columns, -1) for b in bins], axis=1),
        np.frombuffer(b"".join(label), dtype="u1"),
        np.frombuffer(b"".join(fold), dtype="<i4"),
        np.frombuffer(b"".join(hashes), dtype="<i8"),
    )


def fit_many(
    rows: DataFrame, columns: Sequence[str], fits: Sequence[Fit], seed: int = 42, rows_at_once: int = ROWS_AT_ONCE,
    with_trees: bool = True,
) -> tuple[list[Grown], list[np.ndarray]]:
    """The models for ``fits`` and the cuts they use; ``rows`` has key, label (0 or 1), the columns (not null) and fold.

    A driver's share is the cuts and, if asked for, the trees, whose sizes follow from the parameters alone.
    """
    cuts = cut_points(rows, columns)
    blocks = materialise(blocks_of(rows, columns, cuts), "blocks")
    n = blocks.agg(F.sum("n")).first()[0] or 0
    sizes = [len(c) for c in cuts]
    if n <= rows_at_once:
        return _grow_by_model(blocks, list(fits), sizes, seed, with_trees), cuts
    return _grow_by_level(blocks, n, list(fits), sizes, seed, with_trees), cuts


def _grow_by_model(blocks: DataFrame, fits: list[Fit], sizes: list[int], seed: int, with_trees: bool) -> list[Grown]:
    # A task for each model, those of most work first. Each reads the blocks where they were written: nothing is shuffled.
    work = [f.params.n_estimators * (5 + f.params.max_depth) for f in fits]
    order = sorted(range(len(fits)), key=lambda i: -work[i])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, task = [], None
        for batch in batches:
            task, *values = (c.to_pylist() for c in batch.columns)
            found += zip(*values)
        if not found:
            return
        fit = order[task[0]]
        grown = grow_here(_rows_of(found, len(sizes)), fits[fit], sizes, seed)
        trees = [t.tobytes() for t in grown.trees] if with_trees else []
        arrays = [pa.array([fit], type=pa.int32()), pa.array([grown.area], type=pa.float64()), pa.array([trees], type=pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(arrays, ["model", "area", "trees"])

    models = blocks.sparkSession.range(0, len(fits), 1, len(fits)).hint("shuffle_replicate_nl")
    met = models.crossJoin(blocks.select(*_BYTES).coalesce(1))
    found = met.mapInArrow(grow, "model int, area double, trees array<binary>").collect()
    by_model = {r.model: Grown([np.frombuffer(t, dtype=NODE) for t in r.trees], r.area) for r in found}
    return [by_model.get(i, Grown()) for i in range(len(fits))]


def _grow_by_level(
    blocks: DataFrame, n: int, fits: list[Fit], sizes: list[int], seed: int, with_trees: bool
) -> list[Grown]:
    """Every level is a job over the blocks, which stay cached beside the margins of all models after the last round.

    A task adds up its blocks, tasks are added up by (model, node), and what comes back is a split per open node. Margins are
    written every few rounds, so that a lost executor costs those rounds at most.
    """
    columns, nodes_of_model = len(sizes), 1 << (max(f.params.max_depth for f in fits) + 1)
    context = blocks.sparkSession.sparkContext
    tasks = max(context.defaultParallelism, -(-n // ROWS_PER_TASK))
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(blocks.sparkSession))
    # Blocks are large, a task has few of them: they are dealt evenly, once.
    dealt = blocks.select(*_BYTES).repartition(tasks).rdd
    state = dealt.map(lambda block: _unseen(_rows_of([tuple(block)], columns), len(fits))).persist(StorageLevel.MEMORY_AND_DISK)
    grown, before = [Grown() for _ in fits], None

    def sums_by_node(round_: int, partial: dict[int, np.ndarray], open_: dict[int, list[int]]):
        """(model and node in one number, sums) of the open nodes; a model whose tree isn't begun has its root open."""

        def run(blocks: Iterator[tuple[Rows, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
            found: dict[int, np.ndarray] = {}
            for rows, margins in blocks:
                for model, nodes in open_.items():
                    p = fits[model].params
                    slot_of = np.full(len(partial[model]), -1)
                    slot_of[nodes] = np.arange(len(nodes))
                    slot = slot_of.take(reached(partial[model], rows.bins))
                    drawn = rows.of(fits[model]) & sampled(rows.hashes, p.subsample, seed, round_)
                    taken = np.flatnonzero(drawn & (slot >= 0))
                    grad, hess = gradients(margins[model].take(taken), rows.label.take(taken), p)
                    drawn = drawn_columns(columns, p.colsample_bytree, seed, round_)
                    slot = slot.take(taken)
                    bins, sizes_here = some_rows(rows.bins, drawn, taken), np.bincount(slot, minlength=len(nodes)).tolist()
                    sums = histogram(bins, np.argsort(slot, kind="stable"), sizes_here, grad, hess, drawn)
                    found[model] = found[model] + sums if model in found else sums
            for model, sums in found.items():
                for slot, node in enumerate(open_[model]):
                    yield model * nodes_of_model + node, sums[:, slot]

        return run

    def split(round_: int):
        def run(found: tuple[int, np.ndarray]) -> tuple[int, int, tuple | None, int, int]:
            (model, node), sums = divmod(found[0], nodes_of_model), found[1][:, None]
            p = fits[model].params
            best = best_splits(sums, drawn_columns(columns, p.colsample_bytree, seed, round_), sizes, p)[0]
            return model, node, best, *(int(x) for x in sums[:, 0, 0].sum(axis=1))

        return run

    for round_ in range(max(f.params.n_estimators for f in fits)):
        trees = {i: Tree() for i, f in enumerate(fits) if round_ < f.params.n_estimators}
        for level in range(max(fits[i].params.max_depth for i in trees)):
            open_ = {
                i: [node for node in t.open if level == 0 or t.may_split(node, fits[i].params)]
                for i, t in trees.items()
                if level < fits[i].params.max_depth
            }
            open_ = {i: nodes for i, nodes in open_.items() if nodes}
            if not open_:
                break
            partial = {i: trees[i].array() for i in open_}
            sums = state.mapPartitions(sums_by_node(round_, partial, open_))
            wide = min(tasks, sum(map(len, open_.values())))
            # At most one row per model and open node.
            found = sums.reduceByKey(np.add, wide, int).map(split(round_)).collect()
            if before is not None:
                before.unpersist()
                before = None
            splits: dict[int, dict[int, tuple | None]] = {i: {} for i in open_}
            for model, node, best, grad, hess in found:
                splits[model][node] = best
                if level == 0:
                    trees[model] = Tree(grad, hess)
            for i in open_:
                trees[i].grow(splits[i])
        made = {i: tree.array() for i, tree in trees.items()}
        if with_trees:
            for i, tree in made.items():
                grown[i].trees.append(tree)
        before, state = state, state.map(_with_trees(made, fits)).persist(StorageLevel.MEMORY_AND_DISK)
        if (round_ + 1) % WRITTEN_ROUNDS == 0:
            state.checkpoint()

    if any(f.held is not None for f in fits):
        for i, value in _areas(_judged(blocks.sparkSession, state, fits)).items():
            grown[i].area = value
    for kept in (before, state):
        if kept is not None:
            kept.unpersist()
    return grown


def _unseen(rows: Rows, models: int) -> tuple[Rows, np.ndarray]:
    return rows, np.zeros((models, len(rows.label)))


def _with_trees(made: dict[int, np.ndarray], fits: list[Fit]):
    """Add each model's new tree to its margins."""

    def run(block: tuple[Rows, np.ndarray]) -> tuple[Rows, np.ndarray]:
        rows, margins = block[0], block[1].copy()
        for model, tree in made.items():
            add_values(margins[model], reached(tree, rows.bins), leaf_values(tree, fits[model].params))
        return rows, margins

    return run


def _judged(spark: SparkSession, state: RDD, fits: list[Fit]) -> DataFrame:
    """(model, labels, margins) of the rows of a block that the model didn't see, written."""

    def run(block: tuple[Rows, np.ndarray]) -> Iterator[tuple[int, bytes, bytes]]:
        rows, margins = block
        for model, fit in enumerate(fits):
            held = ~rows.of(fit)
            if held.any():
                yield model, rows.label[held].astype("<i8").tobytes(), margins[model][held].astype("<f8").tobytes()

    schema = "model int, label binary, margin binary"
    return materialise(spark.createDataFrame(state.flatMap(run), schema, verifySchema=False), "margins")


def _areas(state: DataFrame) -> dict[int, float]:
    """Exact areas on the held folds, from the margins; each row is judged by the models that didn't see it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for model, label, margin in zip(*(c.to_pylist() for c in batch.columns)):
                label, margin = np.frombuffer(label, dtype="<i8"), np.frombuffer(margin, dtype="<f8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(label), model, dtype=np.int32)), pa.array(margin), pa.array(label)],
                    ["model", "margin", "label"],
                )

    judged = state.mapInArrow(run, "model int, margin double, label long")
    counted = judged.groupBy("model", "margin").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    placed = running_totals(counted, [F.col("margin")], {"upto": "good"}, ["model"], with_totals=True)
    beaten = F.sum(F.col("bad") * (F.col("upto") - F.col("good") / 2))
    areas = placed.groupBy("model").agg((beaten / (F.sum("bad") * F.first("upto_total"))).alias("area"))
    return {r.model: r.area for r in areas.collect()}  # one row per model


@dataclass
class BoostedModel:
    """A fitted booster: its columns, parameters, cuts and trees."""

    columns: list[str]
    params: Params
    cuts: list[np.ndarray]
    trees: list[np.ndarray]

    def nodes(self) -> pd.DataFrame:
        """One row per node: tree, id, children (-1 at leaves), feature, threshold (up to it goes left), value, cover, gain."""
        tables = []
        for number, tree in enumerate(self.trees):
            inner = tree["feature"] >= 0
            threshold = [self.cuts[f][c] if f >= 0 else np.nan for f, c in zip(tree["feature"], tree["cut"])]
            tables.append(
                pd.DataFrame(
                    {
                        "tree": number,
                        "id": np.arange(len(tree)),
                        "left": tree["left"],
                        "right": tree["right"],
                        "feature": np.where(inner, tree["feature"], np.nan),
                        "threshold": np.array(threshold, dtype=float),
                        "prediction": leaf_values(tree, self.params),
                        "cover": tree["hess"] / UNIT,
                        "gain": tree["gain"],
                    }
                )
            )
        columns = ["tree", "id", "left", "right", "feature", "threshold", "prediction", "cover", "gain"]
        return pd.concat(tables, ignore_index=True) if tables else pd.DataFrame(columns=columns)

    def margin(self) -> Column:
        """The log-odds of class 1, from the model's columns."""
        cuts, params, trees = self.cuts, self.params, self.trees

        @F.pandas_udf("double")
        def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for values in batches:
                bins = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, values)]).astype(np.uint8)
                total = np.zeros(bins.shape[1])
                for tree in trees:
                    add_values(total, reached(tree, bins), leaf_values(tree, params))
                yield pd.Series(total)

        return walk(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.columns])


def fit(rows: DataFrame, columns: Sequence[str], params: Params, seed: int = 42, rows_at_once: int = ROWS_AT_ONCE) -> BoostedModel:
    """One booster on all rows."""
    (grown,), cuts = fit_many(rows.drop("fold"), columns, [Fit(params)], seed, rows_at_once)
    return BoostedModel(list(columns), params, cuts, grown.trees)


def params_of(chosen: dict[str, float]) -> Params:
    """Parameters by name; whole numbers where they count something."""
    whole = {k: int(v) for k, v in chosen.items() if k in ("n_estimators", "max_depth")}
    return replace(Params(), **{**{k: float(v) for k, v in chosen.items()}, **whole})
