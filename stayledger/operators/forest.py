"""Random forests over binned columns, beside the boosted trees of ``boost``.

Every tree sees each row a Poisson(1) number of times (a hash of row and tree), every
node draws its own columns, and a cut takes the largest drop of weighted Gini impurity
with ``min_samples_leaf`` different rows on both sides:

    drop = GL^2 / HL + GR^2 / HR - G^2 / H      (G: weight of positives, H: weight)

A leaf is worth its share of positive weight; the forest averages its trees.  Large
tables grow groups of trees level by level, with one aggregation for all their open
nodes; a matrix measured to fit one task grows there, by the same rules.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window, functions as F

from stayledger.config import SEED
from stayledger.operators import boost
from stayledger.operators.boost import Tree, byte_rows, joint_columns  # by name, so that tasks need no package
from stayledger.session import stable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 64
DEEPEST = 30  # where the depth is left open
CELLS = 1 << 22  # cells of a group of trees that one task sums
TASK_CELLS = 1 << 16  # cells that a tree in one task sums at once
SMALL_NODES = 8, 16, 32  # rows of nodes that are summed over the bins they hold
COUNTED, LARGE_NODE = 1 << 14, 1 << 11  # rows of a matrix whose draws are counted, and of a node counted by itself
JOINT, AT_ONCE = 1 << 12, 14_000  # cells of columns counted together, and rows counted in one number
FIELD = 17  # bits: a row is drawn at most 9 times, so AT_ONCE rows have less than 2^17 draws
SMALLEST_DROP = 1e-9
#: How often a uniform number means 0, 1, 2... rows under Poisson(1).
TIMES = np.exp(-1) * np.cumsum(1 / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320], float))


class Settings(NamedTuple):
    n_estimators: int = 500
    max_depth: int | None = 8
    min_samples_leaf: int = 5
    max_features: str | float = "sqrt"
    seed: int = SEED


def column_count(width: int, s: Settings) -> int:
    if s.max_features == "sqrt":
        return max(1, int(np.sqrt(width)))
    if s.max_features == "log2":
        return max(1, int(np.log2(width)))
    return max(1, int(float(s.max_features) * width))


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(s: Settings, *parts: int) -> np.uint64:
    return np.uint64(np.random.SeedSequence([s.seed, *parts]).generate_state(1, np.uint64)[0])


def times_drawn(key: np.ndarray, tree: int, s: Settings) -> np.ndarray:
    """How often a tree sees each row."""
    with np.errstate(over="ignore"):
        x = _mixed(key.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ _salt(s, tree, 0))
    chance, times = (x >> np.uint64(11)).astype(float) * 2.0**-53, np.zeros(len(x), np.uint8)
    for t in TIMES:
        times += chance >= t
    return times


def node_columns(nodes, tree: int, width: int, s: Settings) -> np.ndarray:
    """The columns each node may cut, ascending."""
    with np.errstate(over="ignore"):
        cell = np.asarray(nodes, np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(width, dtype=np.uint64)
        chance = _mixed(cell * np.uint64(0x9E3779B97F4A7C15) ^ _salt(s, tree, 1))
    return np.sort(np.argsort(chance, axis=1, kind="stable")[:, : column_count(width, s)], axis=1)


def cell_sums(bins, columns, node, n_bins: int, values) -> list[np.ndarray]:
    """Sums of each value per (node, column place, bin); columns differ by node."""
    n_nodes, k = columns.shape
    place = (node[:, None] * k + np.arange(k)) * n_bins + np.take_along_axis(bins, columns[node], axis=1)
    flat = place.ravel()
    return [np.bincount(flat, weights=np.repeat(v, k), minlength=n_nodes * k * n_bins).reshape(n_nodes, k, n_bins) for v in values]


def best_cuts(g, h, n, s: Settings):
    """(column place, bin, drop) of each node, drop 0 where no cut is allowed."""
    left = g.cumsum(axis=2), h.cumsum(axis=2), n.cumsum(axis=2)
    return _largest_drops(*left, *(v[:, :, -1:] - v for v in left), s)


def _largest_drops(gl, hl, nl, gr, hr, nr, s: Settings):
    allowed = (nl >= s.min_samples_leaf) & (nr >= s.min_samples_leaf) & (hl > 0) & (hr > 0)
    with np.errstate(all="ignore"):
        whole = gl[:, :, -1:] ** 2 / hl[:, :, -1:]
        drop = np.divide(np.square(gl, out=gl), hl, out=gl)
        drop += np.divide(np.square(gr, out=gr), hr, out=gr)
        drop -= whole
    drop[~allowed] = 0
    bins, drop = gl.shape[2], drop.reshape(len(gl), -1)
    best = drop.argmax(axis=1)
    value = drop[np.arange(len(drop)), best]
    return best // bins, best % bins, np.where(value > SMALLEST_DROP, value, 0)


def _settle(tree: Tree, node: int, g: float, h: float) -> None:
    tree.value[node], tree.cover[node] = g / h, h


def grow_in_task(bins, y, w, key, n_bins: int, s: Settings, some: Sequence[int] | None = None) -> Iterator[Tree]:
    """All trees over one matrix, or those numbered ``some``, one at a time.

    Rows lie ordered by node, in their old order inside it, so a node's rows are known by
    their number, nodes are summed in chunks of bounded size and every cell in the same order.
    Both values of a row are the parts of one complex number, summed in one pass.  In a large
    matrix whose rows weigh alike within a class they follow from how often rows are drawn:
    those are counted, which is exact in any order (see ``_Draws``).
    """
    deepest, x = DEEPEST if s.max_depth is None else s.max_depth, np.ascontiguousarray(bins.T)
    draws = _Draws.of(x, y, w, column_count(len(x), s)) if len(y) >= COUNTED else None
    for t in range(s.n_estimators) if some is None else some:
        times = times_drawn(key, t, s)
        rows = np.flatnonzero(times)
        own, tree = np.concatenate([column.take(rows) for column in x]) if len(x) else x.ravel(), Tree()
        m = len(rows)
        if draws is None:
            gh = np.empty(m, complex)
            gh.imag = w[rows] * times[rows]
            gh.real = gh.imag * y[rows]
            held = [np.arange(m), gh]
        else:
            held = [np.arange(m), *draws.drawn(rows, times)]
        sizes, first = np.array([m]), 0  # open nodes follow each other
        if not m:
            _settle(tree, 0, 0.0, 1.0)
        for depth in range(deepest + 1 if m else 0):
            if draws is None:
                total = np.zeros(len(sizes), complex)
                np.add.at(total, np.repeat(np.arange(len(sizes)), sizes), held[1])
            else:
                total = draws.totals(held[1], sizes)
            gt, ht = total.real, total.imag
            tree.value[first:], tree.cover[first:] = (gt / ht).tolist(), ht.tolist()
            mixed = (gt > 0) & (gt < ht)
            mixed &= sizes >= 2 * s.min_samples_leaf  # others cannot be cut
            if depth == deepest or not mixed.any():
                break
            nodes = np.flatnonzero(mixed)
            if len(nodes) < len(mixed):
                sizes, *held = _kept(mixed, sizes, *held)
            columns = node_columns(nodes + first, t, len(x), s)
            if draws is None:
                c, b, drop = _node_cuts_in_task(own, m, sizes, *held, columns, n_bins, s)
            else:
                c, b, drop = draws.node_cuts(sizes, *held[1:], columns=columns, n_bins=n_bins, s=s)
            cut = drop > 0
            if not cut.any():
                break
            column = columns[np.arange(len(nodes)), c]
            at, first = (nodes + first)[cut], len(tree.column)
            tree.cut_all(at.tolist(), column[cut].tolist(), b[cut].tolist(), drop[cut].tolist())
            here, column, b, sizes = np.flatnonzero(np.repeat(cut, sizes)), column[cut], b[cut], sizes[cut]
            # both sides of every node, one after the other, rows in their old order
            right = own.take(np.repeat(column * m, sizes) + held[0].take(here)) > np.repeat(b.astype(np.uint8), sizes)
            starts = np.cumsum(sizes) - sizes
            n_right = np.add.reduceat(right, starts, dtype=np.intp)
            sizes = np.stack([sizes - n_right, n_right], axis=1).ravel()
            order, side = np.empty(len(here), np.intp), np.repeat(np.arange(len(sizes)) % 2 == 1, sizes)
            for its, met in ((~side, ~right), (side, right)):
                order[np.flatnonzero(its)] = here.take(np.flatnonzero(met))
            held = [v.take(order) for v in held]
        yield tree


class _Draws:
    """Rows that weigh alike within a class, counted by how often they are drawn.

    A row's kind is 2 x draws + class.  Rows, draws and draws of positives of up to ``AT_ONCE``
    rows are fields of one whole number below 2^53, so one weighted count sums all three
    exactly.  In large nodes columns of few bins are one number and counted together
    (``joint_columns``).
    """

    def __init__(self, positive, weights, joint, places):
        self.positive, self.weights, self.joint, self.places = positive.astype(np.uint8), weights, joint, places
        times = np.repeat(np.arange(len(TIMES) + 1), 2)
        positive = np.arange(len(times)) % 2
        self.packed = (1 + (times << FIELD) + (times * positive << 2 * FIELD)).astype(float)
        self.times = np.stack([times * positive, times * (1 - positive)], axis=1)

    @classmethod
    def of(cls, x, y, w, k: int) -> _Draws | None:
        """None where rows of a class differ in weight, there are other classes, or the joint
        numbers of all columns are more than what ``k`` columns of a node repay."""
        positive, weights = y == 1, []
        if not (positive | (y == 0)).all():
            return None
        for own in (w[~positive], w[positive]):
            weights.append(float(own[0]) if len(own) else 1.0)
            if (own != weights[-1]).any():
                return None
        joint, places = joint_columns(x, JOINT)
        return cls(positive, weights, joint, places) if len(joint) <= 2 * k else None

    def drawn(self, rows, times) -> list[np.ndarray]:
        """What is held of the rows: their kind, and their joint columns."""
        return [2 * times[rows] + self.positive[rows], *(code.take(rows) for code in self.joint)]

    def sums(self, positives, negatives) -> tuple[np.ndarray, np.ndarray]:
        g = self.weights[1] * positives
        return g, g + self.weights[0] * negatives

    def totals(self, kind, sizes) -> np.ndarray:
        """The sums of nodes whose rows lie one after the other."""
        many = len(self.packed)
        seen = np.bincount(np.repeat(np.arange(len(sizes)) * many, sizes) + kind, minlength=len(sizes) * many)
        total = np.empty(len(sizes), complex)
        total.real, total.imag = self.sums(*(seen.reshape(-1, many) @ self.times).T)
        return total

    def node_cuts(self, sizes, kind, *joint, columns, n_bins: int, s: Settings):
        """``best_cuts`` of nodes whose rows lie one after the other."""
        large = sizes >= LARGE_NODE
        found = np.empty(len(sizes), np.intp), np.empty(len(sizes), np.intp), np.empty(len(sizes))
        if large.any():
            ends, nodes = np.cumsum(sizes), np.flatnonzero(large)
            step = max(1, TASK_CELLS // (columns.shape[1] * n_bins))
            for some in (nodes[a : a + step] for a in range(0, len(nodes), step)):
                cells = np.zeros((3, len(some), columns.shape[1], n_bins), np.int64)
                for i, node in enumerate(some):
                    at = slice(ends[node] - sizes[node], ends[node])
                    self._count([code[at] for code in joint], self.packed.take(kind[at]), columns[node], cells[:, i])
                n, drawn, positives = cells
                for out, v in zip(found, best_cuts(*self.sums(positives, drawn - positives), n, s)):
                    out[some] = v
        if not large.all():
            rest = ~large
            if large.any():
                sizes, kind, *joint = _kept(rest, sizes, kind, *joint)
            own = self._bins(joint)
            cuts = _node_cuts_in_task(own.ravel(), len(kind), sizes, np.arange(len(kind)), self.packed.take(kind), columns[rest], n_bins, s, self)
            for out, v in zip(found, cuts):
                out[rest] = v
        return found

    def best_cuts(self, packed, s: Settings):
        """``best_cuts`` of nodes of up to ``AT_ONCE`` rows: both sides are whole numbers as their cells are."""
        left = packed.cumsum(axis=2)
        both = np.stack([left, left[:, :, -1:] - left])
        # fields from the highest down; whole numbers, so nothing is rounded
        positives = np.floor(both * 2.0 ** (-2 * FIELD))
        both -= positives * 2.0 ** (2 * FIELD)
        drawn = np.floor(both * 2.0**-FIELD)
        both -= drawn * 2.0**FIELD
        g = self.weights[1] * positives
        drawn -= positives
        drawn *= self.weights[0]
        drawn += g
        (gl, gr), (hl, hr), (nl, nr) = g, drawn, both
        return _largest_drops(gl, hl, nl, gr, hr, nr, s)

    def _count(self, joint, packed, columns, cells) -> None:
        """Rows, draws and draws of positives per (column place, bin) of one node."""
        asked = {c: j for j, c in enumerate(columns.tolist())}
        for code, (shape, places) in zip(joint, self.places):
            here = [(axis, asked[c]) for axis, c in enumerate(places) if c in asked]
            if not here:
                continue
            many, parts = int(np.prod(shape)), []
            for a in range(0, len(code), AT_ONCE):
                seen = np.bincount(code[a : a + AT_ONCE], packed[a : a + AT_ONCE], many).reshape(shape)
                parts.append([seen.sum(axis=tuple(o for o in range(len(shape)) if o != axis)) for axis, _ in here])
            for (axis, j), *found in zip(here, *parts):
                for field, part in enumerate(_fields(np.array(found))):
                    cells[field, j, : shape[axis]] = part.sum(axis=0)

    def _bins(self, joint) -> np.ndarray:
        """The columns again, a row per column."""
        own = np.empty((sum(len(places) for _, places in self.places), len(joint[0])), np.uint8)
        for code, (shape, places) in zip(joint, self.places):
            for size, c in zip(shape[::-1], places[::-1]):
                own[c] = code % code.dtype.type(size) if size < 256 or code.itemsize > 1 else code
                code = code // code.dtype.type(size) if size < 256 or code.itemsize > 1 else code
        return own


def _fields(packed: np.ndarray) -> list[np.ndarray]:
    """Rows, draws and draws of positives."""
    whole = packed.astype(np.int64)
    return [whole >> field * FIELD & (1 << FIELD) - 1 for field in range(3)]


def effort(s: Settings, width: int) -> float:
    """How long a fit takes beside others over the same rows."""
    return s.n_estimators * (DEEPEST if s.max_depth is None else s.max_depth) * (2 + column_count(width, s))


def alike(s: Settings, width: int) -> tuple:
    """Forests of which this is the same have the same trees, up to their depth and number."""
    return column_count(width, s), s.min_samples_leaf, s.seed


def shares(s: Settings, tasks: int) -> list[list[int]]:
    """The numbers of the trees of each task."""
    return [list(range(i, s.n_estimators, tasks)) for i in range(min(tasks, s.n_estimators))]


def _kept(nodes: np.ndarray, sizes, *held):
    """How many rows each marked node has, and what is held of its rows."""
    here = np.flatnonzero(np.repeat(nodes, sizes))
    return sizes[nodes], *(v.take(here) for v in held)


def _node_cuts_in_task(own, m: int, sizes, row, gh, columns, n_bins: int, s: Settings, draws: _Draws | None = None):
    """``best_cuts`` of nodes whose rows lie one after the other, some nodes at a time.

    Nodes of few rows have cells for the bins they hold only: a cut behind an empty bin is
    the cut behind the bin before it.  With ``draws`` the rows' values are its packed numbers.
    """
    n_nodes = len(columns)
    found = np.empty(n_nodes, np.intp), np.empty(n_nodes, np.intp), np.empty(n_nodes)
    least = 0
    for room in [r for r in SMALL_NODES if r < n_bins <= 64] + [n_bins]:
        chosen = (sizes > least) & ((sizes <= room) | (room == n_bins))
        least = room
        if not chosen.any():
            continue
        many, rows, values = (sizes, row, gh) if chosen.all() else _kept(chosen, sizes, row, gh)
        cuts = _sized_cuts(own, m, rows, many, values, columns[chosen], n_bins, room, s, draws)
        for out, v in zip(found, cuts):
            out[chosen] = v
    return found


def _sized_cuts(own, m: int, row, sizes, gh, columns, n_bins: int, room: int, s: Settings, draws: _Draws | None):
    """The cuts of nodes that hold at most ``room`` bins of a column."""
    n_nodes, k = columns.shape
    step = max(1, TASK_CELLS // (k * room))
    ends = np.cumsum(sizes)
    found = []
    for a in range(0, n_nodes, step):
        some, many = columns[a : a + step], sizes[a : a + step]
        lo, hi = ends[a] - many[0], ends[a + len(many) - 1]
        at, values, starts = row[lo:hi], gh[lo:hi], ends[a : a + step] - many - lo
        first = np.repeat(np.arange(len(some)) * room, many)
        cells = np.empty((1 if draws is not None else 3, len(some), k, room))
        held = np.empty((len(some), k), np.uint64)
        for j in range(k):
            bin_ = own.take(np.repeat(some[:, j] * m, many) + at)
            if room < n_bins:  # the bin's place among those the node holds
                bit = np.left_shift(np.uint64(1), bin_.astype(np.uint64))
                held[:, j] = np.bitwise_or.reduceat(bit, starts)
                bin_ = np.bitwise_count(np.repeat(held[:, j], many) & (bit - np.uint64(1)))
            cell, shape = first + bin_, (len(some), room)
            if draws is not None:
                cells[0, :, j] = np.bincount(cell, values, len(some) * room).reshape(shape)
                continue
            total = np.zeros(len(some) * room, complex)
            np.add.at(total, cell, values)
            for v, sums in zip(cells[:, :, j], (total.real, total.imag, np.bincount(cell, minlength=len(total)))):
                v[:] = sums.reshape(shape)
        c, b, drop = best_cuts(*cells, s) if draws is None else draws.best_cuts(cells[0], s)
        found.append((c, _nth_bit(held[np.arange(len(some)), c], b) if room < n_bins else b, drop))
    return tuple(np.concatenate(v) for v in zip(*found))


def _nth_bit(held: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which bit is the ``n``-th that is set, counted from 0."""
    n, bit = n.copy(), np.zeros(len(n), np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(held >> bit & np.uint64((1 << step) - 1))
        past = n >= below
        n -= np.where(past, below, 0)
        bit += np.where(past, np.uint64(step), np.uint64(0))
    return bit.astype(np.intp)


# --- level by level on the cluster -----------------------------------------------------------


def grow_by_levels(matrix: DataFrame, width: int, n_bins: int, s: Settings) -> list[Tree]:
    """The same trees over a table (key, y, w, bins) of any size."""
    deepest = DEEPEST if s.max_depth is None else s.max_depth
    k = column_count(width, s)
    done: list[Tree] = []
    while len(done) < s.n_estimators:
        # as many trees at once as their widest level leaves room for
        widest = min(1 << min(deepest, 10), 1 << 10)
        group = range(len(done), min(s.n_estimators, len(done) + max(1, CELLS // (widest * k * n_bins))))
        trees, open_ = {t: Tree() for t in group}, {t: [0] for t in group}
        for depth in range(deepest + 1):
            state = {t: (trees[t].lists(), nodes, node_columns(nodes, t, width, s)) for t, nodes in open_.items() if nodes}
            if not state:
                break
            shared = matrix.sparkSession.sparkContext.broadcast(state)
            cells = matrix.select("key", "y", "w", "bins").mapInArrow(_cells(shared, width, n_bins, s), "tree int, node int, place int, bin int, g double, h double, n double")
            cuts = {(c["tree"], c["node"]): c for c in node_cuts(cells, s).collect()}
            shared.unpersist()
            for t, (_, nodes, columns) in state.items():
                grown = []
                for i, node in enumerate(nodes):
                    c = cuts.get((t, i))
                    if c is None:
                        _settle(trees[t], node, 0.0, 1.0)
                        continue
                    _settle(trees[t], node, c["g"], c["h"])
                    if depth < deepest and c["drop"] > SMALLEST_DROP and 0 < c["g"] < c["h"]:
                        trees[t].cut(node, int(columns[i, c["place"]]), c["bin"], c["drop"])
                        grown += [trees[t].left[node], trees[t].right[node]]
                open_[t] = grown
        done += trees.values()
    return done


def _cells(shared, width: int, n_bins: int, s: Settings):
    """Partial sums of one input partition, one row per non-empty cell."""
    names = ["tree", "node", "place", "bin", "g", "h", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {t: (Tree(lists), nodes, columns) for t, (lists, nodes, columns) in shared.value.items()}
        total: dict[int, list] = {}
        for batch in batches:
            key, y, w = (batch.column(i).to_numpy() for i in range(3))
            bins = byte_rows(batch.column(3), width)
            for t, (tree, nodes, columns) in state.items():
                place = np.full(len(tree.column), -1)
                place[nodes] = np.arange(len(nodes))
                times, node = times_drawn(key, t, s), place[tree.walk(bins)]
                at = np.flatnonzero((times > 0) & (node >= 0))
                h = w[at] * times[at]
                part = cell_sums(bins[at], columns, node[at], n_bins, (h * y[at], h, np.ones(len(at))))
                total[t] = part if t not in total else [a + b for a, b in zip(total[t], part)]
        for t, (g, h, n) in total.items():
            node, place, bin_ = np.nonzero(n)
            where = node, place, bin_
            ints = [pa.array(v, pa.int32()) for v in (np.full(len(node), t), *where)]
            yield pa.RecordBatch.from_arrays([*ints, *(pa.array(v[where], pa.float64()) for v in (g, h, n))], names=names)

    return run


def node_cuts(cells: DataFrame, s: Settings) -> DataFrame:
    """(tree, node, place, bin, drop, g, h): the best cut of each open node."""
    summed = cells.groupBy("tree", "node", "place", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"])
    column = Window.partitionBy("tree", "node", "place")
    below = column.orderBy("bin")  # at most MAX_BINS rows
    left = [F.sum(c).over(below).alias(f"{c}l") for c in "ghn"]
    run = summed.select("tree", "node", "place", "bin", *left, *[F.sum(c).over(column).alias(c) for c in "ghn"])
    gl, hl, nl, g, h, n = (F.col(c) for c in ("gl", "hl", "nl", "g", "h", "n"))
    drop = F.try_divide(gl * gl, hl) + F.try_divide((g - gl) * (g - gl), h - hl) - g * g / h
    least = F.lit(float(s.min_samples_leaf))
    allowed = (nl >= least) & (n - nl >= least) & (hl > 0) & (h - hl > 0)
    scored = run.withColumn("drop", F.when(allowed, drop).otherwise(F.lit(0.0)))
    first = F.struct("drop", (-F.col("place")).alias("p"), (-F.col("bin")).alias("b"))
    best = F.max_by(F.struct("place", "bin", "drop", "g", "h"), first).alias("c")
    return scored.groupBy("tree", "node").agg(best).select("tree", "node", "c.*")


# --- estimator ---------------------------------------------------------------------------------


class BinnedForest(Estimator, HasLabelCol, HasFeaturesCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    settings = Param(Params._dummy(), "settings", "Settings as JSON", TypeConverters.toString)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a column", TypeConverters.toInt)
    taskBytes = Param(Params._dummy(), "taskBytes", "largest matrix grown in one task", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, labelCol="label", featuresCol="features", weightCol="", settings="{}", maxBins=MAX_BINS, taskBytes=boost.TASK_BYTES):
        super().__init__()
        self._setDefault(labelCol="label", featuresCol="features", weightCol="", settings="{}", maxBins=MAX_BINS, taskBytes=boost.TASK_BYTES)
        self._set(**self._input_kwargs)

    def options(self) -> Settings:
        return Settings(**json.loads(self.getOrDefault("settings")))

    def _fit(self, df: DataFrame) -> BinnedForestModel:
        features, weight = self.getOrDefault("featuresCol"), self.getOrDefault("weightCol")
        edges = boost.bin_edges(df, features, max_bins=self.getOrDefault("maxBins"))
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        y = F.col(self.getOrDefault("labelCol")).cast("double")
        matrix = stable(boost.binned(df, features, edges, F.monotonically_increasing_id().alias("key"), y.alias("y"), w.alias("w")))
        width, n_bins, s = len(edges), max(map(len, edges), default=0) + 1, self.options()
        if boost.fits_task(matrix, width, self.getOrDefault("taskBytes")):
            tasks = shares(s, matrix.sparkSession.sparkContext.defaultParallelism)
            trees = boost.grown_apart(matrix, width, n_bins, s, grow_in_task, tasks)
        else:
            trees = grow_by_levels(matrix, width, n_bins, s)
        state = {"edges": edges, "trees": [list(t.lists()) for t in trees]}
        return BinnedForestModel(state=json.dumps(state), featuresCol=features)


class BinnedForestModel(boost.BoostedTreesModel):
    """Averages the shares of positives in the leaves."""

    @property
    def featureImportances(self) -> DenseVector:
        """Impurity drops per column as shares within each tree, averaged over trees that cut."""
        fitted = self.fitted
        total = np.zeros(len(fitted["edges"]))
        for lists in fitted["trees"]:
            own = np.zeros(len(total))
            for column, drop in zip(lists[0], lists[5]):
                if column >= 0:
                    own[column] += drop
            total += own / own.sum() if own.sum() else own
        return DenseVector(total / total.sum() if total.sum() else total)

    @staticmethod
    def _chance(total: np.ndarray, n_trees: int) -> np.ndarray:
        return total / max(1, n_trees)
