"""Second-order boosted trees over binned columns, with logistic loss.

A column is cut at quantiles of the training rows, so a row is one small number per
column.  Each level of a tree needs the sums of gradients and hessians per (node,
column, bin); the best cut of a node follows from running totals along the bins:

    gain = GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda)

and a leaf is worth -G / (H + lambda).  Columns are drawn per tree, rows per tree by a
hash of their key, and both sides of a cut need ``min_child_weight`` of hessian.

Tables go level by level: one Spark aggregation sums the cells and finds the cuts, and
only the cuts reach the driver.  A matrix measured to fit ``task_bytes`` is grown by the
same rules in one task, because thousands of tiny jobs cost more than the rows; many
such fits (folds, candidates) run side by side.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from stayledger.config import SEED
from stayledger.session import stable

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 256  # a bin is one byte
TASK_BYTES = 64 << 20
REFRESH = 20  # rounds after which the margins are written anew
SMALLEST_GAIN = 1e-6
WALKED, STEPS = 1 << 14, 4  # rows, and levels, that are walked at once
JOINED, JOINT = 1 << 14, 1 << 12  # rows of a matrix whose columns are summed together, and cells of such columns
MATRIX = "key long, y double, w double, bins binary"


class Settings(NamedTuple):
    n_estimators: int = 500
    learning_rate: float = 0.03
    max_depth: int = 4
    min_child_weight: float = 5.0
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    reg_lambda: float = 1.0
    seed: int = SEED


# --- binning ---------------------------------------------------------------------------


def bin_edges(df: DataFrame, features: str, *, max_bins: int = MAX_BINS) -> list[list[float]]:
    """Per column the ascending cuts; a value goes left of the first cut it does not exceed.

    Cuts are values of the rows: up to ``max_bins - 2`` quantiles and the least value.
    The largest value is no cut, as nothing lies behind it.
    """
    return next(iter(part_edges(df, features, F.lit(0), max_bins=max_bins).values()))


def part_edges(df: DataFrame, features: str, part: Column, *, max_bins: int = MAX_BINS) -> dict[int, list[list[float]]]:
    """The cuts of every part of the table, in one pass over it."""
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"max_bins must be between 2 and {MAX_BINS}")
    row = df.select(F.size(vector_to_array(features)).alias("n")).first()
    if row is None:
        raise ValueError("no rows to fit on")
    cells = df.select(part.alias("part"), vector_to_array(features).alias("x"))
    share = F.array(*[F.lit(i / (max_bins - 1)) for i in range(1, max_bins - 1)]).cast("array<double>")
    columns = [
        F.struct(
            F.percentile_approx(F.col("x")[i], share, 100 * max_bins).alias("cuts") if max_bins > 2 else F.array().alias("cuts"),
            F.min(F.col("x")[i]).alias("low"),
            F.max(F.col("x")[i]).alias("high"),
        )
        for i in range(row["n"])
    ]
    found = cells.groupBy("part").agg(F.array(*columns).alias("columns"))
    return {
        r["part"]: [sorted({*c["cuts"], c["low"]} - {c["high"]}) for c in r["columns"]]
        for r in found.collect()  # one row per part
    }


def binned(df: DataFrame, features: str, edges, *keep: Column) -> DataFrame:
    """Kept columns and ``bins``, one byte per column of the vector.

    ``edges`` are the cuts, or the cuts of each part; the first kept column then is the part.
    """
    named = df.select(*keep, vector_to_array(features).alias("_x"))
    kept = named.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(0).to_numpy() if isinstance(edges, dict) else np.zeros(len(batch))
            packed = np.empty(len(batch), object)
            for k in np.unique(part).tolist():
                at = np.flatnonzero(part == k)
                cuts = edges[k] if isinstance(edges, dict) else edges
                x = _rows(batch.column(len(kept)).take(pa.array(at)), len(cuts))
                out = np.empty(x.shape, np.uint8)
                for i, c in enumerate(cuts):
                    out[:, i] = np.searchsorted(c, x[:, i], side="left")
                packed[at] = [r.tobytes() for r in out]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], names=[*kept, "bins"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields[:-1])
    return named.mapInArrow(run, f"{schema}, bins binary")


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def byte_rows(column: pa.Array, width: int) -> np.ndarray:
    """The bytes of a binary column without nulls as a matrix, read where they lie."""
    if not len(column) or not width:
        return np.zeros((len(column), width), np.uint8)
    _, places, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    first = int(np.frombuffer(places, kind)[column.offset])
    return np.frombuffer(data, np.uint8, len(column) * width, first).reshape(len(column), width)


# --- drawing, cutting and walking, shared by both ways --------------------------------------


def drawn_columns(width: int, round_: int, s: Settings) -> np.ndarray:
    """The columns of one tree."""
    n = max(1, int(s.colsample_bytree * width))
    return np.sort(np.random.default_rng([s.seed, round_]).permutation(width)[:n])


def drawn_rows(key: np.ndarray, round_: int, s: Settings) -> np.ndarray:
    """Which rows a tree sees: a hash of key and round, uniform in [0, 1), under the share."""
    if s.subsample >= 1:
        return np.ones(len(key), bool)
    share = np.uint64(np.ceil(s.subsample * 2.0**53))
    with np.errstate(over="ignore"):
        x = key.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(s.seed * 1000003 + round_ + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x >> np.uint64(11) < share


def gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    return w * (p - y), w * p * (1 - p)


def cell_sums(bins, columns, node, n_nodes: int, n_bins: int, values: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Sums of each value per (node, column, bin)."""
    place = (node[:, None] * len(columns) + np.arange(len(columns))) * n_bins + bins[:, columns]
    shape = (n_nodes, len(columns), n_bins)
    flat = place.ravel()
    return [
        np.bincount(flat, weights=np.repeat(v, len(columns)), minlength=n_nodes * len(columns) * n_bins).reshape(shape)
        for v in values
    ]


def best_cuts(g: np.ndarray, h: np.ndarray, s: Settings):
    """(column place, bin, gain) of each node, gain 0 where no cut is allowed."""
    gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
    gt, ht = gl[:, :, -1:], hl[:, :, -1:]
    hr = ht - hl
    gain = gl**2 / (hl + s.reg_lambda) + (gt - gl) ** 2 / (hr + s.reg_lambda) - gt**2 / (ht + s.reg_lambda)
    allowed = (hl >= s.min_child_weight) & (hr >= s.min_child_weight) & (hl > 0) & (hr > 0)
    gain = np.where(allowed, gain, 0).reshape(len(g), -1)
    best = gain.argmax(axis=1)
    value = gain[np.arange(len(g)), best]
    return best // g.shape[2], best % g.shape[2], np.where(value > SMALLEST_GAIN, value, 0)


def joint_columns(x: np.ndarray, most: int) -> tuple[list[np.ndarray], list[tuple[tuple[int, ...], tuple[int, ...]]]]:
    """Columns of few bins as one number: one count of its cells is a count of each of them.

    x: the bins, a row per column.  Numbers have at most ``most`` cells unless a column alone
    has more.  Beside every number are the bins, and the columns, of its places.
    """
    sizes = [int(column.max(initial=0)) + 1 for column in x]
    groups: list[list[int]] = []
    for c in sorted(range(len(x)), key=lambda c: (-sizes[c], c)):
        for group in groups:
            if np.prod([sizes[o] for o in group]) * sizes[c] <= most:
                group.append(c)
                break
        else:
            groups.append([c])
    codes = []
    for group in groups:
        kind = np.min_scalar_type(int(np.prod([sizes[c] for c in group])) - 1)
        code = x[group[0]].astype(kind)
        for c in group[1:]:
            code = code * kind.type(sizes[c]) + x[c].astype(kind)
        codes.append(code)
    return codes, [(tuple(sizes[c] for c in group), tuple(group)) for group in groups]


class Tree:
    """Nodes in the order they were made; a leaf has column -1."""

    def __init__(self, lists=None):
        root = [-1], [0], [0], [0], [0.0], [0.0], [0.0]
        self.column, self.bin, self.left, self.right, self.value, self.gain, self.cover = lists or root

    def cut(self, node: int, column: int, bin_: int, gain: float) -> None:
        n = len(self.column)
        self.column[node], self.bin[node], self.gain[node] = column, bin_, gain
        self.left[node], self.right[node] = n, n + 1
        for values, new in zip(self.lists(), (-1, 0, 0, 0, 0.0, 0.0, 0.0)):
            values += [new, new]

    def cut_all(self, nodes: list, columns: list, bins: list, gains: list) -> None:
        """``cut`` of several nodes in turn."""
        n = len(self.column)
        for i, (node, column, bin_, gain) in enumerate(zip(nodes, columns, bins, gains)):
            self.column[node], self.bin[node], self.gain[node] = column, bin_, gain
            self.left[node], self.right[node] = n + 2 * i, n + 2 * i + 1
        for values, new in zip(self.lists(), (-1, 0, 0, 0, 0.0, 0.0, 0.0)):
            values += [new] * (2 * len(nodes))

    def upto(self, depth: int | None) -> Tree:
        """The tree as it was when it had ``depth`` levels of cuts, grown level by level."""
        first, last = 0, 1
        for _ in range(len(self.column) if depth is None else depth):
            if first == len(self.column):
                return self
            first, last = last, last + 2 * sum(c >= 0 for c in self.column[first:last])
        return Tree((self.column[:first] + [-1] * (len(self.column) - first), *self.lists()[1:]))

    def lists(self) -> tuple[list, ...]:
        return self.column, self.bin, self.left, self.right, self.value, self.gain, self.cover

    def settle(self, node: int, g: float, h: float, s: Settings) -> None:
        self.value[node], self.cover[node] = -g / (h + s.reg_lambda) * s.learning_rate, h

    def walk(self, bins: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
        """The node each row ends in, for as far as the tree has grown."""
        column, cut, left = (np.asarray(v) for v in self.lists()[:3])
        leaf = column < 0
        # a row stays in a leaf, as no byte exceeds 255; children follow each other
        column, cut = np.where(leaf, 0, column), np.where(leaf, 255, cut).astype(np.uint8)
        left = np.where(leaf, np.arange(len(leaf)), left)
        node = np.zeros(len(bins), np.int64) if node is None else node.copy()
        flat, width = bins.ravel(), bins.shape[1]
        for first in range(0, len(node), WALKED):
            at = first + np.flatnonzero(~leaf.take(node[first : first + WALKED]))
            n, own = node.take(at), at * width
            while len(at):
                for _ in range(STEPS):
                    n = left.take(n) + (flat.take(own + column.take(n)) > cut.take(n))
                node[at] = n
                further = np.flatnonzero(~leaf.take(n))
                at, n, own = at.take(further), n.take(further), own.take(further)
        return node


def grow_in_task(bins, y, w, key, n_bins: int, s: Settings) -> Iterator[Tree]:
    """All rounds over one matrix, a tree at a time.

    Columns are summed one by one, and only drawn rows of open nodes are carried from level
    to level; rows stay in order, so every cell is summed in the same order.  Gradient and
    hessian of a row are the parts of one complex number, summed in one pass.  In a large
    matrix columns of few bins are summed together (see ``joint_columns``).
    """
    margin, x = np.zeros(len(y)), np.ascontiguousarray(bins.T)
    codes, places = joint_columns(x, JOINT if len(y) >= JOINED else 0)
    flat = x.ravel()
    for r in range(s.n_estimators):
        g, h = gradients(margin, y, w)
        columns, tree, open_ = drawn_columns(len(x), r, s), Tree(), [0]
        drawn = drawn_rows(key, r, s)
        rows, end = np.flatnonzero(drawn), np.zeros(len(y), np.intp)
        asked = {c: j for j, c in enumerate(columns.tolist())}
        used = [(code, bins_of, [(axis, asked[c]) for axis, c in enumerate(cs) if c in asked]) for code, (bins_of, cs) in zip(codes, places)]
        used, gh = [u for u in used if u[2]], np.empty(len(rows), complex)
        gh.real, gh.imag = g, h = (g, h) if drawn.all() else (g.take(rows), h.take(rows))
        if not drawn.all():
            used = [(code.take(rows), bins_of, here) for code, bins_of, here in used]
        place = np.zeros(len(rows), np.uint8)  # of the row's node among the open ones
        for depth in range(s.max_depth + 1):
            if depth == s.max_depth:
                total = np.zeros(len(open_), complex)
                np.add.at(total, place, gh)
                gt, ht = total.real, total.imag
                cut = [(0, 0, 0.0)] * len(open_)
            else:
                shape = len(open_), len(columns), n_bins
                sums = np.zeros(shape), np.zeros(shape)
                for code, bins_of, here in used:
                    cells = int(np.prod(bins_of))
                    total = np.zeros((shape[0], *bins_of), complex)
                    if shape[0] > 1:
                        code = np.multiply(place, cells, dtype=np.min_scalar_type(shape[0] * cells)) + code
                    np.add.at(total.reshape(-1), code.astype(np.intp), gh)
                    for axis, c in here:
                        one = total.sum(axis=tuple(1 + o for o in range(len(bins_of)) if o != axis))
                        sums[0][:, c, : one.shape[1]], sums[1][:, c, : one.shape[1]] = one.real, one.imag
                gt, ht = (v[:, 0].sum(axis=1) for v in sums)
                cut = list(zip(*(v.tolist() for v in best_cuts(*sums, s))))
            grown, below = [], np.full(len(open_), -1)
            for i, (c, b, gain) in enumerate(cut):
                tree.settle(open_[i], gt[i], ht[i], s)
                if gain > 0:
                    tree.cut(open_[i], int(columns[c]), b, gain)
                    below[i] = len(grown)
                    grown += [tree.left[open_[i]], tree.right[open_[i]]]
            if not grown:
                end[rows] = np.array(open_).take(place)
                break
            if (below < 0).any():
                stays = (below >= 0).take(place)
                gone, kept = np.flatnonzero(~stays), np.flatnonzero(stays)
                end[rows.take(gone)] = np.array(open_).take(place.take(gone))
                rows, gh, place = rows.take(kept), gh.take(kept), place.take(kept)
                used = [(code.take(kept), bins_of, here) for code, bins_of, here in used]
            c, b = (np.array(v) for v in list(zip(*cut))[:2])
            met = flat.take((columns[c] * len(y)).take(place) + rows)
            place = below.astype(np.min_scalar_type(len(grown))).take(place) + (met > b.astype(np.uint8).take(place))
            open_ = grown
        if not drawn.all():
            rest = np.flatnonzero(~drawn)
            end[rest] = tree.walk(bins.take(rest, axis=0))
        margin = margin + np.array(tree.value).take(end)
        yield tree


def effort(s: Settings, width: int) -> float:
    """How long a fit takes beside others over the same rows."""
    return s.n_estimators * (s.max_depth + 1) * s.subsample * max(1, int(s.colsample_bytree * width))


# --- level by level on the cluster --------------------------------------------------------


def grow_by_levels(matrix: DataFrame, width: int, n_bins: int, s: Settings) -> list[Tree]:
    """The same trees over a table (key, y, w, bins) of any size."""
    spark = matrix.sparkSession
    rows = matrix.select("key", "y", "w", "bins", F.lit(0.0).alias("margin"))
    trees: list[Tree] = []
    written = 0  # trees whose worth is in the margin column
    for r in range(s.n_estimators):
        tree, open_, columns = Tree(), [0], drawn_columns(width, r, s)
        for depth in range(s.max_depth + 1):
            # plain lists: a broadcast of objects would need the package on the executors
            recent = [t.lists() for t in trees[written:]]
            state = spark.sparkContext.broadcast((recent, tree.lists(), open_, columns, depth == s.max_depth))
            cells = rows.mapInArrow(_cells(state, width, n_bins, r, s), "node int, place int, bin int, g double, h double")
            cuts = {c["node"]: c for c in node_cuts(cells, s).collect()}  # one row per open node
            state.unpersist()
            grown = []
            for i, node in enumerate(open_):
                if i not in cuts:  # no drawn row came here
                    continue
                c = cuts[i]
                tree.settle(node, c["g"], c["h"], s)
                if depth < s.max_depth and (c["gain"] or 0) > SMALLEST_GAIN:
                    tree.cut(node, int(columns[c["place"]]), c["bin"], c["gain"])
                    grown += [tree.left[node], tree.right[node]]
            open_ = grown
            if not grown:
                break
        trees.append(tree)
        if len(trees) - written >= REFRESH and r + 1 < s.n_estimators:
            rows = stable(_with_margin(rows, trees[written:], width))
            written = len(trees)
    return trees


def _cells(state, width: int, n_bins: int, round_: int, s: Settings):
    """Partial sums of one input partition, one row per non-empty cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent, growing, open_, columns, last = state.value
        recent, tree = [Tree(t) for t in recent], Tree(growing)
        if last:  # leaves need their totals only: one column gives them
            columns = columns[:1]
        total = None
        for batch in batches:
            key, y, w, margin = (batch.column(i).to_numpy() for i in (0, 1, 2, 4))
            bins = byte_rows(batch.column(3), width)
            for t in recent:
                margin = margin + np.array(t.value)[t.walk(bins)]
            g, h = gradients(margin, y, w)
            place = np.full(len(tree.column), -1)
            place[open_] = np.arange(len(open_))
            node = place[tree.walk(bins)]
            at = np.flatnonzero(drawn_rows(key, round_, s) & (node >= 0))
            part = cell_sums(bins[at], columns, node[at], len(open_), n_bins, (g[at], h[at], np.ones(len(at))))
            total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            node, place, bin_ = np.nonzero(total[2])
            cells = [node, place, bin_, total[0][node, place, bin_], total[1][node, place, bin_]]
            kinds = [pa.int32()] * 3 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=["node", "place", "bin", "g", "h"])

    return run


def node_cuts(cells: DataFrame, s: Settings) -> DataFrame:
    """(node, place, bin, gain, g, h): the best cut of each node, from cells (node, place, bin, g, h)."""
    summed = cells.groupBy("node", "place", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    column = Window.partitionBy("node", "place")
    below = column.orderBy("bin")  # at most MAX_BINS rows
    run = summed.select(
        "node", "place", "bin",
        F.sum("g").over(below).alias("gl"), F.sum("h").over(below).alias("hl"),
        F.sum("g").over(column).alias("g"), F.sum("h").over(column).alias("h"),
    )
    gl, hl, g, h, lam = F.col("gl"), F.col("hl"), F.col("g"), F.col("h"), F.lit(float(s.reg_lambda))
    gain = gl * gl / (hl + lam) + (g - gl) * (g - gl) / (h - hl + lam) - g * g / (h + lam)
    least = F.lit(float(s.min_child_weight))
    allowed = (hl >= least) & (h - hl >= least) & (hl > 0) & (h - hl > 0)
    scored = run.withColumn("gain", F.when(allowed, gain).otherwise(F.lit(0.0)))
    first = F.struct("gain", (-F.col("place")).alias("p"), (-F.col("bin")).alias("b"))
    return scored.groupBy("node").agg(F.max_by(F.struct("place", "bin", "gain", "g", "h"), first).alias("c")).select("node", "c.*")


def _with_margin(rows: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast([t.lists() for t in trees])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margin = byte_rows(batch.column(3), width), batch.column(4).to_numpy()
            for t in map(Tree, shared.value):
                margin = margin + np.array(t.value)[t.walk(bins)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margin)], names=["key", "y", "w", "bins", "margin"])

    return rows.mapInArrow(run, f"{MATRIX}, margin double")


# --- many fits side by side ---------------------------------------------------------------


def fits_task(matrix: DataFrame, width: int, task_bytes: int = TASK_BYTES) -> bool:
    """Measured: the rows of the matrix fit one task."""
    return matrix.count() * (width + 24) <= task_bytes


def fit_side_by_side(
    parts: DataFrame, candidates: Sequence, widths: dict[int, int], weights: dict[int, tuple[float, float]], grow, chance, effort, alike=None
) -> DataFrame:
    """(candidate, part, y, score) of the held-out rows of every (candidate, part).

    parts: (part, held, key, y, bins), each part small enough for a task.  Negatives and
    positives of a part weigh ``weights[part]``.  Every fit is a task of its own, the longest
    by ``effort`` first: ``grow`` makes the trees, which are scored and dropped one by one,
    ``chance`` a probability of their sum.

    Candidates whose settings have the same ``alike(settings, width)`` differ in the number
    and depth of their trees only: they are one fit, in which every tree is grown once, as
    deep as the deepest that has it, and walked on from one candidate's depth to the next.
    """
    fits: list[tuple[int, list[int]]] = []
    for p, width in widths.items():
        found: dict = {}
        for c, s in enumerate(candidates):
            found.setdefault(alike(s, width) if alike else c, []).append(c)
        fits += [(p, own) for own in found.values()]

    def stretches(own: list[int]) -> list[tuple[int, int, object]]:
        """From which tree to which one the same settings are the deepest."""
        some = [candidates[c] for c in own]
        ends = sorted({s.n_estimators for s in some})
        open_ = [[s for s in some if s.n_estimators >= end] for end in ends]
        return [(a, b, max(o, key=_depth)) for a, b, o in zip([0, *ends], ends, open_)]

    def length(p: int, own: list[int]) -> float:
        return sum(effort(s._replace(n_estimators=b - a), widths[p]) for a, b, s in stretches(own))

    fits.sort(key=lambda f: (-length(*f), f[1], f[0]))
    places = {p: [place for place, f in enumerate(fits) if f[0] == p] for p in widths}
    places = F.create_map(*[v for p, at in places.items() for v in (F.lit(p), F.array(*map(F.lit, at)))])
    tasks = parts.select(F.explode(F.element_at(places, F.col("part"))).alias("fit"), "held", "key", "y", "bins")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            fit = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(fit[1:] != fit[:-1]) + 1).tolist(), len(fit)] if len(fit) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if fit[a] != now:
                    if rows:
                        yield from one(now, rows)
                    now, rows = int(fit[a]), []
                rows.append(batch.slice(a, b - a))
        if rows:
            yield from one(now, rows)

    def one(fit: int, rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = fits[fit]
        table = pa.Table.from_batches(rows)
        held = table.column("held").to_numpy()
        key, y = table.column("key").to_numpy(), table.column("y").to_numpy()
        bins = byte_rows(table.column("bins").combine_chunks(), widths[part])
        w = np.where(y > 0, weights[part][1], weights[part][0])
        train = bins[~held], y[~held], w[~held], key[~held], int(bins.max(initial=0)) + 1
        asked, y = bins[held], y[held].astype(np.int32)
        margin, n_trees = {c: np.zeros(len(asked)) for c in own}, dict.fromkeys(own, 0)
        own = sorted(own, key=lambda c: _depth(candidates[c]))
        for a, b, s in stretches(own):
            # a fit of its own has all of its trees in one stretch
            some = () if len(own) == 1 else (range(a, b),)
            meant = [c for c in own if candidates[c].n_estimators >= b]
            for t in grow(*train, s, *some):
                node, value = None, np.array(t.value)
                for c in meant:
                    shorter = _depth(candidates[c]) < _depth(s)
                    node = (t.upto(candidates[c].max_depth) if shorter else t).walk(asked, node)
                    margin[c] += value[node]
                    n_trees[c] += 1
        for c in own:
            columns = [np.full(len(y), c, np.int32), np.full(len(y), part, np.int32), y, chance(margin[c], n_trees[c])]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["candidate", "part", "y", "score"])

    dealt = tasks.repartitionById(len(fits), "fit").sortWithinPartitions("fit", "key")
    return dealt.mapInArrow(run, "candidate int, part int, y int, score double")


def _depth(s) -> float:
    return np.inf if s.max_depth is None else s.max_depth


# --- estimator ------------------------------------------------------------------------------


class _BoostedParams(HasLabelCol, HasFeaturesCol, HasWeightCol):
    settings = Param(Params._dummy(), "settings", "Settings as JSON", TypeConverters.toString)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a column", TypeConverters.toInt)
    taskBytes = Param(
        Params._dummy(), "taskBytes", "largest matrix grown in one task", TypeConverters.toInt
    )


class BoostedTrees(Estimator, _BoostedParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, labelCol="label", featuresCol="features", weightCol="", settings="{}", maxBins=MAX_BINS, taskBytes=TASK_BYTES):
        super().__init__()
        self._setDefault(labelCol="label", featuresCol="features", weightCol="", settings="{}", maxBins=MAX_BINS, taskBytes=TASK_BYTES)
        self._set(**self._input_kwargs)

    def options(self) -> Settings:
        return Settings(**json.loads(self.getOrDefault("settings")))

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        features, weight = self.getOrDefault("featuresCol"), self.getOrDefault("weightCol")
        edges = bin_edges(df, features, max_bins=self.getOrDefault("maxBins"))
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        y = F.col(self.getOrDefault("labelCol")).cast("double")
        matrix = stable(
            binned(df, features, edges, F.monotonically_increasing_id().alias("key"), y.alias("y"), w.alias("w"))
        )
        width, n_bins, s = len(edges), max(map(len, edges), default=0) + 1, self.options()
        if fits_task(matrix, width, self.getOrDefault("taskBytes")):
            trees = grown_apart(matrix, width, n_bins, s, grow_in_task)
        else:
            trees = grow_by_levels(matrix, width, n_bins, s)
        state = {"edges": edges, "trees": [list(t.lists()) for t in trees]}
        return BoostedTreesModel(state=json.dumps(state), featuresCol=features)


def grown_apart(matrix: DataFrame, width: int, n_bins: int, s, grow, shares: Sequence[Sequence[int]] | None = None) -> list[Tree]:
    """One small matrix, grown by one task with ``grow`` (see grow_in_task).

    Trees that do not follow from each other may be dealt to tasks: ``shares`` lists the
    numbers of each one's trees, which ``grow`` then takes, and every task gets the matrix.
    """
    names = ["key", "y", "w", "bins"]
    schema = pa.schema([("key", pa.int64()), ("y", pa.float64()), ("w", pa.float64()), ("bins", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if shares is not None and not batches:
            return
        some = (shares[batches[0].column("share")[0].as_py()],) if shares is not None else ()
        table = pa.Table.from_batches([b.select(names) for b in batches], schema)
        batches.clear()
        key, y, w = (table.column(c).to_numpy() for c in names[:3])
        order = np.argsort(key, kind="stable")
        bins = byte_rows(table.column("bins").combine_chunks(), width)[order]
        y, w, key = y[order], w[order], key[order]
        del table, order  # the rows are held once while the trees grow
        for i, t in enumerate(grow(bins, y, w, key, n_bins, s, *some)):
            made = pa.array([some[0][i] if some else i], pa.int32()), pa.array([json.dumps(t.lists())], pa.string())
            yield pa.RecordBatch.from_arrays(list(made), names=["place", "tree"])

    if shares is None:
        dealt = matrix.select(*names).coalesce(1)
    else:
        every = F.explode(F.sequence(F.lit(0), F.lit(len(shares) - 1))).alias("share")
        dealt = matrix.select(*names, every).repartitionById(len(shares), F.col("share"))
    grown = dealt.mapInArrow(run, "place int, tree string").collect()
    return [Tree(json.loads(r["tree"])) for r in sorted(grown, key=lambda r: r["place"])]


class BoostedTreesModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted trees; they are as large as the model, not as the data."""

    state = Param(Params._dummy(), "state", "cuts and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state='{"edges": [], "trees": []}', featuresCol="features"):
        super().__init__()
        self._setDefault(state='{"edges": [], "trees": []}', featuresCol="features")
        self._set(**self._input_kwargs)

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    def nodes(self) -> list[tuple]:
        """(tree, node, column, threshold, left, right, value, gain, cover); a leaf has column -1."""
        fitted = self.fitted
        return [
            (t, i, c, fitted["edges"][c][b] if c >= 0 else None, left, right, value, gain, cover)
            for t, lists in enumerate(fitted["trees"])
            for i, (c, b, left, right, value, gain, cover) in enumerate(zip(*lists))
        ]

    @property
    def featureImportances(self) -> DenseVector:
        """Mean gain of a column's cuts, as shares of their sum."""
        fitted = self.fitted
        gain, cuts = np.zeros(len(fitted["edges"])), np.zeros(len(fitted["edges"]))
        for lists in fitted["trees"]:
            for column, value in zip(lists[0], lists[5]):
                if column >= 0:
                    gain[column] += value
                    cuts[column] += 1
        mean = gain / np.maximum(cuts, 1)
        return DenseVector(mean / mean.sum() if mean.sum() else mean)

    @staticmethod
    def _chance(total: np.ndarray, n_trees: int) -> np.ndarray:
        """A probability from the sum over the trees."""
        return 1 / (1 + np.exp(-total))

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = self.fitted
        # plain arrays: a broadcast of objects would need the package on the executors
        kinds = (np.int64, np.int64, np.int64, np.int64, float)
        trees = [[np.array(v, kind) for v, kind in zip(lists, kinds)] + [None, None] for lists in fitted["trees"]]
        shared = df.sparkSession.sparkContext.broadcast((fitted["edges"], trees))

        to_chance = self._chance

        @F.pandas_udf("double")
        def chance(x: pd.Series) -> pd.Series:
            edges, trees = shared.value
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(edges)))
            bins, margin = np.zeros(rows.shape, np.uint8), np.zeros(len(rows))
            for i, cuts in enumerate(edges):
                bins[:, i] = np.searchsorted(cuts, rows[:, i], side="left")
            for lists in trees:
                tree = Tree(lists)
                margin += tree.value.take(tree.walk(bins))
            return pd.Series(to_chance(margin, len(trees)))

        p = chance(vector_to_array(self.getOrDefault("featuresCol")))
        scored = df.withColumn("_chance", p)
        vector = array_to_vector(F.array(1.0 - F.col("_chance"), F.col("_chance")))
        return scored.withColumn("probability", vector).withColumn("prediction", (F.col("_chance") > 0.5).cast("double")).drop("_chance")
