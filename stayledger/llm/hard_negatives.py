"""Hard negatives of anchors by spanning-tree bounds.

Components become integers, so scores are exact. Anchors of one label are put in blocks of
neighbours (nearest pivot), and a block gets a minimum spanning tree over its anchors. For a
child c of parent a and any row y, c.y = a.y + (c-a).y lies within edge length times the
length of y of the parent's score, so the tree is walked level by level: a row's interval at
the parent, widened by the edge, is its interval at the child, and only rows whose interval
overlaps the child's window are scored again (an interval then shrinks to the score).

The walk is made twice. First the window is open, over rows of the anchor's label, and closes
from below as the best rows are found: these are the positives. Then each positive opens a
window between its shares of the positive's score, over the other labels. Rows are dealt to
chunks that a task holds while the blocks of anchors stream by; a first sweep over one chunk
in SEED gives the floors that keep the other chunks from returning rows that cannot win.

Rows with a null label, a null or empty vector, or a null or non-finite component take no
part. Shorter vectors count as padded with zeros. Rows that repeat an id are rows of their
own. Rows without id are candidates that come after all others at equal score, and no
anchors. Scores beyond 2**62 count as 2**62. Labels that are no integers are compared by
their 64-bit hash. Of rows with the same vector and label only the first few by id can be
among the first of any anchor, so later ones are not compared. A table without anchors gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, pivots_of, table

#: Anchors of a block, blocks' pivots at most, rows a task holds (components), scores of a task.
BLOCK, CELLS, HELD, WORK = 1024, 4096, 1 << 22, 1 << 35
#: Least rows of a chunk, entries of a level's matrices, one chunk in so many gives floors.
CHUNK, ENTRIES, SEED = 4096, 1 << 21, 32
TOP = 1 << 62
READY = "id long, label long, norm double, vec binary"
ROWS = "key long, side int, block long, pos int, parent int, level int, edge double, row long, id long, label long, norm double, vec binary, lows array<long>, highs array<long>"
HITS = "anchor long, w int, row long, id long, score long"


def integers(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: float) -> DataFrame:
    """READY rows: whole components floor(scale * x), as 16-bit numbers where they fit."""

    def run(batches):
        for batch in batches:
            keep, norms, out = [], [], []
            for k, v in enumerate(batch.column(2)):
                values = v.values if v.is_valid else None
                if values is None or not len(values) or values.null_count:
                    continue
                with np.errstate(all="ignore"):
                    x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x).all():
                    continue
                top = np.abs(x).max()
                keep.append(k)
                norms.append(float(top * np.sqrt(((x / top) ** 2).sum())) if top else 0.0)
                out.append(b"\x02" + x.astype("<i2").tobytes() if top < 32768 else b"\x08" + x.astype("<f8").tobytes())
            kept = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept), pa.array(norms, pa.float64()), pa.array(out, pa.binary())], names=["id", "label", "norm", "vec"])

    kind = vectors.schema[label_col].dataType
    label = F.col(label_col).cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(F.col(label_col))
    chosen = vectors.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull())
    return chosen.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vec_col).alias("vec")).mapInArrow(run, READY)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Whole components as doubles, padded with zeros."""
    out = np.zeros((len(column), width))
    for k, v in enumerate(column.to_pylist()):
        x = np.frombuffer(v, "<i2" if v[0] == 2 else "<f8", offset=1)
        out[k, : len(x)] = x
    return out


def clipped(values) -> np.ndarray:
    return np.array([max(-TOP, min(TOP, v)) for v in np.ravel(values)], np.int64)


def scores(a: np.ndarray, b: np.ndarray, top: float) -> np.ndarray:
    """Inner products of all rows; top bounds the product of any two lengths."""
    if top < 2.0**52:
        return np.rint(a @ b.T).astype(np.int64)
    if top < 2.0**62:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    return clipped(whole(a) @ whole(b).T).reshape(len(a), len(b))


def pair_scores(a: np.ndarray, b: np.ndarray, top: float) -> np.ndarray:
    """Inner products of rows side by side."""
    if top < 2.0**52:
        return np.rint(np.einsum("ij,ij->i", a, b)).astype(np.int64)
    if top < 2.0**62:
        return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    return clipped([sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True)])


def spanning_tree(vec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, level, edge): rows by level of a minimum spanning tree, parents as places in it."""
    n = len(vec)
    with np.errstate(all="ignore"):
        size = (vec**2).sum(axis=1)
        gap = np.nan_to_num(size[:, None] + size[None, :] - 2 * vec @ vec.T, nan=np.inf)
    root = int(gap.sum(axis=1).argmin())
    parent, level = np.full(n, root), np.zeros(n, np.int64)
    least, done = gap[root].copy(), np.zeros(n, bool)
    done[root], parent[root] = True, -1
    for _ in range(n - 1):
        k = int(np.where(done, np.inf, least).argmin())
        if done[k]:  # only infinite gaps are left
            k = int(np.flatnonzero(~done)[0])
        done[k] = True
        level[k] = level[parent[k]] + 1
        closer = ~done & (gap[k] < least)
        parent[closer], least[closer] = k, gap[k][closer]
    order = np.lexsort((parent, level))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    up = parent[order]
    with np.errstate(all="ignore"):
        edge = np.sqrt(((vec[order] - vec[np.maximum(up, 0)]) ** 2).sum(axis=1))
    edge[up < 0] = 0
    return order, np.where(up < 0, -1, place[np.maximum(up, 0)]), level[order], edge * (1 + 1e-9)


def trees(anchors: DataFrame, work: Workspace, width: int) -> DataFrame:
    """(block, pos, parent, level, edge, row, id, label, norm, vec): blocks of anchors of one label."""
    n = anchors.count()
    wanted = max(1, min(-(-n // BLOCK), CELLS, HELD // width))
    chosen = matrix(pa.array(pivots_of(anchors, F.xxhash64("row"), wanted).select("vec").toPandas()["vec"], pa.binary()), width)
    shared = work.spark.sparkContext.broadcast(chosen)

    def place(batches):
        pivots = shared.value
        with np.errstate(all="ignore"):
            half = (pivots**2).sum(axis=1) / 2
        for batch in batches:
            with np.errstate(all="ignore"):
                cell = np.nan_to_num(matrix(batch.column("vec"), width) @ pivots.T - half).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], names=["row", *READY_NAMES, "cell"])

    placed = work.write(anchors.select("row", *READY_NAMES).mapInArrow(place, f"row long, {READY}, cell long"), "anchors")
    # a cell of many anchors of one label is split by a hash
    sizes = placed.groupBy("label", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    dealt = placed.join(sizes, ["label", "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))

    def grow(batches):
        now, parts = None, []

        def close():
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            order, parent, level, edge = spanning_tree(matrix(rows.column("vec"), width))
            rows = rows.take(pa.array(order))
            columns = [rows.column(c) for c in ("block", "row", *READY_NAMES)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(len(order)), pa.int32()), pa.array(parent, pa.int32()), pa.array(level, pa.int32()), pa.array(edge)], names=["block", "row", *READY_NAMES, "pos", "parent", "level", "edge"])

        for batch in batches:
            key = list(zip(*(batch.column(c).to_pylist() for c in ("label", "cell", "part")), strict=True))
            cuts = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)] if key else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if key[a] != now:
                    if parts:
                        yield from close()
                    now, parts = key[a], []
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from close()

    block = F.xxhash64("label", "cell", "part").alias("block")
    together = dealt.select(block, "row", *READY_NAMES, "cell", "part").repartition("label", "cell", "part").sortWithinPartitions("label", "cell", "part", "row")
    return work.write(together.mapInArrow(grow, f"block long, row long, {READY}, pos int, parent int, level int, edge double"), "trees")


READY_NAMES = ["id", "label", "norm", "vec"]


class Block:
    """One block of anchors in tree order, with windows and the best rows found in them."""

    def __init__(self, rows: pa.RecordBatch, width: int, k: int):
        self.row, self.label = rows.column("row").to_numpy(), rows.column("label")[0].as_py()
        self.vec, self.norm = matrix(rows.column("vec"), width), rows.column("norm").to_numpy()
        self.parent, self.edge = rows.column("parent").to_numpy(), rows.column("edge").to_numpy()
        level = rows.column("level").to_numpy()
        cuts = np.flatnonzero(np.diff(level, prepend=-1))
        self.levels = list(zip(cuts.tolist(), np.append(cuts[1:], len(level)).tolist(), strict=True))
        lows, highs = rows.column("lows").to_pylist(), rows.column("highs").to_pylist()
        windows = max(map(len, lows))
        self.low, self.high = np.full((len(lows), windows), TOP), np.full((len(lows), windows), -TOP)
        for i, (a, b) in enumerate(zip(lows, highs, strict=True)):
            self.low[i, : len(a)], self.high[i, : len(b)] = a, b
        self.k = k
        self.best = (np.zeros(0, np.int64),) * 4  # anchor, window, score, place

    def walk(self, held: Held, a: int, b: int) -> None:
        """Rows a..b of the held chunk: whole slabs, small ones first, to close windows early."""
        size = 256
        widest = max(y - x for x, y in self.levels)
        while a < b:
            end = min(b, a + min(size, max(64, ENTRIES // widest)))
            self._slab(held, a, end)
            a, size = end, size * 4

    def _slab(self, held, a, b):
        vec, norm = held.vec[a:b], held.norm[a:b]
        found, low, high = [], None, None
        lowest, highest = self.low.min(axis=1), self.high.max(axis=1)
        top = self.norm.max() * norm.max(initial=0)
        for x, y in self.levels:
            mine = self.vec[x:y]
            p = None
            if x:
                with np.errstate(all="ignore"):
                    # the slack covers rounding of scores and bounds
                    wide = self.edge[x:y, None] * norm[None, :] + (self.norm[x:y, None] * norm[None, :] * 1e-9 + 1e-6)
                    up = self.parent[x:y] - before
                    low, high = low[up] - wide, high[up] + wide
                overlap = ~((high < lowest[x:y, None]) | (low > highest[x:y, None]))
                if overlap.mean() <= 0.15:
                    p, q = np.nonzero(overlap)
                    s = pair_scores(mine[p], vec[q], top)
                    low[p, q] = high[p, q] = s
            if p is None:
                every = scores(mine, vec, top)
                low, high = every.astype(np.float64), every.astype(np.float64)
                p, q = np.nonzero((every >= lowest[x:y, None]) & (every <= highest[x:y, None]))
                s = every[p, q]
            else:
                ok = (s >= lowest[x + p]) & (s <= highest[x + p])
                p, q, s = p[ok], q[ok], s[ok]
            other = held.row[a + q] != self.row[x + p]
            found.append((x + p[other], a + q[other], s[other]))
            before = x
        p, q, s = (np.concatenate(z) for z in zip(*found, strict=True))
        if len(p):
            self._keep(held, p, q, s)

    def _keep(self, held, p, q, s):
        i, w = np.nonzero((s[:, None] >= self.low[p]) & (s[:, None] <= self.high[p]))
        p, w, s, q = (np.concatenate(z) for z in zip(self.best, (p[i], w, s[i], q[i]), strict=True))
        order = np.lexsort((held.rank[q], -s, w, p))
        p, w, s, q = p[order], w[order], s[order], q[order]
        group = p * self.low.shape[1] + w
        turn = np.arange(len(group)) - np.searchsorted(group, group)
        last = turn == self.k - 1
        self.low[p[last], w[last]] = np.maximum(self.low[p[last], w[last]], s[last])
        kept = turn < self.k
        self.best = p[kept], w[kept], s[kept], q[kept]

    def result(self, held: Held) -> pa.RecordBatch:
        p, w, s, q = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.row[p]), pa.array(w, pa.int32()), pa.array(held.row[q]), held.id.take(pa.array(q)), pa.array(s)], names=["anchor", "w", "row", "id", "score"])


class Held:
    """The rows of a chunk, by label."""

    def __init__(self, rows: pa.RecordBatch, width: int):
        none, ids = rows.column("id").is_null().to_numpy(zero_copy_only=False), rows.column("id").fill_null(0).to_numpy()
        label, row = rows.column("label").to_numpy(), rows.column("row").to_numpy()
        order = np.lexsort((row, ids, none, label))
        self.label, self.row = label[order], row[order]
        self.id = rows.column("id").take(pa.array(order))
        self.vec, self.norm = matrix(rows.column("vec").take(pa.array(order)), width), rows.column("norm").to_numpy()[order]
        self.rank = np.empty(len(order), np.int64)
        self.rank[np.lexsort((self.row, ids[order], none[order]))] = np.arange(len(order))

    def answer(self, block: Block, same: bool) -> pa.RecordBatch:
        a, b = np.searchsorted(self.label, block.label, "left"), np.searchsorted(self.label, block.label, "right")
        for x, y in [(a, b)] if same else [(0, a), (b, len(self.label))]:
            block.walk(self, int(x), int(y))
        return block.result(self)


def sweep(anchors: DataFrame, rows: DataFrame, chunks: tuple[int, int], ranges: int, width: int, k: int, same: bool) -> DataFrame:
    """HITS: the best k rows of each of the chunks first..last in each window of each anchor."""

    def run(batches):
        now, parts, held, block, asked = None, [], None, None, []

        def answer():
            if asked and held is not None:
                whole = pa.Table.from_batches(asked).combine_chunks().to_batches()[0]
                yield held.answer(Block(whole, width, k), same)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, side, of = (batch.column(c).to_numpy() for c in ("key", "side", "block"))
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (side[1:] != side[:-1]) | (of[1:] != of[:-1])) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if key[a] != now or (side[a] and of[a] != block):
                    yield from answer()
                    asked, block = [], None
                if key[a] != now:
                    now, parts, held = key[a], [], None
                part = batch.slice(a, b - a)
                if side[a] == 0:
                    parts.append(part.select(["row", *READY_NAMES]))
                else:
                    if held is None and parts:
                        held, parts = Held(pa.Table.from_batches(parts).combine_chunks().to_batches()[0], width), []
                    block = of[a]
                    asked.append(part)
        yield from answer()

    def every(first, last):
        return F.explode(F.sequence(F.lit(first), F.lit(last)))

    nothing = {"block": "long", "pos": "int", "parent": "int", "level": "int", "edge": "double"}
    held = rows.where(F.col("chunk").between(*chunks)).withColumn("range", every(0, ranges - 1)).select(
        (F.col("chunk") * ranges + F.col("range")).cast("long").alias("key"), F.lit(0).alias("side"),
        *(F.lit(0).cast(t).alias(c) for c, t in nothing.items()), "row", *READY_NAMES, *(F.array().cast("array<long>").alias(c) for c in ("lows", "highs")),
    )
    asking = anchors.withColumn("chunk", every(*chunks)).select((F.col("chunk") * ranges + F.pmod("block", F.lit(ranges))).cast("long").alias("key"), F.lit(1).alias("side"), *nothing, "row", *READY_NAMES, "lows", "highs")
    dealt = held.unionByName(asking).repartition("key").sortWithinPartitions("key", "side", "block", "pos")
    return dealt.mapInArrow(run, HITS)


def firsts(hits: DataFrame, k: int) -> DataFrame:
    """The first k rows of each window, with their rank."""
    first = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return hits.withColumn("rank", F.row_number().over(first).cast("int")).where(F.col("rank") <= k)


def best_in_windows(anchors: DataFrame, rows: DataFrame, chunks: int, ranges: int, width: int, k: int, same: bool, work: Workspace) -> DataFrame:
    """(anchor, w, row, id, score, rank): the first k rows in each window over all chunks."""
    seeds = -(-chunks // SEED) if chunks > 1 else 0
    if not seeds:
        return work.write(firsts(sweep(anchors, rows, (0, 0), ranges, width, k, same), k), "best")
    begun = work.write(firsts(sweep(anchors, rows, (0, seeds - 1), ranges, width, k, same), k), "seed")
    floor = begun.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("floor"))
    raised = anchors.join(floor.withColumnRenamed("anchor", "row"), "row", "left")
    lows = F.transform("lows", lambda x, i: F.greatest(x, F.coalesce(F.col("floor")[i], x)))
    rest = sweep(raised.withColumn("lows", lows), rows, (seeds, chunks - 1), ranges, width, k, same)
    return work.write(firsts(begun.drop("rank").unionByName(rest), k), "best")


def hard_negatives(
    vectors: DataFrame, is_anchor, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 3, shares: tuple[int, int] = (50, 95), scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A negative scores between shares[0] and shares[1] per cent of the positive's score.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "hard-negatives")
    ready = work.write(integers(vectors, id_col, vec_col, label_col, scale).withColumn("row", F.monotonically_increasing_id()), "rows")
    anchors = ready.where(is_anchor("id"))
    bytes_each = F.when(F.substring("vec", 1, 1) == F.lit(bytearray(b"\x02")), 2).otherwise(8)
    asked, width = ready.agg(F.count_if(is_anchor("id")), F.max(((F.length("vec") - 1) / bytes_each).cast("int"))).first()
    if not asked:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    grown = trees(anchors, work, width)
    # of equal rows only the first ones can win
    copy = Window.partitionBy("vec", "label").orderBy(F.col("id").asc_nulls_last(), "row")
    rows = work.write(ready.withColumn("copy", F.row_number().over(copy)).where(F.col("copy") <= max(positives + 1, negatives)).drop("copy"), "first")
    count = rows.count()
    chunks = max(-(-count // max(1, HELD // width)), min(spark.sparkContext.defaultParallelism, count // CHUNK), 1)
    ranges = max(1, -(-(count // chunks) * asked // WORK))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))

    def whole(c):
        return F.array(F.lit(c).cast("long"))

    open_ = grown.withColumns({"lows": whole(-TOP), "highs": whole(TOP)})
    near = best_in_windows(open_, rows, chunks, ranges, width, positives, True, work)
    near = near.select("anchor", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    wide = F.col("positive_score").cast("decimal(25,0)")
    low, high = F.ceil(wide * shares[0] / 100).cast("long"), F.floor(wide * shares[1] / 100).cast("long")
    window = near.select("anchor", F.struct("w", low.alias("low"), high.alias("high")).alias("window"))
    windows = window.groupBy("anchor").agg(F.sort_array(F.collect_list("window")).alias("windows"))  # at most `positives`
    aimed = grown.join(windows.withColumnRenamed("anchor", "row"), "row", "left")
    empty = F.array(F.struct(F.lit(0).alias("w"), F.lit(TOP).alias("low"), F.lit(-TOP).alias("high")))
    aimed = aimed.withColumn("windows", F.coalesce("windows", empty)).withColumns({"lows": F.col("windows.low"), "highs": F.col("windows.high")}).drop("windows")
    hard = best_in_windows(work.write(aimed, "windows"), rows, chunks, ranges, width, negatives, False, work)
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return hard.join(near, ["anchor", "w"]).join(named, "anchor").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", wrong.alias("label")), lambda c: F.col(c) % 50 == 0)


SQL = """
WITH whole AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT * FROM (SELECT anchor_id, other, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS r FROM scored WHERE same) WHERE r <= 5),
negatives AS (SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""
