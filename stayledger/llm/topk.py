"""Exact top-k inner products over norm-sorted vectors.

Components become integers, so scores are exact. Candidates are cut into cells of similar
length, longest first; inside a cell they are processed by descending length. In the basis
of a singular value decomposition a few leading components give a partial sum, and the
lengths of the rest bound what is missing (Cauchy-Schwarz): a candidate goes on only while
that bound reaches the query's k-th score so far. What is left is scored in integers.

A first pass over the longest cell gives each query a k-th score; a second pass sends it
only to cells whose longest vector could still reach it. Queries travel in blocks.

Left out: rows whose id is null, whose vector is null, empty or holds a null or non-finite
component, and vectors too long for a 64-bit score. Shorter vectors count as padded with
zeros. Repeated rows of one id count as one candidate, by its best score. Equal scores go
to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, table

#: Candidates in a cell; queries in a block; rows the rotation is fitted on.
CELL, BLOCK, SAMPLE = 8192, 1024, 4096
#: At most so many ranges of length are told apart; a range with more rows is split by id.
RANGES = 4096
ROWS = 1024
SCHEMA = "id long, norm double, vec binary"


def integers(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, norm, vec): whole components floor(scale * x) as little-endian doubles."""

    def run(batches):
        for batch in batches:
            ids, norms, out = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = v.values if v.is_valid else None
                if i is None or values is None or not len(values) or values.null_count:
                    continue
                with np.errstate(all="ignore"):
                    x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
                    size = x @ x
                if np.isfinite(size) and size < 2.0**62:
                    ids.append(i)
                    norms.append(float(np.sqrt(size)))
                    out.append(x.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(norms, pa.float64()), pa.array(out, pa.binary())], names=["id", "norm", "vec"])

    return vectors.select(F.col(id_col).cast("long"), F.col(vec_col)).mapInArrow(run, SCHEMA)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a binary column side by side, padded with zeros."""
    out = np.zeros((len(column), width))
    for k, v in enumerate(column.to_pylist()):
        x = np.frombuffer(v, "<f8")
        out[k, : len(x)] = x
    return out


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles are exact while sums stay below 2^53."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    top = np.sqrt((a * a).sum(axis=1).max() * (b * b).sum(axis=1).max())
    if top < 2.0**52:
        return np.rint(a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


class Search:
    """The k best of one query block, as candidates stream by in descending length."""

    def __init__(self, queries: pa.RecordBatch, k: int, width: int, rotation: np.ndarray):
        self.ids = queries.column(0).to_numpy()
        self.vec = matrix(queries.column(1), width)
        self.floor = queries.column(2).to_numpy()
        self.norm = np.sqrt((self.vec**2).sum(axis=1))
        self.rotation, self.k = rotation, k
        self.turned = self.vec @ rotation
        self.best = (np.zeros(0, np.int64),) * 3  # query number, score, id
        self.cuts = [c for c in (8, 24) if c < width]

    def add(self, ids: np.ndarray, vec: np.ndarray) -> None:
        for at in range(0, len(ids), ROWS):
            self._add(ids[at : at + ROWS], vec[at : at + ROWS])

    def _add(self, ids, vec):
        norm = np.sqrt((vec**2).sum(axis=1))
        slack = 1e-9 * np.outer(self.norm, norm) + 1e-6
        live = np.outer(self.norm, norm) + slack >= self.floor[:, None]
        keep = live.any(axis=0)
        if not keep.any():
            return
        ids, vec, norm, slack, live = ids[keep], vec[keep], norm[keep], slack[:, keep], live[:, keep]
        turned = vec @ self.rotation
        partial, before = np.zeros(live.shape), 0
        for cut in self.cuts:
            partial += self.turned[:, before:cut] @ turned[:, before:cut].T
            before = cut
            rest = np.outer(np.sqrt((self.turned[:, cut:] ** 2).sum(axis=1)), np.sqrt((turned[:, cut:] ** 2).sum(axis=1)))
            live &= partial + rest + slack >= self.floor[:, None]
            keep = live.any(axis=0)
            if not keep.any():
                return
            ids, vec, turned, slack, live, partial = ids[keep], vec[keep], turned[keep], slack[:, keep], live[:, keep], partial[:, keep]
        score = exact(self.vec, vec)
        q, c = np.nonzero(live & (score >= self.floor[:, None]) & (ids[None, :] != self.ids[:, None]))
        q, s, i = (np.concatenate(x) for x in zip(self.best, (q, score[q, c], ids[c]), strict=True))
        q, i, s = distinct_best(q, i, s)
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        turn = np.arange(len(q)) - np.searchsorted(q, q)
        kept = turn < self.k
        last = turn == self.k - 1
        self.best = q[kept], s[kept], i[kept]
        self.floor = self.floor.copy()
        self.floor[q[last]] = np.maximum(self.floor[q[last]], s[last])

    def result(self) -> pa.RecordBatch:
        q, s, i = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(i), pa.array(s)], names=["query_id", "vec_id", "score"])


def distinct_best(q, i, s):
    """One row per (query, id): the best score."""
    order = np.lexsort((-s, i, q))
    q, i, s = q[order], i[order], s[order]
    first = np.append(True, (q[1:] != q[:-1]) | (i[1:] != i[:-1])) if len(q) else np.zeros(0, bool)
    return q[first], i[first], s[first]


def probe(rows: DataFrame, k: int, width: int, rotation) -> DataFrame:
    """(query_id, vec_id, score) per (cell, block): rows are (key, side, ord, id, vec, floor).

    In a sorted run the queries of a block come first, then candidates by descending length.
    """
    shared = rows.sparkSession.sparkContext.broadcast(rotation)

    def run(batches):
        now, asked, search = None, [], None
        for batch in batches:
            key, side = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.array(key[1:]) != np.array(key[:-1])) | (side[1:] != side[:-1])) + 1).tolist(), len(key)] if len(key) else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                if key[a] != now:
                    if search is not None:
                        yield search.result()
                    now, asked, search = key[a], [], None
                if side[a] == 0:
                    asked.append(part.select(["id", "vec", "floor"]))
                elif asked:
                    if search is None:
                        whole = pa.Table.from_batches(asked).combine_chunks().to_batches()[0]
                        search = Search(whole, k, width, shared.value)
                    search.add(part.column(3).to_numpy(), matrix(part.column(4), width))
        if search is not None:
            yield search.result()

    dealt = rows.repartition("key").sortWithinPartitions("key", "side", "ord")
    return dealt.select("key", "side", "ord", "id", "vec", "floor").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query row."""
    spark = vectors.sparkSession
    work = Workspace(spark, "topk")
    ready = work.write(integers(vectors, id_col, vec_col, scale), "integers").select("id", "norm", "vec")
    count, width, asked = ready.agg(F.count("*"), F.coalesce(F.max(F.length("vec") / 8), F.lit(0)).cast("int"), F.count_if(is_query("id"))).first()
    if not count or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    fitted = ready.orderBy(F.xxhash64("id"), "id").limit(max(1, min(SAMPLE, (1 << 22) // width))).select("vec").toPandas()
    rotation = np.linalg.svd(matrix(pa.array(fitted["vec"]), width), full_matrices=True)[2].T

    # cells: ranges of length, longest first; a range of many equal lengths is split by id
    target = max(CELL, -(-count // RANGES))
    ranges = max(1, -(-count // target))
    edges = sorted(set(ready.approxQuantile("norm", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges)))) if ranges > 1 else []
    bound = F.array(*map(F.lit, edges)) if edges else F.array().cast("array<double>")
    place = F.lit(len(edges)) - F.size(F.filter(bound, lambda e: e <= F.col("norm")))
    placed = ready.withColumn("range", place)
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"), F.max("norm").alias("top")).orderBy("range").collect()
    split = {r.range: -(-r.n // (2 * target)) for r in sizes}
    first, cells = {}, []
    for r in sizes:
        first[r.range] = len(cells)
        cells += [r.top] * split[r.range]
    start = F.element_at(F.array(*[F.lit(first.get(i, 0)) for i in range(len(edges) + 1)]), F.col("range") + 1)
    parts = F.element_at(F.array(*[F.lit(split.get(i, 1)) for i in range(len(edges) + 1)]), F.col("range") + 1)
    placed = placed.withColumn("cell", start + F.pmod(F.xxhash64("id"), parts))

    blocks = -(-asked // BLOCK)
    block = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks))
    queries = ready.where(is_query("id")).dropDuplicates(["id", "vec"]).withColumn("block", block)

    def meet(asking: DataFrame, candidates: DataFrame) -> DataFrame:
        """asking: (id, vec, floor, block, cell)."""
        q = asking.select((F.col("cell") * blocks + F.col("block")).cast("long").alias("key"), F.lit(0).alias("side"), F.lit(0.0).alias("ord"), "id", "vec", "floor")
        each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0)
        c = candidates.withColumn("block", each).select((F.col("cell") * blocks + F.col("block")).cast("long").alias("key"), F.lit(1).alias("side"), (-F.col("norm")).alias("ord"), "id", "vec", F.lit(0).cast("long").alias("floor"))
        return probe(q.union(c), k, width, rotation)

    nothing = -(1 << 62)
    head = work.write(meet(queries.withColumn("cell", F.lit(0)).withColumn("floor", F.lit(nothing).cast("long")), placed.where("cell = 0")), "head")
    found = head
    if len(cells) > 1:
        kth = head.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
        tops = F.array(*[F.struct(F.lit(i).alias("cell"), F.lit(float(top)).alias("top")) for i, top in enumerate(cells)][1:])
        floor = F.coalesce("kth", F.lit(nothing)).cast("long")
        asking = queries.join(kth, queries["id"] == kth["query_id"], "left").withColumn("floor", floor)
        reach = F.filter(tops, lambda c: c.top * F.col("norm") * (1 + 1e-9) + 1e-6 >= F.col("floor"))
        asking = asking.withColumn("c", F.explode(reach)).withColumn("cell", F.col("c.cell"))
        found = head.union(meet(asking, placed.where("cell > 0")))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_topk(spark, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), lambda c: F.col(c) % 100 == 0)
