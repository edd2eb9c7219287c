"""Near-duplicate vectors by tile products of 8-bit codes.

Equal vectors are one class. A class vector x of length one is s*q + e with q in -127..127,
so a cosine is s*s' q.q' within |e'| |s q| + |e|: an 8-bit product with an error bound of the
two vectors. Pairs whose bound lies over the threshold are linked, pairs whose bound lies
under it are not, and the rest (the window) is computed again from the given components in
double precision.

Classes are put in cells by their nearest pivot (a hash-ordered sample). A vector is sent to
a later cell only if that cell's radius and the plane between the two pivots let a vector of
the cell lie within the threshold's angle; cells are cut into tiles of TILE vectors and the
vectors sent to them into chunks of TILE, so a task multiplies two tiles whatever the group.
The first pass moves the 8-bit codes only. Vectors of window pairs, and only those, are sent
a second time with all their components to the tile pair they met in.

A tile pair emits a count per linked vector and a spanning forest, never its pairs. Vectors
without structure reach every cell: the products then are those of all pairs, and each code
is sent to about (vectors / TILE) / 2 tasks.

Vectors that are null, empty, zero or hold a null or non-finite component link with nothing:
n_links 0, component_id their own id. Shorter vectors count as padded with zeros. Repeated
rows are linked with each other like any equal vectors. A row without id takes part in
links, names no component and is not kept. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, attach, components, pivots_of, spanning_edges, table

#: Vectors of a cell aimed at, cells at most, vectors of a tile, entries of a product at once.
CELL, CELLS, TILE, PRODUCT = 4096, 4096, 32768, 1 << 23
#: Components held by a tile at most, and by the pivots.
HELD = 1 << 22
#: Pairs computed again at once.
PAIRS = 1 << 17
FOUND = "kind int, a long, b long, side int"
EDGE, COUNT, WINDOW = 0, 1, 2
INDEX, PROBE, BOTH = 0, 1, 2


def raw_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """((id, vec), dtype): the components as bytes, null where the vector takes no part."""
    single = isinstance(vectors.schema[vec_col].dataType, T.ArrayType) and isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    dtype = "<f4" if single else "<f8"

    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column(1):
                values = v.values if v.is_valid else None
                if values is None or not len(values) or values.null_count:
                    out.append(None)
                    continue
                x = values.to_numpy(zero_copy_only=False)
                out.append(x.astype(dtype).tobytes() if np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "vec"])

    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>" if single else "array<double>"))
    return chosen.mapInArrow(run, "id long, vec binary"), dtype


def units(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """Rows of length one as doubles, padded with zeros; no component overflows on the way."""
    out = np.zeros((len(column), width))
    for k, v in enumerate(column.to_pylist()):
        x = np.frombuffer(v, dtype)
        out[k, : len(x)] = x
    if len(out):
        out /= np.abs(out).max(axis=1, keepdims=True)
        out /= np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]
    return out


class Codes:
    """8-bit codes of unit vectors: x = scale * code + error, |error| <= miss."""

    def __init__(self, code: np.ndarray, scale: np.ndarray, miss: np.ndarray):
        self.code, self.scale, self.miss = code, scale, miss
        # rounding of lengths and scales is far under this
        self.size = scale * np.sqrt((code.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-12)

    @classmethod
    def of(cls, unit: np.ndarray) -> Codes:
        scale = np.abs(unit).max(axis=1, initial=0) / 127
        code = np.rint(unit / np.where(scale > 0, scale, 1)[:, None]).astype(np.int8)
        rest = unit - scale[:, None] * code
        return cls(code, scale, np.sqrt((rest**2).sum(axis=1)) * (1 + 1e-9) + 1e-14)

    def single(self) -> np.ndarray:
        return self.code.astype(np.float32) * self.scale.astype(np.float32)[:, None]

    def take(self, rows) -> Codes:
        return Codes(self.code[rows], self.scale[rows], self.miss[rows])


class Tile:
    """Links between an index tile and the vectors that stream past it."""

    def __init__(self, node, many, codes: Codes, unit, threshold: float):
        self.node, self.many, self.codes, self.unit, self.threshold = node, many, codes, unit, threshold
        self.flat = codes.single()
        self.label = np.arange(len(node))
        self.count = np.zeros(len(node), np.int64)
        self.in_window = np.zeros(len(node), bool)
        self.rows = max(1, PRODUCT // max(1, len(node)))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def meet(self, node, many, codes: Codes, unit, same: bool):
        """(count, in_window) of the given vectors; same: they are the index itself."""
        count, window = np.zeros(len(node), np.int64), np.zeros(len(node), bool)
        for at in range(0, len(node), self.rows):
            part = slice(at, at + self.rows)
            count[part], window[part] = self._meet(node[part], many[part], codes.take(part), None if unit is None else unit[part], at if same else None)
        return count, window

    def _meet(self, node, many, codes, unit, offset):
        width = self.flat.shape[1]
        worst = codes.miss.max() + codes.size.max() * self.codes.miss.max()
        slack = (width + 8) * 2.0**-22 * 1.1
        value = codes.single() @ self.flat.T
        if offset is not None:  # each pair of the index once
            value[np.arange(len(self.node))[None, :] <= np.arange(offset, offset + len(node))[:, None]] = -9
        sure = value >= self.threshold + worst + slack
        i, j = np.nonzero((value >= self.threshold - worst - slack) & ~sure)
        del value
        # whole numbers decide, so that both passes see the same window
        dot = np.empty(len(i))
        for at in range(0, len(i), PAIRS):
            p = slice(at, at + PAIRS)
            dot[p] = np.einsum("ij,ij->i", codes.code[i[p]].astype(np.int64), self.codes.code[j[p]].astype(np.int64))
        near = codes.scale[i] * self.codes.scale[j] * dot
        bound = codes.miss[i] + codes.size[i] * self.codes.miss[j] + 1e-12
        over, open_ = near - bound >= self.threshold, (near + bound >= self.threshold) & (near - bound < self.threshold)
        window = np.zeros(len(node), bool)
        if unit is None:
            sure[i[over], j[over]] = True
            window[i[open_]] = True
            self.in_window[j[open_]] = True
        else:  # the second pass: sure pairs are counted already
            sure[:] = False
            i, j = i[open_], j[open_]
            for at in range(0, len(i), PAIRS):
                p, q = i[at : at + PAIRS], j[at : at + PAIRS]
                sure[p, q] = np.einsum("ij,ij->i", unit[p], self.unit[q]) >= self.threshold
        count = np.zeros(len(node), np.int64)
        hit = np.flatnonzero(sure.any(axis=1))
        if len(hit):
            sure = sure[hit]
            count[hit] = np.rint(sure @ self.many.astype(np.float64)).astype(np.int64)
            self.count += np.rint(many[hit].astype(np.float64) @ sure).astype(np.int64)
            self._join(node[hit], sure, None if offset is None else hit + offset)
        return count, window

    def _join(self, node, sure, own):
        """Edges that join vectors not joined yet in this task."""
        first = sure.argmax(axis=1)
        if own is None:
            label = self.label[first]
            self.edges.append((node, self.node[first]))
        else:
            label = self.label[own]
        p, q = np.nonzero(sure & (label[:, None] != self.label[None, :]))
        if not len(p):
            return
        pairs = np.unique(np.stack([label[p], self.label[q]]), axis=1)
        child, root = spanning_edges(pairs[0], pairs[1])
        to = np.arange(len(self.label))
        to[child] = root
        # a label is a place of the index, whose node stands for it
        self.edges.append((self.node[child], self.node[root]))
        self.label = to[self.label]

    def result(self, key: int, side: int) -> pa.RecordBatch:
        edges = [np.concatenate(x) for x in zip(*self.edges, strict=True)] if self.edges else [np.zeros(0, np.int64)] * 2
        self.edges = []
        out = found(EDGE, edges[0], edges[1], 0), tally(self.node, self.count), found(WINDOW, np.full(int(self.in_window.sum()), key), self.node[self.in_window], side)
        return pa.Table.from_batches(out).combine_chunks().to_batches()


def found(kind: int, a, b, side: int) -> pa.RecordBatch:
    n = len(a)
    columns = [np.full(n, kind, np.int32), np.asarray(a, np.int64), np.asarray(b, np.int64), np.full(n, side, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "a", "b", "side"])


def tally(node, count) -> pa.RecordBatch:
    some = count > 0
    return found(COUNT, node[some], count[some], 0)


def tile_links(rows: DataFrame, threshold: float, dtype: str, width: int, full: bool) -> DataFrame:
    """Edges, counts and window vectors of every tile pair.

    rows are (key, side, node, many, code, scale, miss), or (key, side, node, many, vec) with
    all components; in a sorted run a key's index comes before the vectors it meets.
    """

    def unpack(batch):
        node, many = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        if full:
            unit = units(batch.column(4), dtype, width)
            return node, many, Codes.of(unit), unit
        code = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.int8).reshape(len(batch), width)
        return node, many, Codes(code, batch.column(5).to_numpy(), batch.column(6).to_numpy()), None

    def whole(parts):
        node, many = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        codes = Codes(*(np.concatenate([getattr(p[2], k) for p in parts]) for k in ("code", "scale", "miss")))
        return node, many, codes, np.concatenate([p[3] for p in parts]) if full else None

    def run(batches):
        now, parts, tile, own = None, [], None, False

        def close():
            nonlocal tile
            if own and parts:
                tile = Tile(*whole(parts), threshold)
                count, window = tile.meet(tile.node, tile.many, tile.codes, tile.unit, True)
                tile.count += count
                tile.in_window |= window
            if tile is not None:
                yield from tile.result(now, BOTH if own else INDEX)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if key[a] != now:
                    yield from close()
                    now, parts, tile, own = int(key[a]), [], None, bool(side[a] == BOTH)
                part = unpack(batch.slice(a, b - a))
                if side[a] != PROBE:
                    parts.append(part)
                elif parts:
                    if tile is None:
                        tile = Tile(*whole(parts), threshold)
                    count, window = tile.meet(*part, False)
                    yield tally(part[0], count)
                    yield found(WINDOW, np.full(int(window.sum()), now), part[0][window], PROBE)
        yield from close()

    names = ["key", "side", "node", "many", *(["vec"] if full else ["code", "scale", "miss"])]
    return rows.select(*names).repartition("key").sortWithinPartitions("key", "side").mapInArrow(run, FOUND)


class Cells:
    """Pivots, and which cells a vector can have a link in."""

    def __init__(self, pivots: np.ndarray, threshold: float):
        self.pivots = pivots
        self.plain = pivots, threshold  # what broadcasts carry: executors need no package
        gap = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
        self.angle = math.acos(min(1.0, max(-1.0, threshold))) + 1e-6
        self.gap = gap * math.sin(min(self.angle, math.pi / 2)) + 1e-9

    def nearest(self, unit):
        likeness = unit @ self.pivots.T
        cell = likeness.argmax(axis=1)
        return cell, np.arccos(np.clip(likeness[np.arange(len(cell)), cell], -1, 1))

    def reach(self, unit, cell, radius):
        """Where a later cell may hold a vector within the angle."""
        likeness = unit @ self.pivots.T
        mine = likeness[np.arange(len(cell)), cell]
        ok = np.arccos(np.clip(likeness, -1, 1)) <= radius[None, :] + self.angle + 1e-6
        if self.angle < math.pi / 2:
            ok &= mine[:, None] - likeness <= self.gap[cell]
        return ok & (np.arange(len(self.pivots))[None, :] > cell[:, None])


def deal(classes: DataFrame, cells, dtype: str, width: int, radius, tiles, chunks, full: bool = False) -> DataFrame:
    """(key, side, node, many, code, scale, miss): every class in each tile pair it takes part in."""
    base = np.concatenate([[0], np.cumsum(tiles * tiles + tiles * chunks)])
    shared = classes.sparkSession.sparkContext.broadcast((*cells.plain, radius, tiles, chunks, base))

    def run(batches):
        *plain, radius, tiles, chunks, base = shared.value
        cells = Cells(*plain)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                node, many, cell, mix = (part.column(k).to_numpy() for k in (0, 1, 3, 4))
                unit = units(part.column(2), dtype, width)
                codes = Codes.of(unit)
                payload = pa.array([c.tobytes() for c in codes.code], pa.binary())
                reach = cells.reach(unit, cell, radius)
                out = []  # (row, key, side)
                own_tile = mix % tiles[cell]
                for t in np.unique(tiles[cell]).tolist():
                    r = np.flatnonzero(tiles[cell] == t)
                    for k in range(t):
                        mine = own_tile[r]
                        low, high = np.minimum(mine, k), np.maximum(mine, k)
                        out.append((r, base[cell[r]] + low * t + high, np.where(mine == k, BOTH, np.where(mine < k, INDEX, PROBE))))
                for c in np.unique(chunks[cell]).tolist():
                    r = np.flatnonzero(chunks[cell] == c)
                    t = tiles[cell[r]]
                    for k in range(c):
                        out.append((r, base[cell[r]] + t * t + own_tile[r] * c + k, np.full(len(r), INDEX)))
                r, b = np.nonzero(reach)
                for k in range(int(tiles[b].max()) if len(b) else 0):
                    some = tiles[b] > k
                    rr, bb = r[some], b[some]
                    out.append((rr, base[bb] + tiles[bb] ** 2 + k * chunks[bb] + (mix[rr] // 65536) % np.maximum(1, chunks[bb]), np.full(len(rr), PROBE)))
                for rows, key, side in out:
                    pick = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(side, pa.int32()), pa.array(node[rows]), pa.array(many[rows]), payload.take(pick), pa.array(codes.scale[rows]), pa.array(codes.miss[rows])], names=["key", "side", "node", "many", "code", "scale", "miss"])

    return classes.select("node", "many", "vec", "cell", "mix").mapInArrow(run, "key long, side int, node long, many long, code binary, scale double, miss double")


def class_links(classes: DataFrame, work: Workspace, threshold: float, dtype: str) -> DataFrame:
    """(kind, a, b, side): edges and counts between the classes (node, many, vec)."""
    spark = work.spark
    count, width = classes.agg(F.count("*"), F.coalesce(F.max(F.length("vec") / int(dtype[-1])), F.lit(1)).cast("int")).first()
    wanted = max(1, min(-(-count // CELL), CELLS, HELD // width))
    chosen = pivots_of(classes, F.xxhash64("node"), wanted).select("vec").toPandas()
    cells = Cells(units(pa.array(chosen["vec"], pa.binary()), dtype, width), threshold)
    shared = spark.sparkContext.broadcast(cells.plain)

    def place(batches):
        cells = Cells(*shared.value)
        for batch in batches:
            cell, angle = cells.nearest(units(batch.column(2), dtype, width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64()), pa.array(angle)], names=["node", "many", "vec", "cell", "angle"])

    mixed = F.pmod(F.xxhash64("node"), F.lit(1 << 48)).alias("mix")
    placed = work.write(classes.select("node", "many", "vec").mapInArrow(place, "node long, many long, vec binary, cell long, angle double").select("*", mixed), "cells")
    n, radius = np.zeros(max(1, len(cells.pivots)), np.int64), np.full(max(1, len(cells.pivots)), -10.0)
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect():
        n[r.cell], radius[r.cell] = r.n, r.radius
    far = spark.sparkContext.broadcast(radius)

    def visits(batches):
        seen, cells = np.zeros(len(far.value), np.int64), Cells(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                seen += cells.reach(units(part.column(0), dtype, width), part.column(1).to_numpy(), far.value).sum(axis=0)
        cell = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(seen[cell])], names=["cell", "n"])

    asked = np.zeros(len(n), np.int64)
    for r in placed.select("vec", "cell").mapInArrow(visits, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        asked[r.cell] = r.n
    tile = max(1, min(TILE, HELD // width))
    tiles, chunks = np.maximum(1, -(-n // tile)), -(-asked // tile)
    first = work.write(tile_links(deal(placed, cells, dtype, width, radius, tiles, chunks), threshold, dtype, width, False), "links")
    window = first.where(F.col("kind") == WINDOW).select(F.col("a").alias("key"), F.col("b").alias("node"), "side").distinct()
    again = window.join(placed.select("node", "many", "vec"), "node")
    second = work.write(tile_links(again, threshold, dtype, width, True), "window")
    return first.where(F.col("kind") != WINDOW).unionByName(second.where(F.col("kind") != WINDOW))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per vector."""
    work = Workspace(vectors.sparkSession, "embed-dedup")
    raw, dtype = raw_vectors(vectors, id_col, vec_col)
    raw = work.write(raw, "raw")
    grouped = raw.where("vec is not null").groupBy("vec").agg(F.count("*").alias("many"), F.min("id").alias("least"))
    classes = work.write(grouped.select(F.monotonically_increasing_id().alias("node"), "vec", "many", "least"), "classes")
    links = class_links(classes, work, threshold, dtype)
    edges = links.where(F.col("kind") == EDGE).select("a", "b")
    counts = links.where(F.col("kind") == COUNT).groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    groups = work.write(components(edges, work), "groups")
    keys = [F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit(7), "vec").alias("k2")]
    named = classes.select("node", "many", "least", *keys).join(counts, "node", "left").join(groups, "node", "left")
    named = work.write(named.withColumn("root", F.coalesce("root", "node")), "named")
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = attach(named, roots, ["root"]).select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id")
    alone = raw.where("vec is null").select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    rows = attach(raw.where("vec is not null").select(F.col("id").alias("vec_id"), *keys), work.write(facts, "facts"), ["k1", "k2"])
    both = rows.select("vec_id", "n_links", "component_id").unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op11_embed_dedup(spark, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


SQL = """
WITH RECURSIVE parts AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
whole AS (SELECT vec_id, v FROM parts WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM whole a JOIN whole b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""
