"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's 64-bit fingerprint sets a bit when over half of its shingle hashes set it.
Fingerprints within `radius` bits are linked. Bits that vary together are put into the
same partition; each fingerprint then gets its own radius per partition (-1 means: not
probed) by dynamic programming over candidate counts estimated from histograms, with
sum radius - partitions + 1, which no pair within the radius can escape. Probes meet
the indexed values of their partition in sorted runs and are verified on the full
fingerprint.

Nulls: a null text has no words. No words: fingerprint zero, linked like any other.
Rows are never merged: repeated rows get the same answer; a null id takes part in links
but is no component's name. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, components, spanning_edges, texts

BINS = 1 << 16
#: Index rows of one value that a task holds; larger groups are cut into a grid of cells.
BLOCK = 4096
#: What a probe row costs, counted in candidate comparisons.
PROBE_COST = 300
SLAB = 1 << 21


def fingerprint(text: bytes, width: int) -> int:
    """The 64-bit fingerprint of one text over word shingles."""
    import xxhash

    words = text.lower().split()
    count = len(words)
    if not count:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, count) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(width, count)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[i:j], 42) for i, j in zip(starts[: count - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[at : at + (1 << 15)], dtype="<u8")
        set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            fp = np.fromiter((fingerprint(t, width) for t in texts(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, fp long")


def bit_groups(fps: DataFrame, parts: int) -> list[list[int]]:
    """64 bit positions in groups of about equal size, bits that vary together in one group."""

    def run(batches):
        both, n = np.zeros((64, 64)), 0
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        i, j = np.divmod(np.arange(4096), 64)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1)), pa.array(np.append(j, -1)), pa.array(np.append(both.ravel().round().astype(np.int64), n))], names=["i", "j", "n"])

    counts = {(r.i, r.j): r.n for r in fps.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()}
    n = max(1, counts.get((-1, -1), 0))
    both = np.array([[counts.get((i, j), 0) for j in range(64)] for i in range(64)]) / n
    mean = both.diagonal()
    sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    likeness = np.abs((both - np.outer(mean, mean)) / np.outer(sd, sd))
    np.fill_diagonal(likeness, 0)
    left, groups = set(range(64)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        rest = sorted(left)
        group = [max(rest, key=lambda b: likeness[b, rest].max())]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(max(rest, key=lambda b: likeness[b, group].mean()))
        groups.append(group)
        left -= set(group)
    return groups


def choose_parts(count: int, radius: int) -> int:
    """How many partitions cost least for so many fingerprints, at evenly spread values."""
    def cost(m: int) -> float:
        total, width = radius - m + 1, 64 // m
        share = [total // m + (i < total % m) for i in range(m)]
        probes = sum(len(ball(width, t)) for t in share if t >= 0)
        return probes * (PROBE_COST + count / 2.0**width)

    return min(range(2, radius + 2), key=cost) if radius >= 1 else 1


def ball(width: int, radius: int) -> np.ndarray:
    """All masks of a width with at most radius bits."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]
    return np.array(masks, np.int64)


def values(fp: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of one partition, side by side."""
    out = np.zeros(len(fp), np.int64)
    for k, bit in enumerate(group):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def bins(value: np.ndarray, width: int) -> np.ndarray:
    """The histogram bin of a partition value: itself up to 16 bits, else mixed."""
    if width <= 16:
        return value
    return ((value.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def allocate(costs: list[dict[int, np.ndarray]], total: int) -> np.ndarray:
    """The cheapest radius per partition for each row, summing to total (dynamic programming)."""
    m, n = len(costs), len(next(iter(costs[0].values())))
    low = -m
    best = {0: np.zeros(n)}
    picks = []
    for cost in costs:
        new, pick = {}, {}
        for have, so_far in best.items():
            for t, c in cost.items():
                to = have + t
                if to < low or to > total + m:
                    continue
                value = so_far + c
                if to not in new:
                    new[to], pick[to] = value, np.full(n, t, np.int8)
                else:
                    better = value < new[to]
                    new[to] = np.where(better, value, new[to])
                    pick[to] = np.where(better, np.int8(t), pick[to])
        best = new
        picks.append(pick)
    out = np.zeros((n, m), np.int8)
    at = np.full(n, total)
    for i in range(m - 1, -1, -1):
        for state, pick in picks[i].items():
            mine = at == state
            out[mine, i] = pick[mine]
        at = at - out[:, i]
    return out


def probes(fps: DataFrame, groups: list[list[int]], histogram: np.ndarray, radius: int) -> DataFrame:
    """(key, probe, fp): each fingerprint's indexed values and the values it probes."""
    m, total = len(groups), radius - len(groups) + 1
    # a partition may be asked to take all of the radius when the others are crowded, as far as its ball stays small
    most = [max(t for t in range(max(0, total) + 1) if t <= -(-total // m) or len(ball(len(g), t)) <= 1024) for g in groups]
    shared = fps.sparkSession.sparkContext.broadcast(histogram)

    def emit(key, value, cell):
        return (np.int64(key) << 56) | (value << 24) | cell

    def run(batches):
        hist = shared.value
        balls = [[ball(len(g), t) for t in range(k + 1)] for g, k in zip(groups, most, strict=True)]
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                fp = whole.column(0).slice(at, 4096).to_numpy().view(np.uint64)
                mixed = ((fp * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.int64)
                vals = [values(fp, g) for g in groups]
                costs = []
                for i, g in enumerate(groups):
                    seen, cost = np.zeros(len(fp)), {-1: np.zeros(len(fp))}
                    done = 0
                    for t in range(most[i] + 1):
                        for mask in balls[i][t][done:]:
                            seen = seen + hist[i, bins(vals[i] ^ mask, len(g))]
                        done = len(balls[i][t])
                        cost[t] = seen + PROBE_COST * done
                    costs.append(cost)
                radii = allocate(costs, total)
                for i, g in enumerate(groups):
                    blocks = -(-hist[i, bins(vals[i], len(g))].astype(np.int64) // BLOCK)
                    blocks = np.maximum(blocks, 1)
                    rows = np.repeat(np.arange(len(fp)), blocks)
                    other = np.arange(len(rows)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    cell = (mixed[rows] % blocks[rows]) * blocks[rows] + other
                    yield batch_of(emit(i, vals[i][rows], cell), False, fp[rows])
                    for t in range(most[i] + 1):
                        mine = np.flatnonzero(radii[:, i] == t)
                        if not len(mine):
                            continue
                        value = (vals[i][mine][:, None] ^ balls[i][t][None, :]).ravel()
                        rows = np.repeat(mine, len(balls[i][t]))
                        count = hist[i, bins(value, len(g))].astype(np.int64)
                        # an empty value has no index rows, so nothing to meet
                        value, rows, count = value[count > 0], rows[count > 0], count[count > 0]
                        blocks = -(-count // BLOCK)
                        again = np.repeat(np.arange(len(rows)), blocks)
                        a = np.arange(len(again)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                        cell = a * blocks[again] + mixed[rows[again]] % blocks[again]
                        yield batch_of(emit(i, value[again], cell), True, fp[rows[again]])

    return fps.select("fp").mapInArrow(run, "key long, probe boolean, fp long")


def batch_of(key, probe, fp):
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(key), probe)), pa.array(fp.view(np.int64))], names=["key", "probe", "fp"])


def verify(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b): edges whose components are those of all probe-index pairs within the radius.

    Rows of one key come in a sorted run, index rows first. A task holds the index rows
    of the run it is in (at most about BLOCK) and the current batch; edges of a batch are
    reduced to a star forest, so a dense group gives as many edges as nodes.
    """

    def run(batches):
        held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate([held_key, batch.column(0).to_numpy()])
            probe = np.concatenate([np.zeros(len(held_key), bool), batch.column(1).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([held, batch.column(2).to_numpy().view(np.uint64)])
            index_key, index_fp = key[~probe], fp[~probe]
            asked = np.flatnonzero(probe)
            first = np.searchsorted(index_key, key[asked], "left")
            count = np.searchsorted(index_key, key[asked], "right") - first
            asked, first, count = asked[count > 0], first[count > 0], count[count > 0]
            done = np.cumsum(count)
            left, right = [], []
            at = 0
            while at < len(asked):
                base = done[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(done, base + SLAB, "right")))
                c = count[at:to]
                me = np.repeat(np.arange(at, to), c)
                other = np.arange(len(me)) - np.repeat(np.cumsum(c) - c, c) + first[me]
                x, y = fp[asked[me]], index_fp[other]
                near = (np.bitwise_count(x ^ y) <= radius) & (x != y)
                if near.any():
                    a, b = spanning_edges(x[near], y[near])
                    left.append(a)
                    right.append(b)
                at = to
            if left:
                a, b = spanning_edges(np.concatenate(left), np.concatenate(right))
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
            last = index_key == key[-1] if len(key) else np.zeros(0, bool)
            held_key, held = index_key[last], index_fp[last]

    return rows.repartition("key").sortWithinPartitions("key", "probe").mapInArrow(run, "a long, b long")


def near_edges(fps: DataFrame, radius: int, count: int) -> DataFrame:
    """Edges (a, b) among distinct fingerprints that connect what lies within the radius."""
    groups = bit_groups(fps, choose_parts(count, radius))

    def tally(batches):
        # each task sums its own rows first: at most BINS rows per partition leave it
        seen = np.zeros((len(groups), BINS), np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for i, g in enumerate(groups):
                seen[i] += np.bincount(bins(values(fp, g), len(g)), minlength=BINS)
        part, bin_ = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(bin_), pa.array(seen[part, bin_])], names=["part", "bin", "n"])

    counted = fps.select("fp").mapInArrow(tally, "part long, bin long, n long").groupBy("part", "bin").agg(F.sum("n").alias("n"))
    got = counted.toPandas()
    histogram = np.zeros((len(groups), BINS), np.float64)
    histogram[got["part"].to_numpy(int), got["bin"].to_numpy(int)] = got["n"]
    return verify(probes(fps, groups, histogram, radius), radius)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """(id, fingerprint, component_id) for every row: the least id reachable over links.

    Keeps only the id column of the input; other columns, whatever their names, are not read.
    """
    work = Workspace(docs.sparkSession, "simhash")
    marked = work.write(fingerprints(docs, id_col, text_col, width), "fingerprints")
    fps = work.write(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    edges = near_edges(fps, radius, fps.count())
    tree = components(edges, work)
    named = fps.join(tree, fps["fp"] == tree["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = named.join(least, "root").select("fp", "component_id")
    return marked.join(answer, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_simhash(spark, folder: str) -> DataFrame:
    from .common import table

    return near_duplicates(table(spark, folder, "documents"))
