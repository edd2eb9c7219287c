"""Removal of long repeated byte strings with suffix arrays by induced sorting.

Every byte covered by a string of `length` bytes that also starts elsewhere is removed.
Equal strings hold the same least window hash (winnowing), so strings can only repeat
among the stretches that share it. Stretches whose hash is met once are settled at once;
the rest is cut out, equal stretches collapse, and each hash's stretches go into one
shard. A shard is sorted by induced sorting, and its permuted common prefixes tell which
strings repeat. A hash shared by more different stretches than a shard takes is decided
by counting its strings across the cluster instead.

Null text: empty. Texts shorter than the length stay whole. Repeated rows are documents
of their own: both are removed. Ids are carried, not read; other columns are ignored.
A cut may split a character: `kept` has every byte left, `kept_text` whole characters only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, table, text_key, texts

GRAM = 64
#: Bytes of one text looked at in one go; bytes of a suffix-sorted shard.
CHUNK, SHARD = 1 << 21, 1 << 20
#: Different stretches of one hash that a shard takes.
MOST = 1500
GAP = 0xFF  # never occurs in UTF-8


# ---- induced sorting -------------------------------------------------------------------


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    rises = np.append(text[ends[:-1]] < text[ends[:-1] + 1], False)
    return np.repeat(rises, np.diff(ends, prepend=-1))


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes from their leftmost-smaller ones in order, bucket by bucket.

    A finished wave of a bucket puts the suffixes before it into their buckets at once;
    those that fall into the same bucket make its next wave.
    """
    def deal(entries, kind, buckets):
        before = entries[entries > 0] - 1
        before = before[small[before] == kind]
        if not len(before):
            return
        letters = text[before]
        order = np.argsort(letters, kind="stable")
        before, letters = before[order], letters[order]
        cuts = np.flatnonzero(np.diff(letters)) + 1
        for part, at in zip(np.split(before, cuts), np.concatenate([[0], cuts]), strict=True):
            buckets[letters[at]].append(part)

    size = int(text.max()) + 1
    heads = [[] for _ in range(size)]
    tails = [[] for _ in range(size)]
    own = np.split(seeds, np.searchsorted(text[seeds], np.arange(1, size)))
    deal(np.array([len(text)]), False, heads)
    for c in range(size):
        at = 0
        while at < len(heads[c]):
            wave = heads[c][at:]
            at += len(wave)
            deal(np.concatenate(wave), False, heads)
        if len(own[c]):
            deal(own[c], False, heads)
    for c in range(size - 1, -1, -1):
        at = 0
        while at < len(tails[c]):
            wave = tails[c][at:]
            at += len(wave)
            deal(np.concatenate(wave), True, tails)
        if heads[c]:
            deal(np.concatenate(heads[c])[::-1], True, tails)
    order = []
    for c in range(size):
        order += heads[c]
        order += [part[::-1] for part in reversed(tails[c])]
    return np.concatenate(order)


def reduced_order(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of the reduced string."""
    n = len(names)
    if names.max() < 256:
        return suffix_array(names)
    # a large alphabet has more buckets than there is work in them: refine ranks by doubling
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    head = np.flatnonzero(np.append(True, sorted_names[1:] != sorted_names[:-1]))
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.repeat(head, np.diff(head, append=n))
    rank[n] = -1
    step = 1
    while True:
        met = np.bincount(rank[:n], minlength=n)
        active = np.flatnonzero(met[rank[:n]] > 1)
        if not len(active):
            break
        key = rank[active] * (n + 1) + rank[np.minimum(active + step, n)] + 1
        sort = np.argsort(key, kind="stable")
        key, active = key[sort], active[sort]
        group = key // (n + 1)
        first = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), np.arange(len(key)), 0))
        same = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), np.arange(len(key)), 0))
        rank[active] = group + same - first
        step *= 2
    out = np.empty(n, np.int64)
    out[rank[:n]] = np.arange(n)
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order (an end sorts before every letter)."""
    text = text.astype(np.int16 if text.dtype != np.uint8 else np.uint8)
    n = len(text)
    if n < 2:
        return np.arange(n)
    small = smaller_than_next(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(lms):
        return induce(text, small, lms)
    order = induce(text, small, lms[np.argsort(text[lms], kind="stable")])
    # the leftmost-smaller substrings are in order now; equal neighbours share a name
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    length = np.zeros(n, np.int64)
    length[lms] = np.diff(lms, append=n) + 1
    same = length[order[1:]] == length[order[:-1]]
    same &= (order[1:] != lms[-1]) & (order[:-1] != lms[-1])
    live, at = np.flatnonzero(same), 0
    while len(live):
        a, b = order[live], order[live + 1]
        differ = text[a + at] != text[b + at]
        same[live[differ]] = False
        at += 1
        live = live[~differ]
        live = live[length[order[live]] > at]
    names = np.empty(n, np.int64)
    names[order] = np.append(0, np.cumsum(~same))
    reduced = names[lms]
    if same.any():
        seeds = lms[reduced_order(reduced)]
    else:
        seeds = order
    return induce(text, small, seeds)


def repeated_starts(text: np.ndarray, length: int) -> np.ndarray:
    """True at each start of a gap-free string of that length that starts elsewhere too.

    Common prefixes with the suffix before are computed in text order: only where the
    letters to the left differ is there anything to compare, elsewhere the value is one
    less than its left neighbour's.
    """
    n = len(text)
    order = suffix_array(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    gaps = np.flatnonzero(text == GAP)
    room = np.append(gaps, n)[np.searchsorted(gaps, np.arange(n))] - np.arange(n)
    left = np.append(GAP, text[:-1])
    fresh = (left == GAP) | (before < 1) | (left != text[np.maximum(before, 1) - 1])
    at = np.flatnonzero(fresh)
    common = np.zeros(n, np.int64)
    padded = np.append(text, np.zeros(16, np.uint8))
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), strides=(1,))
    live = at[(before[at] >= 0) & (room[at] >= length)]
    done = 0
    while len(live):
        differ = words[np.minimum(live + done, n)] ^ words[np.minimum(before[live] + done, n)]
        stop = differ != 0
        low = differ[stop] & (~differ[stop] + np.uint64(1))
        common[live[stop]] = done + np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8
        live = live[~stop]
        done += 8
        over = room[live] <= done
        common[live[over]] = room[live[over]]
        live = live[~over]
    common = np.minimum(common, room)
    last = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
    common = common[last] - (np.arange(n) - last)
    hit = np.flatnonzero(common >= length)
    out = np.zeros(n, bool)
    out[hit] = True
    out[before[hit]] = True
    return out


# ---- winnowing -------------------------------------------------------------------------


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of the `size` bytes (a multiple of 8) at each position."""
    count = len(data) - size + 1
    word = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    word ^= word >> np.uint64(29)
    out = word[:count].copy()
    for at in range(8, size, 8):
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out += word[at : at + count]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    full = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    full[: len(x)] = x
    grid = full.reshape(blocks, width)
    up = np.minimum.accumulate(grid, axis=1).ravel()
    down = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1 : width - 1 + n])


def stretches(data: np.ndarray, ends: np.ndarray, length: int):
    """(lo, n, hash, met) of runs of window starts with one least hash.

    `ends` are the ends of the texts laid side by side in data. met: how often the hash
    occurs in the run's bytes.
    """
    hashes = gram_hashes(data)
    width = length - GRAM + 1
    least = window_minimum(hashes, width)
    begins = np.append(0, ends[:-1])
    count = np.maximum(ends - begins - length + 1, 0)
    starts = np.repeat(begins, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    value = least[starts]
    fresh = np.append(True, (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1))
    head = np.flatnonzero(fresh)
    n = np.diff(head, append=len(starts))
    pieces = -(-n // width)  # a hash that repeats makes long runs; cut them
    again = np.repeat(np.arange(len(head)), pieces)
    k = np.arange(len(again)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    lo = starts[head][again] + k * width
    n = np.minimum(n[again] - k * width, width)
    value = value[head][again]
    met = np.fromiter((np.count_nonzero(hashes[a : a + b] == v) for a, b, v in zip(lo.tolist(), (n + width - 1).tolist(), value, strict=True)), np.int64, len(lo))
    return lo, n, value, met


def pieces_of(column: pa.Array, length: int):
    """Texts of a column laid side by side: (rows, offsets in the text, data, ends)."""
    rows, offsets, parts, size = [], [], [], 0
    for row, text in enumerate(texts(column)):
        for at in range(0, max(0, len(text) - length + 1), CHUNK):
            part = text[at : at + CHUNK + length - 1]
            rows.append(row)
            offsets.append(at)
            parts.append(part)
            size += len(part)
            if size >= CHUNK:
                yield np.array(rows), np.array(offsets), np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
                rows, offsets, parts, size = [], [], [], 0
    if rows:
        yield np.array(rows), np.array(offsets), np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])


def anchors(keyed: DataFrame, length: int) -> DataFrame:
    """(tk1, tk2, lo, n, h, met) for every stretch of every text."""

    def run(batches):
        for batch in batches:
            tk1, tk2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for rows, offsets, data, ends in pieces_of(batch.column(2), length):
                lo, n, h, met = stretches(data, ends, length)
                piece = np.searchsorted(ends, lo, "right")
                row = rows[piece]
                at = lo - np.append(0, ends[:-1])[piece] + offsets[piece]
                yield pa.RecordBatch.from_arrays([pa.array(tk1[row]), pa.array(tk2[row]), pa.array(at.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(met.astype(np.int32))], names=["tk1", "tk2", "lo", "n", "h", "met"])

    return keyed.select("tk1", "tk2", "text").mapInArrow(run, "tk1 long, tk2 long, lo long, n int, h long, met int")


def cut(held: DataFrame, length: int) -> DataFrame:
    """The bytes of the stretches whose hash is met again, named by a 128-bit hash."""

    def run(batches):
        import xxhash

        out = {k: [] for k in ("tk1", "tk2", "lo", "h", "c", "s1", "s2", "seg", "copies")}
        size, last = 0, None
        for batch in batches:
            tk1, tk2, copies = (batch.column(k).to_pylist() for k in (0, 1, 4))
            spans = batch.column(2)
            for row, text in enumerate(texts(batch.column(3))):
                if (tk1[row], tk2[row]) == last:
                    continue  # the copies of a text stand together; one is enough
                last = tk1[row], tk2[row]
                for s in spans[row].as_py():
                    seg = text[s["lo"] : s["lo"] + s["n"] + length - 1]
                    name = xxhash.xxh3_128_digest(seg)
                    for k, v in zip(out, (*last, s["lo"], s["h"], s["c"], int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True), seg, copies[row]), strict=True):
                        out[k].append(v)
                    size += len(seg)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pydict(out, schema)
                    out, size = {k: [] for k in out}, 0
        yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([(k, pa.binary() if k == "seg" else pa.int64()) for k in ("tk1", "tk2", "lo", "h", "c", "s1", "s2", "seg", "copies")])
    return held.select("tk1", "tk2", "spans", "text", "copies").mapInArrow(run, "tk1 long, tk2 long, lo long, h long, c long, s1 long, s2 long, seg binary, copies long")


RUNS = "s1 long, s2 long, runs array<struct<a:int,b:int>>"
RUNS_ARROW = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("runs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])
LEFT = "n_bytes long, spans array<struct<a:long,b:long>>, kept binary, kept_text string"
LEFT_ARROW = pa.schema([("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("kept", pa.binary()), ("kept_text", pa.string())])


def true_runs(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [{"a": a, "b": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def solve(segs: list[tuple], length: int) -> dict:
    """Runs of repeated starts of each (s1, s2, seg, copies) in one shard."""
    out = {"s1": [], "s2": [], "runs": []}
    gap = bytes([GAP])
    flags = repeated_starts(np.frombuffer(gap.join(s[2] for s in segs), np.uint8), length)
    at = 0
    for s1, s2, seg, copies in segs:
        n = len(seg) - length + 1
        runs = [{"a": 0, "b": n}] if copies > 1 else true_runs(flags[at : at + n])
        if runs:
            for k, v in zip(out, (s1, s2, runs), strict=True):
                out[k].append(v)
        at += len(seg) + 1
    return out


def shards(groups: DataFrame, length: int) -> DataFrame:
    """(s1, s2, runs): suffix-sorted hash groups, as many in a shard as fit."""

    def run(batches):
        def settle(group):
            # one stretch, met again only as copies of itself: nothing to sort
            if len(group) == 1 and group[0][3] > 1:
                alone.append(group[0])
            else:
                shard.extend(group)

        def flush(most):
            nonlocal shard, alone
            if alone and len(alone) >= most // 256:
                yield pa.RecordBatch.from_pydict({"s1": [s[0] for s in alone], "s2": [s[1] for s in alone], "runs": [[{"a": 0, "b": len(s[2]) - length + 1}] for s in alone]}, RUNS_ARROW)
                alone = []
            if shard and sum(len(s[2]) for s in shard) >= most:
                yield pa.RecordBatch.from_pydict(solve(shard, length), RUNS_ARROW)
                shard = []

        shard, alone, group, now = [], [], [], None
        for batch in batches:
            for h, s1, s2, seg, copies in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if h != now:
                    settle(group)
                    yield from flush(SHARD)
                    group, now = [], h
                group.append((s1, s2, seg, copies))
        settle(group)
        yield from flush(0)

    return groups.select("h", "s1", "s2", "seg", "copies").repartition("h").sortWithinPartitions("h").mapInArrow(run, RUNS)


def counted_windows(groups: DataFrame, length: int) -> DataFrame:
    """(s1, s2, runs) of groups too large for a shard: their strings, counted by 128-bit hash."""

    def run(batches):
        for batch in batches:
            for s1, s2, seg, copies in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                data = np.frombuffer(seg + bytes(-len(seg) % 8), np.uint8)
                n = len(seg) - length + 1
                size = length // 8 * 8
                one = gram_hashes(data[: len(seg)], size)
                two = gram_hashes(data[: len(seg)] ^ np.uint8(0x5A), size)
                # a length that is no multiple of 8 is covered by a second string at its end
                w1, w2 = one[:n] * np.uint64(31) + one[length - size :][:n], two[:n] * np.uint64(31) + two[length - size :][:n]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, s1)), pa.array(np.full(n, s2)), pa.array(np.arange(n, dtype=np.int32)), pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.full(n, copies))], names=["s1", "s2", "pos", "w1", "w2", "copies"])

    windows = groups.select("s1", "s2", "seg", "copies").mapInArrow(run, "s1 long, s2 long, pos int, w1 long, w2 long, copies long")
    met = windows.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1")
    hits = windows.join(met, ["w1", "w2"], "left_semi")
    spot = F.sort_array(F.collect_set("pos"))
    run_of = F.transform("p", lambda x: F.struct(x.alias("a"), (x + 1).alias("b")))
    return hits.groupBy("s1", "s2").agg(spot.alias("p")).select("s1", "s2", run_of.alias("runs"))


def finish(docs: DataFrame, id_type: str) -> DataFrame:
    """What is left of (id, text, spans); rows go on by 4 MB of text, not by whole batches."""

    def run(batches):
        for batch in batches:
            spans = batch.column(2)
            out, first, size = {k: [] for k in LEFT_ARROW.names}, 0, 0
            for row, text in enumerate(texts(batch.column(1))):
                runs, got = [], spans[row].values if spans[row].is_valid else None
                if got is not None and len(got):
                    mark = np.zeros(len(text) + 1, np.int32)
                    np.add.at(mark, got.field("a").to_numpy(), 1)
                    np.add.at(mark, got.field("b").to_numpy(), -1)
                    runs = true_runs(np.cumsum(mark)[:-1] > 0)
                pieces = [text[lo:hi] for lo, hi in zip([0, *(r["b"] for r in runs)], [*(r["a"] for r in runs), len(text)], strict=True)]
                # a cut may split a character: its bytes are in kept, but in no piece's text
                for k, v in zip(out, (len(text), runs, b"".join(pieces), "".join(p.decode("utf-8", "ignore") for p in pieces)), strict=True):
                    out[k].append(v)
                size += len(text)
                if size > 1 << 22:
                    yield with_ids(batch.column(0).slice(first, row + 1 - first), out)
                    out, first, size = {k: [] for k in out}, row + 1, 0
            yield with_ids(batch.column(0).slice(first), out)

    def with_ids(ids, out):
        return pa.RecordBatch.from_arrays([ids, *(pa.array(out[f.name], f.type) for f in LEFT_ARROW)], names=["id", *LEFT_ARROW.names])

    return docs.mapInArrow(run, f"id {id_type}, {LEFT}")


def repeated_spans(docs: DataFrame, text_col: str, length: int, work: Workspace) -> DataFrame:
    """(tk1, tk2, spans): byte ranges to remove, per text that has any."""
    keyed = docs.select(*text_key(text_col), F.col(text_col).cast("string").alias("text"))
    found = anchors(keyed, length)
    # every stretch of a copy counts; a text's copies then give one set of stretches
    met = found.groupBy("h").agg(F.sum("met").alias("c")).where("c > 1")
    span = F.struct("lo", "n", "h", "c")
    kept = found.join(met, "h").groupBy("tk1", "tk2").agg(F.collect_set(span).alias("spans"))
    copies = keyed.groupBy("tk1", "tk2").agg(F.count("*").alias("copies"))
    segs = work.write(cut(keyed.join(kept.join(copies, ["tk1", "tk2"]), ["tk1", "tk2"]), length), "stretches")
    # the same text may have been cut in two tasks; its stretches then count as one
    distinct = segs.groupBy("h", "s1", "s2", "seg").agg(F.max("c").alias("c"), F.sum("copies").alias("copies"))
    small = distinct.where(F.col("c") <= MOST)
    large = distinct.where(F.col("c") > MOST)
    many = large.groupBy("h").agg(F.count("*").alias("d"))
    sized = large.join(many, "h")
    runs = shards(small.select("h", "s1", "s2", "seg", "copies").union(sized.where(F.col("d") <= MOST).select("h", "s1", "s2", "seg", "copies")), length)
    runs = runs.union(counted_windows(sized.where(F.col("d") > MOST), length))
    spans = segs.select("tk1", "tk2", "lo", "s1", "s2").join(runs, ["s1", "s2"])
    spans = spans.select("tk1", "tk2", F.explode(F.transform("runs", lambda r: F.struct((F.col("lo") + r.a).alias("a"), (F.col("lo") + r.b + (length - 1)).alias("b")))).alias("s"))
    return spans.groupBy("tk1", "tk2").agg(F.collect_set("s").alias("spans"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """(id, n_bytes, spans, kept, kept_text) for every row.

    n_bytes: of the whole text. spans: the maximal removed byte runs [a, b). kept: the
    bytes left. kept_text: the same as text, without the characters that a cut splits.
    """
    work = Workspace(docs.sparkSession, "suffix")
    spans = repeated_spans(docs, text_col, length, work)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *text_key(text_col))
    joined = own.join(spans, ["tk1", "tk2"], "left").select("id", "text", "spans")
    return finish(joined, own.schema["id"].dataType.simpleString()).withColumnRenamed("id", id_col)


def digests() -> list:
    """What is told of a row of `without_repeats` in place of its bytes."""
    return [F.col("n_bytes"), (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    return without_repeats(docs, id_col, text_col, length).select(id_col, *digests())


def op6_suffix_dedup(spark, folder: str) -> DataFrame:
    """The digests, and after them the bytes left (n_kept) and the text left (kept_text)."""
    left = without_repeats(table(spark, folder, "documents"))
    return left.select("doc_id", *digests(), F.octet_length("kept").cast("long").alias("n_kept"), "kept_text")
