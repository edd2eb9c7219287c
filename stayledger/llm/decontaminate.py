"""Benchmark decontamination with suffix arrays over the training documents.

Words are hashed in bulk. Each task sorts the suffixes of its documents (those that
begin like some test suffix; no other can match) into shard arrays, binary-searches every
distinct test window in them, and marks the words at all matching locations. Hashes only
propose: no two words of a set of test items share one (else the set takes another seed),
and a place counts if its words are the test words byte for byte.

Null or wordless text has no words: zero counts, no items, not contaminated. Wordless
items have no window. An item id that is null is listed as an empty string; an id that
stands in several rows counts once. Repeated documents are judged each for itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, texts

#: Bytes of documents in one shard; bytes of test items that one step holds.
SHARD, ITEM_BYTES = 1 << 22, 1 << 24
BASE = 0x9E3779B97F4A7C15
BITS = 22
#: Words over so many bytes are hashed one by one: the bulk hash has known collisions of long words.
LONG = 64


def word_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: its lower-case form, and whether it belongs to a word."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x61:0x7B] = word[0x80:] = True
    return low, word[low]


def powers(n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the seed's base and of its inverse."""
    base = (BASE + 2 * seed * 0xD1342543DE82EF95) % (1 << 64)

    def chain(base):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return chain(base), chain(pow(base, -1, 1 << 64))


def words_of(parts: list[bytes], tables, power, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid side by side: 64-bit word hashes, words per part, lower-cased bytes, where words start and stop."""
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts])
    low, word = tables
    inside = np.concatenate([[False], word[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    lower = low[data]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * power[0][: len(data)], out=total[1:])
    value = (total[stop] - total[start]) * power[1][start]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= (value >> np.uint64(32)) + (stop - start).astype(np.uint64)
    for k in np.flatnonzero(stop - start > LONG):
        word = hashlib.blake2b(lower[start[k] : stop[k]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
        value[k] = int.from_bytes(word.digest(), "little")
    return np.maximum(value, np.uint64(1)), np.diff(np.searchsorted(start, ends), prepend=0), lower, start, stop


def vocabulary(words: np.ndarray, lower: np.ndarray, start: np.ndarray, stop: np.ndarray) -> dict[int, bytes] | None:
    """The word of every hash, or None if two words share one."""
    data, known = lower.tobytes(), {}
    for value, a, b in zip(words.tolist(), start.tolist(), stop.tolist(), strict=True):
        if known.setdefault(value, data[a:b]) != data[a:b]:
            return None
    return known


def windows_at(words: np.ndarray, at: np.ndarray, room: np.ndarray, width: int) -> np.ndarray:
    """The next `width` words from each position as one sortable string; zero past the end."""
    rows = np.zeros((len(at), width), ">u8")
    padded = np.append(words, np.zeros(width, np.uint64))
    for k in range(width):
        rows[:, k] = np.where(room > k, padded[at + k], np.uint64(0))
    return rows.view(f"S{8 * width}").ravel()


def starts_hash(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each position that has so many."""
    n = max(0, len(words) - k + 1)
    out = words[:n].copy()
    for i in range(1, k):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + words[i : i + n]
    return (out >> np.uint64(64 - BITS)).astype(np.int64)


def test_index(items: list[tuple], width: int) -> dict:
    """Distinct test windows in order, their lengths, and the items that hold them."""
    tables, seed, known = word_tables(), -1, None
    data = [(text or "").encode() for _, text in items]
    while known is None:
        seed += 1
        power = powers(sum(map(len, data)) + len(data) + 2, seed)
        every, counts, *places = words_of(data, tables, power, seed) if data else (np.zeros(0, np.uint64), [], *[np.zeros(0, np.int64)] * 3)
        known = vocabulary(every, *places)
    ends = np.cumsum(counts, dtype=np.int64)
    names, rows, lengths, owner = [], [], [], []
    heads = {k: np.zeros(1 << BITS, bool) for k in (1, 2, 3)}
    for k, (name, _) in enumerate(items):
        words = every[ends[k] - counts[k] : ends[k]]
        if not len(words):
            continue
        size = min(width, len(words))
        at = np.arange(len(words) - size + 1)
        rows.append(windows_at(words, at, np.full(len(at), size), width))
        lengths.append(np.full(len(at), size))
        owner.append(np.full(len(at), len(names)))
        k = min(3, size)
        heads[k][starts_hash(words, k)] = True
        names.append("" if name is None else str(name))
    if not rows:
        return {"rows": np.zeros(0, f"S{8 * width}"), "heads": {}, "names": [], "seed": seed, "words": known}
    window, group = np.unique(np.concatenate(rows), return_inverse=True)
    length = np.zeros(len(window), np.int64)
    length[group] = np.concatenate(lengths)
    pair = np.unique(np.stack([group, np.concatenate(owner)]), axis=1)
    return {"rows": window, "length": length, "first": np.searchsorted(pair[0], np.arange(len(window) + 1)), "items": pair[1], "names": names, "heads": {k: v for k, v in heads.items() if v.any()}, "seed": seed, "words": known}


def search(words: np.ndarray, counts: np.ndarray, index: dict, width: int):
    """(position, window) of every place where a test window occurs in the shard."""
    n = len(words)
    if not n or not len(index["rows"]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    room = np.repeat(np.cumsum(counts), counts) - np.arange(n)
    begins = np.zeros(n, bool)
    for k, seen in index["heads"].items():
        begins[: max(0, n - k + 1)] |= seen[starts_hash(words, k)]
    at = np.flatnonzero(begins)
    suffix = windows_at(words, at, room[at], width)
    order = np.argsort(suffix, kind="stable")  # the shard's suffix array
    suffix, at = suffix[order], at[order]
    rows, length = index["rows"], index["length"]
    first = np.searchsorted(suffix, rows, "left")
    last = np.searchsorted(suffix, rows, "right")
    for k in np.flatnonzero(length < width):
        # a short item matches whatever goes on after it
        end = rows[k : k + 1].copy().view(">u8")
        end[length[k] :] = np.iinfo(np.uint64).max
        last[k] = np.searchsorted(suffix, end.view(rows.dtype)[0], "right")
    found = last - first
    window = np.repeat(np.arange(len(rows)), found)
    spot = np.arange(len(window)) - np.repeat(np.cumsum(found) - found, found) + first[window]
    return at[spot], window


def confirmed(at: np.ndarray, length: np.ndarray, words: np.ndarray, lower: np.ndarray, start: np.ndarray, stop: np.ndarray, known: dict[int, bytes]) -> np.ndarray:
    """Which matches hold the test words themselves, not only their hashes."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    asked = np.flatnonzero(np.cumsum(edge)[:-1])
    wrong = np.zeros(len(words) + 1, np.int64)
    for k, value, a, b in zip(asked.tolist(), words[asked].tolist(), start[asked].tolist(), stop[asked].tolist(), strict=True):
        wrong[k + 1] = known[value] != lower[a:b].tobytes()
    wrong = np.cumsum(wrong)
    return wrong[at + length] == wrong[at]


def shard_hits(parts: list[bytes], index: dict, width: int, tables, power):
    """Per text: (words, flags of hit words, item numbers)."""
    words, counts, *places = words_of(parts, tables, power, index["seed"])
    at, window = search(words, counts, index, width)
    if len(at):
        real = confirmed(at, index["length"][window], words, *places, index["words"])
        at, window = at[real], window[real]
    mark = np.zeros(len(words) + 1, np.int32)
    if len(at):
        np.add.at(mark, at, 1)
        np.add.at(mark, at + index["length"][window], -1)
    hit = np.cumsum(mark)[:-1] > 0
    ends = np.cumsum(counts)
    doc = np.searchsorted(ends, at, "right")
    pair = np.unique(doc * len(index["rows"]) + window) if len(at) else np.zeros(0, np.int64)
    items: list[set] = [set() for _ in parts]
    for d, w in zip(*(x.tolist() for x in np.divmod(pair, max(1, len(index["rows"])))), strict=True):
        items[d].update(index["items"][index["first"][w] : index["first"][w + 1]].tolist())
    for k, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
        yield b - a, hit[a:b], items[k]


HITS = "n_words long, hits array<struct<a:int,b:int>>, items array<string>"


def mark_hits(docs: DataFrame, index: dict, width: int, id_type: str) -> DataFrame:
    """One step: the hits of one set of items, added to those found before."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    run_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches):
        index, tables = shared.value, word_tables()
        seed = index["seed"]
        power = powers(SHARD + (1 << 17), seed)
        for batch in batches:
            out = {"n": [], "hits": [], "items": []}
            held, size, row = [], 0, 0
            old_hits, old_items = batch.column(3).to_pylist(), batch.column(4).to_pylist()

            def flush():
                nonlocal held, size, row, power
                if held and size + len(held) + 1 > len(power[0]):
                    power = powers(size + len(held) + 1, seed)
                for n, hit, items in shard_hits(held, index, width, tables, power) if held else ():
                    for run in old_hits[row]:
                        hit[run["a"] : run["b"]] = True
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                    out["n"].append(n)
                    out["hits"].append([{"a": a, "b": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                    out["items"].append(sorted(set(old_items[row]) | {index["names"][i] for i in items}))
                    row += 1
                held, size = [], 0

            for text in texts(batch.column(1)):
                if size + len(text) > SHARD:
                    flush()
                held.append(text)
                size += len(text)
            flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out["n"], pa.int64()), pa.array(out["hits"], run_type), pa.array(out["items"], pa.list_(pa.string()))], names=["id", "text", "n_words", "hits", "items"])

    return docs.mapInArrow(run, f"id {id_type}, text string, {HITS}")


def find_overlap(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = 10) -> DataFrame:
    """(id, text, n_words, hits, items) per document: word runs covered by test windows.

    The test items pass through the driver in sets of about ITEM_BYTES, one step over the
    documents for each set, so their number is not limited by a machine's memory.
    """
    chosen = tests.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text"))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    steps = max(1, -(-size // ITEM_BYTES))
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = own.schema["id"].dataType.simpleString()
    none = F.array().cast("array<struct<a:int,b:int>>")
    marked = own.select("id", "text", F.lit(0).cast("long").alias("n_words"), none.alias("hits"), F.array().cast("array<string>").alias("items"))
    for step in range(steps):
        part = chosen.where(F.pmod(F.xxhash64("text"), F.lit(steps)) == step) if steps > 1 else chosen
        marked = mark_hits(marked, test_index([(r[0], r[1]) for r in part.collect()], width), width, id_type)
    return marked


def overlap_report(docs: DataFrame, tests: DataFrame, **names) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, longest_run, first_hit) per document."""
    found = find_overlap(docs, tests, **names)
    length = lambda r: r.b - r.a
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, r: s + length(r))
    return found.select(
        F.col("id").alias(names.get("id_col", "doc_id")),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("hits", length)), F.lit(0)).cast("long").alias("longest_run"),
        F.try_element_at("hits", F.lit(1)).getField("a").alias("first_hit"),
    )


def op9_decontamination(spark, folder: str) -> DataFrame:
    return overlap_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
