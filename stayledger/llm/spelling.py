"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

Two words one edit apart agree in their first half or in their last: with L the shorter
length and m = L // 2, an edit after position m leaves the first m code points alone, an
edit before it the last L - m. So words meet in lists keyed by (direction, L, that half);
the backward lists hold reversed words, and each word stands in four lists at most. A list
is sorted and walked depth by depth. Words with a common prefix form one range, told by the
longest common prefixes of neighbours, and the banded row of the edit matrix of that prefix
against a query word is computed once for the whole range. A range whose row exceeds one
edit is skipped with everything in it. All queries of a list advance together.

Lists over LIST words are cut into a grid of query and list cells by a hash of the word, so
no list is gathered whole; every pair is still met.

Null and empty texts hold no words. A null doc_id hashes like an empty text before the colon.
Repeated rows count again. A table without words gives no rows. Of the columns only the id
and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, table

#: Words shorter or rarer than this are no words; a form is so many times as frequent.
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: One occurrence in so many loses a letter.
ONE_IN = 199
#: Words of a list that one task holds; code points laid side by side; pairs walked at once.
LIST, SLAB, FRONT = 16384, 1 << 22, 1 << 21
#: Lists over the size are at most so many, so that their sizes can be broadcast.
HOT_LISTS = 1 << 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NEAR = "word string, n_near long, best_n long, best string"


def band_steps() -> np.ndarray:
    """steps[row, equal]: the next row of the band.

    A row holds D[p][p-1], D[p][p], D[p][p+1] in base three, two meaning two or more; bits
    of equal tell whether the list's next letter equals the query's letter p-1, p, p+1.
    """
    out = np.zeros((27, 8), np.uint8)
    for row in range(27):
        left, mid, right = row // 9, row // 3 % 3, row % 3
        for equal in range(8):
            a = min(left + (not equal & 1), mid + 1, 2)
            b = min(mid + (not equal & 2), right + 1, a + 1, 2)
            c = min(right + (not equal & 4), b + 1, 2)
            out[row, equal] = a * 9 + b * 3 + c
    return out


STEPS = band_steps()
#: Both prefixes equal: distance zero, and one towards either neighbour.
EQUAL_ROW, DEAD_ROW = 1 * 9 + 0 * 3 + 1, 26
CELL = np.array([[row // 9, row // 3 % 3, row % 3] for row in range(27)], np.uint8)


def letters(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points side by side, one zero before and zeros after, and the lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), width + 4), np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    row = np.repeat(np.arange(len(words)), sizes)
    out[row, 1 + np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out, sizes


def near_pairs(asked, listed, heads: np.ndarray, node: np.ndarray, depth: int, short: int):
    """Pairs (query, list place) exactly one edit apart, lengths short or short + 1.

    asked and listed are (code points, lengths); listed holds sorted lists of words that
    share their first `depth` letters, one behind the other. heads are the places where
    lists start, node the number of each query's list.
    """
    q_letters, q_size = asked
    letter, size = listed
    ends = np.arange(len(size))
    # the first column in which a row differs from the one before it: its common prefix
    differ = letter[1:, 1:] != letter[:-1, 1:]
    prefix = np.append(-1, np.where(differ.any(axis=1), differ.argmax(axis=1), letter.shape[1]))
    prefix[heads] = -1
    bounds = {p: ends[prefix < p] for p in range(depth, short + 2)}
    found = []

    def accept(q, first, row, p):
        gap = q_size[q] - p + 1
        ok = (size[first] == p) & (gap >= 0) & (gap <= 2)
        ok[ok] = CELL[row[ok], gap[ok]] == 1
        found.append((q[ok], first[ok]))

    def walk(q, at, row, p):
        while len(q):
            if len(q) > FRONT:
                half = len(q) // 2
                walk(q[:half], at[:half], row[:half], p)
                q, at, row = q[half:], at[half:], row[half:]
                continue
            first = bounds[p][at]
            if p >= short:
                accept(q, first, row, p)
            if p > short:
                return
            # the ranges of the next letter inside each range
            child = np.searchsorted(bounds[p + 1], np.append(bounds[p], len(size)))
            many = child[at + 1] - child[at]
            which = np.repeat(np.arange(len(q)), many)
            at = child[at][which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            q, row = q[which], row[which]
            c = letter[bounds[p + 1][at], 1 + p]
            equal = (q_letters[q, p] == c) | ((q_letters[q, p + 1] == c) << 1) | ((q_letters[q, p + 2] == c) << 2)
            row = STEPS[row, equal]
            live = (row != DEAD_ROW) & (c != 0)
            q, at, row, p = q[live], at[live], row[live], p + 1

    walk(np.arange(len(q_size)), node, np.full(len(q_size), EQUAL_ROW, np.uint8), depth)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def near_in_slab(rows: list[tuple], backward: bool, short: int):
    """(word, n_near, best_n, best) of the queries of whole lists of one direction and length.

    rows are (list, side, word, n), sorted; side 0 asks and is asked, 1 asks, 2 is asked.
    """
    half = short // 2
    depth = short - half if backward else half
    width = short + 1
    asking = [r for r in rows if r[1] != 2]
    lists = [r for r in rows if r[1] != 1]
    if not asking or not lists:
        return [], [], [], []
    turn = (lambda w: w[::-1]) if backward else (lambda w: w)
    asked, listed = letters([r[2] for r in asking], width), letters([r[2] for r in lists], width)
    starts, heads = {}, []
    for place, r in enumerate(lists):
        if r[0] not in starts:
            starts[r[0]] = len(starts)
            heads.append(place)
    known = np.array([r[0] in starts for r in asking])
    asking = [r for r, k in zip(asking, known.tolist(), strict=True) if k]
    asked = asked[0][known], asked[1][known]
    q, a = near_pairs(asked, listed, np.array(heads), np.array([starts[r[0]] for r in asking], np.int64), depth, short)
    # two words of the longer length meet in their own list; the forward lists come first
    keep = ~((asked[1][q] > short) & (listed[1][a] > short))
    q, a = q[keep], a[keep]
    if backward and len(q):
        column = np.arange(half)[None, :]
        first = asked[0][q[:, None], asked[1][q][:, None] - column] == listed[0][a[:, None], listed[1][a][:, None] - column]
        keep = ~first.all(axis=1)
        q, a = q[keep], a[keep]
    words = [turn(r[2]) for r in lists]
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    count = np.array([r[3] for r in lists], np.int64)
    order = np.lexsort((rank[a], -count[a], q))
    q, a = q[order], a[order]
    who, at, many = np.unique(q, return_index=True, return_counts=True)
    best = a[at]
    return [turn(asking[i][2]) for i in who.tolist()], many.tolist(), count[best].tolist(), [words[i] for i in best.tolist()]


def near_words(lists: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best), a row per word and list: rows are (backward, short, half, cell, side, word, n)."""

    def run(batches):
        rows, now, size, last = [], None, 0, None

        def done():
            if rows:
                word, many, n, best = near_in_slab(rows, *now)
                return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(many, pa.int64()), pa.array(n, pa.int64()), pa.array(best, pa.string())], names=["word", "n_near", "best_n", "best"])
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())], names=["word", "n_near", "best_n", "best"])

        for batch in batches:
            for backward, short, half, cell, side, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                group = (half, cell)
                if now != (backward, short) or (size > SLAB and group != last):
                    yield done()
                    rows, now, size = [], (backward, short), 0
                rows.append((group, side, word, n))
                size += len(word) + 4
                last = group
        yield done()

    # neighbours in a sorted run differ in their list, so equal halves stand together
    dealt = lists.repartition("backward", "short", "half", "cell").sortWithinPartitions("backward", "short", "half", "cell", "word")
    return dealt.select("backward", "short", "half", "cell", "side", "word", "n").mapInArrow(run, NEAR)


def list_entries(words: DataFrame, limit: int) -> DataFrame:
    """Every word in its lists, large lists as a grid of cells."""
    size, m = F.length("word"), F.floor(F.col("short") / 2).cast("int")
    shorts = F.array(F.struct((size - 1).alias("short")), F.struct(size.alias("short")))
    each = words.select("word", "n", F.inline(shorts)).where(F.col("short") >= LEAST_LENGTH)
    each = each.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward"))
    turned = F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word"))
    each = each.select("backward", "short", turned.alias("word"), "n", F.when(F.col("backward"), F.col("short") - m).otherwise(m).alias("depth"))
    each = each.select("backward", "short", F.expr("substring(word, 1, depth)").alias("half"), "word", "n")
    large = each.groupBy("backward", "short", "half").agg(F.ceil(F.count("*") / limit).cast("int").alias("cells")).where("cells > 1")
    each = each.join(F.broadcast(large), ["backward", "short", "half"], "left")
    own = F.pmod(F.xxhash64("word"), F.col("cells")).cast("int")
    every = F.sequence(F.lit(0), F.col("cells") - 1)
    asks = F.transform(every, lambda j: F.struct((own * F.col("cells") + j).alias("cell"), F.lit(1).alias("side")))
    is_asked = F.transform(every, lambda i: F.struct((i * F.col("cells") + own).alias("cell"), F.lit(2).alias("side")))
    whole = F.array(F.struct(F.lit(0).alias("cell"), F.lit(0).alias("side")))
    places = F.when(F.col("cells").isNull(), whole).otherwise(F.concat(asks, is_asked))
    return each.select("backward", "short", "half", "word", "n", F.inline(places))


def word_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n): runs of letters, some with a letter taken out by their hash."""
    pattern = "[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH  # shorter runs only get shorter
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(text_col).cast("string"), UPPER, LOWER), F.lit(pattern), F.lit(0))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.expr("cast(h % length(run) as int)")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % ONE_IN == 0, cut).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    work = Workspace(docs.sparkSession, "spelling")
    words = work.write(word_counts(docs, id_col, text_col), "words")
    limit = max(LIST, -(-4 * words.count() // HOT_LISTS))
    found = near_words(list_entries(words, limit))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    given = words.join(near, "word", "left")
    is_form = -F.col("top.less") >= RATIO * F.col("n")
    formed = work.write(given.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("top.best")).alias("form"), F.when(is_form, -F.col("top.less")).alias("form_n")), "forms")
    # each form is RATIO times as frequent, so chains are short; steps double in each round
    step = work.write(formed.where("form is not null").select("word", F.col("form").alias("root")), "step")
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = step.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = work.write(joined, "step")
        if not step.where("moved").take(1):
            break
        step = step.select("word", "root")
    rooted = formed.join(step.select("word", "root"), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, folder: str) -> DataFrame:
    return variant_groups(table(spark, folder, "documents"))


SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY 1, 2),
bytes AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM counted),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h FROM bytes, crc),
spelled AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
cuts AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) AS u(i)),
pairs AS (SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.rest = b.word),
ranked AS (SELECT p.word, p.other, o.n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, p.other) AS r
  FROM pairs p JOIN words o ON o.word = p.other),
formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1),
chain AS (SELECT word, word AS last, form AS following FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.following)
SELECT f.word, f.form, c.last AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.following IS NULL
"""
